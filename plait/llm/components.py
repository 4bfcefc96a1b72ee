"""Connected components of an edge table, for the operators of this folder."""

from __future__ import annotations

from ..operators.components import components

__all__ = ["components"]
