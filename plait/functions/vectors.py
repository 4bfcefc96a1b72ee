"""Vectors as arrays of doubles: norm, product, text form, and the centroid that follows articles in order."""

from __future__ import annotations

import numpy as np
from pyspark.sql import Column, functions as F


def doubles(v: Column) -> Column:
    return v.cast("array<double>")


def dot(a: Column, b: Column) -> Column:
    return F.aggregate(F.zip_with(a, b, lambda x, y: x * y), F.lit(0.0), lambda s, x: s + x)


def norm(v: Column) -> Column:
    length = F.sqrt(F.aggregate(v, F.lit(0.0), lambda s, x: s + x * x))
    return F.when(length == 0, F.lit(1.0)).otherwise(length)


def unit(v: Column) -> Column:
    """The vector of length 1; the zero vector stays."""
    return F.get(F.transform(F.array(norm(v)), lambda length: F.transform(v, lambda x: x / length)), 0)  # the norm once, not once an element


def signed(x: Column, rounded: Column) -> Column:
    """A rounded number, zero with the sign of what was rounded: decimals, by which Spark rounds, know no negative zero."""
    return F.when((rounded == 0) & x.cast("string").startswith("-"), -F.abs(rounded)).otherwise(rounded)


def to_text(v: Column) -> Column:
    """``[x,...]`` with seven decimals, halves to the even digit, a small negative number as ``-0.0000000``; null stays null."""
    return F.when(v.isNotNull(), F.concat(F.lit("["), F.array_join(F.transform(v, lambda x: F.format_string("%.7f", signed(x, F.bround(x, 7)))), ","), F.lit("]")))


def from_text(text: Column) -> Column:
    return F.from_json(text, "array<double>")


def follow(centroid: np.ndarray | None, n: int, vector) -> np.ndarray:
    """The unit centroid of ``n`` vectors after one more: weighed by n, added, brought to length 1 again.  Not the mean: the order
    matters.  A zero vector stays zero."""
    v = np.asarray(vector, float)
    c = v if centroid is None or n <= 0 else (centroid * n + v) / (n + 1)
    return c / (np.sqrt((c * c).sum()) or 1.0)
