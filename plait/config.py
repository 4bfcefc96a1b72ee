"""Thresholds and limits of the story engine, and their overrides from the environment or a settings file.

No operator reads a clock: the reference point in time is always an argument.
"""

from __future__ import annotations

import dataclasses
import os
from dataclasses import dataclass


@dataclass(frozen=True)
class Config:
    embed_dims: int = 768
    # ingest
    feed_max_age_hours: int = 72
    max_per_run: int = 40
    min_body_chars: int = 300
    fetch_workers: int = 8
    # assignment
    attach_threshold: float = 0.83
    verify_threshold: float = 0.66
    candidate_window_hours: int = 96
    candidates: int = 10
    event_date_max_gap_days: int = 3
    auto_attach_window_hours: int = 12
    verify_min_confidence: float = 0.6
    split_min_confidence: float = 0.70
    assign_batch: int = 300
    orphan_batch: int = 100
    orphan_window_hours: int = 48
    orphan_retry_minutes: int = 55
    stale_days: int = 5
    # merging
    merge_min_similarity: float = 0.86
    merge_lookback_hours: int = 48
    merge_max_checks: int = 30
    merge_max_event_gap_days: int = 1
    merge_min_confidence: float = 0.7
    # pairs
    pairs_lookback_hours: int = 48
    near_duplicate_ratio: float = 0.90
    # enrichment
    enrich_batch: int = 200
    enrich_workers: int = 4
    body_chars_for_prompt: int = 4000
    framing_body_chars: int = 1500
    framing_cap: int = 3000
    # housekeeping
    recheck_cap: int = 2000
    trim_days: int = 30


def read_settings_file(path: str) -> dict[str, str]:
    """KEY=VALUE lines; blank lines and lines that start with # are skipped, quotes around a value go."""
    found = {}
    with open(path, encoding="utf-8") as lines:
        for line in map(str.strip, lines):
            if line and not line.startswith("#") and "=" in line:
                key, value = line.split("=", 1)
                found[key.strip()] = value.strip().strip("'\"")
    return found


def from_environment(env: dict[str, str] | None = None, prefix: str = "PLAIT_") -> Config:
    """The defaults, each overridden by PLAIT_<NAME> if that is set and not empty, in the default's type."""
    env = dict(os.environ) if env is None else env
    given = {}
    for f in dataclasses.fields(Config):
        raw = env.get(prefix + f.name.upper())
        if raw not in (None, ""):
            given[f.name] = type(f.default)(raw)
    return Config(**given)
