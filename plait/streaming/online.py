"""Assignment as a stream: articles arrive, each block keeps its open stories as state.

``assign_stream`` is the exact sequential pass of operators.assign, one fold for each block, over micro-batches.  State is a
list of stories.  A story not seen for the stale period before the block's newest article goes with the next batch; a block without new articles is woken by an
event-time timeout once the watermark is past the stale period of its newest story, and gives up its state.  So state is bounded by what is open.  Articles older
than the watermark are dropped.
"""

from __future__ import annotations

import json
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, functions as F
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

from ..config import Config
from ..functions.text import placeholder_title
from ..operators.assign import COLUMNS, Sequence, Story, cleaned

OUTPUT = "id long, block string, method string, story_id string, side string, score double"


def _dump(stories: dict[str, Story]) -> str:
    rows = []
    for s in stories.values():
        rows.append({
            "id": s.id, "summary": s.summary, "title": s.title, "category": s.category, "event_date": None if s.event_date is None else str(s.event_date),
            "first_seen": s.first_seen.isoformat(), "last_seen": s.last_seen.isoformat(), "centroid": s.centroid.tolist(), "entities": s.entities, "article_count": s.article_count, "sides": s.sides,
        })
    return json.dumps(rows)


def _load(text: str) -> list[Story]:
    out = []
    for r in json.loads(text):
        day = None if r["event_date"] is None else pd.Timestamp(r["event_date"]).date()
        out.append(Story(r["id"], r["summary"], r["title"], r["category"], day, pd.Timestamp(r["first_seen"]), pd.Timestamp(r["last_seen"]), np.array(r["centroid"]), r["entities"], r["article_count"], r["sides"]))
    return out


def assign_stream(articles: DataFrame, config: Config = Config(), verifier=None, delay: str = "96 hours") -> DataFrame:
    """A streaming frame of assignments from a streaming frame of articles (columns as of assign_in_order, published_at a timestamp)."""

    stale = pd.Timedelta(days=config.stale_days)
    nothing = pd.DataFrame({"id": pd.Series([], dtype="int64"), **{c: pd.Series([], dtype=object) for c in ("block", "method", "story_id", "side")}, "score": pd.Series([], dtype=float)})

    def fold(key: tuple, batches: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        if state.hasTimedOut:
            state.remove()
            yield nothing
            return
        run = Sequence(config, verifier, _load(state.get[0]) if state.exists else [])
        part = pd.concat(list(batches)).sort_values(["phase", "published_at", "id"])
        rows = []
        for a in part.itertuples(index=False):
            try:
                a = cleaned(a)
                done = run.step(a)
            except Exception:  # noqa: BLE001  one article must not stop the stream
                done = {"method": "failed", "story_id": None, "side": None, "score": None}
            rows.append((a.id, key[0], done["method"], done["story_id"], done["side"], done["score"]))
        newest = part["published_at"].max()
        kept = {k: s for k, s in run.stories.items() if s.last_seen >= newest - stale}
        if kept:
            state.update((_dump(kept),))
            until = int((max(s.last_seen for s in kept.values()) + stale).timestamp() * 1000)
            state.setTimeoutTimestamp(max(until, state.getCurrentWatermarkMs() + 1))
        elif state.exists:
            state.remove()
        yield pd.DataFrame(rows, columns=["id", "block", "method", "story_id", "side", "score"])

    timed = articles.select(*COLUMNS).withColumn("placeholder", placeholder_title(F.coalesce(F.nullif("event_summary", F.lit("")), "title"))).withWatermark("published_at", delay)
    return timed.groupBy("block").applyInPandasWithState(fold, OUTPUT, "stories string", "append", GroupStateTimeout.EventTimeTimeout)
