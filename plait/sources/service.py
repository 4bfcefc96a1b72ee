"""A remote table service behind one function that sends a request: retries, and calls of its stored functions.

``procedures`` are the same functions over snapshot tables, for those who call them by name.
"""

from __future__ import annotations

import json
import time
from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, functions as F

from ..config import Config
from ..functions.vectors import from_text
from ..operators import merge, retrieval, stories as S

#: Statuses that another try may mend.
PASSING = frozenset((429, 502, 503, 504))


@dataclass(frozen=True)
class Service:
    """send: a function of (method, path, parameters, body, seconds) to (status, bytes); it may raise OSError."""

    send: Callable[[str, str, dict, bytes | None, float], tuple[int, bytes]]
    tries: int = 3
    pause: float = 1.5
    seconds: float = 30.0
    call_seconds: float = 90.0

    def request(self, method: str, path: str, parameters: dict | None = None, body=None, seconds: float | None = None):
        """The decoded answer, None of an empty one.  Passing statuses and network errors are tried again after growing pauses; other errors are final."""
        data = None if body is None else json.dumps(body).encode()
        for n in range(1, self.tries + 1):
            try:
                status, answer = self.send(method, path, parameters or {}, data, seconds or self.seconds)
            except OSError:
                if n == self.tries:
                    raise
            else:
                if status < 400:
                    return json.loads(answer) if answer and status != 204 else None
                if status not in PASSING or n == self.tries:
                    raise RuntimeError(f"{method} {path}: status {status}: {answer[:300].decode('utf-8', 'replace')}")
            time.sleep(self.pause * n)

    def call(self, name: str, payload: dict):
        """A stored function's answer; functions may take longer than plain requests."""
        return self.request("POST", f"rpc/{name}", body=payload, seconds=self.call_seconds)


def _closest(tables: dict[str, DataFrame], query: str, since: Column, k: int = 10) -> DataFrame:
    """The k open stories most similar to a vector (as text), of those seen since then."""
    stories = tables["stories"].where("status = 'open'").where(F.col("last_seen") >= since)
    one = stories.sparkSession.range(1).select("id", since.cast("timestamp").alias("published_at"), from_text(F.lit(query)).alias("vector"))
    top = retrieval.top_stories(one, stories.select(F.col("story_id").alias("id"), "last_seen", F.col("centroid").alias("vector")), k, 0)
    return top.select(F.col("story_id"), "similarity", "rank").join(stories, "story_id").orderBy("rank").drop("rank")


def _counted(tables: dict[str, DataFrame], target: str) -> DataFrame:
    """The stories with the target's counters taken from its articles."""
    stories, names = tables["stories"], ("article_count", "left_count", "right_count", "center_count")
    counts = S.recount(tables["articles"].where(F.col("story_id") == target)).select("story_id", *[F.col(c).alias(f"__{c}") for c in names])
    rows = stories.join(counts, "story_id", "left")
    mine = F.col("story_id") == target
    return rows.withColumns({c: F.when(mine, F.coalesce(f"__{c}", F.lit(0)).cast("int")).otherwise(F.col(c)) for c in names}).select(*stories.columns)


def _merged(tables: dict[str, DataFrame], survivor: str, absorbed: str) -> dict[str, DataFrame]:
    stories = tables["stories"]
    mapping = stories.sparkSession.createDataFrame([(absorbed, survivor)], "absorbed string, survivor string")
    articles, after, pairs = merge.apply(tables["articles"], stories.withColumnRenamed("story_id", "id"), tables["pairs"], mapping)
    return {"articles": articles, "stories": after.withColumnRenamed("id", "story_id").select(*stories.columns), "pairs": pairs}


def _candidates(tables: dict[str, DataFrame], min_similarity: float, updated_since: Column, max_pairs: int) -> DataFrame:
    rows = tables["stories"].where("status = 'open'").where(F.col("updated_at") >= updated_since)
    found = retrieval.similar_pairs(rows.select(F.col("story_id").alias("id"), F.col("centroid").alias("vector")), min_similarity, most=max_pairs)
    return found.orderBy(F.desc("similarity"), "a_id", "b_id").limit(max_pairs)


PROCEDURES: dict[str, Callable] = {
    "match_stories": _closest,
    "close_stale_stories": lambda tables, now, days=5: S.close_stale(tables["stories"], now, Config(stale_days=days)),
    "refresh_story_stats": _counted,
    "story_merge_candidates": _candidates,
    "merge_stories": _merged,
    "trim_old_bodies": lambda tables, now, days=30: S.trim_bodies(tables["articles"], now, Config(trim_days=days)),
    "refresh_feed_stories": lambda tables: S.feed(tables["stories"], tables["pairs"], tables["articles"]),
}


def call(name: str, tables: dict[str, DataFrame], **arguments):
    """The function of that name over snapshot tables: the rows asked for, or the tables as they are after it."""
    if name not in PROCEDURES:
        raise LookupError(f"there is no function {name}")
    return PROCEDURES[name](tables, **arguments)
