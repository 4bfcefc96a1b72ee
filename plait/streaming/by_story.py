"""Assignment as a stream whose state is one row a story, with a timer for every orphan's next try.

``assign_stream_by_story`` is the exact sequential pass of operators.assign over micro-batches, one block a key, like ``online.assign_stream``; but a batch writes only the stories that it touched and the
orphans that it left, not all that the block holds.  Articles that may not found a story and find none wait as orphans: ``orphan_retry_minutes`` of event time later a timer tries them again, and
again, until they attach or ``orphan_window_hours`` have passed since they appeared.  Event time is the watermark, which trails the newest article by ``delay``.

State is bounded by what is open: a story goes when a batch or timer of its block finds it not seen for ``stale_days``, and a timer of its own wakes a block that gets no more articles: time to live
by event time, which the store's own, of processing time, cannot give.  Articles older than the watermark are dropped.  State is kept in RocksDB, the store that maps and timers need.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

from ..config import Config
from ..functions.text import placeholder_title
from ..operators.assign import COLUMNS, Sequence, Story, cleaned

OUTPUT = "id long, block string, method string, story_id string, side string, score double, phase int"
STORY = (
    "summary string, title string, category string, event_day int, first_seen long, last_seen long, centroid array<double>, entities array<string>, "
    "article_count int, left_count int, right_count int, center_count int"
)
ORPHAN = (
    "due long, published_at long, event_day int, key_entities array<string>, article_type string, is_wire_copy boolean, leaning_label string, leaning_conf double, outlet_leaning string, split_from string, "
    "category string, title string, event_summary string, vector array<double>, placeholder string"
)
ROCKS = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
PROVIDER = "spark.sql.streaming.stateStore.providerClass"


def _micros(t) -> int:
    return pd.Timestamp(t).value // 1000


def _moment(micros: int) -> pd.Timestamp:
    return pd.Timestamp(micros * 1000)


def _day(d) -> int | None:
    return None if d is None else (pd.Timestamp(d) - pd.Timestamp(0)).days


def _date(day: int | None):
    return None if day is None else pd.Timestamp(day, unit="D").date()


def story_row(s: Story) -> tuple:
    return (
        s.summary, s.title, s.category, _day(s.event_date), _micros(s.first_seen), _micros(s.last_seen), s.centroid.tolist(), list(s.entities),
        s.article_count, s.sides["left"], s.sides["right"], s.sides["center"],
    )


def story_of(name: str, r) -> Story:
    return Story(name, r[0], r[1], r[2], _date(r[3]), _moment(r[4]), _moment(r[5]), np.asarray(r[6], float), list(r[7]), r[8], {"left": r[9], "right": r[10], "center": r[11]})


class Desk(StatefulProcessor):
    """The stories and waiting orphans of a block."""

    def __init__(self, config: Config, verifier):
        self.config, self.verifier = config, verifier

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.stories = handle.getMapState("stories", "id string", STORY)
        self.orphans = handle.getMapState("orphans", "id long", ORPHAN)

    def _run(self) -> Sequence:
        return Sequence(self.config, self.verifier, [story_of(k[0], v) for k, v in self.stories.iterator()])

    def _step(self, run: Sequence, a, block, phase: int, touched: set) -> tuple:
        try:
            done = run.step(a)
        except Exception:  # noqa: BLE001  one article must not stop the stream
            done = {"method": "failed", "story_id": None, "side": None, "score": None}
        if done["story_id"]:
            touched.add(done["story_id"])
        return a.id, block, done["method"], done["story_id"], done["side"], done["score"], phase

    def _wait(self, a, due: int) -> None:
        row = (
            due, _micros(a.published_at), _day(a.event_date), list(a.key_entities), a.article_type, bool(a.is_wire_copy), a.leaning_label, a.leaning_conf, a.outlet_leaning, a.split_from, a.category, a.title, a.event_summary,
            None if a.vector is None else [float(x) for x in a.vector], a.placeholder,
        )
        self.orphans.updateValue((int(a.id),), row)
        self.handle.registerTimer(due)

    def _close(self, run: Sequence, touched: set, now: pd.Timestamp) -> None:
        """Writes the stories that were touched, gives up those that went stale, and sees to it that the block is woken when the next would be."""
        stale = pd.Timedelta(days=self.config.stale_days)
        gone = {k for k, s in run.stories.items() if s.last_seen < now - stale}
        for k in touched - gone:
            self.stories.updateValue((k,), story_row(run.stories[k]))
            self.handle.registerTimer(int((run.stories[k].last_seen + stale).timestamp() * 1000) + 1)
        for k in gone:
            if self.stories.containsKey((k,)):
                self.stories.removeKey((k,))

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
        part = pd.concat(list(rows)).sort_values(["phase", "published_at", "id"])
        run, touched, out = self._run(), set(), []
        watermark = timerValues.getCurrentWatermarkInMs()
        for a in part.itertuples(index=False):
            a = cleaned(a)
            out.append(self._step(run, a, key[0], int(a.phase), touched))
            if out[-1][2] == "orphan" and a.vector is not None and len(a.vector):
                self._wait(a, max(_micros(a.published_at) // 1000, watermark) + self.config.orphan_retry_minutes * 60_000)
        self._close(run, touched, part["published_at"].max())
        yield pd.DataFrame(out, columns=[f.split()[0] for f in OUTPUT.split(", ")])

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        now = expiredTimerInfo.getExpiryTimeInMs()
        run, touched, out = self._run(), set(), []
        names = [f.split()[0] for f in ORPHAN.split(", ")]
        due = sorted(((v[1], k[0], v) for k, v in self.orphans.iterator() if v[0] <= now), key=lambda x: x[:2])
        for _, n, v in due:
            have = dict(zip(names, v))
            a = pd.Series(have | {"id": n, "published_at": _moment(v[1]), "event_date": _date(v[2]), "key_entities": list(v[3])})
            told = self._step(run, a, key[0], 1, touched)
            if told[2] == "orphan" and v[1] // 1000 >= now - self.config.orphan_window_hours * 3_600_000:
                self.orphans.updateValue((n,), (now + self.config.orphan_retry_minutes * 60_000, *v[1:]))
                self.handle.registerTimer(now + self.config.orphan_retry_minutes * 60_000)
                continue
            self.orphans.removeKey((n,))
            if told[2] != "orphan":
                out.append(told)
        self._close(run, touched, pd.Timestamp(now, unit="ms"))
        yield pd.DataFrame(out, columns=[f.split()[0] for f in OUTPUT.split(", ")]).astype({"id": "int64", "score": float, "phase": "int32"})

    def close(self) -> None:
        pass


def assign_stream_by_story(articles: DataFrame, config: Config = Config(), verifier=None, delay: str = "96 hours") -> DataFrame:
    """A streaming frame of assignments, first ones and those of orphans at a later try (phase 1), from a streaming frame of articles (columns as of assign_in_order, published_at a timestamp; ids
    are numbers)."""
    articles.sparkSession.conf.set(PROVIDER, ROCKS)
    timed = articles.select(*COLUMNS).withColumn("placeholder", placeholder_title(F.coalesce(F.nullif("event_summary", F.lit("")), "title"))).withWatermark("published_at", delay)
    return timed.groupBy("block").transformWithStateInPandas(Desk(config, verifier), OUTPUT, "append", "eventtime")
