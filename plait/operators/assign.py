"""Assigning articles to stories: queues, the three-zone decision on a snapshot, and the exact sequential pass.

``decide`` is set-based and judges every article against one snapshot of stories.  ``assign_in_order`` is the exact online
form, in which every article sees what the one before it left; it runs inside one group for each ``block`` value, so that
independent blocks (say, categories) proceed in parallel.
"""

from __future__ import annotations

import hashlib
import json
from collections.abc import Callable, Iterator
from dataclasses import dataclass, field

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window, functions as F

from ..config import Config
from ..functions.scoring import SIDES, CREATING_TYPES, can_create, candidate_score, date_compatible, entity_jaccard, verify_reason, zone
from ..functions.text import placeholder_title
from ..functions.vectors import follow
from . import retrieval

RULE = "plait-1"


def floor_of(config: Config) -> float:
    """The similarity below which a story cannot reach a threshold: names add at most 0.05, time only takes away, scores are rounded to four places."""
    return min(config.verify_threshold, config.attach_threshold) - 0.0501


def queue(articles: DataFrame, now: Column, config: Config = Config()) -> DataFrame:
    """What the next pass works on, in order: new articles oldest first, then orphans that are due for another try."""
    done = articles.where("enrichment_status = 'done' and story_id is null")
    fresh = done.where("assigned_at is null").orderBy("published_at", "id").limit(config.assign_batch).withColumn("phase", F.lit(0))
    due = F.col("published_at") >= now - F.make_dt_interval(hours=F.lit(config.orphan_window_hours))
    tried = F.col("assigned_at") <= now - F.make_dt_interval(mins=F.lit(config.orphan_retry_minutes))
    orphans = done.where((F.col("method") == "orphan") & due & tried).orderBy("published_at", "id").limit(config.orphan_batch).withColumn("phase", F.lit(1))
    return fresh.unionByName(orphans)


def split_memory(assignment: Column | str = "assignment") -> Column:
    """The story that an article was split off from, now or before; null if none."""
    a = F.col(assignment) if isinstance(assignment, str) else assignment
    return F.coalesce(a["split_from"], F.when(a["method"] == "detached", a["from_story"]))


def scored(articles: DataFrame, stories: DataFrame, config: Config = Config()) -> DataFrame:
    """The retrieved candidates of each article that fit its event date, with their scores.  An article's own split-off
    parent is left out after the cut to k."""
    top = retrieval.top_stories(articles, stories, config.candidates, config.candidate_window_hours)
    a = articles.select(F.col("id").alias("article_id"), "published_at", "event_date", "key_entities", "split_from")
    s = stories.select(F.col("id").alias("story_id"), "first_seen", "last_seen", F.col("event_date").alias("story_date"), F.col("key_entities").alias("story_entities"))
    rows = top.join(a, "article_id").join(s, "story_id").where(F.col("split_from").isNull() | (F.col("split_from") != F.col("story_id")))
    rows = rows.where(date_compatible(F.col("event_date"), F.col("story_date"), config.event_date_max_gap_days))
    return rows.withColumn("score", candidate_score(F.col("similarity"), entity_jaccard(F.col("key_entities"), F.col("story_entities")), F.col("published_at"), F.col("last_seen")))


def decide(articles: DataFrame, stories: DataFrame, config: Config = Config()) -> DataFrame:
    """Per article with a vector: decision (attach, verify, create, or orphan where the article may not create), the best story, its score and the reason to verify."""
    rows = scored(articles, stories, config)
    best = Window.partitionBy("article_id").orderBy(F.desc("score"), "rank")
    first = rows.withColumn("n", F.row_number().over(best)).where("n = 1")
    reason = verify_reason(F.col("published_at"), F.col("event_date"), F.col("first_seen"), F.col("story_date"), config)
    first = first.select("article_id", "story_id", "score", reason.alias("reason"))
    out = articles.where("vector is not null").select(F.col("id").alias("article_id"), can_create(F.col("article_type"), F.col("is_wire_copy")).alias("may")).join(first, "article_id", "left")
    decision = zone(F.col("score"), F.col("reason"), config)
    decision = F.when((decision == "create") & ~F.col("may"), "orphan").otherwise(decision)
    return out.select("article_id", "story_id", "score", F.when(F.col("score") >= config.attach_threshold, F.col("reason")).alias("reason"), decision.alias("decision"))


@dataclass
class Story:
    id: str
    summary: str
    title: str
    category: str | None
    event_date: object
    first_seen: pd.Timestamp
    last_seen: pd.Timestamp
    centroid: np.ndarray
    entities: list
    article_count: int = 0
    sides: dict = field(default_factory=lambda: {"left": 0, "right": 0, "center": 0})
    status: str = "open"
    slot: int = -1


class Sequence:
    """The sequential pass over one block: open stories in, assignments and stories out.

    Centroids are the rows of one matrix, so that retrieval is a matrix product however many stories are open.
    """

    def __init__(self, config: Config, verifier=None, stories: list[Story] = ()):
        self.config, self.verifier, self.floor = config, verifier, floor_of(config)
        self.stories: dict[str, Story] = {}
        self.list: list[Story] = []
        self.matrix, self.seen = np.zeros((0, 0)), np.zeros(0, np.int64)
        for s in stories:
            self.add(s)

    def add(self, story: Story) -> None:
        n = len(self.list)
        if n == len(self.seen):
            grown, seen = np.zeros((max(64, 2 * n), len(story.centroid))), np.zeros(max(64, 2 * n), np.int64)
            if n:
                grown[:n], seen[:n] = self.matrix, self.seen
            self.matrix, self.seen = grown, seen
        story.slot = n
        self.list.append(story)
        self.stories[story.id] = story
        self.refresh(story)

    def refresh(self, story: Story) -> None:
        self.matrix[story.slot] = story.centroid
        self.seen[story.slot] = story.last_seen.value if story.status == "open" else np.iinfo(np.int64).min

    @staticmethod
    def side(article) -> str | None:
        if article.leaning_label in ("LEFT", "RIGHT") and (article.leaning_conf or 0) >= 0.6:
            return article.leaning_label.lower()
        return SIDES.get(article.outlet_leaning or "")

    def nearest(self, vector: np.ndarray, since: pd.Timestamp) -> list[tuple[float, Story]]:
        """Of the stories seen since then that could reach a threshold the k most similar; ties go to the least id.  What decides is computed story by story, so it does not depend
        on which other stories there are."""
        n, k = len(self.list), self.config.candidates
        rows = np.flatnonzero(self.seen[:n] >= since.value)
        if not len(rows):
            return []
        sims = self.matrix[rows] @ vector
        least = self.floor if len(rows) <= k else max(self.floor, np.partition(sims, -k)[-k])
        rows = rows[sims >= least - 1e-9]
        sims = np.einsum("ij,j->i", self.matrix[rows], vector)
        rows, sims = rows[sims >= self.floor], sims[sims >= self.floor]
        found = sorted(zip((-sims).tolist(), [self.list[i].id for i in rows.tolist()]))[:k]
        return [(-s, self.stories[i]) for s, i in found]

    def candidates(self, article, vector: np.ndarray, parent) -> tuple[list[tuple[float, float, Story]], list[dict]]:
        """(score, similarity, story) of the retrieved stories that fit the event date, best first, and the record of all in the order of retrieval; the
        split-off parent is out.  Stories that could not reach a threshold are not retrieved, so neither record nor score has them."""
        c = self.config
        names = {e.lower() for e in article.key_entities}
        out, record = [], []
        for sim, s in self.nearest(vector, article.published_at - pd.Timedelta(hours=c.candidate_window_hours)):
            if s.id == parent:
                continue
            dated = article.event_date is not None and s.event_date is not None
            if dated and abs((article.event_date - s.event_date).days) > c.event_date_max_gap_days:
                record.append({"id": s.id, "score": None, "similarity": None, "rejected": "event_date_gap", "verify_reason": None})
                continue
            theirs = {e.lower() for e in s.entities}
            shared = len(names & theirs) / len(names | theirs) if names and theirs else 0.0
            days = abs((article.published_at - s.last_seen).total_seconds()) / 86400
            score = round(sim + 0.05 * shared - 0.02 * days, 4)
            out.append((score, sim, s))
            record.append({"id": s.id, "score": score, "similarity": round(sim, 4), "rejected": None, "verify_reason": None})
        return sorted(out, key=lambda x: -x[0]), record

    def reason(self, article, s: Story) -> str | None:
        if s.first_seen is None:
            return "no_first_seen"
        if article.published_at - s.first_seen > pd.Timedelta(hours=self.config.auto_attach_window_hours):
            return "late"
        if article.event_date is not None and s.event_date is not None and article.event_date > s.event_date:
            return "later_event_date"
        return None

    def verify(self, article, found: list, strong: bool, done: dict) -> Story | None:
        c, shown = self.config, [s for _, _, s in found[:3]]
        if self.verifier is None:
            return shown[0] if strong else None
        answer = self.verifier(article, shown)
        done["verifier"] = json.dumps(answer)
        relation, sure = answer.get("relation"), _number(answer.get("confidence"))
        named = next((s for s in shown if s.id == answer.get("candidate_id")), None)
        if relation == "same_development" and named and (strong or sure >= c.verify_min_confidence):
            return named
        if strong and not (relation in ("follow_up", "unrelated") and sure >= c.split_min_confidence):
            return shown[0]
        return None

    def step(self, article) -> dict:
        """What becomes of one article: method, story, side, best score and the record of the decision; the stories change accordingly."""
        c, side = self.config, self.side(article)
        done = {"method": "orphan", "story_id": None, "side": side, "score": None, "reason": None, "candidates": [], "verifier": None}
        if article.vector is None or not len(article.vector):
            return done | {"reason": "no vector"}
        vector = np.asarray(article.vector, float)
        found, record = self.candidates(article, vector, article.split_from)
        chosen, method, best = None, None, found[0][0] if found else None
        done |= {"score": best, "candidates": record[:5]}
        if found and best >= c.attach_threshold:
            why = self.reason(article, found[0][2])
            for x in record:
                x["verify_reason"] = why if x["id"] == found[0][2].id else None
            chosen, method = (self.verify(article, found, True, done), "verifier") if why else (found[0][2], "threshold")
        elif found and best >= c.verify_threshold:
            chosen, method = self.verify(article, found, False, done), "verifier"
        if chosen is not None:
            n = chosen.article_count
            chosen.centroid = follow(chosen.centroid, n, vector)
            chosen.entities = list(dict.fromkeys([*chosen.entities, *article.key_entities]))[:24]
            chosen.first_seen = article.published_at if chosen.first_seen is None else min(chosen.first_seen, article.published_at)
            chosen.last_seen = max(chosen.last_seen, article.published_at)
            chosen.event_date = chosen.event_date if chosen.event_date is not None else article.event_date
            self.refresh(chosen)
        elif article.article_type in CREATING_TYPES and not article.is_wire_copy:
            name = "s" + hashlib.sha1(str(article.id).encode()).hexdigest()[:16]
            while name in self.stories:  # an article that was split off creates another story than at first
                name = "s" + hashlib.sha1(name.encode()).hexdigest()[:16]
            chosen, method = Story(name, article.event_summary or article.title, article.placeholder, article.category, article.event_date, article.published_at, article.published_at, follow(None, 0, vector), list(article.key_entities)[:24]), "create"
            self.add(chosen)
        else:
            return done | {"reason": f"{article.article_type}{' wire' if article.is_wire_copy else ''} cannot create a story"}
        chosen.article_count += 1
        if side:
            chosen.sides[side] += 1
        return done | {"method": method, "story_id": chosen.id}


def _number(value) -> float:
    try:
        return float(value or 0)
    except (TypeError, ValueError):
        return 0.0


RECORD = "phase int, reason string, rule string, candidates array<struct<id:string,score:double,similarity:double,rejected:string,verify_reason:string>>, verifier string, split_from string, error string, step int"
STATE = (
    "story struct<id:string,summary:string,title:string,category:string,event_date:date,first_seen:timestamp,last_seen:timestamp,centroid:array<double>,"
    "key_entities:array<string>,article_count:int,left_count:int,right_count:int,center_count:int,status:string>"
)
COLUMNS = ["id", "block", "phase", "published_at", "event_date", "key_entities", "article_type", "is_wire_copy", "leaning_label", "leaning_conf", "outlet_leaning", "split_from", "category", "title", "event_summary", "vector"]
#: A story's columns, and rows whose results a task holds at a time.
KNOWN = "id summary title category event_date first_seen last_seen centroid key_entities article_count left_count right_count center_count status".split()
SLICE = 512


def dumped(s: Story) -> dict:
    """A story as a row of STATE."""
    return {
        "id": s.id, "summary": s.summary, "title": s.title, "category": s.category, "event_date": s.event_date, "first_seen": s.first_seen, "last_seen": s.last_seen, "centroid": s.centroid.tolist(), "key_entities": list(s.entities),
        "article_count": s.article_count, "left_count": s.sides["left"], "right_count": s.sides["right"], "center_count": s.sides["center"], "status": s.status,
    }


def assign_in_order(articles: DataFrame, stories: DataFrame | None = None, verifier: Callable | None = None, config: Config = Config(), with_stories: bool = False) -> DataFrame:
    """The exact online pass: per article the method, story and side, the story's size just after it, and the record of the decision (RECORD).

    articles: COLUMNS; a null block is a block like any other.  stories: the open ones to begin with, with their block (optional).
    verifier: a picklable function of (article, stories shown), or None: strong matches attach, weak ones do not.
    with_stories: also the story as the step left it; a story's last row is its state after the pass.

    An article whose step fails has the method ``failed`` and the error; the others go on.
    """
    rows = articles.select(*COLUMNS).withColumn("placeholder", placeholder_title(F.coalesce(F.nullif("event_summary", F.lit("")), "title")))
    kind = articles.schema["id"].dataType.simpleString()
    schema = f"id {kind}, block string, method string, story_id string, side string, score double, story_size int, {RECORD}" + (f", {STATE}" if with_stories else "")
    names = [f.split()[0] for f in ("id", "block", "method", "story_id", "side", "score", "story_size", "phase", "reason", "rule", "candidates", "verifier", "split_from", "error", "step")] + ["story"] * with_stories

    def steps(run: Sequence, part: pd.DataFrame, first: int) -> Iterator[dict]:
        for n, a in enumerate(part.itertuples(index=False), first):
            error = None
            try:
                a = cleaned(a)
                done = run.step(a)
            except Exception as e:  # noqa: BLE001  one article must not stop the others
                done, error = {"method": "failed", "story_id": None, "side": None, "score": None, "reason": None, "candidates": [], "verifier": None}, str(e)[:300] or type(e).__name__
            story = run.stories.get(done["story_id"])
            more = {"story": None if story is None else dumped(story)} if with_stories else {}
            yield {"id": a.id, "block": _none(a.block), **done, "story_size": story.article_count if story else None, "phase": a.phase, "rule": RULE, "split_from": _none(a.split_from), "error": error, "step": n} | more

    def frame(found: list[dict]) -> pd.DataFrame:
        return pd.DataFrame({c: pd.Series([r[c] for r in found], dtype="Int32" if c == "story_size" else "int32" if c in ("step", "phase") else object if c not in ("id", "score") else None) for c in names})

    # a block's stories, then its articles, stream through one task in order; only the stories are held, and of the results a slice
    if stories is not None:
        known = stories.where("centroid is not null").select("block", F.lit(-1).alias("phase"), F.lit(0).cast(kind).alias("id"), *[F.col(c).alias(f"known_{c}") for c in KNOWN])
        rows = rows.unionByName(known, allowMissingColumns=True)

    def stream(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        block, run, n = None, None, 0
        for part in batches:
            for begin in range(0, len(part), SLICE):
                out = []
                for own, some in part.iloc[begin : begin + SLICE].groupby("block", sort=False, dropna=False):
                    own = _none(own)  # nulls are one block, however they are shown
                    if run is None or own != block:
                        block, run, n = own, Sequence(config, verifier), 0
                    first = some["phase"] < 0
                    for s in some[first].itertuples(index=False):
                        run.add(_held(s))
                    some = some[~first]
                    out += steps(run, some, n)
                    n += len(some)
                if out:
                    yield frame(out)

    return rows.repartition("block").sortWithinPartitions("block", "phase", "published_at", "id").mapInPandas(stream, schema)


def _held(s) -> Story:
    """A row of a stream that is a story to begin with."""
    return Story(
        s.known_id, s.known_summary, s.known_title, s.known_category, _none(s.known_event_date), _none(s.known_first_seen), s.known_last_seen, np.array(s.known_centroid, float), list(s.known_key_entities), int(s.known_article_count),
        {"left": int(s.known_left_count), "right": int(s.known_right_count), "center": int(s.known_center_count)}, s.known_status,
    )


def cleaned(a):
    """A row of a frame with nulls as None and lists as lists."""
    return a._replace(event_date=_none(a.event_date), key_entities=list(a.key_entities) if a.key_entities is not None else [], split_from=_none(a.split_from), leaning_conf=_none(a.leaning_conf), event_summary=_none(a.event_summary))


def _none(x):
    return None if x is None or x is pd.NaT or (isinstance(x, float) and x != x) else x


def counters() -> dict[str, Column]:
    """What became of the articles of a pass, as aggregates over its rows: observed while these are written."""
    is_ = lambda *methods: F.count_if(F.col("method").isin(*methods))
    return {
        "processed": F.count(F.lit(1)), "attached": is_("threshold", "verifier"), "created": is_("create"), "orphaned": is_("orphan"), "failed": is_("failed"), "verified": F.count("verifier"), "verifier_attached": is_("verifier"),
        "orphan_retries": F.count_if(F.col("phase") == 1),
    }


def stats(done: DataFrame) -> DataFrame:
    """The counters of a pass as one row."""
    return done.agg(*[c.alias(name) for name, c in counters().items()])
