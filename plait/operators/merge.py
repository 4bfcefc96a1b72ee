"""Duplicate stories: candidate pairs, guards, the greedy resolution, and its effect on articles, stories and pairs."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window, functions as F

from ..config import Config
from ..functions.scoring import date_compatible, survives
from . import models, retrieval
from .stories import recount


def candidates(stories: DataFrame, now: Column | None = None, config: Config = Config()) -> DataFrame:
    """The most similar pairs of open stories, at most three times as many as may be checked; with ``now`` only recently updated ones."""
    rows = stories.where("status = 'open'")
    if now is not None:
        rows = rows.where(F.col("updated_at") >= now - F.make_dt_interval(hours=F.lit(config.merge_lookback_hours)))
    most = 3 * config.merge_max_checks
    pairs = retrieval.similar_pairs(rows.select("id", F.col("centroid").alias("vector")), config.merge_min_similarity, most=most)
    return pairs.orderBy(F.desc("similarity"), "a_id", "b_id").limit(most)


def unordered(pairs: DataFrame) -> DataFrame:
    """Each two stories once, by their highest similarity; a story with itself never."""
    key = pairs.where("a_id <> b_id").withColumn("x", F.least("a_id", "b_id")).withColumn("y", F.greatest("a_id", "b_id"))
    return key.groupBy("x", "y").agg(F.max("similarity").alias("similarity")).select(F.col("x").alias("a_id"), F.col("y").alias("b_id"), "similarity")


def split_edges(articles: DataFrame) -> DataFrame:
    """Both directions of (story of an article, story it was split from)."""
    one = articles.where("story_id is not null and split_from is not null").select(F.col("story_id").alias("a_id"), F.col("split_from").alias("b_id"))
    return one.unionByName(one.select(F.col("b_id").alias("a_id"), F.col("a_id").alias("b_id"))).distinct()


def judged(pairs: DataFrame, stories: DataFrame, articles: DataFrame, config: Config = Config()) -> DataFrame:
    """Pairs of two open stories, which of them would survive, and why they may not merge (``rejected``): ``date`` if their event dates do not fit, ``split`` if something
    was split between them, else null."""
    s = stories.where("status = 'open'").select("id", "event_date", "article_count", "first_seen")
    rows = pairs.join(s.toDF("a_id", "a_date", "a_count", "a_first"), "a_id").join(s.toDF("b_id", "b_date", "b_count", "b_first"), "b_id")
    rows = rows.join(split_edges(articles).withColumn("split", F.lit(True)), ["a_id", "b_id"], "left")
    rejected = F.when(~date_compatible(F.col("a_date"), F.col("b_date"), config.merge_max_event_gap_days), "date").when(F.col("split"), "split")
    a_stays = survives(F.col("a_count"), F.col("a_first"), F.col("b_count"), F.col("b_first"))
    return rows.select("a_id", "b_id", "similarity", F.when(a_stays, F.col("a_id")).otherwise(F.col("b_id")).alias("survivor"), F.when(a_stays, F.col("b_id")).otherwise(F.col("a_id")).alias("absorbed"), rejected.alias("rejected"))


def allowed(pairs: DataFrame, stories: DataFrame, articles: DataFrame, config: Config = Config()) -> DataFrame:
    """The pairs of ``judged`` that may merge."""
    return judged(pairs, stories, articles, config).where("rejected is null").drop("rejected")


def resolve(pairs: DataFrame, verifier: Callable[[dict], dict] | None, config: Config = Config()) -> tuple[list[tuple], dict]:
    """(absorbed, survivor) for each merge, greedily from the most similar pair down, and counters.  Rows may have ``rejected``: such pairs are counted and not asked about.

    Sequential by nature: an absorbed story takes no further part and the checks are limited; the pairs are at most three times that limit,
    so this list, and nothing that grows with the corpus, comes to the driver.  Without a verifier nothing merges.
    """
    stats = {"candidates": 0, "checked": 0, "merged": 0, "moved": 0, "failed": 0, "rejected_date": 0, "rejected_split": 0}
    if verifier is None:
        return [], stats
    gone, moves = set(), []
    for row in pairs.orderBy(F.desc("similarity"), "a_id", "b_id").limit(3 * config.merge_max_checks).collect():
        stats["candidates"] += 1
        if stats["checked"] >= config.merge_max_checks or row["a_id"] in gone or row["b_id"] in gone:
            continue
        if "rejected" in row and row["rejected"]:
            stats[f"rejected_{row['rejected']}"] += 1
            continue
        try:
            answer = verifier(row.asDict())
            sure = float(answer.get("confidence") or 0)
        except Exception:  # noqa: BLE001  a pair that cannot be judged stays as it is
            stats["failed"] += 1
            continue
        stats["checked"] += 1
        if answer.get("same_development") and sure >= config.merge_min_confidence:
            moves.append((row["absorbed"], row["survivor"]))
            gone.add(row["absorbed"])
            stats["merged"] += 1
    return moves, stats


def final_targets(moves: list[tuple]) -> dict:
    """Where each absorbed story ends up when a survivor is itself absorbed later."""
    to = dict(moves)
    for a in to:
        while to[a] in to:
            to[a] = to[to[a]]
    return to


def apply(articles: DataFrame, stories: DataFrame, pairs: DataFrame, mapping: DataFrame) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Articles moved, stories recounted or marked merged, pairs of absorbed stories retired.  mapping: absorbed, survivor."""
    m = mapping.select(F.col("absorbed").alias("story_id"), "survivor")
    moved = articles.join(m, "story_id", "left").withColumn("story_id", F.coalesce("survivor", "story_id")).select(*articles.columns)
    counts = recount(moved).withColumnRenamed("story_id", "id")
    names = ["article_count", "left_count", "right_count", "center_count"]
    after = stories.drop(*names).join(counts, "id", "left").join(m.withColumnRenamed("story_id", "id"), "id", "left")
    after = after.withColumn("status", F.when(F.col("survivor").isNotNull(), "merged").otherwise(F.col("status"))).drop("survivor")
    after = after.select(*[F.coalesce(c, F.lit(0)).cast(stories.schema[c].dataType).alias(c) if c in names else F.col(c) for c in stories.columns])
    kept = pairs.join(m, "story_id", "left").withColumn("is_current", F.col("is_current") & F.col("survivor").isNull()).select(*pairs.columns)
    return moved, after, kept


def described(pairs: DataFrame, stories: DataFrame, articles: DataFrame) -> DataFrame:
    """Pairs of ``allowed`` with title, summary, dates and first headlines of both stories, and the prompt made of them."""
    told = stories.select("id", "title", "summary", F.col("event_date").cast("string").alias("date"), F.col("first_seen").cast("string").alias("first")).join(headlines(articles).withColumnRenamed("story_id", "id"), "id", "left")
    rows = pairs
    for s in ("a", "b"):
        rows = rows.join(told.toDF(f"{s}_id", f"{s}_title", f"{s}_summary", f"{s}_date", f"{s}_first", f"{s}_headlines"), f"{s}_id")
    return rows.withColumn("prompt", models.merge_prompt())


def headlines(articles: DataFrame, most: int = 6) -> DataFrame:
    """Per story its first headlines, for the verifier."""
    w = Window.partitionBy("story_id").orderBy("published_at", "id")
    rows = articles.withColumn("n", F.row_number().over(w)).where(F.col("n") <= most)
    return rows.groupBy("story_id").agg(F.transform(F.array_sort(F.collect_list(F.struct("n", F.concat_ws(": ", "outlet", "title").alias("line")))), lambda x: x["line"]).alias("headlines"))
