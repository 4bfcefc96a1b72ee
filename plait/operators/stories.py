"""Stories from their articles: counters, spans, entities, centroids, founders, and their life after that."""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame, Window, functions as F

from ..config import Config
from ..functions.scoring import CREATING_TYPES, ordered_union
from ..functions.vectors import follow


def counters(side: Column) -> list[Column]:
    return [F.count(F.lit(1)).alias("article_count")] + [F.count_if(side == s).alias(f"{s}_count") for s in ("left", "right", "center")]


def recount(articles: DataFrame) -> DataFrame:
    """Per story the numbers of articles by side: one partial aggregate, one shuffle of a row a story and task."""
    return articles.where("story_id is not null").groupBy("story_id").agg(*counters(F.col("side")))


def rollup(articles: DataFrame) -> DataFrame:
    """Per story: counters, first and last seen, the earliest article's known event date, and entities in order (24 at most).

    Entities are reduced per (story, name) first, so a story of any size meets as one row a distinct name.
    """
    base = articles.groupBy("story_id").agg(
        *counters(F.col("side")),
        F.min("published_at").alias("first_seen"), F.max("published_at").alias("last_seen"),
        F.min_by("event_date", F.when(F.col("event_date").isNotNull(), F.struct("published_at", "id"))).alias("event_date"),
    )
    names = articles.select("story_id", "published_at", "id", F.posexplode("key_entities").alias("pos", "name"))
    first = names.groupBy("story_id", "name").agg(F.min(F.struct("published_at", "id", "pos")).alias("at"))
    kept = first.withColumn("n", F.row_number().over(Window.partitionBy("story_id").orderBy("at", "name"))).where("n <= 24")
    listed = kept.groupBy("story_id").agg(F.transform(F.array_sort(F.collect_list(F.struct("n", "name"))), lambda x: x["name"]).alias("key_entities"))
    return base.join(listed, "story_id", "left")


def entity_union(lists: Column) -> Column:
    return ordered_union(lists)


def founders(articles: DataFrame) -> DataFrame:
    """Per story its first report: the earliest article with a summary that may create a story and is no agency copy, else the
    earliest with a summary.  A partial aggregate over one struct."""
    report = F.col("article_type").isin(*CREATING_TYPES) & ~F.coalesce(F.col("is_wire_copy"), F.lit(False))
    rows = articles.where("coalesce(event_summary, '') <> ''").withColumn("later", F.when(F.coalesce(report, F.lit(False)), 0).otherwise(1))
    return rows.groupBy("story_id").agg(F.min(F.struct("later", "published_at", "id")).alias("f")).select("story_id", F.col("f.id").alias("founder_id"), (F.col("f.later") == 0).alias("is_report"))


def centroids(articles: DataFrame) -> DataFrame:
    """Per story the centroid that follows its articles in order of publication.

    The fold is not associative, so a story's articles pass one task in order; they stream through it, sorted by Spark (which spills), and
    only the centroid so far is held.
    """
    rows = articles.select("story_id", "published_at", "id", F.col("vector").cast("array<double>").alias("vector")).where("story_id is not null and vector is not null")
    kind = rows.schema["story_id"].dataType.simpleString()

    def fold(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        story, centroid, n = None, None, 0
        for part in batches:
            done = []
            for own, vector in zip(part["story_id"], part["vector"]):
                if own != story:
                    if n:
                        done.append((story, centroid))
                    story, centroid, n = own, None, 0
                centroid = follow(centroid, n, vector)
                n += 1
            yield pd.DataFrame(done, columns=["story_id", "centroid"])
        if n:
            yield pd.DataFrame([(story, centroid)], columns=["story_id", "centroid"])

    dealt = rows.repartition("story_id").sortWithinPartitions("story_id", "published_at", "id").drop("published_at", "id")
    return dealt.mapInPandas(fold, f"story_id {kind}, centroid array<double>")


def mean_centroids(articles: DataFrame, dims: int, wide: int = 128) -> DataFrame:
    """Per story the unit vector of its articles' mean: per-dimension partial sums, for groups of any size.  Up to ``wide`` dimensions are columns of one
    aggregate; more would be too much code for one stage and are rows of (story, dimension)."""
    if dims <= wide:
        sums = articles.groupBy("story_id").agg(*[F.avg(F.element_at("vector", i + 1)).alias(f"m{i}") for i in range(dims)])
        mean = sums.select("story_id", F.array(*[F.col(f"m{i}") for i in range(dims)]).alias("m"))
    else:
        each = articles.select("story_id", F.posexplode(F.slice("vector", 1, dims)).alias("i", "x")).groupBy("story_id", "i").agg(F.avg("x").alias("x"))
        mean = each.groupBy("story_id").agg(F.transform(F.array_sort(F.collect_list(F.struct("i", "x"))), lambda e: e["x"]).alias("m"))
    length = F.sqrt(F.aggregate("m", F.lit(0.0), lambda s, x: s + x * x))
    return mean.withColumn("__l", length).select("story_id", F.transform("m", lambda x: x / F.when(F.col("__l") == 0, 1.0).otherwise(F.col("__l"))).alias("centroid"))


def close_stale(stories: DataFrame, now: Column, config: Config = Config()) -> DataFrame:
    """Open stories without a new article for some days become closed."""
    stale = (F.col("status") == "open") & (F.col("last_seen") < now - F.make_dt_interval(days=F.lit(config.stale_days)))
    return stories.withColumn("status", F.when(stale, "closed").otherwise(F.col("status")))


def trim_bodies(articles: DataFrame, now: Column, config: Config = Config()) -> DataFrame:
    """Bodies of old articles become null."""
    old = F.col("published_at") < now - F.make_dt_interval(days=F.lit(config.trim_days))
    return articles.withColumn("body_text", F.when(old, F.lit(None).cast("string")).otherwise(F.col("body_text")))


def feed(stories: DataFrame, pairs: DataFrame, articles: DataFrame) -> DataFrame:
    """Open stories with a current pair whose two articles are still members, titles that are no articles left out."""
    from ..functions.text import is_non_article

    member = articles.select("story_id", F.col("id").alias("aid"), "outlet", "title")
    side = lambda s: member.select(F.col("story_id").alias(f"{s}_story"), F.col("aid").alias(f"{s}_article_id"), F.col("outlet").alias(f"{s}_outlet"), F.col("title").alias(f"{s}_title"))
    rows = stories.where("status = 'open'").join(pairs.where("is_current").drop("is_current"), "story_id")
    rows = rows.join(side("left"), "left_article_id").where("left_story = story_id").join(side("right"), "right_article_id").where("right_story = story_id")
    rows = rows.where(~is_non_article(F.col("left_title")) & ~is_non_article(F.col("right_title")))
    return rows.select("story_id", "left_article_id", "right_article_id", "pair_kind", "divergence_score", "left_outlet", "right_outlet", "last_seen")
