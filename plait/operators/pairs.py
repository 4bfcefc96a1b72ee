"""The best left and right article of every story, and whether it replaces the current pair."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window, functions as F

from ..config import Config
from ..functions.scoring import axis_set, displayable, keeps_current, pair_terms
from ..functions.text import near_duplicate, normalise_title
from . import models, pair_blocks

#: What a member must carry for pairing.
MEMBER = ("id", "outlet", "title", "snippet", "image_url", "published_at", "article_type", "direction", "confidence", "axes")


def candidates(articles: DataFrame, current: DataFrame | None = None, near: str = "ratio", config: Config = Config()) -> DataFrame:
    """Every left and right article of one story, different outlets, both fit for display, that do not say the same.

    current: story_id and outlets of the pair that stands.  near: ``ratio`` (longest blocks) or ``title`` (equal normalised titles).
    """
    shown = articles.where(displayable(F.col("is_wire_copy"), F.col("article_type"), F.col("title")) & F.col("story_id").isNotNull())
    told = (normalise_title(F.col("title")).alias("wording"), axis_set(F.col("axes")).alias("axis_set"))  # once an article, not once a pair
    side = lambda s: shown.where(F.col("side") == s).select("story_id", F.struct(*MEMBER, *told).alias("l" if s == "left" else "r"))
    pairs = side("left").join(side("right"), "story_id").where("l.outlet <> r.outlet")
    if near == "title":
        pairs = pairs.where("not (l.wording = r.wording and l.wording <> '')")
    else:
        pairs = pairs.where(~near_duplicate(F.col("l.title"), F.col("l.snippet"), F.col("r.title"), F.col("r.snippet"), config.near_duplicate_ratio))
    outlets = None
    if current is not None:
        pairs = pairs.join(current.select("story_id", F.col("outlets").alias("__outlets")), "story_id", "left")
        outlets = F.col("__outlets")
    return pairs.withColumns(pair_terms("l", "r", outlets, sets=True))


def best(articles: DataFrame, current: DataFrame | None = None, near: str = "ratio", config: Config = Config()) -> DataFrame:
    """Per story the pair of the highest score; ties go to the least ids.

    The members meet in blocks (pair_blocks.py): pairs are no rows, and headlines are compared only from the top down.
    """
    return pair_blocks.best(articles, current, near, config)


def best_by_join(articles: DataFrame, current: DataFrame | None = None, near: str = "ratio", config: Config = Config()) -> DataFrame:
    """The same by a join and one partial aggregate: the plain definition, for small tables and for tests."""
    scored = candidates(articles, current, near, config)
    top = scored.groupBy("story_id").agg(F.min(F.struct((-F.col("score")).alias("s"), F.col("l.id").alias("l"), F.col("r.id").alias("r"), "kind", F.greatest("l.published_at", "r.published_at").alias("at"))).alias("b"))
    return top.select("story_id", F.col("b.l").alias("left_article_id"), F.col("b.r").alias("right_article_id"), F.col("b.kind").alias("pair_kind"), (-F.col("b.s")).alias("divergence_score"), F.col("b.at").alias("featured_at"))


def standing(pairs: DataFrame, articles: DataFrame) -> DataFrame:
    """Current pairs whose two articles are still members of the story, with their outlets."""
    member = articles.select(F.col("id"), F.col("story_id").alias("sid"), "outlet")
    rows = pairs.where("is_current")
    for s in ("left", "right"):
        rows = rows.join(member.toDF(f"{s}_article_id", f"{s}_sid", f"{s}_outlet"), f"{s}_article_id").where(f"{s}_sid = story_id").drop(f"{s}_sid")
    return rows.withColumn("outlets", F.array("left_outlet", "right_outlet"))


def maintain(stories: DataFrame, articles: DataFrame, pairs: DataFrame, near: str = "ratio", config: Config = Config()) -> DataFrame:
    """For each story that had or gets a pair: action (created, replaced, kept, retired) and the pair that is then current."""
    current = standing(pairs, articles)
    choice = best(articles, current, near, config)
    had = pairs.where("is_current").select("story_id", F.lit(True).alias("had"))
    now = current.select("story_id", F.col("left_article_id").alias("cl"), F.col("right_article_id").alias("cr"), F.col("divergence_score").alias("cs"), F.col("featured_at").alias("cf"), F.col("pair_kind").alias("ck"))
    rows = stories.select("story_id").join(had, "story_id", "left").join(now, "story_id", "left").join(choice, "story_id", "left")
    same = F.array_sort(F.array("cl", "cr")) == F.array_sort(F.array("left_article_id", "right_article_id"))
    kept = F.col("cl").isNotNull() & keeps_current(same, F.col("divergence_score"), F.col("cs"), F.col("featured_at"), F.col("cf"))
    none = F.col("left_article_id").isNull()
    action = F.when(none & F.col("had"), "retired").when(none, None).when(kept, "kept").when(F.col("had"), "replaced").otherwise("created")
    pick = lambda new, old: F.when(F.col("action") == "kept", F.col(old)).when(F.col("action") != "retired", F.col(new)).alias(new)
    return rows.withColumn("action", action).where("action is not null").select(
        "story_id", "action", pick("left_article_id", "cl"), pick("right_article_id", "cr"), pick("pair_kind", "ck"), pick("divergence_score", "cs"), pick("featured_at", "cf")
    )


def apply(pairs: DataFrame, changes: DataFrame) -> DataFrame:
    """The pairs table after the changes: at most one current pair a story, one row for each pair of articles."""
    moved = changes.where("action <> 'kept'").select("story_id", F.lit(True).alias("moved"))
    old = pairs.join(moved, "story_id", "left").withColumn("is_current", F.col("is_current") & F.col("moved").isNull()).drop("moved")
    new = changes.where("action in ('created', 'replaced')").select("story_id", "left_article_id", "right_article_id", "pair_kind", "divergence_score", "featured_at", F.lit(True).alias("is_current"))
    keys = ["story_id", "left_article_id", "right_article_id"]
    return old.join(new.select(*keys), keys, "left_anti").unionByName(new, allowMissingColumns=True)


def titles(stories: DataFrame, articles: DataFrame, changes: DataFrame, make: Callable[[], models.Titler]) -> DataFrame:
    """(story_id, title, contrast, error) for stories whose pair is new or whose title no model has written yet; the title of at most 200 characters is null where
    a model's title stands already, and the contrast where the pair stays.  The summary, the story's anchor, is never touched.

    articles: with ``framing`` (what the piece puts first).
    """
    side = lambda s: articles.select(F.col("id").alias(f"{s}_article_id"), F.struct("outlet", "title", "framing").alias(s))
    rows = changes.where("action <> 'retired'").join(stories.select("story_id", "summary", "title_source"), "story_id")
    titled = F.coalesce(F.col("title_source") == "llm", F.lit(False))
    rows = rows.where((F.col("action") != "kept") | ~titled).join(side("left"), "left_article_id").join(side("right"), "right_article_id")
    answers = models.ask(rows.withColumn("prompt", models.title_prompt()), "story_id", "prompt", lambda: make().title)
    told = answers.select("story_id", F.from_json("answer", models.TITLING).alias("t"), "error")
    title = F.nullif(F.substring(F.trim("t.story_title"), 1, 200), F.lit(""))
    return rows.join(told, "story_id").select("story_id", F.when(~titled, title).alias("title"), F.when(F.col("action") != "kept", F.col("t.headline_contrast")).alias("contrast"), "error")


def counters() -> dict[str, Column]:
    """How many stories got, changed, kept or lost their pair, as aggregates over the changes: observed while these are written."""
    return {action: F.count_if(F.col("action") == action) for action in ("created", "replaced", "kept", "retired")}


def ranked(articles: DataFrame, top: int, near: str = "title") -> DataFrame:
    """The ``top`` pairs of each story, for inspection."""
    w = Window.partitionBy("story_id").orderBy(F.desc("score"), "l.id", "r.id")
    return candidates(articles, None, near).withColumn("rank", F.row_number().over(w)).where(F.col("rank") <= top)
