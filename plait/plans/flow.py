"""The whole run as one composition of pure stages: feed entries and pages in, feed rows out.

Every stage is a function from frames to frames; ``run`` publishes each table once, so that a lost executor or a failing later
stage costs one stage.  A run starts from the tables of an earlier one: known links are passed over, what is pending is enriched, new articles and orphans that
are due meet the open stories.  Housekeeping (merging, closing, trimming) may fail without ending the run; the feed may not.

A story's id is the same text in all tables: ``story_id`` of articles, stories and pairs.
"""

from __future__ import annotations

import logging
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, functions as F

from ..config import Config
from ..operators import assign, conflicts, enrich, ingest, merge, models, pairs, recheck, stories as S
from ..sources import pages as P, tables
from ..sources.tables import replaced

log = logging.getLogger("plait")


def build_stage(wanted: DataFrame, sources: DataFrame, pages: DataFrame, now: Column, config: Config = Config()) -> DataFrame:
    """Article rows of wanted entries from their pages (link, final_url, html)."""
    got = wanted.join(pages, "link").join(sources.select(F.col("id").alias("source_id"), "outlet"), "source_id")
    page = P.extract_pages(got.select("canonical_url", "html").dropDuplicates(["canonical_url"]), "canonical_url")
    entry = F.struct("title", "summary", "published_at", "image_url", "author").alias("entry")
    body = F.struct("title", "description", "text", "image", "authors", "published_at", "section", "wire_hint", "jsonld_type").alias("page")
    fetched = got.select("source_id", "outlet", "pos", F.col("final_url").alias("link"), "canonical_url", entry).join(page.select("canonical_url", body, "html_bytes"), "canonical_url").drop("canonical_url")
    return ingest.build_rows(fetched, now, config)


def ingest_stage(sources: DataFrame, feed: DataFrame, pages: DataFrame, known: DataFrame, now: Column, config: Config = Config()) -> DataFrame:
    """New article rows from feed items and the pages fetched for them."""
    return build_stage(ingest.prune(ingest.entries(feed), sources, known, now, config), sources, pages, now, config)


def new_rows(built: DataFrame, known: DataFrame, sources: DataFrame) -> DataFrame:
    """The built rows that the articles table (``known``) lacks, with their numbers."""
    return with_identity(ingest.built_first(built, known, sources)).withColumn("wire_hint", F.col("is_wire_copy"))


def with_identity(rows: DataFrame) -> DataFrame:
    """A stable number for each article, from its canonical URL."""
    return rows.withColumn("id", F.xxhash64("canonical_url"))


STORIES = (
    "story_id string, title string, summary string, category string, event_date date, first_seen timestamp, last_seen timestamp, centroid array<double>, key_entities array<string>, "
    "article_count int, left_count int, right_count int, center_count int, status string, title_source string, updated_at timestamp"
)
PAIRS = "story_id string, left_article_id long, right_article_id long, pair_kind string, divergence_score double, featured_at timestamp, is_current boolean, headline_contrast string"
#: What assignment and rechecks write into the articles table.
ASSIGNMENT = (
    "story_id string, side string, method string, rule string, reason string, score double, candidates array<struct<id:string,score:double,similarity:double,rejected:string,verify_reason:string>>, "
    "verifier string, split_from string, from_story string, assigned_at timestamp"
)


def _with(df: DataFrame, schema: str) -> DataFrame:
    """The frame with null columns for those of the schema that it lacks."""
    empty = df.sparkSession.createDataFrame([], schema).schema
    return df.withColumns({f.name: F.lit(None).cast(f.dataType) for f in empty if f.name not in df.columns}) if set(empty.names) - set(df.columns) else df


def assign_stage(articles: DataFrame, stories: DataFrame | None, sources: DataFrame, now: Column, verifier: Callable | None = None, config: Config = Config()) -> DataFrame:
    """What the exact pass makes of the queue: new articles and orphans that are due, at most a batch of each, against the open stories in the window."""
    articles = _with(articles, ASSIGNMENT)
    lean = sources.select(F.col("id").alias("source_id"), F.col("leaning").alias("outlet_leaning"))
    rows = assign.queue(articles, now, config).join(lean, "source_id", "left").withColumn("block", F.lit(None).cast("string"))
    rows = rows.withColumn("split_from", assign.split_memory(F.struct("split_from", "method", "from_story")))
    known = None
    if stories is not None:
        oldest = rows.agg(F.min("published_at").alias("m")).first()["m"]
        known = stories.where("status = 'open'").withColumnRenamed("story_id", "id").withColumn("block", F.lit(None).cast("string"))
        if oldest is not None:
            known = known.where(F.col("last_seen") >= F.lit(oldest) - F.make_dt_interval(hours=F.lit(config.candidate_window_hours)))
    return conflicts.assign_side_by_side(rows, known, verifier, config, with_stories=True)


def assigned(articles: DataFrame, done: DataFrame, now: Column) -> DataFrame:
    """The articles table after a pass; a failed article stays as it was and is tried again."""
    names = [f.split()[0] for f in ("story_id s", "side s", "method s", "rule s", "reason s", "score s", "candidates s", "verifier s", "split_from s")]
    d = done.where("method <> 'failed'").select("id", *[F.col(c).alias(f"__{c}") for c in names], F.lit(True).alias("__hit"))
    rows = _with(articles, ASSIGNMENT).join(d, "id", "left")
    hit = F.col("__hit").isNotNull()
    changed = {c: F.when(hit, F.col(f"__{c}")).otherwise(F.col(c)) for c in names} | {"split_from": F.coalesce("__split_from", "split_from"), "assigned_at": F.when(hit, now.cast("timestamp")).otherwise(F.col("assigned_at"))}
    return rows.withColumns(changed).drop(*[f"__{c}" for c in names], "__hit")


def stories_after(stories: DataFrame | None, done: DataFrame, now: Column) -> DataFrame:
    """The stories table after a pass: each story as its last step left it; titles that a model wrote stay."""
    last = done.where("story is not null").groupBy(F.col("story.id").alias("story_id")).agg(F.max_by("story", "step").alias("s")).select("story_id", "s.*").drop("id")
    names = [f.split()[0] for f in STORIES.split(", ")]
    fresh = last.withColumns({"title_source": F.lit("auto"), "updated_at": now.cast("timestamp")}).select(*names)
    if stories is None:
        return fresh
    source = stories.select("story_id", F.col("title_source").alias("__source"))
    fresh = fresh.join(source, "story_id", "left").withColumn("title_source", F.coalesce("__source", "title_source")).select(*names)
    return replaced(stories, fresh, "story_id").select(*names)


def pair_members(articles: DataFrame) -> DataFrame:
    return articles.withColumns({"direction": F.col("stance.direction"), "confidence": F.col("stance.confidence"), "axes": F.col("stance.framing_axes"), "framing": F.col("stance.framing_summary")})


def merge_stage(articles: DataFrame, stories: DataFrame, current: DataFrame, verifier: Callable[[dict], dict] | None, now: Column | None = None, config: Config = Config()) -> tuple[DataFrame, DataFrame, DataFrame, dict]:
    """Duplicate stories merged: candidates, guards, the verifier's word, and the effect on all tables."""
    s = stories.withColumnRenamed("story_id", "id")
    found = merge.judged(merge.unordered(merge.candidates(s, now, config)), s, articles, config)
    moves, stats = merge.resolve(merge.described(found, s, articles) if verifier else found, verifier, config)
    if not moves:
        return articles, stories, current, stats
    mapping = articles.sparkSession.createDataFrame(sorted(merge.final_targets(moves).items()), "absorbed string, survivor string")
    stats["moved"] = articles.join(F.broadcast(mapping.select(F.col("absorbed").alias("story_id"))), "story_id", "left_semi").count()
    moved, after, kept = merge.apply(articles, s, current, mapping)
    return moved, after.withColumnRenamed("id", "story_id").select(*stories.columns), kept, stats


def pair_stage(articles: DataFrame, stories: DataFrame, current: DataFrame, since: Column | None = None, make: Callable[[], object] | None = None, config: Config = Config(), publish: Callable[..., DataFrame] | None = None) -> tuple[DataFrame, DataFrame]:
    """(stories, pairs) after pair maintenance of two-sided open stories updated since then; with a model also titles and contrasts."""
    members = pair_members(articles)
    two_sided = stories.where("status = 'open' and left_count >= 1 and right_count >= 1")
    two_sided = two_sided if since is None else two_sided.where(F.col("updated_at") >= since)
    changes = pairs.maintain(two_sided, members, current, config=config)
    changes = publish(changes, "pair_changes", **pairs.counters()) if publish else changes
    after = pairs.apply(current, changes)
    if make is not None:
        told = pairs.titles(stories, members, changes, make)
        told = publish(told, "titles") if publish else told
        contrast = told.where("contrast is not null").join(changes.select("story_id", "left_article_id", "right_article_id"), "story_id").select("story_id", "left_article_id", "right_article_id", "contrast")
        after = after.join(contrast, ["story_id", "left_article_id", "right_article_id"], "left").withColumn("headline_contrast", F.coalesce("contrast", "headline_contrast")).drop("contrast")
        named = told.where("title is not null").select("story_id", F.col("title").alias("__title"))
        stories = stories.join(named, "story_id", "left").withColumns({"title_source": F.when(F.col("__title").isNotNull(), "llm").otherwise(F.col("title_source")), "title": F.coalesce("__title", "title")}).drop("__title")
    names = [f.split()[0] for f in PAIRS.split(", ")]
    return stories, _with(after, PAIRS).select(*names)


def recheck_stage(articles: DataFrame, stories: DataFrame, make: Callable[[], models.Verifier], now: Column, config: Config = Config(), most: int | None = None, publish: Callable[..., DataFrame] | None = None) -> dict[str, DataFrame]:
    """Suspect members asked about again: ``articles`` and ``stories`` after it, ``decisions``, the ``report``, and ``reanchored`` (story_id, before, after).

    Stories are re-anchored on their founder first.  Detached articles lose story, side and time, so the next pass files them; counters follow.
    """
    before, a = stories.withColumnRenamed("story_id", "id"), _with(articles, ASSIGNMENT)
    anchored = recheck.reanchored(before, a)
    asked = recheck.suspects(anchored, a, config, config.recheck_cap if most is None else most)
    answers = recheck.answered(asked, anchored, a, make)
    decisions = recheck.judged(asked, answers.where("error is null"), config)
    decisions = publish(decisions, "recheck_decisions", **recheck.counters()) if publish else decisions
    after = recheck.applied(a, decisions)
    touched = decisions.where("decision = 'detached'").select("story_id").distinct().withColumn("__touched", F.lit(True))
    counts = S.recount(after)
    names = ["article_count", "left_count", "right_count", "center_count"]
    rows = anchored.withColumnRenamed("id", "story_id").join(touched, "story_id", "left").join(counts.select("story_id", *[F.col(c).alias(f"__{c}") for c in names]), "story_id", "left")
    hit = F.col("__touched").isNotNull()
    rows = rows.withColumns({c: F.when(hit, F.coalesce(f"__{c}", F.lit(0)).cast("int")).otherwise(F.col(c)) for c in names} | {"updated_at": F.when(hit | F.col("changed"), now.cast("timestamp")).otherwise(F.col("updated_at"))})
    old = before.select(F.col("id").alias("story_id"), F.col("title").alias("before"))
    renamed = anchored.where("changed").select(F.col("id").alias("story_id"), F.col("title").alias("after")).join(old, "story_id").select("story_id", "before", "after")
    return {"articles": after, "stories": rows.select(*stories.columns), "decisions": decisions, "report": recheck.report(decisions, before, anchored, a), "reanchored": renamed}


def trimmed(articles: DataFrame, root: str, now: Column, config: Config = Config()) -> DataFrame:
    """The articles table of the run, without the bodies of old articles; if that fails, with them."""
    try:
        out, counted = tables.publish_counted(S.trim_bodies(articles, now, config), f"{root}/articles", bodies=F.count("body_text"))
        log.info("trimming: %s", counted)
        return out
    except Exception:  # noqa: BLE001  housekeeping: the next run does it
        log.exception("trimming failed")
        articles.write.mode("overwrite").parquet(f"{root}/articles")
        return articles.sparkSession.read.schema(articles.schema).parquet(f"{root}/articles")


def run(
    sources: DataFrame, feed: DataFrame, pages: DataFrame, root: str, now: Column, make: Callable[[], object] = models.OfflineModel, verifier: Callable | None = None, config: Config = Config(),
    previous: dict[str, DataFrame] | None = None, merger: Callable[[dict], dict] | None = None, titler: Callable[[], models.Titler] | None = None, registry: DataFrame | None = None,
) -> dict[str, DataFrame]:
    """All stages from the tables of an earlier run (``previous``: articles, stories, pairs) or from nothing; tables are published under ``root``.

    sources are those whose feeds were read; registry has all (the same if it is not given), since articles of other sources wait for their assignment too.
    verifier, merger and titler are the models for gray matches, merges and titles; without them strong matches attach, nothing merges and titles
    stay placeholders.  Returns articles, stories, pairs and feed.
    """
    spark = sources.sparkSession

    def publish(df: DataFrame, name: str, **counters: Column) -> DataFrame:
        out, counted = tables.publish_counted(df, f"{root}/{name}", **counters) if counters else (tables.publish(df, f"{root}/{name}"), None)
        if counted is not None:
            log.info("%s: %s", name, counted)
        return out

    old = previous or {}
    known = old["articles"].select("canonical_url") if old else spark.createDataFrame([], "canonical_url string")
    built = publish(ingest_stage(sources, feed, pages, known, now, config), "built")
    rows = new_rows(built, known, sources)
    table = old["articles"].unionByName(rows, allowMissingColumns=True) if old else rows
    enriched = publish(enrich.run(enrich.queue(table.select(*rows.columns), config=config), make, config), "enriched")
    table = publish(_with(replaced(table, enriched, "id"), ASSIGNMENT), "table")
    stories, current = old.get("stories"), old.get("pairs", spark.createDataFrame([], PAIRS))
    done = publish(assign_stage(table, stories, sources if registry is None else registry, now, verifier, config), "assigned", **assign.counters())
    articles = publish(assigned(table, done, now), "filed")
    stories = publish(stories_after(stories, done, now), "stories_open")
    if merger:
        try:
            merged, after, kept, stats = merge_stage(articles, stories, current, merger, now, config)
            articles, stories, current = publish(merged, "articles_merged"), publish(after, "stories_merged"), publish(kept, "pairs_kept")
            log.info("merging: %s", stats)
        except Exception:  # noqa: BLE001  housekeeping: the next run does it
            log.exception("merging failed")
    try:
        stories = publish(S.close_stale(stories, now, config), "stories_closed")
    except Exception:  # noqa: BLE001  housekeeping: the next run does it
        log.exception("closing stale stories failed")
    since = now.cast("timestamp") - F.make_dt_interval(hours=F.lit(config.pairs_lookback_hours))
    stories, current = pair_stage(articles, stories, current, since, titler, config, publish)
    stories, current = publish(stories, "stories"), publish(current, "pairs")
    articles = trimmed(articles, root, now, config)
    return {"articles": articles, "stories": stories, "pairs": current, "feed": publish(S.feed(stories, current, pair_members(articles)), "feed")}
