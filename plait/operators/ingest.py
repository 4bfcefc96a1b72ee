"""From feed entries and fetched pages to article rows: pruning, row building, de-duplication and backfills."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from ..config import Config
from ..functions import text as X, times as M
from ..functions.urls import canonical_url, url_hash
from ..sources import tables


def entries(feed: DataFrame) -> DataFrame:
    """Feed items as entries: link or first link, trimmed texts or null, first valid date, first image; without any link none."""
    blank = lambda c: F.nullif(F.trim(F.col(c)), F.lit(""))
    image_links = lambda c: F.filter(F.coalesce(F.col(c), F.array().cast(feed.schema[c].dataType)), lambda x: F.startswith(x["type"], F.lit("image/")) & (x["href"] != ""))
    urls = lambda c: F.filter(F.coalesce(F.col(c), F.array().cast("array<string>")), lambda x: x != "")
    image = F.coalesce(F.get(urls("media_content"), 0), F.get(urls("media_thumbnail"), 0), F.get(image_links("links"), 0)["href"], F.get(image_links("enclosures"), 0)["href"])
    out = feed.select(
        "source_id", "pos", F.coalesce(blank("link"), F.get(F.col("links"), 0)["href"]).alias("link"), blank("title").alias("title"), blank("summary").alias("summary"),
        F.coalesce(M.parse_datetime(F.col("published")), M.parse_datetime(F.col("updated"))).alias("published_at"), image.alias("image_url"), blank("author").alias("author"),
    )
    return out.where("link is not null and link <> ''")


def prune(rows: DataFrame, sources: DataFrame, known: DataFrame, now: Column, config: Config = Config()) -> DataFrame:
    """Entries worth a page request: fresh, articles by title, the first ``max_per_run`` of a source, then one for each canonical
    link in feed order, then only links that are not known.  The limit comes before the comparison with what is known."""
    live = rows.where(M.fresh(F.col("published_at"), now, config.feed_max_age_hours) & ~X.is_non_article(X.clean_text(F.col("title"))))
    limited = tables.head_limit(live.join(sources.select(F.col("id").alias("source_id"), "max_per_run"), "source_id"), ["source_id"], [F.col("pos")], F.coalesce("max_per_run", F.lit(config.max_per_run))).drop("max_per_run")
    canon = limited.withColumn("canonical_url", canonical_url(F.col("link")))
    return tables.only_new(tables.first_wins(canon, ["source_id", "canonical_url"], [F.col("pos")]), known, "canonical_url")


def build_rows(fetched: DataFrame, now: Column, config: Config = Config()) -> DataFrame:
    """Article rows with an ``outcome`` (row, failed, stale, non_article) from entries joined with their extracted pages.

    fetched: source_id, outlet, pos, link (final), entry (title, summary, published_at, image_url, author), page (title, description, text,
    image, authors, published_at, section, wire_hint, jsonld_type), html_bytes.
    """
    published, source = M.guarded_date(F.col("page.published_at"), F.col("entry.published_at"), now, config.feed_max_age_hours)
    page_title, feed_title = X.clean_text(F.col("page.title")), X.clean_text(F.col("entry.title"))
    base = fetched.select("*", published.alias("published_at"), source.alias("date_source"), F.coalesce(page_title, feed_title).alias("full_title"), feed_title.alias("feed_title"), F.coalesce("page.text", F.lit("")).alias("text"))
    outcome = F.when(F.col("published_at").isNull(), "failed").when(F.col("date_source") == "stale", "stale").when(F.col("full_title").isNull(), "failed").when(X.is_non_article(F.col("full_title")), "non_article").otherwise("row")
    canonical = canonical_url(F.col("link"))
    nothing = F.array().cast("array<string>")
    authors = F.when(F.size(F.coalesce("page.authors", nothing)) > 0, F.col("page.authors")).when(F.col("entry.author").isNotNull(), F.array("entry.author")).otherwise(nothing)
    evidence = F.struct(
        F.col("page.section").alias("section"), F.col("page.wire_hint").alias("wire_hint"), F.col("page.jsonld_type").alias("jsonld_type"), "html_bytes",
        F.col("entry.published_at").alias("feed_published_at"), F.col("page.published_at").alias("page_published_at"), "date_source",
    )
    return base.select(
        outcome.alias("outcome"), "source_id", "outlet", "pos", F.col("link").alias("url"), canonical.alias("canonical_url"), url_hash(canonical).alias("url_hash"),
        F.substring("full_title", 1, 500).alias("title"), F.when(F.col("feed_title") != F.col("full_title"), F.substring("feed_title", 1, 500)).alias("headline"),
        X.clean_text(F.coalesce(F.nullif("page.description", F.lit("")), "entry.summary")).alias("subheadline"), F.nullif(F.substring("text", 1, 20000), F.lit("")).alias("body_text"), F.length("text").alias("body_chars"),
        X.clean_text(F.coalesce(X.snippet("text"), X.snippet("entry.summary"))).alias("snippet"), F.coalesce(F.nullif("page.image", F.lit("")), "entry.image_url").alias("image_url"),
        authors.alias("authors"), "published_at", F.when(F.length("text") >= config.min_body_chars, "pending").otherwise("skipped").alias("enrichment_status"),
        evidence.alias("evidence"), F.coalesce("page.wire_hint", F.lit(False)).alias("is_wire_copy"),
    )


def built_first(built: DataFrame, known: DataFrame, sources: DataFrame) -> DataFrame:
    """The built rows whose canonical URL is new.  Links that redirects made equal count once: the one of the source listed first
    (``position``), then of the earlier entry; a link that a redirect made a known one does not count."""
    rows = built.where("outcome = 'row'").join(sources.select(F.col("id").alias("source_id"), F.col("position").alias("__position")), "source_id", "left")
    first = tables.first_wins(rows, ["canonical_url"], [F.col("__position"), F.col("source_id"), F.col("pos")])
    return tables.only_new(first, known, "canonical_url").drop("__position")


def new_articles(built: DataFrame, table: DataFrame, sources: DataFrame) -> DataFrame:
    """The table with the built rows that are new."""
    return table.unionByName(built_first(built, table, sources).select(*table.columns))


def stats(built: DataFrame) -> DataFrame:
    """Per source what became of its pages: one aggregate."""
    return built.groupBy("source_id").agg(
        F.count(F.lit(1)).alias("fetched"), F.count_if(F.col("outcome") == "row").alias("rows"), F.count_if(F.col("outcome") == "failed").alias("failed"), F.count_if(F.col("outcome") == "stale").alias("stale"),
        F.count_if(F.col("outcome") == "non_article").alias("non_article"), F.count_if((F.col("outcome") == "row") & (F.col("evidence.date_source") == "feed_override")).alias("date_override"),
        F.count_if((F.col("outcome") == "row") & (F.col("enrichment_status") == "skipped")).alias("skipped_short"),
    )


def changed_text(rows: DataFrame, id_col: str, columns: list[str], native: bool = False) -> DataFrame:
    """Rows of which a column with an ampersand has a different, non-empty cleaned value: the id and the columns, null where unchanged."""
    clean = (lambda c: X.clean_plain(F.replace(F.col(c), F.lit("&amp;"), F.lit("&")))) if native else (lambda c: X.clean_text(F.col(c)))
    delta = rows.select(id_col, *[F.when(F.col(c).contains("&") & (clean(c) != F.col(c)), clean(c)).alias(c) for c in columns])
    return delta.where(F.coalesce(*columns).isNotNull())
