"""Reports: status, feed audit, registry health and the quality of attachment decisions."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from ..functions.urls import canonical_url
from ..sources import pages
from . import ingest


def status(articles: DataFrame, stories: DataFrame, pairs: DataFrame) -> DataFrame:
    """One row a measure: articles altogether and by enrichment status, unassigned ones, open and two-sided stories, current pairs.  Each table is scanned once: the
    articles' total, which also counts the unassigned, is a grouping set beside their status."""
    waits = (F.col("enrichment_status") == "done") & F.col("story_id").isNull() & F.col("assigned_at").isNull()
    sets = articles.select("enrichment_status", waits.alias("waits")).groupingSets([["enrichment_status"], []], "enrichment_status").agg(F.grouping_id().alias("all"), F.count(F.lit(1)).alias("n"), F.count_if("waits").alias("waits"))
    told = lambda name, n: F.struct((F.lit(name) if isinstance(name, str) else name).alias("measure"), n.cast("long").alias("n"))
    by = F.when(F.col("all") == 1, F.array(told("articles_total", F.col("n")), told("unassigned", F.col("waits")))).otherwise(F.array(told(F.concat(F.lit("articles_"), F.coalesce("enrichment_status", F.lit("none"))), F.col("n"))))
    none = articles.sparkSession.createDataFrame([("articles_total", 0), ("unassigned", 0)], "measure string, n long")  # of an empty table there are no sets
    counted = sets.select(F.inline(by)).unionByName(none).groupBy("measure").agg(F.sum("n").alias("n"))
    is_open = F.col("status") == "open"
    two = stories.agg(F.count_if(is_open).alias("open_stories"), F.count_if(is_open & (F.col("left_count") >= 1) & (F.col("right_count") >= 1)).alias("two_sided"))
    two = two.select(F.inline(F.array(told("open_stories", F.col("open_stories")), told("two_sided", F.col("two_sided")))))
    return counted.unionByName(two).unionByName(pairs.agg(F.count_if("is_current").alias("n")).select(F.lit("current_pairs").alias("measure"), "n"))


def upper_median(values: Column) -> Column:
    """The element at half the length of the sorted values."""
    ordered = F.array_sort(values)
    return F.get(ordered, F.floor(F.size(ordered) / 2).cast("int"))


def feed_audit(entries: DataFrame, now: Column, sample: int = 3, hours: int = 72) -> DataFrame:
    """Per source: entries, fresh ones, entries a day, and of the first ``sample`` what their pages gave.

    entries: source_id, pos, published_at, link, image_url, and of the sampled ones final_url, body_chars, page_image, page_date,
    wire_hint.  Only sampled rows hold a list, so the median's array has ``sample`` elements at most.
    """
    rows = entries.withColumn("s", F.row_number().over(Window.partitionBy("source_id").orderBy("pos")) <= sample)
    took = F.col("s") & F.col("body_chars").isNotNull()
    fresh = F.col("published_at").isNull() | (F.col("published_at") >= now - F.make_dt_interval(hours=F.lit(hours)))
    at = F.unix_micros(F.col("published_at").cast("timestamp"))
    out = rows.groupBy("source_id").agg(
        F.count(F.lit(1)).alias("entries"), F.count_if(fresh).alias("fresh"), F.count("published_at").alias("dated"), ((F.max(at) - F.min(at)) / 8.64e10).alias("span"),
        F.count_if(F.col("s")).alias("sampled"), F.count_if(took & (F.col("body_chars") >= 500)).alias("body_ok"),
        F.count_if(took & (F.coalesce("page_image", "image_url", F.lit("")) != "")).alias("image_ok"), F.count_if(took & F.coalesce("page_date", "published_at").isNotNull()).alias("date_ok"),
        F.count_if(took & F.coalesce("wire_hint", F.lit(False))).alias("wire"), F.count_if(took & (canonical_url(F.col("final_url")) != canonical_url(F.col("link")))).alias("redirected"),
        F.coalesce(upper_median(F.collect_list(F.when(took, F.col("body_chars")))), F.lit(0)).alias("median_chars"),
    )
    per_day = F.when(F.col("dated") >= 2, F.round(F.col("dated") / F.greatest(F.col("span"), F.lit(1.0) / 24), 1))
    return out.withColumn("per_day", per_day).withColumn("status", _audit_status()).drop("dated", "span")


def _audit_status() -> Column:
    return F.when((F.col("sampled") > 0) & (F.col("body_ok") == 0), "NO_BODY").when(F.col("entries") == 0, "EMPTY").otherwise("ok")


def first_entries(feed: DataFrame, sample: int = 3) -> DataFrame:
    """The entries of feeds that could be read, and of which the first ones are to be sampled (``sampled``)."""
    rows = ingest.entries(feed.where("error is null"))
    return rows.withColumn("sampled", F.row_number().over(Window.partitionBy("source_id").orderBy("pos")) <= sample)


def audit(sources: DataFrame, feed: DataFrame, fetched: DataFrame, now: Column, sample: int = 3, hours: int = 72) -> DataFrame:
    """One row a listed source: id, outlet, leaning, feed_url, used_url, status, error and the counts of ``feed_audit``.

    feed: items and errors of the feeds; fetched: (link, final_url, html, error) of the first entries' links.  A feed that could not be read is FEED_FAIL; a feed
    that an alternate URL gave and pages that could not be had or parsed are told in ``error``.
    """
    rows = first_entries(feed, sample)
    page = pages.extract_pages(fetched.where("error is null"), "link").select(
        "link", F.when(F.col("error").isNull(), F.length(F.coalesce("text", F.lit("")))).alias("body_chars"), F.col("image").alias("page_image"), F.col("published_at").alias("page_date"), "wire_hint", F.col("error").alias("page_error"))
    page = fetched.select("link", "final_url", F.col("error").alias("fetch_error")).join(page, "link", "left").withColumn("page_error", F.coalesce("fetch_error", "page_error")).drop("fetch_error")
    seen = rows.join(page, "link", "left")
    lost = F.transform(F.sort_array(F.collect_list(F.when(F.col("sampled"), F.struct("pos", "page_error")))), lambda x: F.concat(F.lit(" page: "), F.right(x["page_error"], F.lit(60))))
    told = seen.groupBy("source_id").agg(F.array_join(F.filter(lost, lambda x: x.isNotNull()), "").alias("pages_lost"))
    of_feed = feed.groupBy("source_id").agg(F.min("error").alias("feed_error"), F.min("used_url").alias("used_url"))
    counts = feed_audit(seen.drop("sampled"), now, sample, hours).drop("status")
    out = sources.select(F.col("id").alias("source_id"), "outlet", "leaning", "feed_url", "position").join(of_feed, "source_id", "left").join(counts, "source_id", "left").join(told, "source_id", "left")
    numbers = ("entries", "fresh", "sampled", "body_ok", "image_ok", "date_ok", "wire", "redirected", "median_chars")
    out = out.withColumns({c: F.coalesce(c, F.lit(0)) for c in numbers})
    other = F.when(F.col("used_url") != F.col("feed_url"), F.concat(F.lit("WORKED VIA ALT URL "), "used_url")).otherwise("")
    error = F.nullif(F.concat(other, F.coalesce("pages_lost", F.lit(""))), F.lit(""))
    return out.select(
        "source_id", "outlet", "leaning", "feed_url", "used_url", F.when(F.col("feed_error").isNotNull(), "FEED_FAIL").otherwise(_audit_status()).alias("status"), *numbers, "per_day",
        F.when(F.col("feed_error").isNotNull(), F.substring("feed_error", 1, 300)).otherwise(error).alias("error"), "position")


def audit_markdown(rows: list[dict], stamp: str = "") -> str:
    """The audit as a Markdown report; rows are one a feed, so a handful."""
    columns = ("source_id", "outlet", "leaning", "status", "entries", "fresh", "per_day", "body_ok", "image_ok", "date_ok", "wire", "redirected", "median_chars", "error")
    shares = ("body_ok", "image_ok", "date_ok", "wire", "redirected")
    cell = lambda r, c: (r.get(c) or "")[:160] if c == "error" else "-" if r.get(c) is None else f"{r[c]}/{r['sampled']}" if c in shares else str(r[c])
    lines = [f"# Audit of the feeds {stamp}".rstrip(), "", "Sampled are the first 3 entries of each feed.", "", "| " + " | ".join(columns) + " |", "|" + "---|" * len(columns)]
    lines += ["| " + " | ".join(cell(r, c).replace("|", "\\|").replace("\n", " ") for c in columns) + " |" for r in rows]
    passed = sum(r["status"] == "ok" for r in rows)
    return "\n".join([*lines, "", f"{passed} of {len(rows)} feeds pass."])


def attach_quality(judged: DataFrame) -> DataFrame:
    """Precision, recall and counts by kind from rows (kind, expected, predicted)."""
    yes, said = F.col("expected"), F.col("predicted")
    rows = judged.groupBy("kind").agg(F.count_if(yes & said).alias("tp"), F.count_if(~yes & said).alias("fp"), F.count_if(yes & ~said).alias("fn"), F.count_if(~yes & ~said).alias("tn"))
    part = lambda a, b: F.round(F.col(a) / F.nullif(F.col(a) + F.col(b), F.lit(0)), 6)
    return rows.withColumn("precision", part("tp", "fp")).withColumn("recall", part("tp", "fn"))
