"""Registered queries of scalar functions, filters and table writes."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..config import Config
from ..functions import scoring as S, text as X, times as M, vectors as V
from ..functions.predicates import scan
from ..functions.urls import TRACKING_NAMES, TRACKING_PREFIXES, canonical_url, url_hash
from ..operators import enrich, ingest, models
from ..sources import pages as P, registry as R, tables as T
from .proxies import articles, ntz, sql, table

QUERIES, SQL = {}, {}


def query(text: str | None = None):
    def add(f):
        QUERIES[f.__name__] = f
        if text:
            SQL[f.__name__] = text
        return f

    return add


_NAMES = ", ".join(f"'{n}'" for n in TRACKING_NAMES)
_PREFIXED = " OR ".join(f"starts_with(lower(split_part(p, '=', 1)), '{x}')" for x in TRACKING_PREFIXES)
CANON_SQL = f"""parts AS (
  SELECT *, lower(regexp_extract(trim(url), '^(?:[A-Za-z][A-Za-z0-9+.-]*:)?(?://([^/?#]*))?', 1)) AS h,
    regexp_extract(trim(url), '^(?:[A-Za-z][A-Za-z0-9+.-]*:)?(?://[^/?#]*)?([^?#]*)', 1) AS p0, regexp_extract(trim(url), '^[^?#]*\\?([^#]*)', 1) AS q FROM pages),
tidy AS (
  SELECT *, regexp_replace(regexp_replace(h, '^www\\.', ''), '^amp\\.', '') AS host,
    regexp_replace(regexp_replace(CASE WHEN p0 = '' THEN '/' ELSE p0 END, '/amp/?$', '/'), '/{{2,}}', '/', 'g') AS p1,
    list_sort(list_filter(string_split(q, '&'), lambda p: split_part(p, '=', 2) <> '' AND NOT (lower(split_part(p, '=', 1)) IN ({_NAMES}) OR {_PREFIXED}))) AS params FROM parts),
canon AS (
  SELECT page_id, url, 'https://' || host || CASE WHEN length(p1) > 1 AND ends_with(p1, '/') THEN left(p1, -1) ELSE p1 END
    || CASE WHEN len(params) > 0 THEN '?' || array_to_string(params, '&') ELSE '' END AS canonical_url FROM tidy)"""


def _canon(spark, d):
    return table(spark, d, "pages").select("page_id", "url", canonical_url(F.col("url")).alias("canonical_url"))


@query(f"WITH {CANON_SQL} SELECT page_id, canonical_url, sha1(canonical_url) AS url_hash FROM canon")
def url_canonical(spark, d):
    return _canon(spark, d).select("page_id", "canonical_url", url_hash(F.col("canonical_url")).alias("url_hash"))


@query(f"WITH {CANON_SQL} SELECT canonical_url, min(page_id) AS page_id FROM canon GROUP BY canonical_url")
def url_dedup_first(spark, d):
    return T.first_wins(_canon(spark, d), ["canonical_url"], [F.col("page_id")]).select("canonical_url", "page_id")


@query(f"WITH {CANON_SQL} SELECT page_id, canonical_url FROM canon WHERE page_id % 3 <> 0 AND canonical_url NOT IN (SELECT canonical_url FROM canon WHERE page_id % 3 = 0)")
def new_links_anti(spark, d):
    rows = _canon(spark, d)
    return T.only_new(rows.where("page_id % 3 <> 0"), rows.where("page_id % 3 = 0"), "canonical_url").select("page_id", "canonical_url")


@query(
    f"WITH {CANON_SQL}, have AS (SELECT min(page_id) AS page_id, canonical_url FROM canon WHERE page_id % 4 = 0 GROUP BY canonical_url), "
    "new AS (SELECT min(page_id) AS page_id, canonical_url FROM canon WHERE page_id % 4 <> 0 GROUP BY canonical_url) "
    "SELECT * FROM have UNION ALL SELECT * FROM new WHERE canonical_url NOT IN (SELECT canonical_url FROM have)"
)
def insert_ignore(spark, d):
    rows = _canon(spark, d).select("page_id", "canonical_url")
    have = T.first_wins(rows.where("page_id % 4 = 0"), ["canonical_url"], [F.col("page_id")])
    return T.insert_ignore(have, rows.where("page_id % 4 <> 0"), "canonical_url", [F.col("page_id")])


@query(
    "WITH new AS (SELECT doc_id, upper(source) AS source, length(text) AS n FROM documents WHERE doc_id % 5 = 0 UNION ALL SELECT doc_id + 10000000, source, 0 FROM documents WHERE doc_id % 50 = 0) "
    "SELECT doc_id, source, n_chars FROM documents WHERE doc_id NOT IN (SELECT doc_id FROM new) UNION ALL SELECT doc_id, source, n FROM new"
)
def upsert_merge(spark, d):
    docs = table(spark, d, "documents").select("doc_id", "text", "source", "n_chars")
    new = docs.where("doc_id % 5 = 0").select("doc_id", F.upper("source").alias("source"), F.length("text").cast("long").alias("n_chars"))
    more = docs.where("doc_id % 50 = 0").select((F.col("doc_id") + 10000000).alias("doc_id"), "source", F.lit(0).cast("long").alias("n_chars"))
    return T.upsert(docs.drop("text"), new.unionByName(more), ["doc_id"])


@query("SELECT d.doc_id, CASE WHEN l.doc_id IS NOT NULL THEN (CASE WHEN l.toxic = 0 THEN 'q' || l.quality END) ELSE d.lang END AS lang, d.source FROM documents d LEFT JOIN labels l USING (doc_id)")
def patch_rows(spark, d):
    delta = table(spark, d, "labels").select("doc_id", F.when(F.col("toxic") == 0, F.concat(F.lit("q"), "quality")).alias("lang"))
    return T.patch(table(spark, d, "documents").select("doc_id", "lang", "source"), delta, "doc_id", ["lang"])


@query("SELECT doc_id, source FROM documents WHERE doc_id IN (SELECT doc_id FROM labels WHERE toxic = 1)")
def in_list_scan(spark, d):
    return T.having(table(spark, d, "documents").select("doc_id", "source"), table(spark, d, "labels").where("toxic = 1"), "doc_id")


@query("SELECT doc_id, source FROM documents WHERE doc_id > 37 ORDER BY doc_id LIMIT 500")
def keyset_page(spark, d):
    return T.page_after(table(spark, d, "documents").select("doc_id", "source"), "doc_id", 37, 500)


@query(
    "WITH h AS (SELECT source, doc_id, md5(text) AS key, row_number() OVER (PARTITION BY source ORDER BY doc_id) AS n FROM documents), "
    "f AS (SELECT *, row_number() OVER (PARTITION BY source, key ORDER BY doc_id) AS k FROM h WHERE n <= 40) SELECT source, doc_id, key FROM f WHERE k = 1"
)
def head_limit_then_dedup(spark, d):
    rows = table(spark, d, "documents").select("source", "doc_id", F.md5(F.col("text").cast("binary")).alias("key"))
    return T.first_wins(T.head_limit(rows, ["source"], [F.col("doc_id")], 40), ["source", "key"], [F.col("doc_id")])


@query("SELECT event_id, ts, value FROM events WHERE event_type IN ('view', 'click') AND value >= 20 AND user_id > 5 AND json_extract_string(props, '$.k') = '26' AND ts IS NOT NULL ORDER BY ts DESC, event_id LIMIT 200 OFFSET 3")
def table_scan(spark, d):
    filters = {"event_type": "in.(view,click)", "value": "gte.20", "user_id": "gt.5", "props->>k": "eq.26", "ts": "not.is.null"}
    return scan(table(spark, d, "events"), "event_id, ts, value", "ts.desc,event_id.asc", 200, 3, **filters)


_STAMPS = "SELECT event_id, CASE WHEN event_id % 13 <> 0 THEN ts END AS page, CASE WHEN event_id % 7 <> 0 THEN ts + to_minutes(CAST(floor(value * 60) AS BIGINT)) END AS feed FROM events"


def _stamps(spark, d):
    return table(spark, d, "events").selectExpr("event_id", "case when event_id % 13 <> 0 then ts end as page", "case when event_id % 7 <> 0 then timestampadd(MINUTE, cast(floor(value * 60) as int), ts) end as feed")


@query(f"WITH s AS ({_STAMPS}) SELECT event_id FROM s WHERE page IS NULL OR page >= TIMESTAMP '2024-01-31 00:00:00' - INTERVAL 72 HOUR")
def freshness_filter(spark, d):
    return _stamps(spark, d).where(M.fresh(F.col("page"), ntz("2024-01-31 00:00:00"), 72)).select("event_id")


@query(
    f"WITH s AS ({_STAMPS}), t AS (SELECT *, TIMESTAMP '2024-01-31 00:00:00' - INTERVAL 72 HOUR AS cut, greatest(page, feed) AS newest, coalesce(page, feed) AS chosen FROM s) "
    "SELECT event_id, CASE WHEN newest < cut OR (chosen < cut AND newest >= cut) THEN newest ELSE chosen END AS published_at, "
    "CASE WHEN newest IS NULL THEN NULL WHEN newest < cut THEN 'stale' WHEN chosen < cut THEN 'feed_override' WHEN page IS NOT NULL THEN 'page' ELSE 'feed' END AS date_source FROM t"
)
def stale_guard(spark, d):
    published, source = M.guarded_date(F.col("page"), F.col("feed"), ntz("2024-01-31 00:00:00"), 72)
    return _stamps(spark, d).select("event_id", published.alias("published_at"), source.alias("date_source"))


_FETCHED_SQL = """f AS (
  SELECT doc_id, source, text, CASE doc_id % 9 WHEN 0 THEN NULL WHEN 1 THEN '  ' WHEN 2 THEN 'Transcript: talk ' || doc_id WHEN 3 THEN repeat('Long title ', 60) || doc_id ELSE ' Page  title ' || doc_id END AS page_title,
    CASE WHEN doc_id % 4 > 0 THEN 'Feed title ' || doc_id END AS feed_title, CASE WHEN doc_id % 5 > 0 THEN TIMESTAMP '2024-01-01 00:00:00' + to_hours(CAST((doc_id * 7) % 700 AS BIGINT)) END AS page_at,
    CASE WHEN doc_id % 3 > 0 THEN TIMESTAMP '2024-01-01 00:00:00' + to_hours(CAST((doc_id * 11) % 740 AS BIGINT)) END AS feed_at FROM documents),
g AS (
  SELECT *, nullif(trim(regexp_replace(page_title, '\\s+', ' ', 'g')), '') AS pt, TIMESTAMP '2024-01-31 00:00:00' - INTERVAL 72 HOUR AS cut, greatest(page_at, feed_at) AS newest, coalesce(page_at, feed_at) AS chosen FROM f),
r AS (SELECT *, coalesce(pt, feed_title) AS title, CASE WHEN newest < cut OR (chosen < cut AND newest >= cut) THEN newest ELSE chosen END AS published_at FROM g)"""


@query(
    f"""WITH {_FETCHED_SQL}
SELECT doc_id, CASE WHEN published_at IS NULL THEN 'failed' WHEN newest < cut THEN 'stale' WHEN title IS NULL THEN 'failed' WHEN starts_with(title, 'Transcript:') THEN 'non_article' ELSE 'row' END AS outcome,
  left(title, 500) AS title, CASE WHEN feed_title <> title THEN feed_title END AS headline, nullif(substr(text, 1, 20000), '') AS body_text, length(text)::INT AS body_chars, CASE WHEN length(text) >= 300 THEN 'pending' ELSE 'skipped' END AS enrichment_status,
  published_at, 'about ' || CASE WHEN doc_id % 2 = 0 THEN doc_id ELSE -doc_id END AS subheadline, CASE WHEN doc_id % 2 = 0 THEN ['Ann', 'Bo'] WHEN doc_id % 3 = 0 THEN ['Cy'] ELSE [] END AS authors, 'https://w.example/a/' || doc_id AS canonical_url FROM r"""
)
def row_build_status(spark, d):
    out = ingest.build_rows(_fetched(spark, d), ntz("2024-01-31 00:00:00"))
    return out.select(F.col("pos").alias("doc_id"), "outcome", "title", "headline", "body_text", "body_chars", "enrichment_status", F.col("published_at").cast("timestamp_ntz").alias("published_at"), "subheadline", "authors", "canonical_url")


def _fetched(spark, d):
    """Documents as fetched pages with their feed entries, some without titles or dates."""
    docs = table(spark, d, "documents")
    title = F.expr("case doc_id % 9 when 0 then null when 1 then '  ' when 2 then concat('Transcript: talk ', doc_id) when 3 then concat(repeat('Long title ', 60), doc_id) else concat(' Page  title ', doc_id) end")
    at = lambda by, n, span: F.expr(f"case when doc_id % {by} > 0 then cast(timestampadd(HOUR, cast((doc_id * {n}) % {span} as int), timestamp_ntz'2024-01-01 00:00:00') as timestamp) end")
    even, none = F.col("doc_id") % 2 == 0, F.lit(None).cast("string")
    page = F.struct(
        title.alias("title"), F.when(even, F.concat(F.lit("about "), "doc_id")).alias("description"), F.col("text"), none.alias("image"), F.when(even, F.array(F.lit("Ann"), F.lit("Bo"))).otherwise(F.array().cast("array<string>")).alias("authors"),
        at(5, 7, 700).alias("published_at"), none.alias("section"), F.lit(False).alias("wire_hint"), none.alias("jsonld_type"),
    )
    entry = F.struct(
        F.when(F.col("doc_id") % 4 > 0, F.concat(F.lit("Feed title "), "doc_id")).alias("title"), F.concat(F.lit("about "), -F.col("doc_id")).alias("summary"), at(3, 11, 740).alias("published_at"), none.alias("image_url"),
        F.when(F.col("doc_id") % 3 == 0, "Cy").alias("author"),
    )
    return docs.select("doc_id", F.col("source").alias("source_id"), F.col("source").alias("outlet"), F.col("doc_id").alias("pos"), F.concat(F.lit("http://www.w.example/a/"), "doc_id", F.lit("?utm_source=x")).alias("link"), entry.alias("entry"), page.alias("page"), F.lit(0).cast("long").alias("html_bytes"))


@query(
    f"""WITH {_FETCHED_SQL},
o AS (
  SELECT source, text, CASE WHEN published_at IS NULL THEN 'failed' WHEN newest < cut THEN 'stale' WHEN title IS NULL THEN 'failed' WHEN starts_with(title, 'Transcript:') THEN 'non_article' ELSE 'row' END AS outcome, chosen < cut AND newest >= cut AS overridden FROM r)
SELECT source AS source_id, count(*) AS fetched, count(*) FILTER (outcome = 'row') AS "rows", count(*) FILTER (outcome = 'failed') AS failed, count(*) FILTER (outcome = 'stale') AS stale, count(*) FILTER (outcome = 'non_article') AS non_article,
  count(*) FILTER (outcome = 'row' AND overridden) AS date_override, count(*) FILTER (outcome = 'row' AND length(text) < 300) AS skipped_short FROM o GROUP BY source"""
)
def ingest_stats(spark, d):
    return ingest.stats(ingest.build_rows(_fetched(spark, d), ntz("2024-01-31 00:00:00")))


@query(
    """WITH e AS (
  SELECT doc_id, source, 'https://p.example/' || (doc_id % 400) AS canonical_url, CASE WHEN doc_id % 6 > 0 THEN TIMESTAMP '2024-01-01 00:00:00' + to_hours(CAST((doc_id * 7) % 700 AS BIGINT)) END AS seen FROM documents),
live AS (SELECT * FROM e WHERE (seen IS NULL OR seen >= TIMESTAMP '2024-01-20 00:00:00' - INTERVAL 72 HOUR) AND doc_id % 10 <> 0),
cut AS (SELECT * FROM live QUALIFY row_number() OVER (PARTITION BY source ORDER BY doc_id) <= 5 + CAST(regexp_extract(source, '[0-9]+') AS INT) % 3 * 5),
one AS (SELECT * FROM cut QUALIFY row_number() OVER (PARTITION BY source, canonical_url ORDER BY doc_id) = 1)
SELECT doc_id AS pos, source AS source_id, canonical_url FROM one WHERE canonical_url NOT IN (SELECT canonical_url FROM e WHERE doc_id < 60)"""
)
def entry_prune(spark, d):
    docs = table(spark, d, "documents")
    at = F.expr("case when doc_id % 6 > 0 then timestampadd(HOUR, cast((doc_id * 7) % 700 as int), timestamp_ntz'2024-01-01 00:00:00') end")
    url = F.concat(F.lit("http://www.p.example/"), F.col("doc_id") % 400)
    rows = docs.select(F.col("source").alias("source_id"), F.col("doc_id").alias("pos"), F.concat(url, F.lit("?utm_medium=x")).alias("link"), F.when(F.col("doc_id") % 10 == 0, "Transcript &amp; more").otherwise("A title").alias("title"), at.alias("published_at"))
    sources = docs.select("source").distinct().select(F.col("source").alias("id"), (5 + F.regexp_extract("source", "[0-9]+", 0).cast("int") % 3 * 5).alias("max_per_run"))
    known = docs.where("doc_id < 60").select(canonical_url(url).alias("canonical_url"))
    return ingest.prune(rows, sources, known, ntz("2024-01-20 00:00:00")).select("pos", "source_id", "canonical_url")


@query(sql("SELECT id, coalesce(event_summary, '') || ' | Entities: ' || array_to_string(key_entities, ', ') AS t FROM articles_px"))
def embedding_texts(spark, d):
    return articles(spark, d).select("id", models.embedding_text(F.col("event_summary"), F.col("key_entities")).alias("t"))


@query(sql("SELECT id, list_transform(vector, lambda x: round(x, 6)) AS vector FROM articles_px"))
def vector_from_text(spark, d):
    text = F.concat(F.lit("["), F.array_join(F.transform("vector", lambda x: x.cast("string")), ","), F.lit("]"))
    return articles(spark, d).select("id", F.transform(V.from_text(text), lambda x: V.signed(x, F.round(x, 6))).alias("vector"))


@query("SELECT doc_id, (row_number() OVER (ORDER BY doc_id) - 1) // 70 AS page FROM documents WHERE source IN ('src1', 'src2', 'src3')")
def keyset_pages(spark, d):
    """Every page of a keyset scan over a few sources, one after the other."""
    rows = table(spark, d, "documents").where("source in ('src1', 'src2', 'src3')").select("doc_id")
    return T.paged(rows, "doc_id", 70)


@query("SELECT (SELECT count(*) FROM documents) AS every, (SELECT count(*) FROM documents WHERE lang = 'en') AS english, (SELECT count(*) FROM labels WHERE toxic = 1) AS toxic")
def exact_counts(spark, d):
    docs, labels = table(spark, d, "documents"), table(spark, d, "labels")
    return spark.createDataFrame([(T.count_rows(docs), T.count_rows(docs, F.col("lang") == "en"), T.count_rows(labels, F.col("toxic") == 1))], "every long, english long, toxic long")


@query("SELECT page_id, 'https://x.example/p?q=' || page_id || '%25%25&r=a+b%2Fc&t=%C3%A9%25zz&u=%25' AS canonical_url FROM pages")
def url_escapes(spark, d):
    raw = F.concat(F.lit("http://www.X.example//p/?u=%&r=a+b%2Fc&q="), "page_id", F.lit("%25%&t=%C3%A9%zz&utm_x=1&blank=#top"))
    return table(spark, d, "pages").select("page_id", canonical_url(raw).alias("canonical_url"))


@query(
    """SELECT page_id, CASE WHEN page_id % 4 = 0 THEN url || '?alt' ELSE url END AS link, CASE WHEN page_id % 3 > 0 THEN 'Title ' || page_id END AS title,
  CAST(epoch(CASE WHEN page_id % 5 = 0 THEN TIMESTAMP '2024-01-03 04:05:06' WHEN page_id % 5 < 4 THEN TIMESTAMP '2024-01-02 03:04:05' END) AS BIGINT) AS published,
  CASE WHEN page_id % 6 = 0 THEN 'm' WHEN page_id % 6 = 1 THEN 't' WHEN page_id % 6 = 2 THEN 'l' WHEN page_id % 6 = 3 THEN 'e' END AS image_url FROM pages WHERE page_id % 8 <> 4"""
)
def entry_normalise(spark, d):
    image = lambda n, url: F.when(F.col("page_id") % 6 <= n, F.array(F.lit(""), F.lit(url))).otherwise(F.array().cast("array<string>"))
    link = lambda *given: F.array(*[F.struct(F.lit(h).alias("href") if isinstance(h, str) else h.alias("href"), F.lit(kind).alias("type")) for h, kind in given])
    feed = table(spark, d, "pages").select(
        F.lit("s").alias("source_id"), F.col("page_id").alias("pos"), F.when(F.col("page_id") % 4 == 0, "  ").otherwise(F.concat(F.lit(" "), "url")).alias("link"),
        F.when(F.col("page_id") % 8 == 4, link(("", "text/html"))).otherwise(F.when(F.col("page_id") % 6 <= 2, link((F.concat("url", F.lit("?alt")), "text/html"), ("l", "image/png"))).otherwise(link((F.concat("url", F.lit("?alt")), "text/html")))).alias("links"),
        F.when(F.col("page_id") % 3 > 0, F.concat(F.lit(" Title "), "page_id", F.lit(" "))).otherwise(" ").alias("title"), F.lit("sum").alias("summary"),
        F.when(F.col("page_id") % 5 == 0, "soon").when(F.col("page_id") % 5 < 4, "Tue, 02 Jan 2024 03:04:05 GMT").alias("published"), F.when(F.col("page_id") % 5 == 0, "2024-01-03T04:05:06Z").alias("updated"),
        image(0, "m").alias("media_content"), image(1, "t").alias("media_thumbnail"), F.when(F.col("page_id") % 6 <= 3, link(("p", "audio/mp3"), ("e", "image/jpeg"))).otherwise(link(("p", "audio/mp3"))).alias("enclosures"), F.lit("Ann").alias("author"),
    )
    return ingest.entries(feed).select(F.col("pos").alias("page_id"), "link", "title", F.unix_seconds("published_at").alias("published"), "image_url")


@query(
    """WITH r AS (SELECT page_id, 'https://r.example/' || (page_id % 40) AS canonical_url, page_id % 7 AS position FROM pages WHERE page_id % 5 > 0),
old AS (SELECT DISTINCT canonical_url FROM r WHERE page_id % 40 < 4)
SELECT arg_min(page_id, (position, page_id)) AS pos, canonical_url FROM r WHERE canonical_url NOT IN (SELECT canonical_url FROM old) GROUP BY canonical_url UNION ALL SELECT -1, canonical_url FROM old"""
)
def redirect_dedup(spark, d):
    rows = table(spark, d, "pages").where("page_id % 5 > 0").select(F.lit("row").alias("outcome"), F.concat(F.lit("s"), F.col("page_id") % 7).alias("source_id"), F.col("page_id").alias("pos"), F.concat(F.lit("https://r.example/"), F.col("page_id") % 40).alias("canonical_url"))
    sources = spark.range(7).select(F.concat(F.lit("s"), "id").alias("id"), F.col("id").alias("position"))
    have = rows.where("pos % 40 < 4").select(F.lit(-1).cast("long").alias("pos"), "canonical_url").distinct()
    return ingest.new_articles(rows, have, sources)


@query(sql("SELECT id, trim(regexp_replace(lower(title), '[^a-z0-9 ]+', ' ', 'g')) AS title FROM articles_px"))
def title_normalise(spark, d):
    return articles(spark, d).select("id", X.normalise_title(F.col("title")).alias("title"))


_TITLED = "CASE WHEN id % 5 = 0 THEN ' 9/' || (id % 28) || CASE WHEN id % 2 = 0 THEN '/24' ELSE '' END || ' : ' || title WHEN id % 7 = 0 THEN 'Full TRANSCRIPT of ' || title WHEN id % 9 = 0 THEN 'Transcription ' || title ELSE title END"


@query(sql(f"SELECT id FROM (SELECT id, {_TITLED} AS t FROM articles_px) WHERE regexp_matches(t, '^\\s*\\d{{1,2}}/\\d{{1,2}}(?:/\\d{{2,4}})?\\s*:') OR regexp_matches(t, '(?i)^\\s*(?:full\\s+)?transcripts?\\b')"))
def non_article_filter(spark, d):
    return articles(spark, d).select("id", F.expr(_TITLED).alias("t")).where(X.is_non_article(F.col("t"))).select("id")


@query("SELECT doc_id, nullif(trim(regexp_replace(text, '\\s+', ' ', 'g')), '') AS text FROM documents")
def whitespace_clean(spark, d):
    return table(spark, d, "documents").select("doc_id", X.clean_plain(F.col("text")).alias("text"))


@query("SELECT page_id, nullif(trim(regexp_replace(replace(replace(replace(regexp_extract(html, '<title>([^<]*)</title>', 1), '&amp;', '&'), '&amp;', '&'), '&amp;', '&'), '\\s+', ' ', 'g')), '') AS title FROM pages")
def entity_decode(spark, d):
    return table(spark, d, "pages").select("page_id", X.clean_text(F.regexp_extract("html", "<title>([^<]*)</title>", 1)).alias("title"))


@query("SELECT page_id, replace(replace(regexp_replace(html, '&([a-zA-Z]+;|#[0-9]+;|#x[0-9a-fA-F]+;)', chr(1) || '\\1', 'g'), '&', '&amp;'), chr(1), '&') AS html FROM (SELECT page_id, replace(html, '&amp; ', '& ') AS html FROM pages)")
def xml_sanitise(spark, d):
    return table(spark, d, "pages").select("page_id", X.sanitise_xml(F.replace("html", F.lit("&amp; "), F.lit("& "))).alias("html"))


@query("SELECT doc_id, replace(text, chr(10), '') AS text FROM documents")
def nul_scrub(spark, d):
    rows = table(spark, d, "documents").select("doc_id", F.replace("text", F.lit("\n"), F.lit("\0")).alias("text"))
    return T.scrub_nul(rows)


_FLAT = "f AS (SELECT doc_id, trim(regexp_replace(text, '\\s+', ' ', 'g')) AS flat FROM documents)"


@query(
    f"""WITH {_FLAT},
s AS (
  SELECT doc_id, list_filter(list_transform(regexp_extract_all(flat, '.+?(?:[.!?]+(?:\\s|$)|$)'), lambda x: trim(x)), lambda x: x <> '') AS p FROM f WHERE length(flat) >= 40),
e AS (SELECT *, list_transform(range(1, len(p) + 1), lambda i: list_sum(list_transform(p[1:i], lambda x: length(x) + 1))) AS ends FROM s),
j AS (
  SELECT doc_id, array_to_string(p[1:greatest(1, least(len(list_filter(ends, lambda x: x < 400)) + 1, len(list_filter(ends, lambda x: x <= 520))))], ' ') AS t FROM e)
SELECT doc_id, CASE WHEN length(t) <= 520 THEN t ELSE rtrim(left(t, 517)) || '...' END AS snippet FROM j UNION ALL SELECT doc_id, NULL FROM f WHERE length(flat) < 40"""
)
def snippets(spark, d):
    return table(spark, d, "documents").select("doc_id", X.snippet("text").alias("snippet"))


_ABBREVIATED = ", ".join(f"'{w}'" for w in X.ABBREVIATIONS)


@query(
    f"""WITH {_FLAT},
p AS (SELECT doc_id, flat, string_split(flat, '. ') AS p FROM f),
n AS (SELECT *, list_transform(p, lambda x: length(x)) AS n, list_transform(p, lambda x: lower(regexp_extract(x, '[^ ]*$'))) AS w FROM p),
k AS (
  SELECT doc_id, flat, p, list_filter(range(1, len(p)), lambda i: list_sum(n[1:i]) + 2 * (i - 1) >= 20 AND regexp_matches(p[i + 1], '^[A-Z0-9]') AND length(w[i]) <> 1 AND w[i] NOT IN ({_ABBREVIATED})) AS stops FROM n),
t AS (SELECT doc_id, CASE WHEN len(stops) > 0 THEN array_to_string(p[1:stops[1]], '. ') ELSE flat END AS t FROM k)
SELECT doc_id, CASE WHEN length(t) <= 120 THEN t ELSE rtrim(regexp_replace(left(t, 120), ' [^ ]*$', ''), ',;:') || '…' END AS title FROM t"""
)
def placeholder_titles(spark, d):
    return table(spark, d, "documents").select("doc_id", X.placeholder_title("text").alias("title"))


@query(
    "WITH e AS (SELECT event_id, event_type, CAST(json_extract(props, '$.k') AS BIGINT) AS k, value FROM events) "
    "SELECT event_id, CASE WHEN event_type IN ('view', 'click') THEN event_type ELSE 'other' END AS category, CASE WHEN event_type IN ('view', 'error') THEN event_type END AS direction, "
    "CASE WHEN k % 10 = 0 THEN 0.0 ELSE greatest(0.0, least(1.0, (value - 20) / 50)) END AS confidence, "
    "try_strptime('2024-' || lpad(CAST(k % 14 AS VARCHAR), 2, '0') || '-' || lpad(CAST(k % 33 AS VARCHAR), 2, '0'), '%Y-%m-%d')::DATE AS event_date FROM e"
)
def sanitise_enums_clamp_date(spark, d):
    rows = table(spark, d, "events").select("event_id", "event_type", "value", F.get_json_object("props", "$.k").cast("int").alias("k"))
    raw = F.when(F.col("k") % 10 == 0, "n/a").otherwise(((F.col("value") - 20) / 50).cast("string"))
    day = F.format_string("2024-%02d-%02d", F.col("k") % 14, F.col("k") % 33)
    return rows.select("event_id", S.one_of(F.col("event_type"), ("view", "click"), "other").alias("category"), S.one_of(F.col("event_type"), ("view", "error"), None).alias("direction"), S.clamp01(raw).alias("confidence"), M.valid_date(day).alias("event_date"))


_STAMP = "strftime(ts, CASE CAST(event_id % 3 AS INT) WHEN 0 THEN '%Y-%m-%dT%H:%M:%SZ' WHEN 1 THEN '%a, %d %b %Y %H:%M:%S GMT' ELSE '%Y-%m-%d %H:%M:%S+02:00' END)"


@query("SELECT event_id, CASE WHEN event_id % 11 = 0 THEN NULL ELSE CAST(floor(epoch(ts)) AS BIGINT) - CASE WHEN event_id % 3 = 2 THEN 7200 ELSE 0 END END AS seconds FROM events")
def datetime_parse(spark, d):
    f = lambda p: F.date_format("ts", p)
    days = F.element_at(F.array(*[F.lit(x) for x in ("Sun", "Mon", "Tue", "Wed", "Thu", "Fri", "Sat")]), F.dayofweek("ts"))
    text = F.when(F.col("event_id") % 11 == 0, "not a date").when(F.col("event_id") % 3 == 0, f("yyyy-MM-dd'T'HH:mm:ss'Z'")).when(F.col("event_id") % 3 == 1, F.concat(days, F.lit(", "), f("dd MMM yyyy HH:mm:ss"), F.lit(" GMT"))).otherwise(F.concat(f("yyyy-MM-dd HH:mm:ss"), F.lit("+02:00")))
    return table(spark, d, "events").select("event_id", F.unix_seconds(M.parse_datetime(text)).alias("seconds"))


_DIRTY = "['  Alpha   Beta ', 'x', outlet || ' News', 'alpha beta', 'ALPHA BETA', key_entities[1], upper(key_entities[1]), key_entities[2], key_entities[3], 'Gamma', 'Delta', 'Epsilon', 'Zeta', 'Eta', 'Theta']"


@query(
    sql(
        f"SELECT id, list_transform(list_filter(list_zip(l, range(1, len(l) + 1)), lambda x: list_position(list_transform(l, lambda y: lower(y)), lower(x[1])) = x[2]), lambda x: x[1])[1:8] AS key_entities "
        f"FROM (SELECT id, list_filter(list_transform({_DIRTY}, lambda x: trim(regexp_replace(x, '\\s+', ' ', 'g'))), lambda x: length(x) >= 2 AND NOT contains(lower(x), lower(outlet))) AS l FROM articles_px)"
    )
)
def entity_clean(spark, d):
    dirty = F.array(F.lit("  Alpha   Beta "), F.lit("x"), F.concat("outlet", F.lit(" News")), F.lit("alpha beta"), F.lit("ALPHA BETA"), F.col("key_entities")[0], F.upper(F.col("key_entities")[0]), F.col("key_entities")[1], F.col("key_entities")[2], *[F.lit(x) for x in ("Gamma", "Delta", "Epsilon", "Zeta", "Eta", "Theta")])
    return articles(spark, d).select("id", S.clean_entities(dirty, F.col("outlet")).alias("key_entities"))


@query(sql("SELECT id, side FROM articles_px"))
def side_assign(spark, d):
    return articles(spark, d).select("id", "side")


@query(sql("SELECT id FROM articles_px WHERE NOT is_wire_copy AND article_type <> 'roundup' AND NOT regexp_matches(title, '(?i)^\\s*(?:full\\s+)?transcripts?\\b')"))
def displayable(spark, d):
    return articles(spark, d).where(S.displayable(F.col("is_wire_copy"), F.col("article_type"), F.col("title"))).select("id")


@query(sql("SELECT id, '[' || array_to_string(list_transform(vector, lambda x: printf('%.7f', x)), ',') || ']' AS vector FROM articles_px"))
def vector_text(spark, d):
    return articles(spark, d).select("id", V.to_text(F.col("vector")).alias("vector"))


#: Heads and tails of texts, some of them those of agency copy, and names of authors.
_HEADS = ("", "PARIS (AFP) - ", "New York, (AP) — ", "paris (afp) - ", "(Reuters)– ", "LONDON (Reuters) and ", "A line.\nST. JOHN'S, (Bloomberg) - ", "x" * 420 + "\nROME (AP) - ")
_TAILS = ("", " AP writer Ann Lee contributed to this", " © 2024 Reuters", " Reuters was told" + " z" * 30 + " contributed", " © 1999 Reuters", " ap staff contributed")
_BYLINES = (("Ann Lee",), ("Bo", "Reuters Staff"), ("associated press",), ("Reutersson",), ())
_QUOTED = lambda x: "'" + x.replace("'", "''") + "'"
_PICK = lambda name, values: f"([{', '.join(values)}])[1 + {name} % {len(values)}]"
_AGENCY = "(?i)\\b(associated press|reuters|agence france-presse|afp|bloomberg news)\\b"


@query(
    sql(
        f"SELECT id, regexp_matches(left(t, 400), '(?m)^\\s*(?:[A-Z][A-Za-z.''’\\- ]{{1,40}},?\\s*)?\\((?:AP|Reuters|AFP|Bloomberg)\\)\\s*[—–-]') OR len(list_filter(authors, lambda a: regexp_matches(a, '{_AGENCY}'))) > 0 "
        f"OR regexp_matches(right(t, 600), '(?i)\\b(?:AP|Reuters)\\b.{{0,40}}\\bcontributed\\b|©\\s*20\\d\\d\\s*(?:The Associated Press|Reuters)') AS hint FROM w",
        more=f"w AS (SELECT id, {_PICK('id', [_QUOTED(h) for h in _HEADS])} || text || {_PICK('(id // 8)', [_QUOTED(x) for x in _TAILS])} AS t, "
        f"{_PICK('(id // 3)', ['[' + ', '.join(map(_QUOTED, b)) + ']::VARCHAR[]' for b in _BYLINES])} AS authors FROM articles_px)",
    )
)
def wire_hint(spark, d):
    rows = articles(spark, d)
    pick = lambda name, values: F.element_at(F.array(*values), (name % len(values) + 1).cast("int"))
    text = F.concat(pick(F.col("id"), [F.lit(h) for h in _HEADS]), "text", pick(F.floor(F.col("id") / 8), [F.lit(x) for x in _TAILS]))
    authors = pick(F.floor(F.col("id") / 3), [F.array(*map(F.lit, b)).cast("array<string>") for b in _BYLINES])
    return rows.select("id", S.wire_hint(text, authors).alias("hint"))


_EVIDENCE = ("none", "byline: Associated Press", "dateline PARIS (AFP)", "a map of the cape", "")


@query(sql(f"SELECT id, (id % 2 = 0 AND regexp_matches({_PICK('id', [_QUOTED(e) for e in _EVIDENCE])}, '(?i)\\b(ap|associated press|reuters|afp|agence france|bloomberg)\\b')) OR id % 7 = 0 AS wire FROM articles_px"))
def wire_verdict(spark, d):
    evidence = F.element_at(F.array(*map(F.lit, _EVIDENCE)), (F.col("id") % len(_EVIDENCE) + 1).cast("int"))
    return articles(spark, d).select("id", S.wire_verdict(F.col("id") % 2 == 0, evidence, F.col("id") % 7 == 0).alias("wire"))


@query(sql("SELECT id, len(axes) = 0 OR id % 5 = 0 AS missing, CASE WHEN len(axes) = 0 THEN ['new axis'] ELSE axes END AS axes, CASE WHEN id % 5 = 0 THEN 'told' ELSE 'own' END AS summary FROM articles_px"))
def framing_merge(spark, d):
    rows = articles(spark, d).withColumn("s", F.when(F.col("id") % 5 == 0, "  ").otherwise("own"))
    axes, summary = S.fill_framing(F.col("axes"), F.col("s"), F.array(F.lit(" new  axis "), F.lit(" ")), F.lit(" told "))
    return rows.select("id", S.needs_framing(F.col("axes"), F.col("s")).alias("missing"), axes.alias("axes"), summary.alias("summary"))


@query(
    "SELECT doc_id, replace(source, 'src', '&') AS source, lang FROM (SELECT doc_id, source, CAST(NULL AS VARCHAR) AS lang FROM documents WHERE doc_id % 2 = 0)"
)
def fix_text_changed(spark, d):
    coded = F.when(F.col("doc_id") % 2 == 0, F.replace("source", F.lit("src"), F.lit("&amp;"))).otherwise(F.col("source"))
    rows = table(spark, d, "documents").select("doc_id", coded.alias("source"), "lang")
    return ingest.changed_text(rows, "doc_id", ["source", "lang"])


_REG = (
    "SELECT source AS id, upper(source) AS outlet, 'https://' || source || '.example/feed' AS feed_url, n % 5 <> 0 AS enabled, n % 3 = 0 AS verified, n FROM "
    "(SELECT DISTINCT source, CAST(regexp_extract(source, '[0-9]+') AS INT) AS n FROM documents)"
)


def _registry(spark, d):
    rows = table(spark, d, "documents").select("source").distinct().withColumn("n", F.regexp_extract("source", "[0-9]+", 0).cast("int"))
    nothing = F.lit(None).cast("string")
    return rows.select(
        F.col("source").alias("id"), F.upper("source").alias("outlet"), F.concat(F.lit("https://"), "source", F.lit(".example/feed")).alias("feed_url"), nothing.alias("homepage"), F.lit("CENTER").alias("leaning"),
        nothing.alias("section"), F.lit("generic").alias("extractor"), (F.col("n") % 5 != 0).alias("enabled"), F.lit(40).alias("max_per_run"), nothing.alias("notes"), (F.col("n") % 3 == 0).alias("verified"), F.array().cast("array<string>").alias("alt_feed_urls"), F.col("n").alias("position"),
    )


@query(f"WITH r AS ({_REG}) SELECT id, enabled FROM r WHERE n % 4 <> 0 UNION ALL SELECT id, false FROM r WHERE n % 4 = 0 AND n % 2 = 0")
def registry_sync(spark, d):
    listed = _registry(spark, d)
    table_now = listed.where("position % 2 = 0").drop(*R.LOCAL).withColumn("enabled", F.lit(True))
    return R.sync(table_now, listed.where("position % 4 <> 0")).select("id", "enabled")


@query(f"WITH r AS ({_REG}) SELECT id, 'verified' AS how FROM r WHERE enabled AND verified UNION ALL SELECT id, 'all' FROM r WHERE enabled UNION ALL SELECT id, 'one' FROM r WHERE enabled AND id = 'src7'")
def source_select(spark, d):
    rows = _registry(spark, d)
    part = lambda df, how: df.select("id", F.lit(how).alias("how"))
    return part(R.select(rows), "verified").unionByName(part(R.select(rows, True), "all")).unionByName(part(R.select(rows, only="SRC7"), "one"))


_LD = (
    '<script type="application/ld+json">{"@graph": [{"@type": "Person", "headline": "no"}, {"@type": ["NewsArticle"], "headline": "Told @@", "author": [{"name": "Ann @@"}, " Bo "], "datePublished": "2024-01-02T03:04:05Z", '
    '"articleSection": "S", "image": [{"url": "https://img.example/@@"}]}]}</script><script type="application/ld+json">{broken</script>'
)
_METAS = '<meta name="author" content="Ann Lee, Bo @@ and Cy"><meta property="og:title" content="OG @@"><meta property="og:image" content="https://img.example/m"><meta name="description" content=" about @@ "><meta name="date" content="2024-01-05">'


@query(
    f"""WITH h AS (
  SELECT page_id, replace(html, '<meta charset="utf-8">', '<meta charset="utf-8">' || replace(CASE page_id % 3 WHEN 0 THEN '{_LD}' WHEN 1 THEN '{_METAS}' ELSE '' END, '@@', page_id::VARCHAR)) AS html FROM (SELECT page_id, html FROM pages)),
a AS (SELECT *, regexp_extract(html, '(?s)<article>(.*?)</article>', 1) AS art, replace(replace(replace(replace(trim(regexp_extract(html, '<title>([^<]*)</title>', 1)), '&quot;', '"'), '&lt;', '<'), '&gt;', '>'), '&amp;', '&') AS t0 FROM h),
p AS (
  SELECT *, list_transform(string_split(art, '<p>')[2:], lambda x: array_to_string(list_filter(list_transform(string_split(regexp_replace(string_split(x, '</p>')[1], '<[^>]*>', chr(1), 'g'), chr(1)),
    lambda y: trim(y, ' ' || chr(10) || chr(9))), lambda y: y <> ''), ' ')) AS ps,
    CASE page_id % 3 WHEN 0 THEN 'Told ' || page_id WHEN 1 THEN 'OG ' || page_id ELSE t0 END AS title FROM a),
j AS (SELECT *, array_to_string(list_filter(ps, lambda x: length(x) >= 2), chr(10) || chr(10)) AS precise, array_to_string(list_filter(ps, lambda x: length(x) >= 10), chr(10) || chr(10)) AS every FROM p),
r AS (SELECT *, replace(replace(replace(replace(CASE WHEN length(precise) < 300 AND every <> '' THEN every ELSE precise END, '&quot;', '"'), '&lt;', '<'), '&gt;', '>'), '&amp;', '&') AS raw FROM j)
SELECT page_id, title, CASE WHEN starts_with(raw, title) THEN ltrim(substr(raw, length(title) + 1), ' ' || chr(10)) ELSE raw END AS text, CASE page_id % 3 WHEN 0 THEN ['Ann ' || page_id, 'Bo'] WHEN 1 THEN ['Ann Lee', 'Bo ' || page_id, 'Cy'] ELSE [] END AS authors,
  CASE page_id % 3 WHEN 0 THEN 'https://img.example/' || page_id WHEN 1 THEN 'https://img.example/m' END AS image, CASE WHEN page_id % 3 = 1 THEN 'about ' || page_id END AS description, CASE WHEN page_id % 3 = 0 THEN 'S' END AS section,
  CASE WHEN page_id % 3 = 0 THEN 'NewsArticle' END AS jsonld_type, CAST(epoch(CASE page_id % 3 WHEN 0 THEN TIMESTAMP '2024-01-02 03:04:05' END) AS BIGINT) AS published, strlen(html) AS html_bytes FROM r"""
)
def page_extract(spark, d):
    number = F.col("page_id").cast("string")
    more = F.when(F.col("page_id") % 3 == 0, F.lit(_LD)).when(F.col("page_id") % 3 == 1, F.lit(_METAS)).otherwise("")
    html = F.replace("html", F.lit('<meta charset="utf-8">'), F.concat(F.lit('<meta charset="utf-8">'), F.replace(more, F.lit("@@"), number)))
    out = P.extract_pages(table(spark, d, "pages").select("page_id", html.alias("html")), "page_id")
    return out.select("page_id", "title", "text", "authors", "image", "description", "section", "jsonld_type", F.when(F.col("page_id") % 3 == 0, F.unix_seconds("published_at")).alias("published"), "html_bytes")


@query("SELECT event_type AS kind, CAST(user_id % 3 AS VARCHAR) AS model, count(*) AS calls, CAST(sum(event_id) AS BIGINT) AS tokens_in, CAST(sum(user_id) AS BIGINT) AS tokens_out FROM events GROUP BY ALL")
def llm_usage(spark, d):
    from ..operators.models import usage

    calls = table(spark, d, "events").select(F.col("event_type").alias("kind"), (F.col("user_id") % 3).cast("string").alias("model"), F.col("event_id").alias("tokens_in"), F.col("user_id").alias("tokens_out"))
    return usage(calls)


@query(
    sql(
        """SELECT id, 'done' AS enrichment_status, 'other' AS category, 'news' AS article_type, array_to_string(w[1:12], ' ') AS event_summary,
  list_transform(list_filter(list_zip(e, range(1, len(e) + 1)), lambda x: list_position(list_transform(e, lambda y: lower(y)), lower(x[1])) = x[2]), lambda x: x[1])[1:8] AS key_entities, 64 AS dims, CAST(NULL AS VARCHAR) AS error
FROM (SELECT id, w, list_filter(list_sort(list_distinct(list_transform(list_filter(w, lambda x: regexp_matches(x, '^\\p{Lu}')), lambda x: trim(x, '.,'))))[1:6], lambda x: length(x) >= 2 AND NOT contains(lower(x), lower(outlet))) AS e FROM p)""",
        more="""p AS (
  SELECT id, outlet, regexp_extract_all('Outlet: ' || outlet || ' Published: ' || strftime(published_at, '%Y-%m-%d %H:%M:%S') || ' Title: ' || CASE WHEN title = '' THEN 'none' ELSE title END || ' Feed headline: none Description: none Text: ' || left(text, 4000), '\\S+') AS w
  FROM articles_px WHERE length(text) >= 300)""",
    )
)
def enrich_run(spark, d):
    """Enrichment by the offline model, whose answers are functions of the prompt."""
    rows = articles(spark, d).where("length(text) >= 300").select("id", "outlet", "published_at", "title", F.lit(None).cast("string").alias("headline"), F.lit(None).cast("string").alias("subheadline"), F.col("text").alias("body_text"), F.length("text").alias("body_chars"), F.lit(False).alias("wire_hint"))
    out = enrich.run(rows)
    return out.select("id", "enrichment_status", "category", "article_type", "event_summary", "key_entities", F.size("vector").alias("dims"), "error")
