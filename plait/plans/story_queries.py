"""Registered queries of retrieval, assignment, stories, merging, pairs, rechecks and reports."""

from __future__ import annotations

import dataclasses

from pyspark.sql import functions as F

from ..config import Config
from ..functions import scoring as S
from ..operators import alike, assign, conflicts, enrich, merge, models, pairs, recheck, reports, retrieval, stories as Y
from .proxies import PX, articles, ntz, sql, stories, table

QUERIES, SQL = {}, {}


def query(text: str | None = None):
    def add(f):
        QUERIES[f.__name__] = f
        if text:
            SQL[f.__name__] = text
        return f

    return add


def _rounded(df, column, places=6):
    return df.withColumn(column, F.round(column, places))


# ---- retrieval and the decision --------------------------------------------------------------------------------------

TOP_SQL = """met AS (
  SELECT a.id AS article_id, s.id AS story_id, list_dot_product(a.vector, s.centroid) AS similarity FROM articles_px a JOIN stories_px s
  ON s.last_seen >= a.published_at - INTERVAL 96 HOUR),
top AS (SELECT *, row_number() OVER (PARTITION BY article_id ORDER BY similarity DESC, story_id) AS rank FROM met QUALIFY rank <= 10),
cand AS (
  SELECT t.*, a.published_at, a.event_date, s.first_seen, s.event_date AS story_date,
    round(similarity + 0.05 * (CASE WHEN len(a.key_entities) = 0 OR len(s.key_entities) = 0 THEN 0
        ELSE len(list_intersect(a.key_entities, s.key_entities)) / len(list_distinct(list_concat(a.key_entities, s.key_entities))) END)
      - 0.02 * abs(epoch(a.published_at) - epoch(s.last_seen)) / 86400, 4) AS score
  FROM top t JOIN articles_px a ON a.id = t.article_id JOIN stories_px s ON s.id = t.story_id
  WHERE coalesce(abs(date_diff('day', a.event_date, s.event_date)) <= 3, true) AND NOT (a.id % 3 = 0 AND t.story_id = a.id % 10)),
best AS (SELECT * FROM cand QUALIFY row_number() OVER (PARTITION BY article_id ORDER BY score DESC, rank) = 1),
why AS (
  SELECT *, CASE WHEN first_seen IS NULL THEN 'no_first_seen' WHEN published_at - first_seen > INTERVAL 12 HOUR THEN 'late' WHEN event_date > story_date THEN 'later_event_date' END AS r FROM best)"""


def _known(spark, d):
    return stories(spark, d).withColumn("vector", F.col("centroid"))


def _asked(spark, d):
    """Articles of which every third was split off from a story."""
    return articles(spark, d).withColumn("split_from", F.when(F.col("id") % 3 == 0, F.col("id") % 10))


@query(sql("SELECT article_id, story_id, rank::INT AS rank, round(similarity, 6) AS similarity FROM top", True, TOP_SQL))
def cosine_topk(spark, d):
    return _rounded(retrieval.top_stories(articles(spark, d), _known(spark, d)), "similarity").select("article_id", "story_id", "rank", "similarity")


@query(sql("SELECT article_id, story_id, score FROM cand", True, TOP_SQL))
def candidate_score(spark, d):
    return assign.scored(_asked(spark, d), _known(spark, d), PX).select("article_id", "story_id", "score")


@query(
    sql(
        "SELECT a.id AS article_id, w.story_id, w.score, CASE WHEN w.score >= 0.30 THEN w.r END AS reason, "
        "CASE WHEN w.score >= 0.30 AND w.r IS NULL THEN 'attach' WHEN w.score >= 0.20 THEN 'verify' WHEN a.article_type IN ('news', 'live', 'explainer') AND NOT a.is_wire_copy THEN 'create' ELSE 'orphan' END AS decision FROM articles_px a LEFT JOIN why w ON w.article_id = a.id",
        True, TOP_SQL,
    )
)
def decide_zone(spark, d):
    return assign.decide(_asked(spark, d), _known(spark, d), PX)


@query(sql("SELECT a.id, round(len(list_intersect(a.key_entities, s.key_entities)) / len(list_distinct(list_concat(a.key_entities, s.key_entities))), 6) AS jaccard FROM articles_px a JOIN stories_px s ON s.id = a.story_id", True))
def entity_jaccard(spark, d):
    s = stories(spark, d).select(F.col("id").alias("story_id"), F.col("key_entities").alias("theirs"))
    return articles(spark, d).join(s, "story_id").select("id", F.round(S.entity_jaccard(F.col("key_entities"), F.col("theirs")), 6).alias("jaccard"))


@query(
    sql(
        "SELECT id, strong, CASE WHEN relation = 'same_development' AND known AND (strong OR confidence >= 0.6) THEN 'chosen' "
        "WHEN strong AND NOT (relation IN ('follow_up', 'unrelated') AND confidence >= 0.7) THEN 'kept' END AS verdict "
        "FROM (SELECT id, id % 2 = 0 AS strong, (['same_development', 'follow_up', 'unrelated'])[1 + id % 3] AS relation, id % 5 > 0 AS known, confidence FROM articles_px)"
    )
)
def verifier_policy(spark, d):
    relation = F.element_at(F.array(F.lit("same_development"), F.lit("follow_up"), F.lit("unrelated")), (F.col("id") % 3 + 1).cast("int"))
    strong = F.col("id") % 2 == 0
    return articles(spark, d).select("id", strong.alias("strong"), S.verified(relation, F.col("confidence"), F.col("id") % 5 > 0, strong).alias("verdict"))


@query()
def assign_online(spark, d):
    rows = articles(spark, d).withColumns({"block": F.lit(None).cast("string"), "phase": F.lit(0), "category": F.lit("other"), "split_from": F.lit(None).cast("string")})
    return conflicts.assign_side_by_side(rows, config=PX).select("id", "block", "method", "story_id", "side", "score", "story_size")


@query(
    sql(
        """SELECT id, CAST(story_id % 3 AS VARCHAR) AS block, CASE WHEN f IS NULL OR (published_at, id) < f THEN 'orphan' WHEN (published_at, id) = f THEN 'create' WHEN published_at - f[1] > INTERVAL 12 HOUR THEN 'verifier' ELSE 'threshold' END AS method,
  CASE WHEN (published_at, id) >= f THEN 's' || left(sha1(CAST(f[2] AS VARCHAR)), 16) END AS story_id, side, CASE WHEN (published_at, id) >= f THEN n END AS story_size,
  CASE WHEN f IS NULL OR (published_at, id) < f THEN article_type || CASE WHEN is_wire_copy THEN ' wire' ELSE '' END || ' cannot create a story' END AS reason
FROM (SELECT *, CAST(count(*) FILTER ((published_at, id) >= f) OVER (PARTITION BY story_id ORDER BY published_at, id) AS INT) AS n FROM o)""",
        more="""o AS (
  SELECT *, min((published_at, id)) FILTER (article_type IN ('news', 'live', 'explainer') AND NOT is_wire_copy) OVER (PARTITION BY story_id) AS f FROM articles_px)""",
    )
)
def assign_in_blocks(spark, d):
    """Articles of one label are alike, of two labels at right angles: what becomes of each follows from the first that may create."""
    axis = F.transform(F.sequence(F.lit(0), F.lit(9)), lambda i: F.when(i == F.col("story_id"), 1.0).otherwise(0.0))
    rows = articles(spark, d).withColumns({"block": (F.col("story_id") % 3).cast("string"), "phase": F.lit(0), "category": F.lit("other"), "split_from": F.lit(None).cast("string"), "event_date": F.lit(None).cast("date"), "vector": axis})
    return assign.assign_in_order(rows).select("id", "block", "method", "story_id", "side", "story_size", "reason")


@query(
    sql(
        """SELECT id, CASE WHEN f IS NULL OR (published_at, id) < f THEN 'orphan' WHEN (published_at, id) = f THEN 'create' WHEN published_at - f[1] > INTERVAL 12 HOUR THEN 'verifier' ELSE 'threshold' END AS method,
  CASE WHEN (published_at, id) >= f THEN 's' || left(sha1(CAST(f[2] AS VARCHAR)), 16) END AS story_id, side, CASE WHEN (published_at, id) >= f THEN n END AS story_size
FROM (SELECT *, CAST(count(*) FILTER ((published_at, id) >= f) OVER (PARTITION BY story_id ORDER BY published_at, id) AS INT) AS n FROM o)""",
        more="""o AS (
  SELECT *, min((published_at, id)) FILTER (article_type IN ('news', 'live', 'explainer') AND NOT is_wire_copy) OVER (PARTITION BY story_id) AS f FROM articles_px)""",
    )
)
def assign_side_by_side(spark, d):
    """Articles of one label are alike, of two labels at right angles, and nothing says so but their vectors: the components of the conflict graph are the labels."""
    axis = F.transform(F.sequence(F.lit(0), F.lit(9)), lambda i: F.when(i == F.col("story_id"), 1.0).otherwise(0.0))
    rows = articles(spark, d).withColumns({"block": F.lit(None).cast("string"), "phase": F.lit(0), "category": F.lit("other"), "split_from": F.lit(None).cast("string"), "event_date": F.lit(None).cast("date"), "vector": axis})
    return conflicts.assign_side_by_side(rows).select("id", "method", "story_id", "side", "story_size")


@query(
    sql(
        """SELECT count(*) AS processed, count(*) FILTER ((published_at, id) > f) AS attached, count(*) FILTER ((published_at, id) = f) AS created, count(*) FILTER (f IS NULL OR (published_at, id) < f) AS orphaned, 0::BIGINT AS failed,
  0::BIGINT AS verified, count(*) FILTER ((published_at, id) > f AND published_at - f[1] > INTERVAL 12 HOUR) AS verifier_attached, 0::BIGINT AS orphan_retries FROM o""",
        more="""o AS (
  SELECT *, min((published_at, id)) FILTER (article_type IN ('news', 'live', 'explainer') AND NOT is_wire_copy) OVER (PARTITION BY story_id) AS f FROM articles_px)""",
    )
)
def assign_stats(spark, d):
    axis = F.transform(F.sequence(F.lit(0), F.lit(9)), lambda i: F.when(i == F.col("story_id"), 1.0).otherwise(0.0))
    rows = articles(spark, d).withColumns({"block": (F.col("story_id") % 3).cast("string"), "phase": F.lit(0), "category": F.lit("other"), "split_from": F.lit(None).cast("string"), "event_date": F.lit(None).cast("date"), "vector": axis})
    return assign.stats(assign.assign_in_order(rows))


_STATE = "CASE WHEN id % 3 = 0 THEN NULL ELSE story_id END"


@query(
    sql(
        "SELECT * FROM (SELECT id, 0 AS phase FROM q WHERE assigned_at IS NULL ORDER BY published_at, id LIMIT 300) UNION ALL "
        "SELECT * FROM (SELECT id, 1 AS phase FROM q WHERE method = 'orphan' AND published_at >= TIMESTAMP '2024-01-04 00:00:00' - INTERVAL 48 HOUR AND assigned_at <= TIMESTAMP '2024-01-04 00:00:00' - INTERVAL 55 MINUTE ORDER BY published_at, id LIMIT 100)",
        more="q AS (SELECT id, published_at, CASE WHEN id % 2 = 0 THEN published_at + INTERVAL 1 HOUR END AS assigned_at, CASE WHEN id % 2 = 0 THEN 'orphan' END AS method FROM articles_px WHERE id % 3 > 0)",
    )
)
def assign_queue(spark, d):
    tried = F.col("id") % 2 == 0
    rows = articles(spark, d).select(
        "id", "published_at", F.when(F.col("id") % 3 == 0, F.col("story_id")).alias("story_id"), F.lit("done").alias("enrichment_status"),
        F.when(tried, F.col("published_at") + F.make_dt_interval(hours=F.lit(1))).alias("assigned_at"), F.when(tried, "orphan").alias("method"),
    )
    return assign.queue(rows, ntz("2024-01-04 00:00:00")).select("id", "phase")


@query(sql("SELECT id FROM articles_px WHERE id % 2 = 0 ORDER BY published_at DESC, id LIMIT 200"))
def enrich_queue(spark, d):
    rows = articles(spark, d).withColumn("enrichment_status", F.when(F.col("id") % 2 == 0, "pending").otherwise("done"))
    return enrich.queue(rows).select("id")


@query(sql("SELECT id FROM articles_px WHERE published_at >= TIMESTAMP '2024-01-03 00:00:00' AND (len(axes) = 0 OR id % 5 = 0)"))
def framing_queue(spark, d):
    stance = F.struct(F.col("axes").alias("framing_axes"), F.when(F.col("id") % 5 != 0, "told").alias("framing_summary"))
    rows = articles(spark, d).withColumns({"stance": stance, "enrichment_status": F.lit("done")})
    return enrich.framing_queue(rows, ntz("2024-01-03 00:00:00")).select("id")


@query(sql("SELECT id, CASE WHEN id % 4 = 0 THEN story_id + 1 WHEN id % 4 = 1 THEN story_id END AS split_from FROM articles_px"))
def split_memory(spark, d):
    method = F.when(F.col("id") % 4 == 1, "detached").otherwise("orphan")
    a = F.struct(F.when(F.col("id") % 4 == 0, F.col("story_id") + 1).alias("split_from"), method.alias("method"), F.when(F.col("id") % 4 < 3, F.col("story_id")).alias("from_story"))
    return articles(spark, d).select("id", a.alias("assignment")).select("id", assign.split_memory().alias("split_from"))


# ---- stories ----------------------------------------------------------------------------------------------------------


@query(sql("SELECT id, article_count, left_count, right_count, center_count, first_seen, last_seen, event_date, key_entities FROM stories_px", True))
def story_rollup(spark, d):
    return Y.rollup(articles(spark, d)).withColumnRenamed("story_id", "id")


@query(sql("SELECT story_id, count(*) AS article_count, count(*) FILTER (side = 'left') AS left_count, count(*) FILTER (side = 'right') AS right_count, count(*) FILTER (side = 'center') AS center_count FROM articles_px WHERE id % 5 > 0 GROUP BY story_id"))
def recount(spark, d):
    return Y.recount(articles(spark, d).withColumn("story_id", F.when(F.col("id") % 5 > 0, F.col("story_id"))))


@query(sql("SELECT story_id, arg_min(id, (CASE WHEN article_type IN ('news', 'live', 'explainer') AND NOT is_wire_copy THEN 0 ELSE 1 END, published_at, id)) AS founder_id FROM articles_px WHERE event_summary <> '' GROUP BY story_id"))
def founding_article(spark, d):
    return Y.founders(articles(spark, d)).select("story_id", "founder_id")


@query(
    "WITH RECURSIVE "
    + sql("", more="").removeprefix("WITH ").rstrip()
    + """,
o AS (SELECT story_id, vector, row_number() OVER (PARTITION BY story_id ORDER BY published_at, id) AS n FROM articles_px),
f(story_id, n, c) AS (
  SELECT story_id, n, list_transform(vector, lambda x: x / sqrt(list_dot_product(vector, vector))) FROM o WHERE n = 1
  UNION ALL
  SELECT s.story_id, s.n, list_transform(s.m, lambda x: x / sqrt(list_dot_product(s.m, s.m)))
  FROM (SELECT o.story_id, o.n, list_transform(list_zip(f.c, o.vector), lambda p: (p[1] * f.n + p[2]) / (f.n + 1)) AS m FROM f JOIN o ON o.story_id = f.story_id AND o.n = f.n + 1) s)
SELECT story_id, list_transform(arg_max(c, n), lambda x: round(x, 6)) AS centroid FROM f GROUP BY story_id"""
)
def centroid_fold(spark, d):
    return Y.centroids(articles(spark, d)).select("story_id", F.transform("centroid", lambda x: F.round(x, 6)).alias("centroid"))


@query(sql("SELECT id, list_transform(centroid, lambda x: round(x, 6)) AS centroid FROM stories_px", True))
def centroid_mean(spark, d):
    return stories(spark, d).select("id", F.transform("centroid", lambda x: F.round(x, 6)).alias("centroid"))


@query(sql("SELECT id, CASE WHEN last_seen < TIMESTAMP '2024-01-11 12:00:00' - INTERVAL 5 DAY THEN 'closed' ELSE status END AS status FROM stories_px", True))
def close_stale(spark, d):
    return Y.close_stale(stories(spark, d), ntz("2024-01-11 12:00:00")).select("id", "status")


@query(sql("SELECT id, CASE WHEN published_at < TIMESTAMP '2024-02-03 00:00:00' - INTERVAL 30 DAY THEN NULL ELSE text END AS body_text FROM articles_px"))
def trim_bodies(spark, d):
    return Y.trim_bodies(articles(spark, d).withColumnRenamed("text", "body_text"), ntz("2024-02-03 00:00:00")).select("id", "body_text")


# ---- merging ----------------------------------------------------------------------------------------------------------

MERGE_SQL = """sim AS (
  SELECT a.id AS a_id, b.id AS b_id, list_dot_product(a.centroid, b.centroid) AS similarity FROM stories_px a JOIN stories_px b ON a.id < b.id),
mc AS (SELECT * FROM sim WHERE similarity >= 0.05 ORDER BY similarity DESC, a_id, b_id LIMIT 90)"""
_LOOSE = Config(merge_min_similarity=0.05, merge_max_event_gap_days=3)


@query(sql("SELECT a_id, b_id, round(similarity, 6) AS similarity FROM mc", True, MERGE_SQL))
def merge_candidates(spark, d):
    return _rounded(merge.candidates(stories(spark, d), config=_LOOSE), "similarity")


@query(sql("SELECT a_id, b_id, round(similarity, 6) AS similarity FROM mc", True, MERGE_SQL))
def merge_unordered(spark, d):
    rows = merge.candidates(stories(spark, d), config=_LOOSE)
    mirrored = rows.select(F.col("b_id").alias("a_id"), F.col("a_id").alias("b_id"), F.col("similarity") - 0.01)
    return _rounded(merge.unordered(rows.unionByName(mirrored.toDF("a_id", "b_id", "similarity"))), "similarity")


@query(
    sql(
        "SELECT m.a_id, m.b_id, CASE WHEN a.article_count > b.article_count OR (a.article_count = b.article_count AND a.first_seen <= b.first_seen) THEN m.a_id ELSE m.b_id END AS survivor "
        "FROM mc m JOIN stories_px a ON a.id = m.a_id JOIN stories_px b ON b.id = m.b_id WHERE coalesce(abs(date_diff('day', a.event_date, b.event_date)) <= 3, true) "
        "AND NOT EXISTS (SELECT 1 FROM articles_px x WHERE x.id % 37 = 0 AND ((x.story_id = m.a_id AND (x.story_id + 3) % 10 = m.b_id) OR (x.story_id = m.b_id AND (x.story_id + 3) % 10 = m.a_id)))",
        True, MERGE_SQL,
    )
)
def merge_allowed(spark, d):
    s = stories(spark, d)
    arts = articles(spark, d).withColumn("split_from", F.when(F.col("id") % 37 == 0, (F.col("story_id") + 3) % 10))
    return merge.allowed(merge.candidates(s, config=_LOOSE), s, arts, _LOOSE).select("a_id", "b_id", "survivor")


@query(
    "WITH RECURSIVE "
    + sql("", True, MERGE_SQL).removeprefix("WITH ").rstrip()
    + """,
al AS (
  SELECT m.*, CASE WHEN a.article_count > b.article_count OR (a.article_count = b.article_count AND a.first_seen <= b.first_seen) THEN m.a_id ELSE m.b_id END AS survivor, row_number() OVER (ORDER BY similarity DESC, m.a_id, m.b_id) AS n
  FROM mc m JOIN stories_px a ON a.id = m.a_id JOIN stories_px b ON b.id = m.b_id WHERE coalesce(abs(date_diff('day', a.event_date, b.event_date)) <= 3, true)),
g(n, gone, checked, absorbed, survivor) AS (
  SELECT 0::BIGINT, []::BIGINT[], 0, NULL::BIGINT, NULL::BIGINT
  UNION ALL
  SELECT n, CASE WHEN yes THEN list_append(gone, lost) ELSE gone END, checked + CASE WHEN live THEN 1 ELSE 0 END, CASE WHEN yes THEN lost END, CASE WHEN yes THEN survivor END
  FROM (
    SELECT *, live AND (a_id + b_id) % 3 <> 1 AS yes FROM (
      SELECT al.n, g.gone, g.checked, al.survivor, al.a_id, al.b_id, CASE WHEN al.survivor = al.a_id THEN al.b_id ELSE al.a_id END AS lost,
        g.checked < 8 AND al.n <= 24 AND NOT list_contains(g.gone, al.a_id) AND NOT list_contains(g.gone, al.b_id) AS live
      FROM g JOIN al ON al.n = g.n + 1)))
SELECT absorbed, survivor FROM g WHERE absorbed IS NOT NULL"""
)
def merge_greedy(spark, d):
    """The greedy resolution with a limit of checks, on a verifier that answers by the ids."""
    s = stories(spark, d)
    found = merge.allowed(merge.candidates(s, config=_LOOSE), s, articles(spark, d).withColumn("split_from", F.lit(None).cast("long")), _LOOSE)
    says = lambda row: {"same_development": (row["a_id"] + row["b_id"]) % 3 != 1, "confidence": 0.9}
    moves, _ = merge.resolve(found, says, dataclasses.replace(_LOOSE, merge_max_checks=8))
    return spark.createDataFrame(moves, "absorbed long, survivor long")


@query(
    sql(
        "SELECT s.id, CASE WHEN s.id % 3 = 1 THEN 'merged' ELSE s.status END AS status, count(a.id) AS article_count, count(a.id) FILTER (a.side = 'left') AS left_count "
        "FROM stories_px s LEFT JOIN (SELECT id, side, CASE WHEN story_id % 3 = 1 THEN story_id - 1 ELSE story_id END AS story_id FROM articles_px) a ON a.story_id = s.id GROUP BY s.id, s.status",
        True,
    )
)
def merge_apply(spark, d):
    s = stories(spark, d)
    mapping = s.where("id % 3 = 1").select(F.col("id").alias("absorbed"), (F.col("id") - 1).alias("survivor"))
    none = _px_pairs(spark, d)
    _, after, _ = merge.apply(articles(spark, d), s, none, mapping)
    return after.select("id", "status", "article_count", "left_count")


@query(sql("SELECT story_id, list(outlet || ': ' || title ORDER BY published_at, id)[1:6] AS headlines FROM articles_px GROUP BY story_id"))
def story_headlines(spark, d):
    return merge.headlines(articles(spark, d))


# ---- pairs ------------------------------------------------------------------------------------------------------------

PAIR_SQL = """m AS (SELECT *, trim(regexp_replace(lower(title), '[^a-z0-9 ]+', ' ', 'g')) AS nt FROM articles_px
  WHERE NOT is_wire_copy AND article_type <> 'roundup' AND NOT regexp_matches(title, '(?i)^\\s*(?:full\\s+)?transcripts?\\b')),
lr AS (
  SELECT l.story_id, l.id AS l, r.id AS r, l.outlet AS lo, r.outlet AS ro, greatest(l.published_at, r.published_at) AS featured_at,
    ((l.direction, r.direction) IN (('supports', 'opposes'), ('opposes', 'supports'), ('critical_of_left', 'critical_of_right'), ('critical_of_right', 'critical_of_left'))
      AND l.direction IS NOT NULL AND r.direction IS NOT NULL AND l.confidence >= 0.5 AND r.confidence >= 0.5) AS opp,
    (len(l.axes) > 0 AND len(r.axes) > 0 AND NOT list_has_any(l.axes, r.axes)) AS dis,
    CASE WHEN l.article_type = r.article_type THEN 1.0 WHEN l.article_type IN ('news', 'opinion') AND r.article_type IN ('news', 'opinion') THEN -1.0 ELSE 0.0 END
      + CASE WHEN 'live' IN (l.article_type, r.article_type) THEN -1.5 ELSE 0 END
      + CASE WHEN l.image_url IS NOT NULL AND r.image_url IS NOT NULL THEN 1.0 ELSE 0 END + CASE WHEN l.snippet <> '' AND r.snippet <> '' THEN 0.5 ELSE 0 END
      - 0.02 * abs(epoch(l.published_at) - epoch(r.published_at)) / 3600 AS rest
  FROM m l JOIN m r ON l.story_id = r.story_id AND l.side = 'left' AND r.side = 'right' AND l.outlet <> r.outlet AND NOT (l.nt = r.nt AND l.nt <> '')),
scored AS (
  SELECT *, round(CASE WHEN opp THEN 3.0 ELSE 0 END + CASE WHEN dis THEN 1.5 ELSE 0 END + rest, 3) AS score,
    CASE WHEN opp THEN 'opposing_stance' WHEN dis THEN 'framing_contrast' ELSE 'same_story' END AS kind FROM lr)"""
BEST_SQL = "bp AS (SELECT * FROM {of} QUALIFY row_number() OVER (PARTITION BY story_id ORDER BY score DESC, l, r) = 1)"


@query(sql("SELECT story_id, l AS left_id, r AS right_id, score, kind FROM scored", more=PAIR_SQL))
def pair_score(spark, d):
    return pairs.candidates(articles(spark, d), near="title").select("story_id", F.col("l.id").alias("left_id"), F.col("r.id").alias("right_id"), "score", "kind")


@query(sql("SELECT story_id, l AS left_article_id, r AS right_article_id, kind AS pair_kind, score AS divergence_score, featured_at FROM bp", more=PAIR_SQL + ",\n" + BEST_SQL.format(of="scored")))
def pairs_best(spark, d):
    return pairs.best(articles(spark, d), near="title")


@query()
def pairs_best_by_ratio(spark, d):
    return pairs.best(articles(spark, d))


@query()
def near_duplicate_titles(spark, d):
    """Pairs of classes of equal wordings that say the same, and the classes' further members."""
    return alike.near_duplicates(articles(spark, d))


def _px_pairs(spark, d):
    """Current pairs of even stories: their least left and right article; those of stories 0 and 4 name articles of other stories."""
    a = articles(spark, d)
    low = a.where("story_id % 2 = 0").groupBy("story_id").agg(F.min(F.when(F.col("side") == "left", F.col("id"))).alias("left_article_id"), F.min(F.when(F.col("side") == "right", F.col("id"))).alias("right_article_id"))
    lost = F.col("story_id") % 4 == 0
    return low.where("left_article_id is not null and right_article_id is not null").select(
        "story_id", F.when(lost, -1).otherwise(F.col("left_article_id")).alias("left_article_id"), "right_article_id", F.lit("same_story").alias("pair_kind"),
        F.when(F.col("story_id") == 2, 9.0).otherwise(0.5).alias("divergence_score"), ntz("2024-01-01 00:00:00").alias("featured_at"), F.lit(True).alias("is_current"),
    )


CURRENT_SQL = """cur AS (
  SELECT story_id, CASE WHEN story_id % 4 = 0 THEN -1 ELSE l END AS cl, r AS cr, CASE WHEN story_id = 2 THEN 9.0 ELSE 0.5 END AS cs, TIMESTAMP '2024-01-01 00:00:00' AS cf
  FROM (SELECT story_id, min(id) FILTER (side = 'left') AS l, min(id) FILTER (side = 'right') AS r FROM articles_px WHERE story_id % 2 = 0 GROUP BY story_id) WHERE l IS NOT NULL AND r IS NOT NULL),
stand AS (SELECT c.*, a.outlet AS lo, b.outlet AS ro FROM cur c JOIN articles_px a ON a.id = c.cl AND a.story_id = c.story_id JOIN articles_px b ON b.id = c.cr AND b.story_id = c.story_id),
boosted AS (
  SELECT s.story_id, s.l, s.r, s.kind, s.featured_at,
    round(CASE WHEN s.opp THEN 3.0 ELSE 0 END + CASE WHEN s.dis THEN 1.5 ELSE 0 END + s.rest + CASE WHEN c.cl IS NOT NULL AND s.lo NOT IN (c.lo, c.ro) AND s.ro NOT IN (c.lo, c.ro) THEN 0.5 ELSE 0 END, 3) AS score
  FROM scored s LEFT JOIN stand c USING (story_id)),
""" + BEST_SQL.format(of="boosted") + """,
plan AS (
  SELECT s.id AS story_id, b.*  EXCLUDE (story_id), c.cl AS had, t.cl, t.cr, t.cs,
    CASE WHEN b.l IS NULL AND c.story_id IS NOT NULL THEN 'retired' WHEN b.l IS NULL THEN NULL
      WHEN t.cl IS NOT NULL AND ((least(t.cl, t.cr) = least(b.l, b.r) AND greatest(t.cl, t.cr) = greatest(b.l, b.r))
        OR NOT (b.score >= t.cs + 1.0 OR (b.featured_at - t.cf > INTERVAL 12 HOUR AND b.score >= t.cs - 0.5))) THEN 'kept'
      WHEN c.story_id IS NOT NULL THEN 'replaced' ELSE 'created' END AS action
  FROM stories_px s LEFT JOIN bp b ON b.story_id = s.id LEFT JOIN cur c ON c.story_id = s.id LEFT JOIN stand t ON t.story_id = s.id)"""


@query(sql("SELECT story_id, action, CASE WHEN action = 'kept' THEN cl WHEN action <> 'retired' THEN l END AS left_article_id, CASE WHEN action = 'kept' THEN cr WHEN action <> 'retired' THEN r END AS right_article_id, CASE WHEN action = 'kept' THEN cs WHEN action <> 'retired' THEN score END AS divergence_score FROM plan WHERE action IS NOT NULL", True, PAIR_SQL + ",\n" + CURRENT_SQL))
def pair_hysteresis(spark, d):
    s = stories(spark, d).withColumnRenamed("id", "story_id")
    return pairs.maintain(s, articles(spark, d), _px_pairs(spark, d), near="title").select("story_id", "action", "left_article_id", "right_article_id", "divergence_score")


@query(
    sql(
        "SELECT c.story_id, c.cl AS left_article_id, c.cr AS right_article_id, p.action = 'kept' AS is_current FROM cur c JOIN plan p USING (story_id) WHERE NOT (p.action = 'replaced' AND c.cl = p.l AND c.cr = p.r) "
        "UNION ALL SELECT story_id, l, r, true FROM plan WHERE action IN ('created', 'replaced')",
        True, PAIR_SQL + ",\n" + CURRENT_SQL,
    )
)
def pair_apply(spark, d):
    s = stories(spark, d).withColumnRenamed("id", "story_id")
    now = _px_pairs(spark, d)
    return pairs.apply(now, pairs.maintain(s, articles(spark, d), now, near="title")).select("story_id", "left_article_id", "right_article_id", "is_current")


@query(
    sql(
        "SELECT b.story_id, b.l AS left_article_id, b.r AS right_article_id, b.kind AS pair_kind, b.score AS divergence_score, b.lo AS left_outlet, b.ro AS right_outlet FROM bp b JOIN stories_px s ON s.id = b.story_id WHERE b.story_id % 4 <> 3",
        True, PAIR_SQL + ",\n" + BEST_SQL.format(of="scored"),
    )
)
def feed_refresh(spark, d):
    s = stories(spark, d).withColumnRenamed("id", "story_id").withColumn("status", F.when(F.col("story_id") % 4 == 3, "closed").otherwise("open")).select("story_id", "status", "last_seen")
    now = pairs.best(articles(spark, d), near="title").withColumn("is_current", F.lit(True))
    return Y.feed(s, now, articles(spark, d)).drop("last_seen")


@query(
    sql(
        """SELECT story_id, CASE WHEN story_id % 2 = 1 THEN title END AS title, CASE WHEN action <> 'kept' THEN NULL::VARCHAR END AS contrast
FROM (SELECT p.story_id, p.action, array_to_string(regexp_extract_all('Development: About story ' || p.story_id || ' Left piece, outlet: ' || a.outlet || ' Title: ' || a.title, '\\S+')[1:8], ' ') AS title
  FROM plan p JOIN articles_px a ON a.id = CASE WHEN p.action = 'kept' THEN p.cl ELSE p.l END WHERE p.action <> 'retired' AND (p.action <> 'kept' OR p.story_id % 2 = 1))""",
        True, PAIR_SQL + ",\n" + CURRENT_SQL,
    )
)
def pair_titles(spark, d):
    """Titles by the offline model for stories whose pair is new, or that no model has named yet."""
    s = stories(spark, d).withColumnRenamed("id", "story_id").withColumns({"summary": F.concat(F.lit("About story "), "story_id"), "title_source": F.when(F.col("story_id") % 2 == 0, "llm").otherwise("auto")})
    a = articles(spark, d)
    told = pairs.titles(s, a.withColumn("framing", F.lit(None).cast("string")), pairs.maintain(s, a, _px_pairs(spark, d), near="title"), models.OfflineModel)
    return told.select("story_id", "title", "contrast")


# ---- rechecks and reports -----------------------------------------------------------------------------------------------


def _members(spark, d):
    return articles(spark, d).withColumns({
        "rule": F.when(F.col("id") % 10 == 0, assign.RULE), "method": F.when(F.col("id") % 9 == 0, "create").otherwise("threshold"), "from_story": F.lit(None).cast("long"), "assigned_at": F.col("published_at"),
    })


def _founded(spark, d):
    f = Y.founders(articles(spark, d)).select(F.col("story_id").alias("id"), "founder_id")
    return stories(spark, d).join(f, "id", "left")


SUSPECT_SQL = """fo AS (SELECT story_id, arg_min(id, (CASE WHEN article_type IN ('news', 'live', 'explainer') AND NOT is_wire_copy THEN 0 ELSE 1 END, published_at, id)) AS founder_id FROM articles_px WHERE event_summary <> '' GROUP BY story_id),
sus AS (
  SELECT a.story_id, a.id, a.published_at, CASE WHEN a.published_at - s.first_seen > INTERVAL 12 HOUR THEN 'late' WHEN a.event_date > s.event_date THEN 'later_event_date' END AS reason
  FROM articles_px a JOIN stories_px s ON s.id = a.story_id LEFT JOIN fo ON fo.story_id = s.id WHERE s.article_count >= 2 AND a.id % 10 <> 0 AND a.id <> fo.founder_id QUALIFY reason IS NOT NULL)"""
_ANSWER = "(['same_development', 'follow_up', 'unrelated'])[1 + id % 3] AS relation, CAST(id % 21 AS DOUBLE) / 20 AS confidence"


@query(sql("SELECT story_id, id, reason FROM sus", True, SUSPECT_SQL.replace(" QUALIFY reason IS NOT NULL", " AND (a.published_at - s.first_seen > INTERVAL 12 HOUR OR a.event_date > s.event_date)")))
def recheck_suspects(spark, d):
    return recheck.suspects(_founded(spark, d), _members(spark, d)).select("story_id", "id", "reason")


@query(sql("SELECT story_id, id, reason FROM sus ORDER BY story_id, published_at, id LIMIT 40", True, SUSPECT_SQL.replace(" QUALIFY reason IS NOT NULL", " AND (a.published_at - s.first_seen > INTERVAL 12 HOUR OR a.event_date > s.event_date)")))
def recheck_capped(spark, d):
    return recheck.suspects(_founded(spark, d), _members(spark, d), most=40).select("story_id", "id", "reason")


@query(
    sql(
        "SELECT id, CASE WHEN len(axes) = 0 THEN ['coverage'] ELSE axes END AS axes, CASE WHEN id % 5 = 0 THEN array_to_string(regexp_extract_all('Outlet: ' || outlet || ' Headline: ' || title || ' Page title: ' || title || ' Subheadline: none', '[^ ]+')[1:8], ' ') ELSE 'told' END AS summary "
        "FROM (SELECT id, axes, outlet, CASE WHEN trim(regexp_replace(title, '\\s+', ' ', 'g')) = '' THEN 'none' ELSE trim(regexp_replace(title, '\\s+', ' ', 'g')) END AS title FROM articles_px WHERE published_at >= TIMESTAMP '2024-01-03 00:00:00' AND (len(axes) = 0 OR id % 5 = 0))"
    )
)
def framing_backfill(spark, d):
    stance = F.struct(F.col("axes").alias("framing_axes"), F.when(F.col("id") % 5 != 0, "told").alias("framing_summary"))
    none = F.lit(None).cast("string")
    rows = articles(spark, d).withColumns({"stance": stance, "enrichment_status": F.lit("done"), "headline": none, "subheadline": none, "body_text": F.col("text")})
    out = enrich.backfill_framing(enrich.framing_queue(rows, ntz("2024-01-03 00:00:00")))
    return out.select("id", F.col("stance.framing_axes").alias("axes"), F.col("stance.framing_summary").alias("summary"))


def _answers(spark, d):
    relation = F.element_at(F.array(F.lit("same_development"), F.lit("follow_up"), F.lit("unrelated")), (F.col("id") % 3 + 1).cast("int"))
    return articles(spark, d).select("id", F.col("story_id").alias("candidate_id"), relation.alias("relation"), ((F.col("id") % 21).cast("double") / 20).alias("confidence"))


@query(
    sql(
        f"SELECT id, CASE WHEN relation IN ('follow_up', 'unrelated') AND confidence >= 0.7 THEN 'detached' ELSE 'kept' END AS decision, CASE WHEN relation IN ('follow_up', 'unrelated') AND confidence >= 0.7 THEN NULL ELSE story_id END AS story_id "
        f"FROM (SELECT id, story_id, {_ANSWER} FROM sus)",
        True, SUSPECT_SQL.replace(" QUALIFY reason IS NOT NULL", " AND (a.published_at - s.first_seen > INTERVAL 12 HOUR OR a.event_date > s.event_date)"),
    )
)
def recheck_applied(spark, d):
    members = _members(spark, d)
    done = recheck.judged(recheck.suspects(_founded(spark, d), members), _answers(spark, d))
    return recheck.applied(members, done).join(done.select("id", "decision"), "id").select("id", "decision", "story_id")


@query(
    sql(
        f"SELECT s.story_id, 'Story ' || s.story_id AS story_title_before, 'Story ' || s.story_id AS story_anchor, s.id AS article_id, a.outlet, s.published_at, a.title AS headline, s.relation, printf('%.2f', s.confidence) AS confidence, "
        f"CASE WHEN relation IN ('follow_up', 'unrelated') AND s.confidence >= 0.7 THEN 'detached' ELSE 'kept' END AS decision, 'since ' || s.id AS reason FROM (SELECT id, story_id, published_at, {_ANSWER} FROM sus) s JOIN articles_px a USING (id)",
        True, SUSPECT_SQL.replace(" QUALIFY reason IS NOT NULL", " AND (a.published_at - s.first_seen > INTERVAL 12 HOUR OR a.event_date > s.event_date)"),
    )
)
def recheck_report(spark, d):
    members, found = _members(spark, d), _founded(spark, d)
    answers = _answers(spark, d).withColumn("reason", F.concat(F.lit("since\t"), "id"))
    return recheck.report(recheck.judged(recheck.suspects(found, members), answers), found, found, members)


@query(
    sql(
        "SELECT s.id, coalesce(s.id % 2 = 0 AND a.event_summary IS NOT NULL AND a.event_summary <> 'old summary', false) AS changed, CASE WHEN s.id % 2 = 0 AND a.event_summary IS NOT NULL THEN a.event_summary ELSE 'old summary' END AS summary "
        "FROM stories_px s LEFT JOIN fo ON fo.story_id = s.id LEFT JOIN articles_px a ON a.id = fo.founder_id",
        True, SUSPECT_SQL.split(",\nsus AS")[0],
    )
)
def reanchor(spark, d):
    s = stories(spark, d).withColumns({"title_source": F.when(F.col("id") % 2 == 0, "llm").otherwise("auto"), "summary": F.lit("old summary")})
    return recheck.reanchored(s, articles(spark, d)).select("id", "changed", "summary")


@query(sql(f"SELECT cut, count(*) FILTER (confidence >= cut) AS n FROM (SELECT {_ANSWER} FROM articles_px) x, (SELECT unnest([0.5, 0.6, 0.66, 0.7, 0.75, 0.8, 0.85, 0.9])::DOUBLE AS cut) c WHERE relation <> 'same_development' GROUP BY cut"))
def split_histogram(spark, d):
    return recheck.histogram(_answers(spark, d))


@query(sql(f"SELECT id, relation, confidence FROM (SELECT id, {_ANSWER} FROM articles_px) WHERE relation <> 'same_development' AND confidence >= 0.5 AND confidence < 0.85 ORDER BY confidence, id LIMIT 40"))
def borderline(spark, d):
    return recheck.borderline(_answers(spark, d)).select("id", "relation", "confidence")


@query(
    sql(
        "SELECT 'articles_total' AS measure, count(*) AS n FROM articles_px UNION ALL SELECT 'articles_' || CASE WHEN id % 4 = 0 THEN 'pending' ELSE 'done' END AS measure, count(*) AS n FROM articles_px GROUP BY 1 UNION ALL SELECT 'unassigned', count(*) FROM articles_px WHERE id % 4 <> 0 AND id % 3 = 0 AND id % 5 = 0 "
        "UNION ALL SELECT 'open_stories', count(*) FROM stories_px UNION ALL SELECT 'two_sided', count(*) FROM stories_px WHERE left_count >= 1 AND right_count >= 1 UNION ALL SELECT 'current_pairs', count(*) FROM cur",
        True, CURRENT_SQL.split(",\nstand AS")[0],
    )
)
def status_report(spark, d):
    rows = articles(spark, d).select(F.when(F.col("id") % 4 == 0, "pending").otherwise("done").alias("enrichment_status"), F.when(F.col("id") % 3 > 0, F.col("story_id")).alias("story_id"), F.when(F.col("id") % 5 > 0, F.col("published_at")).alias("assigned_at"))
    return reports.status(rows, stories(spark, d), _px_pairs(spark, d))


@query(
    """WITH e AS (
  SELECT source AS source_id, doc_id AS pos, CASE WHEN doc_id % 6 > 0 THEN TIMESTAMP '2024-01-01 00:00:00' + to_hours(CAST((doc_id * 7) % 700 AS BIGINT)) END AS published_at, length(text) AS body_chars,
    CASE WHEN doc_id % 2 = 0 THEN 'i' END AS page_image, doc_id % 11 = 0 AS wire_hint, row_number() OVER (PARTITION BY source ORDER BY doc_id) <= 3 AS s FROM documents),
g AS (
  SELECT source_id, count(*) AS entries, count(*) FILTER (published_at IS NULL OR published_at >= TIMESTAMP '2024-01-31 00:00:00' - INTERVAL 72 HOUR) AS fresh, count(published_at) AS dated,
    (epoch(max(published_at)) - epoch(min(published_at))) / 86400 AS span, count(*) FILTER (s) AS sampled, count(*) FILTER (s AND body_chars >= 500) AS body_ok, count(*) FILTER (s AND page_image IS NOT NULL) AS image_ok,
    count(*) FILTER (s AND published_at IS NOT NULL) AS date_ok, count(*) FILTER (s AND wire_hint) AS wire, count(*) FILTER (s AND pos % 8 = 0) AS redirected, list(body_chars ORDER BY body_chars) FILTER (s) AS l FROM e GROUP BY source_id)
SELECT source_id, entries, fresh, sampled, body_ok, image_ok, date_ok, wire, redirected, l[1 + len(l) // 2]::INT AS median_chars, CASE WHEN dated >= 2 THEN round(dated / greatest(span, 1.0 / 24), 1) END AS per_day,
  CASE WHEN sampled > 0 AND body_ok = 0 THEN 'NO_BODY' WHEN entries = 0 THEN 'EMPTY' ELSE 'ok' END AS status FROM g"""
)
def feed_audit(spark, d):
    rows = table(spark, d, "documents").select(
        F.col("source").alias("source_id"), F.col("doc_id").alias("pos"), F.expr("case when doc_id % 6 > 0 then timestampadd(HOUR, cast((doc_id * 7) % 700 as int), timestamp_ntz'2024-01-01 00:00:00') end").alias("published_at"),
        F.concat(F.lit("https://a.example/"), "doc_id").alias("link"), F.lit(None).cast("string").alias("image_url"), F.concat(F.lit("https://a.example/"), F.col("doc_id"), F.when(F.col("doc_id") % 8 == 0, "/b").otherwise("/")).alias("final_url"),
        F.length("text").alias("body_chars"), F.when(F.col("doc_id") % 2 == 0, "i").alias("page_image"), F.lit(None).cast("timestamp_ntz").alias("page_date"), (F.col("doc_id") % 11 == 0).alias("wire_hint"),
    )
    return reports.feed_audit(rows, ntz("2024-01-31 00:00:00"))


@query(
    sql(
        "SELECT kind, tp, fp, fn, tn, round(tp / nullif(tp + fp, 0), 6) AS precision, round(tp / nullif(tp + fn, 0), 6) AS recall FROM (SELECT (['same_story', 'hard_negative', 'opinion_attach', 'syndication'])[1 + a.id % 4] AS kind, "
        "count(*) FILTER (quality = 1 AND confidence >= 0.4) AS tp, count(*) FILTER (quality = 0 AND confidence >= 0.4) AS fp, count(*) FILTER (quality = 1 AND confidence < 0.4) AS fn, count(*) FILTER (quality = 0 AND confidence < 0.4) AS tn "
        "FROM articles_px a JOIN labels l ON l.doc_id = a.id GROUP BY 1)"
    )
)
def attach_precision_recall(spark, d):
    kinds = F.array(*[F.lit(k) for k in ("same_story", "hard_negative", "opinion_attach", "syndication")])
    rows = articles(spark, d).join(table(spark, d, "labels"), F.col("doc_id") == F.col("id")).select(F.element_at(kinds, (F.col("id") % 4 + 1).cast("int")).alias("kind"), (F.col("quality") == 1).alias("expected"), (F.col("confidence") >= 0.4).alias("predicted"))
    return reports.attach_quality(rows)
