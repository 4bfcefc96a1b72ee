"""Stand-ins for news tables, derived from the synthetic tables: the same definitions for Spark and, as SQL, for the oracle.

Articles are documents with an embedding; stories are the embeddings' labels; feed entries are pages.  The vectors are nearly
random, so queries that compare similarities use thresholds of their own (PX).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from ..config import Config
from ..functions.scoring import side_of
from ..operators import stories as S

PX = Config(attach_threshold=0.30, verify_threshold=0.20, merge_min_similarity=0.20, merge_max_event_gap_days=3)


def ntz(text: str) -> Column:
    return F.expr(f"timestamp_ntz'{text}'")


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _pick(index: str, values: tuple) -> str:
    return f"element_at(array({', '.join('cast(null as string)' if v is None else repr(v) for v in values)}), cast({index} as int) + 1)"


LEANINGS = ("LEFT", "LEAN_LEFT", "CENTER", "LEAN_RIGHT", "RIGHT")
TYPES = ("news", "live", "explainer", "opinion", "analysis", "roundup", "other")
DIRECTIONS = ("supports", "opposes", "critical_of_left", "critical_of_right", "neutral", None)
LABELS = ("LEFT", "RIGHT", "CENTER", None, None, None, None, None, None)
AXES = ("array()", "array('economy')", "array('economy', 'rights')", "array('security')")


def articles(spark: SparkSession, sf_dir: str) -> DataFrame:
    d, e = table(spark, sf_dir, "documents"), table(spark, sf_dir, "embeddings")
    rows = d.join(e, d["doc_id"] == e["vec_id"]).selectExpr(
        "doc_id as id", "source as outlet", "text", _pick("cast(regexp_extract(source, '[0-9]+', 0) as int) % 5", LEANINGS) + " as outlet_leaning",
        "substring(split_part(text, '\\n', 1), 1, 120) as title", "substring(text, 1, 400) as snippet",
        "timestampadd(MINUTE, cast((doc_id % 400) * 20 as int), timestamp_ntz'2024-01-01 00:00:00') as published_at",
        _pick("doc_id % 7", TYPES) + " as article_type", "doc_id % 11 = 0 as is_wire_copy",
        "array_distinct(array(concat('Label ', label), concat('Third ', doc_id % 3), concat('Fifth ', doc_id % 5))) as key_entities",
        _pick("doc_id % 6", DIRECTIONS) + " as direction", f"case doc_id % 4 when 0 then cast(array() as array<string>) when 1 then {AXES[1]} when 2 then {AXES[2]} else {AXES[3]} end as axes",
        "cast(doc_id % 10 as double) / 10 as confidence", _pick("doc_id % 9", LABELS) + " as leaning_label", "cast(doc_id % 10 as double) / 10 as leaning_conf",
        "case when doc_id % 3 > 0 then concat('https://img.example/', doc_id) end as image_url", "cast(label as long) as story_id", "cast(embedding as array<double>) as vector",
    )
    rows = rows.withColumn("event_date", F.when(F.col("id") % 4 != 0, F.to_date("published_at"))).withColumn("event_summary", F.when(F.col("id") % 13 != 0, F.col("title")))
    return rows.withColumn("side", side_of(F.col("leaning_label"), F.col("leaning_conf"), F.col("outlet_leaning")))


def stories(spark: SparkSession, sf_dir: str) -> DataFrame:
    a = articles(spark, sf_dir)
    rows = S.rollup(a).join(S.mean_centroids(a, 64), "story_id")
    return rows.withColumnRenamed("story_id", "id").withColumn("status", F.lit("open")).withColumn("title", F.concat(F.lit("Story "), "id"))


def _duck(index: str, values: tuple) -> str:
    return f"([{', '.join('NULL' if v is None else repr(v) for v in values)}])[1 + ({index})]"


ARTICLES_SQL = f"""a0 AS (
  SELECT d.doc_id AS id, d.source AS outlet, d.text, {_duck("CAST(regexp_extract(d.source, '[0-9]+') AS BIGINT) % 5", LEANINGS)} AS outlet_leaning,
    substr(split_part(d.text, chr(10), 1), 1, 120) AS title, substr(d.text, 1, 400) AS snippet,
    TIMESTAMP '2024-01-01 00:00:00' + to_minutes(CAST((d.doc_id % 400) * 20 AS BIGINT)) AS published_at,
    {_duck("d.doc_id % 7", TYPES)} AS article_type, d.doc_id % 11 = 0 AS is_wire_copy,
    ['Label ' || e.label, 'Third ' || (d.doc_id % 3), 'Fifth ' || (d.doc_id % 5)] AS key_entities,
    {_duck("d.doc_id % 6", DIRECTIONS)} AS direction,
    CASE d.doc_id % 4 WHEN 0 THEN CAST([] AS VARCHAR[]) WHEN 1 THEN ['economy'] WHEN 2 THEN ['economy', 'rights'] ELSE ['security'] END AS axes,
    CAST(d.doc_id % 10 AS DOUBLE) / 10 AS confidence, {_duck("d.doc_id % 9", LABELS)} AS leaning_label, CAST(d.doc_id % 10 AS DOUBLE) / 10 AS leaning_conf,
    CASE WHEN d.doc_id % 3 > 0 THEN 'https://img.example/' || d.doc_id END AS image_url, CAST(e.label AS BIGINT) AS story_id, CAST(e.embedding AS DOUBLE[]) AS vector
  FROM documents d JOIN embeddings e ON d.doc_id = e.vec_id),
articles_px AS (
  SELECT *, CASE WHEN id % 4 <> 0 THEN CAST(published_at AS DATE) END AS event_date, CASE WHEN id % 13 <> 0 THEN title END AS event_summary,
    CASE WHEN leaning_label IN ('LEFT', 'RIGHT') AND leaning_conf >= 0.6 THEN lower(leaning_label)
         WHEN outlet_leaning IN ('LEFT', 'LEAN_LEFT') THEN 'left' WHEN outlet_leaning = 'CENTER' THEN 'center' WHEN outlet_leaning IN ('LEAN_RIGHT', 'RIGHT') THEN 'right' END AS side
  FROM a0)"""

STORIES_SQL = """s_base AS (
  SELECT story_id, count(*) AS article_count, count(*) FILTER (side = 'left') AS left_count, count(*) FILTER (side = 'right') AS right_count,
    count(*) FILTER (side = 'center') AS center_count, min(published_at) AS first_seen, max(published_at) AS last_seen,
    arg_min(event_date, (published_at, id)) FILTER (event_date IS NOT NULL) AS event_date
  FROM articles_px GROUP BY story_id),
s_names AS (SELECT story_id, published_at, id, unnest(key_entities) AS name, unnest(range(len(key_entities))) AS pos FROM articles_px),
s_first AS (SELECT story_id, name, min((published_at, id, pos)) AS fst FROM s_names GROUP BY ALL),
s_list AS (SELECT story_id, list(name ORDER BY fst, name)[1:24] AS key_entities FROM s_first GROUP BY story_id),
s_dim AS (SELECT story_id, unnest(vector) AS v, unnest(range(len(vector))) AS i FROM articles_px),
s_mean AS (SELECT story_id, i, avg(v) AS m FROM s_dim GROUP BY ALL),
s_cent AS (SELECT story_id, list(m / l ORDER BY i) AS centroid FROM (SELECT *, sqrt(sum(m * m) OVER (PARTITION BY story_id)) AS l FROM s_mean) GROUP BY story_id),
stories_px AS (
  SELECT b.story_id AS id, b.* EXCLUDE (story_id), n.key_entities, c.centroid, 'open' AS status, 'Story ' || b.story_id AS title
  FROM s_base b JOIN s_list n USING (story_id) JOIN s_cent c USING (story_id))"""


def sql(body: str, stories: bool = False, more: str = "") -> str:
    """A query over the stand-ins; ``more`` are further common table expressions."""
    return f"WITH {ARTICLES_SQL}" + (f",\n{STORIES_SQL}" if stories else "") + (f",\n{more}" if more else "") + f"\n{body}"
