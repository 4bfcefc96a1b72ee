"""The registered queries of the training-data operators, and SQL for those that SQL can express."""

from __future__ import annotations

import os
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F

from . import collocations, compression_bands as bands, decontamination, exact_dedup, filter_audit, jaccard_join, language_id, packing, repeated_phrases, rule_ensemble, secrets, sharding, text_density
from .common import bounded_batches, fold, new_path


def tokenizer_path() -> str:
    """Where the public tokenizer's file lies: the parameter PLAIT_TOKENIZER, else the installed public vocabulary."""
    given = os.environ.get("PLAIT_TOKENIZER")
    if given:
        return given
    import public_tokenizers

    return public_tokenizers.path("word_bpe_49k.json")


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    bounded_batches(spark)
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_ngram_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard_join.jaccard_components(table(spark, sf_dir, "documents"))


def op2_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    model = language_id.fit(docs, where=fold("doc_id", 4) != 2)
    out = language_id.predict(docs, model)
    return out.select("doc_id", (fold("doc_id", 4) == 2).alias("held_out"), "lang_pred", "score", "margin", "rejected")


def op3_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = repeated_phrases.dedup_phrases(table(spark, sf_dir, "documents"))
    return out.select("doc_id", "n_words", "n_removed", F.sha2(F.col("kept").cast("binary"), 256).alias("kept_sha256"))


def op4_html_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = text_density.extract_main_text(table(spark, sf_dir, "pages"))
    return out.withColumn("n_chars", F.length("text").cast("long"))


def op5_secret_scans(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = secrets.scan_secrets(table(spark, sf_dir, "documents"))
    listed = lambda spans: F.array_join(F.transform(spans, lambda x: F.concat_ws(":", x["kind"], x["start"], x["end"])), ",")
    count = lambda kind: F.size(F.filter("spans", lambda x: x["kind"] == kind)).cast("long").alias(f"n_{kind}")
    base = F.filter("spans", lambda x: x["base"])
    live = F.size(F.filter("spans", lambda x: x["verdict"] == "live")).cast("long").alias("n_live")
    return found.select("doc_id", count("assign"), count("access"), count("hex"), F.sha2(listed(base).cast("binary"), 256).alias("base_sha256"), listed(F.col("spans")).alias("spans"), live)


def op6_benchmark_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontamination.contaminated(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"), unnamed=True)


def op7_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(table(spark, sf_dir, "documents"), tokenizer_path())


def op8_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = sharding.shuffle_shards(table(spark, sf_dir, "documents"))
    return out.select("doc_id", "size", "text_crc32", F.lit("key").alias("law"), "shard", "slot", "grown_shard")


def op9_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, labels = table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")
    model = rule_ensemble.fit(docs, labels, where=fold("doc_id", 5) != 0)
    return rule_ensemble.score(docs, model).select("doc_id", (fold("doc_id", 5) == 0).alias("held_out"), "score", "predicted")


def op10_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bands.compression_bands(table(spark, sf_dir, "documents"))


def op11_filter_interaction_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    return filter_audit.audit(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op12_phrase_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return collocations.collocations(table(spark, sf_dir, "documents"))


def op13_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return exact_dedup.deduplicate(docs, exact_dedup.index_for(docs, new_path(spark, "digests")))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f
    for f in (
        op1_ngram_jaccard_join, op2_language_id, op3_substring_dedup, op4_html_extraction, op5_secret_scans,
        op6_benchmark_decontamination, op7_packing, op8_sharding, op9_quality_classifier, op10_quality_rules,
        op11_filter_interaction_audit, op12_phrase_collocations, op13_exact_dedup,
    )
}

#: Words of a text as the contracts define them; translate lower-cases A-Z only.
_WORDS = r"regexp_extract_all({text}, '[^\x20\x09-\x0D]+')"
_LOWER = "translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"

SQL: dict[str, str] = {
    "op1_ngram_jaccard_join": f"""
WITH RECURSIVE w AS (SELECT doc_id, {_WORDS.format(text=_LOWER)} AS ws FROM documents WHERE text IS NOT NULL),
g AS (
  SELECT doc_id, unnest(CASE WHEN len(ws) >= 5 THEN list_transform(range(1, len(ws) - 3), lambda i: array_to_string(ws[i:i + 4], ' '))
                             WHEN len(ws) > 0 THEN [array_to_string(ws, ' ')] ELSE [] END) AS s FROM w),
sh AS (SELECT DISTINCT doc_id, hash(s) AS s FROM g),
n AS (SELECT doc_id, count(*) AS n FROM sh GROUP BY doc_id),
p AS (SELECT a.doc_id AS x, b.doc_id AS y, count(*) AS c FROM sh a JOIN sh b ON a.s = b.s AND a.doc_id < b.doc_id GROUP BY 1, 2),
l AS (SELECT x, y FROM p JOIN n a ON a.doc_id = x JOIN n b ON b.doc_id = y WHERE 100 * c >= 80 * (a.n + b.n - c)),
e AS (SELECT x, y FROM l UNION ALL SELECT y, x FROM l),
r(doc_id, seen) AS (SELECT doc_id, doc_id FROM documents UNION SELECT r.doc_id, e.y FROM r JOIN e ON e.x = r.seen)
SELECT d.doc_id, coalesce(n.n, 0)::BIGINT AS n_shingles, m.component_id
FROM documents d LEFT JOIN n USING (doc_id) JOIN (SELECT doc_id, min(seen) AS component_id FROM r GROUP BY doc_id) m USING (doc_id)
""",
    "op3_substring_dedup": f"""
WITH w AS (SELECT doc_id, {_WORDS.format(text="coalesce(text, '')")} AS ws FROM documents),
x AS (SELECT doc_id, unnest(range(1, len(ws) - 33)) AS i, ws FROM w WHERE len(ws) >= 35),
h AS (SELECT doc_id, i, sha256(array_to_string(ws[i:i + 34], ' ')) AS k FROM x),
c AS (SELECT k FROM h GROUP BY k HAVING count(*) > 1),
gone AS (SELECT DISTINCT doc_id, unnest(range(i, i + 35)) AS j FROM h JOIN c USING (k)),
t AS (SELECT doc_id, unnest(range(1, len(ws) + 1)) AS j, unnest(ws) AS word FROM w),
k AS (
  SELECT t.doc_id, string_agg(t.word, ' ' ORDER BY t.j) AS kept, count(*) AS n FROM t LEFT JOIN gone g ON g.doc_id = t.doc_id AND g.j = t.j
  WHERE g.j IS NULL GROUP BY t.doc_id)
SELECT w.doc_id, len(ws)::BIGINT AS n_words, (len(ws) - coalesce(k.n, 0))::BIGINT AS n_removed, sha256(coalesce(k.kept, '')) AS kept_sha256
FROM w LEFT JOIN k USING (doc_id)
""",
    "op11_filter_interaction_audit": f"""
WITH RECURSIVE w AS (SELECT doc_id, coalesce(lang, '') AS part, coalesce(text, '') AS text, {_WORDS.format(text="coalesce(text, '')")} AS ws FROM documents),
f AS (
  SELECT doc_id, part, [CASE WHEN len(ws) < 100 THEN 'A' END, CASE WHEN 100 * len(list_distinct(ws)) < 80 * len(ws) THEN 'B' END,
    CASE WHEN 100 * len(regexp_replace(text, '[^A-Z]', '', 'g')) > 10 * length(text) THEN 'C' END, CASE WHEN regexp_matches(text, '[#$%&*|]') THEN 'D' END,
    CASE WHEN min(doc_id) OVER (PARTITION BY text) < doc_id THEN 'E' END] AS fails,
    coalesce((SELECT max(CASE WHEN quality = 1 THEN 1 ELSE 0 END) FROM labels l WHERE l.doc_id = w.doc_id), 0) AS good,
    coalesce((SELECT max(CASE WHEN toxic = 1 THEN 1 ELSE 0 END) FROM labels l WHERE l.doc_id = w.doc_id), 0) AS toxic FROM w),
h AS (SELECT part, list_filter(fails, lambda x: x IS NOT NULL) AS fails, count(*) AS n, sum(good) AS good, sum(toxic) AS toxic FROM f GROUP BY 1, 2),
o(filter_order) AS (SELECT '' UNION ALL SELECT filter_order || x FROM o, (SELECT unnest(['A', 'B', 'C', 'D', 'E']) AS x) WHERE NOT contains(filter_order, x)),
s AS (SELECT filter_order, step::INTEGER AS step, filter_order[step] AS letter, string_split(filter_order[1:step - 1], '') AS before FROM o, (SELECT unnest(range(1, 6)) AS step) WHERE len(filter_order) = 5),
r AS (
  SELECT part, filter_order, step, letter,
    coalesce(sum(n) FILTER (NOT list_contains(fails, letter) AND NOT list_has_any(fails, before)), 0)::BIGINT AS kept,
    coalesce(sum(n) FILTER (list_contains(fails, letter) AND NOT list_has_any(fails, before)), 0)::BIGINT AS removed,
    coalesce(sum(n) FILTER (list_contains(fails, letter) AND list_has_any(fails, before)), 0)::BIGINT AS redundant,
    coalesce(sum(n) FILTER (fails = [letter]), 0)::BIGINT AS unique_fails,
    coalesce(sum(good) FILTER (list_contains(fails, letter) AND NOT list_has_any(fails, before)), 0)::BIGINT AS good_lost,
    coalesce(sum(toxic) FILTER (list_contains(fails, letter) AND NOT list_has_any(fails, before)), 0)::BIGINT AS toxic_lost
  FROM h, s GROUP BY ALL)
SELECT part, filter_order, step, kept, removed, redundant, unique_fails, good_lost, toxic_lost, (sum(removed) OVER (PARTITION BY part, letter))::BIGINT AS shapley FROM r
""",
    "op12_phrase_collocations": f"""
WITH d AS (SELECT row_number() OVER () AS d, coalesce(lang, 'und') AS lang, regexp_split_to_array({_LOWER.replace("text", "coalesce(text, '')")}, '[.,;:!?\\x0A-\\x0D]') AS ps FROM documents),
p AS (SELECT lang, regexp_extract_all(unnest(ps), '[^\\x20\\x09]+') AS ws FROM d),
g AS (SELECT lang, k, unnest(list_transform(range(1, len(ws) - k + 2), lambda i: array_to_string(ws[i:i + k - 1], ' '))) AS phrase FROM p, (SELECT unnest([1, 2, 3]) AS k) WHERE len(ws) >= k),
c AS (SELECT lang, k, phrase, count(*) AS a FROM g GROUP BY ALL),
t AS (SELECT lang, sum(a)::BIGINT AS n FROM c WHERE k = 1 GROUP BY lang),
x AS (SELECT lang, k, phrase, string_split(phrase, ' ') AS ws, a FROM c WHERE k > 1 AND a >= 10),
cut AS (SELECT lang, k, phrase, a, j, array_to_string(ws[1:j], ' ') AS p1, array_to_string(ws[j + 1:], ' ') AS p2 FROM x, (SELECT unnest([1, 2]) AS j) WHERE j < k),
sc AS (
  SELECT cut.lang, cut.k, cut.phrase, cut.a, cut.j, l.a AS l, r.a AS r, (1000000::HUGEINT * cut.a * cut.a // (l.a::HUGEINT * r.a))::BIGINT AS score
  FROM cut JOIN c l ON l.lang = cut.lang AND l.phrase = cut.p1 JOIN c r ON r.lang = cut.lang AND r.phrase = cut.p2),
low AS (SELECT * FROM sc QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, j) = 1),
i AS (SELECT lang, unnest([array_to_string(ws[1:2], ' '), array_to_string(ws[2:3], ' ')]) AS phrase, a FROM x WHERE k = 3),
m AS (SELECT lang, phrase, max(a) AS a FROM i GROUP BY ALL),
kept AS (SELECT low.* FROM low LEFT JOIN m ON m.lang = low.lang AND m.phrase = low.phrase WHERE m.a IS NULL OR 100 * m.a < 50 * low.a),
ranked AS (SELECT lang, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank, phrase, a, l, r, score FROM kept)
SELECT ranked.lang, rank, phrase, a, l, r, n, score FROM ranked JOIN t ON t.lang = ranked.lang WHERE rank <= 2000
""",
    "op13_exact_dedup": f"""
WITH t AS (SELECT doc_id, sha256({_LOWER.replace("text", "coalesce(text, '')")}) AS text_sha256 FROM documents),
k AS (SELECT text_sha256, max(doc_id) AS keep_id, count(*) AS group_size FROM t GROUP BY text_sha256)
SELECT doc_id, keep_id, group_size, doc_id = keep_id AS kept, text_sha256 FROM t JOIN k USING (text_sha256)
""",
}
