"""From raw documents to packed sequences: quality, near duplicates, benchmark leaks, secrets, packing.

Each stage takes (spark, docs, sf_dir), works on all that its predecessor kept and returns the columns of documents,
except the last, which returns packed pieces.  ``run`` writes each stage's rows to the shared folder and reads them again.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from plait.llm import decontamination, jaccard_join, packing, rule_ensemble, secrets
from plait.llm.common import bounded_batches, discard, fold, materialize, scratch
from plait.llm.queries import table, tokenizer_path

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


def _numbered(docs: DataFrame) -> DataFrame:
    """The columns of documents with a key of the row's own, so that repeated and null ids stay apart."""
    return docs.select(*COLUMNS, secrets.row_key(*COLUMNS).alias("__row"))


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops what the classifier rejects.  The rows pass through the scan with all their columns, so nothing is joined."""
    model = rule_ensemble.fit(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"), where=fold("doc_id", 5) != 0)
    return rule_ensemble.score(docs, model, tuple(COLUMNS)).where("predicted = 1").select(*COLUMNS)


def _own_numbers(docs: DataFrame) -> tuple[DataFrame, DataFrame]:
    """The columns of documents with a number ``__id`` of the row's values, and the table of (__id, doc_id, n), how often the row stands.  Equal rows share a
    number, different ones never do: hashes are drawn with another seed until none agree."""
    flags = F.concat(*[F.col(c).isNull().cast("int").cast("string") for c in COLUMNS])
    exact = F.concat(flags, *[F.concat(F.length(c := F.coalesce(F.col(name).cast("string"), F.lit(""))), F.lit(":"), c) for name in COLUMNS])
    for seed in range(9):
        rows = docs.select(*COLUMNS, F.xxhash64(F.lit(seed), flags, *COLUMNS).alias("__id"))
        known = materialize(rows.groupBy("__id", "doc_id", F.md5(exact).alias("__key")).agg(F.count(F.lit(1)).alias("n")), "numbers")
        if known.groupBy("__id").count().where("count > 1").isEmpty():
            return rows, known.select("__id", "doc_id", "n")
    raise RuntimeError("rows could not be told apart")


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps one row of each component, one of the least id (null ids come last), and one of fully equal rows.  Rows are
    compared and dropped by numbers of their own, so rows with one id and different texts are documents of their own.

    What goes and what stands more than once are written tables, whose size decides how they are joined: while they are small, no text moves."""
    bounded_batches(spark)
    rows, known = _own_numbers(docs)
    linked = jaccard_join.jaccard_components(rows, id_col="__id").where("n_shingles > 0").select("__id", "component_id").distinct()
    linked = materialize(linked.join(known.drop("n"), "__id"), "linked")
    kept = linked.groupBy("component_id").agg(F.min(F.struct(F.col("doc_id").isNull(), "doc_id", "__id"))["__id"].alias("__id"))
    gone = materialize(linked.join(kept, "__id", "left_anti").select("__id"), "gone")
    several = materialize(known.where("n > 1").select("__id"), "several")
    left = rows.join(gone, "__id", "left_anti")
    once = left.join(several, "__id", "left_semi").groupBy("__id").agg(F.first(F.struct(*COLUMNS)).alias("d")).select("d.*")
    return left.join(several, "__id", "left_anti").select(*COLUMNS).unionByName(once)


def benchmark_leaks(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops every document that holds a benchmark item.  The rows found are a written table, whose size decides how it is joined."""
    found = decontamination.contaminated(_numbered(docs), table(spark, sf_dir, "benchmark"), id_col="__row", unnamed=True).select("__row").distinct()
    return _numbered(docs).join(materialize(found, "leaks"), "__row", "left_anti").select(*COLUMNS)


def secret_spans(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Replaces every reported span by a mark of its kind; n_chars follows the text.  Texts pass through the scan and are not joined again."""
    bounded_batches(spark)
    out = secrets.redacted(docs.select(*COLUMNS))
    return out.withColumn("n_chars", F.when(F.col("__redacted"), F.length("text").cast(docs.schema["n_chars"].dataType)).otherwise(F.col("n_chars"))).select(*COLUMNS)


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Packs what is left into sequences of at most 4096 tokens."""
    bounded_batches(spark)
    return packing.pack(docs, tokenizer_path())


STAGES = [
    ("quality_classifier", quality),
    ("ngram_jaccard_join", near_duplicates),
    ("benchmark_decontamination", benchmark_leaks),
    ("secret_scans", secret_spans),
    ("packing", packed),
]

#: A fitted classifier, tokenizer ids and packing are beyond SQL; tests hold the stages against brute-force versions.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stages, each written to the shared folder; what a stage made on its way, and its input, go once it is written."""
    docs = table(spark, sf_dir, "documents")
    for n, (name, stage) in enumerate(STAGES):
        with scratch(spark) as keep:
            out = materialize(stage(spark, docs, sf_dir), name)
            keep(out)
        if n:
            discard(docs)
        docs = out
    return docs
