"""Filter interaction audit: what each filter of a cascade removes, in every order of the filters, from one incidence matrix.

Every document gets a mask, one bit a filter that it fails.  What happens to it at a step of an order follows from the mask alone, so the corpus is read once
and counted by part, mask and label.  A part's counts are rows of 2 ** k numbers (all documents, good ones, toxic ones); multiplied by 0/1 matrices of 2 ** k rows and
k! * k columns they give each outcome at each step of each order: 32 by 600 for five filters.  All numbers are 64-bit integers.

The five filters of ``text_failures`` and ``masks``: A too few words, B too few distinct words, C too many capitals, D a forbidden character, E the text of a
smaller id.  E costs no join on texts: the least id of each digest is joined back on digest and id, so a text that a third of all rows share is one row a task in the aggregate, and
its rows are spread by id in the join.  Masks and digests are 60 bytes a row; labels are joined by id, where an id of very many rows is split by adaptive execution.

Defined results: a null text is an empty one (it fails A, and E if another empty text has a smaller id; 0 of 0 words is not too few distinct ones); rows with one id
and equal texts pass or fail E together; a null id neither fails E nor makes others fail it, and has no labels; of several labels of an id one is enough; an empty table gives an empty table; a part
has all its rows, zeros included; other columns are ignored, whatever their names; very long texts are read whole: their words are an array of one row.
"""

from __future__ import annotations

import itertools

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from .common import WORD, materialize

OUTCOMES = ("kept", "removed", "redundant", "unique_fails")
FIELDS = "part string, filter_order string, step int, kept long, removed long, redundant long, unique_fails long, good_lost long, toxic_lost long, shapley long"


def outcome_matrices(names: str) -> tuple[list[tuple[str, int]], dict[str, np.ndarray]]:
    """((order, step) of each column, matrix of each outcome) for filters of one letter each; bit i of a mask is letter i."""
    columns, masks = [], np.arange(1 << len(names))
    made: dict[str, list[np.ndarray]] = {x: [] for x in OUTCOMES}
    for order in itertools.permutations(range(len(names))):
        before = 0
        for step, letter in enumerate(order):
            bit = 1 << letter
            fails, gone = (masks & bit) > 0, (masks & before) > 0
            columns.append(("".join(names[i] for i in order), step + 1))
            for name, holds in zip(OUTCOMES, (~fails & ~gone, fails & ~gone, fails & gone, masks == bit)):
                made[name].append(holds)
            before |= bit
    return columns, {name: np.stack(x, axis=1).astype(np.int64) for name, x in made.items()}


def text_failures(text: Column, words: Column) -> dict[str, Column]:
    """Whether a text fails A to D; its words are given, so that they are cut once."""
    capitals = F.length(text) - F.length(F.regexp_replace(text, "[A-Z]+", ""))
    return {
        "A": F.size(words) < 100,
        "B": 100 * F.size(F.array_distinct(words)) < 80 * F.size(words),
        "C": 100 * capitals.cast("long") > 10 * F.length(text).cast("long"),
        "D": text.rlike(r"[#$%&*|]"),
    }


def masks(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", part_col: str = "lang") -> DataFrame:
    """(id, part, mask of A to D, digest) of every row, in one pass."""
    rows = docs.select(F.col(id_col).alias("id"), F.coalesce(F.col(part_col).cast("string"), F.lit("")).alias("part"), F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("text"))
    rows = rows.withColumn("words", F.regexp_extract_all("text", F.lit(WORD), F.lit(0)))
    mask = sum((F.when(fails, 1 << i).otherwise(0) for i, fails in enumerate(text_failures(F.col("text"), F.col("words")).values())), F.lit(0))
    return rows.select("id", "part", mask.alias("mask"), F.unhex(F.sha2(F.col("text").cast("binary"), 256)).alias("digest"))


def histogram(facts: DataFrame, labels: DataFrame, id_col: str = "doc_id") -> DataFrame:
    """(part, mask of A to E, n, good, toxic): at most 32 rows a part.  ``facts`` is a written table of ``masks``."""
    named = facts.where("id IS NOT NULL")
    flags = labels.where(F.col(id_col).isNotNull()).groupBy(F.col(id_col).alias("id")).agg(F.max(F.when(F.col("quality") == 1, 1).otherwise(0)).alias("good"), F.max(F.when(F.col("toxic") == 1, 1).otherwise(0)).alias("toxic"))
    least = named.groupBy("digest").agg(F.min("id").alias("id")).withColumn("is_first", F.lit(True))
    rows = named.join(flags, "id", "left").join(least, ["digest", "id"], "left").select(
        "part", (F.col("mask") + F.when(F.col("is_first"), 0).otherwise(16)).alias("mask"), F.coalesce("good", F.lit(0)).alias("good"), F.coalesce("toxic", F.lit(0)).alias("toxic"))
    rows = rows.unionByName(facts.where("id IS NULL").select("part", "mask", F.lit(0).alias("good"), F.lit(0).alias("toxic")))
    return rows.groupBy("part", "mask").agg(F.count(F.lit(1)).alias("n"), F.sum("good").cast("long").alias("good"), F.sum("toxic").cast("long").alias("toxic"))


def outcomes(counts: DataFrame, names: str = "ABCDE") -> DataFrame:
    """One row for each part, order and step, from (part, mask, n, good, toxic): the parts' rows are stacked and multiplied, a hundred at a time."""
    columns, matrix = outcome_matrices(names)
    width = len(columns)
    letter_at = np.array([names.index(order[step - 1]) for order, step in columns])
    of_letter = (letter_at[:, None] == np.arange(len(names))).astype(np.int64)

    def run(batches):
        for batch in batches:
            for begin in range(0, batch.num_rows, 100):
                rows = batch.slice(begin, 100).to_pylist()
                stack = np.zeros((3, len(rows), 1 << len(names)), np.int64)
                for i, row in enumerate(rows):
                    for x in row["counts"]:
                        stack[:, i, x["mask"]] = x["n"], x["good"], x["toxic"]
                found = {name: stack[0] @ m for name, m in matrix.items()}
                good, toxic = stack[1] @ matrix["removed"], stack[2] @ matrix["removed"]
                shapley = (found["removed"] @ of_letter)[:, letter_at]
                repeat = lambda values: [x for _ in rows for x in values]
                yield pa.RecordBatch.from_arrays([
                    pa.array([row["part"] for row in rows for _ in range(width)], pa.string()), pa.array(repeat([c[0] for c in columns]), pa.string()), pa.array(repeat([c[1] for c in columns]), pa.int32()),
                    *(pa.array(found[name].ravel()) for name in OUTCOMES), pa.array(good.ravel()), pa.array(toxic.ravel()), pa.array(shapley.ravel()),
                ], names=[f.split(" ")[0] for f in FIELDS.split(", ")])

    return counts.groupBy("part").agg(F.collect_list(F.struct("mask", "n", "good", "toxic")).alias("counts")).mapInArrow(run, FIELDS)


def audit(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", part_col: str = "lang") -> DataFrame:
    """The outcomes of filters A to E on whole texts, by part."""
    return outcomes(histogram(materialize(masks(docs, id_col, text_col, part_col), "masks"), labels, id_col))
