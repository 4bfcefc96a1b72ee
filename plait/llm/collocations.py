"""Phrase collocation mining by Apriori passes over the levels: words, pairs of words, runs of three.

Pass k reads the texts once more and counts runs of k words within pieces of text, but only those of which both runs of k - 1 words are frequent (``least`` occurrences in
the language).  The frequent runs of the last level reach the tasks as a broadcast bit table, one bit a run at its hash, built by Spark's bitmap aggregates: 16 bits a run and at most
``MOST_BITS`` altogether (32 MB), so its size is bounded whatever the vocabulary.  Where two runs share a bit a rare run is counted in vain and dropped by its count; no frequent one is ever missed.

A task interns words with Arrow dictionaries and counts runs as pairs of integers, so what is counted is the run itself and not a hash, and each piece of some megabytes sends one row for
each run that it has.  Spark adds them up by (lang, phrase), with partial sums, so a word that every document holds is one row a task.  Level tables are written; candidates are scored by
joining their first and last parts with them, where words that begin or end very many phrases meet a broadcast table of at most 1,000 rows (``lookup``).  Counts are exact; products of three counts
are decimals of 38 digits, which holds up to 10 ** 15 occurrences.

Defined results: a null text has no words; a null language is ``und`` and counts together with a language of that name; rows that stand several times count each time; equal scores go by count, then by
the phrase's bytes; an empty table, or one without frequent phrases, gives an empty table; other columns are ignored, whatever their names; texts of any length are read whole.
"""

from __future__ import annotations

from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F

from .common import lookup, materialize, release
from .words import Words, mix, slices, span_hashes, text_bytes

_BREAK = np.zeros(256, dtype=bool)
_BREAK[list(b".,;:!?\n\x0b\x0c\r")] = True
_GAP = _BREAK.copy()
_GAP[[0x20, 0x09]] = True
COUNTS = "lang string, phrase string, n long"
#: Bits of a table of frequent runs.
LEAST_BITS, MOST_BITS = 1 << 16, 1 << 28
#: Bits that one of Spark's bitmaps holds.
_BITMAP = 32768


def _joined(left: np.ndarray, word: np.ndarray) -> np.ndarray:
    """Hashes of runs that are one word longer."""
    return mix(left * np.uint64(0xD6E8FEB86659FD93) + word)


def _strings(words: Words) -> pa.Array:
    """The words as strings: all bytes but those that part them, one word after the other."""
    offsets = np.zeros(len(words) + 1, np.int64)
    np.cumsum(words.end - words.start, out=offsets[1:])
    return pa.Array.from_buffers(pa.large_string(), len(words), [None, pa.py_buffer(offsets), pa.py_buffer(words.raw[~_GAP[words.raw]])])


def _lang_hashes(langs: pa.Array) -> np.ndarray:
    raw, at = text_bytes(langs)
    return np.array([span_hashes(raw[a:b], np.array([0]), np.array([b - a]))[0] for a, b in zip(at[:-1], at[1:])], np.uint64) if len(langs) else np.zeros(0, np.uint64)


class Runs:
    """The words of some texts by number, equal numbers for equal words of one language, and which words follow each other in a piece."""

    def __init__(self, langs: pa.Array, texts: pa.Array):
        words = Words(texts, lower=True, gaps=_GAP)
        spoken = langs.dictionary_encode()
        coded = _strings(words).dictionary_encode()
        many = max(1, len(coded.dictionary))
        text = np.repeat(np.arange(len(texts)), words.counts)
        both = spoken.indices.to_numpy()[text].astype(np.int64) * many + coded.indices.to_numpy()
        known, self.word, self.counts = np.unique(both, return_inverse=True, return_counts=True)
        self.langs = spoken.dictionary.take(pa.array(known // many)).cast(pa.string())
        self.words = coded.dictionary.take(pa.array(known % many))
        raw, at = text_bytes(coded.dictionary)
        self.code = _joined(_lang_hashes(spoken.dictionary)[known // many], span_hashes(raw, at[:-1], at[1:])[known % many])
        breaks = np.flatnonzero(_BREAK[words.raw])
        piece = np.searchsorted(breaks, words.start)
        self.follows = (piece[1:] == piece[:-1]) & (text[1:] == text[:-1])

    def level(self, k: int, bits: np.ndarray | None) -> tuple[list[np.ndarray], np.ndarray]:
        """(the words of each distinct run of k, by number, and how often it occurs) of which both shorter runs have their bit."""
        if k == 1:
            return [np.arange(len(self.counts))], self.counts
        n = len(self.word)
        code, at = self.code[self.word], np.ones(n, bool)  # at i: the run that begins there, and whether it lies within a piece
        for j in range(1, k - 1):
            at = at[:-1] & self.follows[j - 1 :]
            code = _joined(code[:-1], self.code[self.word[j:]])
        at = at & has(bits, code)
        at = np.flatnonzero(at[:-1] & at[1:] & self.follows[k - 2 :])
        parts, run = [self.word[at]], self.word[at]
        for j in range(1, k):
            word = self.word[at + j]
            _, first, run, counts = np.unique((run << 32) | word, return_index=True, return_inverse=True, return_counts=True)
            parts = [*parts, word]
        return [p[first] for p in parts], counts

    def table(self, k: int, bits: np.ndarray | None) -> pa.RecordBatch:
        parts, counts = self.level(k, bits)
        phrase = self.words.take(pa.array(parts[0]))
        for p in parts[1:]:
            phrase = pa.compute.binary_join_element_wise(phrase, self.words.take(pa.array(p)), pa.scalar(" ", pa.large_string()))
        return pa.RecordBatch.from_arrays([self.langs.take(pa.array(parts[0])), phrase.cast(pa.string()), pa.array(counts.astype(np.int64))], names=["lang", "phrase", "n"])


def has(bits: np.ndarray, codes: np.ndarray) -> np.ndarray:
    """Whether the bit of each hash is set."""
    at = codes >> np.uint64(65 - (len(bits) * 8).bit_length())
    return (bits[at >> np.uint64(3)] >> (at & np.uint64(7)).astype(np.uint8)) & 1 > 0


def bit_table(frequent: DataFrame) -> np.ndarray:
    """One bit for each run of (lang, phrase): at most ``MOST_BITS`` bits, whatever the number of runs."""
    size = LEAST_BITS
    runs = frequent.count()
    while size < min(16 * runs, MOST_BITS):
        size *= 2
    shift = 65 - size.bit_length()

    def places(batches):
        for batch in batches:
            spoken = batch.column(0).dictionary_encode()
            words = Words(batch.column(1))
            if not len(words):
                continue
            hashes, first, size = words.hashes(), words.first[:-1], words.counts
            lang = _lang_hashes(spoken.dictionary)[spoken.indices.to_numpy()]
            code = _joined(lang, hashes[first])
            for j in range(1, int(size[0])):  # runs of one table are equally long
                code = _joined(code, _joined(lang, hashes[first + j]))
            yield pa.RecordBatch.from_arrays([pa.array((code >> np.uint64(shift)).astype(np.int64))], names=["at"])

    marked = frequent.select("lang", "phrase").mapInArrow(places, "at long")
    maps = marked.groupBy((F.col("at") / _BITMAP).cast("long").alias("map")).agg(F.bitmap_construct_agg(F.col("at") % _BITMAP).alias("bits"))
    out = np.zeros(size // 8, np.uint8)
    for row in maps.collect():  # at most MOST_BITS / 32768 rows of 4 KB
        out[row["map"] * _BITMAP // 8 :][: _BITMAP // 8] = np.frombuffer(row["bits"], np.uint8)
    return out


def _texts(docs: DataFrame, text_col: str, lang_col: str) -> DataFrame:
    return docs.select(F.coalesce(F.col(lang_col).cast("string"), F.lit("und")).alias("lang"), F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("text"))


def count_level(texts: DataFrame, k: int, shared=None, limit: int = 4 << 20) -> DataFrame:
    """(lang, phrase, n) of runs of k words over all texts; ``shared`` is the broadcast bit table of the level below."""

    def run(batches):
        release()
        bits = np.frombuffer(shared.value, np.uint8) if shared else None
        for batch in batches:
            for row, piece in slices(batch.column(1), limit):
                yield Runs(batch.column(0).slice(row, len(piece)), piece).table(k, bits)
        release()

    return texts.mapInArrow(run, COUNTS).groupBy("lang", "phrase").agg(F.sum("n").alias("n"))


def levels(docs: DataFrame, longest: int, least: int, text_col: str = "text", lang_col: str = "lang") -> tuple[list[DataFrame], DataFrame]:
    """(the written tables (lang, phrase, n) of frequent runs of 1, 2, ... words, the number of words of each language)."""
    spark: SparkSession = docs.sparkSession
    texts, out, totals, shared = _texts(docs, text_col, lang_col), [], None, None
    for k in range(1, longest + 1):
        counted = count_level(texts, k, shared)
        if k == 1:
            words = materialize(counted, "words")
            totals = materialize(words.groupBy("lang").agg(F.sum("n").alias("n_words")), "totals")
            counted = words
        out.append(materialize(counted.where(F.col("n") >= least), f"level{k}"))
        if shared:
            shared.unpersist()
        if k < longest:
            shared = spark.sparkContext.broadcast(bit_table(out[-1]).tobytes())
    return out, totals


def _part(first: bool, words: int) -> Column:
    return F.substring_index("phrase", " ", words if first else -words)


def scored(tables: list[DataFrame], k: int) -> DataFrame:
    """(lang, phrase, a, l, r, score) of the runs of k words, by the cut of the lowest score."""
    rows = tables[k - 1].withColumnRenamed("n", "a")
    for cut in range(1, k):
        for name, words, first in (("l", cut, True), ("r", k - cut, False)):
            rows = materialize(rows.withColumn(f"{name}_part", _part(first, words)), "parts")
            known = tables[words - 1].select("lang", F.col("phrase").alias(f"{name}_part"), F.col("n").alias(f"{name}{cut}"))
            rows = lookup(rows, known, ["lang", f"{name}_part"]).drop(f"{name}_part")
    cuts = [F.struct(F.expr(f"(CAST(1000000 AS DECIMAL(7,0)) * (CAST(a AS DECIMAL(15,0)) * CAST(a AS DECIMAL(15,0)))) div (CAST(l{c} AS DECIMAL(15,0)) * CAST(r{c} AS DECIMAL(15,0)))").alias("score"), F.lit(c).alias("cut"), F.col(f"l{c}").alias("l"), F.col(f"r{c}").alias("r")) for c in range(1, k)]
    return rows.withColumn("best", F.array_min(F.array(*cuts))).select("lang", "phrase", "a", "best.l", "best.r", "best.score")


def within_longer(tables: list[DataFrame], k: int, percent: int) -> DataFrame:
    """(lang, phrase) of runs of k words that a longer frequent run contains and that occur in it so often, per cent."""
    inner = []
    for longer in range(k + 1, len(tables) + 1):
        words = F.split("phrase", " ")
        starts = [F.array_join(F.slice(words, i + 1, k), " ") for i in range(longer - k + 1)]
        inner.append(tables[longer - 1].select("lang", F.explode(F.array(*starts)).alias("phrase"), "n"))
    most = reduce(DataFrame.unionByName, inner).groupBy("lang", "phrase").agg(F.max("n").alias("longer"))
    return most.join(tables[k - 1], ["lang", "phrase"]).where(F.lit(100) * F.col("longer") >= F.lit(percent) * F.col("n")).select("lang", "phrase")


def collocations(docs: DataFrame, longest: int = 3, least: int = 10, percent: int = 50, top: int = 2000, text_col: str = "text", lang_col: str = "lang") -> DataFrame:
    """Each language's best phrases: lang, rank, phrase, a, l, r, n, score."""
    tables, totals = levels(docs, longest, least, text_col, lang_col)
    found = []
    for k in range(2, longest + 1):
        rows = scored(tables, k)
        found.append(rows.join(within_longer(tables, k, percent), ["lang", "phrase"], "left_anti") if k < longest else rows)
    rows = reduce(DataFrame.unionByName, found).withColumn("share", F.pmod(F.xxhash64("phrase"), F.lit(64)))
    order = [F.desc("score"), F.desc("a"), F.asc("phrase")]
    for by in (["lang", "share"], ["lang"]):  # a language's best are among the best of its 64 shares, so no task gets a whole language
        rows = rows.withColumn("rank", F.row_number().over(Window.partitionBy(*by).orderBy(*order))).where(F.col("rank") <= top)
    rows = rows.join(totals, "lang")
    return rows.select("lang", F.col("rank").cast("long").alias("rank"), "phrase", "a", "l", "r", F.col("n_words").alias("n"), "score")
