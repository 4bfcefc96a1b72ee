"""Language ID by compression: one zstandard raw-content dictionary for each language, the smallest encoding wins.

Texts are lower-cased first.  Sizes alone decide: how often a language occurs counts for nothing.  The score is the best language's share of
the likelihoods exp(-bytes / temperature).

Every language of the training rows is learned.  ``fit`` reads a bounded sample: at most ``max_texts`` texts a language, chosen by a seeded hash of the id, of which
a piece of up to ``piece`` characters each, at a place that the hash draws, goes into a dictionary of at most ``dict_bytes``.  ``predict`` encodes every whole text
once with each dictionary and sums the sizes: its first ``head`` bytes behind the last ``tail`` bytes of the dictionary, of which what they add counts (alone, a few words would be stored as they
are), the rest in chunks of ``chunk`` bytes, so that long texts keep depending on the dictionary.  Texts of any length are measured in this one way.  Of more than ``max_langs`` languages each has a share of that many languages' texts and bytes.  A narrow margin between the two smallest sizes marks a prediction as rejected.

Defined results: a null text, or one without any letter, is ``und`` with score 0; without any training text every
text is ``und``; full ties go to the language first in alphabetical order; repeated rows give repeated rows; other columns are
ignored, whatever their names, and a result column of the id column's name gets a trailing underscore.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window, functions as F

from .common import scan_texts

UNKNOWN = "und"


@dataclass(frozen=True)
class Settings:
    max_texts: int = 400
    piece: int = 1024
    dict_bytes: int = 112 << 10
    max_langs: int = 256
    chunk: int = 1024
    #: so many first bytes of a text are encoded, more thoroughly, behind so many last bytes of the dictionary: alone a short text would be stored as it is
    head: int = 256
    tail: int = 200
    min_match: int = 4
    search_log: int = 4
    #: margins (second smallest size over smallest, less 1) under this are rejected
    min_margin: float = 0.01
    #: bytes of size difference that divide a likelihood by e
    temperature: float = 4.0
    seed: int = 11


def fit(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang", where: Column | None = None, settings: Settings = Settings()) -> dict[str, bytes]:
    """Dictionary by language, from the rows of ``where`` with a language.  Two passes: counts of the languages (no
    text is read), then the texts whose hash lies under a rate that leaves about twice ``max_texts`` a language.
    The driver gets at most max_langs * max_texts * piece bytes, or one piece a language if that is more."""
    rows = docs.where(F.col(lang_col).isNotNull() & (where if where is not None else F.lit(True)))
    counts = rows.groupBy(F.col(lang_col).cast("string").alias("lang")).count().orderBy(F.desc("count"), "lang").collect()
    if not counts:
        return {}
    over = max(1.0, len(counts) / settings.max_langs)
    max_texts, dict_bytes = max(1, int(settings.max_texts / over)), max(64, int(settings.dict_bytes / over))
    rates = F.create_map(*[F.lit(x) for r in counts for x in (r["lang"], min(1.0, 2.0 * max_texts / r["count"] + 20.0 / r["count"]))])
    key = F.xxhash64(F.lit(settings.seed), F.col(id_col).cast("string"))
    picked = (
        rows.select(F.col(lang_col).cast("string").alias("lang"), key.alias("key"), F.col(text_col).cast("string").alias("text"))
        .where((F.pmod(F.shiftright("key", 11), F.lit(1 << 50)) / float(1 << 50) < rates[F.col("lang")]) & F.col("text").rlike(r"\p{L}"))
        .withColumn("at", F.pmod("key", F.greatest(F.length("text") - settings.piece, F.lit(0)) + 1).cast("int") + 1)
        .withColumn("text", F.substring("text", F.col("at"), F.lit(settings.piece)))
        .withColumn("rank", F.row_number().over(Window.partitionBy("lang").orderBy("key", "text")))
        .where(F.col("rank") <= max_texts)
        .select("lang", "rank", "text")
    )
    found: dict[str, bytearray] = {}
    for r in sorted(picked.collect(), key=lambda r: (r["lang"], r["rank"])):
        held = found.setdefault(r["lang"], bytearray())
        if len(held) < dict_bytes:
            held += r["text"].lower().encode()[: settings.piece] + b"\n"
    return {lang: bytes(held[:dict_bytes]) for lang, held in sorted(found.items())}


def _classifier(model: dict[str, bytes], settings: Settings):
    import zstandard

    table_log = 17 - min(9, max(0, math.ceil(math.log2(max(1, len(model)) / settings.max_langs))))  # the more languages, the smaller their tables

    def packer(content: bytes, strategy: int, **given: int):
        how = zstandard.ZstdCompressionParameters.from_level(
            3, window_log=18, hash_log=table_log, chain_log=table_log, strategy=strategy, write_checksum=False, write_content_size=False, write_dict_id=False, **given,
        )
        held = zstandard.ZstdCompressionDict(content, dict_type=zstandard.DICT_TYPE_RAWCONTENT)
        held.precompute_compress(compression_params=how)
        return zstandard.ZstdCompressor(dict_data=held, compression_params=how).compress

    packs = [packer(content, zstandard.STRATEGY_LAZY2, min_match=settings.min_match, search_log=settings.search_log) for content in model.values()]
    langs, fine = list(model), []
    for content in model.values():
        pack, tail = packer(content, zstandard.STRATEGY_BTULTRA, min_match=3, search_log=settings.search_log), content[-settings.tail :]
        fine.append((pack, tail, len(pack(tail))))

    def one(text: str | None) -> tuple:
        if not text or not langs or not any(map(str.isalpha, text)):
            return UNKNOWN, 0.0, 0.0, True
        data = text.lower().encode()
        head, rest = data[: settings.head], memoryview(data)[settings.head :]
        cuts = [rest[i : i + settings.chunk] for i in range(0, len(rest), settings.chunk)]
        sizes = [max(1, len(first(tail + head)) - alone + sum(len(pack(c)) for c in cuts)) for (first, tail, alone), pack in zip(fine, packs)]
        best = min(range(len(sizes)), key=sizes.__getitem__)
        low = sizes[best]
        margin = min((s for i, s in enumerate(sizes) if i != best), default=2 * low) / low - 1
        score = 1 / sum(math.exp(-(s - low) / settings.temperature) for s in sizes)
        return langs[best], score, margin, margin < settings.min_margin

    def work(texts: pa.Array) -> list:
        rows = [one(t) for t in texts.to_pylist()]
        return [pa.array([r[i] for r in rows], kind) for i, kind in enumerate((pa.string(), pa.float64(), pa.float64(), pa.bool_()))]

    return work


def predict(docs: DataFrame, model: dict[str, bytes], id_col: str = "doc_id", text_col: str = "text", settings: Settings = Settings()) -> DataFrame:
    """Per document lang_pred, score (0 to 1), margin and rejected; one pass without shuffle.  The dictionaries go to
    the tasks with the function: at most max_langs * dict_bytes, or 64 bytes a language if that is more, whatever the input's size."""
    return scan_texts(docs, [id_col], text_col, "lang_pred string, score double, margin double, rejected boolean", lambda: _classifier(model, settings))
