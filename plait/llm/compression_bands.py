"""Quality rules by compression bands: zstandard ratios of whole documents and of fixed chunks.

A document's ratio is raw bytes over zstandard bytes.  Repetitive text lies above its length's band, random or
encoded text below it.  Long documents are also cut into chunks of ``chunk`` bytes; too large a share of chunks
outside the chunk band rejects a document of which only a part is bad.  Everything is one pass without shuffle.

Defined results: a null text is an empty one (no words, ratio 0, base_failed); repeated rows give repeated rows;
an empty table gives an empty table; other columns of the input are ignored, whatever their names.
"""

from __future__ import annotations

import re
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from .common import scan_texts
from .words import Words, mix, text_bytes

#: (texts below so many bytes, lowest ratio, highest ratio); short texts compress less and vary more.  The synthetic documents (sf0.1, whole
#: texts, level 3) that are labelled good and pass the base rules have ratios of 1.38 to 1.85 under 500 bytes, and of 1.47 to 1.98, 1.73 to 2.15, 1.92
#: to 2.22, 2.11 to 2.34 and 2.22 to 2.48 in the next lengths, their chunks 1.89 to 2.14.  Their words are drawn evenly, while real prose of
#: one subject repeats more, so the limits leave a fifth or more below and a quarter or more above.  Another corpus, above all in other scripts, wants limits
#: of its own, measured in the same way.
BANDS = ((200, 0.0, 2.3), (500, 1.05, 2.4), (1000, 1.2, 2.5), (2000, 1.35, 2.7), (4000, 1.5, 2.9), (8000, 1.6, 3.1), (32000, 1.7, 3.5), (float("inf"), 1.7, 4.0))
_WORD = re.compile(r"[^\x20\x09-\x0D]")


@dataclass(frozen=True)
class Limits:
    bands: tuple = BANDS
    chunk: int = 2048
    chunk_band: tuple = (1.25, 3.0)
    bad_share: float = 0.25
    level: int = 3
    min_words: int = 50
    max_repeat_percent: int = 50


FIELDS = (
    "n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long, base_failed boolean, kept boolean, "
    "ratio double, n_chunks long, n_bad_chunks long, reason string"
)


def duplicate_lines(text: str) -> int:
    """Lines that hold a word and equal an earlier line of the text."""
    seen, n = set(), 0
    for line in text.split("\n"):
        if line in seen:
            n += 1
        elif _WORD.search(line):
            seen.add(line)
    return n


def base_counts(texts: pa.Array) -> dict[str, np.ndarray]:
    """Counts per text: words, code points in words, symbols, duplicate lines, words in repeated 3-word windows."""
    words = Words(texts)
    raw, at = words.raw, words.at
    per = lambda flags: np.diff(np.concatenate(([0], np.cumsum(flags)))[at])
    space = (raw == 0x20) | ((raw >= 9) & (raw <= 13))
    chars = per(((raw & 0xC0) != 0x80) & ~space)
    symbols = per(np.isin(raw, np.frombuffer(b"#*$%&|<>", np.uint8)))
    hashes, repeat = words.hashes(), np.zeros(len(words), bool)
    windows, first = words.windows(hashes, 3)
    if len(windows):
        doc = np.searchsorted(words.first, first, side="right").astype(np.uint64)
        _, inverse, counts = np.unique(mix(windows + mix(doc)), return_inverse=True, return_counts=True)
        twice = first[counts[inverse] > 1]
        for shift in range(3):
            repeat[twice + shift] = True
    total = np.concatenate(([0], np.cumsum(repeat)))
    return {
        "n_words": words.counts, "word_chars": chars, "n_symbols": symbols,
        "n_dup_lines": np.array([duplicate_lines(t) if t else 0 for t in texts.to_pylist()], np.int64),
        "n_repeat_words": total[words.first[1:]] - total[words.first[:-1]],
    }


def _judge(limits: Limits):
    import zstandard

    pack = zstandard.ZstdCompressor(level=limits.level, write_checksum=False, write_content_size=False).compress

    def ratios(data: memoryview) -> tuple[float, int, int]:
        if not len(data):
            return 0.0, 0, 0
        whole, size = len(data) / len(pack(data)), limits.chunk
        if len(data) < 2 * size:
            return whole, 0, 0
        cuts = list(range(0, len(data) - size // 2, size))  # a short rest joins the last chunk
        ends = [*cuts[1:], len(data)]
        low, high = limits.chunk_band
        return whole, len(cuts), sum(not low <= (e - s) / len(pack(data[s:e])) <= high for s, e in zip(cuts, ends))

    def work(texts: pa.Array) -> list:
        n = base_counts(texts)
        raw, at = text_bytes(texts)
        data = memoryview(np.ascontiguousarray(raw))
        found = [ratios(data[at[i] : at[i + 1]]) for i in range(len(texts))]
        failed = (n["n_words"] < limits.min_words) | (100 * n["n_repeat_words"] > limits.max_repeat_percent * n["n_words"])
        reasons = []
        for i, (ratio, chunks, bad) in enumerate(found):
            size = at[i + 1] - at[i]
            low, high = next((lo, hi) for below, lo, hi in limits.bands if size < below)
            reasons.append("base" if failed[i] else "repetitive" if ratio > high else "incompressible" if ratio < low else "chunks" if bad > limits.bad_share * chunks else "")
        return [
            *(pa.array(n[k], pa.int64()) for k in ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")),
            pa.array(failed), pa.array([not r for r in reasons], pa.bool_()),
            pa.array([f[0] for f in found], pa.float64()), pa.array([f[1] for f in found], pa.int64()), pa.array([f[2] for f in found], pa.int64()),
            pa.array(reasons, pa.string()),
        ]

    return work


def compression_bands(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", limits: Limits = Limits()) -> DataFrame:
    """Per document the base counts, the ratios, the first reason against it ('' if none) and ``kept``."""
    return scan_texts(docs, [id_col], text_col, FIELDS, lambda: _judge(limits))
