"""Substring dedup with repeated-phrase automata.

A window is ``window`` consecutive words of one document; it recurs if the same words start anywhere else, in the same
document or another.  Every word under a recurring window goes, first occurrences included.

1. Candidate search.  Of each window the ``anchor``-word phrase with the least hash is its anchor: equal windows have
   equal anchors.  A census over all documents (census.py) finds the anchors that stand at two places or more.
2. Confirmation.  Only windows around such anchors are counted, by 96 bits of hash, in a second census.  One bucket that
   holds a recurring window becomes its owner and is told which buckets hold it; no other bucket learns anything.
3. Passages.  An owner cuts its text into the runs of recurring windows that a bucket holds and sends that bucket the words.
4. Location.  Each bucket compiles the passages that it was sent into Aho-Corasick automata, in shards of at most
   ``automaton_words`` words, and streams all its documents through them.  A passage's patterns are its successive phrases
   of ``window + 1 over 2`` words: every window of the passage holds a whole one.  Around each place that an automaton finds,
   the windows' words are compared with those of the shard's passages; equal ones go.

Words are letters of the automata, written as a few digits each, so neither long words nor long passages make them deep.

Documents are dealt into buckets by a hash, and only those hold whole texts in memory, one bucket at a time.  The text is
shuffled once, and all steps read that exchange again.  A window that more than ``spread`` buckets hold gets its owner by a hash of its anchor, so that
what very many documents share is sent by many tasks.

Defined results: a null text has no words; a text with fewer words than a window stays whole; of repeated rows every
long enough one loses all its words (fully equal rows share a bucket); an empty table gives an empty table; other columns are ignored, whatever their names, and a result column whose name is the id column's gets a trailing underscore.
Two different windows of n candidates
are taken for equal with a probability of about n**2 / 2**97.
"""

from __future__ import annotations

import re
from dataclasses import dataclass
from itertools import chain, repeat

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F, types as T

from . import census
from .common import kept_type, text_volume, with_id
from .words import Words, mix, rolled

_WORD = re.compile(rb"[^\x20\x09-\x0D]+")


@dataclass(frozen=True)
class Settings:
    window: int = 35
    anchor: int = 8
    bucket_bytes: int = 4 << 20
    shard_keys: int = 500_000
    least_parts: int = 64
    anchor_bytes: int = 4
    automaton_words: int = 250_000
    spread: int = 64
    targets: int = 256


def _extreme(values: np.ndarray, width: int, pick) -> np.ndarray:
    """pick (minimum or maximum) over each run of ``width`` values, by doubling."""
    out, have = values, 1
    while 2 * have <= width:
        out = pick(out[: len(out) - have], out[have:])
        have *= 2
    rest = width - have
    return pick(out[: len(out) - rest], out[rest:]) if rest else out


class _Bucket:
    """Word hashes of a bucket's texts and, for each long enough text, its windows' least anchor hashes."""

    def __init__(self, texts: pa.ChunkedArray, s: Settings):
        self.words = Words(texts)
        self.hashes = self.words.hashes()
        self.spans = [(a, b) for a, b in zip(self.words.first[:-1].tolist(), self.words.first[1:].tolist()) if b - a >= s.window]
        self.width = s.window - s.anchor + 1
        self.phrases = mix(rolled(self.hashes, s.anchor)) if len(self.hashes) >= s.anchor else self.hashes[:0]
        self.windows = rolled(self.hashes, s.window) if len(self.hashes) >= s.window else self.hashes[:0]
        self.s = s

    def least(self, a: int, b: int) -> np.ndarray:
        return _extreme(self.phrases[a : b - self.s.anchor + 1], self.width, np.minimum)

    def anchors(self) -> np.ndarray:
        """Hashes of all places that are the anchor of some window."""
        out = [self.hashes[:0]]
        for a, b in self.spans:
            low, own = self.least(a, b), self.phrases[a : b - self.s.anchor + 1]
            padded = np.concatenate((np.zeros(self.width - 1, np.uint64), low, np.zeros(self.width - 1, np.uint64)))
            out.append(own[_extreme(padded, self.width, np.maximum) == own])
        return np.concatenate(out)

    def candidates(self, codes: np.ndarray, classes: np.ndarray, keys: census.Keys) -> tuple[np.ndarray, np.ndarray]:
        """Places of the windows whose anchor recurs, and their anchors' hashes."""
        places, anchors = [np.zeros(0, np.int64)], [np.zeros(0, np.uint64)]
        for a, b in self.spans:
            low = self.least(a, b)
            found = np.flatnonzero(classes[np.searchsorted(codes, keys.codes(low))] > 0)
            places.append(a + found)
            anchors.append(low[found])
        return np.concatenate(places), np.concatenate(anchors)

    def checks(self, places: np.ndarray, anchors: np.ndarray) -> np.ndarray:
        """32 more bits of the windows at the places: 16 of the anchor, which windows side by side share, 16 of all words."""
        if not len(places):
            return np.zeros(0, np.uint32)
        again = rolled(self.hashes * np.uint64(0x9FB21C651E98DF25) + np.uint64(1), self.s.window)[places]
        return ((mix(anchors) >> np.uint64(48) << np.uint64(16)) | (again >> np.uint64(48))).astype(np.uint32)


def runs(places: np.ndarray, to: np.ndarray, window: int) -> list[tuple[int, int, np.ndarray]]:
    """(first word, word after the last, targets) of the maximal runs of consecutive places that go to the same target."""
    if not len(places):
        return []
    order = np.lexsort((places, to))
    places, to = places[order], to[order]
    cut = np.flatnonzero(np.r_[True, (np.diff(places) != 1) | (np.diff(to) != 0)])
    first, last, target = places[cut], places[np.r_[cut[1:], len(places)] - 1], to[cut]
    order = np.lexsort((target, last, first))
    first, last, target = first[order], last[order], target[order]
    cut = np.flatnonzero(np.r_[True, (np.diff(first) != 0) | (np.diff(last) != 0)])
    return [(int(first[i]), int(last[i]) + window, target[i:j]) for i, j in zip(cut.tolist(), [*cut[1:].tolist(), len(first)])]


BASE = 64


def letters(numbers: np.ndarray, width: int) -> str:
    """Numbers as ``width`` letters each, which tell their place, so that no match is shifted; -1 is a letter that stands in no pattern."""
    out = np.ones((len(numbers), width), np.uint32)
    known = numbers >= 0
    rest = numbers[known]
    for d in range(width):
        out[known, d] = 2 + d * BASE + rest % BASE
        rest = rest // BASE
    return out.astype("<u4").tobytes().decode("utf-32-le")


def locate(texts: list[list[bytes]], passages: list[list[bytes]], s: Settings) -> list[np.ndarray]:
    """For each text, as its words, which of them lie under a window of a passage, by one automaton for each shard of passages."""
    import ahocorasick

    size, seed, at = s.window, (s.window + 1) // 2, 0
    most = max(s.automaton_words, size)
    ids: dict[bytes, int] = {}
    parts = [p[i : i + most] for p in passages for i in range(0, len(p) - size + 1, most - size + 1)]
    sizes = [len(p) for p in parts]
    numbers = np.fromiter((ids.setdefault(w, len(ids)) for w in chain.from_iterable(parts)), np.int32, sum(sizes))
    width = 1
    while BASE**width < len(ids):
        width += 1
    between = [b""]  # no word
    flat = np.fromiter(map(ids.get, chain.from_iterable(chain(t, between) for t in texts), repeat(-1)), np.int32) if parts else np.zeros(0, np.int32)
    phrases, stream, raw, data = letters(numbers, width), letters(flat, width), numbers.tobytes(), flat.tobytes()
    cover = np.zeros(len(flat) + 1, np.int32)
    begin = 0
    while at < len(parts):
        automaton, windows, room = ahocorasick.Automaton(ahocorasick.STORE_LENGTH), set(), most
        while at < len(parts) and sizes[at] <= room:
            end = begin + sizes[at]
            for i in range(begin, end - seed + 1, seed):
                automaton.add_word(phrases[i * width : (i + seed) * width])
            windows.update([raw[4 * i : 4 * (i + size)] for i in range(begin, end - size + 1)])
            room, begin, at = room - sizes[at], end, at + 1
        automaton.make_automaton()
        ends = np.fromiter((end for end, _ in automaton.iter(stream)), np.int64)
        first = (ends + 1) // width - seed
        near = np.zeros(len(flat) + 1, np.int32)  # the windows that hold a found phrase
        np.add.at(near, np.maximum(first - (size - seed), 0), 1)
        np.add.at(near, first + 1, -1)
        starts = np.flatnonzero(np.cumsum(near[: max(0, len(flat) - size + 1)]) > 0).tolist()
        found = np.array([i for i in starts if data[4 * i : 4 * (i + size)] in windows], np.int64)
        cover[found] += 1
        cover[found + size] -= 1
    gone = np.cumsum(cover[:-1]) > 0 if parts else np.zeros(sum(map(len, texts)) + len(texts), bool)
    ends = np.cumsum([len(t) + 1 for t in texts]).tolist()
    return [gone[e - len(t) - 1 : e - 1] for t, e in zip(texts, ends)]


def dedup_phrases(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", settings: Settings = Settings()) -> DataFrame:
    """Per document n_words, n_removed, ``kept`` (its other words joined by one space) and ``removed``, the word spans that went."""
    s = settings
    source = docs.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text"))
    volume = text_volume(source, "text")
    buckets, parts = census.sizes(volume, s.bucket_bytes, s.shard_keys, s.least_parts)
    words = volume // 6
    coarse = census.Keys(parts(words // 12), s.anchor_bytes)
    exact = census.Keys(parts(words // 2), 8)
    dealt = source.withColumn("bucket", census.bucket_of(buckets, "id", "text"))
    span = T.ArrayType(T.StructType([T.StructField("first", T.LongType()), T.StructField("end", T.LongType())]))
    out = T.StructType([T.StructField("__id", kept_type(docs, id_col)), T.StructField("n_words", T.LongType()), T.StructField("n_removed", T.LongType()), T.StructField("kept", T.StringType()), T.StructField("removed", span)])

    def anchors(table: pa.Table) -> pa.Table:
        codes, counts = np.unique(coarse.codes(_Bucket(table.column("text"), s).anchors()), return_counts=True)
        return census.blobs(table.column("bucket")[0].as_py(), codes, counts, coarse)

    def windows(table: pa.Table, verdict: pa.Table) -> pa.Table:
        held = _Bucket(table.column("text"), s)
        codes = np.unique(coarse.codes(held.anchors()))
        places, low = held.candidates(codes, census.classes(verdict, codes, coarse), coarse)
        bucket = (table if table.num_rows else verdict).column("bucket")[0].as_py()
        return census.marked_blobs(bucket, held.windows[places], held.checks(places, low), exact)

    def passages(table: pa.Table, owned: pa.Table) -> pa.Table:
        rows = []
        if owned.num_rows:
            held = _Bucket(table.column("text"), s)
            codes, checks, counts, to = census.owned_keys(owned)
            places = np.concatenate([np.zeros(0, np.int64), *[np.arange(a, b - s.window + 1) for a, b in held.spans]])
            low = np.concatenate([np.zeros(0, np.uint64), *[held.least(a, b) for a, b in held.spans]])
            at = np.minimum(np.searchsorted(codes, held.windows[places]), len(codes) - 1)
            hit = np.flatnonzero(codes[at] == held.windows[places])
            hit = hit[held.checks(places[hit], low[hit]) == checks[at[hit]]]
            key, first = np.unique(at[hit], return_index=True)
            begin = np.cumsum(counts) - counts
            n = counts[key]
            pick = np.repeat(begin[key] - (np.cumsum(n) - n), n) + np.arange(n.sum())
            for a, b, targets in runs(np.repeat(places[hit[first]], n), to[pick], s.window):
                text = held.words.text(a, b)
                rows += [(text, targets[i : i + s.targets].tolist()) for i in range(0, len(targets), s.targets)]
        return pa.table({"words": pa.array([r[0] for r in rows], pa.binary()), "to": pa.array([r[1] for r in rows], pa.list_(pa.int32()))})

    def remove(table: pa.Table, sent: pa.Table) -> pa.Table:
        texts = [_WORD.findall((t or "").encode()) for t in table.column("text").to_pylist()]
        gone = locate(texts, [_WORD.findall(w) for w in sorted(set(sent.column("words").to_pylist()))], s)
        kept = [b" ".join(t) if not g.any() else b" ".join([w for w, x in zip(t, g.tolist()) if not x]) for t, g in zip(texts, gone)]
        edges = [np.flatnonzero(np.diff(np.r_[0, g.view(np.int8), 0])).reshape(-1, 2).tolist() for g in gone]
        result = pa.table({
            "__id": table.column("id"), "n_words": pa.array([len(t) for t in texts], pa.int64()), "n_removed": pa.array([int(g.sum()) for g in gone], pa.int64()),
            "kept": pa.array([k.decode() for k in kept], pa.string()),
            "removed": pa.array([[{"first": a, "end": b} for a, b in e] for e in edges], pa.list_(pa.struct([("first", pa.int64()), ("end", pa.int64())]))),
        })
        return result

    first = census.verdicts(dealt.groupBy("bucket").applyInArrow(anchors, census.BLOBS), coarse)
    counted = dealt.groupBy("bucket").cogroup(first.groupBy("bucket")).applyInArrow(windows, census.MARKED)
    owned = census.owners(counted, s.spread)
    found = dealt.groupBy("bucket").cogroup(owned.groupBy("bucket")).applyInArrow(passages, "words binary, to array<int>")
    sent = found.repartition(F.xxhash64("words", F.col("to")[0])).select(F.explode("to").alias("bucket"), "words")
    return with_id(dealt.groupBy("bucket").cogroup(sent.groupBy("bucket")).applyInArrow(remove, out), id_col)
