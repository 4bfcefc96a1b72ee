"""Bounded-space online packing of tokenised documents into sequences.

Each task keeps at most ``open_windows`` windows.  A document longer than a window fills whole windows; what is left, or a
shorter document, goes into the open window that it fits best.  If none fits and no further window may be opened,
the fullest is topped up with a cut of the document and emitted.  At the end of a partition its open windows are left
over; leftovers of ``merged_parts`` partitions are then packed together, and the last tokens of such a merge form sequences whose
lengths are powers of two, which need no padding.

Pieces are written once to the shared folder, with ids only for the leftovers.

Defined results: a null or empty text is the end id alone; repeated rows are packed each; order within a document
is kept by ``start``; an empty table gives an empty table; other columns are
ignored, whatever their names, and a result column of the id column's name gets a trailing underscore.
"""

from __future__ import annotations

import bisect
import os
import string
import zlib
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, functions as F

from .common import materialize, release, schema_of, with_id
from .words import Words, slices, span_hashes


@dataclass(frozen=True)
class Settings:
    window: int = 4096
    end_id: int = 2
    open_windows: int = 16
    merged_parts: int = 16
    cached_pieces: int = 300_000
    block_bytes: int = 2 << 20


#: Byte kinds: white space, letters, punctuation, digits, others.
_SPACE, _LETTER, _MARK, _DIGIT, _OTHER = range(5)
_KIND = np.full(256, _OTHER, np.uint8)
_KIND[[0x20, 9, 10, 11, 12, 13]] = _SPACE
_KIND[[ord(c) for c in string.ascii_letters]] = _LETTER
_KIND[[ord(c) for c in string.punctuation if c not in "'<>|"]] = _MARK
_KIND[[ord(c) for c in string.digits]] = _DIGIT
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32


def _pieces(texts: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(bytes, starts, ends, kinds, first piece of each text) of the pieces that a tokenizer encodes on their own.

    In a word of ASCII and Latin-1 letters, digits and punctuation without apostrophes these are the runs of letters, lower-cased, each
    digit and the runs of punctuation; any other word is one piece, as it stands.
    """
    words = Words(texts)
    raw = words.raw
    kind = _KIND[raw]
    low = _LOWER[raw]
    lead = np.flatnonzero(raw[:-1] == 0xC3) if len(raw) else np.zeros(0, np.int64)
    after = raw[lead + 1]
    good = (after >= 0x80) & (after < 0xC0) & (after != 0x97) & (after != 0xB7)
    lead, after = lead[good], after[good]
    kind[lead] = kind[lead + 1] = _LETTER
    low[lead + 1] = np.where(after < 0x9F, after + 0x20, after)
    odd = np.concatenate(([0], np.cumsum(kind == _OTHER)))
    odd = np.flatnonzero(odd[words.end] > odd[words.start])
    step = np.zeros(len(raw) + 1, np.int8)
    step[words.start[odd]] += 1
    step[words.end[odd]] -= 1
    whole = np.cumsum(step[:-1], dtype=np.int8).astype(bool)
    low[whole] = raw[whole]
    kind[whole] = _OTHER
    begins = np.zeros(len(raw) + 1, bool)
    begins[1:-1] = (kind[1:] != kind[:-1]) | (kind[1:] == _DIGIT)
    begins[words.start] = True
    inside = kind != _SPACE
    begins[:-1] &= inside
    start = np.flatnonzero(begins[:-1])
    begins[-1] = True
    begins[:-1] |= ~inside
    end = np.flatnonzero(inside & begins[1:]) + 1
    return low, start, end, kind[start], np.searchsorted(start, words.at)


class Encoder:
    """Ids of whole texts by a tokenizer, as little-endian 32-bit numbers.

    If the tokenizer drops white space, ignores case and splits letters, digits and punctuation (found out by encoding probes both ways), the
    ids of a text are those of its pieces: every distinct piece of a block of texts is encoded once and kept in a bounded cache.
    Other tokenizers encode each text as it is.
    """

    PROBES = ("Ab, cd!  ab.\nÉcole ÉCOLE*** the.%%% it's 12 x_y", "a\tb c-d e/f (g) h; öß Öß. 3.5x", "don't stop? \"no\" f**k ñandú, x1y2z")

    def __init__(self, path: str, s: Settings):
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        from tokenizers import Tokenizer

        self.tokenizer, self.s = Tokenizer.from_file(path), s
        self.known: dict[bytes, bytes] = {}
        vocabulary = self.tokenizer.get_vocab()
        self.last = np.zeros(max(vocabulary.values()) + 1, bool)  # ids that end a piece
        self.last[[i for t, i in vocabulary.items() if t.endswith("</w>")]] = True
        self.by_piece = all(self._by_piece(pa.array([p], pa.large_string()))[0] == self._whole(p) for p in self.PROBES)
        self.known.clear()

    def _whole(self, text: str | None) -> bytes:
        return np.array(self.tokenizer.encode(text or "", add_special_tokens=False).ids, "<u4").tobytes()

    def _apart(self, words: list[bytes]) -> list[bytes]:
        found = self.tokenizer.encode([w.decode() for w in words], is_pretokenized=True, add_special_tokens=False)
        cut = np.searchsorted(np.array([-1 if w is None else w for w in found.word_ids], np.int64), np.arange(len(words) + 1)) * 4
        ids = np.array(found.ids, "<u4").tobytes()
        return [ids[i:j] for i, j in zip(cut[:-1].tolist(), cut[1:].tolist())]

    def _letters(self, words: list[bytes]) -> list[bytes]:
        """Runs of letters: one call, in which each ends with an id that ends a piece."""
        ids = np.array(self.tokenizer.encode_batch_fast([b" ".join(words).decode()], add_special_tokens=False)[0].ids, "<u4")
        cut = np.r_[0, 4 * np.flatnonzero(self.last[ids]) + 4]
        if len(cut) != len(words) + 1:
            return self._apart(words)
        raw = ids.tobytes()
        return [raw[i:j] for i, j in zip(cut[:-1].tolist(), cut[1:].tolist())]

    def _by_piece(self, texts: pa.Array) -> list[bytes]:
        raw, start, end, kind, first_of = _pieces(texts)
        if not len(start):
            return [b""] * len(texts)
        _, first, which = np.unique(span_hashes(raw, start, end), return_index=True, return_inverse=True)
        data = raw.tobytes()
        pieces = [data[a:b] for a, b in zip(start[first].tolist(), end[first].tolist())]
        letters = (kind[first] == _LETTER).tolist()
        known = self.known
        new = [(p, is_run) for p, is_run in zip(pieces, letters) if p not in known]
        if len(known) + len(new) > self.s.cached_pieces:
            known.clear()
            new = list(zip(pieces, letters))
        for is_run, encode in ((True, self._letters), (False, self._apart)):
            some = [p for p, x in new if x is is_run]
            if some:
                known.update(zip(some, encode(some)))
        ids = [known[p] for p in pieces]
        flat = np.frombuffer(b"".join(ids), "<u4")
        size = np.fromiter(map(len, ids), np.int64, len(ids)) // 4
        each = size[which]
        total = np.concatenate(([0], np.cumsum(each)))
        out = flat[np.repeat((np.cumsum(size) - size)[which] - total[:-1], each) + np.arange(total[-1])].tobytes()
        cut = (4 * total[first_of]).tolist()
        return [out[i:j] for i, j in zip(cut[:-1], cut[1:])]

    def __call__(self, texts: pa.Array) -> list[bytes]:
        return self._by_piece(texts) if self.by_piece else [self._whole(t) for t in texts.to_pylist()]


_ENCODERS: dict[tuple, Encoder] = {}


def encoder(path: str, s: Settings) -> Encoder:
    """The worker process's encoder: the tokenizer is read once and its cache serves all tasks that the process runs."""
    if (path, s) not in _ENCODERS:
        _ENCODERS.clear()
        _ENCODERS[path, s] = Encoder(path, s)
    return _ENCODERS[path, s]


class Windows:
    """At most ``limit`` open windows; a piece is (key, start, ids, document's tokens), a full window a list of pieces."""

    def __init__(self, window: int, limit: int):
        self.window, self.limit = window, limit
        self.free: list[tuple[int, int]] = []  # (free tokens, window), sorted
        self.held: dict[int, list] = {}
        self.next = 0

    def _put(self, k: int, room: int, piece: tuple):
        self.held[k].append(piece)
        room -= len(piece[2]) // 4
        if room:
            bisect.insort(self.free, (room, k))
            return None
        return self.held.pop(k)

    def _open(self, piece: tuple):
        self.held[self.next] = []
        self.next += 1
        return self._put(self.next - 1, self.window, piece)

    def add(self, key, ids: bytes):
        """Places a document; yields the windows that became full."""
        start, total, size = 0, len(ids) // 4, 4 * self.window
        while total - start >= self.window:
            yield [(key, start, ids[4 * start : 4 * start + size], total)]
            start += self.window
        while start < total:
            rest = total - start
            piece = (key, start, ids[4 * start :], total)
            at = bisect.bisect_left(self.free, (rest, -1))
            if at < len(self.free):
                room, k = self.free.pop(at)
                full = self._put(k, room, piece)
            elif len(self.free) < self.limit:
                full = self._open(piece)
            else:
                room, k = self.free.pop(0)  # the fullest
                full = self._put(k, room, (key, start, ids[4 * start : 4 * (start + room)], total))
                start += room
                yield full
                continue
            start = total
            if full:
                yield full

    def rest(self) -> list[list]:
        return [self.held[k] for _, k in self.free]


FIELDS = "start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long, ids binary, part int"


def _rows(window: list, sequence: int, part, ids: bool):
    at = 0
    for key, start, data, total in window:
        n = len(data) // 4
        yield key, start, n, zlib.crc32(data), total, sequence, at, data if ids else None, part
        at += n


def tails(tokens: int, window: int) -> list[int]:
    """Lengths, whole windows first, then powers of two, that hold the tokens without padding."""
    out = [window] * (tokens // window)
    rest = tokens % window
    return out + [1 << b for b in range(rest.bit_length() - 1, -1, -1) if rest >> b & 1]


def pack(docs: DataFrame, tokenizer_path: str, id_col: str = "doc_id", text_col: str = "text", with_ids: bool = False, settings: Settings = Settings()) -> DataFrame:
    """Per piece the document's id, start, length, crc32 of its ids, the document's tokens, sequence and offset there;
    with ``with_ids`` also the ids as little-endian 32-bit numbers."""
    s = settings
    docs = docs.select(F.col(id_col).alias("__id"), F.col(text_col).cast("string").alias("__text"))
    schema = schema_of(docs, ["__id"], FIELDS)
    names = schema.fieldNames()
    arrow = [pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.binary(), pa.int32()]

    def batch(rows: list, ids: pa.DataType) -> pa.RecordBatch:
        columns = list(zip(*rows)) or [()] * len(names)
        return pa.RecordBatch.from_arrays([pa.array(c, kind) for c, kind in zip(columns, [ids, *arrow])], names=names)

    end = s.end_id.to_bytes(4, "little")

    def scatter(batches):
        release()
        encode, windows = encoder(tokenizer_path, s), Windows(s.window, s.open_windows)
        part = TaskContext.get().partitionId()
        rows, count, kind = [], 0, None
        for b in batches:
            kind = b.column(0).type
            for at, piece in slices(b.column(1), s.block_bytes):
                for key, ids in zip(b.column(0).slice(at, len(piece)).to_pylist(), encode(piece)):
                    for full in windows.add(key, ids + end):
                        rows += _rows(full, part << 32 | count, None, with_ids)
                        count += 1
                if len(rows) > 2000:
                    yield batch(rows, kind)
                    rows = []
        for window in windows.rest():
            rows += _rows(window, part << 32 | count, part, True)
            count += 1
        if kind is not None:
            yield batch(rows, kind)
        release()

    pieces = materialize(docs.mapInArrow(scatter, schema), "pieces")

    def merge(table: pa.Table) -> pa.Table:
        group = table.column("part")[0].as_py() // s.merged_parts
        got = table.select(["__id", "sequence_id", "offset", "start", "ids", "doc_tokens"]).sort_by([("sequence_id", "ascending"), ("offset", "ascending")])
        keys, _, _, starts, ids, totals = (got.column(i).to_pylist() for i in range(6))
        lengths = tails(sum(map(len, ids)) // 4, s.window)
        rows, at, count, window, room = [], 0, 0, [], lengths[0]
        for key, start, data, total in zip(keys, starts, ids, totals):
            at = 0
            while at < len(data):
                cut = data[at : at + 4 * room]
                window.append((key, start + at // 4, cut, total))
                at += len(cut)
                room -= len(cut) // 4
                if not room:
                    rows += _rows(window, 1 << 62 | group << 32 | count, None, with_ids)
                    count += 1
                    window, room = [], lengths[count] if count < len(lengths) else 0
        return pa.Table.from_batches([batch(rows, got.schema.field(0).type)])

    left = pieces.where("part is not null")
    merged = left.groupBy(F.floor(F.col("part") / s.merged_parts).alias("merge")).applyInArrow(merge, schema)
    out = pieces.where("part is null").unionByName(merged)
    return with_id(out.select(*[c for c in names if c not in ("part", *(() if with_ids else ("ids",)))]), id_col)
