"""Corpus-wide counts of hashed keys without one row a key.

Documents are dealt into buckets by a hash; a bucket's distinct keys are cut into shards of the key space and travel
as sorted binary blobs, one row for each (bucket, shard).  Each shard counts its keys over all buckets and sends every
bucket a class for each of the keys that it had sent: 0 for a key seen once in the corpus, else 1 + floor(log2(count)).
A key that a third of all documents hold is one entry of one blob a bucket, so no task gets more than its share.

Keys may be shortened to ``width`` bytes beside their shard: two keys may then be taken for one, so that a class can be
too high but never too low.  With 8 bytes the full 64-bit hash counts.

Sizes: ``bucket_bytes`` of text a bucket and ``shard_keys`` keys a shard.  A blob holds keys over buckets over shards, so beyond ``CALM`` bytes
both grow with the square root of the volume, which keeps a blob at hundreds of keys, up to ``MOST`` times (buckets of 64 MB, shards
of 8 million keys, about 1 GB a worker); from there on, at 1 TB, blobs grow shorter again, unless larger sizes are given.
"""

from __future__ import annotations

import math
from collections.abc import Callable

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from .common import parts_for
from .words import mix

CALM, MOST = 4 << 30, 16

BLOBS = "bucket int, shard int, keys binary, many binary, counts binary"
MARKED = "bucket int, shard int, keys binary, checks binary, many binary"
OWNED = "bucket int, keys binary, checks binary, counts binary, held binary"
VERDICTS = "bucket int, shard int, known binary, classes binary"


def bucket_of(count: int, *columns: str) -> Column:
    return F.pmod(F.xxhash64(*[F.col(c) for c in columns]), F.lit(count)).cast("int")


def sizes(volume: int, bucket_bytes: int, shard_keys: int, least: int) -> tuple[int, Callable[[int], int]]:
    """The number of buckets for so many bytes of text, and the number of shards as a function of the number of keys."""
    grown = min(MOST, max(1.0, math.sqrt(volume / CALM)))
    return parts_for(volume, int(bucket_bytes * grown), least), lambda keys: parts_for(keys, int(shard_keys * grown), least)


class Keys:
    """How a 64-bit hash is split into shard and key; orders keys by shard."""

    def __init__(self, shards: int, width: int):
        self.shards, self.width = shards, width

    def codes(self, hashes: np.ndarray) -> np.ndarray:
        if self.width == 8:
            return hashes
        return (self.shard(hashes) << np.uint64(8 * self.width)) | (hashes & np.uint64((1 << (8 * self.width)) - 1))

    def shard(self, hashes: np.ndarray) -> np.ndarray:
        return ((hashes >> np.uint64(32)) * np.uint64(self.shards)) >> np.uint64(32)

    def cuts(self, codes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(shards with keys, their bounds) in sorted codes."""
        shard = self.shard(codes) if self.width == 8 else codes >> np.uint64(8 * self.width)
        first = np.flatnonzero(np.r_[True, shard[1:] != shard[:-1]]) if len(shard) else np.zeros(0, np.int64)
        return shard[first].astype(np.int32), np.r_[first, len(codes)]

    def pack(self, codes: np.ndarray) -> bytes:
        return codes.astype("<u8").view(np.uint8).reshape(-1, 8)[:, : self.width].tobytes()

    def unpack(self, data: bytes) -> np.ndarray:
        raw = np.frombuffer(data, np.uint8).reshape(-1, self.width)
        out = np.zeros((len(raw), 8), np.uint8)
        out[:, : self.width] = raw
        return out.view("<u8").ravel()


def blobs(bucket: int, codes: np.ndarray, counts: np.ndarray, keys: Keys) -> pa.Table:
    """The rows for a bucket's sorted distinct codes and how often it has each."""
    shards, bounds = keys.cuts(codes)
    spans = list(zip(bounds[:-1], bounds[1:]))
    many = counts > 1
    return pa.table({
        "bucket": pa.array(np.full(len(shards), bucket, np.int32)),
        "shard": pa.array(shards),
        "keys": pa.array([keys.pack(codes[a:b]) for a, b in spans], pa.binary()),
        "many": pa.array([np.packbits(many[a:b]).tobytes() for a, b in spans], pa.binary()),
        "counts": pa.array([counts[a:b][many[a:b]].astype("<u4").tobytes() for a, b in spans], pa.binary()),
    })


def verdicts(rows: DataFrame, keys: Keys) -> DataFrame:
    """The classes of each blob's keys over all buckets."""

    def count(table: pa.Table) -> pa.Table:
        found, sizes = [], []
        for data, many, counts in zip(*(table.column(c).to_pylist() for c in ("keys", "many", "counts"))):
            codes = keys.unpack(data)
            n = np.ones(len(codes), np.int64)
            n[np.unpackbits(np.frombuffer(many, np.uint8), count=len(codes)).astype(bool)] = np.frombuffer(counts, "<u4")
            found.append((codes, n))
            sizes.append(len(codes))
        _, inverse = np.unique(np.concatenate([c for c, _ in found]), return_inverse=True)
        total = np.bincount(inverse, np.concatenate([n for _, n in found]))
        classes = np.where(total > 1, 1 + np.floor(np.log2(np.maximum(total, 1))), 0).astype(np.uint8)[inverse]
        ends = np.cumsum(sizes)
        parts = [classes[e - s : e] for s, e in zip(sizes, ends)]
        return pa.table({
            "bucket": table.column("bucket"), "shard": table.column("shard"),
            "known": pa.array([np.packbits(p > 0).tobytes() for p in parts], pa.binary()),
            "classes": pa.array([p[p > 0].tobytes() for p in parts], pa.binary()),
        })

    return rows.groupBy("shard").applyInArrow(count, VERDICTS)


def marked_blobs(bucket: int, codes: np.ndarray, checks: np.ndarray, keys: Keys) -> pa.Table:
    """The rows for a bucket's full hashes with 32 further bits each, in any order: sorted, distinct, and which it has more than once."""
    order = np.lexsort((checks, codes))
    codes, checks = codes[order], checks[order]
    first = np.flatnonzero(np.r_[True, (codes[1:] != codes[:-1]) | (checks[1:] != checks[:-1])]) if len(codes) else np.zeros(0, np.int64)
    many = np.diff(np.r_[first, len(codes)]) > 1
    codes, checks = codes[first], checks[first]
    shards, bounds = keys.cuts(codes)
    spans = list(zip(bounds[:-1], bounds[1:]))
    return pa.table({
        "bucket": pa.array(np.full(len(shards), bucket, np.int32)),
        "shard": pa.array(shards),
        "keys": pa.array([codes[a:b].astype("<u8").tobytes() for a, b in spans], pa.binary()),
        "checks": pa.array([checks[a:b].astype("<u4").tobytes() for a, b in spans], pa.binary()),
        "many": pa.array([np.packbits(many[a:b]).tobytes() for a, b in spans], pa.binary()),
    })


def owners(rows: DataFrame, spread: int) -> DataFrame:
    """For each key that the corpus has more than once, told to one bucket only, its owner: the buckets that hold it.

    The owner is the least of these buckets; of more than ``spread`` buckets it is drawn by a hash of the upper half of the check.
    """

    def count(table: pa.Table) -> pa.Table:
        sent = [np.frombuffer(x, "<u8") for x in table.column("keys").to_pylist()]
        bucket = np.repeat(table.column("bucket").to_numpy(), [len(x) for x in sent])
        many = np.concatenate([np.unpackbits(np.frombuffer(m, np.uint8), count=len(c)) for m, c in zip(table.column("many").to_pylist(), sent)])
        codes, checks = np.concatenate(sent), np.concatenate([np.frombuffer(x, "<u4") for x in table.column("checks").to_pylist()])
        order = np.lexsort((bucket, checks, codes))
        codes, checks, bucket, many = codes[order], checks[order], bucket[order], many[order]
        first = np.flatnonzero(np.r_[True, (codes[1:] != codes[:-1]) | (checks[1:] != checks[:-1])])
        n = np.diff(np.r_[first, len(codes)])
        recurs = (n > 1) | (many[first] > 0)
        first, n = first[recurs], n[recurs]
        drawn = mix((checks[first] >> np.uint32(16)).astype(np.uint64)) % n.astype(np.uint64)
        owner = bucket[first + np.where(n > spread, drawn.astype(np.int64), 0)]
        by = np.argsort(owner, kind="stable")
        first, n, owner = first[by], n[by], owner[by]
        held = bucket[np.repeat(first - (np.cumsum(n) - n), n) + np.arange(n.sum())]
        ends = np.cumsum(n)
        cut = np.flatnonzero(np.r_[True, owner[1:] != owner[:-1]]) if len(owner) else np.zeros(0, np.int64)
        spans = list(zip(cut.tolist(), [*cut[1:].tolist(), len(owner)]))
        return pa.table({
            "bucket": pa.array([owner[a] for a, _ in spans], pa.int32()),
            "keys": pa.array([codes[first[a:b]].tobytes() for a, b in spans], pa.binary()),
            "checks": pa.array([checks[first[a:b]].tobytes() for a, b in spans], pa.binary()),
            "counts": pa.array([n[a:b].astype("<u4").tobytes() for a, b in spans], pa.binary()),
            "held": pa.array([held[ends[a] - n[a] : ends[b - 1]].astype("<i4").tobytes() for a, b in spans], pa.binary()),
        })

    return rows.groupBy("shard").applyInArrow(count, OWNED)


def owned_keys(table: pa.Table) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(keys, checks, numbers of holders, holders) of a bucket's rows of ``owners``, sorted by key."""
    codes, checks, counts, held = (np.concatenate([np.frombuffer(x, kind) for x in table.column(c).to_pylist()]) for c, kind in (("keys", "<u8"), ("checks", "<u4"), ("counts", "<u4"), ("held", "<i4")))
    counts = counts.astype(np.int64)
    begin = np.cumsum(counts) - counts
    order = np.argsort(codes, kind="stable")
    n = counts[order]
    pick = np.repeat(begin[order] - (np.cumsum(n) - n), n) + np.arange(n.sum())
    return codes[order], checks[order], n, held[pick]


def classes(table: pa.Table, codes: np.ndarray, keys: Keys) -> np.ndarray:
    """The class of each of a bucket's sorted distinct codes, from the verdict rows of that bucket."""
    out = np.zeros(len(codes), np.uint8)
    shards, bounds = keys.cuts(codes)
    got = {s: (k, c) for s, k, c in zip(*(table.column(c).to_pylist() for c in ("shard", "known", "classes")))}
    for i, shard in enumerate(shards.tolist()):
        a, b = bounds[i], bounds[i + 1]
        known, found = got[shard]
        out[a:b][np.unpackbits(np.frombuffer(known, np.uint8), count=b - a).astype(bool)] = np.frombuffer(found, np.uint8)
    return out
