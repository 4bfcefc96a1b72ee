"""Benchmark decontamination by greedy string tiling (Wise's RKR-GST) over words.

1. Seeds: hashed runs of ``least`` words, lower-cased, that a document shares with a benchmark item, found by one lookup
   of each document run among the benchmark's runs.  Only items of which the shared runs cover enough words go on.
2. Tiling: for each such (document, item), running Karp-Rabin hashes over all runs of a length tell whether one is common; the greatest
   such length is found by halving, its matches are compared word by word and marked in order of place, and marked words stand in
   no further run.  That repeats until no run of ``least`` words is common.  Tiles may lie in any order, so an
   item whose parts were moved about is still covered.
3. Verdict: an item of which the tiles cover at least ``coverage`` of the words contaminates the document.

The benchmark is the stated query set.  It travels with the function in blocks of at most ``block_words`` words, one
block as a rule; a larger benchmark takes more passes over the documents and no more memory in a task.  The driver builds the plan of all passes and so holds the whole benchmark meanwhile: it is meant
for benchmarks of up to some 100 MB.  Tiling needs memory in proportion to the
document's words near seeds, however often its words repeat.

Defined results: null texts and texts without words have no seeds and match nothing; an item with fewer words than
``least`` must stand whole and in order; items with no words are left out, and those with a null id unless ``unnamed`` asks for them, as the query and the
pipeline do: they are reported with a null item; equal items are reported each; repeated rows give
repeated results; an empty table on either side gives an empty result; other columns are
ignored, whatever their names, and a result column of the id column's name gets a trailing underscore.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from .common import release, schema_of
from .words import Words, mix, rolled, slices


@dataclass(frozen=True)
class Settings:
    least: int = 5
    coverage: float = 0.6
    block_words: int = 1_000_000


def _near(doc: np.ndarray, item: np.ndarray, k: int) -> np.ndarray:
    """Places of the document's words under a run of k words that the item has too."""
    runs = np.flatnonzero(np.isin(rolled(doc, k), rolled(item, k)))
    under = np.zeros(len(doc) + 1, np.int32)
    under[runs] += 1
    np.subtract.at(under, runs + k, 1)
    return np.flatnonzero(np.cumsum(under[:-1]) > 0)


def _marks(places: np.ndarray, side: int) -> np.ndarray:
    """Hashes for marked words, all different: nothing equals them."""
    return mix(places.astype(np.uint64) * np.uint64(2) + np.uint64(side) + np.uint64(0x2545F4914F6CDD1D))


def tile(doc: np.ndarray, item: np.ndarray, k: int) -> list[tuple[int, int, int]]:
    """Greedy tiles (place in doc, place in item, words), longest first; ties go to the earliest place.  Words are numbers, equal
    for equal words."""
    k = min(k, len(item)) or 1
    if len(doc) < k or not len(item):
        return []
    places = _near(doc, item, k)
    if not len(places):
        return []
    apart = np.flatnonzero(np.diff(places) > 1)  # a mark between stretches, so that no run crosses
    places = np.insert(places, apart + 1, -1)
    words, other = np.where(places < 0, np.uint64(0), doc[places]), item
    x, y = mix(words), mix(other)
    gap = np.flatnonzero(places < 0)
    x[gap] = _marks(gap, 0)
    tiles, longest = [], min(len(x), len(y))
    left = len(y)

    def common(n: int) -> bool:
        return n <= longest and bool(np.isin(rolled(y, n), rolled(x, n)).any())

    while left >= k:
        if not common(k):
            break
        low, high = k, longest  # the greatest common length lies between
        while low < high:
            middle = (low + high + 1) // 2
            low, high = (middle, high) if common(middle) else (low, middle - 1)
        n = longest = low
        one, two = rolled(x, n), rolled(y, n)
        of: dict[int, list[int]] = {}
        for j, key in enumerate(two.tolist()):
            of.setdefault(key, []).append(j)
        hits = np.flatnonzero(np.isin(one, two))
        free_x, free_y, taken = 0, np.ones(len(y), bool), False
        for i, key in zip(hits.tolist(), one[hits].tolist()):
            if i < free_x:
                continue
            open_at = of[key]
            while open_at and not free_y[open_at[0] : open_at[0] + n].all():
                open_at.pop(0)
            j = next((j for j in open_at if free_y[j : j + n].all() and np.array_equal(words[i : i + n], other[j : j + n])), None)
            if j is None:
                if not any(of.values()):
                    break
                continue
            tiles.append((int(places[i]), j, n))
            x[i : i + n], y[j : j + n] = _marks(np.arange(i, i + n), 0), _marks(np.arange(j, j + n), 1)
            free_x, taken = i + n, True
            free_y[j : j + n] = False
            left -= n
        if not taken:  # equal hashes of different words
            longest -= 1
            if longest < k:
                break
    return tiles


class _Block:
    def __init__(self, ids: list, texts: list[str], s: Settings):
        words = Words(pa.array(texts, pa.large_string()), lower=True)
        hashes = words.hashes()
        self.ids, self.s = ids, s
        self.items = [hashes[a:b] for a, b in zip(words.first[:-1], words.first[1:])]
        self.words = [[words.text(i, i + 1) for i in range(a, b)] for a, b in zip(words.first[:-1].tolist(), words.first[1:].tolist())]
        self.seeds: dict[int, tuple[np.ndarray, np.ndarray, np.ndarray]] = {}  # run length -> sorted run hashes, items and places of each
        for k in sorted({min(s.least, len(x)) for x in self.items}):
            of = [(rolled(x, k), np.full(len(x) - k + 1, n), np.arange(len(x) - k + 1)) for n, x in enumerate(self.items) if min(s.least, len(x)) == k]
            runs, owner, place = (np.concatenate(x) for x in zip(*of))
            order = np.argsort(runs, kind="stable")
            self.seeds[k] = runs[order], owner[order], place[order]

    def _covered(self, rows: np.ndarray, low: np.ndarray, high: np.ndarray, k: int):
        """(row, item) of which the runs that the row holds cover enough words of the item; (rows, low, high) are distinct runs by row."""
        _, owner, place = self.seeds[k]
        at = 0
        bounds = np.r_[0, np.flatnonzero(np.diff(rows)) + 1, len(rows)]  # whole rows at a time, so that memory follows one row
        sizes = np.concatenate(([0], np.cumsum(high - low)))
        while at < len(bounds) - 1:
            to = max(at + 1, int(np.searchsorted(sizes[bounds], sizes[bounds[at]] + (1 << 20), side="right")) - 1)
            a, b = bounds[at], bounds[to]
            n = (high - low)[a:b]
            pick = np.repeat(low[a:b] - (np.cumsum(n) - n), n) + np.arange(n.sum())
            row, item, start = np.repeat(rows[a:b], n), owner[pick], place[pick]
            order = np.lexsort((start, item, row))
            row, item, start = row[order], item[order], start[order]
            new = np.r_[True, (np.diff(row) != 0) | (np.diff(item) != 0)]
            adds = np.minimum(np.r_[k, np.diff(start)], k)
            adds[new] = k
            first = np.flatnonzero(new)
            covered = np.add.reduceat(adds, first)
            lengths = np.array([len(self.items[i]) for i in item[first].tolist()])
            enough = covered >= self.s.coverage * lengths - 1e-9
            yield from zip(row[first][enough].tolist(), item[first][enough].tolist())
            at = to

    def matches(self, texts: pa.Array) -> list[tuple]:
        """(row, item id, coverage, tiles, longest tile) of the contaminated rows of a column."""
        words = Words(texts, lower=True)
        hashes, out = words.hashes(), []
        pairs = set()
        for k, (runs, *_) in self.seeds.items():
            own, at = words.windows(hashes, k)
            low = np.searchsorted(runs, own)
            hit = np.flatnonzero(runs[np.minimum(low, len(runs) - 1)] == own) if len(runs) else np.zeros(0, np.int64)
            if not len(hit):
                continue
            rows = np.searchsorted(words.first, at[hit], side="right") - 1
            order = np.lexsort((low[hit], rows))
            rows, starts = rows[order], low[hit][order]
            once = np.r_[True, (np.diff(rows) != 0) | (np.diff(starts) != 0)]
            rows, starts = rows[once], starts[once]
            pairs.update(self._covered(rows, starts, np.searchsorted(runs, runs[starts], side="right"), k))
        known, told = -1, []
        for row, n in sorted(pairs):
            if row != known:
                known, told = row, [words.text(i, i + 1) for i in range(words.first[row], words.first[row + 1])]
            numbers = {w: i for i, w in enumerate(dict.fromkeys(self.words[n]))}
            none = len(numbers)
            item = np.array([numbers[w] for w in self.words[n]], np.uint64)
            tiles = tile(np.array([numbers.get(w, none) for w in told], np.uint64), item, self.s.least)
            share = sum(t[2] for t in tiles) / len(item)
            if share >= self.s.coverage:
                out.append((row, self.ids[n], share, len(tiles), max(t[2] for t in tiles)))
        return out


def _blocks(benchmark: DataFrame, item_col: str, text_col: str, s: Settings, unnamed: bool):
    """The benchmark in blocks of about ``block_words`` words, one at a time on the driver."""
    items = benchmark.select(F.col(item_col).cast("long").alias("id"), F.col(text_col).cast("string").alias("text")).where((F.col("id").isNotNull() | F.lit(unnamed)) & F.col("text").rlike(r"[^\x20\x09-\x0D]"))
    total = items.agg(F.coalesce(F.sum(F.octet_length("text")), F.lit(0)).alias("n")).first()["n"]
    count = max(1, math.ceil(total / (6 * s.block_words)))
    for k in range(count):
        yield items.where(F.pmod(F.xxhash64("id", "text"), F.lit(count)) == k).orderBy("id", "text").toArrow()


def contaminated(docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text", item_col: str = "item_id", item_text_col: str = "text", settings: Settings = Settings(), unnamed: bool = False) -> DataFrame:
    """One row for each document and benchmark item that it contains: coverage, tiles and the longest tile's words."""
    out = schema_of(docs, [id_col], "item_id long, coverage double, n_tiles long, longest_tile long")
    source = docs.select(F.col(id_col), F.col(text_col).cast("string").alias("__text"))
    found = None
    for table in _blocks(benchmark, item_col, item_text_col, settings, unnamed):
        ids, texts = table.column("id").to_pylist(), table.column("text").to_pylist()

        def run(batches, ids=ids, texts=texts):
            release()
            block = _Block(ids, texts, settings)
            for batch in batches:
                for row, piece in slices(batch.column(1)):
                    got = block.matches(piece)
                    rows = pa.array([row + g[0] for g in got], pa.int64())
                    columns = [pa.array([g[i] for g in got], kind) for i, kind in ((1, pa.int64()), (2, pa.float64()), (3, pa.int64()), (4, pa.int64()))]
                    yield pa.RecordBatch.from_arrays([batch.column(0).take(rows), *columns], names=out.fieldNames())
            release()

        part = source.mapInArrow(run, out)
        found = part if found is None else found.unionByName(part)
    return found
