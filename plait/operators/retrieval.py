"""Nearest stories of articles within a time window, all stories over a similarity, and similar pairs: products of blocks, of which bounds leave out most.

Vectors whose nearest pivot, of a few, is the same and that are about equally far from it form a ball: a ring around the pivot.  By the triangle inequality for angles, no product between two balls
exceeds the cosine of the least angle that the pivots' distance and the rings allow (times the lengths), and none is below that of the greatest.  So from the balls' numbers alone it is known which of them can hold an answer: for a threshold, those whose
upper bound reaches it; for the best k, those whose upper bound reaches the value that k stories are sure to have.  Only blocks of such balls meet.  Balls
are also cut by time slots as long as the window, since stories of earlier slots never answer.  Whatever the pivots are, the rows are the same; how many products are made is theirs.

A meeting of two blocks is one task's matrix product; only the best k rows of an article, or pairs over the threshold, leave it.  Under a threshold the product is made over the
strongest dimensions first, and what they and the length of the rest (Cauchy-Schwarz) cannot bring over it is dropped.  Stories that are few travel with the function instead, as an index
of balls that each batch of articles visits from the best bound down.  Similarities that decide are computed pair by pair, so they do not depend on how blocks are cut.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window, functions as F

from ..functions.times import micros
from ..sources.scratch import materialize
from .components import components

BLOCK = 4096
#: Rows of a block whose products with another are held at a time, and pairs looked at in one go, where only connections are asked for.
STRIP, PAIRS = 256, 1 << 14
#: Vectors of each side that all of the other meet first, where only connections are asked for, and groups whose rows need not meet each other.
HUBS, GROUPS = 1024, 16
#: Stories that may travel with the function, and their bytes.
SHIPPED_ROWS, SHIPPED = 4096, 64 << 20
#: Balls of a side at most, vectors of which pivots are chosen, rounding errors of a bound.
BALLS, SAMPLE, SLACK = 1024, 2048, 1e-9
#: Width of a ring around a pivot, as an angle, and more rings than there can be.
RING, RINGS = 0.3, 16


def matrix(column: pa.Array) -> np.ndarray:
    """A column of equally long lists as rows."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    return column.flatten().to_numpy(zero_copy_only=False).reshape(len(column), -1) if len(column) else np.zeros((0, 1))


def unit(m: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(rows of length 1, their lengths); a zero row stays zero."""
    length = np.sqrt(np.einsum("ij,ij->i", m, m))
    return m / np.where(length == 0, 1.0, length)[:, None], length


def choose_pivots(sample: np.ndarray, most: int) -> np.ndarray:
    """Up to ``most`` directions: each next one is the sample's vector that is farthest from those before."""
    rows, length = unit(sample)
    rows = rows[length > 0]
    if not len(rows):
        return np.eye(1, sample.shape[1])
    chosen = [0]
    near = rows @ rows[0]
    while len(chosen) < min(most, len(rows)) and near.min() < 0.9999:
        chosen.append(int(near.argmin()))
        near = np.maximum(near, rows @ rows[chosen[-1]])
    return rows[chosen]


def placed(m: np.ndarray, pivots: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(ball, angle to its pivot, length) of each row; a ball's number is that of its pivot and ring.  Zero vectors fit any ball: their products are none."""
    rows, length = unit(m)
    cos = rows @ pivots.T
    best = cos.argmax(axis=1)
    angle = np.where(length == 0, 0.0, np.arccos(np.clip(cos[np.arange(len(m)), best], -1, 1)))
    return best * RINGS + (angle / RING).astype(int), angle, length


class Balls:
    """The numbers of some balls: ball, least and greatest angle to its pivot, least and greatest length, rows, time slot, group (0: none, else its rows need not meet each other)."""

    def __init__(self, ball, near, far, low, high, rows, slot=None, group=None):
        self.ball, self.near, self.far, self.low, self.high, self.rows = np.asarray(ball, int), *(np.asarray(x, float) for x in (near, far, low, high)), np.asarray(rows, np.int64)
        self.slot, self.group = (np.zeros(len(self.ball), np.int64) if x is None else np.asarray(x, np.int64) for x in (slot, group))

    @classmethod
    def of(cls, vectors: np.ndarray, pivots: np.ndarray) -> tuple[Balls, np.ndarray]:
        """(the balls of some rows, the rows in the balls' order)."""
        ball, angle, length = placed(vectors, pivots)
        order = np.argsort(ball, kind="stable")
        known, begin, rows = np.unique(ball[order], return_index=True, return_counts=True)
        fold = lambda f, x: f.reduceat(x[order], begin) if len(begin) else np.zeros(0)
        return cls(known, fold(np.minimum, angle), fold(np.maximum, angle), fold(np.minimum, length), fold(np.maximum, length), rows), order

    def __len__(self) -> int:
        return len(self.ball)


def ball_bounds(left: Balls, right: Balls, pivots: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(least, greatest) product that a row of each left ball can have with a row of each right ball."""
    apart = np.arccos(np.clip(pivots @ pivots.T, -1, 1))[left.ball // RINGS][:, right.ball // RINGS]
    far, other, near, inner = left.far[:, None], right.far[None, :], left.near[:, None], right.near[None, :]
    least = np.maximum.reduce([apart - far - other, near - apart - other, inner - apart - far, np.zeros_like(apart)])
    up, down = np.cos(np.minimum(least, math.pi)), np.cos(np.minimum(apart + far + other, math.pi))
    few, many = left.low[:, None] * right.low[None, :], left.high[:, None] * right.high[None, :]
    return np.where(down > 0, down * few, down * many) - SLACK, np.maximum(up, 0) * many + SLACK


def ball_meetings(left: Balls, right: Balls, pivots: np.ndarray, least: float | None = None, k: int | None = None, ahead: int | None = None) -> np.ndarray:
    """Which left balls must meet which right ones: for all products of ``least``, or for the best ``k`` of each left row.  ``ahead``: so many slots later at most."""
    down, up = ball_bounds(left, right, pivots)
    reached = (right.slot[None, :] >= left.slot[:, None] - 1) & ((left.group[:, None] != right.group[None, :]) | (left.group[:, None] == 0))
    if ahead is not None:
        reached &= right.slot[None, :] <= left.slot[:, None] + ahead
    if k is not None:  # stories of the own slot and later ones are in the window of every article of a slot
        sure = right.slot[None, :] >= left.slot[:, None]
        order = np.argsort(-np.where(sure, down, -np.inf), axis=1, kind="stable")
        many = np.cumsum(np.where(np.take_along_axis(sure, order, 1), right.rows[order], 0), axis=1) >= k
        at = many.argmax(axis=1)
        row = np.arange(len(left))
        floor = np.where(many.any(axis=1), np.where(sure, down, -np.inf)[row, order[row, at]], -np.inf)[:, None] if len(right) else np.full((len(left), 1), -np.inf)
    else:
        floor = np.full((len(left), 1), least)
    return reached & (up >= floor)


class Found:
    """Products worth keeping: (row, column, approximate value), and each row's k-th best so far."""

    def __init__(self, rows: int, k: int):
        self.k, self.top, self.parts = k, np.full((rows, k), -np.inf), []

    def add(self, rows: np.ndarray, cols: np.ndarray, sims: np.ndarray) -> None:
        """sims: a product of the numbered rows with the numbered columns; minus infinity is none."""
        together = np.concatenate([self.top[rows], sims], axis=1)
        self.top[rows] = np.partition(together, -self.k, axis=1)[:, -self.k :]
        i, j = np.nonzero((sims >= self.floor(rows)[:, None]) & np.isfinite(sims))
        self.parts.append((rows[i], cols[j], sims[i, j]))

    def floor(self, rows: np.ndarray) -> np.ndarray:
        return self.top[rows].min(axis=1) - SLACK

    def best(self, a: np.ndarray, b: np.ndarray, rank: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(row, column, product) of the k best of each row; equal products go by the columns' rank."""
        if not self.parts:
            return np.zeros(0, int), np.zeros(0, int), np.zeros(0)
        rows, cols, sims = (np.concatenate(x) for x in zip(*self.parts))
        kept = sims >= self.floor(rows)
        rows, cols = rows[kept], cols[kept]
        exact = np.einsum("ij,ij->i", a[rows], b[cols])
        order = np.lexsort((rank[cols], -exact, rows))
        rows, cols, exact = rows[order], cols[order], exact[order]
        kept = np.arange(len(rows)) - np.searchsorted(rows, rows) < self.k
        return rows[kept], cols[kept], exact[kept]


def ranks(ids: pa.Array) -> np.ndarray:
    """The places of ids in their order."""
    out = np.empty(len(ids), np.int64)
    out[np.argsort(np.asarray(ids.to_pylist(), dtype=object), kind="stable")] = np.arange(len(ids))
    return out


def over(a: np.ndarray, b: np.ndarray, least: float) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(row, column, product) of all products of at least ``least``: the strongest quarter of the dimensions first, then what the rest may still bring."""
    if not len(a) or not len(b):
        return np.zeros(0, int), np.zeros(0, int), np.zeros(0)
    order = np.argsort(-np.einsum("ij,ij->j", b, b), kind="stable")
    a, b = a[:, order], b[:, order]
    cut = max(8, a.shape[1] // 4)
    rest = lambda m: np.sqrt(np.einsum("ij,ij->i", m[:, cut:], m[:, cut:]))
    near = a[:, :cut] @ b[:, :cut].T + rest(a)[:, None] * rest(b)[None, :] >= least - SLACK
    if near.sum() * 8 > near.size:  # so many that one product is less work
        near &= a @ b.T >= least - SLACK
    i, j = np.nonzero(near)
    parts = []
    for at in range(0, len(i), 1 << 16):
        x, y = i[at : at + (1 << 16)], j[at : at + (1 << 16)]
        sims = np.einsum("ij,ij->i", a[x], b[y])
        kept = sims >= least
        parts.append((x[kept], y[kept], sims[kept]))
    return tuple(np.concatenate(p) for p in zip(*parts)) if parts else (i, j, np.zeros(0))


class BallIndex:
    """Stories that travel with the function, ball by ball; ``products`` counts the products that were made."""

    def __init__(self, ids: pa.Array, at: np.ndarray, vectors: np.ndarray, of_ball: int = 32, ranked: bool = True):
        pivots = choose_pivots(vectors[:: max(1, len(vectors) // SAMPLE)], max(1, len(vectors) // of_ball))
        self.balls, order = Balls.of(vectors, pivots)
        self.ids, self.at, self.vectors, self.rank = ids.take(pa.array(order)), at[order], vectors[order], ranks(ids)[order] if ranked else None
        ends = np.cumsum(self.balls.rows)
        self.spans = list(zip((ends - self.balls.rows).tolist(), ends.tolist()))
        self.centre = pivots[self.balls.ball // RINGS]
        self.products = 0

    def _bounds(self, a: np.ndarray) -> np.ndarray:
        rows, length = unit(a)
        angle = np.arccos(np.clip(rows @ self.centre.T, -1, 1))
        least = np.maximum(np.maximum(angle - self.balls.far[None, :], self.balls.near[None, :] - angle), 0)
        return np.maximum(np.cos(least), 0) * length[:, None] * self.balls.high[None, :] + SLACK

    def top(self, a: np.ndarray, since: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(row, story, product) of each row's k best stories seen since its time."""
        found, bounds = Found(len(a), k), self._bounds(a)
        order, left = np.argsort(-bounds, axis=1, kind="stable"), np.arange(len(a))
        for nth in range(order.shape[1]):  # each row from its best bound down, until none is left that could do better
            ball = order[left, nth]
            kept = bounds[left, ball] >= found.floor(left)
            left, ball = left[kept], ball[kept]
            if not len(left):
                break
            for b in np.unique(ball):
                rows, (x, y) = left[ball == b], self.spans[b]
                sims = a[rows] @ self.vectors[x:y].T
                self.products += sims.size
                sims[since[rows, None] > self.at[None, x:y]] = -np.inf
                found.add(rows, np.arange(x, y), sims)
        return found.best(a, self.vectors, self.rank)

    def over(self, a: np.ndarray, since: np.ndarray, until: np.ndarray, least: float) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(row, story, product) of all stories over the threshold that were seen between the row's times."""
        bounds, parts = self._bounds(a), []
        for ball, (x, y) in enumerate(self.spans):
            rows = np.flatnonzero(bounds[:, ball] >= least)
            self.products += len(rows) * (y - x)
            i, j, sims = over(a[rows], self.vectors[x:y], least)
            kept = (since[rows[i]] <= self.at[x + j]) & (self.at[x + j] <= until[rows[i]])
            parts.append((rows[i][kept], (x + j)[kept], sims[kept]))
        return tuple(np.concatenate(p) for p in zip(*parts))


def _side(rows: DataFrame, at: str) -> DataFrame:
    return rows.select("id", micros(F.col(at)).alias("at"), F.col("vector").cast("array<double>").alias("v"), F.lit(0).cast("long").alias("group")).where("v is not null and at is not null")


def _place(rows: DataFrame, pivots: np.ndarray) -> DataFrame:
    """Rows with their ball, the angle to its pivot and their length."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            ball, angle, length = placed(matrix(b.column("v")), pivots) if b.num_rows else (np.zeros(0, int), np.zeros(0), np.zeros(0))
            yield pa.RecordBatch.from_arrays([*b.columns, pa.array(ball.astype(np.int32)), pa.array(angle), pa.array(length)], names=[*b.schema.names, "ball", "angle", "len"])

    fields = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in rows.schema.fields)
    return rows.mapInArrow(run, f"{fields}, ball int, angle double, len double")


def _balls(rows: DataFrame, width: int | None) -> Balls:
    """The balls of a side: ``BALLS`` times some rings at most."""
    slot = F.lit(0).cast("long") if width is None else F.floor(F.col("at") / width)
    least, most = [F.min(c).alias(f"{c}_a") for c in ("angle", "len")], [F.max(c).alias(f"{c}_b") for c in ("angle", "len")]
    found = rows.groupBy("group", slot.alias("slot"), "ball").agg(*least, *most, F.count(F.lit(1)).alias("rows")).orderBy("group", "slot", "ball").toPandas()
    return Balls(found["ball"], found["angle_a"], found["angle_b"], found["len_a"], found["len_b"], found["rows"], found["slot"], found["group"])


def _cut(balls: Balls, block: int, packed: bool) -> tuple[np.ndarray, np.ndarray]:
    """(first block, blocks) of each ball: blocks of its own or, packed, one that it shares with the small balls beside it."""
    parts = -(-balls.rows // block)
    if not packed:
        return np.cumsum(parts) - parts, parts
    first, now, held, of = np.zeros(len(balls), np.int64), -1, block, None
    for i, (rows, group) in enumerate(zip(balls.rows.tolist(), balls.group.tolist())):
        if held + rows > block or group != of:
            now, held, of = now + 1, 0, group
        first[i], held = now, held + rows
        now += parts[i] - 1
    return first, parts


def _spans(first: np.ndarray, parts: np.ndarray, met: np.ndarray) -> list[tuple[int, int]]:
    """The numbers of the blocks of some balls, as spans, each number once."""
    low, high = first[met], first[met] + parts[met] - 1
    if not len(low):
        return []
    new = np.flatnonzero(np.r_[True, low[1:] > np.maximum.accumulate(high)[:-1] + 1])
    return list(zip(low[new].tolist(), np.maximum.reduceat(high, new).tolist()))


def _numbered(rows: DataFrame, balls: Balls, width: int | None, cut: tuple, meets: np.ndarray, others_cut: tuple, own: str, others: str) -> DataFrame:
    """Rows with the number of their block, once for each block of the other side that it meets."""
    table = pd.DataFrame({"group": balls.group, "slot": balls.slot, "ball": balls.ball, "first": cut[0], "parts": cut[1], "spans": [_spans(*others_cut, np.flatnonzero(row)) for row in meets]})
    spans = rows.sparkSession.createDataFrame(table.to_dict("records"), "group long, slot long, ball int, first long, parts long, spans array<struct<a:long,b:long>>")
    slot = F.lit(0).cast("long") if width is None else F.floor(F.col("at") / width)
    met = rows.withColumn("slot", slot).join(F.broadcast(spans), ["group", "slot", "ball"])
    met = met.withColumn(own, F.col("first") + F.pmod(F.xxhash64("id"), F.col("parts")))
    return met.withColumn(others, F.explode(F.flatten(F.transform("spans", lambda s: F.sequence(s["a"], s["b"]))))).select("id", "at", "v", own, others)


def _copies(balls: Balls, meets: np.ndarray, parts: np.ndarray) -> float:
    """How often a row is sent, on average."""
    return float((balls.rows * (meets @ parts)).sum() / max(1, balls.rows.sum()))


def _answers(article_ids: pa.Array, story_ids: pa.Array, rows: np.ndarray, cols: np.ndarray, sims: np.ndarray) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([article_ids.take(pa.array(rows)), story_ids.take(pa.array(cols)), pa.array(sims.astype(float))], names=["article_id", "story_id", "similarity"])


def joined(label: np.ndarray, u: np.ndarray, v: np.ndarray) -> np.ndarray:
    """The least node that each node is connected with, once the nodes u are with the nodes v."""
    while len(u):
        least, new = np.minimum(label[u], label[v]), label.copy()
        for ends in (u, v, label[u], label[v]):
            np.minimum.at(new, ends, least)
        new = new[new]
        if (new == label).all():
            break
        label = new
    while (label[label] != label).any():
        label = label[label]
    return label


def connect(label: np.ndarray, u: np.ndarray, v: np.ndarray, a: np.ndarray, b: np.ndarray, fits, least: float) -> np.ndarray:
    """``label`` after the nodes u of the rows of a are joined with the nodes v of the rows of b wherever these fit and their product is at least so large.  Pairs that are connected
    already are passed over, so there is no list of all pairs, and a dense block costs a few strips of products.  ``fits`` (rows, columns): a matrix of truth values."""
    for begin in range(0, len(a), STRIP):
        rows = np.arange(begin, min(begin + STRIP, len(a)))
        apart = label[u[rows]][:, None] != label[v][None, :]
        rows, cols = rows[apart.any(axis=1)], np.flatnonzero(apart.any(axis=0))
        if not len(rows):
            continue
        i, j = np.nonzero((a[rows] @ b[cols].T >= least - SLACK) & (label[u[rows]][:, None] != label[v[cols]][None, :]) & fits(rows, cols))
        for at in range(0, len(i), PAIRS):
            x, y = rows[i[at : at + PAIRS]], cols[j[at : at + PAIRS]]
            kept = label[u[x]] != label[v[y]]
            x, y = x[kept], y[kept]
            kept = np.einsum("ij,ij->i", a[x], b[y]) >= least
            label = joined(label, u[x[kept]], v[y[kept]])
    return label


def _blocks_of(ids: pa.Array, codes: dict) -> np.ndarray:
    """Blocks as numbers that are the same wherever ``codes`` is."""
    found = pc.struct_field(ids, "block").dictionary_encode()
    table = np.array([codes.setdefault(x, len(codes)) for x in found.dictionary.to_pylist()] + [-1], np.int64)
    return table[found.indices.fill_null(len(table) - 1).to_numpy(zero_copy_only=False)]


class NodeIndex:
    """Vectors that travel with the function, and which of their nodes are known to be connected: the edges that join the nodes of batches of rows with them and them with each other."""

    def __init__(self, index: BallIndex):
        self.index, self.codes = index, {}
        self.block, coded = _blocks_of(index.ids, self.codes), pc.struct_field(index.ids, "node").dictionary_encode()
        self.node, self.names = coded.indices.to_numpy(), coded.dictionary
        self.label = np.arange(len(self.names))

    def edges(self, ids: pa.Array, a: np.ndarray, since: np.ndarray, until: np.ndarray, least: float) -> pa.RecordBatch:
        block, node = _blocks_of(ids, self.codes), pc.struct_field(ids, "node")
        known = pc.index_in(node, self.names)
        new = pc.unique(node.filter(pc.is_null(known)))
        u = pc.if_else(pc.is_null(known), pc.add(pc.index_in(node, new), len(self.names)), known).to_numpy(zero_copy_only=False).astype(np.int64)
        before = np.concatenate([self.label, len(self.names) + np.arange(len(new))])
        label, bounds = before, self.index._bounds(a)
        for ball, (x, y) in enumerate(self.index.spans):
            rows, at = np.flatnonzero(bounds[:, ball] >= least), self.index.at[x:y]
            fits = lambda i, j, rows=rows, at=at, x=x: (since[rows[i], None] <= at[None, j]) & (at[None, j] <= until[rows[i], None]) & (block[rows[i], None] == self.block[None, x + j])
            label = connect(label, u[rows], self.node[x:y], a[rows], self.index.vectors[x:y], fits, least)
        self.label, changed = label[: len(self.names)], np.flatnonzero(label != before)
        names = pa.concat_arrays([self.names, new])
        return pa.RecordBatch.from_arrays([names.take(pa.array(before[changed])), names.take(pa.array(label[changed]))], names=["a", "b"])


def _one(column) -> pa.Array:
    return column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column


def meetings(left: DataFrame, right: DataFrame, window: int, block: int, k: int | None = None, least: float | None = None, ahead: int | None = None, groups: int = 0) -> tuple[DataFrame, DataFrame] | None:
    """Both sides (id, at, v, group), a row for each task (lb, rb) in which it meets the other; None if a side is empty.  The rows of the right side that are seen before the
    window of the earliest left one are left out.  Where the bounds leave out so little that rows would be sent very often, small balls share blocks."""
    left, right = (rows if "group" in rows.columns else rows.withColumn("group", F.lit(0).cast("long")) for rows in (left, right))
    times = left.agg(F.min("at").alias("a"), F.max("at").alias("b")).first()
    right = right.where(F.col("at") >= F.lit((times["a"] or 0) - window))
    sample = right.orderBy(F.xxhash64("id")).limit(SAMPLE).toArrow()
    if times["a"] is None or not sample.num_rows:
        return None
    seen = right.agg(F.max("at").alias("b")).first()["b"]
    span = max(times["b"], seen) - times["a"] + 2 * window + 1
    width = max(window, 1, math.ceil(span / 256))
    pivots = choose_pivots(matrix(sample.column("v")), max(1, min(256, BALLS // math.ceil(span / width + 1) // (1 + groups))))
    left, right = _place(left, pivots), _place(right, pivots)
    lefts, rights = _balls(left, width), _balls(right, width)
    meets = ball_meetings(lefts, rights, pivots, least, k, None if ahead is None else 1 + math.ceil(ahead / width))
    packed = _copies(lefts, meets, -(-rights.rows // block)) > max(16, 2 * rights.rows.sum() / block) or _copies(rights, meets.T, -(-lefts.rows // block)) > max(16, 2 * lefts.rows.sum() / block)
    cuts = _cut(lefts, block, packed), _cut(rights, block, packed)
    return _numbered(left, lefts, width, cuts[0], meets, cuts[1], "lb", "rb"), _numbered(right, rights, width, cuts[1], meets.T, cuts[0], "rb", "lb")


def _shipped(rows: DataFrame, head: pa.Table, ranked: bool) -> BallIndex | None:
    return BallIndex(_one(head.column("id")), head.column("at").to_numpy(), matrix(head.column("v")), ranked=ranked) if head.num_rows else None


def _met(articles: DataFrame, stories: DataFrame, window_hours: int, block: int, shipped_bytes: int, k: int | None = None, least: float | None = None, ahead_hours: int | None = None) -> DataFrame:
    """(article_id, story_id, similarity) in which each article's k best stories, or all over ``least`` that were last seen at most ``ahead_hours`` after it, are."""
    window = window_hours * 3_600_000_000
    ahead = np.iinfo(np.int64).max // 4 if ahead_hours is None else ahead_hours * 3_600_000_000
    left, right = _side(articles, "published_at"), _side(stories, "last_seen")
    schema = f"article_id {left.schema['id'].dataType.simpleString()}, story_id {right.schema['id'].dataType.simpleString()}, similarity double"
    head = right.limit(SHIPPED_ROWS + 1).toArrow()
    if head.num_rows <= SHIPPED_ROWS and head.nbytes <= shipped_bytes:
        index = _shipped(right, head, k is not None)

        def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                for row in range(0, batch.num_rows if index else 0, 1024):
                    part = batch.slice(row, 1024)
                    a, at = matrix(part.column("v")), part.column("at").to_numpy()
                    yield _answers(part.column("id"), index.ids, *(index.top(a, at - window, k) if k is not None else index.over(a, at - window, at + ahead, least)))

        return left.mapInArrow(scan, schema)
    sides = meetings(left, right, window, block, k, least, None if ahead_hours is None else ahead)
    if sides is None:
        return left.sparkSession.createDataFrame([], schema)
    one, two = sides

    def meet(a: pa.Table, b: pa.Table) -> pa.Table:
        x, y = matrix(a.column("v")), matrix(b.column("v"))
        at, seen = a.column("at").to_numpy(), b.column("at").to_numpy()
        if not len(x) or not len(y):
            rows, cols, sims = np.zeros(0, int), np.zeros(0, int), np.zeros(0)
        elif k is None:
            rows, cols, sims = over(x, y, least)
            kept = (at[rows] - window <= seen[cols]) & (seen[cols] <= at[rows] + ahead)
            rows, cols, sims = rows[kept], cols[kept], sims[kept]
        else:
            found, product = Found(len(x), k), x @ y.T
            product[(at - window)[:, None] > seen[None, :]] = -np.inf
            found.add(np.arange(len(x)), np.arange(len(y)), product)
            rows, cols, sims = found.best(x, y, ranks(_one(b.column("id"))))
        return pa.Table.from_batches([_answers(_one(a.column("id")), _one(b.column("id")), rows, cols, sims)])

    return one.groupBy("lb", "rb").cogroup(two.groupBy("lb", "rb")).applyInArrow(meet, schema)


def top_stories(articles: DataFrame, stories: DataFrame, k: int = 10, window_hours: int = 96, block: int = BLOCK, shipped_bytes: int = SHIPPED) -> DataFrame:
    """(article_id, story_id, similarity, rank) of each article's ``k`` most similar stories last seen within the window before it, or later.

    articles: id, published_at, vector; stories: id, last_seen, vector.  Ids may be of any ordered type.  Rows without a vector or time take no
    part.  Rows that share an article id ask together: k stories at most answer, each once.  Up to ``SHIPPED_ROWS`` stories of up to ``shipped_bytes`` in all travel
    with the function and articles are not moved; more are dealt into blocks.  Either way the same rows come out.
    """
    met = _met(articles, stories, window_hours, block, shipped_bytes, k=k)
    once = met.repartition("article_id").groupBy("article_id", "story_id").agg(F.max("similarity").alias("similarity"))
    ranked = once.withColumn("rank", F.row_number().over(Window.partitionBy("article_id").orderBy(F.desc("similarity"), "story_id")))
    return ranked.where(F.col("rank") <= k)


def stories_over(articles: DataFrame, stories: DataFrame, least: float, window_hours: int = 96, ahead_hours: int | None = None, block: int = BLOCK, shipped_bytes: int = SHIPPED) -> DataFrame:
    """(article_id, story_id, similarity) of all stories at least so similar that were last seen within the window before the article, or later: at most
    ``ahead_hours`` later, if given."""
    return _met(articles, stories, window_hours, block, shipped_bytes, least=least, ahead_hours=ahead_hours)


def _edges_to(rows: DataFrame, head: pa.Table, before: int, after: int, least: float) -> DataFrame:
    """Edges (a, b) between the nodes of the rows and those that travel with the function: at most one for each row, and one for each of these in a task."""
    index = _shipped(rows, head, False)

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        nodes = NodeIndex(index) if index else None
        for batch in batches:
            for row in range(0, batch.num_rows if index else 0, 1024):
                part = batch.slice(row, 1024)
                at = part.column("at").to_numpy()
                yield nodes.edges(part.column("id"), matrix(part.column("v")), at - before, at + after, least)

    return rows.mapInArrow(scan, "a string, b string")


def nodes_over(articles: DataFrame, stories: DataFrame, least: float, window_hours: int = 96, ahead_hours: int | None = None, block: int = BLOCK, shipped_bytes: int = SHIPPED) -> DataFrame:
    """Edges (a, b) of the same connected components as the pairs of ``stories_over`` whose blocks are equal (nulls are): ids are structs of block and node, a text.

    Few stories travel with the function.  Of more, a sample of each side meets all of the other first, which connects most of what is dense; nodes then go by the component that they
    are in, and the largest components need not meet themselves.  The rest meets in blocks, and a task sends a spanning forest of its pairs.
    """
    window = window_hours * 3_600_000_000
    ahead = np.iinfo(np.int64).max // 4 if ahead_hours is None else ahead_hours * 3_600_000_000
    left, right = _side(articles, "published_at"), _side(stories, "last_seen")
    head = right.limit(SHIPPED_ROWS + 1).toArrow()
    if head.num_rows <= SHIPPED_ROWS and head.nbytes <= shipped_bytes:
        return _edges_to(left, head, window, ahead, least)
    some = lambda rows: rows.orderBy(F.xxhash64("id"), "at").limit(HUBS).toArrow()
    first = materialize(_edges_to(left, some(right), window, ahead, least).unionByName(_edges_to(right, some(left), ahead, window, least)), "hubs")
    roots = components(first, "hubs")
    large = [r["root"] for r in roots.groupBy("root").count().where(F.col("count") >= HUBS).orderBy(F.desc("count"), "root").limit(GROUPS).collect()]
    numbers = F.coalesce(*[F.when(F.col("root") == name, F.lit(n).cast("long")) for n, name in enumerate(large, 1)], F.lit(0).cast("long"))

    def grouped(rows: DataFrame) -> DataFrame:
        named = rows.drop("group").withColumn("node", F.col("id.node")).join(roots, "node", "left").withColumn("group", numbers)
        return named.select(F.struct(F.col("id.block").alias("block"), F.coalesce("root", "node").alias("node")).alias("id"), "at", "v", "group")

    sides = meetings(grouped(left), grouped(right), window, block, None, least, None if ahead_hours is None else ahead, len(large))
    if sides is None:
        return first
    one, two = sides

    def meet(a: pa.Table, b: pa.Table) -> pa.Table:
        x, y, nodes, codes = matrix(a.column("v")), matrix(b.column("v")), pc.struct_field(pa.concat_arrays([_one(a.column("id")), _one(b.column("id"))]), "node").dictionary_encode(), {}
        at, seen = a.column("at").to_numpy(), b.column("at").to_numpy()
        ours, theirs, node = _blocks_of(_one(a.column("id")), codes), _blocks_of(_one(b.column("id")), codes), nodes.indices.to_numpy()
        label = np.arange(len(nodes.dictionary))
        if len(x) and len(y):
            fits = lambda i, j: (at[i, None] - window <= seen[None, j]) & (seen[None, j] <= at[i, None] + ahead) & (ours[i, None] == theirs[None, j])
            label = connect(label, node[: len(x)], node[len(x) :], x, y, fits, least)
        moved = np.flatnonzero(label != np.arange(len(label)))
        return pa.table({"a": nodes.dictionary.take(pa.array(moved)), "b": nodes.dictionary.take(pa.array(label[moved]))})

    return first.unionByName(one.groupBy("lb", "rb").cogroup(two.groupBy("lb", "rb")).applyInArrow(meet, "a string, b string"))


def similar_pairs(stories: DataFrame, least: float, block: int = BLOCK, most: int | None = None) -> DataFrame:
    """(a_id, b_id, similarity), a_id < b_id, of all stories whose vectors' product is at least ``least``; with ``most`` every task returns its best
    so many, among which the best of all are."""
    rows = stories.select("id", F.lit(0).cast("long").alias("at"), F.col("vector").cast("array<double>").alias("v"), F.lit(0).cast("long").alias("group")).where("v is not null")
    kind = rows.schema["id"].dataType.simpleString()
    schema = f"a_id {kind}, b_id {kind}, similarity double"
    sample = rows.orderBy(F.xxhash64("id")).limit(SAMPLE).toArrow()
    if not sample.num_rows:
        return rows.sparkSession.createDataFrame([], schema)
    pivots = choose_pivots(matrix(sample.column("v")), 1 if sample.num_rows <= min(block, SAMPLE - 1) else min(256, BALLS))
    rows = _place(rows, pivots)
    balls = _balls(rows, None)
    meets = ball_meetings(balls, balls, pivots, least)
    cut = _cut(balls, block, False)
    both = _numbered(rows, balls, None, cut, meets | meets.T, cut, "b", "o").select(F.least("b", "o").alias("x"), F.greatest("b", "o").alias("y"), "b", "id", "v")

    def meet(part: pa.Table) -> pa.Table:
        x, y, b = part.column("x")[0].as_py(), part.column("y")[0].as_py(), part.column("b").to_numpy()
        one, two = part.filter(pa.array(b == x)), part.filter(pa.array(b == y))
        i, j, sims = over(matrix(one.column("v")), matrix(two.column("v")), least)
        ids = ranks(_one(pa.concat_tables([one, two]).column("id")))
        mine, their = ids[: one.num_rows][i], ids[one.num_rows :][j]
        if x == y:
            mine, their = ranks(_one(one.column("id")))[i], ranks(_one(two.column("id")))[j]
            kept = mine < their
            i, j, sims, mine, their = i[kept], j[kept], sims[kept], mine[kept], their[kept]
        a, c = _one(one.column("id")).take(pa.array(i)), _one(two.column("id")).take(pa.array(j))
        if most is not None and len(i) > most:
            low, high = np.minimum(mine, their), np.maximum(mine, their)
            best = np.lexsort((high, low, -sims))[:most]
            a, c, sims, mine, their = a.take(pa.array(best)), c.take(pa.array(best)), sims[best], mine[best], their[best]
        swap = pa.array(mine > their)
        less, more = pa.compute.if_else(swap, c, a), pa.compute.if_else(swap, a, c)
        differ = pa.compute.not_equal(less, more)
        return pa.table({"a_id": less, "b_id": more, "similarity": pa.array(sims)}).filter(differ)

    return both.groupBy("x", "y").applyInArrow(meet, schema)
