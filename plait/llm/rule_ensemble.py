"""Quality classifier as a sparse rule ensemble (after Friedman and Popescu's RuleFit).

Shallow boosted trees over text statistics give conjunctive rules (every tree path is one), a lasso logistic
regression picks and weighs a few of them, and the picked rules are compiled into one Spark column expression over
the statistics, so that scoring is a plain projection.

``fit`` uses a bounded sample of labelled rows (``max_rows``, by a seeded hash of the id); scoring reads every text.

Defined results: a null text counts as an empty one, all statistics 0; without usable labels, or with one class only,
the score is the (smoothed) share of label 1; several labels of one id count as their rounded mean, of several
texts of one id the one with the least statistics, in their order, is learned from; repeated rows give repeated rows; statistics are finite for any text, so scores lie in 0 to 1; other columns are
ignored, whatever their names, and a result column of a carried column's name gets a trailing underscore.
"""

from __future__ import annotations

import math
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from .common import free_names, scan_texts
from .words import Words, mix

STATISTICS = (
    "words", "mean_word", "symbol_share", "upper_share", "digit_share", "punct_share", "exclaim_share", "bar_share", "non_ascii_share",
    "distinct_words", "repeated_pairs", "repeated_trigrams", "adjacent_repeats", "words_per_line", "lines", "space_share", "longest_word", "distinct_lines",
)


@dataclass(frozen=True)
class Settings:
    max_rows: int = 12000
    trees: int = 40
    depth: int = 3
    shrinkage: float = 0.2
    bins: int = 24
    min_leaf: int = 8
    penalty: float = 0.002
    steps: int = 300
    threshold: float = 0.3
    seed: int = 5


@dataclass
class Model:
    """Rules as tuples of (statistic, '<=' or '>', cut), their weights, and the intercept of the log-odds."""

    intercept: float
    rules: list[tuple[tuple[str, str, float], ...]] = field(default_factory=list)
    weights: list[float] = field(default_factory=list)

    def score(self) -> Column:
        """The ensemble as one column expression over the statistics."""
        total = F.lit(float(self.intercept))
        for rule, weight in zip(self.rules, self.weights):
            terms = [F.col(name) <= cut if sign == "<=" else F.col(name) > cut for name, sign, cut in rule]
            every = terms[0]
            for term in terms[1:]:
                every = every & term
            total = total + F.when(every, F.lit(float(weight))).otherwise(F.lit(0.0))
        return F.lit(1.0) / (F.lit(1.0) + F.exp(-total))


def statistics(texts: pa.Array) -> list[np.ndarray]:
    """The statistics of each text, in the order of STATISTICS."""
    words = Words(texts)
    raw, at = words.raw, words.at
    size = np.diff(at)
    per = lambda flags: np.diff(np.concatenate(([0], np.cumsum(flags)))[at])
    over = lambda a, b: np.where(b > 0, a / np.maximum(b, 1), 0.0)
    kinds = np.zeros(256, np.uint8)
    for kind, members in ((1, range(65, 91)), (2, range(48, 58)), (3, b"#*$%&|<>^~=+@\\{}[]_"), (4, b".,;:'\"()?-/"), (5, b"!"), (6, b" \t\n\r\v\f")):
        kinds[list(members)] = kind
    code = kinds[raw]
    n = words.counts
    doc = np.repeat(np.arange(len(texts)), n)
    hashes = words.hashes()
    tag = mix(np.arange(1, len(texts) + 1).astype(np.uint64))

    def repeated(k: int) -> np.ndarray:
        """Share of k-word windows that stand more than once in their text."""
        windows, first = words.windows(hashes, k)
        if not len(windows):
            return np.zeros(len(texts))
        own = doc[first]
        _, inverse, counts = np.unique(mix(windows + tag[own]), return_inverse=True, return_counts=True)
        return over(np.bincount(own, counts[inverse] > 1, len(texts)), np.bincount(own, minlength=len(texts)))

    distinct = np.zeros(len(texts))
    if len(hashes):
        _, first = np.unique(mix(hashes + tag[doc]), return_index=True)
        distinct = np.bincount(doc[first], minlength=len(texts))
    same = np.zeros(len(hashes))
    if len(hashes) > 1:
        same[1:] = (hashes[1:] == hashes[:-1]) & (doc[1:] == doc[:-1])
    length = words.end - words.start
    longest = np.zeros(len(texts))
    np.maximum.at(longest, doc, length)
    rows = [[x for x in (t or "").split("\n") if x and not x.isspace()] for t in texts.to_pylist()]
    lines = np.array([len(x) for x in rows], float)
    return [
        n.astype(float), over(np.bincount(doc, length, len(texts)), n), over(per(code == 3), size), over(per(code == 1), size), over(per(code == 2), size),
        over(per(code == 4), size), over(per(code == 5), size), over(per(raw == 124), size), over(per(raw >= 128), size),
        over(distinct, np.sqrt(n) * np.sqrt(np.maximum(n, 1))), repeated(2), repeated(3), over(np.bincount(doc, same, len(texts)), n),
        over(n, lines), lines, over(per(code == 6), size), longest, over(np.array([len(set(x)) for x in rows], float), lines),
    ]


def with_statistics(docs: DataFrame, carried: list[str], text_col: str) -> DataFrame:
    fields = ", ".join(f"{name} double" for name in STATISTICS)
    return scan_texts(docs, carried, text_col, fields, lambda: lambda texts: [pa.array(x, pa.float64()) for x in statistics(texts)])


def _tree(x: np.ndarray, grad: np.ndarray, hess: np.ndarray, rows: np.ndarray, cuts: list[np.ndarray], depth: int, path: tuple, out: list, step: np.ndarray, s: Settings) -> None:
    """Grow one regression tree by histogram gain; every node but the root adds its path to ``out``."""
    if path:
        out.append(path)
    g, h = grad[rows].sum(), hess[rows].sum()
    best = (1e-6, None, None)
    if depth:
        for j, edges in enumerate(cuts):
            if not len(edges):
                continue
            code = x[rows, j]
            gs, hs, ns = (np.bincount(code, w, len(edges) + 1).cumsum()[:-1] for w in (grad[rows], hess[rows], None))
            gain = gs**2 / (hs + 1) + (g - gs) ** 2 / (h - hs + 1) - g**2 / (h + 1)
            gain[(ns < s.min_leaf) | (len(rows) - ns < s.min_leaf)] = -1
            k = int(gain.argmax())
            if gain[k] > best[0]:
                best = (gain[k], j, k)
    _, j, k = best
    if j is None:
        step[rows] = g / (h + 1)
        return
    left = x[rows, j] <= k
    for side, sign in ((left, "<="), (~left, ">")):
        _tree(x, grad, hess, rows[side], cuts, depth - 1, (*path, (j, sign, k)), out, step, s)


def _simplify(path: tuple) -> tuple:
    """One bound for each statistic and side; the tightest stays."""
    held: dict = {}
    for j, sign, k in path:
        held[j, sign] = k if (j, sign) not in held else (min if sign == "<=" else max)(held[j, sign], k)
    return tuple(sorted((j, sign, k) for (j, sign), k in held.items()))


def fit_rules(values: np.ndarray, labels: np.ndarray, settings: Settings = Settings()) -> Model:
    """Boost trees, take their paths as rules, fit lasso logistic weights (accelerated proximal gradient)."""
    y = labels.astype(float)
    share = (y.sum() + 1) / (len(y) + 2)
    base = math.log(share / (1 - share))
    if len(y) == 0 or y.min() == y.max():
        return Model(base)
    cuts = [np.unique(np.quantile(values[:, j], np.linspace(0, 1, settings.bins + 1)[1:-1])) for j in range(values.shape[1])]
    cuts = [c[c < values[:, j].max()] for j, c in enumerate(cuts)]
    codes = np.stack([np.searchsorted(c, values[:, j], side="left") for j, c in enumerate(cuts)], axis=1)
    odds, paths, rows = np.full(len(y), base), [], np.arange(len(y))
    for _ in range(settings.trees):
        p = 1 / (1 + np.exp(-odds))
        step = np.zeros(len(y))
        _tree(codes, y - p, p * (1 - p), rows, cuts, settings.depth, (), paths, step, settings)
        odds += settings.shrinkage * step
    rules, columns, seen = [], [], set()
    for path in dict.fromkeys(map(_simplify, paths)):
        hit = np.ones(len(y), bool)
        for j, sign, k in path:
            hit &= codes[:, j] <= k if sign == "<=" else codes[:, j] > k
        key = min(hit.tobytes(), (~hit).tobytes())
        if hit.any() and not hit.all() and key not in seen:
            seen.add(key)
            rules.append(path)
            columns.append(hit)
    if not rules:
        return Model(base)
    r = np.stack(columns, axis=1).astype(float)
    mean, sd = r.mean(0), np.maximum(r.std(0), 0.02)
    z = (r - mean) / sd
    lip = 0.25 * (np.linalg.norm(z, 2) ** 2 / len(y) + 1)
    w, v, b, vb, t = np.zeros(len(rules)), np.zeros(len(rules)), base, base, 1.0
    for _ in range(settings.steps):
        err = 1 / (1 + np.exp(-(z @ v + vb))) - y
        nw = v - z.T @ err / len(y) / lip
        nw = np.sign(nw) * np.maximum(np.abs(nw) - settings.penalty / lip, 0)
        nb = vb - err.mean() / lip
        nt = (1 + math.sqrt(1 + 4 * t * t)) / 2
        v, vb = nw + (t - 1) / nt * (nw - w), nb + (t - 1) / nt * (nb - b)
        w, b, t = nw, nb, nt
    kept = np.flatnonzero(np.abs(w) > 1e-4)
    named = [tuple((STATISTICS[j], sign, float(cuts[j][k])) for j, sign, k in rules[i]) for i in kept]
    return Model(float(b - (w[kept] * mean[kept] / sd[kept]).sum()), named, [float(w[i] / sd[i]) for i in kept])


def fit(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_col: str = "quality", where: Column | None = None, settings: Settings = Settings()) -> Model:
    """Fit on at most about ``max_rows`` labelled rows (those of ``where`` with the smallest hashes).  The labels side of the
    join is bounded by that number, so it is broadcast; the driver gets that many rows of statistics."""
    rows = labels.where(where if where is not None else F.lit(True)).where(F.col(id_col).isNotNull() & F.col(label_col).isNotNull())
    rows = rows.groupBy(F.col(id_col).alias("__id")).agg(F.round(F.avg(F.col(label_col))).cast("int").alias("__y"))
    rate = min(1.0, (1.5 * settings.max_rows + 1000) / max(1, rows.count()))  # what is then sorted is bounded, too
    rows = rows.withColumn("__h", F.xxhash64(F.lit(settings.seed), F.col("__id").cast("string")))
    picked = rows.where(F.pmod(F.shiftright("__h", 11), F.lit(1 << 50)) < F.lit(int(rate * (1 << 50)))).orderBy("__h", "__id").limit(settings.max_rows)
    texts = docs.select(F.col(id_col).alias("__id"), F.col(text_col).alias("__text")).join(F.broadcast(picked.select("__id", "__y")), "__id")
    found = with_statistics(texts.select(F.struct("__id", "__y").alias("__key"), "__text"), ["__key"], "__text")
    # of several texts with one id the least statistics count, whatever the order of rows
    one = found.groupBy(F.col("__key.__id").alias("__id"), F.col("__key.__y").alias("__y")).agg(F.min(F.struct(*STATISTICS)).alias("s"))
    table = one.select("__id", "__y", "s.*").orderBy("__id").toArrow()
    if not table.num_rows:
        return fit_rules(np.zeros((0, len(STATISTICS))), np.zeros(0), settings)
    values = np.stack([table.column(c).to_numpy() for c in STATISTICS], axis=1)
    return fit_rules(values, table.column("__y").to_numpy(), settings)


def score(docs: DataFrame, model: Model, carried: tuple[str, ...] = ("doc_id",), text_col: str = "text", settings: Settings = Settings()) -> DataFrame:
    """Per document the carried columns, score and predicted (1 if score >= threshold); one pass without shuffle."""
    score, predicted = free_names(("score", "predicted"), carried)
    inner = {c: f"__{n}" for n, c in enumerate(dict.fromkeys([*carried, text_col]))}  # so no column has a statistic's name
    out = with_statistics(docs.select(*[F.col(c).alias(name) for c, name in inner.items()]), [inner[c] for c in carried], inner[text_col])
    return out.select(*[F.col(inner[c]).alias(c) for c in carried], model.score().alias(score)).withColumn(predicted, (F.col(score) >= settings.threshold).cast("int"))
