"""The best pair of every story without a row for each pair.

The score of a pair is a term of the members' classes (stance, axes, type, picture, snippet, outlet) less the time between them.  Members fall into few classes, and of two classes the best
pair is the nearest in time, which sorted lists show without a score for each pair.  So a search goes from the best term down and outwards in time; the costly comparison of headlines runs on
pairs from the highest score down and stops at the first that differ.  Small stories are dealt many to a task; a large one is cut into blocks of ``block`` members a side.
"""

from __future__ import annotations

import functools
import heapq
import math
from collections import Counter
from collections.abc import Callable
from decimal import ROUND_HALF_UP, Decimal

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, functions as F

from ..config import Config
from ..functions.scoring import OPPOSED, displayable
from ..functions.text import bigrams, block_ratio, may_be_alike, normalise_title
from ..functions.times import micros

OUT = "story_id {0}, left_article_id {1}, right_article_id {1}, pair_kind string, divergence_score double, featured_at long"
_PLACE = Decimal("0.001")


def _rounded(x: float) -> float:
    """As Spark rounds: half up on the shortest decimal text."""
    return float(Decimal(repr(float(x))).quantize(_PLACE, ROUND_HALF_UP))


def _same_news(lt: str, ls: str, rt: str, rs: str, near: str, ratio: float) -> bool:
    if near == "title":
        return lt == rt and lt != ""
    return any(may_be_alike(a, b, least, _pairs) and block_ratio(a, b) >= least for a, b, least in ((lt, rt, ratio), (ls, rs, 0.9)))


@functools.lru_cache(1 << 14)
def _pairs(text: str) -> frozenset:
    return frozenset(bigrams(text))


#: A trait that so large a share of a story's members has is part of their class; a rarer one is looked at pair by pair.
FREQUENT = 1 / 8


def _common(values: list, share: float = FREQUENT) -> dict:
    """Numbers for the values that so large a share of all holds."""
    counts = Counter(values)
    return {v: n for n, v in enumerate(sorted((v for v, c in counts.items() if c >= share * len(values)), key=repr))}


class Members:
    """One side of a story: classes of members with the same terms in the score, each in the order of time."""

    def __init__(self, m: pd.DataFrame, words: np.ndarray, axes: dict, outlets: dict, wordings: dict, current):
        code = {d: n for n, d in enumerate(sorted({d for pair in OPPOSED for d in pair}))}
        self.ids, self.at, self.outlet, self.words = m["id"].to_numpy(), m["at"].to_numpy(np.int64), m["outlet"].to_numpy(object), words
        self.axes = [frozenset(x) for x in m["axes"]]
        self.title, self.snippet = m["title"].to_numpy(object), m["snippet"].to_numpy(object)
        stance = [code.get(d, len(code)) if c is not None and c >= 0.5 else len(code) for d, c in zip(m["direction"], m["confidence"])]
        known = [frozenset(axes[x] for x in xs if x in axes) for xs in self.axes]
        new = np.zeros(len(m), bool) if current is None or not len(current) else ~m["outlet"].isin(list(current)).to_numpy(bool)
        keys = list(zip(stance, known, [bool(x) for x in self.axes], m["article_type"].to_numpy(object), m["has_image"], m["has_snippet"], new, [outlets.get(x, -1) for x in self.outlet], [wordings.get(x, -1) for x in words.tolist()]))
        number = {k: n for n, k in enumerate(dict.fromkeys(keys))}
        self.keys = list(number)
        of = np.array([number[k] for k in keys])
        order = np.lexsort((self.at, of))
        cuts = np.searchsorted(of[order], np.arange(len(number) + 1))
        self.classes = [order[a:b] for a, b in zip(cuts[:-1], cuts[1:])]
        self.times = [self.at[c] for c in self.classes]


def _terms(l: Members, r: Members, axes: int, current) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(doubled score without time, opposed, disjoint as far as frequent axes tell) of every two classes; impossible ones have the least number."""
    column = lambda m, i: [k[i] for k in m.keys]
    code = {d: n for n, d in enumerate(sorted({d for pair in OPPOSED for d in pair}))}
    table = np.zeros((len(code) + 1, len(code) + 1), bool)
    for a, b in OPPOSED:
        table[code[a], code[b]] = True
    opposed = table[np.array(column(l, 0))[:, None], np.array(column(r, 0))[None, :]]

    def marks(m: Members) -> np.ndarray:
        out = np.zeros((len(m.keys), axes + 1), np.float32)
        for i, xs in enumerate(column(m, 1)):
            out[i, list(xs)] = 1
        return out

    flag = lambda m, i: np.array(column(m, i), bool)
    both = lambda i: flag(l, i)[:, None] & flag(r, i)[None, :]
    disjoint = both(2) & (marks(l) @ marks(r).T == 0)
    kind = lambda m, k: np.array([x == k for x in column(m, 3)], bool)
    types = {x: n for n, x in enumerate(dict.fromkeys([*column(l, 3), *column(r, 3)]))}
    same = np.array([types[x] for x in column(l, 3)])[:, None] == np.array([types[x] for x in column(r, 3)])[None, :]
    clash = (kind(l, "news")[:, None] & kind(r, "opinion")[None, :]) | (kind(l, "opinion")[:, None] & kind(r, "news")[None, :])
    live = kind(l, "live")[:, None] | kind(r, "live")[None, :]
    twice = (6 * opposed + 3 * disjoint + np.where(same, 2, np.where(clash, -2, 0)) - 3 * live + 2 * both(4) + both(5)).astype(np.int16)
    if current is not None and len(current):
        twice += both(6)
    own, theirs = np.array(column(l, 7)), np.array(column(r, 7))
    twice[(own[:, None] == theirs[None, :]) & (own >= 0)[:, None]] = np.iinfo(np.int16).min
    return twice, opposed, disjoint


class Search:
    """The best pair of two sides: two classes share all terms but the time apart, so for them the best is the nearest in time.  Classes come from the best term down,
    each is followed outwards in time by steps of one rounded score, and a step ends the search if a pair of it may stand."""

    def __init__(self, l: Members, r: Members, twice: np.ndarray, opposed: np.ndarray, disjoint: np.ndarray, same: Callable[[int, int], bool], current):
        self.l, self.r, self.twice, self.opposed, self.disjoint, self.same = l, r, twice, opposed, disjoint, same
        self.offset = 0.5 if current is not None and len(current) else 0.0
        self.told: dict[tuple, bool] = {}
        self.compared = 0

    def score(self, i: int, j: int, gap: int, less: int = 0) -> float:
        """As the plain definition adds it up: time is taken off before the half for new outlets."""
        new = bool(self.offset) and self.l.keys[i][6] and self.r.keys[j][6]
        return _rounded((int(self.twice[i, j]) - less - int(new)) / 2 - 0.02 * (gap / 3.6e9) + (0.5 if new else 0.0))

    def reach(self, i: int, j: int, score: float) -> int:
        """The greatest time apart, in microseconds, at which the two classes have the rounded score or a higher one."""
        gap = max(0, int((int(self.twice[i, j]) / 2 - score + 0.0005) / 0.02 * 3.6e9))
        while self.score(i, j, gap) < score and gap > 0:
            gap -= 1
        while self.score(i, j, gap + 1) >= score:
            gap += 1
        return gap

    def next_gap(self, i: int, j: int, beyond: int) -> int | None:
        """The least time apart of two members that is over ``beyond``."""
        a, b = self.l.times[i], self.r.times[j]
        after, before = np.searchsorted(b, a + beyond, "right"), np.searchsorted(b, a - beyond, "left") - 1
        ahead, behind = after < len(b), before >= 0
        gaps = np.concatenate([b[after[ahead]] - a[ahead], a[behind] - b[before[behind]]])
        return int(gaps.min()) if len(gaps) else None

    def alike(self, x: int, y: int) -> bool:
        key = (self.l.words[x], self.r.words[y])
        if key not in self.told:
            self.compared += 1
            self.told[key] = self.same(x, y)
        return self.told[key]

    def first(self, active: list[tuple[int, int, int, int]], later: list) -> tuple | None:
        """Of the pairs in the steps (class, class, over, up to) the one of the least ids that may stand; pairs that turn out to share a rare axis go to ``later``."""
        l, r, found = self.l, self.r, {}
        for n, (i, j, low, high) in enumerate(active):
            a, b = l.times[i], r.times[j]
            spans = np.stack([np.searchsorted(b, a - high, "left"), np.searchsorted(b, a - low, "left"), np.searchsorted(b, a + low, "right"), np.searchsorted(b, a + high, "right")])
            spans[1] = np.maximum(spans[0], spans[1])
            spans[2] = np.maximum(spans[2], spans[1])  # at the first step both sides hold what is at the same time
            for at in np.flatnonzero((spans[1] > spans[0]) | (spans[3] > spans[2])):
                found.setdefault(l.classes[i][at], []).append((n, *spans[:, at].tolist()))
        for x in sorted(found, key=lambda x: l.ids[x]):
            near = [(n, y) for n, s0, s1, s2, s3 in found[x] for y in (*r.classes[active[n][1]][s0:s1], *r.classes[active[n][1]][s2:s3])]
            for n, y in sorted(near, key=lambda p: r.ids[p[1]]):
                i, j = active[n][:2]
                if l.outlet[x] == r.outlet[y]:
                    continue
                if self.disjoint[i, j] and l.axes[x] & r.axes[y]:
                    heapq.heappush(later, (-self.score(i, j, abs(int(l.at[x] - r.at[y])), 3), l.ids[x], r.ids[y], i, j, x, y))
                elif not self.alike(x, y):
                    return l.ids[x], r.ids[y], "opposing_stance" if self.opposed[i, j] else "framing_contrast" if self.disjoint[i, j] else "same_story", max(l.at[x], r.at[y])
        return None

    def best(self) -> tuple | None:
        """(left id, right id, kind, score, later date) of the best pair, or None."""
        terms = [t for t in np.unique(self.twice)[::-1].tolist() if t > np.iinfo(np.int16).min]
        queue, later, at = [], [], 0  # (score that two classes may have, classes, how far they were followed)
        while queue or later or at < len(terms):
            top = max([-queue[0][0]] if queue else [], default=-math.inf)
            top = max(top, -later[0][0] if later else -math.inf, _rounded(terms[at] / 2) if at < len(terms) else -math.inf)
            while at < len(terms) and _rounded(terms[at] / 2) >= top:
                queue += [(-_rounded(terms[at] / 2), int(i), int(j), -1) for i, j in zip(*np.nonzero(self.twice == terms[at]))]
                at += 1
            heapq.heapify(queue)
            active = []
            while queue and -queue[0][0] >= top:
                _, i, j, beyond = heapq.heappop(queue)
                gap = self.next_gap(i, j, beyond)
                if gap is None or (beyond < 0 and min(self.l.keys[i][8], self.r.keys[j][8]) >= 0 and self.alike(self.l.classes[i][0], self.r.classes[j][0])):
                    continue  # no more pairs, or all of them are worded alike
                score = self.score(i, j, gap)
                if score < top:
                    heapq.heappush(queue, (-score, i, j, beyond))
                else:
                    active.append((i, j, beyond, self.reach(i, j, top)))
            got = self.first(active, later)
            while later and -later[0][0] >= top:
                _, _, _, i, j, x, y = heapq.heappop(later)
                pair = (self.l.ids[x], self.r.ids[y], "opposing_stance" if self.opposed[i, j] else "same_story", max(self.l.at[x], self.r.at[y]))
                if (got is None or pair[:2] < got[:2]) and not self.alike(x, y):
                    got = pair
            if got:
                return got[0], got[1], got[2], top, got[3]
            for i, j, _, high in active:
                heapq.heappush(queue, (-top, i, j, high))
        return None


def best_of(l: pd.DataFrame, r: pd.DataFrame, outlets, near: str, ratio: float) -> tuple | None:
    """(left id, right id, kind, score, later date) of the best pair that does not say the same, or None.  Members that are worded alike count as one in that comparison."""
    l, r = l[l["outlet"].notna()], r[r["outlet"].notna()]
    if not len(l) or not len(r):
        return None
    words = pd.factorize(pd.Series(list(zip([*l["title"], *r["title"]], [*l["snippet"], *r["snippet"]]))))[0]
    held = [x for m in (l, r) for xs in m["axes"] for x in xs]
    counts = Counter(held)
    axes = {x: n for n, x in enumerate(sorted(x for x, c in counts.items() if 2 * c >= FREQUENT * len(words)))}
    common = _common([*l["outlet"], *r["outlet"]]), _common(words.tolist())
    one, two = Members(l, words[: len(l)], axes, *common, outlets), Members(r, words[len(l) :], axes, *common, outlets)
    same = lambda x, y: _same_news(one.title[x], one.snippet[x], two.title[y], two.snippet[y], near, ratio)
    return Search(one, two, *_terms(one, two, len(axes), outlets), same, outlets).best()


def best(articles: DataFrame, current: DataFrame | None = None, near: str = "ratio", config: Config = Config(), block: int = 65536, buckets: int = 200) -> DataFrame:
    """Per story the pair of the highest score; ties go to the least ids.  The same rows as the join of ``pairs.best``."""
    axes = F.array_distinct(F.transform(F.filter(F.coalesce("axes", F.array().cast("array<string>")), lambda x: x.isNotNull() & (x != "")), lambda x: F.lower(F.trim(x))))
    filled = lambda c: F.coalesce(F.col(c), F.lit("")) != ""
    shown = articles.where(displayable(F.col("is_wire_copy"), F.col("article_type"), F.col("title")) & F.col("story_id").isNotNull() & F.col("side").isin("left", "right")).select(
        "story_id", "side", "id", "outlet", "article_type", "direction", "confidence", axes.alias("axes"), micros(F.col("published_at")).alias("at"), filled("image_url").alias("has_image"), filled("snippet").alias("has_snippet"),
        normalise_title(F.col("title")).alias("title"), F.substring(F.coalesce("snippet", F.lit("")), 1, 200).alias("snippet"),
    )
    sizes = shown.groupBy("story_id").agg(F.ceil(F.count_if(F.col("side") == "left") / block).cast("int").alias("ln"), F.ceil(F.count_if(F.col("side") == "right") / block).cast("int").alias("rn")).where("ln > 0 and rn > 0")
    if current is not None:
        sizes = sizes.join(current.select("story_id", "outlets"), "story_id", "left")
    else:
        sizes = sizes.withColumn("outlets", F.lit(None).cast("array<string>"))
    rows = shown.join(sizes, "story_id")
    small = (F.col("ln") == 1) & (F.col("rn") == 1)
    left = F.col("side") == "left"
    own = F.pmod(F.xxhash64("id"), F.when(left, F.col("ln")).otherwise(F.col("rn"))).cast("int")
    others = F.explode(F.sequence(F.lit(0), F.when(left, F.col("rn")).otherwise(F.col("ln")) - 1))
    rows = rows.withColumn("own", own).withColumn("other", others)
    unit = F.when(small, F.concat(F.lit("b"), F.pmod(F.xxhash64("story_id"), F.lit(buckets)).cast("string"))).otherwise(F.concat_ws(":", F.lit("s"), F.col("story_id").cast("string"), F.when(left, F.col("own")).otherwise(F.col("other")).cast("string"), F.when(left, F.col("other")).otherwise(F.col("own")).cast("string")))

    def pick(part: pd.DataFrame) -> pd.DataFrame:
        out = []
        for story, m in part.groupby("story_id", sort=False):
            l, r = m[m["side"] == "left"], m[m["side"] == "right"]
            got = best_of(l, r, m["outlets"].iloc[0], near, config.near_duplicate_ratio) if len(l) and len(r) else None
            if got:
                out.append((story, *got))
        return pd.DataFrame(out, columns=["story_id", "left_article_id", "right_article_id", "pair_kind", "divergence_score", "featured_at"])

    kinds = [articles.schema[c].dataType.simpleString() for c in ("story_id", "id")]
    found = rows.withColumn("unit", unit).drop("own", "other", "ln", "rn").groupBy("unit").applyInPandas(pick, OUT.format(*kinds))
    top = found.groupBy("story_id").agg(F.min(F.struct((-F.col("divergence_score")).alias("s"), "left_article_id", "right_article_id", "pair_kind", "featured_at")).alias("b"))
    moment = F.timestamp_micros("b.featured_at").cast(articles.schema["published_at"].dataType)
    return top.select("story_id", "b.left_article_id", "b.right_article_id", "b.pair_kind", (-F.col("b.s")).alias("divergence_score"), moment.alias("featured_at"))
