"""Secret scans with corpus-wide ownership frequency.

Base kinds (``assign``, ``access``, ``hex``) are always reported.  Further candidates (provider tokens, JSON web tokens, credentials
in URLs, private key blocks, mixed strings of 32 characters or more) are only reported if the corpus speaks for it: their values are hashed,
and the hash is aggregated by distinct repositories and distinct owners.  A value that ``max_owners`` owners or more share, or
``max_repos`` repositories or more of however few owners, or that is a placeholder, is a widely copied example; one of few owners and repositories
that looks random is live-looking and is added.

Texts are scanned once; the table of candidates is written to the shared folder.  Counts are pre-aggregated by (hash, owner,
repository).  Only live values come back to the documents, over a join salted by row, so a value that a third of all documents hold is no hot key there.
``redacted`` carries the texts through the scan: only rows with candidates of the further kinds are joined with a verdict.

Defined results: a null text is an empty one; a null owner or repository counts as one of its own; repeated rows give
repeated rows; a candidate that overlaps a base span or an earlier candidate is not reported again; an empty table
gives an empty table; very long texts are scanned whole, in time that follows their length; other columns may have any name that does not begin with two underscores.
"""

from __future__ import annotations

import bisect
import hashlib
import math
import re
from collections import Counter
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F, types as T

from .common import free_names, kept_type, materialize, release

#: Kinds in the order in which spans with one start are listed.  A run of hex digits, or of letters and digits after AKIA, is
#: matched whole, so asking for its least length in the pattern gives the same matches as dropping short ones afterwards; a short
#: assigned value uses up its text, so there they are dropped afterwards.
BASE = (
    ("assign", re.compile(r"(password|passwd|secret|token|api_?key)[\"']?\x20*[:=]\x20*[\"']?([A-Za-z0-9+/_.=-]+)", re.IGNORECASE | re.ASCII), 2, 6),
    ("access", re.compile(r"AKIA[A-Z0-9]{16,}"), 0, 20),
    ("hex", re.compile(r"[0-9a-f]{24,}"), 0, 24),
)
#: Further kinds with a text that every match holds (any of several), by which most documents are passed over.
MORE = (
    ("pem", re.compile(r"-----BEGIN [A-Z ]*PRIVATE KEY-----[A-Za-z0-9+/=\s]+-----END [A-Z ]*PRIVATE KEY-----"), ("PRIVATE KEY-----",)),
    ("url", re.compile(r"\b[a-z][a-z0-9+.-]{1,20}://[^\s:/@]+:([^\s:/@]{6,})@[A-Za-z0-9.-]+"), ("://",)),
    ("jwt", None, ("eyJ",)),  # found by ``token_spans``
    ("provider", re.compile(r"\b(?:gh[pousr]_[A-Za-z0-9]{30,}|xox[abprs]-[A-Za-z0-9-]{20,}|sk_live_[A-Za-z0-9]{16,}|AIza[A-Za-z0-9_-]{30,}|glpat-[A-Za-z0-9_-]{18,})"), ("gh", "xox", "sk_live_", "AIza", "glpat-")),
    ("mixed", re.compile(r"(?<![A-Za-z0-9+/_=-])[A-Za-z0-9+/_=-]{32,}(?![A-Za-z0-9+/_=-])"), ("",)),
)
KINDS = {kind: n for n, kind in enumerate([k[0] for k in BASE] + [k[0] for k in MORE])}
_DOTTED, _TOKEN = re.compile(r"[A-Za-z0-9_.-]+"), re.compile(r"\beyJ")
_PLACEHOLDER = re.compile(r"(?i)example|sample|dummy|placeholder|changeme|your[_-]|xxxx|test|0123456789|abcdefgh")


@dataclass(frozen=True)
class Settings:
    max_owners: int = 3
    max_repos: int = 50
    salts: int = 16
    min_entropy: float = 3.0


def entropy(value: str) -> float:
    """Bits for each character by the value's own character counts."""
    n = len(value)
    return -sum(c / n * math.log2(c / n) for c in Counter(value).values()) if n else 0.0


def base_spans(text: str) -> list[tuple[str, int, int, str]]:
    """(kind, start, end, value) of the base kinds: leftmost non-overlapping matches, of which short ones are dropped."""
    found = []
    for kind, pattern, group, least in BASE:
        for m in pattern.finditer(text):
            if len(m[group]) >= least:
                found.append((kind, m.start(), m.end(), m[group]))
    return sorted(found, key=lambda x: (x[1], KINDS[x[0]]))


def token_spans(text: str) -> list[tuple[int, int]]:
    """JSON web tokens: three parts of letters, digits, _ and - between dots, at least 10 long, the first from an ``eyJ`` at the edge of a word.  Every run of
    such characters and dots is cut at its dots once, so a text of many beginnings takes no longer than another."""
    found = []
    for run in _DOTTED.finditer(text):
        if text.find("eyJ", run.start(), run.end()) < 0:
            continue
        parts, at = [], run.start()
        for part in run[0].split("."):
            parts.append((at, at + len(part)))
            at += len(part) + 1
        i = 0
        while i + 2 < len(parts):
            a, b = parts[i]
            begin = _TOKEN.search(text, a, b)
            if begin and b - begin.start() >= 13 and all(y - x >= 10 for x, y in parts[i + 1 : i + 3]):
                found.append((begin.start(), parts[i + 2][1]))
                i += 3
            else:
                i += 1
    return found


def live_looking(kind: str, value: str, s: Settings) -> bool:
    if kind == "pem":
        return True
    if _PLACEHOLDER.search(value) or entropy(value) < s.min_entropy:
        return False
    return kind != "mixed" or (sum(map(str.isdigit, value)) >= 3 and any(map(str.isupper, value)) and any(map(str.islower, value)))


def more_spans(text: str, held: list[tuple], s: Settings) -> list[tuple[str, int, int, str]]:
    """Live-looking candidates of the further kinds that overlap nothing held."""
    starts, ends = [], []  # what is taken, as disjoint spans in order
    for _, a, b, _ in held:  # by start
        if ends and a < ends[-1]:
            ends[-1] = max(ends[-1], b)
        else:
            starts.append(a)
            ends.append(b)
    found = []
    for kind, pattern, parts in MORE:
        if not any(part in text for part in parts):
            continue
        spans = ((a, b, text[a:b]) for a, b in token_spans(text)) if pattern is None else ((m.start(), m.end(), m[m.lastindex or 0]) for m in pattern.finditer(text))
        new = [(kind, a, b, value) for a, b, value in spans if bisect.bisect_right(ends, a) == bisect.bisect_left(starts, b) and live_looking(kind, value, s)]
        found += new
        starts, ends = sorted([*starts, *(x[1] for x in new)]), sorted([*ends, *(x[2] for x in new)])  # matches of one pattern never overlap
    return found


_SPAN = pa.struct([("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64()), ("hash", pa.string()), ("base", pa.bool_())])


def _scan(s: Settings):
    def work(texts: pa.Array) -> pa.Array:
        rows = []
        for text in texts.to_pylist():
            text = text or ""
            held = base_spans(text)
            spans = [(x, True) for x in held] + [(x, False) for x in more_spans(text, held, s)]
            rows.append([{"kind": k, "start": a, "end": b, "hash": hashlib.sha256(v.encode()).hexdigest(), "base": base} for (k, a, b, v), base in spans])
        return pa.array(rows, pa.list_(_SPAN))

    return work


def row_key(*columns: str) -> Column:
    """A key of a row's values; repeated rows share it, other rows never: every value stands with its length, a null without."""
    told = [F.coalesce(F.concat(F.length(F.col(c).cast("string")), F.lit(":"), F.col(c).cast("string")), F.lit("-")) for c in columns]
    return F.substring(F.sha2(F.concat(*told).cast("binary"), 256), 1, 32)  # 128 bits: keys of rows that go are joined as a table, which should stay small


_FOUND = T.ArrayType(T.StructType([T.StructField("kind", T.StringType()), T.StructField("start", T.LongType()), T.StructField("end", T.LongType()), T.StructField("hash", T.StringType()), T.StructField("base", T.BooleanType())]))


def candidates(docs: DataFrame, carried: list[str], id_col: str, text_col: str, repo_col: str, owner_col: str, s: Settings) -> DataFrame:
    """The carried columns with ``__row`` (row_key of id, repository, owner and text), ``__repo``, ``__owner`` and ``__found``: base spans and live-looking
    candidates.  Written to the shared folder."""
    rows = docs.select(*carried, row_key(id_col, repo_col, owner_col, text_col).alias("__row"), F.col(repo_col).cast("string").alias("__repo"), F.col(owner_col).cast("string").alias("__owner"), F.col(text_col).cast("string").alias("__text"))
    own_text = text_col in carried and isinstance(kept_type(docs, text_col), T.StringType)
    if own_text:
        rows = rows.drop("__text")
    keep = [*carried, "__row", "__repo", "__owner"]
    out = T.StructType([rows.schema[c] for c in keep] + [T.StructField("__found", _FOUND)])
    at = carried.index(text_col) if own_text else len(keep)

    def run(batches):
        release()
        work = _scan(s)
        for batch in batches:
            for row in range(0, batch.num_rows, 512):
                b = batch.slice(row, 512)
                yield pa.RecordBatch.from_arrays([*b.columns[: len(keep)], work(b.column(at))], names=out.fieldNames())
        release()

    return materialize(rows.mapInArrow(run, out), "secrets")


def _live(rows: DataFrame, s: Settings) -> DataFrame:
    """(hash, repos, owners) of the values of few owners and repositories, by exact distinct counts over all rows."""
    one = rows.select("__repo", "__owner", F.explode("__found.hash").alias("hash"))
    nothing = F.lit("\0")
    counts = one.groupBy("hash").agg(F.count_distinct(F.coalesce("__repo", nothing)).alias("repos"), F.count_distinct(F.coalesce("__owner", nothing)).alias("owners"))
    return counts.where((F.col("owners") < s.max_owners) & (F.col("repos") < s.max_repos))


def _judged(rows: DataFrame, spans: Column, live: DataFrame, s: Settings) -> DataFrame:
    """(row, span columns, repos, owners, verdict) of the given spans, once for repeated rows; counts are null for examples."""
    one = rows.select(F.col("__row").alias("row"), F.explode(spans).alias("x")).select("row", "x.*").dropDuplicates(["row", "kind", "start", "end"])
    one = one.withColumn("salt", F.pmod(F.xxhash64("row"), F.lit(s.salts)).cast("int"))
    known = live.withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(s.salts - 1))))
    return one.join(known, ["hash", "salt"], "left").withColumn("verdict", F.when(F.col("owners").isNull(), "example").otherwise("live")).drop("salt")


def scan_secrets(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", repo_col: str = "doc_id", owner_col: str = "source", settings: Settings = Settings()) -> DataFrame:
    """Per document its id, ``row`` (row_key of id, repository, owner and text) and ``spans``: array of (kind, start, end, hash, base, repos, owners, verdict) by start, in code
    points; verdict is ``live`` or ``example``, whose counts are null.  Base spans are all there, others only if live.  If the id column has one of these names, the other gets
    a trailing underscore."""
    s = settings
    row, spans = free_names(("row", "spans"), [id_col])
    rows = candidates(docs, [id_col], id_col, text_col, repo_col, owner_col, s)
    judged = _judged(rows, F.col("__found"), _live(rows, s), s)
    order = F.create_map(*[F.lit(x) for kind, n in KINDS.items() for x in (kind, n)])
    kept = judged.where(F.col("base") | (F.col("verdict") == "live"))
    listed = kept.groupBy("row").agg(F.array_sort(F.collect_list(F.struct(F.col("start"), order[F.col("kind")].alias("rank"), F.col("end"), F.col("kind"), F.col("hash"), F.col("base"), F.col("repos"), F.col("owners"), F.col("verdict")))).alias("spans"))
    listed = listed.select(F.col("row").alias("__row"), F.col("spans").alias("__spans"))
    none = F.array().cast(listed.schema["__spans"].dataType)
    return rows.select("__row", id_col).join(listed, "__row", "left").select(id_col, F.col("__row").alias(row), F.coalesce("__spans", none).alias(spans))


def redacted(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", repo_col: str = "doc_id", owner_col: str = "source", settings: Settings = Settings()) -> DataFrame:
    """The documents with every span that scan_secrets would report replaced, and ``__redacted``, whether any was.  Rows with base spans only, or none, stay in
    place; only those with further candidates meet their verdicts."""
    s = settings
    rows = candidates(docs, docs.columns, id_col, text_col, repo_col, owner_col, s)
    base, further = F.filter("__found", lambda x: x["base"]), F.filter("__found", lambda x: ~x["base"])
    plain, asked = rows.where(F.size(further) == 0), rows.where(F.size(further) > 0)
    judged = _judged(asked, further, _live(rows, s), s).where("verdict = 'live'")
    more = judged.groupBy(F.col("row").alias("__row")).agg(F.collect_list(F.struct("kind", "start", "end", "hash", "base")).alias("__more"))
    joined = asked.join(more, "__row", "left").select(*rows.columns, "__more")
    joined = joined.withColumn("__found", F.concat(base, F.coalesce("__more", F.array().cast(_FOUND)))).drop("__more")
    every = plain.unionByName(joined)
    return redact_column(every, "__found", text_col).select(*docs.columns, (F.size("__found") > 0).alias("__redacted"))


def redact(text: str, spans: list[tuple[int, int, str]]) -> str:
    """The text with every span, overlapping ones joined, replaced by a mark of its first kind."""
    out, at = [], 0
    for start, end, kind in sorted(spans):
        if end <= at:
            continue
        if start >= at:
            out += [text[at:start], f"<secret:{kind}>"]
        at = end
    return "".join([*out, text[at:]])


def redact_column(docs: DataFrame, spans_col: str, text_col: str = "text") -> DataFrame:
    """``text_col`` with the spans of ``spans_col`` (as of scan_secrets, or null) replaced; nulls stay null."""

    @F.pandas_udf("string")
    def apply(texts, starts, ends, kinds):
        import pandas as pd

        return pd.Series([t if t is None or a is None or not len(a) else redact(t, list(zip(a, b, k))) for t, a, b, k in zip(texts, starts, ends, kinds)])

    spans = F.col(spans_col)
    return docs.withColumn(text_col, F.when(F.size(F.coalesce(spans, F.array())) > 0, apply(F.col(text_col), spans["start"], spans["end"], spans["kind"])).otherwise(F.col(text_col)))
