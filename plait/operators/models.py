"""Language models behind small interfaces, with deterministic offline stand-ins, and their use inside plans.

A model is any picklable object with the method of its role; it is made once in each task by ``make``.  Answers come back as columns with
an ``error`` field: a failing call never fails the task.  ``Structured`` turns a plain function that sends a prompt into all roles, by the rules for structured
answers: broken or truncated ones are asked again, and one role may fall back to another model.  Calls that a model lists in ``calls`` come back as a column,
and usage is an aggregate over it.
"""

from __future__ import annotations

import hashlib
import itertools
import json
import threading
import time
from collections.abc import Callable, Iterator
from dataclasses import dataclass, field
from typing import Protocol

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, functions as F

from ..config import Config
from ..functions.text import collapse_space
from ..sources.pool import pooled

CALLS = "array<struct<kind:string,model:string,tokens_in:long,tokens_out:long>>"
#: What the roles answer, as types for from_json.
FRAMING = "framing_axes array<string>, framing_summary string"
VERIFICATION = "candidate_id string, relation string, confidence string, reason string"
MERGING = "same_development boolean, confidence string, reason string"
TITLING = "story_title string, headline_contrast string"


class Enricher(Protocol):
    def enrich(self, prompt: str) -> dict: ...


class Framer(Protocol):
    def frame(self, prompt: str) -> dict: ...


class Embedder(Protocol):
    def embed(self, texts: list[str]) -> list[list[float]]: ...


class Titler(Protocol):
    def title(self, prompt: str) -> dict: ...


class Verifier(Protocol):
    def verify(self, prompt: str) -> dict: ...


class Merger(Protocol):
    def merge(self, prompt: str) -> dict: ...


class OfflineModel:
    """All roles without any network: answers are functions of the prompt."""

    def __init__(self, dims: int = 64):
        self.dims = dims

    def enrich(self, prompt: str) -> dict:
        words = prompt.split()
        return {
            "category": "other", "article_type": "news", "event_summary": " ".join(words[:12]), "event_date": None, "event_date_confidence": 0.0, "key_entities": sorted({w.strip(".,") for w in words if w[:1].isupper()})[:6],
            "leaning": {"label": "CENTER", "confidence": 0.5}, "stance": {"contested_question": None, "direction": "neutral", "confidence": 0.1, "framing_axes": [], "framing_summary": None},
            "loaded_terms": [], "is_wire_copy": False, "wire_copy_evidence": None, "evidence": {"headline_terms": [], "date_strings": []},
        }

    def frame(self, prompt: str) -> dict:
        return {"framing_axes": ["coverage"], "framing_summary": " ".join(prompt.split()[:8])}

    def embed(self, texts: list[str]) -> list[list[float]]:
        out = []
        for text in texts:
            rng = np.random.Generator(np.random.PCG64(int.from_bytes(hashlib.sha256(text.encode()).digest()[:8], "little")))
            v = rng.standard_normal(self.dims)
            out.append((v / np.sqrt((v * v).sum())).tolist())
        return out

    def title(self, prompt: str) -> dict:
        return {"story_title": " ".join(prompt.split()[:8]), "headline_contrast": None}

    def verify(self, prompt: str) -> dict:
        return {"candidate_id": None, "relation": "unrelated", "confidence": 0.0, "reason": "offline"}

    def merge(self, prompt: str) -> dict:
        return {"same_development": False, "confidence": 0.0, "reason": "offline"}


class Truncated(RuntimeError):
    """The answer ended at the limit of tokens: it is no answer."""


@dataclass(frozen=True)
class Reply:
    text: str
    finish: str = "stop"
    tokens_in: int = 0
    tokens_out: int = 0


@dataclass(frozen=True)
class Request:
    model: str
    kind: str
    prompt: str
    effort: str | None = None
    most_tokens: int = 300


@dataclass
class Structured:
    """All text roles over ``send(request)``, which returns a Reply.

    models: the model of each kind, or of all under ``""``.  fallback: the model that is asked once when a call of the tier that verifies (verify, merge, title)
    failed after all tries; other kinds have none, nor has that model itself.  efforts: how hard models think, by the start of their names; those that think
    more than the least get ``headroom`` tokens on top of a kind's limit, since thinking counts towards it.
    """

    send: Callable[[Request], Reply]
    models: dict[str, str]
    fallback: str | None = None
    efforts: dict[str, str] = field(default_factory=dict)
    limits: dict[str, int] = field(default_factory=lambda: {"enrich": 1200, "": 300})
    headroom: int = 2000
    tries: int = 3
    pause: float = 0.0
    calls: list[dict] = field(default_factory=list)

    def request(self, model: str, kind: str, prompt: str) -> Request:
        effort = next((self.efforts[start] for start in sorted(self.efforts, key=len, reverse=True) if model.startswith(start)), None)
        limit = self.limits.get(kind, self.limits[""])
        return Request(model, kind, prompt, effort, limit + (self.headroom if effort not in (None, "none", "minimal") else 0))

    def _once(self, model: str, kind: str, prompt: str) -> dict:
        reply = self.send(self.request(model, kind, prompt))
        self.calls.append({"kind": kind, "model": model, "tokens_in": reply.tokens_in, "tokens_out": reply.tokens_out})
        if reply.finish == "length":
            raise Truncated("the answer was cut off at its limit of tokens")
        return json.loads(reply.text)

    def ask(self, kind: str, prompt: str) -> dict:
        model = self.models.get(kind, self.models.get("", ""))
        tier = kind in ("verify", "merge", "title") and self.fallback not in (None, "", model)
        other = (lambda: retried(lambda: self._once(self.fallback, kind, prompt), self.tries, self.pause)) if tier else None
        return retried(lambda: self._once(model, kind, prompt), self.tries, self.pause, other)

    def enrich(self, prompt: str) -> dict:
        return self.ask("enrich", prompt)

    def frame(self, prompt: str) -> dict:
        return self.ask("framing", prompt)

    def verify(self, prompt: str) -> dict:
        return self.ask("verify", prompt)

    def merge(self, prompt: str) -> dict:
        return self.ask("merge", prompt)

    def title(self, prompt: str) -> dict:
        return self.ask("title", prompt)


def retried(call: Callable, tries: int = 3, pause: float = 0.0, fallback: Callable | None = None):
    """The call's answer; broken JSON is asked again at once, other errors after a growing pause; then the fallback, once."""
    last: Exception | None = None
    for n in range(tries):
        try:
            return call()
        except json.JSONDecodeError as error:
            last = error
        except Exception as error:  # noqa: BLE001  a model may fail in any way
            last = error
            time.sleep(pause * (n + 1))
    if fallback is not None:
        return fallback()
    raise last


def ask(df: DataFrame, id_col: str, prompt_col: str, make: Callable[[], Callable[[str], dict]], workers: int = 4) -> DataFrame:
    """(id, answer as JSON, error, calls) for every row, in Arrow batches; a row's failure is its error.  A task asks ``workers`` prompts at a time, each by a model of its own."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        own = threading.local()

        def one(row: tuple) -> tuple:
            if not hasattr(own, "call"):
                own.call = make()
            log = getattr(getattr(own.call, "__self__", None), "calls", [])
            log.clear()
            try:
                answer, error = json.dumps(retried(lambda: own.call(row[1]))), None
            except Exception as e:  # noqa: BLE001  a model may fail in any way
                answer, error = None, str(e)[:300]
            return answer, error, list(log)

        found = pooled((row for b in batches for row in zip(b[id_col], b["prompt"])), one, workers)
        while part := list(itertools.islice(found, 256)):
            told = [got or (None, failed, []) for _, got, failed in part]  # a model that cannot be made fails its rows
            yield pd.DataFrame({id_col: [row[0] for row, _, _ in part], "answer": [t[0] for t in told], "error": [t[1] for t in told], "calls": [t[2] for t in told]})

    kind = df.schema[id_col].dataType.simpleString()
    return df.select(id_col, F.col(prompt_col).alias("prompt")).mapInPandas(run, f"{id_col} {kind}, answer string, error string, calls {CALLS}")


def in_order(found: list) -> list[list[float]]:
    """The vectors of an answer; where each comes with the index of its text, in the order of the texts."""
    if found and isinstance(found[0], dict):
        found = [x["embedding"] for x in sorted(found, key=lambda x: x["index"])]
    return found


def embed(df: DataFrame, id_col: str, text_col: str, make: Callable[[], Embedder], batch: int = 64, most_chars: int = 8000) -> DataFrame:
    """(id, vector, error): texts cut to ``most_chars``, embedded ``batch`` at a time; a failing batch, or one with another number of vectors than
    texts, is an error of all its rows."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        model = make()
        for b in batches:
            for at in range(0, len(b), batch):
                part = b.iloc[at : at + batch]
                try:
                    vectors, error = in_order(retried(lambda p=part: model.embed([(t or "")[:most_chars] for t in p["text"]]))), None
                    if len(vectors) != len(part):
                        raise ValueError(f"{len(vectors)} vectors for {len(part)} texts")
                except Exception as e:  # noqa: BLE001
                    vectors, error = [None] * len(part), str(e)[:300]
                yield pd.DataFrame({id_col: part[id_col], "vector": vectors, "error": error})

    kind = df.schema[id_col].dataType.simpleString()
    return df.select(id_col, F.col(text_col).alias("text")).mapInPandas(run, f"{id_col} {kind}, vector array<double>, error string")


def usage(calls: DataFrame) -> DataFrame:
    """Calls and tokens by kind and model, from a log of calls."""
    return calls.groupBy("kind", "model").agg(F.count(F.lit(1)).alias("calls"), F.sum("tokens_in").alias("tokens_in"), F.sum("tokens_out").alias("tokens_out"))


def _said(name: str, value: Column) -> list[Column]:
    return [F.lit(f"{name}: "), F.coalesce(F.nullif(value.cast("string"), F.lit("")), F.lit("none")), F.lit("\n")]


def _outlet() -> list[Column]:
    """As it stands, empty too."""
    return [F.lit("Outlet: "), F.coalesce("outlet", F.lit("none")), F.lit("\n")]


def enrich_prompt(config: Config = Config(), columns: tuple[str, ...] = ()) -> Column:
    """What an enricher reads of an article; section and authors where there are such columns."""
    parts = [*_outlet(), *_said("Published", F.col("published_at")), *_said("Title", F.col("title")), *_said("Feed headline", F.col("headline")), *_said("Description", F.col("subheadline"))]
    if "evidence" in columns:
        parts += _said("Section", F.col("evidence.section"))
    if "authors" in columns:
        parts += _said("Authors", F.array_join("authors", ", "))
    return F.concat(*parts, F.lit("Text:\n"), F.substring(F.coalesce("body_text", F.lit("")), 1, config.body_chars_for_prompt))


def framing_prompt(config: Config = Config()) -> Column:
    """What a framer reads of an article; a title of white space alone is none."""
    title = F.when(collapse_space(F.col("title")) != "", F.col("title"))
    headline = F.coalesce(F.when(collapse_space(F.col("headline")) != "", F.col("headline")), title)
    return F.concat(*_outlet(), *_said("Headline", headline), *_said("Page title", title), *_said("Subheadline", F.col("subheadline")), F.lit("Text:\n"), F.substring(F.coalesce("body_text", F.lit("")), 1, config.framing_body_chars))


def verify_prompt(article, stories: list) -> str:
    """An article's main point and the stories that it may belong to, for a verifier; any objects with these fields."""
    has = lambda name: getattr(article, name, None)
    lines = [f"Outlet: {has('outlet')}", f"Published: {has('published_at')}", f"Headline: {has('title')}", f"Main point: {has('event_summary')}", f"Date of the event: {has('event_date')}", f"Names: {', '.join(has('key_entities') or [])}", "", "Stories:"]
    lines += [f"[{s.id}] {s.title} | {s.summary} (event {s.event_date}, first seen {s.first_seen or 'unknown'})" for s in stories]
    return "\n".join([*lines, "", "To which story is the article closest, and is its main point the same development, a follow-up of it, or unrelated?"])


class ModelVerifier:
    """A verifier for the sequential pass over a model's role; the model is made where it is used."""

    def __init__(self, make: Callable[[], Verifier]):
        self.make, self.model = make, None

    def __getstate__(self):
        return {"make": self.make, "model": None}

    def __call__(self, article, stories: list) -> dict:
        self.model = self.model or self.make()
        return self.model.verify(verify_prompt(article, stories))


class ModelMerger:
    """A verifier for merges: a row of merge.described in, the answer out."""

    def __init__(self, make: Callable[[], Merger]):
        self.model = make()

    def __call__(self, row: dict) -> dict:
        return self.model.merge(row["prompt"])


def merge_prompt() -> Column:
    """Two stories with their first headlines, from the columns of merge.described."""
    one = lambda s: F.concat(
        F.lit(f"Story {s.upper()}\n"), *_said("Title", F.col(f"{s}_title")), *_said("Summary", F.col(f"{s}_summary")), *_said("Event", F.col(f"{s}_date")), *_said("First seen", F.col(f"{s}_first")), F.lit("Headlines:\n- "),
        F.coalesce(F.array_join(f"{s}_headlines", "\n- "), F.lit("none")),
    )
    return F.concat(one("a"), F.lit("\n\n"), one("b"), F.lit("\n\nDo both report the same single development?"))


def title_prompt() -> Column:
    """A story's anchor and the two pieces that are set against each other."""
    piece = lambda s: [F.lit(f"{s.capitalize()} piece, "), *_said("outlet", F.col(f"{s}.outlet")), *_said("Title", F.col(f"{s}.title")), *_said("Framing", F.col(f"{s}.framing"))]
    return F.concat(*_said("Development", F.col("summary")), *piece("left"), *piece("right"))


def embedding_text(summary, entities):
    return F.concat(F.coalesce(summary, F.lit("")), F.lit(" | Entities: "), F.array_join(F.coalesce(entities, F.array().cast("array<string>")), ", "))
