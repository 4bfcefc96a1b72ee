"""Models behind their interfaces: rules for structured answers, vectors, usage; the table service and its functions by name."""

import json
import time
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from plait.operators import enrich, models
from plait.sources import service, tables

T0 = datetime(2026, 1, 1)


def replies(*given):
    """A sender that gives one reply after the other, and what it was asked."""
    asked, left = [], list(given)

    def send(request):
        asked.append(request)
        x = left.pop(0)
        if isinstance(x, Exception):
            raise x
        return x if isinstance(x, models.Reply) else models.Reply(x, tokens_in=5, tokens_out=1)

    return send, asked


def test_broken_and_truncated_answers_are_asked_again():
    send, asked = replies("{broken", models.Reply('{"a": 1', "length"), '{"a": 2}')
    m = models.Structured(send, {"": "one"})
    assert m.enrich("p") == {"a": 2} and len(asked) == 3 and [c["model"] for c in m.calls] == ["one"] * 3
    send, asked = replies(*[models.Reply('{"a": 1}', "length")] * 3)
    with pytest.raises(models.Truncated):
        models.Structured(send, {"": "one"}).frame("p")
    assert len(asked) == 3


def test_broken_answers_are_asked_again_at_once():
    send, _ = replies("{", "{", '{"a": 1}')
    began = time.perf_counter()
    assert models.Structured(send, {"": "one"}, pause=5.0).title("p") == {"a": 1} and time.perf_counter() - began < 1


def test_only_the_verifying_tier_falls_back():
    down = [OSError("down")] * 3
    send, asked = replies(*down, '{"relation": "unrelated"}')
    assert models.Structured(send, {"verify": "big", "": "small"}, fallback="spare").verify("p") == {"relation": "unrelated"}
    assert [r.model for r in asked] == ["big"] * 3 + ["spare"]
    for kind, fallback, model in (("enrich", "spare", "small"), ("frame", "spare", "small"), ("merge", None, "big"), ("merge", "big", "big")):
        send, asked = replies(*down)
        with pytest.raises(OSError):
            getattr(models.Structured(send, {"merge": "big", "": "small"}, fallback=fallback), kind)("p")
        assert [r.model for r in asked] == [model] * 3


def test_effort_and_headroom():
    m = models.Structured(None, {}, efforts={"five": "minimal", "six": "low", "six-plain": "none"})
    told = {name: (r.effort, r.most_tokens) for name in ("five-x", "six-y", "six-plain", "other") for r in [m.request(name, "verify", "p")]}
    assert told == {"five-x": ("minimal", 300), "six-y": ("low", 2300), "six-plain": ("none", 300), "other": (None, 300)}
    assert m.request("six-y", "enrich", "p").most_tokens == 3200


class Shuffled(models.OfflineModel):
    def embed(self, texts):
        return [{"index": i, "embedding": [float(len(texts[i])), 1.0]} for i in reversed(range(len(texts)))]


class Short(models.OfflineModel):
    def embed(self, texts):
        return [[1.0]] * (len(texts) - 1)


def test_vectors_come_back_in_order(spark):
    rows = spark.createDataFrame([(i, "x" * i) for i in range(150)], "id long, t string").coalesce(1)
    got = models.embed(rows, "id", "t", Shuffled).collect()
    assert len(got) == 150 and all(r["vector"] == [float(r["id"]), 1.0] for r in got)
    assert all(r["vector"] is None and "vectors for" in r["error"] for r in models.embed(rows, "id", "t", Short).collect())


ARTICLE = "id long, outlet string, published_at timestamp, title string, headline string, subheadline string, body_text string, body_chars int, wire_hint boolean, authors array<string>, evidence struct<section:string>"


class Echo(models.OfflineModel):
    """Enrichment of which the summary is the prompt; framing fails for every second article."""

    def __init__(self):
        super().__init__()
        self.calls = []

    def enrich(self, prompt):
        self.calls.append({"kind": "enrich", "model": "echo", "tokens_in": len(prompt), "tokens_out": 3})
        return super().enrich(prompt) | {"event_summary": prompt}

    def frame(self, prompt):
        self.calls.append({"kind": "framing", "model": "echo", "tokens_in": 1, "tokens_out": 1})
        if "Headline: T2" in prompt:
            raise OSError("down")
        return {"framing_axes": [" new  axis ", " "], "framing_summary": " told "}


def test_enrichment_asks_for_framing_once_more(spark):
    rows = spark.createDataFrame([(1, "O", T0, "T1", None, "Sub", "Body", 400, False, ["Ann", "Bo"], ("World",)), (2, "O", T0, "T2", None, None, "Body", 400, False, [], (None,))], ARTICLE)
    got = {r["id"]: r for r in enrich.run(rows, Echo).collect()}
    assert got[1]["event_summary"].splitlines()[5:7] == ["Section: World", "Authors: Ann, Bo"] and got[2]["event_summary"].splitlines()[5:7] == ["Section: none", "Authors: none"]
    assert got[1]["stance"]["framing_axes"] == ["new axis"] and got[1]["stance"]["framing_summary"] == "told"
    assert got[2]["stance"]["framing_axes"] == [] and got[2]["enrichment_status"] == "done" and got[2]["error"] is None
    calls = enrich.run(rows, Echo).select(F.explode("calls").alias("c")).select("c.*")
    assert {(r["kind"], r["calls"]) for r in models.usage(calls).collect()} == {("enrich", 2), ("framing", 4)}  # one framing call is tried three times


def test_service_requests():
    given = [(503, b""), OSError("reset"), (200, b'[{"n": 1}]'), (204, b""), (404, b"no such function"), (429, b"slow"), (429, b"slow"), (429, b"slow")]
    asked = []

    def send(method, path, parameters, body, seconds):
        asked.append((method, path, body, seconds))
        x = given.pop(0)
        if isinstance(x, Exception):
            raise x
        return x

    s = service.Service(send, pause=0.0)
    assert s.call("close", {"days": 5}) == [{"n": 1}] and asked[0] == ("POST", "rpc/close", json.dumps({"days": 5}).encode(), 90.0) and len(asked) == 3
    assert s.request("PATCH", "t", body={}) is None and asked[-1][3] == 30.0
    with pytest.raises(RuntimeError, match="404"):
        s.call("missing", {})
    assert len(asked) == 5
    with pytest.raises(RuntimeError, match="429"):
        s.request("GET", "t")
    assert len(asked) == 8


def test_functions_by_name(spark):
    story = "story_id string, status string, last_seen timestamp, updated_at timestamp, centroid array<double>, article_count int, left_count int, right_count int, center_count int, event_date date, first_seen timestamp"
    old = T0 - timedelta(days=9)
    stories = spark.createDataFrame([("a", "open", T0, T0, [1.0, 0.0], 5, 0, 0, 0, None, T0), ("b", "open", T0, T0, [0.99, 0.141], 1, 0, 0, 0, None, T0), ("c", "open", old, old, [1.0, 0.0], 1, 0, 0, 0, None, old), ("d", "closed", T0, T0, [1.0, 0.0], 1, 0, 0, 0, None, T0)], story)
    articles = spark.createDataFrame([(1, "a", "left", T0, "body"), (2, "b", "right", old - timedelta(days=30), "body")], "id long, story_id string, side string, published_at timestamp, body_text string")
    pairs = spark.createDataFrame([("b", 1, 2, True)], "story_id string, left_article_id long, right_article_id long, is_current boolean")
    have = {"stories": stories, "articles": articles, "pairs": pairs}
    now = F.lit(T0 + timedelta(hours=1))
    close = service.call("match_stories", have, query="[1.0,0.0]", since=F.lit(T0 - timedelta(hours=96)), k=5).collect()
    assert [(r["story_id"], round(r["similarity"], 3)) for r in close] == [("a", 1.0), ("b", 0.99)]
    assert {r["story_id"]: r["status"] for r in service.call("close_stale_stories", have, now=now).collect()} == {"a": "open", "b": "open", "c": "closed", "d": "closed"}
    counted = {r["story_id"]: (r["article_count"], r["left_count"]) for r in service.call("refresh_story_stats", have, target="a").collect()}
    assert counted["a"] == (1, 1) and counted["b"] == (1, 0)
    assert [(r["a_id"], r["b_id"]) for r in service.call("story_merge_candidates", have, min_similarity=0.9, updated_since=F.lit(T0), max_pairs=3).collect()] == [("a", "b")]
    after = service.call("merge_stories", have, survivor="a", absorbed="b")
    assert {r["story_id"] for r in after["articles"].collect()} == {"a"} and not after["pairs"].first()["is_current"] and {r["story_id"]: (r["status"], r["article_count"]) for r in after["stories"].collect()}["a"] == ("open", 2)
    assert sorted((r["id"], r["body_text"]) for r in service.call("trim_old_bodies", have, now=now).collect()) == [(1, "body"), (2, None)]
    with pytest.raises(LookupError):
        service.call("unknown", have)


def test_pages_of_a_scan(spark):
    rows = spark.range(23).withColumn("id", F.col("id") * 3)
    for size, lengths in ((10, [10, 10, 3]), (23, [23]), (50, [23])):
        got = list(tables.pages_of(rows, "id", size))
        assert [len(p) for p in got] == lengths and [r["id"] for p in got for r in p] == list(range(0, 69, 3))
    assert list(tables.pages_of(rows.limit(0), "id", 5)) == []
