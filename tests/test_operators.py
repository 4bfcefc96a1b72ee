"""Sequential operators against scenarios with invented data."""

from datetime import date, datetime, timedelta

import pytest
from pyspark.sql import functions as F

from plait.config import Config
from plait.operators import assign, enrich, merge, models, pairs, stories as S

T0 = datetime(2026, 1, 1)


def article(n, vector, leaning="LEFT", kind="news", hours=0, **more):
    base = {"id": n, "block": "all", "phase": 0, "published_at": T0 + timedelta(hours=hours or n), "event_date": date(2026, 1, 1), "key_entities": ["Ann Lee"], "article_type": kind, "is_wire_copy": False, "leaning_label": leaning, "leaning_conf": 0.9, "outlet_leaning": "CENTER", "split_from": None, "category": "politics", "title": f"Title {n}", "event_summary": f"Summary {n}", "vector": vector}
    return base | more


SCHEMA = "id long, block string, phase int, published_at timestamp, event_date date, key_entities array<string>, article_type string, is_wire_copy boolean, leaning_label string, leaning_conf double, outlet_leaning string, split_from string, category string, title string, event_summary string, vector array<double>"


def assigned(spark, rows, verifier=None, config=Config()):
    return {r["id"]: r for r in assign.assign_in_order(spark.createDataFrame([tuple(r[c.split()[0]] for c in SCHEMA.split(", ")) for r in rows], SCHEMA), None, verifier, config).collect()}


def test_five_articles_make_two_stories(spark):
    rows = [article(1, [1.0, 0.0, 0.0]), article(2, [0.99, 0.14, 0.0], "RIGHT"), article(3, [0.98, 0.2, 0.0], kind="opinion"), article(4, [0.97, 0.0, 0.24], is_wire_copy=True), article(5, [0.0, 1.0, 0.0])]
    got = assigned(spark, rows)
    assert [got[i]["method"] for i in range(1, 6)] == ["create", "threshold", "threshold", "threshold", "create"]
    assert len({got[i]["story_id"] for i in range(1, 5)}) == 1 and got[4]["story_size"] == 4 and [got[i]["side"] for i in (1, 2)] == ["left", "right"]


def test_orphans_and_memory(spark):
    got = assigned(spark, [article(1, None), article(2, [1.0, 0.0], kind="opinion"), article(3, [0.0, 1.0], is_wire_copy=True)])
    assert {r["method"] for r in got.values()} == {"orphan"}
    first = assigned(spark, [article(1, [1.0, 0.0])])[1]["story_id"]
    assert assigned(spark, [article(1, [1.0, 0.0]), article(2, [1.0, 0.0], split_from=first)])[2]["method"] == "create"


def late_split(article, shown):
    return {"relation": "follow_up", "confidence": 0.9, "candidate_id": shown[0].id}


def test_late_match_is_verified(spark):
    rows = [article(1, [1.0, 0.0]), article(2, [1.0, 0.0], hours=30)]
    assert assigned(spark, rows)[2]["method"] == "verifier"
    assert assigned(spark, rows, late_split)[2]["method"] == "create"


MEMBER = "story_id string, id long, side string, outlet string, title string, snippet string, image_url string, published_at timestamp, article_type string, is_wire_copy boolean, direction string, confidence double, axes array<string>"


def member(n, side, outlet, title, direction=None, axes=None, kind="news", **more):
    r = {"story_id": "s", "id": n, "side": side, "outlet": outlet, "title": title, "snippet": None, "image_url": None, "published_at": T0, "article_type": kind, "is_wire_copy": False, "direction": direction, "confidence": 0.9, "axes": axes or []} | more
    return tuple(r.values())


def test_opposing_beats_framing(spark):
    rows = spark.createDataFrame([member(1, "left", "L1", "Budget helps schools", "supports", ["schools"]), member(2, "left", "L2", "Budget framed", None, ["schools"]), member(3, "right", "R1", "Spending is too high", "opposes", ["taxes"])], MEMBER)
    got = pairs.best(rows).first()
    assert (got["left_article_id"], got["right_article_id"], got["pair_kind"], got["divergence_score"]) == (1, 3, "opposing_stance", 5.5)


@pytest.mark.parametrize("change", [{"is_wire_copy": True}, {"article_type": "roundup"}, {"title": "Transcript: talk"}, {"title": "Same words here"}, {"outlet": "L"}])
def test_no_pair(spark, change):
    rows = spark.createDataFrame([member(1, "left", "L", "Same words here"), member(2, "right", **({"outlet": "R", "title": "Other text"} | change))], MEMBER)
    assert pairs.best(rows).count() == 0


def test_hysteresis_and_idempotence(spark):
    rows = spark.createDataFrame([member(1, "left", "L1", "Budget helps schools", "supports"), member(2, "right", "R1", "Spending is too high", "opposes")], MEMBER)
    stories = spark.createDataFrame([("s",)], "story_id string")
    none = spark.createDataFrame([], "story_id string, left_article_id long, right_article_id long, pair_kind string, divergence_score double, featured_at timestamp, is_current boolean")
    one = pairs.maintain(stories, rows, none)
    assert one.first()["action"] == "created"
    table = pairs.apply(none, one)
    assert pairs.maintain(stories, rows, table).first()["action"] == "kept"
    gone = table.withColumn("left_article_id", F.lit(9).cast("long"))
    two = pairs.maintain(stories, rows, gone)
    assert two.first()["action"] == "replaced" and pairs.apply(gone, two).where("is_current").count() == 1
    assert pairs.maintain(stories, rows.where("side = 'left'"), gone).first()["action"] == "retired"


def test_merge_resolution(spark):
    rows = spark.createDataFrame([(1, 2, 0.97, 1, 2), (2, 3, 0.96, 2, 3), (3, 4, 0.95, 3, 4)], "a_id long, b_id long, similarity double, survivor long, absorbed long")
    yes = lambda row: {"same_development": True, "confidence": 0.9}
    assert merge.resolve(rows, yes)[0] == [(2, 1), (4, 3)]
    assert merge.resolve(rows, lambda row: {"same_development": True, "confidence": 0.6})[0] == [] and merge.resolve(rows, None)[0] == []
    assert merge.final_targets([(2, 1), (1, 5)]) == {2: 5, 1: 5}


def test_founder_prefers_a_report(spark):
    rows = spark.createDataFrame([("s", 1, T0, "x", "news", True), ("s", 2, T0 + timedelta(hours=1), "x", "opinion", False), ("s", 3, T0 + timedelta(hours=2), "x", "news", False), ("s", 4, T0, "", "news", False)], "story_id string, id long, published_at timestamp, event_summary string, article_type string, is_wire_copy boolean")
    assert S.founders(rows).first()["founder_id"] == 3


class Failing:
    def enrich(self, prompt):
        raise OSError("down")

    def embed(self, texts):
        raise OSError("down")


def test_models_report_errors(spark):
    rows = spark.createDataFrame([(1, "a"), (2, "b")], "id long, p string")
    assert all(r["error"] == "down" and r["answer"] is None for r in models.ask(rows, "id", "p", lambda: Failing().enrich).collect())
    assert all(r["error"] == "down" for r in models.embed(rows, "id", "p", Failing).collect())
    assert all(len(r["vector"]) == 64 for r in models.embed(rows, "id", "p", models.OfflineModel).collect())


def test_retrieval_by_blocks_equals_shipping(spark):
    import numpy as np

    from plait.operators.retrieval import similar_pairs, top_stories

    rng = np.random.default_rng(2)
    unit = lambda n: [(v / np.sqrt((v * v).sum())).tolist() for v in rng.standard_normal((n, 8))]
    a = spark.createDataFrame([(i, T0 + timedelta(hours=i), v) for i, v in enumerate(unit(50))], "id long, published_at timestamp, vector array<double>")
    s = spark.createDataFrame([(i, T0 + timedelta(hours=5 * i - 100), v) for i, v in enumerate(unit(30))], "id long, last_seen timestamp, vector array<double>")
    rows = lambda df: sorted((r["article_id"], r["rank"], r["story_id"], round(r["similarity"], 9)) for r in df.collect())
    one, two = top_stories(a, s, k=4), top_stories(a, s, k=4, block=7, shipped_bytes=5)
    assert rows(one) == rows(two) and len(rows(one)) > 100
    again = a.unionByName(a.withColumn("id", F.col("id") % 10))  # repeated ids ask together
    named = s.withColumn("id", F.concat(F.lit("s"), F.col("id").cast("string")))
    for stories in (s, named):
        one, two = top_stories(again, stories, k=3), top_stories(again, stories, k=3, block=7, shipped_bytes=5)
        assert rows(one) == rows(two) and max(r[1] for r in rows(one)) == 3
        assert len({(r[0], r[2]) for r in rows(one)}) == len(rows(one))
    assert top_stories(a.limit(0), s, shipped_bytes=0).count() == 0 == top_stories(a, s.limit(0), shipped_bytes=-1).count()
    best = sorted(((r["a_id"], r["b_id"]) for r in similar_pairs(s, 0.2).orderBy(F.desc("similarity")).limit(5).collect()))
    assert best == sorted(((r["a_id"], r["b_id"]) for r in similar_pairs(s, 0.2, block=4, most=5).orderBy(F.desc("similarity")).limit(5).collect()))
    pairs_of = lambda df: sorted((r["a_id"], r["b_id"], round(r["similarity"], 9)) for r in df.collect())
    assert pairs_of(similar_pairs(s, 0.2)) == pairs_of(similar_pairs(s, 0.2, block=4))


def test_only_blocks_within_the_window_meet(spark):
    from plait.operators import retrieval

    width = 96 * 3_600_000_000
    at = lambda days: F.lit(days) * 86_400_000_000
    left = spark.range(400).select("id", (at(100) + F.col("id") * 21_600_000_000).cast("long").alias("at"))  # days 100 to 200
    right = spark.range(3000).select("id", (F.col("id") * 5_760_000_000).cast("long").alias("at"))  # days 0 to 200
    alike = F.array(F.lit(1.0)).alias("v")  # so time alone decides
    one, two = retrieval.meetings(left.select("*", alike), right.select("*", alike), width, 20, least=0.0)
    keys = lambda df: {(r["lb"], r["rb"]) for r in df.select("lb", "rb").distinct().collect()}
    span = lambda df, key: {r[key]: (r["a"], r["z"]) for r in df.groupBy(key).agg(F.min("at").alias("a"), F.max("at").alias("z")).collect()}
    a, b = span(one, "lb"), span(two, "rb")
    assert keys(one) == keys(two) and all(b[y][1] >= a[x][0] - 2 * width for x, y in keys(one))
    assert len(keys(one)) < 0.45 * len(a) * (3000 // 20)
    must = {(x["lb"], y["rb"]) for x in one.select("lb", "at").distinct().collect()[::7] for y in two.select("rb", "at").distinct().collect()[::97] if y["at"] >= x["at"] - width}
    assert must <= keys(one)


def test_pairs_by_blocks_equal_the_join(spark):
    from plait.operators import pair_blocks
    from plait.plans.proxies import articles as px

    rows = px(spark, "/root/testdata/sf0.001").cache()
    current = rows.groupBy("story_id").agg(F.array(F.min("outlet"), F.max("outlet")).alias("outlets"))
    listed = lambda df: sorted(tuple(r) for r in df.select("story_id", "left_article_id", "right_article_id", "pair_kind", "divergence_score", "featured_at").collect())
    for now in (None, current):
        want = listed(pairs.best_by_join(rows, now, near="title"))
        assert want and listed(pair_blocks.best(rows, now, near="title")) == want and listed(pair_blocks.best(rows, now, near="title", block=3, buckets=2)) == want
    assert listed(pairs.best(rows)) == listed(pairs.best_by_join(rows))
    rows.unpersist()


def test_nearest_equals_a_plain_search():
    import numpy as np
    import pandas as pd

    rng = np.random.default_rng(4)
    run = assign.Sequence(Config(candidates=5, verify_threshold=-1000.0))  # every story could reach the threshold
    for n in range(150):
        v = rng.integers(-2, 3, 4).astype(float)  # many ties
        run.add(assign.Story(f"s{rng.integers(0, 10**9)}", "", "", None, None, None, pd.Timestamp(T0) + pd.Timedelta(hours=int(rng.integers(0, 100))), v, [], status="open" if n % 7 else "closed"))
        q, since = rng.integers(-2, 3, 4).astype(float), pd.Timestamp(T0) + pd.Timedelta(hours=int(rng.integers(0, 100)))
        plain = sorted((-float(s.centroid @ q), s.id) for s in run.list if s.status == "open" and s.last_seen >= since)[:5]
        assert [(-sim, s.id) for sim, s in run.nearest(q, since)] == plain


def test_sequential_pass_from_given_stories(spark):
    given = spark.createDataFrame([("s1", "all", "Sum", "T", "politics", date(2026, 1, 1), T0, T0 + timedelta(hours=1), [1.0, 0.0], ["Ann Lee"], 3, 2, 1, 0, "open"), ("s2", "all", "Sum", "T", "politics", None, T0, T0, [0.0, 1.0], [], 1, 0, 1, 0, "closed")], "id string, block string, summary string, title string, category string, event_date date, first_seen timestamp, last_seen timestamp, centroid array<double>, key_entities array<string>, article_count int, left_count int, right_count int, center_count int, status string")
    rows = [article(1, [1.0, 0.0]), article(2, [0.0, 1.0])]
    df = spark.createDataFrame([tuple(r[c.split()[0]] for c in SCHEMA.split(", ")) for r in rows], SCHEMA)
    got = {r["id"]: r for r in assign.assign_in_order(df, given).collect()}
    assert got[1]["story_id"] == "s1" and got[1]["story_size"] == 4 and got[2]["method"] == "create"


def test_order_of_input_does_not_matter(spark):
    import random

    rows = [article(n, [1.0, 0.03 * n, 0.0] if n % 3 else [0.0, 0.1 * n, 1.0], hours=n, block=f"b{n % 2}", kind="opinion" if n % 5 == 0 else "news") for n in range(1, 40)]
    base = {k: tuple(v) for k, v in assigned(spark, rows).items()}
    random.Random(1).shuffle(rows)
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "3")
    try:
        assert {k: tuple(v) for k, v in assigned(spark, rows).items()} == base
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")
    assert len({v[3] for v in base.values()}) > 2


def test_null_blocks_and_batch_sizes(spark):
    """Equal results whatever the size of Arrow batches, also for articles without a block, from nothing and from given stories."""
    rows = [article(n, [1.0, 0.01 * n], hours=n / 4, block=None if n % 2 else "b") for n in range(1, 13)]
    given = spark.createDataFrame([("s1", None, "Sum", "T", "politics", None, T0, T0, [1.0, 0.0], ["Ann Lee"], 3, 2, 1, 0, "open")], "id string, block string, summary string, title string, category string, event_date date, first_seen timestamp, last_seen timestamp, centroid array<double>, key_entities array<string>, article_count int, left_count int, right_count int, center_count int, status string")
    df = spark.createDataFrame([tuple(r[c.split()[0]] for c in SCHEMA.split(", ")) for r in rows], SCHEMA)
    seen = []
    for size in ("10000", "2"):
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", size)
        try:
            seen.append([{r["id"]: (r["block"], r["method"], r["story_id"], r["story_size"], r["step"]) for r in assign.assign_in_order(df, known).collect()} for known in (None, given)])
        finally:
            spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")
    assert seen[0] == seen[1] and [sum(v[1] == "create" for v in x.values()) for x in seen[0]] == [2, 1]
    assert {v[2] for k, v in seen[0][1].items() if k % 2} == {"s1"}


def fails_on_three(article, shown):
    if article.id == 3:
        raise OSError("verifier down")
    return {"relation": "same_development", "confidence": "0.9", "candidate_id": shown[0].id, "reason": "same"}


def test_records_and_failures(spark):
    """The record of each decision, and an article whose verifier fails, which stops no other."""
    rows = [article(1, [1.0, 0.0, 0.0]), article(2, [1.0, 0.0, 0.0], hours=30), article(3, [1.0, 0.0, 0.0], hours=31), article(4, [0.75, 0.66, 0.0], hours=32), article(5, [0.0, 0.0, 1.0], kind="opinion"), article(6, [1.0, 0.0, 0.0], hours=3, event_date=date(2026, 2, 1)), article(7, [1.0, 0.0], hours=40)]
    got = assigned(spark, rows, fails_on_three)
    assert [got[n]["method"] for n in range(1, 8)] == ["create", "verifier", "failed", "verifier", "orphan", "create", "failed"]
    assert "verifier down" in got[3]["error"] and got[3]["story_id"] is None and got[7]["error"] and got[2]["error"] is None
    first = got[1]["story_id"]
    assert got[2]["candidates"][0]["id"] == first and got[2]["candidates"][0]["verify_reason"] == "late" and '"reason": "same"' in got[2]["verifier"] and got[2]["rule"] == assign.RULE
    assert got[5]["reason"] == "opinion cannot create a story" and [c["rejected"] for c in got[6]["candidates"]] == ["event_date_gap"]
    states = {r["id"]: r["story"] for r in assign.assign_in_order(spark.createDataFrame([tuple(r[c.split()[0]] for c in SCHEMA.split(", ")) for r in rows[:2]], SCHEMA), with_stories=True).collect()}
    assert [states[n]["article_count"] for n in (1, 2)] == [1, 2] and states[2]["id"] == first and states[2]["title"] == "Summary 1" and abs(sum(x * x for x in states[2]["centroid"]) - 1) < 1e-9


def tells_memory(article, shown):
    with open("/proc/self/statm") as f:
        return {"relation": "unsure", "rss": int(f.read().split()[1]) * 4096}


@pytest.mark.parametrize("begin", ["nothing", "a story"])
def test_a_block_passes_in_slices(spark, begin):
    """What a task holds of a block's results, each with its story's centroid, does not grow with the block."""
    base = spark.createDataFrame([tuple(article(0, [])[c.split()[0]] for c in SCHEMA.split(", "))], SCHEMA)
    wide = F.array_repeat(F.lit(1000**-0.5), 1000)
    rows = base.drop("id", "published_at", "vector").crossJoin(spark.range(1, 4001)).withColumns({"published_at": F.timestamp_seconds(F.lit(T0.timestamp()) + 60 * F.col("id")), "vector": wide})
    known = [("s1", "all", "Sum", "T", "politics", None, T0, T0, [1.0], ["Ann Lee"], 3, 2, 1, 0, "open")]
    names = "id string, block string, summary string, title string, category string, event_date date, first_seen timestamp, last_seen timestamp, centroid array<double>, key_entities array<string>, article_count int, left_count int, right_count int, center_count int, status string"
    given = None if begin == "nothing" else spark.createDataFrame(known, names).withColumn("centroid", wide)
    done = assign.assign_in_order(rows, given, tells_memory, with_stories=True).select("id", "step", "story_size", F.get_json_object("verifier", "$.rss").cast("long").alias("rss"))
    got = sorted(map(tuple, done.collect()))
    assert [(n, step, size) for n, step, size, _ in got] == [(n, n - 1, n + 3 * (given is not None)) for n in range(1, 4001)]
    held = [rss for *_, rss in got if rss is not None]
    assert len(held) > 3000 and max(held) - held[0] < 64 << 20


def test_decide_knows_who_may_create(spark):
    rows = [article(n, [0.0, 1.0], kind=kind, is_wire_copy=wire) for n, kind, wire in ((1, "news", False), (2, "opinion", False), (3, "news", True))]
    df = spark.createDataFrame([tuple(r[c.split()[0]] for c in SCHEMA.split(", ")) for r in rows], SCHEMA)
    known = spark.createDataFrame([("s1", None, T0, T0, [1.0, 0.0], ["Ann Lee"])], "id string, event_date date, first_seen timestamp, last_seen timestamp, vector array<double>, key_entities array<string>")
    assert {r["article_id"]: r["decision"] for r in assign.decide(df, known).collect()} == {1: "create", 2: "orphan", 3: "orphan"}


def test_copies_are_compared_once(spark, monkeypatch):
    """A story of which all members are worded alike has no pair, and finds that out with one comparison."""
    import pandas as pd

    from plait.operators import pair_blocks

    calls = []
    monkeypatch.setattr(pair_blocks, "_same_news", lambda *a: calls.append(a) or True)
    side = lambda s, n: pd.DataFrame({"id": range(n), "outlet": [f"{s}{i % 50}" for i in range(n)], "article_type": "news", "direction": None, "confidence": 0.0, "axes": [[]] * n, "at": range(n), "has_image": True, "has_snippet": True, "title": "same words", "snippet": "same"})
    assert pair_blocks.best_of(side("l", 300), side("r", 300), None, "ratio", 0.9) is None and len(calls) == 1


def test_mean_centroids_of_many_dimensions(spark):
    rows = spark.range(60).select((F.col("id") % 3).alias("story_id"), F.transform(F.sequence(F.lit(1), F.lit(40)), lambda i: ((F.col("id") * i) % 7).cast("double")).alias("vector"))
    one, two = ({r["story_id"]: [round(x, 9) for x in r["centroid"]] for r in S.mean_centroids(rows, 40, wide).collect()} for wide in (128, 10))
    assert one == two and len(one) == 3


def test_framing_queue_is_whole_unless_told(spark):
    """More rows than a command's cap of 3,000 lack framing: all are queued, and a cap takes the newest."""
    stance = F.struct(F.array().cast("array<string>").alias("framing_axes"), F.lit("told").alias("framing_summary"))
    rows = spark.range(3500).select("id", F.lit("s").alias("story_id"), F.lit("done").alias("enrichment_status"), F.timestamp_seconds(F.col("id")).alias("published_at"), stance.alias("stance"))
    assert enrich.framing_queue(rows, F.timestamp_seconds(F.lit(100))).count() == 3400
    assert {r["id"] for r in enrich.framing_queue(rows, F.timestamp_seconds(F.lit(100)), 3).collect()} == {3499, 3498, 3497}


def test_framing_is_filled_in_for_more_than_a_command_takes(spark):
    """The backfill answers every queued row."""
    stance = F.struct(F.array().cast("array<string>").alias("framing_axes"), F.lit("told").alias("framing_summary"))
    none = F.lit(None).cast("string")
    rows = spark.range(3100).select("id", F.lit("s").alias("story_id"), F.lit("done").alias("enrichment_status"), F.timestamp_seconds(F.col("id")).alias("published_at"), stance.alias("stance"), F.lit("o").alias("outlet"), F.lit("t").alias("title"), none.alias("headline"), none.alias("subheadline"), none.alias("body_text"))
    out = enrich.backfill_framing(enrich.framing_queue(rows, F.timestamp_seconds(F.lit(0))))
    assert out.where("size(stance.framing_axes) > 0").count() == 3100


def test_framing_of_blank_titles_and_empty_outlets(spark):
    """A title of white space alone is told as none, an outlet as it stands."""
    stance = F.struct(F.array(F.lit("x")).alias("framing_axes"), F.lit(None).cast("string").alias("framing_summary"))
    rows = spark.createDataFrame([(1, "o", "  "), (2, "o", "\t\r"), (3, "o", "\u2003"), (4, "o", ""), (5, "", "a b"), (6, "o", " a ")], "id long, outlet string, title string")
    rows = rows.withColumns({"stance": stance, "headline": F.lit(None).cast("string"), "subheadline": F.lit(None).cast("string"), "body_text": F.lit("text")})
    got = {r["id"]: r["stance"]["framing_summary"] for r in enrich.backfill_framing(rows).collect()}
    blank = "Outlet: o Headline: none Page title: none Subheadline:"
    assert got == {1: blank, 2: blank, 3: blank, 4: blank, 5: "Outlet: Headline: a b Page title: a b", 6: "Outlet: o Headline: a Page title: a Subheadline:"}


def test_what_an_article_tells_is_not_computed_for_each_pair(spark):
    """Above the join of a story's two sides no title is normalised and no axis is put in lower case."""
    kinds = "id long, story_id long, side string, is_wire_copy boolean, outlet string, title string, snippet string, image_url string, published_at timestamp, article_type string, direction string, confidence double, axes array<string>"
    plan = pairs.candidates(spark.createDataFrame([], kinds), near="title").select("l.id", "r.id", "score", "kind")._jdf.queryExecution().optimizedPlan().toString()
    above = plan.partition("Join")[0]
    assert "Join" in plan and "regexp_replace" not in above and "array_distinct" not in above
