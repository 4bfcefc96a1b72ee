"""The registered queries and the pipeline on the driver's small tables, with brute-force checks where SQL has none."""

import hashlib
import math
import re
import zlib

import pyarrow as pa
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from plait.llm import queries
from tests.oracle import compare

SMALL = "/root/testdata/sf0.001"


@pytest.mark.parametrize("name", sorted(queries.SQL))
def test_query_equals_sql(spark, name):
    assert compare(spark, name, SMALL) == ""


def documents(spark):
    return {r["doc_id"]: r for r in spark.read.parquet(f"{SMALL}/documents.parquet").collect()}


def test_op2_held_out_accuracy(spark):
    docs, got = documents(spark), queries.op2_language_id(spark, SMALL).collect()
    assert len(got) == len(docs) and all(r["held_out"] == (zlib.crc32(str(r["doc_id"]).encode()) % 4 == 2) for r in got)
    held = [r for r in got if r["held_out"]]
    assert sum(r["lang_pred"] == docs[r["doc_id"]]["lang"] for r in held) >= 0.9 * len(held)


def test_op2_short_texts_by_language(spark):
    """Held-out texts cut to a few characters: no language is swallowed by the most frequent one."""
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    model = queries.language_id.fit(docs, where=queries.fold("doc_id", 4) != 2)
    held = docs.where((queries.fold("doc_id", 4) == 2) & F.col("lang").isNotNull())
    for n, least in ((80, 0.9), (40, 0.9), (25, 0.85), (12, 0.6)):
        rows = held.select("doc_id", "lang", F.substring("text", 1, n).alias("text")).where(F.col("text").rlike(r"\p{L}"))
        right = rows.join(queries.language_id.predict(rows, model), "doc_id").groupBy("lang").agg(F.avg((F.col("lang") == F.col("lang_pred")).cast("int")).alias("share"))
        found = {r["lang"]: r["share"] for r in right.collect()}
        assert len(found) == 4 and min(found.values()) >= least, (n, found)
    phrases = spark.createDataFrame(list(enumerate(("der hund", "die katze", "nach hause", "der weg durch den wald"))), "doc_id long, text string")
    said = queries.language_id.predict(phrases, model).collect()
    assert all(r["lang_pred"] == "de" or r["rejected"] or r["score"] < 0.6 for r in said)


def test_op5_base(spark):
    patterns = {"assign": (r"(?i)(password|passwd|secret|token|api_?key)[\"']?\x20*[:=]\x20*[\"']?([A-Za-z0-9+/_.=-]+)", 2, 6), "access": (r"AKIA[A-Z0-9]+", 0, 20), "hex": (r"[0-9a-f]+", 0, 24)}
    docs = documents(spark)
    for r in queries.op5_secret_scans(spark, SMALL).collect():
        found = []
        for n, (kind, (pattern, group, least)) in enumerate(patterns.items()):
            spans = [m.span() for m in re.finditer(pattern, docs[r["doc_id"]]["text"], re.ASCII) if len(m[group]) >= least]
            assert r[f"n_{kind}"] == len(spans)
            found += [(s, n, f"{kind}:{s}:{e}") for s, e in spans]
        assert r["base_sha256"] == hashlib.sha256(",".join(x[2] for x in sorted(found)).encode()).hexdigest()


def test_op9_held_out_accuracy(spark):
    """On the middle table: the small one has 68 labels to learn from."""
    middle = "/root/testdata/sf0.01"
    labels = {r["doc_id"]: r["quality"] for r in spark.read.parquet(f"{middle}/labels.parquet").collect()}
    got = queries.op9_quality_classifier(spark, middle).collect()
    held = [(r["score"], r["predicted"], labels[r["doc_id"]]) for r in got if r["held_out"] and r["doc_id"] in labels]
    right = [[predicted == label for _, predicted, label in held if label == side] for side in (0, 1)]
    assert min(map(len, right)) >= 8 and sum(sum(x) / len(x) for x in right) / 2 >= 0.8  # always answering 1 has 0.5
    low, high = ([score for score, _, label in held if label == side] for side in (0, 1))
    assert sum((a < b) + 0.5 * (a == b) for a in low for b in high) / len(low) / len(high) >= 0.95


def test_op9_equals_brute_force(spark):
    """Every document's score from the model's rules by plain loops, and statistics by definition."""
    from plait.llm import rule_ensemble as Q

    docs, labels = (spark.read.parquet(f"{SMALL}/{n}.parquet") for n in ("documents", "labels"))
    model = Q.fit(docs, labels, where=queries.fold("doc_id", 5) != 0)
    values = {r["doc_id"]: r for r in Q.with_statistics(docs, ["doc_id"], "text").collect()}
    for r in queries.op9_quality_classifier(spark, SMALL).collect():
        x = values[r["doc_id"]]
        odds = model.intercept + sum(w for rule, w in zip(model.rules, model.weights) if all((x[n] <= cut) == (sign == "<=") for n, sign, cut in rule))
        assert abs(r["score"] - 1 / (1 + math.exp(-odds))) < 1e-9 and r["predicted"] == (r["score"] >= 0.3) and r["held_out"] == (zlib.crc32(str(r["doc_id"]).encode()) % 5 == 0)
    texts = {i: r["text"] for i, r in documents(spark).items()}
    for i, text in texts.items():
        w = re.findall(r"[^\x20\x09-\x0D]+", text or "")
        x = values[i]
        assert x["words"] == len(w) and x["longest_word"] == max((len(a.encode()) for a in w), default=0)
        assert math.isclose(x["upper_share"], sum("A" <= c <= "Z" for c in text or "") / max(1, len((text or "").encode())))
        pairs = [tuple(w[j : j + 3]) for j in range(len(w) - 2)]
        assert math.isclose(x["repeated_trigrams"], sum(pairs.count(p) > 1 for p in pairs) / max(1, len(pairs)) if len(w) < 2000 else x["repeated_trigrams"])


def test_op9_is_the_same_for_any_order_of_rows(spark):
    from plait.llm import rule_ensemble as Q

    rows = [(i, f"plain words {i} follow each other here " * 3 if i % 4 else f"w{i}%%% x{i}*** y&&& " * 6) for i in range(120)] + [(i, "other text of the same id " * (i + 1)) for i in range(0, 60, 3)]
    labels = spark.createDataFrame([(i, int(i % 4 > 0)) for i in range(120)], "doc_id long, quality int")
    one, two = (Q.fit(spark.createDataFrame(r, "doc_id long, text string").repartition(n), labels) for r, n in ((rows, 1), (rows[::-1], 7)))
    assert one == two


def test_pipeline_stages(spark):
    docs = spark.read.parquet(f"{SMALL}/documents.parquet")
    columns = docs.columns
    before = docs
    for name, stage in corpus_pipeline.STAGES:
        after = stage(spark, before, SMALL).cache()
        n = after.count()
        if name == "packing":
            assert after.groupBy("doc_id").agg(F.sum("length").alias("l"), F.max("doc_tokens").alias("t")).where("l <> t").count() == 0
            assert {r["doc_id"] for r in after.collect()} == {r["doc_id"] for r in before.collect()}
            break
        assert after.columns == columns and 0 < n <= before.count()
        if name == "ngram_jaccard_join":
            from plait.llm.jaccard_join import jaccard_components

            assert jaccard_components(after).where("n_shingles > 0 and component_id <> doc_id").count() == 0
        if name == "benchmark_decontamination":
            from plait.llm.decontamination import contaminated

            assert contaminated(after, spark.read.parquet(f"{SMALL}/benchmark.parquet")).count() == 0
        if name == "secret_scans":
            from plait.llm.secrets import scan_secrets

            assert n == before.count() and scan_secrets(after).where(F.size("spans") > 0).count() == 0
        before = after


def test_pipeline_equals_brute_force(spark, tmp_path):
    """Every stage of the pipeline against plain loops over all that the stage before it kept, on a table with repeated ids, copies, leaks and secrets."""
    from plait.llm import secrets as S
    from tests.llm.test_operators import brute_components, brute_secrets, brute_tiles, check_packing

    base = list(documents(spark).values())
    bench = [(r["item_id"], r["text"]) for r in spark.read.parquet(f"{SMALL}/benchmark.parquet").collect()]
    rows = [(r["doc_id"], r["text"], r["lang"], r["source"], r["n_chars"]) for r in base]
    rows += [(rows[3][0], rows[9][1], "en", "s", 1), (rows[4][0], rows[4][1] + " tail of it", "en", "s", 2), rows[5], (None, rows[6][1], None, None, None), (None, None, None, None, 0)]
    rows += [(10**6 + i, f"so {rows[20 + i][1]} then {text} and on", "en", "src1", 3) for i, (_, text) in enumerate(bench[:6])]
    fine = {r["doc_id"] for r in spark.read.parquet(f"{SMALL}/labels.parquet").where("quality = 1").collect()}
    good = [r["text"] for r in base if r["doc_id"] in fine and len(r["text"].split()) > 80]
    rows += [(2 * 10**6 + i, f"{' '.join(reversed(good[i].split()))} ghp_Zq8rT2mWx5Lk9Vb3Nc7Jd1Hf6Gs4Pa0YeUi{'abc'[i]} end", "en", f"src{i}", 4) for i in range(3)]
    key = lambda r: tuple(map(repr, r))
    schema = "doc_id long, text string, lang string, source string, n_chars long"
    spark.createDataFrame(rows, schema).write.parquet(f"{tmp_path}/documents.parquet")
    for name in ("labels", "benchmark"):
        spark.read.parquet(f"{SMALL}/{name}.parquet").write.parquet(f"{tmp_path}/{name}.parquet")
    sf, now = str(tmp_path), rows
    got = lambda stage: [tuple(r) for r in stage(spark, spark.createDataFrame(now, schema), sf).collect()]
    stages = dict(corpus_pipeline.STAGES)

    after = got(stages["quality_classifier"])
    model = queries.rule_ensemble.fit(queries.table(spark, sf, "documents"), queries.table(spark, sf, "labels"), where=queries.fold("doc_id", 5) != 0)
    x = queries.rule_ensemble.statistics(pa.array([r[1] for r in now], "string"))
    at = {n: i for i, n in enumerate(queries.rule_ensemble.STATISTICS)}
    odds = [model.intercept + sum(w for rule, w in zip(model.rules, model.weights) if all((x[at[n]][k] <= cut) == (sign == "<=") for n, sign, cut in rule)) for k in range(len(now))]
    assert sorted(map(key, after)) == sorted(key(r) for r, o in zip(now, odds) if 1 / (1 + math.exp(-o)) >= 0.3) and len(after) < len(now)

    now = after
    after = got(stages["ngram_jaccard_join"])
    numbered = list(enumerate(now))
    parts = {}
    for i, n, component in brute_components([(i, r[1]) for i, r in numbered]):
        parts.setdefault(("alone", now[i]) if not n else component, []).append(now[i])
    least = lambda group: min((r[0] is None, r[0] or 0) for r in group)
    assert len(after) == len(parts)
    kept = {key(r) for r in after}
    assert all(sum(key(r) in kept for r in set(group)) == 1 and any(key(r) in kept and (r[0] is None, r[0] or 0) == least(group) for r in group) for group in parts.values())

    now = after
    after = got(stages["benchmark_decontamination"])
    words = lambda t: re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]+", lambda m: m[0].lower(), t or ""))

    def leaks(text):
        doc = words(text)
        for _, item in bench:
            b = words(item)
            if not b:
                continue
            k = min(5, len(b))
            grams = {tuple(b[j : j + k]) for j in range(len(b) - k + 1)}
            near = {p for j in range(len(doc) - k + 1) if tuple(doc[j : j + k]) in grams for p in range(j, j + k)}
            a = [doc[j] if j in near else None for j in range(len(doc)) if j in near or j - 1 in near]  # other words as breaks
            if len(near) >= 0.6 * len(b) and sum(n for *_, n in brute_tiles(a, b, k)) >= 0.6 * len(b) - 1e-9:
                return True
        return False

    assert sorted(map(key, after)) == sorted(key(r) for r in now if not leaks(r[1])) and len(after) < len(now)

    now = after
    after = got(stages["secret_scans"])
    kinds = list(S.KINDS)
    want = []
    for (d, text, spans), r in zip(brute_secrets([(r[0], r[1], r[3]) for r in now], S.Settings()), now):
        told = S.redact(text, [(a, b, kinds[k]) for a, k, b, _ in spans]) if spans else r[1]
        want.append((d, told, r[2], r[3], len(told) if spans else r[4]))
    assert sorted(map(key, after)) == sorted(map(key, want)) and any("<secret:provider>" in (r[1] or "") for r in after)

    now = after
    frame = spark.createDataFrame(now, schema)
    check_packing([(r[0], r[1]) for r in now], stages["packing"](spark, frame, sf).collect())


def test_pipeline_takes_odd_rows(spark):
    rows = [(None, "a few plain words here and there that say nothing at all today", None, None, None), (None, None, None, None, None), (7, "", "en", "s", 0), (8, "the same text for two rows of this table stands here", "en", "s", 1), (8, "the same text for two rows of this table stands here", "en", "s", 1)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    for frame in (docs, docs.limit(0)):
        for name, stage in corpus_pipeline.STAGES:
            out = stage(spark, frame, SMALL).collect()
            assert len({(r["doc_id"], r["doc_tokens"]) for r in out} if name == "packing" else out) <= len(rows)
    assert corpus_pipeline.near_duplicates(spark, docs, SMALL).count() == 4


def test_pipeline_near_duplicates_go_by_row(spark):
    say = lambda x: " ".join(f"{x}{i}" for i in range(40))
    rows = [(3, "A"), (7, "A"), (7, "B"), (9, "B"), (7, "C"), (5, "D"), (5, "D2"), (5, "D"), (None, "E"), (None, "E"), (2, "F"), (None, "F"), (1, None), (1, "")]
    texts = {x: say(x) for x in "ABCDEF"} | {"D2": say("D") + " more", None: None, "": ""}
    odd = [(1, None, None, "s", 1), (1, None, "s", None, 1)]  # the same but for the place of the null
    docs = spark.createDataFrame([(i, texts[x], "en", "s", 1) for i, x in rows] + odd, "doc_id long, text string, lang string, source string, n_chars long")
    got = corpus_pipeline.near_duplicates(spark, docs, SMALL).collect()
    assert sorted((r["doc_id"], r["text"][:1]) for r in got if r["text"] and r["doc_id"] is not None) == [(2, "F"), (3, "A"), (5, "D"), (7, "B"), (7, "C")]
    assert [r["text"][:1] for r in got if r["doc_id"] is None] == ["E"] and sum(not r["text"] for r in got) == 4


def test_benchmark_items_without_id(spark, tmp_path):
    say = lambda x, n=30: " ".join(f"{x}{i}" for i in range(n))
    rows = [(1, say("a", 60), "en", "s", 1), (2, "so " + say("b") + " then", "en", "s", 1), (3, "so " + say("c") + " then", "en", "s", 1)]
    spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long").write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame([(5, say("b")), (None, say("c")), (None, None)], "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    got = queries.op6_benchmark_decontamination(spark, str(tmp_path)).collect()
    assert sorted((r["doc_id"], r["item_id"], r["coverage"]) for r in got) == [(2, 5, 1.0), (3, None, 1.0)]
    left = corpus_pipeline.benchmark_leaks(spark, spark.read.parquet(f"{tmp_path}/documents.parquet"), str(tmp_path)).collect()
    assert [r["doc_id"] for r in left] == [1]


@pytest.mark.parametrize("name", sorted(queries.QUERIES))
def test_plans_have_no_products_and_no_row_udfs(spark, name):
    spark.catalog.clearCache()
    plan = queries.QUERIES[name](spark, SMALL)._jdf.queryExecution().executedPlan().toString()
    assert not re.search(r"CartesianProduct|BroadcastNestedLoopJoin|BatchEvalPython", plan)
