"""Exact dedup, filter audit and collocations against brute force on small tables with every kind of odd row."""

import collections
import hashlib
import itertools
import re

import numpy as np
import pytest
from pyspark.sql import functions as F

from plait.llm import collocations as C, exact_dedup as X, filter_audit as A
from plait.llm.common import free_names, lookup, materialize, new_path

WORD = re.compile(r"[^\x20\x09-\x0D]+")
DOCS = "doc_id long, text string, lang string, keep_id long, words string, digest binary, good int, n long"


def lower(text):
    return re.sub("[A-Z]+", lambda m: m[0].lower(), text or "")


def frame(spark, rows, parts=3):
    return spark.createDataFrame([(i, t, lang, 1, "w", b"d", 1, 5) for i, t, lang in rows], DOCS).repartition(parts)


LONG = " ".join(f"w{i}" for i in range(200_000))
ROWS = [
    (1, "Ab c", "en"), (2, "aB C", "en"), (3, "ab  c", "en"), (4, None, "de"), (5, "", None), (5, "", "de"), (6, "É x", "fr"), (7, "é x", "fr"), (None, "ab c", "en"), (None, "lone", None), (None, "lone", ""),
    (8, "same", "en"), (8, "same", "en"), (8, "other", "en"), (9, LONG, "en"), (10, LONG.upper(), "en"), (11, LONG + " ", "en"), (12, "a" * 300 + " #", "xx"), (13, "UPPER " * 120, "xx"), (-3, "\x0b\n ", "de"), (14, " ".join(f"d{i}" for i in range(150)), "xx"),
    (15, " ".join(f"d{i}" for i in range(150)), "xx"), (None, " ".join(f"d{i}" for i in range(150)), "xx"),
]


def brute_dedup(rows):
    groups = collections.defaultdict(list)
    for i, t, _ in rows:
        groups[lower(t)].append(i)
    out = []
    for text, ids in groups.items():
        keep = max((i for i in ids if i is not None), default=None)
        first = ids.index(keep)
        out += [(i, keep, len(ids), n == first, hashlib.sha256(text.encode()).hexdigest()) for n, i in enumerate(ids)]
    return sorted(out, key=repr)


def test_dedup_equals_brute_force(spark):
    for parts in (1, 2, 5):
        docs = frame(spark, ROWS)
        index = X.index_for(docs, new_path(spark, "digests"))
        got = X.deduplicate(docs, index, parts=parts)
        assert got.columns == ["doc_id", "keep_id", "group_size", "kept", "text_sha256"]
        assert sorted(map(tuple, got.collect()), key=repr) == brute_dedup(ROWS)
        firsts = [r["digest"] for name in index._live() for r in index.first(name).collect()]
        assert len(firsts) == len(set(firsts)) == len({lower(t) for _, t, _ in ROWS})  # appended once, by the part that brought it
    assert X.deduplicate(frame(spark, []), X.index_for(frame(spark, []), new_path(spark, "digests"))).collect() == []


def test_dedup_of_an_id_column_with_a_result_name(spark):
    docs = frame(spark, ROWS).drop("keep_id").withColumnRenamed("doc_id", "keep_id")
    got = X.deduplicate(docs, X.index_for(docs, new_path(spark, "digests"), "keep_id"), id_col="keep_id")
    assert got.columns == ["keep_id", "keep_id_", "group_size", "kept", "text_sha256"] and sorted(map(tuple, got.collect()), key=repr) == brute_dedup(ROWS)


def test_index_outlives_the_batch(spark):
    folder = new_path(spark, "digests")
    first, second = frame(spark, [(1, "one", ""), (2, "Two", ""), (3, "two", "")]), frame(spark, [(9, "ONE", ""), (10, "three", ""), (11, "three", ""), (12, None, "")])
    X.deduplicate(first, X.index_for(first, folder), "monday").collect()
    again = X.DigestIndex(spark, folder)  # another session would open it so
    got = {r["doc_id"]: (r["keep_id"], r["group_size"], r["kept"]) for r in X.deduplicate(second, again, "tuesday").collect()}
    assert got == {9: (1, 2, False), 10: (11, 2, False), 11: (11, 2, True), 12: (12, 1, True)}
    before = sorted(map(tuple, again.entries().collect()))
    X.deduplicate(second, X.DigestIndex(spark, folder), "tuesday").collect()
    assert sorted(map(tuple, X.DigestIndex(spark, folder).entries().collect())) == before  # a batch counts once
    again.compact()
    merged = X.DigestIndex(spark, folder)
    assert len(merged._live()) == 1 and sorted(map(tuple, merged.entries().collect())) == before and merged.batches() == again.batches()
    merged.add(X.digests(frame(spark, [(99, "one", ""), (98, "four", "")])), "friday")
    assert {r["keep_id"]: r["copies"] for r in merged.entries().collect()} == {1: 3, 3: 2, 11: 2, 12: 1, 98: 1}


def test_a_failed_batch_leaves_nothing(spark):

    index = X.DigestIndex(spark, new_path(spark, "digests"))
    rows = X.digests(frame(spark, [(1, "one", "")]))
    with pytest.raises(Exception, match="lost"):
        index.add(rows.withColumn("n", F.raise_error(F.lit("lost")).cast("long")), "a")
    assert index.batches() == set()
    index.add(rows, "a")
    assert index.batches() == {"a"} and index.entries().count() == 1


def test_index_joins_without_exchange(spark):
    """Segments meet bucket by bucket: sort-merge joins, no exchange of the index and none of the batch once it is written."""
    index = X.DigestIndex(spark, new_path(spark, "digests"), buckets=4)
    index.add(X.digests(frame(spark, [(i, f"t{i}", "") for i in range(50)])), "a")
    index.add(X.digests(frame(spark, [(i, f"t{i}", "") for i in range(40, 90)])), "b")
    one, two = (index.first(name) for name in index._live())
    spark.conf.set(X._ORDERED, "true")
    try:
        plan = two.join(one.select("digest").hint("merge"), "digest", "left_anti")._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.set(X._ORDERED, "false")
    assert "SortMergeJoin" in plan and "Exchange" not in plan and " Sort " not in plan and two.count() == 40


def test_lookup_spreads_heavy_keys(spark):
    rows = materialize(spark.range(4000).selectExpr("id", "if(id < 3000, 'hot', cast(id % 500 as string)) AS k"), "rows")
    table = spark.createDataFrame([("hot", 1), *((str(i), i) for i in range(400))], "k string, v long")
    assert sorted(map(tuple, lookup(rows, table, ["k"]).select("id", "v").collect())) == sorted(map(tuple, rows.join(table, "k").select("id", "v").collect()))


def test_free_names():
    assert free_names(["a", "B", "a"], ["A", "a_"]) == ["a__", "B", "a___"]


def brute_audit(rows, labels):
    seen = collections.defaultdict(list)
    for i, t, _ in rows:
        if i is not None:
            seen[t or ""].append(i)
    docs = []
    for i, t, part in rows:
        text = t or ""
        w = WORD.findall(text)
        fails = "".join(x for x, bad in (
            ("A", len(w) < 100), ("B", 100 * len(set(w)) < 80 * len(w)), ("C", 100 * sum("A" <= c <= "Z" for c in text) > 10 * len(text)), ("D", any(c in "#$%&*|" for c in text)),
            ("E", i is not None and min(seen[text]) < i),
        ) if bad)
        mine = [x for x in labels if i is not None and x[0] == i]
        docs.append((part or "", fails, any(x[1] == 1 for x in mine), any(x[2] == 1 for x in mine)))
    out = {}
    for part in {d[0] for d in docs}:
        here = [d for d in docs if d[0] == part]
        for order in map("".join, itertools.permutations("ABCDE")):
            for step, x in enumerate(order, 1):
                gone = lambda d: any(y in d[1] for y in order[: step - 1])  # noqa: E731, B023
                cut = [d for d in here if x in d[1] and not gone(d)]
                out[part, order, step] = [
                    sum(x not in d[1] and not gone(d) for d in here), len(cut), sum(x in d[1] and gone(d) for d in here), sum(d[1] == x for d in here), sum(d[2] for d in cut), sum(d[3] for d in cut)]
        for x in "ABCDE":
            cells = [k for k in out if k[0] == part and k[1][k[2] - 1] == x]
            total = sum(out[k][1] for k in cells)
            for k in cells:
                out[k].append(total)
    return out


def test_audit_equals_brute_force(spark):
    labels = [(1, 1, 0), (8, 0, 1), (8, 1, 0), (13, 1, 1), (None, 1, 1), (15, None, 1), (14, 1, None), (999, 1, 1)]
    table = spark.createDataFrame([(*x, "mask") for x in labels], "doc_id long, quality int, toxic int, part string")
    got = A.audit(frame(spark, ROWS), table).collect()
    want = brute_audit(ROWS, labels)
    assert len(got) == len(want) == 600 * 5
    assert {(r[0], r[1], r[2]): list(r[3:]) for r in got} == want
    assert A.audit(frame(spark, []), table).collect() == []
    bare = A.audit(frame(spark, ROWS), table.where("false")).collect()
    assert len(bare) == len(want) and all(r["good_lost"] == r["toxic_lost"] == 0 for r in bare)


def test_audit_matrices_are_of_the_stated_shape():
    columns, matrices = A.outcome_matrices("ABCDE")
    assert set(matrices) == set(A.OUTCOMES) and all(m.shape == (32, 600) and m.dtype == np.int64 for m in matrices.values()) and len(set(columns)) == 600
    reached = matrices["kept"] + matrices["removed"]
    assert (reached[0] == 1).all() and (reached + matrices["redundant"] <= 1).all() and (matrices["removed"].reshape(32, 120, 5).sum(axis=2)[1:] == 1).all()


def brute_collocations(rows, least=10, top=2000):
    count, total = collections.Counter(), collections.Counter()
    for _, t, lang in rows:
        lang = "und" if lang is None else lang
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", lower(t)):
            w = re.findall(r"[^\x20\x09]+", piece)
            total[lang] += len(w)
            for k in (1, 2, 3):
                count.update((lang, tuple(w[i : i + k])) for i in range(len(w) - k + 1))
    out = collections.defaultdict(list)
    for (lang, p), a in count.items():
        if len(p) < 2 or a < least:
            continue
        if any(len(q) > len(p) and q[0] and l2 == lang and 100 * b >= 50 * a and b >= least and any(q[i : i + len(p)] == p for i in range(len(q) - len(p) + 1)) for (l2, q), b in count.items() if len(q) == 3):
            continue
        cuts = [(10**6 * a * a // (count[lang, p[:k]] * count[lang, p[k:]]), k) for k in range(1, len(p))]
        score, k = min(cuts)
        out[lang].append((score, a, " ".join(p), count[lang, p[:k]], count[lang, p[k:]]))
    found = []
    for lang, phrases in out.items():
        phrases.sort(key=lambda x: (-x[0], -x[1], x[2].encode()))
        found += [(lang, i, p, a, left, right, total[lang], score) for i, (score, a, p, left, right) in enumerate(phrases[:top], 1)]
    return sorted(found)


def test_collocations_equal_brute_force(spark):
    rng = np.random.default_rng(5)
    vocabulary = ["New", "york", "city", "über", "a#b", "日本", " x", "the", "of", "q"]
    rows = []
    for i in range(120):
        words = list(rng.choice(vocabulary, int(rng.integers(0, 30)), p=[0.2, 0.2, 0.2, 0.05, 0.05, 0.05, 0.05, 0.1, 0.05, 0.05]))
        seps = rng.choice([" ", "  ", "\t", ", ", ".", "\n", "\x0b", " ;", "-"], len(words))
        rows.append((i, "".join(w + s for w, s in zip(words, seps)), ["en", "de", None, "und", ""][i % 5]))
    rows += [(200, None, "en"), (201, "", None), (202, "...", "en"), (203, "new york city " * 4000, "fr"), (203, "new york city " * 4000, "fr"), (None, "tie one, tie two, " * 12, "fr"), (204, "x" * 40_000 + " y", "de")]
    got = C.collocations(frame(spark, rows))
    assert got.columns == ["lang", "rank", "phrase", "a", "l", "r", "n", "score"] and {t for _, t in got.dtypes} == {"string", "bigint"}
    assert sorted(map(tuple, got.collect())) == brute_collocations(rows)
    few = C.collocations(frame(spark, rows), top=3)
    assert sorted(map(tuple, few.collect())) == brute_collocations(rows, top=3)
    assert C.collocations(frame(spark, [])).collect() == [] and C.collocations(frame(spark, [(1, "rare words", "en")])).collect() == []


def test_only_runs_of_frequent_runs_are_counted(spark):
    """Of 2,000 pairs with a rare word none is counted, unless their bits agree by chance."""
    rows = [(i, f"good day, good rare{i}, day rare{i}", "en") for i in range(1000)]
    texts = C._texts(frame(spark, rows), "text", "lang")
    words = materialize(C.count_level(texts, 1).where("n >= 10"), "words")
    bits = C.bit_table(words)
    assert len(bits) * 8 == C.LEAST_BITS and int(np.unpackbits(bits).sum()) == 2
    pairs = C.count_level(texts, 2, spark.sparkContext.broadcast(bits.tobytes())).collect()
    assert {r["phrase"]: r["n"] for r in pairs}["good day"] == 1000 and len(pairs) <= 3
    full = C.count_level(texts, 2, spark.sparkContext.broadcast(np.full(64, 255, np.uint8).tobytes())).collect()
    assert len(full) == 2001


def test_scores_are_exact_beyond_64_bits(spark):
    big = 999_999_999_999_989
    words = spark.createDataFrame([("en", "a", big), ("en", "b", big - 2)], "lang string, phrase string, n long")
    pairs = spark.createDataFrame([("en", "a b", big - 4)], "lang string, phrase string, n long")
    tables = [materialize(words, "w"), materialize(pairs, "p")]
    row = C.scored(tables, 2).collect()[0]
    assert row["score"] == 10**6 * (big - 4) ** 2 // (big * (big - 2)) == 999_999


def test_id_columns_of_any_name(spark):
    """An id column with a name of the operator's own results keeps it; the result gets an underscore."""
    from plait.llm import compression_bands as B, decontamination as D, jaccard_join as J, language_id as L, packing as P, repeated_phrases as R, rule_ensemble as Q, sharding as H, text_density as T
    from plait.llm.queries import tokenizer_path

    text = " ".join(f"word{i}" for i in range(80))
    rows = spark.createDataFrame([(1, text, "en", 1), (2, text, "en", 0), (3, "other words here", "de", 1)], "i long, text string, lang string, quality int")
    model = L.fit(rows, id_col="i")
    labels = rows.select("i", "quality")
    rules = Q.fit(rows, labels, id_col="i")
    bench = spark.createDataFrame([(7, " ".join(f"word{i}" for i in range(30)))], "item_id long, text string")
    calls = {
        "component_id": lambda d, c: J.jaccard_components(d, id_col=c), "score": lambda d, c: L.predict(d, model, id_col=c), "kept": lambda d, c: R.dedup_phrases(d, id_col=c), "item_id": lambda d, c: D.contaminated(d, bench, id_col=c),
        "offset": lambda d, c: P.pack(d, tokenizer_path(), id_col=c), "size": lambda d, c: H.shuffle_shards(d, id_col=c), "words": lambda d, c: Q.score(d, rules, (c,)), "predicted": lambda d, c: Q.score(d, rules, (c,)), "n_words": lambda d, c: B.compression_bands(d, id_col=c),
    }
    for name, call in calls.items():
        plain, named = call(rows.select("i", "text"), "i"), call(rows.select(rows["i"].alias(name), "text"), name)
        assert len({c.lower() for c in named.columns}) == len(named.columns) and named.columns[0] == name, name
        assert sorted(map(tuple, named.collect()), key=repr) == sorted(map(tuple, plain.select("i", *[c for c in plain.columns if c != "i"]).collect()), key=repr), name
    pages = spark.createDataFrame([(1, "<p>Some text</p>")], "text long, html string")
    assert T.extract_main_text(pages, carried=("text",)).first().asDict() == {"text": 1, "text_": "Some text"}


def test_op1_size_bands(spark):
    """Sets that may link lie in one band or in neighbours; of 50,000 strangers of mixed sizes under a tenth of all pairs of rows meet."""
    from plait.llm.jaccard_join import size_band

    band = {r["n"]: r["b"] for r in spark.range(1, 4001).select(F.col("id").alias("n"), size_band("id", 80).alias("b")).collect()}
    assert all(abs(band[a] - band[b]) <= 1 for a in range(1, 4001) for b in {a, a + 1, a * 100 // 80 - 1, a * 100 // 80} if a <= b <= 4000 and 100 * a >= 80 * b)
    sizes = np.exp(np.random.default_rng(1).uniform(np.log(5), np.log(20_000), 50_000)).astype(int)
    rows = spark.createDataFrame([(int(n),) for n in sizes], "n long").groupBy(size_band("n", 80).alias("b")).count().collect()
    count = {r["b"]: r["count"] for r in rows}
    assert sum(c * sum(count.get(b + d, 0) for d in (-1, 0, 1)) for b, c in count.items()) < 0.1 * 50_000**2


def test_op1_families_of_mixed_sizes(spark):
    """Families and strangers of very different sizes around frequent shingles, in blocks of a few rows."""
    from plait.llm import jaccard_join as J
    from tests.llm.test_operators import brute_components

    rng = np.random.default_rng(6)
    rows, common = [], [f"c{i}" for i in range(12)]
    for family in range(14):
        base = common + [f"f{family}x{i}" for i in range(int(rng.integers(0, 6)) * 9)]
        for _ in range(int(rng.integers(1, 9))):
            words = list(base)
            for at in rng.choice(len(words), int(rng.integers(0, 3)), replace=False):
                words[at] = f"e{rng.integers(0, 9)}"
            rows.append((len(rows), " ".join(words + [f"t{rng.integers(0, 3)}"] * int(rng.integers(0, 2)))))
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    for settings in (J.Settings(hot=3, block=4, members=1), J.Settings(hot=3, block=2, members=2), J.Settings()):
        assert sorted(map(tuple, J.jaccard_components(docs, settings=settings).collect()), key=repr) == brute_components(rows)
