"""The whole run on fixtures, the command line and the stream."""

import re
from datetime import datetime

from pyspark.sql import functions as F

from plait import cli
from plait.config import Config
from plait.operators import models
from plait.plans import flow
from plait.sources import registry
from tests.test_operators import SCHEMA, article

NOW = datetime(2026, 1, 3)


def page(n):
    body = f"The council of town {n % 2} agreed on the new budget after a long debate that lasted until the morning. " * 5
    return f"<html><head><title>Budget agreed {n}</title></head><body><article><p>{body}</p><p>{body}</p></article></body></html>"


def run_once(spark, root):
    listed = registry.parse_registry([{"id": f"s{i}", "outlet": f"Outlet {i}", "feed_url": "u", "leaning": "LEFT" if i % 2 else "RIGHT", "verified": True} for i in range(4)])
    sources = spark.createDataFrame(listed, registry.SCHEMA)
    feed = spark.range(8).select(
        F.concat(F.lit("s"), F.col("id") % 4).alias("source_id"), F.col("id").cast("int").alias("pos"), F.concat(F.lit("https://o.example/"), F.col("id") % 6).alias("link"),
        F.array().cast("array<struct<href:string,type:string>>").alias("links"), F.concat(F.lit("Budget agreed "), "id").alias("title"), F.lit("sum").alias("summary"), F.lit("2026-01-02T12:00:00Z").alias("published"), F.lit(None).cast("string").alias("updated"),
        F.array().cast("array<string>").alias("media_content"), F.array().cast("array<string>").alias("media_thumbnail"), F.array().cast("array<struct<href:string,type:string>>").alias("enclosures"), F.lit("Ann").alias("author"),
    )
    pages = spark.createDataFrame([(f"https://o.example/{i}", f"https://o.example/{i}", page(i)) for i in range(6)], "link string, final_url string, html string")
    return flow.run(sources, feed, pages, root, F.lit(NOW))


def test_run(spark, tmp_path):
    out = run_once(spark, str(tmp_path / "a"))
    rows = out["articles"].collect()
    assert len(rows) == 6 and all(r["method"] == "create" and r["story_id"] for r in rows)
    assert out["stories"].count() == 6 and out["pairs"].count() == 0 and out["feed"].count() == 0


def feed_bytes(url):
    items = "".join(f"<item><title>Budget agreed {i}</title><link>https://{url.split('/')[2]}/{i}</link><pubDate>Fri, 02 Jan 2026 12:00:00 GMT</pubDate></item>" for i in range(3))
    return f"<rss><channel>{items}</channel></rss>".encode()


def page_bytes(url):
    if url.endswith("/2"):
        raise OSError("gone")
    return url + "?utm_source=feed", page(int(url[-1])).encode()


def test_cli_run(spark, tmp_path, capsys):
    (tmp_path / "sources.yaml").write_text("".join(f"- {{id: s{i}, outlet: O{i}, feed_url: 'https://o{i}.example/feed', leaning: LEFT, verified: true}}\n" for i in range(2)))
    common = ["--root", str(tmp_path / "t"), "--sources", str(tmp_path / "sources.yaml"), "--now", "2026-01-03T00:00:00+00:00", "--transport", "tests.test_flow:feed_bytes", "--page-transport", "tests.test_flow:page_bytes"]
    assert cli.main(["run", "--dry-run", *common], spark) == 0
    assert cli.main(["run", *common], spark) == 0
    assert '"articles": 4' in capsys.readouterr().out
    assert sorted(r["canonical_url"] for r in spark.read.parquet(str(tmp_path / "t" / "articles")).collect()) == [f"https://o{i}.example/{n}" for i in range(2) for n in range(2)]
    assert cli.main(["ingest", *common], spark) == 0
    assert cli.main(["status", "--root", str(tmp_path / "t")], spark) == 0
    said = capsys.readouterr().out
    assert "articles_done\t4" in said and "open_stories\t4" in said
    assert cli.main(["pairs", "--dry-run", *common], spark) == 0 and '"dry_run": true' in capsys.readouterr().out
    for command in ("fix-text", "trim", "refresh-feed"):
        assert cli.main([command, "--dry-run", *common], spark) == 0


def test_cli_status(spark, tmp_path, capsys):
    from tests.test_operators import T0

    spark.createDataFrame([("done", None, None), ("pending", "s", T0)], "enrichment_status string, story_id string, assigned_at timestamp").write.parquet(str(tmp_path / "articles"))
    spark.createDataFrame([("open", 1, 1)], "status string, left_count int, right_count int").write.parquet(str(tmp_path / "stories"))
    spark.createDataFrame([(True,)], "is_current boolean").write.parquet(str(tmp_path / "pairs"))
    assert cli.main(["status", "--root", str(tmp_path)], spark) == 0
    said = dict(line.split("\t") for line in capsys.readouterr().out.strip().splitlines())
    assert said == {"articles_total": "2", "articles_done": "1", "articles_pending": "1", "current_pairs": "1", "open_stories": "1", "two_sided": "1", "unassigned": "1"}


def test_stream_equals_batch(spark, tmp_path):
    from plait.operators.assign import assign_in_order
    from plait.streaming.online import assign_stream

    rows = [article(n, [1.0, 0.05 * n, 0.0] if n % 3 else [0.0, 0.0, 1.0], hours=n) for n in range(1, 9)]
    df = spark.createDataFrame([tuple(r[c.split()[0]] for c in SCHEMA.split(", ")) for r in rows], SCHEMA)
    for n in range(2):
        df.where(F.col("id") <= 4 if n == 0 else F.col("id") > 4).coalesce(1).write.mode("append").parquet(str(tmp_path / "in"))
    stream = assign_stream(spark.readStream.schema(df.schema).option("maxFilesPerTrigger", 1).parquet(str(tmp_path / "in")))
    query = stream.writeStream.format("memory").queryName("assigned").option("checkpointLocation", str(tmp_path / "cp")).trigger(availableNow=True).start()
    query.awaitTermination(120)
    got = {r["id"]: (r["method"], r["story_id"]) for r in spark.table("assigned").collect()}
    assert got == {r["id"]: (r["method"], r["story_id"]) for r in assign_in_order(df).collect()}


def test_stream_gives_up_old_blocks(spark, tmp_path):
    """A block without new articles loses its state by event time: the same article founds a story again."""
    from plait.streaming.online import assign_stream

    rows = [article(1, [1.0, 0.0], block="a"), article(2, [0.0, 1.0], block="b", hours=24 * 20), article(3, [0.0, 1.0], block="b", hours=24 * 40), article(4, [1.0, 0.0], block="a", hours=24 * 41)]
    df = spark.createDataFrame([tuple(r[c.split()[0]] for c in SCHEMA.split(", ")) for r in rows], SCHEMA)
    for n in range(1, 5):
        df.where(F.col("id") == n).coalesce(1).write.mode("append").parquet(str(tmp_path / "in"))
    stream = assign_stream(spark.readStream.schema(df.schema).option("maxFilesPerTrigger", 1).parquet(str(tmp_path / "in")), delay="1 hour")
    query = stream.writeStream.format("memory").queryName("aged").option("checkpointLocation", str(tmp_path / "cp")).trigger(availableNow=True).start()
    query.awaitTermination(120)
    sizes = [sum(s["numRowsTotal"] for s in p["stateOperators"]) for p in query.recentProgress]
    assert {r["id"]: r["method"] for r in spark.table("aged").collect()} == {n: "create" for n in range(1, 5)} and max(sizes) <= 2 and sizes[-1] <= 2 and min(sizes[1:]) <= 1


class TopicModel(models.OfflineModel):
    """Answers by the topic that a page names: "topic A", "topic A2" (nearly A), "opinion on topic B"."""

    def __init__(self):
        super().__init__(dims=4)
        self.calls = []

    def _log(self, kind):
        self.calls.append({"kind": kind, "model": "topics", "tokens_in": 10, "tokens_out": 2})

    def enrich(self, prompt):
        self._log("enrich")
        topic = re.search(r"topic (\w+)", prompt)[1]
        told = super().enrich(prompt)
        return told | {"event_summary": f"Development {topic} took place", "key_entities": [f"Actor {topic}"], "article_type": "opinion" if "opinion" in prompt else "news", "event_date": "2026-01-02"}

    def embed(self, texts):
        base = {"A": [1, 0, 0, 0], "A2": [0.95, 0.31, 0, 0], "B": [0, 0, 1, 0], "C": [0, 0, 0, 1]}
        return [{"index": i, "embedding": [float(x) for x in base[re.search(r"Development (\w+)", t)[1]]]} for i, t in reversed(list(enumerate(texts)))]

    def verify(self, prompt):
        return {"candidate_id": re.search(r"\[(\w+)\]", prompt)[1], "relation": "follow_up", "confidence": 0.9, "reason": "later\tstep"}

    def merge(self, prompt):
        return {"same_development": "Story A" in prompt and "Outlet" in prompt, "confidence": 0.9, "reason": "same"}

    def title(self, prompt):
        return {"story_title": "Told: " + prompt.splitlines()[0].removeprefix("Development: "), "headline_contrast": "left and right"}


def topic_feed(spark, items, day=2, hour=12):
    """(source, link, title) items as feed rows and their pages."""
    feed = spark.createDataFrame([(s, n, link, title, f"2026-01-{day:02d}T{hour + n // 60:02d}:{n % 60:02d}:00Z") for n, (s, link, title) in enumerate(items)], "source_id string, pos int, link string, title string, published string").select(
        "source_id", "pos", "link", F.array().cast("array<struct<href:string,type:string>>").alias("links"), "title", F.lit("sum").alias("summary"), "published", F.lit(None).cast("string").alias("updated"),
        F.array().cast("array<string>").alias("media_content"), F.array().cast("array<string>").alias("media_thumbnail"), F.array().cast("array<struct<href:string,type:string>>").alias("enclosures"), F.lit("Ann").alias("author"),
    )
    body = lambda title: f"<html><head><title>{title}</title></head><body><article><p>{('Report on ' + title + ', with much to say about it. ') * 9}</p></article></body></html>"
    return feed, spark.createDataFrame([(link, link, body(title)) for _, link, title in items], "link string, final_url string, html string")


def topic_sources(spark):
    listed = registry.parse_registry([{"id": f"s{i}", "outlet": f"Outlet {i}", "feed_url": "u", "leaning": "LEFT" if i % 2 else "RIGHT", "verified": True} for i in range(4)])
    return spark.createDataFrame(listed, registry.SCHEMA)


def test_second_run_goes_on_from_the_first(spark, tmp_path):
    """New articles attach to the first run's stories, orphans are tried again, known links are passed over; then merges and rechecks by command."""
    u = "https://o.example/"
    sources, root = topic_sources(spark), str(tmp_path / "t")
    first = topic_feed(spark, [("s0", u + "a1", "topic A one"), ("s1", u + "a2", "topic A two"), ("s2", u + "b1", "opinion on topic B")])
    one = flow.run(sources, *first, root, F.lit(datetime(2026, 1, 2, 13)), make=TopicModel, titler=TopicModel)
    got = {r["canonical_url"][-2:]: r for r in one["articles"].collect()}
    assert [got[k]["method"] for k in ("a1", "a2", "b1")] == ["create", "threshold", "orphan"] and got["b1"]["reason"] == "opinion cannot create a story" and got["a2"]["candidates"][0]["id"] == got["a1"]["story_id"]
    assert got["a1"]["stance"]["framing_axes"] == ["coverage"]  # asked once more, since the first answer had none
    assert [(c["kind"], c["model"]) for c in got["a1"]["calls"]] == [("enrich", "topics")]
    pair = one["pairs"].first()
    story = one["stories"].first()
    assert one["pairs"].count() == 1 and pair["headline_contrast"] == "left and right" and story["title"] == "Told: Development A took place" and story["title_source"] == "llm" and story["summary"] == "Development A took place"
    assert one["feed"].count() == 1

    second = topic_feed(spark, [("s0", u + "a1", "topic A one"), ("s3", u + "a3", "topic A three"), ("s3", u + "b2", "topic B news"), ("s1", u + "c1", "topic A2 near")], hour=13)
    tables = {n: one[n] for n in ("articles", "stories", "pairs")}
    two = flow.run(sources, *second, root + "/run-1", F.lit(datetime(2026, 1, 2, 14, 30)), make=TopicModel, previous=tables, titler=TopicModel, config=Config(attach_threshold=0.99))
    now = {r["canonical_url"][-2:]: r for r in two["articles"].collect()}
    assert len(now) == 6 and [now[k]["method"] for k in ("a1", "a2", "a3", "b2", "b1", "c1")] == ["create", "threshold", "threshold", "create", "threshold", "create"]
    assert now["a3"]["story_id"] == got["a1"]["story_id"] and now["b1"]["story_id"] == now["b2"]["story_id"] and now["a1"]["assigned_at"] == got["a1"]["assigned_at"]
    stories = {r["story_id"]: r for r in two["stories"].collect()}
    assert stories[now["a1"]["story_id"]]["article_count"] == 3 and stories[now["a1"]["story_id"]]["title_source"] == "llm" and len(stories) == 3
    sources.drop(*registry.LOCAL).write.parquet(root + "/sources")

    common = ["--root", root, "--now", "2026-01-02T15:00:00+00:00", "--model", "tests.test_flow:TopicModel"]
    config = Config(attach_threshold=0.99, verify_threshold=0.9, merge_min_similarity=0.9, auto_attach_window_hours=0)
    assert cli.main(["merge", "--dry-run", *common], spark, config) == 0 and cli.main(["merge", *common], spark, config) == 0
    merged = {r["canonical_url"][-2:]: r["story_id"] for r in cli._read(spark, root, "articles").collect()}
    assert merged["c1"] == merged["a1"] and {r["status"] for r in cli._read(spark, root, "stories").collect()} == {"open", "merged"}

    report = str(tmp_path / "report")
    old = cli._read(spark, root, "articles").withColumn("rule", F.lit("older"))
    cli._write(old, root, "articles", False)
    assert cli.main(["recheck-stories", "--report", report, *common], spark, config) == 0
    told = spark.read.option("sep", "\t").option("header", True).csv(report)
    assert told.columns == ["story_id", "story_title_before", "story_anchor", "article_id", "outlet", "published_at", "headline", "relation", "confidence", "decision", "reason"]
    decisions = {(r["decision"], r["reason"]) for r in told.collect()}
    assert decisions == {("detached", "later step")} and told.count() >= 3
    final = {r["canonical_url"][-2:]: r for r in cli._read(spark, root, "articles").collect()}
    assert final["a3"]["split_from"] == merged["a1"] != final["a3"]["story_id"]  # filed anew, never back into the story it was split from
    anchored = {r["story_id"]: r for r in cli._read(spark, root, "stories").collect()}[merged["a1"]]
    assert anchored["article_count"] == sum(r["story_id"] == merged["a1"] for r in final.values())
    for command in ("assign", "pairs", "enrich", "status", "refresh-feed", "trim", "fix-text", "backfill-framing"):
        assert cli.main([command, *(["--dry-run"] if command != "assign" else []), *common], spark, config) == 0
    bare = cli._read(spark, root, "articles")
    spoilt = bare.withColumns({"stance": F.col("stance").withField("framing_axes", F.array().cast("array<string>")), "title": F.concat("title", F.lit(" &amp; more")), "enrichment_status": F.when(F.col("canonical_url").endswith("b2"), "pending").otherwise(F.col("enrichment_status"))})
    cli._write(spoilt, root, "articles", False)
    for command in ("fix-text", "backfill-framing", "enrich"):
        assert cli.main([command, *common], spark, config) == 0
    mended = {r["canonical_url"][-2:]: r for r in cli._read(spark, root, "articles").collect()}
    assert len(mended) == 6 and all(r["title"].endswith(" & more") and r["enrichment_status"] == "done" for r in mended.values())
    assert mended["a1"]["stance"]["framing_axes"] == ["coverage"] == mended["b2"]["stance"]["framing_axes"]


def command_feed(url):
    """Three feeds: one whose pages are whole, one whose pages have no body and which only an alternate URL gives, one that is down."""
    if "bad" in url or url.endswith("/moved"):
        raise OSError("down")
    host = url.split("/")[2]
    items = "".join(f"<item><title>Budget agreed {i}</title><link>https://{host}/{i}</link><pubDate>Fri, 02 Jan 2026 {10 + i}:00:00 GMT</pubDate></item>" for i in range(5))
    return f"<rss><channel>{items}</channel></rss>".encode()


def command_page(url):
    if url.endswith("/1"):
        raise OSError("gone away")
    n = int(url[-1])
    if "thin" in url:
        return url, b"<html><head><title>Thin</title></head><body><article><p>Short.</p></article></body></html>"
    return url + ("?utm_source=feed" if n == 0 else "/moved"), page(n).replace("<head>", '<head><meta property="og:image" content="https://x.example/i.jpg"><meta name="date" content="2026-01-02T09:00:00Z">').encode()


REGISTRY = """
- {id: good, outlet: Good Times, feed_url: 'https://good.example/feed', leaning: LEFT, verified: true}
- {id: thin, outlet: Thin Post, feed_url: 'https://thin.example/moved', alt_feed_urls: ['https://thin.example/feed'], leaning: RIGHT, verified: true}
- {id: bad, outlet: Bad News, feed_url: 'https://bad.example/feed', leaning: CENTER, verified: false}
"""


def commands(tmp_path, now="2026-01-03T00:00:00+00:00"):
    (tmp_path / "sources.yaml").write_text(REGISTRY)
    return ["--root", str(tmp_path / "t"), "--sources", str(tmp_path / "sources.yaml"), "--now", now, "--transport", "tests.test_flow:command_feed", "--page-transport", "tests.test_flow:command_page"]


def test_verify_feeds_samples_pages_and_keeps_failures(spark, tmp_path, capsys):
    out = tmp_path / "audit.md"
    assert cli.main(["verify-feeds", "--out", str(out), *commands(tmp_path)], spark) == 0
    lines = [line.split(" | ") for line in out.read_text().splitlines() if line.startswith("| ")]
    columns = [c.strip("| ") for c in lines[0]]
    rows = {r["source_id"]: r for r in (dict(zip(columns, (c.strip("| ") for c in line))) for line in lines[1:])}
    assert list(rows) == ["good", "thin", "bad"] and {k: r["status"] for k, r in rows.items()} == {"good": "ok", "thin": "NO_BODY", "bad": "FEED_FAIL"}
    good = rows["good"]
    assert (good["outlet"], good["leaning"], good["entries"], good["fresh"], good["per_day"]) == ("Good Times", "LEFT", "5", "5", "30.0")
    assert (good["body_ok"], good["image_ok"], good["date_ok"], good["wire"], good["redirected"]) == ("2/3", "2/3", "2/3", "0/3", "1/3") and int(good["median_chars"]) > 500 and good["error"] == "page: gone away"
    assert rows["thin"]["error"] == "WORKED VIA ALT URL https://thin.example/feed page: gone away" and rows["thin"]["body_ok"] == "0/3" and rows["thin"]["median_chars"] == "6"
    assert "down" in rows["bad"]["error"] and rows["bad"]["entries"] == "0" and "1 of 3 feeds pass." in out.read_text()
    capsys.readouterr()
    assert cli.main(["verify-feeds", "--source", "good times", *commands(tmp_path)], spark) == 0
    assert "1 of 1 feeds pass." in capsys.readouterr().out


def test_a_selection_leaves_the_registry_whole(spark, tmp_path, capsys):
    common = commands(tmp_path)
    assert cli.main(["run", "--source", "good", *common], spark) == 0
    sources = lambda: {r["id"]: (r["leaning"], r["enabled"]) for r in cli._read(spark, str(tmp_path / "t"), "sources").collect()}
    assert sources() == {"good": ("LEFT", True), "thin": ("RIGHT", True), "bad": ("CENTER", True)}
    first = {r["canonical_url"]: r for r in cli._read(spark, str(tmp_path / "t"), "articles").collect()}
    assert len(first) == 4 and {r["side"] for r in first.values()} == {"left"}
    waiting = cli._read(spark, str(tmp_path / "t"), "articles").withColumns({"story_id": F.lit(None).cast("string"), "assigned_at": F.lit(None).cast("timestamp"), "side": F.lit(None).cast("string")})
    cli._write(waiting, str(tmp_path / "t"), "articles", False)  # as if they had not been filed yet
    (tmp_path / "sources.yaml").write_text(REGISTRY.replace("id: bad", "id: new"))
    assert cli.main(["run", "--source", "thin", *common], spark) == 0
    assert sources() == {"good": ("LEFT", True), "thin": ("RIGHT", True), "new": ("CENTER", True), "bad": ("CENTER", False)}
    after = cli._read(spark, str(tmp_path / "t"), "articles").collect()
    assert len(after) == 8 and {r["side"] for r in after if r["source_id"] == "good"} == {"left"}  # by the leaning of a source that this run did not read
    assert cli.main(["ingest", "--source", "thin", *common], spark) == 0
    assert len(sources()) == 4 and cli._read(spark, str(tmp_path / "t"), "articles").count() == 8
    said = capsys.readouterr().out
    assert '"inserted": 0' in said and '"failed_pages": 1' in said


def test_a_run_trims_old_bodies(spark, tmp_path, monkeypatch):
    root = str(tmp_path / "t")
    assert cli.main(["run", *commands(tmp_path)], spark) == 0
    assert cli._read(spark, root, "articles").where("body_text is not null").count() == 8
    assert cli.main(["run", *commands(tmp_path, "2026-01-20T00:00:00+00:00")], spark) == 0
    assert cli._read(spark, root, "articles").where("body_text is not null").count() == 8
    from plait.operators import stories as S

    with monkeypatch.context() as broken:  # a failing trim must not block the feed
        broken.setattr(S, "trim_bodies", lambda *a: (_ for _ in ()).throw(OSError("no")))
        assert cli.main(["run", *commands(tmp_path, "2026-03-05T00:00:00+00:00")], spark) == 0
    assert cli._read(spark, root, "articles").where("body_text is not null").count() == 8
    assert cli.main(["run", *commands(tmp_path, "2026-03-05T00:00:00+00:00")], spark) == 0
    bare = cli._read(spark, root, "articles").collect()
    assert len(bare) == 8 and all(r["body_text"] is None and r["title"] for r in bare)


def test_an_unfinished_run_does_not_count(spark, tmp_path, monkeypatch):
    """Tables of a run are those of one moment: if it ends before its feed, the next one starts from the last whole run."""
    from plait.operators import stories as S

    root = str(tmp_path / "t")
    with monkeypatch.context() as broken:
        broken.setattr(S, "feed", lambda *a: (_ for _ in ()).throw(OSError("no")))
        try:
            cli.main(["run", "--source", "good", *commands(tmp_path)], spark)
        except OSError:
            pass
    assert cli.main(["run", "--source", "good", *commands(tmp_path)], spark) == 0
    before = sorted(map(str, cli._read(spark, root, "articles").select("id", "story_id").collect()))
    with monkeypatch.context() as broken:
        broken.setattr(S, "feed", lambda *a: (_ for _ in ()).throw(OSError("no")))
        try:
            cli.main(["run", "--source", "thin", *commands(tmp_path)], spark)
            raise AssertionError
        except OSError:
            pass
    assert sorted(map(str, cli._read(spark, root, "articles").select("id", "story_id").collect())) == before
