"""Tables, registry, feeds and pages."""

import json

import pytest
from pyspark.sql import functions as F

from plait.sources import feeds, pages, registry, tables

RSS = b"""<?xml version="1.0"?><rss xmlns:media="http://search.yahoo.com/mrss/"><channel><title>Feed</title>
<item><title>One &amp; only</title><link>https://a.example/1?utm_source=x</link><description>Text</description><pubDate>Fri, 02 Jan 2026 03:04:05 GMT</pubDate><media:content url="https://a.example/i.jpg"/></item>
<item><title>Tom & Ann\x01</title><link>https://a.example/2</link><enclosure url="https://a.example/j.png" type="image/png"/></item><item><title>No link</title></item></channel></rss>"""
ATOM = b"""<feed xmlns="http://www.w3.org/2005/Atom"><entry><title>A</title><link href="https://b.example/1" rel="alternate"/><updated>2026-01-02T03:04:05Z</updated><author><name>Ann</name></author></entry></feed>"""


def transport(url: str) -> bytes:
    if "broken" in url:
        raise OSError("no route")
    return ATOM if "atom" in url else b"<rss/>" if "empty" in url else RSS


def test_parse_items():
    items = feeds.parse_items(RSS)
    assert [i["title"] for i in items] == ["One & only", "Tom & Ann", "No link"] and items[0]["media_content"] == ["https://a.example/i.jpg"]
    assert feeds.parse_items(ATOM)[0]["link"] == "https://b.example/1"


def test_alternates():
    used, items, error = feeds.read_feed("https://broken.example", ["https://empty.example", "https://atom.example"], transport)
    assert used == "https://atom.example" and len(items) == 1 and error is None
    assert feeds.read_feed("https://broken.example", [], transport)[2]


def test_feed_source_to_entries(spark):
    from plait.operators.ingest import entries

    spark.dataSource.register(feeds.FeedSource)
    listed = json.dumps([{"source_id": "a", "url": "https://a.example/feed"}, {"source_id": "b", "url": "https://broken.example", "alternates": ["https://atom.example"]}, {"source_id": "c", "url": "https://broken.example"}])
    df = spark.read.format("plait_feed").option("feeds", listed).option("transport", "tests.test_sources:transport").load()
    assert df.where("error is not null").count() == 1
    got = {r["link"]: r for r in entries(df.where("error is null")).collect()}
    assert set(got) == {"https://a.example/1?utm_source=x", "https://a.example/2", "https://b.example/1"}
    assert str(got["https://a.example/1?utm_source=x"]["published_at"]) == "2026-01-02 03:04:05" and got["https://a.example/2"]["image_url"] == "https://a.example/j.png"
    assert got["https://b.example/1"]["author"] == "Ann"


PAGE = """<html><head><title>Vote passes - Site</title><meta property="og:image" content="https://a.example/i.jpg"><meta property="article:published_time" content="2026-01-02T05:00:00+02:00">
<script type="application/ld+json">{"@graph": [{"@type": ["NewsArticle"], "headline": "Vote passes", "author": [{"name": "Ann Lee"}, "Bo"], "datePublished": "2026-01-02T03:04:05Z", "articleSection": "Politics", "image": [{"url": "https://a.example/ld.jpg"}]}]}</script>
<script type="application/ld+json">{broken</script></head><body><nav><p>Menu text that is long enough to count as a paragraph here.</p></nav><article><h1>Vote passes</h1>
<p>PARIS (AP) — The vote passed after a long night of talks in the capital.</p><p>Members of both groups said that they were content with the outcome of the vote.</p><p>short</p></article></body></html>"""


def extracted(spark, *html):
    rows = spark.createDataFrame(list(enumerate(html)), "id int, html string")
    return [r for r in sorted(pages.extract_pages(rows, "id").collect(), key=lambda r: r["id"])]


def test_page(spark):
    got = extracted(spark, PAGE)[0]
    assert (got["title"], got["section"], got["authors"], got["image"], got["jsonld_type"]) == ("Vote passes", "Politics", ["Ann Lee", "Bo"], "https://a.example/ld.jpg", "NewsArticle")
    assert got["text"].count("\n\n") == 1 and "Menu" not in got["text"]


def test_pages_frame(spark):
    rows = spark.createDataFrame([(1, PAGE), (2, None), (3, "<p>" + "x" * 60)], "id long, html string")
    got = {r["id"]: r for r in pages.extract_pages(rows, "id").collect()}
    assert str(got[1]["published_at"]) == "2026-01-02 03:04:05" and got[1]["wire_hint"] and got[2]["text"] == "" and not got[3]["wire_hint"]


LONG = "Words of the report that go on, and on, for quite a while without an end. " * 3


def test_text_in_three_attempts(spark):
    """Precisely from the weightiest element; all of it if that is short; the paragraphs of a holder if even that is."""
    links = "<ul>" + "<li><a href=x>Another page of this site</a></li>" * 5 + "</ul>"
    page = f"<body><nav><p>{LONG}</p></nav><div><h1>T</h1><p>{LONG}</p><h2>Part</h2><p>{LONG}</p><ul><li>A point</li></ul>{links}</div><div><p>Other text, short.</p></div><footer><p>{LONG}</p></footer></body>"
    one = LONG.strip()
    short = "<body><div><p>Just a line.</p></div><ul><li>First point</li><li>Second point</li></ul><div>Loose text</div></body>"
    holder = "<body><main>" + "".join(f"<p>{'x' * 45} {n}</p>" for n in range(3)) + "</main></body>"
    got = extracted(spark, page, short, holder, "<p>" + "y" * 50 + "<div>z", "<table><tr><td>cell</table>")
    assert got[0]["text"] == f"{one}\n\nPart\n\n{one}\n\nA point" and got[1]["text"] == "Just a line.\n\nFirst point\n\nSecond point\n\nLoose text"
    assert got[2]["text"] == "\n\n".join(f"{'x' * 45} {n}" for n in range(3)) and got[3]["text"] == "y" * 50 and got[4]["text"] == ""


def test_paragraphs_of_holders():
    p = lambda n, c="x": f"<p>{c * n}</p>"
    first = pages.Page(f"<main>{p(900)}{p(900)}</main><article>{p(4000)}</article>").paragraphs()
    assert first == "x" * 900 + "\n\n" + "x" * 900  # enough is known at the first holder
    assert pages.Page(f"<main>{p(500)}</main><article>{p(700, 'y')}{p(39)}</article>").paragraphs() == "y" * 700
    assert pages.Page(f'<div class="x post-content">{p(41)}</div>{p(800, "z")}').paragraphs() == "x" * 41


def test_pages_of_many_elements():
    """Time follows the page's size, whatever is nested or left open."""
    import time

    began = time.perf_counter()
    n = 20_000
    for page in ("<article><p>" + "w" * 50 + "</p></article>", "<article>", "<div><p>text of a line", "<ul><li>point of a list", "</div></p>", "<p>a b c d e f g h i j"):
        pages.Page(page * n).text()
    pages.Page("<main>" * 300 + ("<p>" + "w" * 60 + "</p>") * 300).text()
    assert time.perf_counter() - began < 20


def test_fields_by_rank(spark):
    """Structured data before meta tags; the last object first, up to the first with a date; meta tags in their order."""
    data = lambda x: f'<script type="application/ld+json">{json.dumps(x)}</script>'
    item = lambda **more: {"@type": "NewsArticle"} | more
    two = data([item(headline="Never read", datePublished="2026-01-01T00:00:00Z"), {"@type": "Person", "headline": "no"}, item(headline="Second", author="Cy", datePublished="2026-01-03T00:00:00Z", image={"url": "i2"}), item(headline=" First ", author=[{"name": " Ann "}, "Bo", {"x": 1}], datePublished="bad")])
    metas = '<meta name="author" content="Dee, Ed and Flo"><meta name="description" content="later"><meta property="og:description" content=" sooner "><meta property="og:title" content="OG"><meta name="date" content="2026-01-05"><meta property="og:published_time" content="2026-01-06T01:00:00+01:00"><meta name="parsely-section" content="S">'
    got = extracted(spark, two + metas, metas + "<title> T &amp; x </title>", '<title>Only</title><meta name="author" content="https://x.example/a"><p>Only the text', data({"@graph": [item(image=["i1", "i2"], articleSection="News")]}) + data("[") + metas, None)
    assert (got[0]["title"], got[0]["authors"], got[0]["image"], str(got[0]["published_at"]), got[0]["description"], got[0]["section"]) == ("First", ["Ann", "Bo", "Cy"], "i2", "2026-01-03 00:00:00", "sooner", "S")
    assert (got[1]["title"], got[1]["authors"], str(got[1]["published_at"]), got[1]["jsonld_type"]) == ("OG", ["Dee", "Ed", "Flo"], "2026-01-06 00:00:00", None)
    assert (got[2]["title"], got[2]["authors"], got[2]["text"]) == ("Only", [], "the text")
    assert (got[3]["image"], got[3]["section"], got[3]["jsonld_type"], got[3]["title"]) == ("i1", "News", "NewsArticle", "OG") and got[4]["title"] is None and got[4]["text"] == ""


def test_registry(spark):
    one = {"id": "a", "outlet": "A", "feed_url": "u", "leaning": "LEFT"}
    assert registry.parse_registry([one])[0]["max_per_run"] == 40
    with pytest.raises(ValueError):
        registry.parse_registry([one, one])
    with pytest.raises(ValueError):
        registry.parse_registry([one | {"leaning": "UP"}])


def test_tables(spark):
    have = spark.createDataFrame([(1, "a"), (2, "b")], "k int, v string")
    new = spark.createDataFrame([(2, "c"), (3, "d"), (3, "e")], "k int, v string")
    rows = lambda df: sorted(map(tuple, df.collect()))
    assert rows(tables.insert_ignore(have, new, "k", [F.col("v")])) == [(1, "a"), (2, "b"), (3, "d")]
    assert rows(tables.upsert(have, new, ["k"], [F.desc("v")])) == [(1, "a"), (2, "c"), (3, "e")]
    assert rows(tables.patch(have, spark.createDataFrame([(2, None)], "k int, v string"), "k", ["v"])) == [(1, "a"), (2, None)]


def test_scrub(spark):
    rows = spark.range(1).select(F.array(F.struct(F.concat(F.lit("a"), F.lit("\0")).alias("s"), F.lit(1).alias("n"))).alias("x"), F.create_map(F.concat(F.lit("k"), F.lit("\0")), F.lit("v")).alias("m"), F.lit(None).cast("string").alias("z"))
    got = tables.scrub_nul(rows).first()
    assert got["x"][0]["s"] == "a" and got["m"] == {"k": "v"} and got["z"] is None


def test_scan_filters(spark):
    from plait.functions.predicates import predicate, scan

    df = spark.range(1).select(F.explode(F.array(*[F.struct(F.lit(i).alias("n"), F.lit(s).cast("string").alias("s"), F.struct(F.lit(m).alias("method")).alias("a"), F.lit(i % 2 == 0).alias("b")) for i, s, m in ((1, "x", "orphan"), (2, None, "create"), (3, "y,z", "orphan"))])).alias("r")).select("r.*")
    ids = lambda **f: [r["n"] for r in scan(df, order="n.asc", **f).collect()]
    assert ids(s="is.null") == [2] and ids(s="not.is.null") == [1, 3] and ids(n="gte.2") == [2, 3] and ids(n="lt.2") == [1] and ids(s='in.(x,"y,z")') == [1, 3]
    assert ids(**{"a->>method": "eq.orphan"}, n="neq.1") == [3] and ids(b="is.true") == [2] and [r["n"] for r in scan(df, "n", "n.desc", 1, 1).collect()] == [2]
    with pytest.raises(ValueError):
        predicate(df, "n", "like.x")


def test_views(spark, tmp_path):
    spark.createDataFrame([(1,), (2,)], "k int").write.parquet(str(tmp_path / "t"))
    tables.register_views(spark, str(tmp_path), ["t"])
    assert spark.sql("SELECT sum(k) AS s FROM t GROUP BY ROLLUP(k) ORDER BY s DESC LIMIT 1").first()["s"] == 3


_AT_WORK, _MOST = {}, {}


def slow_page(url):
    import threading
    import time
    from urllib.parse import urlsplit

    host = urlsplit(url).netloc
    with _LOCK:
        _AT_WORK[host] = _AT_WORK.get(host, 0) + 1
        _MOST[host] = max(_MOST.get(host, 0), _AT_WORK[host])
    time.sleep(0.05)
    with _LOCK:
        _AT_WORK[host] -= 1
    if url.endswith("/7"):
        raise OSError("no " + "x" * 400)
    return url + "/final", f"page of {threading.current_thread().name} {_MOST[host]}".encode()


import threading  # noqa: E402

_LOCK = threading.Lock()


def test_pooled_calls_keep_order_and_their_limit():
    import time

    from plait.sources.pool import pooled

    _MOST.clear()
    began = time.perf_counter()
    found = list(pooled((f"https://a.example/{n}" for n in range(100)), slow_page, 8))
    assert time.perf_counter() - began < 1.5 and _MOST["a.example"] <= 8
    assert [x for x, _, _ in found] == [f"https://a.example/{n}" for n in range(100)]
    assert [n for n, (_, got, error) in enumerate(found) if error] == [7] and len(found[7][2]) == 300 and found[8][1][0] == "https://a.example/8/final"
    assert list(pooled([], slow_page, 8)) == []


def test_pages_are_fetched_side_by_side(spark):
    """A host is asked by one task, each link once, and a failure is one row."""
    links = spark.createDataFrame([(f"https://h{n % 3}.example/{n // 3}",) for n in range(60)] * 2 + [("not a link",)], "link string").repartition(4)
    got = {r["link"]: r for r in pages.fetch_pages(links, "tests.test_sources:slow_page", workers=4).collect()}
    assert len(got) == 61 and {x for x, r in got.items() if r["error"]} == {f"https://h{n}.example/7" for n in range(3)}
    assert max(int(r["html"].rsplit(" ", 1)[1]) for r in got.values() if r["html"]) <= 4


def test_end_tags_reach_any_open_element():
    """Of 70 elements left open in an article none keeps its end tag from closing it."""
    for n in (10, 70, 500):
        text = pages.Page(f"<body><article>{'<div>' * n}<p>{LONG}</p><p>{LONG}</p></article><p>{LONG} outside</p></body>").text()
        assert text == LONG.strip() + "\n\n" + LONG.strip()
        assert pages.Page(f"<body>{'</section>' * n}<p>{LONG}</p></body>").text() == LONG.strip()


def test_pages_are_numbered_without_the_driver(spark):
    """The pages of a keyset scan, from the plan alone: no row is gathered by it or made from Python values."""
    rows = spark.range(0, 3000, 3).select((F.col("id") * 7919 % 100_003).alias("key")).repartition(5)
    pages = tables.paged(rows, "key", 70)
    assert "LocalTableScan" not in pages._jdf.queryExecution().toString() and "ExistingRDD" not in pages._jdf.queryExecution().toString()
    assert sorted((r["key"], r["page"]) for r in pages.collect()) == [(k, i // 70) for i, k in enumerate(sorted(n * 7919 % 100_003 for n in range(0, 3000, 3)))]
    assert tables.paged(rows.where("key < 0"), "key", 70).count() == 0
