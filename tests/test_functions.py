"""Column functions on small frames with invented data."""

from datetime import date, datetime

import pytest
from pyspark.sql import functions as F

from plait.config import Config, from_environment, read_settings_file
from plait.functions import scoring as S, text as X, times as M, vectors as V
from plait.functions.urls import canonical_url


def one(spark, column, **values):
    df = spark.range(1).select(*[F.lit(v).alias(k) for k, v in values.items()]) if values else spark.range(1)
    return df.select(column.alias("x")).first()["x"]


@pytest.mark.parametrize("url, want", [
    ("http://www.Site.example/a//b/?utm_source=x&b=2&a=1#top", "https://site.example/a/b?a=1&b=2"),
    ("https://amp.site.example/story/amp/", "https://site.example/story"),
    ("https://site.example", "https://site.example/"),
    ("https://site.example:8080/x/?q=", "https://site.example:8080/x"),
    ("https://user@site.example/x?A=b+c&z=%7E*", "https://user@site.example/x?A=b+c&z=~%2A"),
    ("  https://site.example/x?ref=home&fbclid=1  ", "https://site.example/x"),
    ("https://site.example/x?a&b=&c==&=d", "https://site.example/x?=d&c=%3D"),
])
def test_canonical_url(spark, url, want):
    assert one(spark, canonical_url(F.col("u")), u=url) == want


def test_clean_text(spark):
    assert one(spark, X.clean_text(F.col("t")), t="&amp;#8216;A&amp;#8217;  and&nbsp;\n b ") == "‘A’ and b"
    assert one(spark, X.clean_text(F.col("t")), t=" \n ") is None


@pytest.mark.parametrize("title, want", [("9/18: Evening Show", True), ("9/18/26 : Morning", True), ("Full transcript of the talk", True), ("Transcription errors", False), ("Ratio 3:4 explained", False), (None, False)])
def test_non_article(spark, title, want):
    assert one(spark, X.is_non_article(F.col("t").cast("string")), t=title) is want


def test_xml_and_nul(spark):
    assert one(spark, X.sanitise_xml(F.col("t")), t="a\x01 & b &amp; c &#38; d &x e") == "a &amp; b &amp; c &#38; d &amp;x e"
    assert one(spark, X.strip_nul(F.concat(F.lit("a"), F.lit("\0"), F.lit("b")))) == "ab"


def test_snippet(spark):
    say = lambda text: one(spark, X.snippet(F.col("t").cast("string")), t=text)
    assert say("too short") is None and say(None) is None
    got = say("This is a sentence of some length. " * 30)
    assert 400 <= len(got) + 1 <= 520 and got.endswith(".")
    assert say("x" * 600) == "x" * 517 + "..."
    assert say("One\x1ctwo  three\u2003four. " * 3) == ("One two three four. " * 3).strip()
    assert say("A. " * 100 + "B" * 700).endswith("A.")


def test_placeholder_title(spark):
    say = lambda text: one(spark, X.placeholder_title(F.col("t").cast("string")), t=text)
    assert say("Rep. Ann Lee and Sen. Bo Ray voted on the bill. Then they left.") == "Rep. Ann Lee and Sen. Bo Ray voted on the bill"
    long = say("word " * 60)
    assert len(long) <= 121 and long.endswith("…")
    assert say(None) == "" and say("Too early. Then this goes on for a while. End") == "Too early. Then this goes on for a while"
    assert say("The talks with J. Doe of the U.S. Army went on. 2 left") == "The talks with J. Doe of the U.S. Army went on" and say("z" * 130) == "z" * 120 + "…"


def test_near_duplicate(spark):
    rows = spark.createDataFrame([("a b c d e f g", None, "A b c d e f g!", None), ("one two", "x", "three four", "y"), ("", "s" * 100, None, "s" * 100)], "lt string, ls string, rt string, rs string")
    assert [r["x"] for r in rows.select(X.near_duplicate(*[F.col(c) for c in ("lt", "ls", "rt", "rs")]).alias("x")).collect()] == [True, False, True]


@pytest.mark.parametrize("text, want", [("2026-01-02T03:04:05Z", "2026-01-02 03:04:05"), ("2026-01-02T03:04:05+02:00", "2026-01-02 01:04:05"), ("Fri, 02 Jan 2026 03:04:05 GMT", "2026-01-02 03:04:05"), ("2 Jan 2026 03:04:05 +0100", "2026-01-02 02:04:05"), ("2026-01-02 03:04:05", "2026-01-02 03:04:05"), ("soon", None)])
def test_parse_datetime(spark, text, want):
    got = one(spark, M.parse_datetime(F.col("t")), t=text)
    assert (str(got) if got else None) == want


def test_valid_date(spark):
    assert one(spark, M.valid_date(F.col("t")), t="2026-02-28") == date(2026, 2, 28)
    assert one(spark, M.valid_date(F.col("t")), t="2026-02-30") is None
    assert one(spark, M.valid_date(F.col("t")), t="28 Feb 2026") is None


def test_guarded_date(spark):
    now = datetime(2026, 1, 31)
    rows = spark.createDataFrame([(datetime(2026, 1, 1), datetime(2026, 1, 30, 22)), (datetime(2026, 1, 1), datetime(2026, 1, 11)), (datetime(2026, 1, 30, 19), datetime(2026, 1, 30, 22)), (None, datetime(2026, 1, 30)), (None, None)], "p timestamp, f timestamp")
    published, source = M.guarded_date(F.col("p"), F.col("f"), F.lit(now), 72)
    assert [r["s"] for r in rows.select(source.alias("s"), published.alias("x")).collect()] == ["feed_override", "stale", "page", "feed", None]


def test_clamp_and_enums(spark):
    assert one(spark, S.clamp01(F.col("v")), v="2") == 1.0 and one(spark, S.clamp01(F.col("v")), v="-1") == 0.0
    assert one(spark, S.clamp01(F.col("v")), v="high") == 0.0 and one(spark, S.clamp01(F.col("v")), v="0.25") == 0.25
    assert one(spark, S.one_of(F.col("v"), S.DIRECTIONS, None), v="sideways") is None
    assert one(spark, S.one_of(F.col("v"), S.CATEGORIES, "other"), v="gossip") == "other"


def test_clean_entities(spark):
    names = F.array(*[F.lit(x) for x in ("Ann  Lee", "ann lee", " ", "Z", "The Daily Example", "Daily Example Poll", "Bo Ray")])
    assert one(spark, S.clean_entities(names, F.lit("Daily Example"))) == ["Ann Lee", "Bo Ray"]
    assert one(spark, S.clean_entities(F.lit(None).cast("array<string>"), F.lit(None).cast("string"))) == []


def test_side(spark):
    f = lambda a, b, c: one(spark, S.side_of(F.lit(a).cast("string"), F.lit(b).cast("double"), F.lit(c).cast("string")))
    assert f("LEFT", 0.6, "RIGHT") == "left" and f("LEFT", 0.59, "RIGHT") == "right" and f("CENTER", 1.0, "LEAN_LEFT") == "left" and f(None, None, None) is None


def test_verify_reason_boundaries(spark):
    def f(hours, a=None, s=None, first=datetime(2026, 1, 1)):
        rows = spark.createDataFrame([(datetime(2026, 1, 1 + hours // 24, hours % 24), a, first, s)], "p timestamp, a date, f timestamp, s date")
        return rows.select(S.verify_reason(F.col("p"), F.col("a"), F.col("f"), F.col("s")).alias("x")).first()["x"]

    assert f(12) is None and f(13) == "late" and f(72) == "late" and f(1, first=None) == "no_first_seen"
    assert f(1, date(2026, 1, 2), date(2026, 1, 1)) == "later_event_date" and f(1, date(2026, 1, 1), date(2026, 1, 1)) is None


@pytest.mark.parametrize("score, reason, want", [(0.95, None, "attach"), (0.95, "late", "verify"), (0.75, None, "verify"), (0.5, None, "create"), (None, None, "create"), (0.83, None, "attach")])
def test_zones(spark, score, reason, want):
    assert one(spark, S.zone(F.lit(score).cast("double"), F.lit(reason).cast("string"))) == want


@pytest.mark.parametrize("relation, sure, known, keep, want", [
    ("follow_up", 0.66, True, True, "kept"), ("follow_up", 0.70, True, True, None), ("unrelated", 0.4, False, True, "kept"), ("same_development", 0.3, True, True, "chosen"),
    ("same_development", 0.5, True, False, None), ("same_development", 0.8, True, False, "chosen"), ("same_development", 0.9, False, False, None),
])
def test_verified(spark, relation, sure, known, keep, want):
    assert one(spark, S.verified(F.lit(relation), F.lit(sure), F.lit(known), F.lit(keep))) == want


def test_framing(spark):
    axes, summary = S.fill_framing(F.array(F.lit(" ")), F.lit("have"), F.array(F.lit(" a  b ")), F.lit("new"))
    assert one(spark, axes) == ["a b"] and one(spark, summary) == "have"
    assert one(spark, S.needs_framing(F.lit(None).cast("array<string>"), F.lit("x"))) and one(spark, S.needs_framing(F.array(F.lit("x")), F.lit(" ")))
    assert not one(spark, S.needs_framing(F.array(F.lit("x")), F.lit("y")))


def test_wire(spark):
    none = F.lit(None).cast("array<string>")
    assert one(spark, S.wire_hint(F.lit("PARIS (AP) — Text"), none)) and one(spark, S.wire_hint(F.lit("x"), F.array(F.lit("By Reuters"))))
    assert not one(spark, S.wire_hint(F.lit("A plain text about Reuters staff."), none))
    assert not one(spark, S.wire_verdict(F.lit(True), F.lit("quotes several people"), F.lit(False)))
    assert one(spark, S.wire_verdict(F.lit(True), F.lit("dateline (AP)"), F.lit(False))) and one(spark, S.wire_verdict(F.lit(False), F.lit(None).cast("string"), F.lit(True)))


def test_centroid_follows_order(spark):
    c = V.follow(V.follow(None, 0, [3.0, 0.0]), 1, [0.0, 1.0])
    assert c.tolist() == pytest.approx([0.5**0.5, 0.5**0.5]) and V.follow(None, 0, [0.0, 0.0]).tolist() == [0.0, 0.0]
    assert one(spark, V.to_text(F.array(F.lit(0.5), F.lit(1.0)))) == "[0.5000000,1.0000000]"
    assert one(spark, V.from_text(F.lit("[0.5,1]"))) == [0.5, 1.0]


def test_config(tmp_path):
    path = tmp_path / "settings"
    path.write_text("# comment\nPLAIT_STALE_DAYS='7'\n\nPLAIT_ATTACH_THRESHOLD=0.5\n")
    got = from_environment(read_settings_file(str(path)))
    assert got.stale_days == 7 and got.attach_threshold == 0.5 and got.verify_threshold == Config().verify_threshold


def test_small_negative_numbers_keep_their_sign(spark):
    """As printf has it; zero that was rounded from below is a negative zero, in text and as a number."""
    df = spark.createDataFrame([([-1e-8, 1e-8, -0.0, 0.0, -2e-7, 0.00390625],)], "v array<double>")
    got = df.select(V.to_text(F.col("v")).alias("t"), F.transform("v", lambda x: V.signed(x, F.round(x, 6))).alias("r")).first()
    assert got["t"] == "[" + ",".join(f"{x:.7f}" for x in [-1e-8, 1e-8, -0.0, 0.0, -2e-7, 0.00390625]) + "]"
    assert [str(x) for x in got["r"]] == ["-0.0", "0.0", "-0.0", "0.0", "-0.0", "0.003906"]
