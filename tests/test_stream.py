"""The stream whose state is one row a story."""

import pytest
from pyspark.sql import functions as F

from plait.operators.assign import assign_in_order
from plait.streaming.by_story import PROVIDER, assign_stream_by_story
from tests.test_operators import SCHEMA, article


@pytest.fixture
def rocks(spark):
    was = spark.conf.get(PROVIDER, None)
    yield spark
    if was is None:
        spark.conf.unset(PROVIDER)
    else:
        spark.conf.set(PROVIDER, was)


def streamed(spark, tmp_path, name, batches, **given):
    """The rows of a stream over batches of articles, and the progress of each."""
    schema = spark.createDataFrame([], SCHEMA).schema
    for rows in batches:
        spark.createDataFrame([tuple(r[c.split()[0]] for c in SCHEMA.split(", ")) for r in rows], SCHEMA).coalesce(1).write.mode("append").parquet(str(tmp_path / "in"))
    stream = assign_stream_by_story(spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).parquet(str(tmp_path / "in")), **given)
    query = stream.writeStream.format("memory").queryName(name).option("checkpointLocation", str(tmp_path / "cp")).trigger(availableNow=True).start()
    query.awaitTermination(240)
    assert query.exception() is None
    return spark.table(name).collect(), query.recentProgress


def test_stream_by_story_equals_batch(rocks, tmp_path):
    spark = rocks
    rows = [article(n, [1.0, 0.05 * n, 0.0] if n % 3 else [0.0, 0.0, 1.0], hours=n) for n in range(1, 13)]
    got, _ = streamed(spark, tmp_path, "by_story", [rows[:4], rows[4:5], rows[5:]])
    df = spark.createDataFrame([tuple(r[c.split()[0]] for c in SCHEMA.split(", ")) for r in rows], SCHEMA)
    assert {r["id"]: (r["method"], r["story_id"]) for r in got} == {r["id"]: (r["method"], r["story_id"]) for r in assign_in_order(df).collect()}


def test_an_orphan_is_filed_by_its_timer(rocks, tmp_path):
    """An opinion comes before the news that founds its story: once the watermark has passed its time, the timer attaches it; another one never finds a story and is dropped."""
    spark = rocks
    first = [article(1, [1.0, 0.0, 0.0], kind="opinion", hours=1), article(2, [0.0, 1.0, 0.0], kind="opinion", hours=1)]
    news = [article(3, [1.0, 0.0, 0.0], hours=1.5)]
    later = [[article(4 + n, [0.0, 0.0, 1.0], hours=h)] for n, h in enumerate((4, 8, 60, 100))]
    got, progress = streamed(spark, tmp_path, "timers", [first, news, *later], delay="10 minutes")
    told = {}
    for r in got:
        told.setdefault(r["id"], []).append((r["phase"], r["method"], r["story_id"]))
    story = told[3][0][2]
    assert told[1] == [(0, "orphan", None), (1, "threshold", story)] and told[3] == [(0, "create", story)] and told[2] == [(0, "orphan", None)]
    assert progress[-1]["stateOperators"][0]["numRowsTotal"] < 12


def test_writes_follow_the_stories_touched(rocks, tmp_path):
    """A block of 40 stories: a batch with one article writes a few rows, not the block."""
    spark = rocks
    axis = lambda n: [1.0 if i == n else 0.0 for i in range(41)]
    many = [article(n, axis(n), hours=1 + n / 100) for n in range(1, 41)]
    got, progress = streamed(spark, tmp_path, "touched", [many, [article(100, axis(3), hours=3)], [article(101, axis(4), hours=4)]])
    assert len(got) == 42
    written = [p["stateOperators"][0]["numRowsUpdated"] for p in progress if p["numInputRows"] == 1]
    assert len(written) == 2 and max(written) <= 8
