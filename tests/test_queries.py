"""Every registered query of the story engine against its SQL, and those without SQL against their invariants."""

import pytest

from plait.plans import registry
from tests.oracle import compare

SMALL = "/root/testdata/sf0.001"


@pytest.mark.parametrize("name", sorted(registry.SQL))
def test_query_equals_sql(spark, name):
    assert compare(spark, name, SMALL) == ""


def test_entry(spark):
    import __spark_entry__ as entry

    assert entry.entry(spark).count() > 0
    assert set(entry.oracle_sql()) <= set(entry.queries())


def test_online_assignment_is_independent_of_partitioning(spark):
    run = registry.QUERIES["assign_online"]
    one = sorted(map(tuple, run(spark, SMALL).drop("score").collect()), key=repr)
    spark.conf.set("spark.sql.shuffle.partitions", "2")
    try:
        assert sorted(map(tuple, run(spark, SMALL).drop("score").collect()), key=repr) == one
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", "4")
    assert {r[2] for r in one} == {"create", "threshold", "orphan"} or {"create", "orphan"} <= {r[2] for r in one}


def test_enrich_run(spark):
    rows = registry.QUERIES["enrich_run"](spark, SMALL).collect()
    assert rows and all(r["enrichment_status"] == "done" and r["dims"] == 64 and r["error"] is None for r in rows)
