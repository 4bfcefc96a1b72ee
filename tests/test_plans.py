"""Plans of the registered queries: no product of tables, no row-at-a-time Python, columns pruned at the scan."""

import re

import pytest

from plait.plans import registry

SMALL = "/root/testdata/sf0.001"


def plan(spark, name: str) -> str:
    spark.catalog.clearCache()  # what other tests keep would stand in for scans
    return registry.QUERIES[name](spark, SMALL)._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", sorted(registry.QUERIES))
def test_no_products_and_no_row_udfs(spark, name):
    assert not re.search(r"CartesianProduct|BroadcastNestedLoopJoin|BatchEvalPython", plan(spark, name))


@pytest.mark.parametrize("name, table, columns", [("url_canonical", "pages", "page_id:bigint,url:string"), ("in_list_scan", "labels", "doc_id:bigint,toxic:int"), ("side_assign", "documents", "doc_id:bigint,source:string"), ("llm_usage", "events", "event_id:bigint,user_id:bigint,event_type:string")])
def test_columns_are_pruned(spark, name, table, columns):
    found = [m[1] for m in re.finditer(rf"{table}\.parquet.*?ReadSchema: struct<([^>]*)>", plan(spark, name), re.DOTALL)]
    assert columns in found


def test_filters_reach_the_scan(spark):
    assert re.search(r"PushedFilters: \[[^\]]*EqualTo\(toxic,1\)", plan(spark, "in_list_scan"))
