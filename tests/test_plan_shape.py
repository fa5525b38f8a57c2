"""Physical plans of headline queries: pruned scans, pushed filters, shuffle counts.

That no catalog query multiplies pairs or runs Python in its plan is checked with the results.
"""

import re
from pathlib import Path

import pytest

from lakeweave.catalog import CATALOG

ROOT = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not Path(ROOT).exists(), reason="test tables are not mounted")


def plan_of(spark, name):
    return CATALOG[name].run(spark, ROOT)._jdf.queryExecution().executedPlan().toString()


def scan_columns(plan, table):
    found = re.findall(rf"Location: [^\n]*{table}\.parquet[^\n]*ReadSchema: struct<([^>\n]*)", plan)
    return {column.split(":")[0] for columns in found for column in columns.split(",")}


def test_scans_are_pruned_and_filters_pushed(spark):
    spark.conf.set("spark.sql.maxMetadataStringLength", "10000")
    plan = CATALOG["row_predicates"].run(spark, ROOT)._jdf.queryExecution().executedPlan().toString()
    assert "GreaterThan(o_totalprice" in plan and "In(o_orderpriority" in plan
    assert scan_columns(plan_of(spark, "rollup_by_date"), "orders") == {"o_custkey", "o_totalprice", "o_orderdate"}
    assert scan_columns(plan_of(spark, "daily_sales_top_product"), "lineitem") == {
        "l_partkey", "l_suppkey", "l_extendedprice", "l_shipdate"}


@pytest.mark.parametrize("name,most", [("latest_by_key", 1), ("batch_customer_totals", 1), ("unique_with_count", 1),
                                       ("distinct_on_key", 1), ("quality_errors", 0), ("cdc_normalise", 0), ("nearest_centre", 0),
                                       ("expectation_counts", 1), ("column_profile", 2), ("upsert_merge", 3), ("session_window", 2)])
def test_shuffle_counts(spark, name, most):
    plan = plan_of(spark, name)
    assert len(re.findall(r"(?<!Broadcast)Exchange (hash|range|Single)", plan)) <= most


def test_error_lists_stay_in_generated_code(spark):
    plan = plan_of(spark, "quality_errors")
    assert "lambdafunction" not in plan and "*(1) Project" in plan
