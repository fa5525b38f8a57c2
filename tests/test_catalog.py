"""Every registered query on Spark against its SQL text on DuckDB, over whole tables."""

import re
from pathlib import Path

import pytest

import __spark_entry__ as entry
from lakeweave.catalog import CATALOG
from lakeweave.catalog.registry import Query

from .oracle import connect, differences

ROOT = "/root/testdata/sf0.001"
UNWANTED = re.compile(r"CartesianProduct|BroadcastNestedLoopJoin|EvalPython|InPandas|InArrow")
pytestmark = pytest.mark.skipif(not Path(ROOT).exists(), reason="test tables are not mounted")


@pytest.fixture(scope="module")
def duck():
    return connect(ROOT)


@pytest.mark.parametrize("name", sorted(CATALOG))
def test_query(spark, duck, name):
    """Results equal the SQL text; the plan holds no pair product and no Python."""
    frames = []

    def run(session, root):
        frames.append(CATALOG[name].run(session, root))
        return frames[0]

    problem, _, _ = differences(spark, duck, ROOT, Query(run, CATALOG[name].sql))
    assert problem is None
    assert not UNWANTED.search(frames[0]._jdf.queryExecution().executedPlan().toString())


def test_entry_contract(spark):
    assert set(entry.oracle_sql()) <= set(entry.queries())
    assert entry.entry(spark).columns
