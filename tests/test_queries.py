"""Every registered query against its SQL counterpart, and what their plans may not hold."""

import pytest
from compare import connect, difference
from conftest import SMALL

import __spark_entry__ as contract
from tradewell import entries, oracles

QUERIES, SQL = entries.queries(), oracles.oracle_sql()


@pytest.fixture(scope="module")
def con():
    return connect(SMALL)


def test_every_query_has_sql():
    assert set(QUERIES) == set(SQL)


@pytest.mark.parametrize("name", QUERIES)
def test_matches_sql(spark, con, name):
    assert difference(QUERIES[name](spark, SMALL), SQL[name], con) is None


@pytest.mark.parametrize("name", [n for n in QUERIES if n[0] in "mr"])
def test_no_cross_join(spark, name):
    plan = QUERIES[name](spark, SMALL)._jdf.queryExecution().executedPlan().toString()
    assert "CartesianProduct" not in plan and "NestedLoopJoin" not in plan


def test_scan_is_pruned_and_pushed(spark):
    plan = QUERIES["s01_columnar_scan"](spark, SMALL)._jdf.queryExecution().executedPlan().toString()
    assert "LessThan(l_shipdate" in plan and "l_tax" not in plan


def test_entry(spark):
    assert contract.entry(spark).columns == ["CategoryName", "total_sales"]
