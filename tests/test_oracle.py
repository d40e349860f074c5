"""Every registered query against its SQL."""

import os

import pytest

import __spark_entry__ as driver
from oracle import connect, differences

SF_DIR = os.environ.get("ORACLE_SF_DIR", "/root/testdata/sf0.001")
SINGLE_ROW_AGGREGATES = (
    "check_from_footers",
    "check_table",
    "column_report",
    "compare_columns",
    "gold_set_row_counts",
    "row_count_observed",
    "row_count_report",
)
CORE = [module for module in driver._MODULES if module not in driver._CORPUS]
QUERIES = {name: query for module in CORE for name, query in module.QUERIES.items()}
ORACLE = {name: sql for module in CORE for name, sql in module.ORACLE.items()}


@pytest.fixture(scope="module")
def duck():
    return connect(SF_DIR)


def test_every_query_has_sql():
    assert set(QUERIES) == set(ORACLE)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_matches_sql(spark, duck, name):
    result = QUERIES[name](spark, SF_DIR)
    plan = result._jdf.queryExecution().executedPlan().toString()
    for unwanted in ("Python", "CartesianProduct", "BroadcastNestedLoopJoin"):
        assert unwanted not in plan
    if name not in SINGLE_ROW_AGGREGATES:
        assert "SinglePartition" not in plan
    assert differences(result, duck.sql(ORACLE[name])) == []


def test_entry_returns_rows(spark):
    assert driver.entry(spark).count() > 0
