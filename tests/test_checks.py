"""Table checks and comparison."""

import pytest

from build import values
from lodeworks.operators.checks import (
    assert_table,
    assert_tables_equal,
    check_table,
    compare_tables,
    missing_columns,
)


def test_checks_in_one_report(spark):
    df = spark.createDataFrame(
        [(1, -1.0, 0.5), (None, 2.0, 1.5), (3, None, None)], "a int, b double, c double"
    )
    report = check_table(df, not_null=["a", "b"], non_negative=["b"], unit_interval=["c"])
    assert values(report, "check_name", "column_name", "violations", "passed") == [
        ("non_empty", "*", 0, True),
        ("non_negative", "b", 1, False),
        ("not_null", "a", 1, False),
        ("not_null", "b", 1, False),
        ("unit_interval", "c", 1, False),
    ]


def test_empty_table_fails(spark):
    with pytest.raises(AssertionError, match="non_empty"):
        assert_table(spark.range(0))


def test_assert_table(spark):
    df = spark.range(3)
    assert_table(df, required=["id"], not_null=["id"], non_negative=["id"])
    assert missing_columns(df, ["id", "x"]) == ["x"]
    with pytest.raises(AssertionError, match="missing"):
        assert_table(df, required=["x"])


def test_comparison_counts_repeats_and_nulls(spark):
    left = spark.createDataFrame([(1, None), (1, None), (2, "b")], "a int, b string")
    right = spark.createDataFrame([(1, None), (2, "b"), (3, "c")], "a int, b string")
    columns = ("a", "b", "actual_count", "expected_count")
    assert values(compare_tables(left, right), *columns) == [(1, None, 2, 1), (3, "c", 0, 1)]
    with pytest.raises(AssertionError, match="differing rows"):
        assert_tables_equal(left, right)
    assert_tables_equal(left, left.orderBy("a"))


def test_comparison_of_schemas(spark):
    narrow = spark.createDataFrame([(1,)], "a int")
    assert_tables_equal(narrow, spark.createDataFrame([(1,)], "a bigint"))
    for other in ("b int", "a string", "a double"):
        with pytest.raises(AssertionError):
            assert_tables_equal(narrow, spark.createDataFrame([], other))
    with pytest.raises(AssertionError, match="columns"):
        assert_tables_equal(narrow, narrow.selectExpr("a", "a AS c"))
