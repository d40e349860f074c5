"""Table checks and comparison."""

from __future__ import annotations

from lodeworks.operators.checks import check_table, compare_tables
from workload import roles

_LINE_COLUMNS = ("personId", "gameId", "numMinutes", "points", "assists")


def _check(spark, sf_dir):
    lines = roles.BRONZE_PLAYER_STATISTICS.frame(spark, sf_dir, *_LINE_COLUMNS)
    discounts = lines.withColumnRenamed("numMinutes", "share")
    return check_table(
        discounts,
        not_null=("personId", "gameId", "share"),
        non_negative=("points", "assists"),
        unit_interval=("share",),
    )


def _compare(spark, sf_dir):
    lines = roles.load(spark, sf_dir, "lineitem")
    left = lines.selectExpr("l_suppkey AS suppkey", "l_returnflag AS flag")
    right = lines.selectExpr("l_suppkey AS suppkey", "l_linestatus AS flag")
    return compare_tables(left, right)


QUERIES = {"check_table": _check, "compare_tables": _compare}

_CHECKS = (
    ("non_empty", "*", "CASE WHEN count(*) = 0 THEN 1 ELSE 0 END"),
    ("not_null", "personId", "count(*) - count(personId)"),
    ("not_null", "gameId", "count(*) - count(gameId)"),
    ("not_null", "share", "count(*) - count(numMinutes)"),
    ("non_negative", "points", "count(CASE WHEN points < 0 THEN 1 END)"),
    ("non_negative", "assists", "count(CASE WHEN assists < 0 THEN 1 END)"),
    ("unit_interval", "share", "count(CASE WHEN numMinutes < 0 OR numMinutes > 1 THEN 1 END)"),
)

ORACLE = {
    "check_table": f"WITH b AS ({roles.BRONZE_PLAYER_STATISTICS.sql(*_LINE_COLUMNS)}) "
    + " UNION ALL ".join(
        f"SELECT '{check}' AS check_name, '{column}' AS column_name, "
        f"CAST({count} AS BIGINT) AS violations, {count} = 0 AS passed FROM b"
        for check, column, count in _CHECKS
    ),
    "compare_tables": """
        SELECT coalesce(a.suppkey, e.suppkey) AS suppkey, coalesce(a.flag, e.flag) AS flag,
               coalesce(a.n, 0) AS actual_count, coalesce(e.n, 0) AS expected_count
        FROM (SELECT l_suppkey AS suppkey, l_returnflag AS flag, count(*) AS n
              FROM lineitem GROUP BY 1, 2) AS a
        FULL JOIN (SELECT l_suppkey AS suppkey, l_linestatus AS flag, count(*) AS n
                   FROM lineitem GROUP BY 1, 2) AS e
          ON a.suppkey = e.suppkey AND a.flag = e.flag
        WHERE coalesce(a.n, 0) <> coalesce(e.n, 0)""",
}
