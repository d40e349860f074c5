"""Layouts, staged comparison, counts and splits: what spares passes over whole tables."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, functions as F
from pyspark.sql.types import LongType, StringType, StructField, StructType

from lodeworks.contracts import GAMES
from lodeworks.jobs import run_silver
from lodeworks.operators.checks import compare_by_checksum, differing_columns
from lodeworks.plans import gold
from lodeworks.sources.clustering import write_clustered
from lodeworks.sources.files import scan_delimited, scan_parquet
from lodeworks.sources.footers import check_from_footers
from lodeworks.sources.jdbc import depth_bounds, range_predicates
from lodeworks.sources.sinks import write_delimited
from lodeworks.sources.staging import fresh_path
from workload import roles
from workload.check_queries import ORACLE as CHECK_SQL
from workload.gold_queries import ORACLE as GOLD_SQL
from workload.silver_queries import AS_OF, ORACLE as SILVER_SQL

_GAME_COLUMNS = roles.BRONZE_GAMES_COLUMNS
_PLAYER = ("personId", "gameId", "firstName", "lastName")
_TEAM, _SEASON = "NATION_7", 1997


def _slice_clustered(spark, sf_dir):
    """The season slice of one team from box scores clustered by season and team."""
    columns = ("game_year", "playerteamName", *gold.SLICE_MEASURES)
    path = fresh_path(spark, "clustered")
    write_clustered(
        roles.PLAYER_STATISTICS.frame(spark, sf_dir, *_PLAYER, *columns), path, ("game_year", "playerteamName")
    )
    return gold.slice_summary(scan_parquet(spark, path), _TEAM, _SEASON)


def _sides(spark, sf_dir):
    lines = roles.load(spark, sf_dir, "lineitem")
    left = lines.selectExpr("l_suppkey AS suppkey", "l_returnflag AS flag")
    right = lines.selectExpr("l_suppkey AS suppkey", "l_linestatus AS flag")
    return left, right


def _compare_by_checksum(spark, sf_dir):
    return compare_by_checksum(*_sides(spark, sf_dir), keys=["suppkey"])


def _differing_columns(spark, sf_dir):
    orders = roles.load(spark, sf_dir, "orders").selectExpr("o_orderkey", "o_custkey", "o_orderpriority AS priority")
    changed = orders.withColumns(
        {
            "priority": F.when(F.col("o_orderkey") % 1000 == 7, None).otherwise(F.col("priority")),
            "o_custkey": F.when(F.col("o_orderkey") % 500 == 3, -1).otherwise(F.col("o_custkey")).cast(
                orders.schema["o_custkey"].dataType
            ),
        }
    )
    return differing_columns(orders, changed, ["o_orderkey"], buckets=1 << 16)


def _row_count_observed(spark, sf_dir):
    """The report of the silver job over delimited bronze, of which no count pass is made."""
    bronze, silver, quarantine = (fresh_path(spark, x) for x in ("bronze", "silver", "quarantine"))
    write_delimited(roles.BRONZE_GAMES.frame(spark, sf_dir, *_GAME_COLUMNS), bronze)
    rows = scan_delimited(spark, bronze, GAMES.bronze)
    return run_silver(rows, GAMES, silver, quarantine, as_of=AS_OF)


def _import_ranges(spark, sf_dir):
    """Rows per range, as an equal-depth import reads them, summed up over the column's parity."""
    lines = roles.load(spark, sf_dir, "lineitem").selectExpr(
        "CASE WHEN l_partkey % 11 = 0 THEN NULL WHEN l_partkey % 3 = 0 THEN 1 ELSE l_extendedprice * l_extendedprice END AS skewed",
        "l_returnflag",
    )
    ranges = range_predicates("skewed", depth_bounds(lines, "skewed", 16))
    parts = [lines.filter(condition) for condition in ranges]
    return reduce(DataFrame.unionAll, parts).groupBy("l_returnflag").agg(
        F.count("*").alias("rows_read"), F.count("skewed").alias("with_value")
    )


_LIMITS = {
    "not_null": ("l_orderkey", "l_quantity"),
    "non_negative": ("l_quantity", "l_extendedprice"),
    "unit_interval": ("l_discount", "l_quantity"),
}


def _check_from_footers(spark, sf_dir):
    return check_from_footers(spark, f"{sf_dir}/lineitem.parquet", **_LIMITS)


def _footer_check_sql() -> str:
    tests = {
        "not_null": "count({c}) = count(*)",
        "non_negative": "coalesce(min({c}) >= 0, true)",
        "unit_interval": "coalesce(min({c}) >= 0 AND max({c}) <= 1, true)",
    }
    rows = ["SELECT 'non_empty' AS check_name, '*' AS column_name, count(*) > 0 AS passed FROM lineitem"]
    rows += [
        f"SELECT '{check}', '{c}', {tests[check].format(c=c)} FROM lineitem"
        for check, columns in _LIMITS.items()
        for c in columns
    ]
    return " UNION ALL ".join(rows)


# Backslashes, a private character and its codes, as other writers leave them.
_PLAIN = (
    "CASE l_orderkey % 4 WHEN 0 THEN 'C:' || chr(92) || 'new' WHEN 1 THEN 'DOM' || chr(92) "
    "WHEN 2 THEN chr(57344) || '1' || chr(57345) || chr(92) || chr(92) ELSE l_returnflag END"
)
_PLAIN_SCHEMA = StructType(
    [StructField("l_orderkey", LongType()), StructField("remark", StringType()), StructField("flag", StringType())]
)


def _plain_lines(spark, sf_dir):
    text = _PLAIN.replace("chr(57344)", "decode(X'EE8080', 'UTF-8')").replace("chr(57345)", "decode(X'EE8081', 'UTF-8')")
    return roles.load(spark, sf_dir, "lineitem").selectExpr("l_orderkey", f"{text} AS remark", "l_linestatus AS flag")


def _delimited_plain(spark, sf_dir):
    """Delimited text of a writer that escapes nothing."""
    path = fresh_path(spark, "plain")
    _plain_lines(spark, sf_dir).select(F.concat_ws(",", "l_orderkey", "remark", "flag")).write.text(path)
    return scan_delimited(spark, path, _PLAIN_SCHEMA, escape=None)


def _delimited_any_text(spark, sf_dir):
    """The same texts, and separators among them, written and read with escapes."""
    path = fresh_path(spark, "escaped")
    rows = _plain_lines(spark, sf_dir).withColumn("remark", F.concat("remark", F.lit(","), "flag", F.lit("\\,\\\\n\n")))
    write_delimited(rows, path)
    return scan_delimited(spark, path, _PLAIN_SCHEMA)


QUERIES = {
    "slice_clustered": _slice_clustered,
    "compare_by_checksum": _compare_by_checksum,
    "compare_columns": _differing_columns,
    "row_count_observed": _row_count_observed,
    "import_ranges": _import_ranges,
    "check_from_footers": _check_from_footers,
    "delimited_plain": _delimited_plain,
    "delimited_any_text": _delimited_any_text,
}

ORACLE = {
    "slice_clustered": GOLD_SQL["slice_summary"],
    "compare_by_checksum": CHECK_SQL["compare_tables"],
    "compare_columns": """
        SELECT 'priority' AS column_name, count(*) AS n_keys FROM orders
        WHERE o_orderkey % 1000 = 7 AND o_orderpriority IS NOT NULL HAVING count(*) > 0
        UNION ALL
        SELECT 'o_custkey', count(*) FROM orders WHERE o_orderkey % 500 = 3 HAVING count(*) > 0""",
    "row_count_observed": f"""
        SELECT 'bronze' AS layer, count(*) AS row_count FROM lineitem UNION ALL
        SELECT 'silver', count(*) FROM ({SILVER_SQL["silver_games"]}) AS s UNION ALL
        SELECT 'quarantine', count(*) FROM ({SILVER_SQL["quarantine_games"]}) AS q""",
    "import_ranges": """
        SELECT l_returnflag, count(*) AS rows_read, count(CASE WHEN l_partkey % 11 <> 0 THEN 1 END) AS with_value
        FROM lineitem GROUP BY 1""",
    "check_from_footers": _footer_check_sql(),
    "delimited_plain": f"SELECT l_orderkey, {_PLAIN} AS remark, l_linestatus AS flag FROM lineitem",
    "delimited_any_text": f"""
        SELECT l_orderkey, {_PLAIN} || ',' || l_linestatus || chr(92) || ',' || chr(92) || chr(92) || 'n' || chr(10)
               AS remark, l_linestatus AS flag FROM lineitem""",
}
