"""Delimited text, external entries, comparison by checksums, counts, splits, clustering."""

import os

import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StringType, StructField, StructType

from build import bronze, values
from lodeworks import jobs
from lodeworks.contracts import GAMES
from lodeworks.operators import checks
from lodeworks.sources import clustering, footers, jdbc, sinks
from lodeworks.sources.files import scan_delimited
from lodeworks.sources.tables import register_delimited, register_external

TEXT = StructType([StructField("a", StringType()), StructField("b", StringType())])


def written(spark, path, *lines):
    spark.createDataFrame([(line,) for line in lines], "value string").coalesce(1).write.text(path)


def test_plain_text_is_what_it_is(spark, tmp_path):
    path = str(tmp_path / "plain")
    written(spark, path, "C:\\new,x", "DOM\\,AC", "\ue0001\ue001,\\\\", "a\\n,b\\r")
    got = values(scan_delimited(spark, path, TEXT, escape=None), "a", "b")
    assert got == sorted([("C:\\new", "x"), ("DOM\\", "AC"), ("\ue0001\ue001", "\\\\"), ("a\\n", "b\\r")], key=repr)
    entry = register_delimited(spark, "plain_text_entry", path, TEXT)
    assert values(entry, "a", "b") == got
    spark.sql("DROP TABLE plain_text_entry")


@pytest.mark.parametrize("sep", (",", "\t", "\x01", "|"))
def test_escaped_text_comes_back_whatever_it_holds(spark, tmp_path, sep):
    texts = ["\ue000", "\ue0000", "\ue0001\ue002", "\\", "\\\\", "\\n", "\n", "\r\n", sep, f"\\{sep}", f"\\\\{sep}\\", "\\\\n", "é🙂"]
    rows = spark.createDataFrame([(x, y) for x in texts for y in texts], TEXT)
    path = str(tmp_path / "escaped")
    sinks.write_delimited(rows, path, sep)
    assert values(scan_delimited(spark, path, TEXT, sep), "a", "b") == values(rows, "a", "b")
    with pytest.raises(ValueError):
        scan_delimited(spark, path, TEXT, "1")


def test_entries_are_changed_in_place(spark, tmp_path):
    name, path = "layout_entry", str(tmp_path / "t")
    rows = spark.range(40).selectExpr("id", "id % 4 AS y")
    dropped = []
    plain = spark.sql

    def watch(text, *a, **k):
        if text.startswith("DROP"):
            dropped.append(text)
        return plain(text, *a, **k)

    spark.sql = watch
    try:
        sinks.replace_parquet(rows, path, partition_by=["y"])
        assert register_external(spark, name, path).count() == 40
        sinks.replace_parquet(rows.filter("y > 1").withColumn("more", F.lit("x")), path, partition_by=["y"])
        assert register_external(spark, name, path).filter("more = 'x'").count() == 20
        assert [r[0] for r in plain(f"SHOW PARTITIONS {name}").collect()] == ["y=2", "y=3"]
        other = str(tmp_path / "u")
        sinks.replace_parquet(rows.filter("y = 1").withColumn("more", F.lit("z")), other, partition_by=["y"])
        assert register_external(spark, name, other).filter("more = 'z'").count() == 10
        assert dropped == []
        # Columns that are gone need another entry.
        sinks.replace_parquet(rows.filter("y = 1"), other, partition_by=["y"])
        assert register_external(spark, name, other).columns == ["id", "y"] and len(dropped) == 1
    finally:
        spark.sql = plain
        plain(f"DROP TABLE IF EXISTS {name}")


def test_checksums_find_what_a_full_comparison_finds(spark):
    rows = [(i, i % 7, None if i % 5 == 0 else f"t{i % 11}") for i in range(300)]
    schema = "id long, n long, t string"
    left = spark.createDataFrame(rows + [rows[3]], schema).repartition(5)
    changed = [(i, n, "x" if i in (17, 170) else t) for i, n, t in rows if i != 40] + [(999, None, None), rows[3], rows[3]]
    right = spark.createDataFrame(changed, schema)
    for buckets in (1, 16, 4096):
        got = checks.compare_by_checksum(left, right, ["id"], buckets)
        assert values(got, *got.columns) == values(checks.compare_tables(left, right), *got.columns)
    assert checks.compare_by_checksum(left, left.repartition(3), ["id"]).count() == 0
    assert checks.differing_buckets(left, left.orderBy("t"), ["id"], 64) == []
    assert checks.compare_by_checksum(left.limit(0), right.limit(0), ["id"]).count() == 0
    moved = spark.createDataFrame([(1, None, "2")], schema), spark.createDataFrame([(1, 2, None)], schema)
    assert checks.compare_by_checksum(*moved, ["id"]).count() == 2
    assert values(checks.differing_columns(left, right, ["id"]), "column_name", "n_keys") == [("t", 2)]


def test_equal_tables_shuffle_a_row_a_bucket(spark):
    sums = checks.bucket_checksums(spark.range(10_000, numPartitions=4), ["id"], 8)
    plan = sums._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning(bucket") == 1 and sums.count() == 8


def test_bronze_is_counted_by_the_quarantine_pass(spark, tmp_path):
    game = {"gameid": 1, "gamedatetimeest": "2020-01-01", "hometeamid": 1, "awayteamid": 2, "arenaid": 3,
            "homescore": 4, "awayscore": 5}
    rows = bronze(spark, GAMES, game, game, {"gameid": 2}, {"gameid": 3})
    reads = spark.sparkContext.accumulator(0)
    for given, counts in ((rows, [("bronze", 4), ("quarantine", 2), ("silver", 1)]), (rows.limit(0), [("bronze", 0), ("quarantine", 0), ("silver", 0)])):
        got = jobs.run_silver(given, GAMES, str(tmp_path / "s"), str(tmp_path / "q"))
        assert values(got, "layer", "row_count") == counts
    assert values(jobs.run_silver(rows, GAMES, str(tmp_path / "s")), "layer", "row_count") == [("bronze", 4), ("silver", 1)]
    assert reads.value == 0


def test_ranges_hold_every_row_once_and_are_even(spark):
    rows = spark.range(20_000).selectExpr(
        "CASE WHEN id % 10 = 0 THEN NULL WHEN id % 10 < 3 THEN 5 ELSE id * id END AS k", "id",
        "CASE WHEN id % 3 = 0 THEN NULL ELSE timestamp_seconds(id) END AS t",
    )
    bounds = jdbc.depth_bounds(rows, "k", 10)
    ranges = jdbc.range_predicates("k", bounds)
    counts = [rows.filter(r).count() for r in ranges]
    assert sum(counts) == 20_000
    # The frequent value is a range of its own; the others are even.
    assert rows.filter("k = 5").count() in counts and counts[-1] == 2_000
    assert sorted(counts)[-2] < 1.5 * 20_000 * 0.9 / 10
    after = jdbc.range_predicates("k", bounds, "t", "1970-01-01 04:00:00")
    kept = rows.filter("t > '1970-01-01 04:00:00' OR t IS NULL").count()
    assert sum(rows.filter(r).count() for r in after) == kept
    assert jdbc.range_predicates("k", []) == ["1 = 1"] and jdbc.depth_bounds(rows, "k", 1) == []
    assert jdbc.depth_bounds(rows.limit(0), "k", 4) == []


def _groups_read(path, column, value):
    """Row groups whose extremes do not exclude a value."""
    count = total = 0
    for name in os.listdir(path):
        if name.endswith(".parquet"):
            meta = pq.ParquetFile(f"{path}/{name}").metadata
            at = meta.schema.names.index(column)
            for k in range(meta.num_row_groups):
                told = meta.row_group(k).column(at).statistics
                total += 1
                count += not told.has_min_max or told.min <= value <= told.max
    return count, total


def test_clustering_spares_groups_on_every_column(spark, tmp_path):
    rows = spark.range(40_000).selectExpr(
        "id", "CAST(1980 + hash(id) % 20 AS INT) AS season", "concat('TEAM_', abs(hash(id, 1)) % 30) AS team",
        "CASE WHEN id % 50 = 0 THEN NULL ELSE CAST(date_add(DATE'2000-01-01', CAST(id % 900 AS INT)) AS TIMESTAMP) END AS at",
    )
    plain, clustered = str(tmp_path / "plain"), str(tmp_path / "clustered")
    rows.repartition(32).write.parquet(plain)
    clustering.write_clustered(rows, clustered, ("season", "team"), 32)
    assert values(spark.read.parquet(clustered), "id") == values(rows, "id")
    for column, value in (("season", 1990), ("team", "TEAM_17")):
        assert _groups_read(plain, column, value) == (32, 32)
        count, total = _groups_read(clustered, column, value)
        assert count <= total / 2, (column, count, total)
    for columns in (("at", "team"), ("id",)):
        assert rows.select(clustering.interleaved(rows, columns).alias("z")).distinct().count() > 30
    with pytest.raises(ValueError):
        clustering.interleaved(rows, ["id"] * 11)
    assert rows.limit(0).select(clustering.interleaved(rows.limit(0), ["id"])).count() == 0


def test_footers_answer_checks(spark, tmp_path):
    path = str(tmp_path / "t")
    spark.createDataFrame(
        [(1, 0.5, None, None), (2, 1.0, -1.0, None), (None, 0.0, 3.0, None)], "id long, share double, x double, none double"
    ).coalesce(1).write.parquet(path)
    limits = {"not_null": ("id", "share"), "non_negative": ("id", "x", "none"), "unit_interval": ("share", "x")}
    got = footers.check_from_footers(spark, path, **limits)
    full = checks.check_table(spark.read.parquet(path), **limits)
    assert values(got, "check_name", "column_name", "passed") == values(full, "check_name", "column_name", "passed")
    # A row group of NULLs alone has no extremes; without it nothing but footers is read.
    assert "PushedAggregation" not in got._jdf.queryExecution().toString()
    limits |= {"non_negative": ("id", "share")}
    limits["unit_interval"] = ("share",)
    got = footers.check_from_footers(spark, path, **limits)
    full = checks.check_table(spark.read.parquet(path), **limits)
    assert values(got, "check_name", "column_name", "passed") == values(full, "check_name", "column_name", "passed")
    assert "PushedAggregation: [COUNT(*)" in got._jdf.queryExecution().toString()
    assert spark.conf.get("spark.sql.sources.useV1SourceList") != ""
