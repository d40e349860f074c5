"""What writes, merges and large facts leave on disk, and that rounds change no row."""

import time

import pytest
from pyspark.sql import Row

import __spark_entry__ as driver
from build import values
from lodeworks.sources import sinks, staging, storage
from lodeworks.sources.sinks import write_parquet
from lodeworks.streaming import merge as merging
from workload import star_queries, upkeep_queries

SF_DIR = "/root/testdata/sf0.001"


def shuffle_files(spark):
    found = spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().getAllFiles()
    names = (found.apply(i).getName() for i in range(found.size()))
    return {name for name in names if name.startswith("shuffle_")}


def gone(spark, before):
    """Whether no shuffle files but those of ``before`` are left; they are deleted meanwhile."""
    for _ in range(100):
        if not shuffle_files(spark) - before:
            return True
        time.sleep(0.1)
    return False


def test_writes_leave_no_shuffle_files(spark, tmp_path):
    rows = spark.range(1000).selectExpr("id", "id % 3 AS season").repartition(7, "id")
    before = shuffle_files(spark)
    kept = staging.staged(rows, "probe")
    write_parquet(rows, str(tmp_path / "a"), partition_by=["season"])
    assert gone(spark, before)
    assert kept.count() == spark.read.parquet(str(tmp_path / "a")).count() == 1000
    # A result outside of such writes can be taken twice.
    assert rows.distinct().count() == 1000 and shuffle_files(spark) - before


def test_merges_of_queries_leave_nothing_staged(spark):
    kept = lambda: {x for x in storage.children(spark, staging.shared_folder(spark)) if "/merge-" in x}
    before = kept()
    assert upkeep_queries.QUERIES["silver_merge_increments"](spark, SF_DIR).count()
    assert kept() == before


@pytest.mark.parametrize("name", ["fact_stats", "fact_bucketed", "silver_stream"])
def test_rounds_give_the_same_rows(spark, monkeypatch, name):
    query = driver.queries()[name]
    want = sorted(query(spark, SF_DIR).collect(), key=repr)
    used = []
    monkeypatch.setattr(staging, "ROUND_BYTES", 40_000)
    for module in (star_queries, upkeep_queries, merging):
        if hasattr(module, "rounds_for"):
            told = lambda *a, **b: used.append(staging.rounds_for(*a, **b)) or used[-1]
            monkeypatch.setattr(module, "rounds_for", told)
    assert sorted(query(spark, SF_DIR).collect(), key=repr) == want
    assert max(used) > 1


def test_rounds_hold_rows_without_a_key_and_any_partition(spark, tmp_path):
    rows = spark.createDataFrame([(None, 2000), (1, None), (1, 2001), (2, 2000)], "id long, season int")
    assert values(staging.staged_in_rounds(rows, "probe", ["id"], 3), "id", "season") == values(rows, "id", "season")
    path = str(tmp_path / "parts")
    touched = [Row(season=2000), Row(season=None), Row(season=2001), Row(season=1999)]
    sinks.replace_partitions(rows, path, ["season"], touched, 2)
    assert values(spark.read.schema(rows.schema).parquet(path), "id", "season") == values(rows, "id", "season")
