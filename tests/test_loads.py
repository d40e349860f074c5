"""Sources, sinks, incremental loads and table publication."""

from datetime import date, datetime, timedelta, timezone

import pytest
from pyspark.sql import functions as F

from build import values
from lodeworks.contracts import GAMES, PLAYERS
from lodeworks.operators.audit import row_counts
from lodeworks.operators.checks import assert_tables_equal
from lodeworks.sources import jdbc
from lodeworks.sources.files import (
    scan_csv_with_header,
    scan_delimited,
    scan_headerless_csv,
    with_lineage,
)
from lodeworks.sources.sinks import write_delimited, write_parquet
from lodeworks.sources.staging import shared_folder, staged
from lodeworks.sources.tables import ensure_database, publish_table, scan_table
from lodeworks.streaming.incremental import high_watermark, incremental_append, since_cutoff

DAYS = [(1, "2021-01-01 10:00:00"), (2, "2021-01-02 10:00:00.25"), (3, "2021-01-03 10:00:00")]


@pytest.fixture(params=["timestamp", "timestamp_ntz", "string", "date"])
def timed(request, spark):
    text = spark.createDataFrame(DAYS, "id int, ts string")
    return text.withColumn("ts", F.col("ts").cast(request.param))


def test_two_increments_make_the_whole(timed, tmp_path):
    target = str(tmp_path / "t")
    incremental_append(timed.filter("id < 2"), target, "ts")
    assert incremental_append(timed.filter("id < 3"), target, "ts").count() == 2
    assert_tables_equal(incremental_append(timed, target, "ts"), timed)
    # Nothing new: nothing is added.
    assert incremental_append(timed, target, "ts").count() == 3


def test_a_floor_narrows_the_search_only(timed):
    top = high_watermark(timed, "ts")
    for floor in ("2020-05-05", "2021-01-02", "2021-01-03", "2022-01-01"):
        assert high_watermark(timed, "ts", floor=floor) == top


def test_late_rows_need_a_lookback(spark, tmp_path):
    rows = spark.createDataFrame(DAYS, "id int, ts string").withColumn(
        "ts", F.col("ts").cast("timestamp")
    )
    target = str(tmp_path / "t")
    incremental_append(rows.filter("id <> 2"), target, "ts")
    assert values(incremental_append(rows, target, "ts"), "id") == [(1,), (3,)]
    late = incremental_append(rows, target, "ts", lookback=timedelta(days=2))
    assert values(late.distinct(), "id") == [(1,), (2,), (3,)]


def test_text_target_grows_by_watermark(spark, tmp_path):
    rows = spark.createDataFrame(DAYS, "id int, ts string")
    target = str(tmp_path / "t")
    incremental_append(rows.filter("id = 1"), target, "ts", delimited=True)
    assert_tables_equal(incremental_append(rows, target, "ts", delimited=True), rows)


def test_text_target_keeps_microseconds(spark, tmp_path):
    rows = spark.createDataFrame(DAYS, "id int, ts string")
    for kind in ("timestamp", "timestamp_ntz"):
        typed = rows.withColumn("ts", F.col("ts").cast(kind))
        target = str(tmp_path / kind)
        incremental_append(typed.filter("id < 3"), target, "ts", delimited=True)
        assert_tables_equal(incremental_append(typed, target, "ts", delimited=True), typed)


def test_files_with_other_headers_are_refused(spark, tmp_path):
    (tmp_path / "a.csv").write_text("personId,country\n7,Peru\n")
    (tmp_path / "b.csv").write_text("country,personId\nChad,8\n")
    with pytest.raises(Exception, match="header"):
        scan_csv_with_header(spark, str(tmp_path), PLAYERS.bronze).collect()


def test_rows_from_no_file_have_no_lineage(spark):
    assert with_lineage(spark.createDataFrame([(1,)], "a int")).first()["source_file"] is None


def test_empty_target_has_no_watermark(spark, tmp_path):
    rows = spark.createDataFrame(DAYS, "id int, ts string")
    target = str(tmp_path / "t")
    write_parquet(rows.filter("id < 0"), target)
    assert high_watermark(rows.filter("id < 0"), "ts") is None
    assert incremental_append(rows, target, "ts").count() == 3


def test_watermark_does_not_depend_on_the_time_zone(spark, tmp_path):
    spark.conf.set("spark.sql.session.timeZone", "America/New_York")
    try:
        # The hour that happens twice when daylight saving time ends.
        instants = [datetime(2021, 11, 7, h, 30, tzinfo=timezone.utc) for h in (4, 5, 6, 7)]
        rows = spark.createDataFrame(list(enumerate(instants)), "id int, ts timestamp")
        target = str(tmp_path / "t")
        incremental_append(rows.filter("id < 2"), target, "ts")
        assert values(incremental_append(rows, target, "ts"), "id") == [(0,), (1,), (2,), (3,)]
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")


def test_cutoff_is_inclusive_and_drops_malformed(spark):
    rows = spark.createDataFrame(
        [(1, "2017-12-31 23:59:59"), (2, "2018-01-01 00:00:00"), (3, "x"), (4, None)],
        "id int, ts string",
    )
    assert values(since_cutoff(rows, "ts"), "id") == [(2,)]
    with pytest.raises(ValueError, match="available"):
        since_cutoff(rows, "when")


def test_delimited_numbers_that_do_not_parse_are_null(spark, tmp_path):
    (tmp_path / "part").write_text('1,2020-01-01,"Rome",x\nfive,2020-01-02, Oslo ,7\n')
    rows = scan_delimited(spark, str(tmp_path), GAMES.bronze)
    assert values(rows, "gameid", "hometeamcity", "hometeamname", "hometeamid") == [
        (1, '"Rome"', "x", None), (None, " Oslo ", "7", None),
    ]


def test_delimited_round_trip(spark, tmp_path):
    rows = spark.createDataFrame([(1, " a ", None), (2, "b'\"c", 3.5)], "i int, s string, d double")
    write_delimited(rows, str(tmp_path / "t"))
    assert_tables_equal(scan_delimited(spark, str(tmp_path / "t"), rows.schema), rows)


def test_headerless_csv_reads_null_word(spark, tmp_path):
    (tmp_path / "f.csv").write_text('1,"a, b",null\n')
    schema = spark.createDataFrame([], "id long, name string, n int").schema
    rows = scan_headerless_csv(spark, str(tmp_path), schema)
    assert values(rows, "id", "name", "n") == [(1, "a, b", None)]


def test_header_decides_the_order(spark, tmp_path):
    (tmp_path / "f.csv").write_text("country,Extra,personId,height\nPeru,e,7,tall\n")
    rows = scan_csv_with_header(spark, str(tmp_path), PLAYERS.bronze)
    assert rows.dtypes == [
        ("country", "string"), ("Extra", "string"), ("personId", "bigint"), ("height", "double"),
    ]
    assert values(rows, *rows.columns) == [("Peru", "e", 7, None)]


def test_lineage_survives_the_dedup_shuffle(spark, tmp_path):
    from lodeworks.plans.silver import build_silver

    path = str(tmp_path / "t")
    rows = spark.createDataFrame([(1, "Ann")], "personId long, firstName string")
    for field in PLAYERS.bronze.fields:
        if field.name not in rows.columns:
            rows = rows.withColumn(field.name, F.lit(None).cast(field.dataType))
    write_parquet(rows, path)
    out = build_silver(with_lineage(spark.read.parquet(path)), PLAYERS).silver
    (name,) = out.first()["source_file"].rsplit("/", 1)[-1:]
    assert name.startswith("part-") and name.endswith(".parquet")


def test_partitioned_write_is_rebalanced(spark, tmp_path):
    rows = spark.range(1000).selectExpr("id", "id % 3 AS year").repartition(8)
    write_parquet(rows, str(tmp_path / "t"), partition_by=["year"])
    files = list((tmp_path / "t").glob("year=*/*.parquet"))
    assert len(files) == 3
    assert spark.read.parquet(str(tmp_path / "t")).count() == 1000


def test_fixed_partition_count_is_applied(spark, tmp_path):
    write_parquet(spark.range(100), str(tmp_path / "t"), num_partitions=3)
    assert len(list((tmp_path / "t").glob("*.parquet"))) == 3


def test_publish_replaces_and_survives_failure(spark, tmp_path):
    ensure_database(spark, "pubtest", str(tmp_path / "db"))
    base = str(tmp_path / "gold")
    first = publish_table(spark.range(3), "pubtest.t", base)
    second = publish_table(spark.range(5), "pubtest.t", base)
    assert first != second and scan_table(spark, "pubtest", "t").count() == 5
    failing = spark.range(4).selectExpr("assert_true(id < 2) AS a", "id").select("id", "a")
    with pytest.raises(Exception):
        publish_table(failing, "pubtest.t", base)
    assert scan_table(spark, "pubtest", "t").count() == 5
    publish_table(spark.range(2).selectExpr("id", "'x' AS extra"), "pubtest.t", base)
    assert scan_table(spark, "pubtest", "t").columns == ["id", "extra"]


def test_staging_uses_the_named_folder(spark):
    folder = shared_folder(spark)
    kept = staged(spark.range(10), "probe")
    assert kept.count() == 10 and folder in kept.inputFiles()[0]
    assert folder == spark.sparkContext.getConf().get("spark.checkpoint.dir").rstrip("/")


def test_row_counts(spark):
    counts = row_counts({"a": spark.range(3), "b": spark.range(0)})
    assert values(counts, "layer", "row_count") == [("a", 3), ("b", 0)]


def test_jdbc_options():
    split = jdbc.Split("id", "0", "100", 8)
    options = jdbc.read_options("jdbc:x", "games", {"user": "u"}, split)
    assert options["partitionColumn"] == "id" and options["numPartitions"] == "8"
    assert options["user"] == "u" and options["dbtable"] == "games"
    assert "partitionColumn" not in jdbc.read_options("jdbc:x", "games", {})
    assert jdbc.write_options("jdbc:x", "games", {})["batchsize"] == "1000"
