"""Text, catalog and storage at their edges: what tidy inputs never show."""

from datetime import timedelta

import pytest
from pyspark.sql import functions as F
from pyspark.sql.types import IntegerType, LongType

from build import values
from lodeworks import jobs
from lodeworks.contracts import GAMES
from lodeworks.functions.numeric import whole_number
from lodeworks.operators.checks import missing_columns
from lodeworks.sources import jdbc, storage
from lodeworks.sources.files import scan_csv_with_header, scan_delimited, scan_headerless_csv
from lodeworks.sources.sinks import replace_parquet, write_delimited, write_parquet
from lodeworks.sources.tables import (
    ensure_database,
    overwrite_table,
    publish_table,
    register_external,
    remove_superseded,
    table_type,
)
from lodeworks.streaming.incremental import high_watermark, incremental_append, since_cutoff


@pytest.fixture(scope="module")
def database(spark, tmp_path_factory):
    ensure_database(spark, "edges", str(tmp_path_factory.mktemp("edges")))
    return "edges"


def test_fractions_are_cut_and_other_text_is_null(spark):
    texts = ["12.0", "12.7", "-12.7", " 7. ", "1e3", ".5", "x", "1610612737.0", "99999999999.5", None]
    rows = spark.createDataFrame([(t,) for t in texts], "t string")
    got = rows.select(whole_number(F.col("t"), IntegerType()), whole_number(F.col("t"), LongType())).collect()
    assert [r[0] for r in got] == [12, 12, -12, 7, None, None, None, 1610612737, None, None]
    assert got[8][1] == 99999999999


def test_delimited_text_survives(spark, tmp_path):
    texts = ["a,b", "two\nlines", "cr\r", "back\\slash", "\\", "\\,", "\\n", 'quote "x"', "", None, " pad "]
    rows = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "id int, t string")
    path = str(tmp_path / "t")
    write_delimited(rows, path)
    assert [r["t"] for r in scan_delimited(spark, path, rows.schema).orderBy("id").collect()] == [
        t or None for t in texts
    ]
    lines = spark.read.text(path)
    assert lines.count() == len(texts)
    assert lines.filter(F.col("value").contains("\x00")).isEmpty()


def test_quoted_csv_survives(spark, tmp_path):
    (tmp_path / "a.csv").write_text('GAMEID,hometeamcity,homescore\n1,"a ""b"", c",9.0\n2,"two\nlines",7\n')
    rows = scan_csv_with_header(spark, str(tmp_path), GAMES.bronze, multiline=True)
    assert rows.columns == ["gameid", "hometeamcity", "homescore"]
    assert values(rows, "gameid", "hometeamcity", "homescore") == [(1, 'a "b", c', 9), (2, "two\nlines", 7)]
    (tmp_path / "h").write_text('1,"a ""b"""\n')
    schema = GAMES.bronze.__class__(GAMES.bronze.fields[:2])
    assert scan_headerless_csv(spark, str(tmp_path / "h"), schema).first()[1] == 'a "b"'


def test_records_that_do_not_fit_go_to_rejects(spark, tmp_path):
    csv, rejects = tmp_path / "a.csv", str(tmp_path / "rejects")
    csv.write_text("gameid,gameDateTimeEst\n1,2020-01-01 10:00:00\n2,2020-01-02 10:00:00,extra\n")
    rows = jobs.load_csv(spark, str(csv), GAMES, rejects=rejects)
    assert values(rows, "gameid") == [(1,)]
    assert [r["_corrupt_record"] for r in spark.read.parquet(rejects).collect()] == [
        "2,2020-01-02 10:00:00,extra"
    ]


def test_watermark_and_cutoff_take_times_only(spark, tmp_path):
    rows = spark.createDataFrame(
        [(1, "2021-01-01 10:00:00"), (2, "garbage"), (3, "NA"), (4, None), (5, "2021-01-03 10:00:00")],
        "id int, TS string",
    )
    target, undated = str(tmp_path / "t"), str(tmp_path / "u")
    incremental_append(rows.filter("id < 5"), target, "ts", undated_path=undated)
    assert high_watermark(rows, "ts", floor="2021-01-02") == high_watermark(rows, "Ts")
    assert values(incremental_append(rows, target, "ts", undated_path=undated), "id") == [(1,), (5,)]
    assert values(spark.read.parquet(undated), "id") == [(2,), (3,), (4,)]
    assert values(since_cutoff(rows, "ts", "2021-01-02"), "id") == [(5,)]


def test_undated_rows_go_next_to_the_target_and_stay(spark, tmp_path):
    rows = spark.createDataFrame(
        [(1, "2021-01-01", {"a": 1}), (2, "NA", {"a": 2}), (2, "NA", {"a": 2}), (3, None, None), (4, "2021-01-02", None), (5, "?", {})],
        "id int, ts string, more map<string, int>",
    ).withColumn("seen", F.timestamp_micros(F.col("id") * 1))
    target = str(tmp_path / "t")
    for ids in ("id < 3", "id < 3", "id > 2", "id = 2 OR id = 5"):
        loaded = incremental_append(rows.filter(ids), target, "ts")
    assert values(loaded, "id") == [(1,), (4,)]
    undated = spark.read.parquet(f"{target}-undated")
    assert values(undated, "id") == [(2,), (2,), (3,), (5,)]
    assert undated.columns == rows.columns


@pytest.mark.parametrize("keys", ([], ["ID"]))
def test_lookback_appends_each_row_once(spark, tmp_path, keys):
    rows = spark.createDataFrame(
        [(i, f"2021-01-0{1 + i % 5} 10:00:00") for i in (*range(20), None) if i is not None]
        + [(None, "2021-01-05 10:00:00")],
        "id int, ts string",
    ).withColumn("ts", F.col("ts").cast("timestamp"))
    target = str(tmp_path / "t")
    incremental_append(rows.filter("id % 3 = 0"), target, "ts")
    for _ in range(3):
        whole = incremental_append(rows, target, "ts", lookback=timedelta(days=9), keys=keys)
    assert whole.count() == 21 and whole.distinct().count() == 21


def test_registered_partitions_follow_the_files(spark, database, tmp_path):
    path, name = str(tmp_path / "silver"), f"{database}.parts"
    rows = spark.range(100).selectExpr("id", "CAST(2000 + id % 4 AS INT) AS year")
    for limit, count in ((2002, 50), (2003, 75), (2004, 100)):
        replace_parquet(rows.filter(F.col("year") < limit), path, partition_by=["year"])
        assert register_external(spark, name, path).count() == count
    replace_parquet(rows.withColumn("more", F.lit("x")), path, partition_by=["year"])
    assert register_external(spark, name, path).where("more = 'x' AND year = 2001").count() == 25


def test_silver_job_registers_partitions_that_gold_reads(spark, tmp_path):
    bronze = {n: None for n in GAMES.bronze.fieldNames()}
    for run, years in enumerate(((2020,), (2020, 2021))):
        records = [
            {**bronze, "gameid": y, "gamedatetimeest": f"{y}-02-03 19:00:00", "hometeamname": "a",
             "hometeamid": 1, "awayteamname": "b", "awayteamid": 2, "homescore": 9, "awayscore": 1,
             "arenaid": 4}
            for y in years
        ]
        source = f"{tmp_path}/bronze{run}"
        write_parquet(spark.createDataFrame([tuple(r.values()) for r in records], GAMES.bronze), source)
        jobs.main([
            "silver", "games", "--parquet", source, "--silver", f"{tmp_path}/silver",
            "--partition-by", "game_year", "--register", "edges2.games_silver", "--as-of", "2024-06-30",
        ])
        assert spark.table("edges2.games_silver").count() == len(years)


def test_managed_tables_are_never_replaced(spark, database, tmp_path):
    overwrite_table(spark.range(3), f"{database}.own")
    path = str(tmp_path / "x")
    write_parquet(spark.range(1), path)
    with pytest.raises(ValueError, match="managed"):
        register_external(spark, f"{database}.own", path)
    with pytest.raises(ValueError, match="managed"):
        publish_table(spark.range(1), f"{database}.own", str(tmp_path))
    assert spark.table(f"{database}.own").count() == 3


def test_publishing_changed_columns_keeps_the_name(spark, database, tmp_path):
    name, base = f"{database}.pub", str(tmp_path)
    write_parquet(spark.range(2), f"{base}/before")
    register_external(spark, name, f"{base}/before")
    first = publish_table(spark.range(3), name, base)
    assert table_type(spark, name) == "VIEW" and spark.read.parquet(f"{base}/before").count() == 2
    second = publish_table(spark.range(4).selectExpr("id", "'x' AS more"), name, base)
    assert spark.table(name).columns == ["id", "more"]
    third = publish_table(spark.range(5), name, base)
    assert [x.rsplit("/", 1)[-1] for x in remove_superseded(spark, name, base, third)] == [
        first.rsplit("/", 1)[-1]
    ]
    assert storage.exists(spark, second) and spark.table(name).count() == 5


def test_a_failed_write_leaves_the_old_data(spark, tmp_path):
    path = str(tmp_path / "t")
    replace_parquet(spark.range(3), path)
    with pytest.raises(Exception):
        replace_parquet(spark.range(9).select(F.raise_error(F.lit("no")).cast("string").alias("x")), path)
    assert spark.read.parquet(path).count() == 3
    # The rows may come from the place they replace.
    replace_parquet(spark.read.parquet(path).filter("id > 0"), path)
    assert spark.read.parquet(path).count() == 2
    assert [p.name for p in tmp_path.iterdir()] == ["t"]


def test_import_bounds_follow_the_new_rows():
    assert jdbc.bounds_query("games", "id") == "SELECT min(id) AS low, max(id) AS high FROM games"
    assert jdbc.bounds_query("games", "id", "ts", "2021-01-01").endswith("WHERE ts > '2021-01-01'")


def test_import_without_a_split_is_refused(tmp_path):
    with pytest.raises(SystemExit, match="split-by"):
        jobs.main(["import", "games", str(tmp_path), "--url", "jdbc:none:x"])


def test_required_columns_in_any_case(spark):
    assert missing_columns(spark.range(1), ["ID", "name"]) == ["name"]


def test_a_line_is_split_once_however_many_fields_it_has(spark, tmp_path):
    rows = spark.createDataFrame([(1, "a", None), (2, "b\\n,c", "d"), (3, "", ",")], "id long, x string, y string")
    write_delimited(rows, str(tmp_path / "t"))
    read = scan_delimited(spark, str(tmp_path / "t"), rows.schema)
    assert values(read, "id", "x", "y") == values(rows, "id", "x", "y")
    # Once as it stands and once for lines with an escape, not for each field.
    assert read._jdf.queryExecution().optimizedPlan().toString().count("split(") == 2
    plain = scan_delimited(spark, str(tmp_path / "t"), rows.schema, escape=None)
    assert plain._jdf.queryExecution().optimizedPlan().toString().count("split(") == 1
