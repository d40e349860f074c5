"""Steps that several queries share are done once, by many tasks, in compiled code."""

import __spark_entry__ as driver
from lodeworks import jobs
from lodeworks.plans import star
from lodeworks.sources import storage
from workload import ingest_queries, star_queries, upkeep_queries

SF_DIR = "/root/testdata/sf0.001"


def plan_of(df):
    return df._jdf.queryExecution().optimizedPlan().toString()


def test_queries_ask_for_small_methods(spark):
    spark.conf.unset("spark.sql.codegen.hugeMethodLimit")
    driver.queries()["quarantine_games"](spark, SF_DIR)
    assert spark.conf.get("spark.sql.codegen.hugeMethodLimit") == "8000"


def test_queries_ask_for_small_scans(spark):
    key = "spark.sql.files.maxPartitionBytes"
    spark.conf.unset(key)
    driver.queries()["fact_stats"](spark, SF_DIR)
    assert spark.conf.get(key) == "16m"
    spark.conf.set(key, "32m")
    driver.queries()["fact_stats"](spark, SF_DIR)
    assert spark.conf.get(key) == "32m"
    spark.conf.unset(key)


def test_a_delivery_is_written_by_many_tasks(spark):
    rows = spark.range(0, 1000, 1, 4)
    (path, _), = upkeep_queries._landing(spark, "landing-test", [rows])
    assert len(storage.files_below(spark, path)) == 4


def test_deliveries_are_parts_of_staged_bronze(spark):
    for deltas in (upkeep_queries._game_deltas, upkeep_queries._line_deltas):
        for delta in deltas(spark, SF_DIR):
            assert "Join" not in plan_of(delta)


def test_outdated_versions_with_bad_dates_do_not_fail(spark):
    for delta in upkeep_queries._game_deltas(spark, SF_DIR):
        assert "cast(substring" not in plan_of(delta).replace("try_cast", "")


def test_gold_sets_are_made_from_staged_seasons(spark):
    seasons = upkeep_queries._seasons(spark, SF_DIR)
    for table in upkeep_queries._gold_set(seasons, 1998).values():
        assert "l_orderkey" not in plan_of(table)


def test_silver_is_built_once_for_all_runs(spark, monkeypatch):
    plans = []
    write = ingest_queries.replace_parquet
    monkeypatch.setattr(
        ingest_queries, "replace_parquet", lambda rows, *a, **b: (plans.append(plan_of(rows)), write(rows, *a, **b))
    )
    ingest_queries._registered(spark, SF_DIR)
    assert len(plans) == 3 and not any("Window" in plan for plan in plans)


def test_a_sink_takes_only_the_silver_it_is_made_from(spark, monkeypatch):
    written = []
    write = star_queries.write_parquet
    monkeypatch.setattr(
        star_queries, "write_parquet", lambda rows, path: (written.append(path), write(rows, path))
    )
    for name, (_, entities) in star.STAR.items():
        written.clear()
        query = star_queries.QUERIES[f"star_{name}"]
        assert query(spark, SF_DIR).count() > 0
        assert [path.rsplit("/", 1)[1] for path in written] == list(entities)


def test_star_job_writes_the_named_tables(spark, tmp_path):
    players = star_queries.silver_players(spark, SF_DIR).silver
    players.write.parquet(f"{tmp_path}/silver/players")
    jobs.main(
        ["star", "--silver-root", f"{tmp_path}/silver", "--gold-root", f"{tmp_path}/gold"]
        + ["--table", "dim_players"]
    )
    assert [path.name for path in (tmp_path / "gold").iterdir()] == ["dim_players"]
    assert spark.read.parquet(f"{tmp_path}/gold/dim_players").count() == players.count()
