"""The plans are the ones meant to run at scale."""

import pytest

import __spark_entry__ as driver
from build import bronze
from lodeworks.contracts import CONTRACTS, TEAM_STATISTICS
from lodeworks.plans import gold
from lodeworks.plans.silver import build_silver
from lodeworks.sources.sinks import write_parquet
from lodeworks.streaming.incremental import newer_than
from workload import roles

SF_DIR = "/root/testdata/sf0.001"


def physical(df):
    return df._jdf.queryExecution().executedPlan().toString()


def optimized(df):
    return df._jdf.queryExecution().optimizedPlan().toString()


@pytest.fixture(scope="module", params=sorted(CONTRACTS))
def silver_tables(request, spark, tmp_path_factory):
    contract = CONTRACTS[request.param]
    path = str(tmp_path_factory.mktemp("bronze") / request.param)
    write_parquet(bronze(spark, contract, {}), path)
    return contract, build_silver(spark.read.parquet(path), contract)


def test_silver_needs_one_shuffle_and_limits_groups_before_it(silver_tables):
    _, tables = silver_tables
    plan = physical(tables.silver)
    assert plan.count("Exchange hashpartitioning") == 1
    below = plan.split("Exchange hashpartitioning")[1]
    assert "WindowGroupLimit" in below and "Partial" in below
    assert plan.count("FileScan") == 1


def test_key_checks_reach_the_scan(silver_tables):
    contract, tables = silver_tables
    for key in contract.latest.keys:
        assert f"IsNotNull({key})" in physical(tables.silver)


def test_quarantine_is_one_scan_without_shuffle(silver_tables):
    _, tables = silver_tables
    plan = physical(tables.quarantine)
    assert "Exchange" not in plan and "Union" not in plan and plan.count("FileScan") == 1


def test_home_and_away_come_from_one_scan(spark, tmp_path):
    path = str(tmp_path / "games")
    columns = ("game_year", "homeTeamName", "awayTeamName", "homeScore", "awayScore")
    write_parquet(roles.GAMES.frame(spark, SF_DIR, *columns), path)
    plan = physical(gold.team_win_percentage(spark.read.parquet(path)))
    assert plan.count("FileScan") == 1 and "Union" not in plan
    assert plan.count("Exchange hashpartitioning") == 1


def test_gold_reads_only_its_columns(spark, tmp_path):
    path = str(tmp_path / "lines")
    write_parquet(roles.PLAYER_STATISTICS.frame(spark, SF_DIR), path)
    lines = spark.read.parquet(path)
    schema = physical(gold.player_per_game(lines, "points")).split("ReadSchema")[1]
    for name in ("personId", "gameId", "firstName", "lastName", "points"):
        assert name in schema
    for name in ("assists", "playerteamName", "numMinutes"):
        assert name not in schema


def test_slice_filters_reach_the_scan(spark, tmp_path):
    path = str(tmp_path / "lines")
    write_parquet(roles.PLAYER_STATISTICS.frame(spark, SF_DIR), path)
    plan = physical(gold.slice_summary(spark.read.parquet(path), "NATION_7", 1997))
    pushed = plan.split("PushedFilters")[1].lower()
    assert "equalto(game_year,1997)" in pushed and "equalto(playerteamname" in pushed


def test_watermark_reaches_the_scan(spark):
    events = roles.load(spark, SF_DIR, "events")
    assert "GreaterThan(ts" in physical(newer_than(events, "ts", "2024-01-01 12:00:00"))


def test_unused_game_join_is_absent(spark):
    assert optimized(driver.queries()["fact_stats"](spark, SF_DIR)).count("LeftOuter") == 1


def test_wide_contract_plans_quickly(spark, tmp_path):
    """Planning must not blow up with the number of columns and rules."""
    import time

    path = str(tmp_path / "t")
    write_parquet(bronze(spark, TEAM_STATISTICS, {}), path)
    started = time.perf_counter()
    physical(build_silver(spark.read.parquet(path), TEAM_STATISTICS).silver)
    assert time.perf_counter() - started < 20
