"""Laws that hold for any input, including heavily skewed input."""

from hypothesis import HealthCheck, given, settings, strategies as st
from pyspark.sql import functions as F

from build import AS_OF, RUN_TS, bronze, values
from lodeworks.contracts import TEAM_STATISTICS
from lodeworks.operators.checks import assert_tables_equal
from lodeworks.operators.dedup import keep_latest
from lodeworks.plans import gold, star
from lodeworks.plans.silver import build_silver, clean

_some = lambda values: st.one_of(st.none(), values)
_row = st.fixed_dictionaries(
    {
        "gameId": _some(st.integers(1, 3)),
        "teamId": _some(st.integers(1, 3)),
        "teamScore": _some(st.integers(-2, 5)),
        "opponentScore": _some(st.integers(-1, 5)),
        "gameDateTimeEst": _some(
            st.sampled_from(["2020-01-01 10:00:00", "2020-01-02 10:00:00", "NA", "bad"])
        ),
        "teamName": _some(st.sampled_from([" owls ", "NULL", "bees", ""])),
        "fieldGoalsPercentage": _some(st.sampled_from([-1.0, 0.0, 50.0, 100.0, 101.0])),
    }
)
_quick = settings(
    max_examples=8, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture]
)


@_quick
@given(rows=st.lists(_row, min_size=1, max_size=25))
def test_every_row_is_accounted_for(spark, rows):
    df = bronze(spark, TEAM_STATISTICS, *rows)
    out = build_silver(
        df, TEAM_STATISTICS, as_of=AS_OF, run_ts=RUN_TS, on_unknown="quarantine"
    )
    silver, rejected = out.silver.collect(), out.quarantine.count()
    keys = {(r["gameId"], r["teamId"]) for r in silver}
    assert len(keys) == len(silver)
    good = [
        r
        for r in rows
        if r["gameId"] is not None
        and r["teamId"] is not None
        and (r["teamScore"] or 0) >= 0
        and (r["opponentScore"] or 0) >= 0
        and None not in (r["teamScore"], r["opponentScore"])
        and 0 <= (r["fieldGoalsPercentage"] or 0) <= 100
    ]
    assert rejected == len(rows) - len(good)
    assert keys == {(r["gameId"], r["teamId"]) for r in good}


@_quick
@given(rows=st.lists(_row, min_size=1, max_size=10))
def test_cleaning_twice_changes_nothing(spark, rows):
    once = clean(bronze(spark, TEAM_STATISTICS, *rows), TEAM_STATISTICS)
    # Trimming can uncover a token, so only rows without padding are compared.
    again = clean(once.select(*TEAM_STATISTICS.bronze.fieldNames()), TEAM_STATISTICS)
    assert_tables_equal(again, once)


def test_a_key_with_a_third_of_all_rows(spark):
    rows = spark.range(30_000).selectExpr(
        "CASE WHEN id % 3 = 0 THEN 0 ELSE id END AS k", "id AS t", "id % 7 AS v"
    )
    kept = keep_latest(rows.repartition(16), ["k"], ["t"])
    assert kept.count() == 20_001
    assert values(kept.filter("k = 0"), "t") == [(29_997,)]


def test_gold_and_fact_with_a_hot_player_and_game(spark):
    hot = "CASE WHEN id % 3 = 0 THEN 0 ELSE id % 1000 END"
    lines = spark.range(30_000).selectExpr(
        f"CAST({hot} AS INT) AS gameId", "CAST(id AS BIGINT) AS personId", "'a' AS firstName",
        "'b' AS lastName", "'OWLS' AS playerteamName", "'x' AS playerteamcity",
        "'y' AS opponentteamname", "'y' AS opponentteamcity", "current_date() AS game_date",
        "2020 AS game_year", "1 AS game_month", "1 AS home", "1 AS win", "2 AS points",
        "3 AS assists", "1 AS steals", "1 AS blocks", "1.0 AS numminutes",
        "1.0 AS reboundsoffensive", "1.0 AS reboundsdefensive", "1.0 AS fieldgoalspercentage",
        "1.0 AS threepointerspercentage", "1.0 AS freethrowspercentage",
    )
    others = [n for n in star.FACT_FROM_TEAMS if n != "score_diff"]
    teams = spark.range(1000).selectExpr(
        "CAST(id AS INT) AS gameid", "'OWLS' AS teamname", "CAST(id AS INT) AS score_diff",
        *(f"0 AS {n}" for n in others),
    )
    fact = star.fact_stats(lines, teams)
    assert fact.count() == 30_000
    expected = sum(0 if i % 3 == 0 else i % 1000 for i in range(30_000))
    assert fact.agg(F.sum("score_diff")).first()[0] == expected

    busy = lines.withColumn("personId", F.expr("personId % 3"))
    assert values(gold.player_per_game(busy, "points"), "personId", "total_points") == [
        (0, 20_000), (1, 20_000), (2, 20_000),
    ]


def test_an_oversized_join_partition_is_split(spark):
    """Adaptive execution cuts a hot game into several tasks."""
    changed = {
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "64KB",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "128KB",
        "spark.sql.shuffle.partitions": "32",
    }
    before = {key: spark.conf.get(key, None) for key in changed}
    for key, value in changed.items():
        spark.conf.set(key, value)
    try:
        names = [n for n in star.FACT_COLUMNS if n not in star.FACT_FROM_TEAMS]
        made = ("gameid", "personid", "rebounds", "teamname", "teamcity")
        plain = [n for n in names if n not in made]
        lines = spark.range(0, 200_000, 1, 16).selectExpr(
            "CASE WHEN id % 3 = 0 THEN 0 ELSE id END AS gameid", "id AS personid",
            "'t' AS playerteamname", "'c' AS playerteamcity", "id AS reboundsoffensive",
            "1L AS reboundsdefensive", *(f"id * 31 AS {n}" for n in plain),
        )
        teams = spark.range(0, 200_000, 1, 16).selectExpr(
            "id AS gameid", "'t' AS teamname", *(f"id AS {n}" for n in star.FACT_FROM_TEAMS)
        )
        fact = star.fact_stats(lines, teams)
        execution = fact._jdf.queryExecution()
        assert execution.toRdd().count() == 200_000
        assert "skew=true" in execution.executedPlan().toString()
    finally:
        for key, value in before.items():
            spark.conf.unset(key) if value is None else spark.conf.set(key, value)
