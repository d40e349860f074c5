"""Plain plans against the ones this library builds, on the same staged inputs.

Inputs are written once as parquet with several files, so the figures show the
operators rather than the preparation of their input. Prints one JSON line with
``[plain, built]`` seconds per case (best of three).
"""

from __future__ import annotations

import json
import os
import time

from pyspark.sql import functions as F

from bench import _session
from lodeworks.contracts import PLAYER_STATISTICS, PLAYERS
from lodeworks.operators.checks import check_table
from lodeworks.operators.quality import REASON, quarantined
from lodeworks.plans import gold, star
from lodeworks.plans.silver import build_silver, clean
from lodeworks.sources.staging import staged
from workload import roles

RUNS = 3


def _noop(df) -> None:
    df.write.format("noop").mode("overwrite").save()


def _best(action) -> float:
    times = []
    for _ in range(RUNS + 1):
        started = time.perf_counter()
        action()
        times.append(time.perf_counter() - started)
    return round(min(times[1:]), 3)


def _win_rate_by_union(games):
    sides = [
        games.select("game_year", F.col(team).alias("team"), (F.col(a) > F.col(b)).alias("won"))
        for team, a, b in (
            ("homeTeamName", "homeScore", "awayScore"),
            ("awayTeamName", "awayScore", "homeScore"),
        )
    ]
    rows = sides[0].union(sides[1])
    return rows.groupBy("game_year", "team").agg(F.count_if("won"), F.count(F.lit(1)))


def _quarantine_by_union(bronze):
    cleaned = clean(bronze, PLAYER_STATISTICS)
    keys, ranges = (check.passes(F.current_date()) for check in PLAYER_STATISTICS.checks)
    return cleaned.filter(~keys).withColumn(REASON, F.lit("MISSING_KEYS")).unionByName(
        cleaned.filter(keys & ~ranges).withColumn(REASON, F.lit("INVALID_NUMERIC_RANGE"))
    )


def _quarantine(bronze):
    return quarantined(
        clean(bronze, PLAYER_STATISTICS), PLAYER_STATISTICS.checks, F.current_date()
    )


def _gold_direct(stats, games):
    for table in gold.gold_tables(stats, games).values():
        _noop(table)


def _gold_shared(stats, games):
    shared = gold.gold_tables_from_seasons(
        staged(gold.player_seasons(stats), "players"), staged(gold.team_seasons(games), "teams")
    )
    for table in shared.values():
        _noop(table)


def _checks_one_by_one(stats, columns):
    for name in columns:
        stats.filter(F.col(name).isNull()).count()
        stats.filter(F.col(name) < 0).count()


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    spark = _session(os.environ.get("BENCH_CPUS", "8"))

    def stage(role, *names):
        return staged(role.frame(spark, sf_dir, *names).repartition(8), "bench")

    games = stage(
        roles.GAMES, "gameid", "game_year", "homeTeamName", "awayTeamName", "homeScore", "awayScore"
    )
    stats = stage(roles.PLAYER_STATISTICS)
    lines = stage(roles.BRONZE_PLAYER_STATISTICS)
    people = stage(roles.BRONZE_PLAYERS)
    names = [n for n in star.FACT_FROM_TEAMS if n != "score_diff"]
    teams = staged(
        stats.groupBy(F.col("gameId").alias("gameid"), F.col("playerteamName").alias("teamname"))
        .agg(F.max("points").alias("score_diff"))
        .selectExpr("*", *(f"1 AS {n}" for n in names)),
        "bench",
    )
    numbers = ["points", "assists", "blocks", "steals"]
    cases = {
        "home_away_unpivot": (
            lambda: _noop(_win_rate_by_union(games)),
            lambda: _noop(gold.team_win_percentage(games)),
        ),
        "quarantine": (
            lambda: _noop(_quarantine_by_union(lines)),
            lambda: _noop(_quarantine(lines)),
        ),
        "gold_set_of_eight": (
            lambda: _gold_direct(stats, games),
            lambda: _gold_shared(stats, games),
        ),
        "fact_without_unused_join": (
            lambda: _noop(star.fact_stats(stats, teams, games)),
            lambda: _noop(star.fact_stats(stats, teams)),
        ),
        "checks_in_one_pass": (
            lambda: _checks_one_by_one(stats, numbers),
            lambda: check_table(stats, not_null=numbers, non_negative=numbers).collect(),
        ),
    }
    seconds = {name: [_best(plain), _best(built)] for name, (plain, built) in cases.items()}
    seconds["silver_player_statistics"] = [
        None, _best(lambda: _noop(build_silver(lines, PLAYER_STATISTICS).silver))
    ]
    seconds["silver_players"] = [None, _best(lambda: _noop(build_silver(people, PLAYERS).silver))]
    print(json.dumps({"unit": "sec", "plain_and_built": seconds, "sf": os.path.basename(sf_dir)}))
    spark.stop()


if __name__ == "__main__":
    main()
