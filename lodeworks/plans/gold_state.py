"""Gold kept up to date by deltas of silver.

The state has one row per season and player, or season and team, with sums that can be
added to and taken from. A delta is the rows that silver got and the rows it lost, as a
merge reports them: the former count once, the latter minus once, so that a corrected
line takes its old share back. The published tables are made from the state alone.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame, functions as F

from lodeworks.plans.gold import MEASURES, with_player_name, team_seasons
from lodeworks.sources import storage
from lodeworks.sources.files import scan_parquet
from lodeworks.sources.sinks import partition_filter, replace_partitions, write_parquet
from lodeworks.sources.staging import staged

SEASON = "game_year"
_PLAYER = (SEASON, "personId", "playerName")
_TEAM = (SEASON, "team")
_ROWS = "rows_held"
_GAMES = "games_played"


def _total(measure: str) -> str:
    return f"total_{measure}"


def _known(measure: str) -> str:
    return f"known_{measure}"


def player_state(stats: DataFrame, measures: Mapping[str, str] = MEASURES) -> DataFrame:
    """Sums per season and player that can be added up: for every measure its total and the
    number of known values, which tells a total of none from a total of zero."""
    sums = [
        column
        for name, source in measures.items()
        for column in (
            F.coalesce(F.sum(source), F.lit(0)).alias(_total(name)),
            F.count(source).alias(_known(name)),
        )
    ]
    return (
        with_player_name(stats)
        .groupBy(*_PLAYER)
        .agg(*sums, F.count("gameId").alias(_GAMES), F.count(F.lit(1)).alias(_ROWS))
    )


def player_seasons_of(state: DataFrame, measures: Mapping[str, str] = MEASURES) -> DataFrame:
    """``gold.player_seasons`` from the state."""
    totals = [F.when(F.col(_known(m)) > 0, F.col(_total(m))).alias(_total(m)) for m in measures]
    return state.select(*_PLAYER, *totals, _GAMES)


def team_state(games: DataFrame) -> DataFrame:
    """Sums per season and team; all of them can be added up as they are."""
    return team_seasons(games).withColumn(_ROWS, F.col(_GAMES))


def team_seasons_of(state: DataFrame) -> DataFrame:
    """``gold.team_seasons`` from the state."""
    return state.drop(_ROWS)


def changed(
    state: DataFrame, added: DataFrame, removed: DataFrame, keys: tuple[str, ...]
) -> DataFrame:
    """The state after the shares of some rows were added and those of others taken away.

    All three have the columns of the state. Groups without rows leave it.
    """
    sums = [c for c in state.columns if c not in keys]
    minus = removed.select(*keys, *((-F.col(c)).alias(c) for c in sums))
    whole = state.unionByName(added).unionByName(minus)
    return (
        whole.groupBy(*keys)
        .agg(*(F.sum(c).cast(state.schema[c].dataType).alias(c) for c in sums))
        .filter(F.col(_ROWS) > 0)
    )


def update_state(path: str, added: DataFrame, removed: DataFrame, keys: tuple[str, ...]) -> DataFrame:
    """Bring the state at ``path`` up to date and return a scan of it.

    ``added`` and ``removed`` are states of the delta's rows. Only the seasons they touch
    are read and replaced. Unlike a merge, applying a delta twice counts it twice; the
    merge's report is empty when a delta is merged again.
    """
    spark = added.sparkSession
    added, removed = staged(added, "gold-added"), staged(removed, "gold-removed")
    if not storage.exists(spark, path):
        write_parquet(added, path, partition_by=[SEASON])
        return scan_parquet(spark, path, added.schema).select(*added.columns)
    present = scan_parquet(spark, path, added.schema).select(*added.columns)
    seasons = added.select(SEASON).union(removed.select(SEASON)).distinct().collect()
    if seasons:
        here = present.filter(partition_filter(seasons, [SEASON]))
        fresh = staged(changed(here, added, removed, keys), "gold-state")
        replace_partitions(fresh, path, [SEASON], seasons)
    return scan_parquet(spark, path, added.schema).select(*added.columns)


def update_players(path: str, added: DataFrame, removed: DataFrame) -> DataFrame:
    """Player state after box scores came into silver and left it."""
    return update_state(path, player_state(added), player_state(removed), _PLAYER)


def update_teams(path: str, added: DataFrame, removed: DataFrame) -> DataFrame:
    """Team state after games came into silver and left it."""
    return update_state(path, team_state(added), team_state(removed), _TEAM)
