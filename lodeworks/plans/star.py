"""Silver -> dimensions and fact."""

from __future__ import annotations

from collections.abc import Iterable, Mapping

from pyspark.sql import DataFrame, functions as F

# Columns of the published dimensions and of the fact, in order.
PLAYER_COLUMNS = (
    "personid",
    "firstname",
    "lastname",
    "country",
    "height",
    "bodyweight",
    "age_years",
    "primary_position",
)
TEAM_COLUMNS = ("teamid", "teamname", "teamcity", "team_full_name", "league")
GAME_COLUMNS = (
    "gameid",
    "gametype",
    "attendance",
    "arenaid",
    "home_win",
    "away_win",
    "homescore",
    "awayscore",
    "winner",
)
FACT_FROM_TEAMS = (
    "q1points",
    "q4points",
    "benchpoints",
    "biggestlead",
    "biggestscoringrun",
    "leadchanges",
    "score_diff",
    "shooting_efficiency",
)
FACT_COLUMNS = (
    "gameid",
    "personid",
    "teamname",
    "teamcity",
    "opponentteamname",
    "opponentteamcity",
    "game_date",
    "game_year",
    "game_month",
    "home",
    "win",
    "points",
    "assists",
    "rebounds",
    "steals",
    "blocks",
    "numminutes",
    *FACT_FROM_TEAMS,
    "fieldgoalspercentage",
    "threepointerspercentage",
    "freethrowspercentage",
)


#: The join keys of the fact on either side, in the order in which both are bucketed.
FACT_KEYS = {
    "player_statistics": ("gameId", "playerteamName"),
    "team_statistics": ("gameId", "teamName"),
}


def dim_players(players: DataFrame) -> DataFrame:
    return players.select(*PLAYER_COLUMNS)


def dim_teams(team_histories: DataFrame) -> DataFrame:
    return team_histories.select(*TEAM_COLUMNS)


def dim_games(games: DataFrame) -> DataFrame:
    return games.select(*GAME_COLUMNS)


def dim_dates(games: DataFrame, distinct: bool = False) -> DataFrame:
    """Calendar attributes, one row per game, or per date if ``distinct``."""
    dates = games.select("game_date", "game_year", "game_month")
    if distinct:
        dates = dates.distinct()
    return dates.withColumns(
        {"week": F.weekofyear("game_date"), "quarter_of_year": F.quarter("game_date")}
    )


def fact_stats(
    player_statistics: DataFrame,
    team_statistics: DataFrame,
    games: DataFrame | None = None,
    co_located: bool = False,
) -> DataFrame:
    """Player lines widened by the line of their team in the same game.

    No join strategy is forced. Spark broadcasts the team side only when its
    measured size is below the session threshold; otherwise both sides shuffle
    on (game, team) and adaptive execution splits an oversized player partition,
    which a left join allows.

    ``games`` takes part only as a further left join of which no column is kept.
    It changes nothing while game ids are unique there, so callers leave it out
    unless they need the row multiplication of a table with repeated ids.

    ``co_located`` is for tables that are bucketed alike by game and team (see
    ``sinks.write_bucketed`` and ``FACT_KEYS``): they are merged as they lie, with nothing
    shuffled or broadcast.
    """
    team = team_statistics.select(
        F.col("gameid").alias("team_gameid"),
        F.col("teamname").alias("team_teamname"),
        *FACT_FROM_TEAMS,
    )
    lines = player_statistics.withColumnsRenamed(
        {"playerteamname": "teamname", "playerteamcity": "teamcity"}
    ).withColumn("rebounds", F.try_add(F.col("reboundsoffensive"), F.col("reboundsdefensive")))
    if co_located:
        team = team.hint("merge")
    own = [name for name in FACT_COLUMNS if name not in FACT_FROM_TEAMS]
    fact = lines.select(*own).join(
        team,
        (F.col("gameid") == F.col("team_gameid")) & (F.col("teamname") == F.col("team_teamname")),
        "left",
    )
    if games is not None:
        fact = fact.join(games.select("gameid"), "gameid", "left")
    return fact.select(*FACT_COLUMNS)


#: The published tables by directory name: what builds each, from which silver entities.
STAR = {
    "dim_players": (dim_players, ("players",)),
    "dim_teams": (dim_teams, ("team_histories",)),
    "dim_games": (dim_games, ("games",)),
    "dim_dates": (dim_dates, ("games",)),
    "fact_nba_stats": (fact_stats, ("player_statistics", "team_statistics")),
}


def sources(names: Iterable[str]) -> list[str]:
    """The silver entities that the named tables are made from."""
    return list(dict.fromkeys(entity for name in names for entity in STAR[name][1]))


def star_table(name: str, silver: Mapping[str, DataFrame]) -> DataFrame:
    """One published table from silver by entity; others than its own are not looked at."""
    build, entities = STAR[name]
    return build(*(silver[entity] for entity in entities))


def star_tables(
    games: DataFrame,
    players: DataFrame,
    player_statistics: DataFrame,
    team_histories: DataFrame,
    team_statistics: DataFrame,
) -> dict[str, DataFrame]:
    """The four dimensions and the fact, keyed by directory name."""
    silver = {
        "games": games,
        "players": players,
        "player_statistics": player_statistics,
        "team_histories": team_histories,
        "team_statistics": team_statistics,
    }
    return {name: star_table(name, silver) for name in STAR}
