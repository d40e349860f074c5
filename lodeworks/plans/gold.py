"""Silver -> gold aggregates."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from lodeworks.functions.numeric import flag
from lodeworks.functions.text import joined_name
from lodeworks.operators.unpivot import sides_to_rows

# Names of the published tables and of the measures in them, and
# the margin that makes a win a double-digit one.
MEASURES = {"points": "points", "assists": "assists", "rebounds": "reboundstotal"}
SLICE_MEASURES = ("points", "assists", "blocks", "steals")
DOUBLE_DIGITS = 10
PER_GAME_TABLE = "player_{}_per_game_gold"
PER_SEASON_TABLE = "player_total_{}_per_season_gold"
WIN_TABLE = "team_win_percentage_gold"
DOUBLE_DIGIT_TABLE = "team_double_digit_wins_per_season_gold"

_PLAYER = ("personId", "playerName")
_PLAYER_SEASON = ("game_year", *_PLAYER)
_GAMES = "games_played"


def with_player_name(stats: DataFrame) -> DataFrame:
    return stats.withColumn("playerName", joined_name(F.col("firstName"), F.col("lastName")))


def _total(measure: str) -> str:
    return f"total_{measure}"


# -- players ---------------------------------------------------------------


def player_seasons(stats: DataFrame, measures: dict[str, str] | None = None) -> DataFrame:
    """Per player and season: the totals and the number of games."""
    measures = MEASURES if measures is None else measures
    return (
        with_player_name(stats)
        .groupBy(*_PLAYER_SEASON)
        .agg(
            *(F.sum(source).alias(_total(name)) for name, source in measures.items()),
            F.count("gameId").alias(_GAMES),
        )
    )


def _rate(df: DataFrame, measure: str) -> DataFrame:
    """Players with at least one game, with total, games and average."""
    total = _total(measure)
    return df.filter(F.col(_GAMES) > 0).select(
        *_PLAYER,
        total,
        _GAMES,
        (F.col(total) / F.col(_GAMES)).alias(f"{measure}_per_game"),
    )


def player_per_game(stats: DataFrame, measure: str) -> DataFrame:
    """Career average of one measure, straight from the box scores."""
    grouped = with_player_name(stats).groupBy(*_PLAYER)
    return _rate(
        grouped.agg(
            F.sum(MEASURES[measure]).alias(_total(measure)),
            F.count("gameId").alias(_GAMES),
        ),
        measure,
    )


def player_per_game_from_seasons(seasons: DataFrame, measure: str) -> DataFrame:
    """The same from season totals, which are far fewer rows."""
    total = _total(measure)
    careers = seasons.groupBy(*_PLAYER).agg(
        F.sum(total).alias(total), F.sum(_GAMES).alias(_GAMES)
    )
    return _rate(careers, measure)


def _season_table(seasons: DataFrame, measure: str) -> DataFrame:
    total = _total(measure)
    table = seasons.select(*_PLAYER_SEASON, total)
    if measure != "rebounds":
        return table
    # The key columns extend the published order so that equal totals do not
    # all land in one range partition.
    return table.orderBy("game_year", F.col(total).desc(), *_PLAYER)


def player_season_totals(stats: DataFrame, measure: str) -> DataFrame:
    """Season totals of one measure; the rebounds table comes ordered."""
    return _season_table(player_seasons(stats, {measure: MEASURES[measure]}), measure)


# -- teams -----------------------------------------------------------------


def _side(team: str, own: str, other: str) -> dict[str, Column]:
    margin = F.col(own) - F.col(other)
    return {
        "team": F.col(team),
        "win": flag(F.col(own) > F.col(other)),
        "double_digit_win": flag(margin >= DOUBLE_DIGITS),
    }


def team_seasons(games: DataFrame) -> DataFrame:
    """Per team and season: games, wins and double-digit wins, in one scan."""
    rows = sides_to_rows(
        games,
        ("game_year",),
        (
            _side("homeTeamName", "homeScore", "awayScore"),
            _side("awayTeamName", "awayScore", "homeScore"),
        ),
    )
    return rows.groupBy("game_year", "team").agg(
        F.sum("win").alias("wins"),
        F.count(F.lit(1)).alias(_GAMES),
        F.sum("double_digit_win").alias("double_digit_wins"),
    )


def _win_table(seasons: DataFrame) -> DataFrame:
    return seasons.select(
        "game_year",
        F.col("team").alias("teamId"),
        "wins",
        _GAMES,
        (F.col("wins").cast("double") / F.col(_GAMES)).alias("win_percentage"),
    )


def _double_digit_table(seasons: DataFrame) -> DataFrame:
    return seasons.select("game_year", "team", "double_digit_wins").orderBy(
        "game_year", F.col("double_digit_wins").desc(), "team"
    )


def team_win_percentage(games: DataFrame) -> DataFrame:
    return _win_table(team_seasons(games))


def team_double_digit_wins(games: DataFrame) -> DataFrame:
    return _double_digit_table(team_seasons(games))


# -- the published set -----------------------------------------------------


def gold_tables(stats: DataFrame, games: DataFrame) -> dict[str, DataFrame]:
    """Every published table, each straight from silver. Lazy, no I/O."""
    return {
        **{PER_GAME_TABLE.format(name): player_per_game(stats, name) for name in MEASURES},
        **{
            PER_SEASON_TABLE.format(name): player_season_totals(stats, name)
            for name in MEASURES
        },
        WIN_TABLE: team_win_percentage(games),
        DOUBLE_DIGIT_TABLE: team_double_digit_wins(games),
    }


def gold_tables_from_seasons(players: DataFrame, teams: DataFrame) -> dict[str, DataFrame]:
    """The same set from ``player_seasons`` and ``team_seasons``.

    With those two written out first, eight tables cost one pass over each
    silver table instead of eight passes.
    """
    return {
        **{
            PER_GAME_TABLE.format(name): player_per_game_from_seasons(players, name)
            for name in MEASURES
        },
        **{PER_SEASON_TABLE.format(name): _season_table(players, name) for name in MEASURES},
        WIN_TABLE: _win_table(teams),
        DOUBLE_DIGIT_TABLE: _double_digit_table(teams),
    }


# -- one team, one season --------------------------------------------------


def team_season_slice(stats: DataFrame, team: str, season: int) -> DataFrame:
    """Box scores of one team in one season; both filters reach the scan."""
    return stats.filter((F.col("game_year") == season) & (F.col("playerteamname") == team))


def slice_summary(
    stats: DataFrame, team: str, season: int, measures: tuple[str, ...] = SLICE_MEASURES
) -> DataFrame:
    """Totals, games and averages of the measures for one team and season."""
    games = f"{_GAMES}_{season}"
    sums = (F.sum(name).alias(f"total_{name}_{season}") for name in measures)
    grouped = (
        with_player_name(team_season_slice(stats, team, season))
        .groupBy(*_PLAYER)
        .agg(*sums, F.count("gameId").alias(games))
        .filter(F.col(games) > 0)
    )
    return grouped.withColumns(
        {
            f"{name}_per_game_{season}": F.col(f"total_{name}_{season}") / F.col(games)
            for name in measures
        }
    )


def slice_points(stats: DataFrame, team: str, season: int) -> DataFrame:
    """Points per game of the slice, under that table's own column names."""
    summary = slice_summary(stats, team, season, ("points",))
    return summary.select(
        F.col("personId").alias("personid"),
        "playerName",
        F.col(f"total_points_{season}").alias("points"),
        F.col(f"{_GAMES}_{season}").alias("gameid"),
        f"points_per_game_{season}",
    )
