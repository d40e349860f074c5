"""Dimensions and fact over silver tables built from the bronze roles."""

from __future__ import annotations

from lodeworks.jobs import run_star
from lodeworks.plans import star
from lodeworks.sources.files import scan_parquet
from lodeworks.sources.sinks import write_parquet
from lodeworks.sources.staging import fresh_path, rounds_for, staged_in_rounds
from workload import roles
from workload.silver_queries import (
    ORACLE as SILVER_SQL,
    SILVER_TEAM_STATISTICS_SQL,
    silver_games,
    silver_histories,
    silver_player_statistics,
    silver_players,
    silver_team_statistics,
)

_LINES = roles.PLAYER_STATISTICS
_LINE_COLUMNS = tuple(
    name for name in _LINES.columns if name not in ("firstName", "lastName", "reboundstotal")
)


def _dim(build, source):
    return lambda spark, sf_dir: build(source(spark, sf_dir).silver)


def _dim_sql(columns, silver):
    named = ", ".join(f"{name} AS {name}" for name in columns)
    return f"SELECT {named} FROM ({SILVER_SQL[silver]}) AS s"


def _in_rounds(fact):
    """Large facts game by game: all shuffles of one execution are on disk together."""
    rounds = rounds_for(fact.sparkSession, fact.inputFiles())
    return fact if rounds == 1 else staged_in_rounds(fact, "fact", ["gameid"], rounds)


def _fact(spark, sf_dir):
    teams = silver_team_statistics(spark, sf_dir).silver
    return _in_rounds(star.fact_stats(_LINES.frame(spark, sf_dir, *_LINE_COLUMNS), teams))


def _fact_with_games(spark, sf_dir):
    teams = silver_team_statistics(spark, sf_dir).silver
    lines = _LINES.frame(spark, sf_dir, *_LINE_COLUMNS)
    # Lines carry the order's number, games that number times eight and the line's.
    games = silver_games(spark, sf_dir).silver.selectExpr("gameid DIV 8 AS gameid").distinct()
    return _in_rounds(star.fact_stats(lines, teams, games))


def _fact_from_silver(spark, sf_dir):
    lines = silver_player_statistics(spark, sf_dir).silver
    return star.fact_stats(lines, silver_team_statistics(spark, sf_dir).silver)


_SILVER = {
    "games": silver_games,
    "players": silver_players,
    "player_statistics": silver_player_statistics,
    "team_histories": silver_histories,
    "team_statistics": silver_team_statistics,
}


def _published(name):
    """A sink of the star job, read back from where the job wrote it.

    Silver is built for the entities that this sink is made from, all rows and columns.
    """

    def query(spark, sf_dir):
        root = fresh_path(spark, "star")
        for entity in star.sources([name]):
            write_parquet(_SILVER[entity](spark, sf_dir).silver, f"{root}/silver/{entity}")
        run_star(spark, f"{root}/silver", f"{root}/gold", [name])
        return scan_parquet(spark, f"{root}/gold/{name}")

    return query


def _fact_sql(lines=None):
    own = {"teamname": "playerteamName", "teamcity": "playerteamCity"}
    own["rebounds"] = "ps.reboundsOffensive + ps.reboundsDefensive"
    columns = ", ".join(
        f"ts.{name} AS {name}"
        if name in star.FACT_FROM_TEAMS
        else f"{own.get(name, 'ps.' + name)} AS {name}"
        for name in star.FACT_COLUMNS
    )
    return f"""
        SELECT {columns} FROM ({lines or _LINES.sql(*_LINE_COLUMNS)}) AS ps
        LEFT JOIN ({SILVER_TEAM_STATISTICS_SQL}) AS ts
          ON ps.gameId = ts.gameId AND ps.playerteamName = ts.teamName"""


_DATES_SQL = """
    SELECT {distinct} game_date, game_year, game_month,
           CAST(weekofyear(game_date) AS INT) AS week,
           CAST(quarter(game_date) AS INT) AS quarter_of_year
    FROM ({games}) AS g"""

#: Directories of the star job and the queries that have the same rows.
_SINKS = {
    "dim_players": "dim_players",
    "dim_teams": "dim_teams",
    "dim_games": "dim_games",
    "dim_dates": "dim_dates",
    "fact_nba_stats": "fact_from_silver",
}

QUERIES = {
    "dim_players": _dim(star.dim_players, silver_players),
    "dim_teams": _dim(star.dim_teams, silver_histories),
    "dim_games": _dim(star.dim_games, silver_games),
    "dim_dates": _dim(star.dim_dates, silver_games),
    "dim_dates_distinct": _dim(lambda g: star.dim_dates(g, distinct=True), silver_games),
    "fact_stats": _fact,
    "fact_stats_with_games": _fact_with_games,
    "fact_from_silver": _fact_from_silver,
    **{f"star_{name}": _published(name) for name in _SINKS},
}

ORACLE = {
    "dim_players": _dim_sql(star.PLAYER_COLUMNS, "silver_players"),
    "dim_teams": _dim_sql(star.TEAM_COLUMNS, "silver_team_histories"),
    "dim_games": _dim_sql(star.GAME_COLUMNS, "silver_games"),
    "dim_dates": _DATES_SQL.format(distinct="", games=SILVER_SQL["silver_games"]),
    "dim_dates_distinct": _DATES_SQL.format(
        distinct="DISTINCT", games=SILVER_SQL["silver_games"]
    ),
    "fact_stats": _fact_sql(),
    "fact_stats_with_games": _fact_sql(),
    "fact_from_silver": _fact_sql(SILVER_SQL["silver_player_statistics"]),
}
ORACLE |= {f"star_{name}": ORACLE[same] for name, same in _SINKS.items()}
