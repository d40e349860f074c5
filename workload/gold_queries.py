"""Gold aggregates over the tidy roles."""

from __future__ import annotations

from lodeworks.operators.audit import row_counts
from lodeworks.plans import gold
from lodeworks.sources.staging import staged
from workload.roles import GAMES, PLAYER_STATISTICS

_PLAYER = ("personId", "gameId", "firstName", "lastName")
_TEAMS = ("game_year", "homeTeamName", "awayTeamName", "homeScore", "awayScore")
_ALL_MEASURES = tuple(gold.MEASURES.values())
_SLICE_TEAM, _SLICE_SEASON = "NATION_7", 1997


def _stats(spark, sf_dir, *columns):
    return PLAYER_STATISTICS.frame(spark, sf_dir, *_PLAYER, *columns)


def _games(spark, sf_dir):
    return GAMES.frame(spark, sf_dir, *_TEAMS)


def _per_game(measure):
    return lambda spark, sf_dir: gold.player_per_game(
        _stats(spark, sf_dir, gold.MEASURES[measure]), measure
    )


def _per_game_sql(measure):
    source = gold.MEASURES[measure]
    return f"""
        SELECT personId, firstName || ' ' || lastName AS playerName,
               sum({source}) AS total_{measure}, count(gameId) AS games_played,
               sum({source}) / count(gameId) AS {measure}_per_game
        FROM ({PLAYER_STATISTICS.sql(*_PLAYER, source)}) AS s
        GROUP BY 1, 2 HAVING count(gameId) > 0"""


def _per_season(measure):
    return lambda spark, sf_dir: gold.player_season_totals(
        _stats(spark, sf_dir, "game_year", gold.MEASURES[measure]), measure
    )


def _per_season_sql(measure):
    source = gold.MEASURES[measure]
    return f"""
        SELECT game_year, personId, firstName || ' ' || lastName AS playerName,
               sum({source}) AS total_{measure}
        FROM ({PLAYER_STATISTICS.sql(*_PLAYER, "game_year", source)}) AS s
        GROUP BY 1, 2, 3 ORDER BY game_year, total_{measure} DESC"""


_SIDES_SQL = f"""
    WITH g AS ({GAMES.sql(*_TEAMS)}),
    sides AS (
        SELECT game_year, homeTeamName AS team, homeScore - awayScore AS margin FROM g
        UNION ALL
        SELECT game_year, awayTeamName, awayScore - homeScore FROM g
    )"""


def _slice(build):
    def query(spark, sf_dir):
        columns = ("game_year", "playerteamName", *gold.SLICE_MEASURES)
        return build(_stats(spark, sf_dir, *columns), _SLICE_TEAM, _SLICE_SEASON)

    return query


def _slice_sql(measures, names=None):
    year = _SLICE_SEASON
    names = names or {}
    games = names.get("games", f"games_played_{year}")
    sums = ", ".join(
        f"sum({m}) AS {names.get(m, f'total_{m}_{year}')}" for m in measures
    )
    rates = ", ".join(f"sum({m}) / count(gameId) AS {m}_per_game_{year}" for m in measures)
    columns = (*_PLAYER, "game_year", "playerteamName", *measures)
    return f"""
        SELECT personId AS {names.get("personId", "personId")},
               firstName || ' ' || lastName AS playerName,
               {sums}, count(gameId) AS {games}, {rates}
        FROM ({PLAYER_STATISTICS.sql(*columns)}) AS s
        WHERE game_year = {year} AND playerteamName = '{_SLICE_TEAM}'
        GROUP BY personId, firstName || ' ' || lastName HAVING count(gameId) > 0"""


def _one_measure(measure):
    return lambda stats, team, season: gold.slice_summary(stats, team, season, (measure,))


def _gold_set_counts(spark, sf_dir):
    """All eight tables from two staged aggregates, as row counts."""
    stats = _stats(spark, sf_dir, "game_year", *_ALL_MEASURES)
    tables = gold.gold_tables_from_seasons(
        staged(gold.player_seasons(stats), "player-seasons"),
        staged(gold.team_seasons(_games(spark, sf_dir)), "team-seasons"),
    )
    return row_counts(tables)


def _gold_set_counts_sql():
    players = PLAYER_STATISTICS.sql("personId", "game_year")
    parts = [
        f"SELECT '{gold.PER_GAME_TABLE.format(m)}' AS layer, "
        "count(DISTINCT personId) AS row_count FROM p"
        for m in gold.MEASURES
    ]
    parts += [
        f"SELECT '{gold.PER_SEASON_TABLE.format(m)}', "
        "count(DISTINCT (game_year, personId)) FROM p"
        for m in gold.MEASURES
    ]
    parts += [
        f"SELECT '{name}', count(DISTINCT (game_year, team)) FROM sides"
        for name in (gold.WIN_TABLE, gold.DOUBLE_DIGIT_TABLE)
    ]
    return f"{_SIDES_SQL}, p AS ({players}) " + " UNION ALL ".join(parts)


def _points_from_seasons(spark, sf_dir):
    stats = _stats(spark, sf_dir, "game_year", *_ALL_MEASURES)
    seasons = staged(gold.player_seasons(stats), "player-seasons")
    return gold.player_per_game_from_seasons(seasons, "points")


def _from_seasons(table):
    """A table of the set that the gold job publishes."""

    def query(spark, sf_dir):
        stats = _stats(spark, sf_dir, "game_year", *_ALL_MEASURES)
        return gold.gold_tables_from_seasons(
            staged(gold.player_seasons(stats), "player-seasons"),
            staged(gold.team_seasons(_games(spark, sf_dir)), "team-seasons"),
        )[table]

    return query


#: Published tables and the queries that have the same rows.
_PUBLISHED = {
    **{gold.PER_GAME_TABLE.format(m): f"player_{m}_per_game" for m in gold.MEASURES},
    **{gold.PER_SEASON_TABLE.format(m): f"player_total_{m}_per_season" for m in gold.MEASURES},
    gold.WIN_TABLE: "team_win_percentage",
    gold.DOUBLE_DIGIT_TABLE: "team_double_digit_wins",
}

QUERIES = {
    **{f"player_{m}_per_game": _per_game(m) for m in gold.MEASURES},
    **{f"player_total_{m}_per_season": _per_season(m) for m in gold.MEASURES},
    "team_win_percentage": lambda spark, sf_dir: gold.team_win_percentage(
        _games(spark, sf_dir)
    ),
    "team_double_digit_wins": lambda spark, sf_dir: gold.team_double_digit_wins(
        _games(spark, sf_dir)
    ),
    "slice_points": _slice(gold.slice_points),
    **{f"slice_{m}": _slice(_one_measure(m)) for m in ("assists", "blocks", "steals")},
    "slice_summary": _slice(gold.slice_summary),
    "gold_set_row_counts": _gold_set_counts,
    "player_points_per_game_from_seasons": _points_from_seasons,
    **{f"published_{table}": _from_seasons(table) for table in _PUBLISHED},
}

ORACLE = {
    **{f"player_{m}_per_game": _per_game_sql(m) for m in gold.MEASURES},
    **{f"player_total_{m}_per_season": _per_season_sql(m) for m in gold.MEASURES},
    "team_win_percentage": f"""{_SIDES_SQL}
        SELECT game_year, team AS "teamId",
               sum(CASE WHEN margin > 0 THEN 1 ELSE 0 END)::BIGINT AS wins,
               count(*) AS games_played,
               sum(CASE WHEN margin > 0 THEN 1 ELSE 0 END)::DOUBLE / count(*) AS win_percentage
        FROM sides GROUP BY 1, 2""",
    "team_double_digit_wins": f"""{_SIDES_SQL}
        SELECT game_year, team,
               sum(CASE WHEN margin >= 10 THEN 1 ELSE 0 END)::BIGINT AS double_digit_wins
        FROM sides GROUP BY 1, 2 ORDER BY game_year, double_digit_wins DESC""",
    "slice_points": _slice_sql(
        ("points",), {"personId": "personid", "points": "points", "games": "gameid"}
    ),
    **{f"slice_{m}": _slice_sql((m,)) for m in ("assists", "blocks", "steals")},
    "slice_summary": _slice_sql(gold.SLICE_MEASURES),
    "gold_set_row_counts": _gold_set_counts_sql(),
    "player_points_per_game_from_seasons": _per_game_sql("points"),
}
ORACLE |= {f"published_{table}": ORACLE[same] for table, same in _PUBLISHED.items()}
