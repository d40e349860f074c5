"""Cleansing and derivation operators, each on its own."""

from __future__ import annotations

from pyspark.sql import functions as F

from lodeworks.contracts import GAMES, GAMES_BY_SEASON, PLAYERS, TEAM_HISTORIES, TEAM_STATISTICS
from lodeworks.contracts.games import outcome
from lodeworks.contracts.player_statistics import scoring_rate
from lodeworks.contracts.players import age, birth, position_flags, primary_position
from lodeworks.contracts.team_histories import full_name_and_activity
from lodeworks.contracts.team_statistics import NOT_IN_SILVER, margin_and_efficiency
from lodeworks.operators.clean import (
    blank_null_tokens,
    drop_columns,
    enforce_types,
    parse_game_time,
    tidy_text,
)
from lodeworks.operators.derive import derive
from lodeworks.plans.gold import with_player_name
from workload import roles
from workload.silver_queries import AS_OF, null_tokens, number, replacing, title_case

_GAMES, _PLAYERS = roles.BRONZE_GAMES, roles.BRONZE_PLAYERS
_LINES, _TEAMS = roles.BRONZE_PLAYER_STATISTICS, roles.BRONZE_TEAM_STATISTICS
_HISTORIES = roles.BRONZE_TEAM_HISTORIES

_TOKEN_COLUMNS = ("gameid", "hometeamcity", "hometeamname", "awayteamname", "gametype")
_POSITION_COLUMNS = ("personId", "lastName", "guard", "forward", "center")
_SCORE_COLUMNS = ("gameid", "homescore", "awayscore")
_NAME_COLUMNS = ("personId", "gameId", "firstName", "lastName")


def _null_tokens(spark, sf_dir):
    return blank_null_tokens(_GAMES.frame(spark, sf_dir, *_TOKEN_COLUMNS))


def _null_tokens_excluding(spark, sf_dir):
    rows = _PLAYERS.frame(spark, sf_dir, *_POSITION_COLUMNS)
    return blank_null_tokens(rows, except_columns=PLAYERS.keep_tokens_in)


def _cast(contract, role):
    return lambda spark, sf_dir: enforce_types(role.frame(spark, sf_dir), contract.bronze)


def cast_sql(contract, role):
    kinds = {"bigint": "BIGINT", "int": "INT", "double": "DOUBLE"}
    typed = ", ".join(
        f"{number(field.name, kinds[kind]) if kind in kinds else field.name} AS {field.name}"
        for field in contract.bronze.fields
        for kind in (field.dataType.simpleString(),)
    )
    return f"SELECT {typed} FROM ({role.sql()}) AS b"


def _trim_case(spark, sf_dir):
    rows = _GAMES.frame(spark, sf_dir, "gameid", *GAMES.trim, "hometeamname", "awayteamname")
    return tidy_text(rows, GAMES.trim, GAMES.upper)


def _initcap(spark, sf_dir):
    rows = _PLAYERS.frame(spark, sf_dir, "personId", *PLAYERS.initcap)
    return tidy_text(rows, trim=PLAYERS.initcap, initcap=PLAYERS.initcap)


def _timestamps(spark, sf_dir):
    rows = _GAMES.frame(spark, sf_dir, "gameid", "gamedatetimeest")
    return parse_game_time(rows, "gamedatetimeest", "game_ts")


def _timestamps_in_place(spark, sf_dir):
    rows = _LINES.frame(spark, sf_dir, "gameId", "gameDateTimeEst")
    return parse_game_time(rows, "gameDateTimeEst", "gameDateTimeEst")


def _as_of():
    return F.lit(AS_OF)


def _trimmed_birthdates(spark, sf_dir):
    return tidy_text(_PLAYERS.frame(spark, sf_dir, "personId", "birthdate"), trim=["birthdate"])


def _birth_dates(spark, sf_dir):
    return derive(_trimmed_birthdates(spark, sf_dir), (birth,), _as_of())


def _age(spark, sf_dir):
    return derive(_trimmed_birthdates(spark, sf_dir), (birth, age), _as_of())


def _position(spark, sf_dir):
    rows = _PLAYERS.frame(spark, sf_dir, "personId", "guard", "forward", "center")
    trimmed = tidy_text(rows, trim=("guard", "forward", "center"))
    return derive(trimmed, (position_flags, primary_position), _as_of())


def _team_name_active(spark, sf_dir):
    rows = enforce_types(_HISTORIES.frame(spark, sf_dir), TEAM_HISTORIES.bronze)
    return derive(rows, (full_name_and_activity,), _as_of())


def _outcome(spark, sf_dir):
    return derive(_GAMES.frame(spark, sf_dir, *_SCORE_COLUMNS), (outcome,), _as_of())


def _points_per_minute(spark, sf_dir):
    rows = _LINES.frame(spark, sf_dir, "personId", "gameId", "points", "numMinutes")
    return derive(rows, (scoring_rate,), _as_of())


_RATIO_INPUTS = {
    name: number(name, "INT")
    for name in ("teamScore", "opponentScore", "fieldGoalsMade", "fieldGoalsAttempted")
}


def _ratios(spark, sf_dir):
    rows = enforce_types(_TEAMS.frame(spark, sf_dir), TEAM_STATISTICS.bronze)
    derived = derive(rows, (margin_and_efficiency,), _as_of())
    return derived.select("gameId", *_RATIO_INPUTS, "score_diff", "shooting_efficiency")


def _drop(spark, sf_dir):
    return drop_columns(_TEAMS.frame(spark, sf_dir), NOT_IN_SILVER)


def _player_name(spark, sf_dir):
    return with_player_name(blank_null_tokens(_LINES.frame(spark, sf_dir, *_NAME_COLUMNS)))


QUERIES = {
    "clean_null_tokens": _null_tokens,
    "clean_null_tokens_excluding": _null_tokens_excluding,
    "clean_cast_players": _cast(PLAYERS, _PLAYERS),
    "clean_cast_team_histories": _cast(TEAM_HISTORIES, _HISTORIES),
    "clean_cast_team_statistics": _cast(TEAM_STATISTICS, _TEAMS),
    "clean_cast_games_by_season": _cast(GAMES_BY_SEASON, _GAMES),
    "clean_trim_case": _trim_case,
    "clean_initcap": _initcap,
    "clean_timestamps": _timestamps,
    "clean_timestamps_in_place": _timestamps_in_place,
    "clean_birth_dates": _birth_dates,
    "derive_age": _age,
    "derive_position": _position,
    "derive_team_name_active": _team_name_active,
    "derive_outcome": _outcome,
    "derive_points_per_minute": _points_per_minute,
    "derive_ratios": _ratios,
    "derive_player_name": _player_name,
    "drop_columns": _drop,
}

_FLAGS_SQL = ", ".join(
    f"CASE WHEN lower({n}) IN ('true', 't', 'yes', 'y', '1') THEN 1 ELSE 0 END AS {n}_flag"
    for n in ("guard", "forward", "center")
)
_BIRTH_SQL = f"""
    SELECT *, CAST(year(birth_date) AS INT) AS birth_year FROM (
        SELECT personId, trim(birthdate) AS birthdate,
               CASE WHEN regexp_full_match(trim(birthdate), '[0-9]{{4}}-[0-9]{{2}}-[0-9]{{2}}')
                    THEN try_cast(trim(birthdate) AS DATE) END AS birth_date
        FROM ({_PLAYERS.sql("personId", "birthdate")}) AS b
    ) AS born"""


def _time_sql(role, key, source, target):
    kept = f"{key}, {source}" if source != target else key
    return f"""
        SELECT {kept}, ts AS {target}, CAST(ts AS DATE) AS game_date,
               CAST(year(ts) AS INT) AS game_year, CAST(month(ts) AS INT) AS game_month
        FROM (SELECT *, try_cast({source} AS TIMESTAMP) AS ts
              FROM ({role.sql(key, source)}) AS b) AS timed"""


ORACLE = {
    "clean_null_tokens": f"""SELECT * REPLACE ({replacing(
        {n: null_tokens(n) for n in _TOKEN_COLUMNS[1:]})})
        FROM ({_GAMES.sql(*_TOKEN_COLUMNS)}) AS b""",
    "clean_null_tokens_excluding": f"""SELECT * REPLACE ({replacing(
        {n: null_tokens(n) for n in ("personId", "lastName")})})
        FROM ({_PLAYERS.sql(*_POSITION_COLUMNS)}) AS b""",
    "clean_cast_players": cast_sql(PLAYERS, _PLAYERS),
    "clean_cast_team_histories": cast_sql(TEAM_HISTORIES, _HISTORIES),
    "clean_cast_team_statistics": cast_sql(TEAM_STATISTICS, _TEAMS),
    "clean_cast_games_by_season": cast_sql(GAMES_BY_SEASON, _GAMES),
    "clean_trim_case": f"""
        SELECT gameid, trim(hometeamcity) AS hometeamcity, trim(awayteamcity) AS awayteamcity,
               upper(trim(gametype)) AS gametype, upper(hometeamname) AS hometeamname,
               upper(awayteamname) AS awayteamname
        FROM ({_GAMES.sql()}) AS b""",
    "clean_initcap": f"""SELECT * REPLACE ({replacing(
        {n: title_case(f"trim({n})") for n in ("firstName", "lastName")})})
        FROM ({_PLAYERS.sql("personId", "firstName", "lastName")}) AS b""",
    "clean_timestamps": _time_sql(_GAMES, "gameid", "gamedatetimeest", "game_ts"),
    "clean_timestamps_in_place": _time_sql(
        _LINES, "gameId", "gameDateTimeEst", "gameDateTimeEst"
    ),
    "clean_birth_dates": _BIRTH_SQL,
    "derive_age": f"""
        SELECT *, date_diff('day', birth_date, DATE '{AS_OF}') / CAST(365.25 AS DOUBLE)
                  AS age_years
        FROM ({_BIRTH_SQL}) AS b""",
    "derive_position": f"""
        SELECT *, CASE WHEN guard_flag = 1 THEN 'G' WHEN forward_flag = 1 THEN 'F'
                       WHEN center_flag = 1 THEN 'C' END AS primary_position
        FROM (SELECT *, {_FLAGS_SQL} FROM (
            SELECT personId, trim(guard) AS guard, trim(forward) AS forward,
                   trim(center) AS center
            FROM ({_PLAYERS.sql("personId", "guard", "forward", "center")}) AS b
        ) AS trimmed) AS flagged""",
    "derive_team_name_active": f"""
        SELECT *, concat_ws(' ', teamCity, teamName) AS team_full_name,
               CASE WHEN seasonActiveTill IS NULL OR seasonActiveTill >= {AS_OF.year}
                    THEN 1 ELSE 0 END AS active_flag
        FROM ({cast_sql(TEAM_HISTORIES, _HISTORIES)}) AS typed""",
    "derive_outcome": f"""
        SELECT *, CASE WHEN homescore > awayscore THEN 1 ELSE 0 END AS home_win,
               CASE WHEN awayscore > homescore THEN 1 ELSE 0 END AS away_win,
               homescore - awayscore AS score_diff
        FROM ({_GAMES.sql(*_SCORE_COLUMNS)}) AS b""",
    "derive_points_per_minute": f"""
        SELECT *, CASE WHEN numMinutes > 0 THEN points / numMinutes END AS points_per_minute
        FROM ({_LINES.sql("personId", "gameId", "points", "numMinutes")}) AS b""",
    "derive_ratios": f"""
        SELECT *, teamScore - opponentScore AS score_diff,
               CASE WHEN fieldGoalsAttempted > 0
                    THEN CAST(fieldGoalsMade AS DOUBLE) / fieldGoalsAttempted
               END AS shooting_efficiency
        FROM (SELECT {number("gameId", "BIGINT")} AS gameId, {replacing(_RATIO_INPUTS)}
              FROM ({_TEAMS.sql()}) AS b) AS typed""",
    "derive_player_name": f"""
        SELECT *, concat_ws(' ', firstName, lastName) AS "playerName"
        FROM (SELECT * REPLACE ({replacing(
            {n: null_tokens(n) for n in ("firstName", "lastName")})})
            FROM ({_LINES.sql(*_NAME_COLUMNS)}) AS b) AS blanked""",
    "drop_columns": f"""
        SELECT * EXCLUDE ({", ".join(NOT_IN_SILVER)}) FROM ({_TEAMS.sql()}) AS b""",
}
