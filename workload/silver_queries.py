"""Silver and quarantine of the five entities over the bronze roles.

The SQL states the same rules by hand; it shares nothing with the engine but the
bronze role.
"""

from __future__ import annotations

from datetime import date, datetime, timezone

from lodeworks.contracts import (
    GAMES,
    GAMES_BY_SEASON,
    PLAYER_STATISTICS,
    PLAYERS,
    TEAM_HISTORIES,
    TEAM_STATISTICS,
)
from lodeworks.operators.dedup import keep_latest
from lodeworks.plans.silver import build_silver
from lodeworks.sources.files import with_lineage
from workload import roles

AS_OF = date(2024, 6, 30)
RUN_TS = datetime(2024, 7, 1, 12, 0, tzinfo=timezone.utc)
_RUN_TS_SQL = "TIMESTAMP '2024-07-01 12:00:00'"
_AUDIT = ("silver_ingest_ts", "quarantine_ts", "source_file")


def tables(role, contract, columns=(), **options):
    """Both outputs of a contract over a bronze role, at fixed dates."""

    def build(spark, sf_dir):
        bronze = role.frame(spark, sf_dir, *columns)
        return build_silver(bronze, contract, as_of=AS_OF, run_ts=RUN_TS, **options)

    return build


def _pair(name, build, keep=()):
    hidden = tuple(column for column in _AUDIT if column not in keep)
    return {
        f"silver_{name}": lambda spark, sf_dir: build(spark, sf_dir).silver.drop(*hidden),
        f"quarantine_{name}": lambda spark, sf_dir: build(spark, sf_dir).quarantine.drop(
            *hidden
        ),
    }


# -- SQL helpers -----------------------------------------------------------


def number(text: str, kind: str) -> str:
    """A number from text; whole numbers lose a fraction instead of being rounded."""
    if kind == "DOUBLE":
        return f"try_cast({text} AS DOUBLE)"
    return f"""CASE WHEN regexp_full_match(CAST({text} AS VARCHAR), '\\s*[+-]?[0-9]+[.][0-9]*\\s*')
                THEN try_cast(trunc(try_cast({text} AS DECIMAL(38, 10))) AS {kind})
                ELSE try_cast({text} AS {kind}) END"""


def null_tokens(column: str) -> str:
    return f"CASE WHEN {column} IN ('nul', 'NULL', 'NA', '') THEN NULL ELSE {column} END"


def title_case(text: str) -> str:
    return (
        f"array_to_string(list_transform(string_split({text}, ' '), "
        "lambda w: upper(w[1]) || lower(w[2:])), ' ')"
    )


def replacing(columns: dict[str, str]) -> str:
    """A DuckDB REPLACE list."""
    return ", ".join(f"{expression} AS {name}" for name, expression in columns.items())


def newest_first(*columns: str) -> str:
    return ", ".join(f"{column} DESC NULLS LAST" for column in columns)


_DATE_PARTS = (
    "CAST({ts} AS DATE) AS game_date, CAST(year({ts}) AS INT) AS game_year, "
    "CAST(month({ts}) AS INT) AS game_month"
)


def _latest_sql(keys: str, order: str, outputs: str) -> str:
    return f"""
        , ranked AS (
            SELECT *, row_number() OVER (PARTITION BY {keys} ORDER BY {order}) AS rn
            FROM accepted
        )
        SELECT {outputs} FROM ranked WHERE rn = 1"""


# -- games -----------------------------------------------------------------

_GAME_TEXT = (
    "gamedatetimeest",
    "hometeamcity",
    "hometeamname",
    "awayteamcity",
    "awayteamname",
    "gametype",
    "gamelabel",
    "gamesublabel",
)
_GAME_COLUMNS = roles.BRONZE_GAMES_COLUMNS


def _games_sql(columns, year_column, typed=""):
    cleaned = {name: null_tokens(name) for name in _GAME_TEXT}
    tidy = {
        "hometeamcity": "trim(hometeamcity)",
        "awayteamcity": "trim(awayteamcity)",
        "gametype": "upper(trim(gametype))",
        "hometeamname": "upper(hometeamname)",
        "awayteamname": "upper(awayteamname)",
    }
    return f"""
        WITH bronze AS ({roles.BRONZE_GAMES.sql(*columns)}),
        blanked AS (SELECT * REPLACE ({replacing(cleaned)}{typed}) FROM bronze),
        timed AS (SELECT *, try_cast(gamedatetimeest AS TIMESTAMP) AS game_ts FROM blanked),
        cleaned AS (SELECT *, {_DATE_PARTS.format(ts="game_ts")} FROM timed),
        judged AS (
            SELECT *, gameid IS NULL OR hometeamid IS NULL OR awayteamid IS NULL
                      OR arenaid IS NULL AS keyless,
                   homescore >= 0 AND awayscore >= 0
                   AND (attendance IS NULL OR (attendance >= 0 AND attendance <= 30000))
                   AND {year_column} >= 1946 AND {year_column} <= 2100 AS plausible
            FROM cleaned
        ),
        accepted AS (
            SELECT * EXCLUDE (keyless, plausible) REPLACE ({replacing(tidy)})
            FROM judged WHERE NOT keyless AND plausible
        )"""


_GAMES_OUT = """* EXCLUDE (rn),
    CASE WHEN homescore > awayscore THEN 1 ELSE 0 END AS home_win,
    CASE WHEN awayscore > homescore THEN 1 ELSE 0 END AS away_win,
    homescore - awayscore AS score_diff"""
_GAMES_SQL = _games_sql(_GAME_COLUMNS, "game_year")
_GAMES_ORDER = newest_first("game_ts", *_GAME_COLUMNS[1:])
_SEASON_COLUMNS = tuple(roles.BRONZE_GAMES.columns)
_SEASON_SQL = _games_sql(
    _SEASON_COLUMNS, "season", f", {number('season', 'INT')} AS season"
)

# -- players ---------------------------------------------------------------

_PLAYER_NUMBERS = {
    "personId": "BIGINT",
    "height": "DOUBLE",
    "bodyWeight": "DOUBLE",
    "draftYear": "INT",
    "draftRound": "INT",
    "draftNumber": "INT",
}
_PLAYERS_SQL = f"""
    WITH bronze AS ({roles.BRONZE_PLAYERS.sql()}),
    typed AS (
        SELECT * REPLACE ({replacing({
            **{n: number(null_tokens(n), t) for n, t in _PLAYER_NUMBERS.items()},
            "firstName": title_case(f"trim({null_tokens('firstName')})"),
            "lastName": title_case(f"trim({null_tokens('lastName')})"),
            "birthdate": f"trim({null_tokens('birthdate')})",
            "lastAttended": f"upper(trim({null_tokens('lastAttended')}))",
            "country": f"upper(trim({null_tokens('country')}))",
            "guard": "trim(guard)",
            "forward": "trim(forward)",
            "center": "trim(center)",
        })}) FROM bronze
    ),
    born AS (
        SELECT *, CASE WHEN regexp_full_match(birthdate, '[0-9]{{4}}-[0-9]{{2}}-[0-9]{{2}}')
                       THEN try_cast(birthdate AS DATE) END AS birth_date
        FROM typed
    ),
    flagged AS (
        SELECT *, CAST(year(birth_date) AS INT) AS birth_year,
               date_diff('day', birth_date, DATE '{AS_OF}') / CAST(365.25 AS DOUBLE)
                   AS age_years,
               {", ".join(
                   f"CASE WHEN lower({n}) IN ('true', 't', 'yes', 'y', '1') THEN 1 ELSE 0 END "
                   f"AS {n}_flag" for n in ("guard", "forward", "center")
               )}
        FROM born
    ),
    judged AS (
        SELECT *,
               CASE WHEN guard_flag = 1 THEN 'G' WHEN forward_flag = 1 THEN 'F'
                    WHEN center_flag = 1 THEN 'C' END AS primary_position,
               CASE WHEN personId IS NULL THEN 'MISSING_PERSON_ID'
                    WHEN height <= 10 OR height >= 280 OR bodyWeight <= 0 OR bodyWeight >= 999
                    THEN 'INVALID_NUMERIC_RANGE' END AS quarantine_reason,
               'NBA_PLAYERS_BRONZE' AS record_source,
               {_RUN_TS_SQL} AS silver_ingest_ts
        FROM flagged
    ),
    accepted AS (
        SELECT * EXCLUDE (quarantine_reason) FROM judged WHERE quarantine_reason IS NULL
    )"""
_PLAYERS_ORDER = newest_first(
    "birth_date",
    "draftYear",
    "firstName",
    "lastName",
    "birthdate",
    "lastAttended",
    "country",
    "height",
    "bodyWeight",
    "guard",
    "forward",
    "center",
    "draftRound",
    "draftNumber",
)

# -- player statistics -----------------------------------------------------

_LINE_COLUMNS = tuple(roles.BRONZE_PLAYER_STATISTICS.columns)
_LINE_TEXT = {
    "firstName": "trim({})",
    "lastName": "trim({})",
    "playerteamCity": "trim({})",
    "playerteamName": "upper(trim({}))",
    "opponentteamCity": "trim({})",
    "opponentteamName": "upper(trim({}))",
    "gameType": "upper(trim({}))",
    "gameLabel": "{}",
    "gameSubLabel": "{}",
    "gameDateTimeEst": "try_cast({} AS TIMESTAMP)",
}
_LINES_SQL = f"""
    WITH bronze AS ({roles.BRONZE_PLAYER_STATISTICS.sql()}),
    timed AS (
        SELECT * REPLACE ({replacing(
            {n: form.format(null_tokens(n)) for n, form in _LINE_TEXT.items()}
        )}) FROM bronze
    ),
    cleaned AS (SELECT *, {_DATE_PARTS.format(ts="gameDateTimeEst")} FROM timed),
    judged AS (
        SELECT *, CASE
            WHEN personId IS NULL OR gameId IS NULL THEN 'MISSING_KEYS'
            WHEN numMinutes < 0 OR points < 0 OR assists < 0 OR blocks < 0 OR steals < 0
              OR fieldGoalsPercentage < 0 OR fieldGoalsPercentage > 100
              OR threePointersPercentage < 0 OR threePointersPercentage > 100
              OR freeThrowsPercentage < 0 OR freeThrowsPercentage > 100
            THEN 'INVALID_NUMERIC_RANGE' END AS quarantine_reason
        FROM cleaned
    ),
    accepted AS (
        SELECT * EXCLUDE (quarantine_reason) FROM judged WHERE quarantine_reason IS NULL
    )"""
_LINES_ORDER = newest_first(
    "gameDateTimeEst",
    *(c for c in _LINE_COLUMNS if c not in ("personId", "gameId", "gameDateTimeEst")),
)

# -- team histories --------------------------------------------------------

_HISTORIES_SQL = f"""
    WITH bronze AS ({roles.BRONZE_TEAM_HISTORIES.sql()}),
    typed AS (
        SELECT * REPLACE ({replacing({
            "teamId": number(null_tokens("teamId"), "BIGINT"),
            "teamCity": title_case(f"trim({null_tokens('teamCity')})"),
            "teamName": f"upper(trim({null_tokens('teamName')}))",
            "teamAbbrev": f"upper(trim({null_tokens('teamAbbrev')}))",
            "seasonFounded": number(null_tokens("seasonFounded"), "INT"),
            "seasonActiveTill": number(null_tokens("seasonActiveTill"), "INT"),
            "league": f"upper(trim({null_tokens('league')}))",
        })}) FROM bronze
    ),
    judged AS (
        SELECT *, concat_ws(' ', teamCity, teamName) AS team_full_name,
               CASE WHEN seasonActiveTill IS NULL OR seasonActiveTill >= {AS_OF.year}
                    THEN 1 ELSE 0 END AS active_flag,
               CASE WHEN seasonFounded < 1900 OR seasonFounded > {AS_OF.year}
                      OR seasonActiveTill < seasonFounded THEN 'INVALID_SEASON_RANGE'
                    WHEN teamId IS NULL OR teamName IS NULL THEN 'MISSING_KEYS'
               END AS quarantine_reason
        FROM typed
    ),
    accepted AS (
        SELECT * EXCLUDE (quarantine_reason) FROM judged WHERE quarantine_reason IS NULL
    )"""
_HISTORIES_ORDER = newest_first(
    "seasonActiveTill", "seasonFounded", "teamCity", "teamName", "teamAbbrev", "league"
)

# -- team statistics -------------------------------------------------------

_TEAM_COLUMNS = tuple(roles.BRONZE_TEAM_STATISTICS.columns)
_TEAM_LONGS = ("gameId", "teamId", "opponentTeamId", "coachId")
_TEAM_DOUBLES = ("fieldGoalsPercentage", "threePointersPercentage", "freeThrowsPercentage")
_TEAM_TEXT = ("teamCity", "teamName", "opponentTeamCity", "opponentTeamName")
_TEAM_DROPPED = (
    "timeoutsRemaining, seasonWins, seasonLosses, coachId, timesTied, pointsSecondChance, "
    "pointsInThePaint, pointsFromTurnovers, pointsFastBreak, q2Points, q3Points, "
    "plusMinusPoints, turnovers, foulsPersonal"
)


def _team_column(name: str) -> str:
    value = null_tokens(name)
    if name in _TEAM_TEXT:
        return f"upper(trim({value}))"
    if name == "gameDateTimeEst":
        return value
    kind = "BIGINT" if name in _TEAM_LONGS else "DOUBLE" if name in _TEAM_DOUBLES else "INT"
    return number(value, kind)


_TEAMS_SQL = f"""
    WITH bronze AS ({roles.BRONZE_TEAM_STATISTICS.sql()}),
    typed AS (
        SELECT * REPLACE ({replacing({n: _team_column(n) for n in _TEAM_COLUMNS})}) FROM bronze
    ),
    timed AS (SELECT *, try_cast(gameDateTimeEst AS TIMESTAMP) AS game_ts FROM typed),
    cleaned AS (SELECT *, {_DATE_PARTS.format(ts="game_ts")} FROM timed),
    judged AS (
        SELECT *, gameId IS NULL OR teamId IS NULL AS keyless,
               teamScore >= 0 AND opponentScore >= 0
               AND {" AND ".join(
                   f"({n} IS NULL OR ({n} >= 0 AND {n} <= 100))" for n in _TEAM_DOUBLES
               )} AS plausible
        FROM cleaned
    ),
    accepted AS (
        SELECT * EXCLUDE (keyless, plausible) FROM judged WHERE NOT keyless AND plausible
    )"""
_TEAMS_ORDER = newest_first(
    "game_ts", *(c for c in _TEAM_COLUMNS if c not in ("gameId", "teamId"))
)
_TEAMS_OUT = f"""* EXCLUDE (rn, {_TEAM_DROPPED}), teamScore - opponentScore AS score_diff,
    CASE WHEN fieldGoalsAttempted > 0
         THEN CAST(fieldGoalsMade AS DOUBLE) / fieldGoalsAttempted END AS shooting_efficiency"""
SILVER_TEAM_STATISTICS_SQL = _TEAMS_SQL + _latest_sql("gameId, teamId", _TEAMS_ORDER, _TEAMS_OUT)


def _rejected(invalid: str, unknown: bool) -> str:
    """Quarantine of the team table with or without undecidable rows."""
    bad = "NOT coalesce(plausible, false)" if unknown else "NOT plausible"
    return f"""{_TEAMS_SQL}
        SELECT * EXCLUDE (keyless, plausible),
               CASE WHEN keyless THEN 'MISSING_KEYS' ELSE '{invalid}' END AS quarantine_reason
        FROM judged WHERE keyless OR {bad}"""


# -- dedup on its own ------------------------------------------------------

_DEDUP_COLUMNS = ("gameid", "game_ts", "homeTeamName", "partkey", "suppkey", "price")
_DEDUP_TIES = ("partkey", "suppkey", "price")
_HISTORY_TIES = ("teamName", "teamCity", "teamAbbrev", "league")


def _dedup_games(spark, sf_dir):
    games = roles.GAMES.frame(spark, sf_dir, *_DEDUP_COLUMNS)
    return keep_latest(games, ("gameid",), ("game_ts",), _DEDUP_TIES)


def _lineage_through_dedup(spark, sf_dir):
    """The file of each row that survives the dedup."""
    bronze = with_lineage(roles.load(spark, sf_dir, "lineitem"))
    bronze = bronze.selectExpr(
        "l_orderkey AS gameid", "l_shipdate AS game_ts", "l_linenumber", "l_partkey", "source_file"
    )
    kept = keep_latest(bronze, ("gameid",), ("game_ts",), ("l_linenumber", "l_partkey", "source_file"))
    return kept.selectExpr("gameid", "game_ts", "element_at(split(source_file, '/'), -1) AS file_name")


def _dedup_histories(spark, sf_dir):
    rows = roles.BRONZE_TEAM_HISTORIES.frame(spark, sf_dir)
    return keep_latest(rows, ("teamId",), ("seasonActiveTill", "seasonFounded"), _HISTORY_TIES)


silver_team_statistics = tables(roles.BRONZE_TEAM_STATISTICS, TEAM_STATISTICS)
silver_games = tables(roles.BRONZE_GAMES, GAMES, _GAME_COLUMNS)
silver_player_statistics = tables(roles.BRONZE_PLAYER_STATISTICS, PLAYER_STATISTICS)
silver_players = tables(roles.BRONZE_PLAYERS, PLAYERS)
silver_histories = tables(roles.BRONZE_TEAM_HISTORIES, TEAM_HISTORIES)
_strict_games = tables(roles.BRONZE_GAMES, GAMES, _GAME_COLUMNS,
                       on_invalid="quarantine", on_unknown="quarantine")
_strict_teams = tables(roles.BRONZE_TEAM_STATISTICS, TEAM_STATISTICS, on_unknown="quarantine")

QUERIES = {
    **_pair("games", silver_games),
    **_pair("players", silver_players, keep=("silver_ingest_ts",)),
    **_pair("player_statistics", silver_player_statistics),
    **_pair("team_histories", silver_histories, keep=("quarantine_ts",)),
    **_pair("team_statistics", silver_team_statistics),
    "silver_games_by_season": _pair(
        "games_by_season", tables(roles.BRONZE_GAMES, GAMES_BY_SEASON)
    )["silver_games_by_season"],
    "quarantine_games_strict": _pair("x", _strict_games)["quarantine_x"],
    "quarantine_team_statistics_strict": _pair("x", _strict_teams)["quarantine_x"],
    "dedup_games": _dedup_games,
    "dedup_lineage": _lineage_through_dedup,
    "dedup_team_histories": _dedup_histories,
}

ORACLE = {
    "dedup_lineage": """
        SELECT l_orderkey AS gameid, max(l_shipdate) AS game_ts, 'lineitem.parquet' AS file_name
        FROM lineitem GROUP BY l_orderkey""",
    "silver_games": _GAMES_SQL + _latest_sql("gameid", _GAMES_ORDER, _GAMES_OUT),
    "quarantine_games": f"""{_GAMES_SQL}
        SELECT * EXCLUDE (keyless, plausible), 'MISSING_KEY_FIELDS' AS quarantine_reason
        FROM judged WHERE keyless""",
    "quarantine_games_strict": f"""{_GAMES_SQL}
        SELECT * EXCLUDE (keyless, plausible),
               CASE WHEN keyless THEN 'MISSING_KEY_FIELDS' ELSE 'INVALID_NUMERIC_RANGE' END
                   AS quarantine_reason
        FROM judged WHERE keyless OR NOT coalesce(plausible, false)""",
    "silver_games_by_season": _SEASON_SQL
    + _latest_sql("gameid", newest_first("game_ts", *_SEASON_COLUMNS[1:]), _GAMES_OUT),
    "silver_players": _PLAYERS_SQL
    + _latest_sql("personId", _PLAYERS_ORDER, "* EXCLUDE (rn)"),
    "quarantine_players": f"""{_PLAYERS_SQL}
        SELECT * FROM judged WHERE quarantine_reason IS NOT NULL""",
    "silver_player_statistics": _LINES_SQL
    + _latest_sql(
        "personId, gameId",
        _LINES_ORDER,
        "* EXCLUDE (rn), CASE WHEN numMinutes > 0 THEN points / numMinutes END "
        "AS points_per_minute",
    ),
    "quarantine_player_statistics": f"""{_LINES_SQL}
        SELECT * FROM judged WHERE quarantine_reason IS NOT NULL""",
    "silver_team_histories": _HISTORIES_SQL
    + _latest_sql("teamId", _HISTORIES_ORDER, "* EXCLUDE (rn)"),
    "quarantine_team_histories": f"""{_HISTORIES_SQL}
        SELECT *, {_RUN_TS_SQL} AS quarantine_ts FROM judged
        WHERE quarantine_reason IS NOT NULL""",
    "silver_team_statistics": SILVER_TEAM_STATISTICS_SQL,
    "quarantine_team_statistics": _rejected("INVALID_NUMERIC_RANGE", unknown=False),
    "quarantine_team_statistics_strict": _rejected("INVALID_NUMERIC_RANGE", unknown=True),
    "dedup_games": f"""
        SELECT * EXCLUDE (rn) FROM (
            SELECT *, row_number() OVER (
                PARTITION BY gameid ORDER BY {newest_first("game_ts", *_DEDUP_TIES)}) AS rn
            FROM ({roles.GAMES.sql(*_DEDUP_COLUMNS)}) AS g
        ) AS ranked WHERE rn = 1""",
    "dedup_team_histories": f"""
        SELECT * EXCLUDE (rn) FROM (
            SELECT *, row_number() OVER (PARTITION BY teamId ORDER BY {
                newest_first("seasonActiveTill", "seasonFounded", *_HISTORY_TIES)}) AS rn
            FROM ({roles.BRONZE_TEAM_HISTORIES.sql()}) AS h
        ) AS ranked WHERE rn = 1""",
}
