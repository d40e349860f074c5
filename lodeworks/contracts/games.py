"""Games: one row per game."""

from __future__ import annotations

from dataclasses import replace

from pyspark.sql import Column, functions as F
from pyspark.sql.types import StructType

from lodeworks.contract import DISCARD, Check, Contract, Latest
from lodeworks.contracts.columns import INT, LONG, TEXT, of, table
from lodeworks.functions.numeric import flag
from lodeworks.functions.predicates import absent_or_within, every, present

# Bronze columns, reason code and limits of this feed.
_BRONZE = table(
    of(LONG, "gameid"),
    of(TEXT, "gamedatetimeest", "hometeamcity", "hometeamname"),
    of(LONG, "hometeamid"),
    of(TEXT, "awayteamcity", "awayteamname"),
    of(LONG, "awayteamid"),
    of(INT, "homescore", "awayscore", "winner"),
    of(TEXT, "gametype"),
    of(INT, "attendance"),
    of(LONG, "arenaid"),
    of(TEXT, "gamelabel", "gamesublabel"),
    of(INT, "seriesgamenumber"),
)
MISSING_KEYS = "MISSING_KEY_FIELDS"
INVALID_RANGE = "INVALID_NUMERIC_RANGE"
MAX_ATTENDANCE = 30000
FIRST_YEAR, LAST_YEAR = 1946, 2100


def outcome(_as_of: Column) -> dict[str, Column]:
    """Win flags and margin; a tie or an unknown score wins for nobody."""
    home, away = F.col("homescore"), F.col("awayscore")
    return {
        "home_win": flag(home > away),
        "away_win": flag(away > home),
        "score_diff": home - away,
    }


def _plausible(year_column: str):
    def rule(_as_of: Column) -> Column:
        return every(
            F.col("homescore") >= 0,
            F.col("awayscore") >= 0,
            absent_or_within("attendance", 0, MAX_ATTENDANCE),
            F.col(year_column).between(FIRST_YEAR, LAST_YEAR),
        )

    return rule


def _checks(year_column: str) -> tuple[Check, ...]:
    return (
        Check(
            MISSING_KEYS,
            lambda _as_of: present("gameid", "hometeamid", "awayteamid", "arenaid"),
        ),
        # Implausible games are left out without a trace by default.
        Check(INVALID_RANGE, _plausible(year_column), on_invalid=DISCARD),
    )


GAMES = Contract(
    entity="games",
    bronze=_BRONZE,
    trim=("hometeamcity", "awayteamcity", "gametype"),
    upper=("gametype", "hometeamname", "awayteamname"),
    tidy_text_after_checks=True,
    timestamp_from="gamedatetimeest",
    timestamp_to="game_ts",
    checks=_checks("game_year"),
    latest=Latest(keys=("gameid",), newest_by=("game_ts",)),
    after_dedup=(outcome,),
)

# Feeds that carry a season column: types are enforced and the season, not the
# calendar year, has to be plausible.
GAMES_BY_SEASON = replace(
    GAMES,
    entity="games_by_season",
    bronze=StructType([*_BRONZE.fields, *of(INT, "season")]),
    enforce_types=True,
    checks=_checks("season"),
)
