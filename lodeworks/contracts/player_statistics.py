"""Player box scores: one row per person and game."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

from lodeworks.contract import Check, Contract, Latest
from lodeworks.contracts.columns import DOUBLE, INT, LONG, TEXT, of, table
from lodeworks.functions.numeric import ratio
from lodeworks.functions.predicates import (
    absent_or_non_negative,
    absent_or_within,
    every,
    present,
)

# Bronze columns, reason codes and limits of this feed.
_BRONZE = table(
    of(TEXT, "firstName", "lastName"),
    of(LONG, "personId", "gameId"),
    of(
        TEXT,
        "gameDateTimeEst",
        "playerteamCity",
        "playerteamName",
        "opponentteamCity",
        "opponentteamName",
        "gameType",
        "gameLabel",
        "gameSubLabel",
    ),
    of(INT, "seriesGameNumber", "win", "home"),
    of(
        DOUBLE,
        "numMinutes",
        "points",
        "assists",
        "blocks",
        "steals",
        "fieldGoalsAttempted",
        "fieldGoalsMade",
        "fieldGoalsPercentage",
        "threePointersAttempted",
        "threePointersMade",
        "threePointersPercentage",
        "freeThrowsAttempted",
        "freeThrowsMade",
        "freeThrowsPercentage",
        "reboundsDefensive",
        "reboundsOffensive",
        "reboundsTotal",
        "foulsPersonal",
        "turnovers",
        "plusMinusPoints",
    ),
)
MISSING_KEYS = "MISSING_KEYS"
INVALID_RANGE = "INVALID_NUMERIC_RANGE"
NON_NEGATIVE = ("numMinutes", "points", "assists", "blocks", "steals")
PERCENTAGES = ("fieldGoalsPercentage", "threePointersPercentage", "freeThrowsPercentage")


def scoring_rate(_as_of: Column) -> dict[str, Column]:
    return {"points_per_minute": ratio(F.col("points"), F.col("numMinutes"))}


PLAYER_STATISTICS = Contract(
    entity="player_statistics",
    bronze=_BRONZE,
    trim=(
        "firstName",
        "lastName",
        "playerteamCity",
        "playerteamName",
        "opponentteamCity",
        "opponentteamName",
        "gameType",
    ),
    upper=("gameType", "playerteamName", "opponentteamName"),
    timestamp_from="gameDateTimeEst",
    timestamp_to="gameDateTimeEst",
    checks=(
        Check(MISSING_KEYS, lambda _as_of: present("personId", "gameId")),
        Check(
            INVALID_RANGE,
            lambda _as_of: every(
                *map(absent_or_non_negative, NON_NEGATIVE),
                *(absent_or_within(name, 0, 100) for name in PERCENTAGES),
            ),
        ),
    ),
    latest=Latest(keys=("personId", "gameId"), newest_by=("gameDateTimeEst",)),
    after_dedup=(scoring_rate,),
    quarantine_audit=("silver_ingest_ts", "source_file"),
)
