"""Franchises: one row per team id."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

from lodeworks.contract import Check, Contract, Latest
from lodeworks.contracts.columns import INT, LONG, TEXT, of, table
from lodeworks.functions.predicates import every, null_or, present
from lodeworks.functions.text import joined_name

# Bronze columns, reason codes and limits of this feed.
_BRONZE = table(
    of(LONG, "teamId"),
    of(TEXT, "teamCity", "teamName", "teamAbbrev"),
    of(INT, "seasonFounded", "seasonActiveTill"),
    of(TEXT, "league"),
)
MISSING_KEYS = "MISSING_KEYS"
INVALID_RANGE = "INVALID_SEASON_RANGE"
EARLIEST_FOUNDING = 1900


def full_name_and_activity(as_of: Column) -> dict[str, Column]:
    still_active = null_or("seasonActiveTill", F.col("seasonActiveTill") >= F.year(as_of))
    return {
        "team_full_name": joined_name(F.col("teamCity"), F.col("teamName")),
        "active_flag": still_active.cast("int"),
    }


def _seasons_in_order(as_of: Column) -> Column:
    founded, till = F.col("seasonFounded"), F.col("seasonActiveTill")
    return every(
        null_or("seasonFounded", founded.between(F.lit(EARLIEST_FOUNDING), F.year(as_of))),
        null_or("seasonActiveTill", null_or("seasonFounded", till >= founded)),
    )


TEAM_HISTORIES = Contract(
    entity="team_histories",
    bronze=_BRONZE,
    enforce_types=True,
    trim=("teamCity", "teamName", "teamAbbrev", "league"),
    upper=("teamName", "teamAbbrev", "league"),
    initcap=("teamCity",),
    before_checks=(full_name_and_activity,),
    # Here the range rule comes first and names the reason.
    checks=(
        Check(INVALID_RANGE, _seasons_in_order),
        Check(MISSING_KEYS, lambda _as_of: present("teamId", "teamName")),
    ),
    latest=Latest(keys=("teamId",), newest_by=("seasonActiveTill", "seasonFounded")),
    quarantine_audit=("quarantine_ts", "source_file"),
)
