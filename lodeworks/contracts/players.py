"""Players: one row per person."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

from lodeworks.contract import Check, Contract, Latest
from lodeworks.contracts.columns import DOUBLE, INT, LONG, TEXT, of, table
from lodeworks.functions.numeric import truthy_flag
from lodeworks.functions.predicates import absent_or_inside, every, present
from lodeworks.functions.temporal import parsed_date, years_between

# Bronze columns, reason codes, limits, position letters in order
# of precedence and the source tag of this feed.
_BRONZE = table(
    of(LONG, "personId"),
    of(TEXT, "firstName", "lastName", "birthdate", "lastAttended", "country"),
    of(DOUBLE, "height", "bodyWeight"),
    of(TEXT, "guard", "forward", "center"),
    of(INT, "draftYear", "draftRound", "draftNumber"),
)
MISSING_KEYS = "MISSING_PERSON_ID"
INVALID_RANGE = "INVALID_NUMERIC_RANGE"
HEIGHT_LIMITS = (10, 280)
WEIGHT_LIMITS = (0, 999)
POSITIONS = {"guard": "G", "forward": "F", "center": "C"}
RECORD_SOURCE = "NBA_PLAYERS_BRONZE"


def birth(_as_of: Column) -> dict[str, Column]:
    date = parsed_date(F.col("birthdate"))
    return {"birth_date": date, "birth_year": F.year(date)}


def age(as_of: Column) -> dict[str, Column]:
    return {"age_years": years_between(F.col("birth_date"), as_of)}


def position_flags(_as_of: Column) -> dict[str, Column]:
    return {f"{name}_flag": truthy_flag(F.col(name)) for name in POSITIONS}


def primary_position(_as_of: Column) -> dict[str, Column]:
    """Letter of the first flag that is set, NULL if none is."""
    letters = (
        F.when(F.col(f"{name}_flag") == 1, F.lit(letter))
        for name, letter in POSITIONS.items()
    )
    return {"primary_position": F.coalesce(*letters)}


PLAYERS = Contract(
    entity="players",
    bronze=_BRONZE,
    enforce_types=True,
    keep_tokens_in=tuple(POSITIONS),
    trim=(
        "firstName",
        "lastName",
        "birthdate",
        "lastAttended",
        "country",
        "guard",
        "forward",
        "center",
    ),
    upper=("country", "lastAttended"),
    initcap=("firstName", "lastName"),
    before_checks=(birth, age, position_flags, primary_position),
    checks=(
        Check(MISSING_KEYS, lambda _as_of: present("personId")),
        Check(
            INVALID_RANGE,
            lambda _as_of: every(
                absent_or_inside("height", *HEIGHT_LIMITS),
                absent_or_inside("bodyWeight", *WEIGHT_LIMITS),
            ),
        ),
    ),
    latest=Latest(keys=("personId",), newest_by=("birth_date", "draftYear")),
    record_source=RECORD_SOURCE,
    quarantine_audit=("silver_ingest_ts", "source_file"),
)
