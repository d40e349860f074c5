"""Team box scores: one row per game and team."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

from lodeworks.contract import Check, Contract, Latest
from lodeworks.contracts.columns import DOUBLE, INT, LONG, TEXT, of, table
from lodeworks.functions.numeric import ratio
from lodeworks.functions.predicates import absent_or_within, every, present

# Bronze columns, columns left out of silver, reason codes and
# limits of this feed.
_BRONZE = table(
    of(LONG, "gameId"),
    of(TEXT, "gameDateTimeEst", "teamCity", "teamName"),
    of(LONG, "teamId"),
    of(TEXT, "opponentTeamCity", "opponentTeamName"),
    of(LONG, "opponentTeamId"),
    of(INT, "home", "win", "teamScore", "opponentScore", "assists", "blocks", "steals"),
    of(INT, "fieldGoalsAttempted", "fieldGoalsMade"),
    of(DOUBLE, "fieldGoalsPercentage"),
    of(INT, "threePointersAttempted", "threePointersMade"),
    of(DOUBLE, "threePointersPercentage"),
    of(INT, "freeThrowsAttempted", "freeThrowsMade"),
    of(DOUBLE, "freeThrowsPercentage"),
    of(INT, "reboundsDefensive", "reboundsOffensive", "reboundsTotal"),
    of(INT, "foulsPersonal", "turnovers", "plusMinusPoints", "numMinutes"),
    of(INT, "q1Points", "q2Points", "q3Points", "q4Points", "benchPoints"),
    of(INT, "biggestLead", "biggestScoringRun", "leadChanges"),
    of(INT, "pointsFastBreak", "pointsFromTurnovers", "pointsInThePaint"),
    of(INT, "pointsSecondChance", "timesTied", "timeoutsRemaining"),
    of(INT, "seasonWins", "seasonLosses"),
    of(LONG, "coachId"),
)
NOT_IN_SILVER = (
    "foulsPersonal",
    "turnovers",
    "plusMinusPoints",
    "q2Points",
    "q3Points",
    "pointsFastBreak",
    "pointsFromTurnovers",
    "pointsInThePaint",
    "pointsSecondChance",
    "timesTied",
    "timeoutsRemaining",
    "seasonWins",
    "seasonLosses",
    "coachId",
)
MISSING_KEYS = "MISSING_KEYS"
INVALID_RANGE = "INVALID_NUMERIC_RANGE"
PERCENTAGES = ("fieldGoalsPercentage", "threePointersPercentage", "freeThrowsPercentage")
_TEAM_TEXT = ("teamCity", "teamName", "opponentTeamCity", "opponentTeamName")


def margin_and_efficiency(_as_of: Column) -> dict[str, Column]:
    return {
        "score_diff": F.col("teamScore") - F.col("opponentScore"),
        "shooting_efficiency": ratio(F.col("fieldGoalsMade"), F.col("fieldGoalsAttempted")),
    }


TEAM_STATISTICS = Contract(
    entity="team_statistics",
    bronze=_BRONZE,
    enforce_types=True,
    trim=_TEAM_TEXT,
    upper=_TEAM_TEXT,
    timestamp_from="gameDateTimeEst",
    timestamp_to="game_ts",
    checks=(
        Check(MISSING_KEYS, lambda _as_of: present("gameId", "teamId")),
        # Scores have no allowance for NULL: an unknown score makes the rule
        # unknown unless another part of it already fails.
        Check(
            INVALID_RANGE,
            lambda _as_of: every(
                F.col("teamScore") >= 0,
                F.col("opponentScore") >= 0,
                *(absent_or_within(name, 0, 100) for name in PERCENTAGES),
            ),
        ),
    ),
    latest=Latest(keys=("gameId", "teamId"), newest_by=("game_ts",)),
    after_dedup=(margin_and_efficiency,),
    drop=NOT_IN_SILVER,
    quarantine_audit=("quarantine_ts",),
)
