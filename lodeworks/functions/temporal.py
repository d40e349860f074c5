"""Timestamp, date and age expressions.

The ``try_`` forms are used throughout: a malformed value becomes NULL and is
dealt with by the quality rules instead of failing the job under ANSI mode.
"""

from __future__ import annotations

from pyspark.sql import Column, functions as F

DAYS_PER_YEAR = 365.25


def parsed_timestamp(column: Column) -> Column:
    """Timestamp from text in the session time zone, NULL if malformed."""
    return F.try_to_timestamp(column)


def calendar_parts(ts: Column) -> dict[str, Column]:
    """The date columns that every game-grained table carries."""
    return {
        "game_date": F.to_date(ts),
        "game_year": F.year(ts),
        "game_month": F.month(ts),
    }


def parsed_date(column: Column, pattern: str = "yyyy-MM-dd") -> Column:
    """Date from text in the given pattern, NULL if malformed."""
    return F.try_to_date(column, pattern)


def years_between(earlier: Column, later: Column) -> Column:
    """Fractional years from ``earlier`` to ``later``."""
    return F.datediff(later, earlier) / F.lit(DAYS_PER_YEAR)
