"""Row predicates used by the quality rules."""

from __future__ import annotations

from functools import reduce
from operator import and_

from pyspark.sql import Column, functions as F


def every(*conditions: Column) -> Column:
    """Conjunction in three-valued logic."""
    return reduce(and_, conditions)


def present(*names: str) -> Column:
    """All named columns are non-NULL (never unknown itself)."""
    return every(*(F.col(name).isNotNull() for name in names))


def null_or(name: str, condition: Column) -> Column:
    """NULL passes, otherwise the condition decides."""
    return F.col(name).isNull() | condition


def absent_or_non_negative(name: str) -> Column:
    return null_or(name, F.col(name) >= 0)


def absent_or_within(name: str, low: float, high: float) -> Column:
    """NULL or inside the closed range."""
    return null_or(name, F.col(name).between(low, high))


def absent_or_inside(name: str, low: float, high: float) -> Column:
    """NULL or strictly inside the open range."""
    return null_or(name, (F.col(name) > low) & (F.col(name) < high))
