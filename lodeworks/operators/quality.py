"""Quality routing: every row is accepted, quarantined with a reason, or discarded.

Accepted rows pass one filter per rule. For the rest, the rules become one CASE
column, so rejected rows are found in a single narrow pass whatever the number of
rules.
"""

from __future__ import annotations

from collections.abc import Iterable, Sequence
from dataclasses import replace

from pyspark.sql import Column, DataFrame, functions as F

from lodeworks.contract import DISCARD, QUARANTINE, Check

REASON = "quarantine_reason"
# Marks rows that belong to neither output. No real reason is empty.
_DISCARDED = ""


def require_columns(df: DataFrame, names: Iterable[str]) -> DataFrame:
    """Fail before planning when the input lacks a column."""
    available = {name.lower() for name in df.columns}
    missing = [name for name in names if name.lower() not in available]
    if missing:
        raise ValueError(f"missing columns {missing}; available: {df.columns}")
    return df


def resolved(df: DataFrame, name: str) -> str:
    """The column's name as the table spells it."""
    require_columns(df, [name])
    return next(own for own in df.columns if own.lower() == name.lower())


def with_policy(
    checks: Sequence[Check], on_invalid: str | None = None, on_unknown: str | None = None
) -> tuple[Check, ...]:
    """The same checks with another destination for failing or unknown rows."""
    for choice in (on_invalid, on_unknown):
        if choice not in (None, QUARANTINE, DISCARD):
            raise ValueError(f"unknown policy {choice!r}")
    return tuple(
        replace(
            check,
            on_invalid=on_invalid or check.on_invalid,
            on_unknown=on_unknown or check.on_unknown,
        )
        for check in checks
    )


def _label(destination: str, reason: str) -> Column:
    return F.lit(reason if destination == QUARANTINE else _DISCARDED)


def tag_rows(df: DataFrame, checks: Sequence[Check], as_of: Column) -> DataFrame:
    """Add the reason column; the first failing check wins, NULL means accepted."""
    verdict = F.when(F.lit(False), F.lit(_DISCARDED))
    for check in checks:
        passes = check.passes(as_of)
        if check.on_invalid == check.on_unknown:
            verdict = verdict.when(
                ~F.coalesce(passes, F.lit(False)), _label(check.on_invalid, check.reason)
            )
        else:
            verdict = verdict.when(~passes, _label(check.on_invalid, check.reason)).when(
                passes.isNull(), _label(check.on_unknown, check.reason)
            )
    return df.withColumn(REASON, verdict)


def accepted(df: DataFrame, checks: Sequence[Check], as_of: Column) -> DataFrame:
    """Rows for which every check holds.

    The checks stay separate filters rather than a test of the reason column:
    key checks then reach the scan, and the optimizer reasons about a few small
    conditions instead of one large CASE.
    """
    for check in checks:
        df = df.filter(check.passes(as_of))
    return df


def quarantined(df: DataFrame, checks: Sequence[Check], as_of: Column) -> DataFrame:
    """Rows that some check sends to quarantine, with the reason."""
    return tag_rows(df, checks, as_of).filter(F.col(REASON) != _DISCARDED)
