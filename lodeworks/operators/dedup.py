"""Latest row per key.

``row_number() = 1`` is planned with a group limit on both sides of the
exchange: every map task forwards at most one row per key, so a key holding a
large share of the table sends one row per task instead of all its rows.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window, functions as F

_RANK = "__rank"


def keep_latest(
    df: DataFrame,
    keys: Sequence[str],
    newest_by: Sequence[str],
    tie_break: Sequence[str] = (),
) -> DataFrame:
    """One row per key, greatest ``newest_by`` first with NULLs last.

    ``tie_break`` columns extend the order the same way, which makes the result
    repeatable when several rows share the greatest value. They are compared
    only for rows that tie.
    """
    order = [F.col(name).desc_nulls_last() for name in (*newest_by, *tie_break)]
    window = Window.partitionBy(*keys).orderBy(*order)
    return (
        df.withColumn(_RANK, F.row_number().over(window))
        .filter(F.col(_RANK) == 1)
        .drop(_RANK)
    )
