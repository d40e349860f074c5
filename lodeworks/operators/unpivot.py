"""Turn one row with two sides into one row per side, in a single scan."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, functions as F


def sides_to_rows(
    df: DataFrame,
    shared: Sequence[str],
    sides: Sequence[Mapping[str, Column]],
) -> DataFrame:
    """Emit one row per element of ``sides`` next to the ``shared`` columns.

    A union of one projection per side gives the same rows but reads the input
    once per side.
    """
    names = list(sides[0])
    if any(list(side) != names for side in sides):
        raise ValueError("all sides need the same columns in the same order")
    packed = F.array(
        *(F.struct(*(side[name].alias(name) for name in names)) for side in sides)
    )
    return df.select(*shared, F.inline(packed))
