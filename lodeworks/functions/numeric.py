"""Guarded arithmetic and 0/1 flags."""

from __future__ import annotations

from pyspark.sql import Column, functions as F
from pyspark.sql.types import DataType

_WITH_FRACTION = r"^\s*[+-]?[0-9]+\.[0-9]*\s*$"


def whole_number(text: Column, kind: DataType) -> Column:
    """Integer from text; digits with a fraction are cut off, other text is NULL.

    Only plain decimal notation has a fraction to cut: ``12.7`` is 12, ``1e3`` is NULL.
    """
    # One cast for both notations, and the pattern only where there is a point at all.
    fraction = F.contains(text, F.lit(".")) & text.rlike(_WITH_FRACTION)
    return F.when(fraction, F.substring_index(text, ".", 1)).otherwise(text).try_cast(kind)


def ratio(numerator: Column, denominator: Column) -> Column:
    """Quotient as double, NULL unless the denominator is positive."""
    return F.when(denominator > 0, numerator / denominator)


def flag(condition: Column) -> Column:
    """1 where the condition holds, 0 where it is false or unknown."""
    return F.when(condition, F.lit(1)).otherwise(F.lit(0))


def truthy_flag(column: Column) -> Column:
    """1 for boolean-like text (true, t, yes, y, 1 in any case), else 0."""
    return flag(column.try_cast("boolean"))
