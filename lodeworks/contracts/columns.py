"""Short forms for writing table schemas."""

from __future__ import annotations

from pyspark.sql.types import (
    DataType,
    DoubleType,
    IntegerType,
    LongType,
    StringType,
    StructField,
    StructType,
)

LONG, INT, DOUBLE, TEXT = LongType(), IntegerType(), DoubleType(), StringType()


def of(data_type: DataType, *names: str) -> list[StructField]:
    """Nullable fields of one type."""
    return [StructField(name, data_type, True) for name in names]


def table(*groups: list[StructField]) -> StructType:
    """A schema from consecutive groups of fields."""
    return StructType([field for group in groups for field in group])
