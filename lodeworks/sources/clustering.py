"""Files laid out so that filters on any of several columns skip most of them.

Every column's values are ranked coarsely, the bits of the ranks are interleaved, and the
rows are range-partitioned and sorted by the resulting number. Rows that are close in all
columns then stand together, and the least and greatest values that parquet keeps of each
row group exclude most groups, whichever of the columns a filter names.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql.types import DateType, StringType, TimestampNTZType, TimestampType

from lodeworks.sources.sinks import write_parquet

_ORDER = "__cluster"
#: Leading bytes of a text that its rank looks at.
_TEXT_BYTES = 7


def _number(df: DataFrame, name: str) -> Column:
    """A number in the order of the column's values; long texts by their first bytes."""
    kind, column = df.schema[name].dataType, F.col(f"`{name}`")
    if isinstance(kind, StringType):
        head = F.rpad(F.substring(F.hex(column.cast("binary")), 1, 2 * _TEXT_BYTES), 2 * _TEXT_BYTES, "0")
        return F.conv(head, 16, 10).cast("double")
    if isinstance(kind, DateType):
        return F.datediff(column, F.lit("1970-01-01").cast("date")).cast("double")
    if isinstance(kind, (TimestampType, TimestampNTZType)):
        return F.unix_micros(column.cast("timestamp")).cast("double")
    return column.cast("double")


def interleaved(df: DataFrame, columns: Sequence[str], bits: int = 6) -> Column:
    """The interleaved ranks of the columns' values as one number; NULL ranks lowest.

    Ranks are those of ``2 ** bits`` ranges with about as many rows each, found by one
    quantile sketch over all columns. The bounds are all that reaches the driver.
    """
    if not 1 <= bits * len(columns) <= 62:
        raise ValueError("the ranks do not fit one number")
    shares = [k / 2**bits for k in range(1, 2**bits)]
    cuts = df.agg(*(F.approx_percentile(_number(df, c), shares).alias(f"c{i}") for i, c in enumerate(columns))).first()
    place = F.lit(0).cast("long")
    for i, name in enumerate(columns):
        bounds = sorted(set(cuts[i] or []))
        value = _number(df, name)
        # Ranks are spread over all bits also where few values give few ranges.
        width = max(1, 2**bits // (len(bounds) + 1))
        rank = F.size(F.filter(F.array(*map(F.lit, bounds)).cast("array<double>"), lambda b: b <= value))
        rank = (F.coalesce(rank, F.lit(0)) * width).cast("long")
        rank = F.when(value.isNull(), F.lit(0)).otherwise(rank).cast("long")
        for bit in range(bits):
            moved = F.shiftleft(F.shiftright(rank, bit).bitwiseAND(F.lit(1).cast("long")), bit * len(columns) + i)
            place = place.bitwiseOR(moved)
    return place


def write_clustered(
    df: DataFrame, path: str, columns: Sequence[str], partitions: int | None = None, bits: int = 6
) -> None:
    """Write the rows clustered by several columns; ``partitions`` files if that is given."""
    placed = df.withColumn(_ORDER, interleaved(df, columns, bits))
    if partitions:
        placed = placed.repartitionByRange(partitions, _ORDER, *columns)
    else:
        placed = placed.repartitionByRange(_ORDER, *columns)
    write_parquet(placed.sortWithinPartitions(_ORDER, *columns).drop(_ORDER), path)
