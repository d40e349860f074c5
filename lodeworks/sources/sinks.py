"""Path sinks."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from operator import and_, or_
from uuid import uuid4

from pyspark.sql import Column, DataFrame, Row, functions as F
from pyspark.sql.types import TimestampNTZType, TimestampType

from lodeworks.sources import storage
from lodeworks.sources.files import TEXT_TIMESTAMP
from lodeworks.sources.staging import freed_shuffles


def laid_out(
    df: DataFrame, partition_by: Sequence[str] = (), num_partitions: int | None = None
) -> DataFrame:
    """Arrange rows for writing.

    A fixed partition count is applied as given. For a partitioned layout the
    rows are rebalanced on the partition columns: adaptive execution merges small
    partitions and splits large ones, so neither many tiny files nor one huge
    file per value results, whatever the skew.
    """
    if num_partitions is not None:
        return df.repartition(num_partitions)
    if partition_by:
        return df.hint("rebalance", *partition_by)
    return df


def write_parquet(
    df: DataFrame,
    path: str,
    mode: str = "overwrite",
    partition_by: Sequence[str] = (),
    num_partitions: int | None = None,
) -> None:
    writer = laid_out(df, partition_by, num_partitions).write.mode(mode)
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    with freed_shuffles(df.sparkSession):
        writer.parquet(path)


def replace_parquet(df: DataFrame, path: str, **layout) -> None:
    """Replace a directory once the new data is completely written next to it.

    A failed write leaves the old data as it was. The rows may be read from ``path``.
    """
    spark = df.sparkSession
    fresh = f"{path.rstrip('/')}-new-{uuid4().hex}"
    try:
        write_parquet(df, fresh, **layout)
        storage.replace_directory(spark, fresh, path)
    except BaseException:
        storage.remove(spark, fresh)
        raise


def partition_filter(partitions: Sequence[Row], columns: Sequence[str]) -> Column:
    """Rows of the given partitions, as constants that prune directories before the scan."""
    if len(columns) == 1:
        name = columns[0]
        values = [p[name] for p in partitions if p[name] is not None]
        found = F.col(name).isin(values)
        return found | F.col(name).isNull() if len(values) < len(partitions) else found
    cells = [
        reduce(and_, (F.col(c).eqNullSafe(F.lit(p[c])) for c in columns)) for p in partitions
    ]
    return reduce(or_, cells, F.lit(False))


def replace_partitions(
    df: DataFrame,
    path: str,
    partition_by: Sequence[str],
    touched: Sequence[Row],
    rounds: int = 1,
) -> None:
    """Replace the ``touched`` partitions of a directory; files of all others stay.

    ``df`` holds everything that these partitions are to have and must not be read from
    ``path``. Partitions for which it has no rows are removed after the others are
    written. Running it again with the same rows gives the same directory. With several
    ``rounds`` the partitions are written in as many groups, one after the other.
    """
    spark = df.sparkSession
    rounds = max(1, min(rounds, len(touched)))
    for k in range(rounds):
        group = df if rounds == 1 else df.filter(partition_filter(touched[k::rounds], partition_by))
        writer = laid_out(group, partition_by).write.mode("overwrite").partitionBy(*partition_by)
        with freed_shuffles(spark):
            writer.option("partitionOverwriteMode", "dynamic").parquet(path)
    filled = {tuple(r) for r in df.select(*partition_by).distinct().collect()}
    for gone in touched:
        if tuple(gone[c] for c in partition_by) not in filled:
            where = "/".join(f"{c}={_directory(gone[c])}" for c in partition_by)
            storage.remove(spark, f"{path.rstrip('/')}/{where}")


def _directory(value: object) -> str:
    """How a partition value is spelled in directory names."""
    if value is None or value == "":
        return "__HIVE_DEFAULT_PARTITION__"
    text = str(value).lower() if isinstance(value, bool) else str(value)
    escaped = "\"#%'*/:=?\\{[]^\x7f"
    return "".join(f"%{ord(c):02X}" if c in escaped or c < " " else c for c in text)


def write_bucketed(
    df: DataFrame, name: str, path: str, keys: Sequence[str], buckets: int, rounds: int = 1
) -> DataFrame:
    """Replace an external table whose files are dealt out and sorted by ``keys``.

    Tables with the same number of buckets are joined on the same keys without a shuffle.
    The rows are dealt out before the write, so that there is one file a
    bucket: with many tasks each would otherwise write its own part of every bucket. With
    several ``rounds`` the buckets are written in as many groups, one after the other.
    """
    # Spark's own number of a row's bucket, so that a round has whole buckets.
    bucket = F.pmod(F.hash(*keys), F.lit(buckets))
    rounds = min(rounds, buckets)
    for k in range(rounds):
        part = df if rounds == 1 else df.filter(bucket % rounds == k)
        writer = part.repartition(buckets, *keys).write.mode("append" if k else "overwrite")
        writer = writer.format("parquet").option("path", path)
        with freed_shuffles(df.sparkSession):
            writer.bucketBy(buckets, *keys).sortBy(*keys).saveAsTable(name)
    return df.sparkSession.read.table(name)


def _written(df: DataFrame, name: str, sep: str) -> Column:
    kind = df.schema[name].dataType
    column = F.col(f"`{name}`")
    if isinstance(kind, (TimestampType, TimestampNTZType)):
        text = F.date_format(column, TEXT_TIMESTAMP)
    else:
        text = column.cast("string")
    for plain, code in (("\\", "\\\\"), (sep, "\\" + sep), ("\n", "\\n"), ("\r", "\\r")):
        text = F.replace(text, F.lit(plain), F.lit(code))
    return F.coalesce(text, F.lit(""))


def write_delimited(df: DataFrame, path: str, sep: str = ",", mode: str = "overwrite") -> None:
    """Headerless delimited text without quoting; NULL is an empty field.

    The counterpart of ``scan_delimited``. A backslash stands before separators and
    backslashes of the text, and line breaks are written as ``\\n`` and ``\\r``, so that
    a record is one line.
    """
    fields = [_written(df, name, sep) for name in df.columns]
    df.select(F.concat_ws(sep, *fields).alias("value")).write.mode(mode).text(path)
