"""Relational reads and writes through Spark's JDBC source.

Connection settings always come from the caller; none are kept here.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession, functions as F

# Fixed value: rows per insert batch of the original loader.
BATCH_SIZE = 1000


@dataclass(frozen=True)
class Split:
    """Range split of a read: one task per stride of a numeric or time column."""

    column: str
    lower: str
    upper: str
    partitions: int


def read_options(
    url: str,
    table: str,
    properties: Mapping[str, str],
    split: Split | None = None,
    fetch_size: int = 10_000,
) -> dict[str, str]:
    """Options of a table read; bounds only shape the split, no row is lost."""
    options = {"url": url, "dbtable": table, "fetchsize": str(fetch_size), **properties}
    if split is not None:
        options |= {
            "partitionColumn": split.column,
            "lowerBound": split.lower,
            "upperBound": split.upper,
            "numPartitions": str(split.partitions),
        }
    return options


def bounds_query(
    table: str, column: str, newer_by: str | None = None, after: str | None = None
) -> str:
    """SQL for the least and greatest split value of the rows that a run will read."""
    newer = f" WHERE {newer_by} > '{after}'" if newer_by and after is not None else ""
    return f"SELECT min({column}) AS low, max({column}) AS high FROM {table}{newer}"


def derived_split(
    spark: SparkSession,
    url: str,
    query: str,
    properties: Mapping[str, str],
    column: str,
    partitions: int,
) -> Split | None:
    """A split over the bounds the database gives now; none if it has no rows to read.

    Fixed bounds would leave all new rows of an incremental import to the last task.
    """
    options = {"url": url, "query": query, **properties}
    row = spark.read.format("jdbc").options(**options).load().first()
    if row is None or row[0] is None:
        return None
    return Split(column, str(row[0]), str(row[1]), partitions)


def depth_bounds(rows: DataFrame, column: str, partitions: int, accuracy: int = 10_000) -> list[str]:
    """Values that cut a column into ``partitions`` ranges of about as many rows each.

    From a quantile sketch, so that a skewed column is not cut by its span. ``rows`` may be
    what a run will read, or what an earlier run stored of the same column. A value so
    frequent that several cuts fall on it is given twice, and ``range_predicates`` makes a
    range of it alone; an empty or all-NULL column gives none.
    """
    if partitions < 2:
        return []
    shares = [k / partitions for k in range(1, partitions)]
    cuts = F.approx_percentile(f"`{column}`", shares, accuracy)
    found = rows.agg(F.transform(cuts, lambda x: x.cast("string")).alias("cuts")).first()["cuts"]
    often = Counter(found or [])
    return [cut for cut, times in often.items() for _ in range(min(times, 2))]


def range_predicates(
    column: str, bounds: Sequence[str], newer_by: str | None = None, after: str | None = None
) -> list[str]:
    """SQL conditions, one a task, that together hold for every row to be read exactly once.

    Bounds ascend; a row on a bound belongs to the range that begins there, or to one of
    its own if the bound is given twice. Rows without a value are a range of their own. With ``after``, the watermark less the lookback, rows
    up to it are left out of every range; rows without a time are not.
    """
    told = [f"'{b}'" for b in bounds]
    if told:
        ranges = [f"{column} < {told[0]}"]
        for k, low in enumerate(told):
            alone = k > 0 and told[k - 1] == low
            high = told[k + 1] if k + 1 < len(told) else None
            if high == low:
                ranges.append(f"{column} = {low}")
                continue
            begin = f"{column} {'>' if alone else '>='} {low}"
            ranges.append(begin if high is None else f"{begin} AND {column} < {high}")
        ranges.append(f"{column} IS NULL")
    else:
        ranges = ["1 = 1"]
    if newer_by and after is not None:
        newer = f"({newer_by} > '{after}' OR {newer_by} IS NULL)"
        ranges = [f"({r}) AND {newer}" for r in ranges]
    return ranges


def scan_jdbc_ranges(
    spark: SparkSession,
    url: str,
    table: str,
    properties: Mapping[str, str],
    predicates: Sequence[str],
) -> DataFrame:
    """A table read with one task per condition of ``range_predicates``."""
    return spark.read.jdbc(url, table, predicates=list(predicates), properties=dict(properties))


def scan_jdbc(
    spark: SparkSession,
    url: str,
    table: str,
    properties: Mapping[str, str],
    split: Split | None = None,
) -> DataFrame:
    """Table scan; filters and column choice are pushed into the database."""
    return (
        spark.read.format("jdbc").options(**read_options(url, table, properties, split)).load()
    )


def write_options(url: str, table: str, properties: Mapping[str, str]) -> dict[str, str]:
    return {"url": url, "dbtable": table, "batchsize": str(BATCH_SIZE), **properties}


def append_jdbc(df: DataFrame, url: str, table: str, properties: Mapping[str, str]) -> None:
    df.write.format("jdbc").mode("append").options(**write_options(url, table, properties)).save()


def replace_jdbc(df: DataFrame, url: str, table: str, properties: Mapping[str, str]) -> None:
    writer = df.write.format("jdbc").mode("overwrite")
    writer.options(**write_options(url, table, properties)).save()
