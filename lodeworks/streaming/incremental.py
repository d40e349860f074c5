"""Date-cutoff and high-watermark loads."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import timedelta
from functools import reduce
from operator import and_
from typing import Any

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F
from pyspark.sql.types import DataType, StringType, TimestampNTZType, TimestampType

from lodeworks.functions.temporal import parsed_timestamp
from lodeworks.operators.quality import resolved
from lodeworks.sources.files import scan_delimited, scan_parquet
from lodeworks.sources.sinks import write_delimited, write_parquet

# Fixed value: first moment the original loader keeps.
CUTOFF = "2018-01-01"


def instant_of(df: DataFrame, ts_column: str) -> Column:
    """The column as something that orders by time: text is parsed, bad text is NULL."""
    column = F.col(f"`{ts_column}`")
    textual = isinstance(df.schema[ts_column].dataType, StringType)
    return parsed_timestamp(column) if textual else column


def since_cutoff(df: DataFrame, ts_column: str, cutoff: str = CUTOFF) -> DataFrame:
    """Rows at or after the cutoff, with the column as a timestamp.

    Rows whose text is not a timestamp are left out; a missing column is an
    error, its case plays no part. A column that already is a timestamp is compared
    as it is, so that the filter reaches the scan.
    """
    ts_column = resolved(df, ts_column)
    df = df.withColumn(ts_column, instant_of(df, ts_column))
    limit = F.lit(cutoff).cast(df.schema[ts_column].dataType)
    return df.filter(F.col(ts_column) >= limit)


def high_watermark(target: DataFrame, ts_column: str, floor: str | None = None) -> Any:
    """Greatest time in the column, NULL for an empty table.

    Text is parsed first, so that ``NA`` or any other text that is no timestamp never is
    the greatest. A single value reaches the driver: an instant as microseconds since the
    epoch and a local timestamp as text, so that the time zone of the Python
    process plays no part.

    ``floor`` is any value known to be reached, such as yesterday's date. Only
    files and row groups from there on are read, instead of the whole column; if
    nothing is found there, the whole column is read after all. With text this needs
    one fixed notation, as the limit is compared as text.
    """
    ts_column = resolved(target, ts_column)
    if floor is not None:
        limit = F.lit(floor).cast(target.schema[ts_column].dataType)
        recent = high_watermark(target.filter(F.col(ts_column) >= limit), ts_column)
        if recent is not None:
            return recent
    times = target.select(instant_of(target, ts_column).alias("ts"))
    top = F.max("ts")
    kind = times.schema["ts"].dataType
    if isinstance(kind, TimestampType):
        top = F.unix_micros(top)
    elif isinstance(kind, TimestampNTZType):
        top = top.cast("string")
    return times.agg(top.alias("top")).first()["top"]


def _literal(value: Any, column_type: DataType) -> Column:
    if isinstance(column_type, TimestampType):
        return F.timestamp_micros(F.lit(value))
    return F.lit(value).cast(column_type)


def newer_than(
    source: DataFrame, ts_column: str, watermark: Any, lookback: timedelta | None = None
) -> DataFrame:
    """Source rows strictly after the watermark, all rows if there is none.

    ``lookback`` moves the limit back so that rows arriving late are read too. The limit
    is a constant in the plan, hence pushed to parquet or the database unless the column
    is text. Rows without a time are never newer than a watermark.
    """
    if watermark is None:
        return source
    ts_column = resolved(source, ts_column)
    instant = instant_of(source, ts_column)
    kind = source.select(instant.alias("ts")).schema["ts"].dataType
    limit = _literal(watermark, kind)
    if lookback is not None:
        limit = limit - F.lit(lookback)
    return source.filter(instant > limit)


def scan_target(source: DataFrame, path: str, delimited: bool) -> DataFrame:
    read = scan_delimited if delimited else scan_parquet
    return read(source.sparkSession, path, source.schema)


def _existing(source: DataFrame, path: str, delimited: bool) -> DataFrame | None:
    try:
        return scan_target(source, path, delimited)
    except AnalysisException as missing:
        if missing.getCondition() == "PATH_NOT_FOUND":
            return None
        raise


def last_value(
    spark: SparkSession, target_path: str, ts_column: str, floor: str | None = None
) -> str | None:
    """The watermark of a parquet target as text, none for a new or empty target."""
    try:
        target = scan_parquet(spark, target_path)
    except AnalysisException as missing:
        if missing.getCondition() in ("PATH_NOT_FOUND", "UNABLE_TO_INFER_SCHEMA"):
            return None
        raise
    top = high_watermark(target, ts_column, floor)
    if isinstance(top, int):
        return target.sparkSession.range(1).select(F.timestamp_micros(F.lit(top)).cast("string")).first()[0]
    return None if top is None else str(top)


def not_in(rows: DataFrame, present: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Rows whose keys are not present yet; NULL keys are equal to each other."""
    same = [rows[name].eqNullSafe(present[name]) for name in keys]
    return rows.join(present, reduce(and_, same), "left_anti")


def undated_default(target_path: str) -> str:
    """Where rows without a time go if no place is named: next to the target."""
    return f"{target_path.rstrip('/')}-undated"


def _comparable(rows: DataFrame) -> DataFrame:
    """``row, text``: texts are equal for equal rows, whatever the types of their columns."""
    exact = {
        "ignoreNullFields": "false",
        "timestampFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSSXXX",
        "timestampNTZFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSS",
    }
    return rows.select(F.struct("*").alias("row")).withColumn("text", F.to_json("row", exact))


def append_undated(rows: DataFrame, path: str | None, target_path: str) -> None:
    """Append the copies of each row that the path lacks."""
    if path is None:
        path = undated_default(target_path)
        if rows.isEmpty():
            return
    present = _existing(rows, path, False)
    if present is not None:
        had = _comparable(present).groupBy("text").agg(F.count("*").alias("had"))
        copy = F.row_number().over(Window.partitionBy("text").orderBy("text"))
        rows = (
            _comparable(rows)
            .withColumn("copy", copy)
            .join(had, "text", "left")
            .where(F.col("copy") > F.coalesce("had", F.lit(0)))
            .select("row.*")
        )
    write_parquet(rows, path, mode="append")


def incremental_append(
    source: DataFrame,
    target_path: str,
    ts_column: str,
    lookback: timedelta | None = None,
    delimited: bool = False,
    floor: str | None = None,
    keys: Sequence[str] = (),
    undated_path: str | None = None,
) -> DataFrame:
    """Append what is new to the target and return a scan of the whole target.

    The target is parquet, or delimited text with ``delimited``. ``floor`` narrows the
    search for the watermark, see ``high_watermark``.

    With ``lookback`` rows that arrive late by that much are found too. What the target
    has already is told by ``keys`` and the time (all columns if no keys are given) among
    the target's rows within the window, so no row is appended twice.

    A target that does not exist yet receives every row with a time. Rows without one, or
    with text that is none, go to ``undated_path``, by default the parquet directory
    ``<target_path>-undated``. It is only appended to: a row that it has as often as the
    source is not written again, and rows of earlier deliveries stay.
    """
    ts_column = resolved(source, ts_column)
    instant = instant_of(source, ts_column)
    append_undated(source.filter(instant.isNull()), undated_path, target_path)
    target = _existing(source, target_path, delimited)
    watermark = None if target is None else high_watermark(target, ts_column, floor)
    new = newer_than(source.filter(instant.isNotNull()), ts_column, watermark, lookback)
    if lookback is not None and watermark is not None:
        own = [resolved(source, name) for name in keys or source.columns]
        names = list(dict.fromkeys([*own, ts_column]))
        seen = newer_than(target, ts_column, watermark, lookback).select(*names).distinct()
        new = not_in(new, seen, names)
    write = write_delimited if delimited else write_parquet
    write(new, target_path, mode="append")
    return scan_target(source, target_path, delimited)
