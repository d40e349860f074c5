"""Incremental loads that are recorded next to their target.

Every run that appended rows leaves an entry below ``<target>-log``: its files, their
number of rows and greatest time, and the watermark after it. The next run reads the
entries instead of the target, so that a target of delimited text is never parsed for
its watermark. Files that no entry names were left by a run that was cut off; they are
deleted before the next one appends, so no row is loaded twice and none is missed. One
loader per target is assumed.
"""

from __future__ import annotations

import json
from collections.abc import Sequence
from dataclasses import asdict, dataclass, field
from datetime import timedelta
from typing import Any
from uuid import uuid4

from pyspark.sql import DataFrame, SparkSession, functions as F

from lodeworks.operators.quality import resolved
from lodeworks.sources import storage
from lodeworks.sources.files import scan_delimited
from lodeworks.sources.sinks import write_delimited, write_parquet
from lodeworks.streaming.incremental import (
    append_undated,
    high_watermark,
    instant_of,
    newer_than,
    not_in,
    scan_target,
)

#: Every so many entries one names all files, so that older ones need not be read.
WHOLE_EVERY = 50


@dataclass(frozen=True)
class Entry:
    """One run: ``watermark`` is the greatest time of all runs, ``top`` that of its own rows."""

    number: int
    run: str
    watermark: int | str | None
    top: int | str | None
    rows: int
    files: list[str]
    #: Entries that this one stands for as well, as ``[top, files]``.
    before: list[list[Any]] = field(default_factory=list)


def log_path(target_path: str) -> str:
    return f"{target_path.rstrip('/')}-log"


def entries(spark: SparkSession, target_path: str) -> list[Entry]:
    """Committed runs, oldest first, back to the last entry that names all files.

    An entry that was cut off while it was written does not count.
    """
    found: list[Entry] = []
    for name in reversed(storage.files_below(spark, log_path(target_path))):
        try:
            entry = Entry(**json.loads(storage.read_text(spark, f"{log_path(target_path)}/{name}")))
        except json.JSONDecodeError:
            continue
        found.append(entry)
        if entry.number % WHOLE_EVERY == 0:
            break
    return found[::-1]


def loads(log: Sequence[Entry]) -> list[tuple[Any, list[str]]]:
    """The greatest time and the files of every load."""
    return [
        load
        for entry in log
        for load in (*((top, files) for top, files in entry.before), (entry.top, entry.files))
    ]


def _told(top: Any) -> int | str | None:
    return top if top is None or isinstance(top, (int, str)) else str(top)


def _commit(spark: SparkSession, target_path: str, log: Sequence[Entry], **told: Any) -> Entry:
    names = storage.files_below(spark, log_path(target_path))
    number = int(names[-1].split(".")[0]) + 1 if names else 0
    before = [[top, files] for top, files in loads(log)] if number % WHOLE_EVERY == 0 else []
    entry = Entry(number=number, before=before, **told)
    storage.write_new(
        spark, f"{log_path(target_path)}/{number:012d}.json", json.dumps(asdict(entry))
    )
    return entry


def _read(source: DataFrame, target_path: str, files: Sequence[str], delimited: bool) -> DataFrame:
    spark = source.sparkSession
    paths = [f"{target_path.rstrip('/')}/{name}" for name in files]
    if not paths:
        return source.limit(0)
    if delimited:
        return scan_delimited(spark, paths, source.schema)
    return spark.read.schema(source.schema).parquet(*paths)


def recover(source: DataFrame, target_path: str, ts_column: str, delimited: bool = False) -> list[Entry]:
    """The log of a target, after files of unfinished runs were deleted.

    A target without a log that has files is taken over as it is, which reads its times once.
    """
    spark = source.sparkSession
    log = entries(spark, target_path)
    present = storage.files_below(spark, target_path)
    if not log:
        if present:
            held = _read(source, target_path, present, delimited)
            top = _told(high_watermark(held, ts_column))
            told = {"run": "taken-over", "watermark": top, "top": top}
            log = [_commit(spark, target_path, [], rows=held.count(), files=present, **told)]
        return log
    known = {name for _, files in loads(log) for name in files}
    for name in present:
        if name not in known:
            storage.remove(spark, f"{target_path.rstrip('/')}/{name}")
    return log


def write_load(rows: DataFrame, target_path: str, delimited: bool = False) -> None:
    """Append rows without recording them, as a run does before it commits."""
    (write_delimited if delimited else write_parquet)(rows, target_path, mode="append")


def logged_append(
    source: DataFrame,
    target_path: str,
    ts_column: str,
    lookback: timedelta | None = None,
    delimited: bool = False,
    keys: Sequence[str] = (),
    undated_path: str | None = None,
) -> DataFrame:
    """Append what is new, record it, and return a scan of the whole target.

    The rules for new, late and undated rows are those of ``incremental_append``. With a
    ``lookback`` only files of runs that reached into it are read for what is there
    already. A run without new rows leaves no entry.
    """
    spark = source.sparkSession
    ts_column = resolved(source, ts_column)
    instant = instant_of(source, ts_column)
    append_undated(source.filter(instant.isNull()), undated_path, target_path)
    log = recover(source, target_path, ts_column, delimited)
    watermark = log[-1].watermark if log else None
    new = newer_than(source.filter(instant.isNotNull()), ts_column, watermark, lookback)
    if lookback is not None and watermark is not None:
        own = [resolved(source, name) for name in keys or source.columns]
        names = list(dict.fromkeys([*own, ts_column]))
        reached = _within(source, ts_column, watermark, lookback, log)
        seen = newer_than(
            _read(source, target_path, reached, delimited), ts_column, watermark, lookback
        )
        new = not_in(new, seen.select(*names).distinct(), names)
    write_load(new, target_path, delimited)
    known = {name for _, files in loads(log) for name in files}
    files = [name for name in storage.files_below(spark, target_path) if name not in known]
    # From the new files alone, so that the figures hold however often tasks were run.
    written = _read(source, target_path, files, delimited)
    rows, top = written.count(), _told(high_watermark(written, ts_column))
    if rows:
        reached_top = watermark if top is None else _later(source, ts_column, watermark, top)
        log = [
            *log,
            _commit(spark, target_path, log, run=uuid4().hex, watermark=reached_top, top=top,
                    rows=rows, files=files),
        ]
    else:
        for name in files:
            storage.remove(spark, f"{target_path.rstrip('/')}/{name}")
    # Nothing but recorded files is left there now.
    return scan_target(source, target_path, delimited) if log else source.limit(0)


def _times(source: DataFrame, ts_column: str, tops: Sequence[Any]) -> DataFrame:
    """Recorded times, numbered, as values of the column's own kind."""
    kind = source.select(instant_of(source, ts_column).alias("ts")).schema["ts"].dataType
    rows = source.sparkSession.createDataFrame(
        [(i, str(top)) for i, top in enumerate(tops) if top is not None], "i int, top string"
    )
    if kind.typeName() == "timestamp":
        return rows.select("i", F.timestamp_micros(F.col("top").cast("long")).alias("ts"))
    return rows.select("i", F.col("top").cast(kind).alias("ts"))


def _later(source: DataFrame, ts_column: str, watermark: Any, top: Any) -> Any:
    best = _times(source, ts_column, [watermark, top]).orderBy(F.desc("ts")).first()
    return (watermark, top)[best["i"]]


def _within(
    source: DataFrame, ts_column: str, watermark: Any, lookback: timedelta, log: Sequence[Entry]
) -> list[str]:
    """Files of the loads whose greatest time lies within the lookback."""
    found = loads(log)
    times = _times(source, ts_column, [top for top, _ in found])
    reached = {r["i"] for r in newer_than(times, "ts", watermark, lookback).select("i").collect()}
    return [name for i, (_, files) in enumerate(found) if i in reached for name in files]
