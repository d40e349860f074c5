"""Helpers the corpus operators share: tables, staging and Arrow text batches."""

from __future__ import annotations

from collections.abc import Iterator
from contextlib import contextmanager
from contextvars import ContextVar
from uuid import uuid4

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession

from lodeworks.sources import storage

#: Paths handed out within the innermost ``released``.
_paths: ContextVar[list[str] | None] = ContextVar("paths", default=None)
#: Bytes of text that a task holds as one numpy block.
BLOCK_BYTES = 8 << 20


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def shared_folder(spark: SparkSession) -> str:
    """The cluster's shared folder. A local session without one uses its warehouse; elsewhere
    that may be a folder of the driver's machine, so that not naming one is an error."""
    folder = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getConf().get(
        "spark.checkpoint.dir"
    )
    if not folder and not spark.sparkContext.master.startswith("local"):
        raise ValueError("spark.checkpoint.dir must name a folder that all executors reach")
    return (folder or f"{spark.conf.get('spark.sql.warehouse.dir')}/_staging").rstrip("/")


def fresh_path(spark: SparkSession, label: str) -> str:
    """A path below the shared folder that no other run uses."""
    path = f"{shared_folder(spark)}/{label}-{uuid4().hex}"
    if (within := _paths.get()) is not None:
        within.append(path)
    return path


@contextmanager
def released(spark: SparkSession) -> Iterator[None]:
    """Delete on leaving what ``staged`` and ``fresh_path`` made inside, also after a failure.

    What is to outlast it must be computed and written elsewhere before.
    """
    made: list[str] = []
    outer = _paths.set(made)
    try:
        yield
    finally:
        _paths.reset(outer)
        for path in made:
            storage.remove(spark, path)


def staged(df: DataFrame, label: str) -> DataFrame:
    """Write the rows below the shared folder and scan them from there.

    Later losses of executors then do not repeat the work behind the rows.
    """
    path = fresh_path(df.sparkSession, label)
    df.write.option("compression", "zstd").parquet(path)
    return df.sparkSession.read.parquet(path)


def text_bytes(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The UTF-8 bytes of all texts end to end, and where each starts (plus the end).

    A null text has no bytes.
    """
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    if column.null_count:
        column = pc.fill_null(column, "")
    column = column.cast(pa.large_string())
    offsets = np.frombuffer(column.buffers()[1], np.int64)[
        column.offset : column.offset + len(column) + 1
    ]
    if not len(column) or column.buffers()[2] is None:
        return np.zeros(0, np.uint8), np.zeros(len(column) + 1, np.int64)
    data = np.frombuffer(column.buffers()[2], np.uint8)[offsets[0] : offsets[-1]]
    return data, offsets - offsets[0]


def blocks(
    batches: Iterator[pa.RecordBatch], column: str = "text", limit: int = BLOCK_BYTES
) -> Iterator[pa.RecordBatch]:
    """Cut batches so that the texts of a piece hold about ``limit`` bytes.

    A text is never cut, so a longer one makes a piece of its own.
    """
    for batch in batches:
        sizes = pc.fill_null(pc.binary_length(batch.column(column)), 0)
        ends = np.cumsum(sizes.to_numpy(zero_copy_only=False), dtype=np.int64)
        first = 0
        while first < batch.num_rows:
            before = ends[first - 1] if first else 0
            last = max(first + 1, int(np.searchsorted(ends, before + limit, "right")))
            yield batch.slice(first, last - first)
            first = last
    # A worker waits for its next task with the memory of the last one otherwise.
    pa.default_memory_pool().release_unused()


def spans_of(mask: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Starts and ends of the runs of True."""
    edges = np.flatnonzero(np.diff(np.concatenate(([0], mask.view(np.int8), [0]))))
    return edges[::2], edges[1::2]


def ragged(starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """The positions start, start + 1, ... of all runs, end to end."""
    total = int(lengths.sum())
    if not total:
        return np.zeros(0, np.int64)
    ends = np.cumsum(lengths)
    return np.arange(total) + np.repeat(starts - (ends - lengths), lengths)


def mix(values: np.ndarray, seed: int = 0) -> np.ndarray:
    """A 64-bit finaliser: every input bit reaches every output bit."""
    x = values.astype(np.uint64) + np.uint64((seed * 0x9E3779B97F4A7C15) % 2**64)
    x ^= x >> np.uint64(30)
    x *= np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x
