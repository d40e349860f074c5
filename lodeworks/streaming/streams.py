"""Feeds as file streams: new files are picked up, merged or appended, and remembered.

The checkpoint remembers which files were read. A batch that was cut off is run again with
the same files, so both sinks are made to bear that: appended batches replace their own
directory, and a merge of rows that are there already changes nothing.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import LongType, StructField, StructType

from lodeworks.contract import Contract
from lodeworks.sources.sinks import write_parquet
from lodeworks.sources.staging import released
from lodeworks.streaming.incremental import instant_of
from lodeworks.streaming.merge import merge_silver

BATCH = "load_batch"


def read_feed(
    spark: SparkSession, path: str, schema: StructType, files_per_batch: int | None = None
) -> DataFrame:
    """A stream over the parquet files that arrive in a directory."""
    reader = spark.readStream.schema(schema)
    if files_per_batch:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    return reader.parquet(path)


def without_repeats(
    feed: DataFrame, ts_column: str, keys: Sequence[str], late: str
) -> DataFrame:
    """Drop repeats of a key that arrive within ``late`` of the newest time seen.

    Keys older than that are forgotten, so the state stays bounded, and rows that old are
    left out, as a watermark demands. The column itself keeps its type.
    """
    own = "__event_time"
    timed = feed.withColumn(own, instant_of(feed, ts_column).cast("timestamp"))
    return (
        timed.withWatermark(own, late).dropDuplicatesWithinWatermark(list(keys)).drop(own)
    )


def _run(feed: DataFrame, checkpoint: str, batch: Callable[[DataFrame, int], None]) -> StreamingQuery:
    return (
        feed.writeStream.trigger(availableNow=True)
        .option("checkpointLocation", checkpoint)
        .foreachBatch(batch)
        .start()
    )


def append_available(feed: DataFrame, target_path: str, checkpoint: str) -> None:
    """Append all that has arrived since the last run, and return when that is done.

    Every batch has a directory of its own below the target, which running it again
    replaces. Readers find the batch's number in the column ``load_batch``.
    """

    def batch(rows: DataFrame, number: int) -> None:
        write_parquet(rows, f"{target_path.rstrip('/')}/{BATCH}={number}")

    _run(feed, checkpoint, batch).awaitTermination()


def merge_available(
    feed: DataFrame,
    contract: Contract,
    silver_path: str,
    checkpoint: str,
    quarantine_path: str | None = None,
    **options,
) -> None:
    """Merge all bronze rows that have arrived since the last run into silver.

    ``options`` are those of ``merge_silver``. A batch merged again changes nothing, and
    its rejects replace those of the first attempt.
    """

    def batch(rows: DataFrame, number: int) -> None:
        with released(rows.sparkSession):
            merge_silver(rows, contract, silver_path, quarantine_path, run=str(number), **options)

    _run(feed, checkpoint, batch).awaitTermination()


def scan_appended(spark: SparkSession, target_path: str, schema: StructType) -> DataFrame:
    """The rows of ``append_available`` without the batch numbers."""
    whole = StructType([*schema.fields, StructField(BATCH, LongType())])
    return spark.read.schema(whole).parquet(target_path).drop(BATCH)
