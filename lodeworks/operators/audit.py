"""Audit columns and row-count reports."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F

SOURCE_FILE = "source_file"
SILVER_TS = "silver_ingest_ts"
QUARANTINE_TS = "quarantine_ts"
RECORD_SOURCE = "record_source"


def stamp(
    df: DataFrame,
    columns: Sequence[str],
    run_ts: Column,
    record_source: str | None = None,
) -> DataFrame:
    """Append the named audit columns in order.

    File lineage has to be captured at the scan (see ``sources.files``), since
    it is gone after a shuffle. Inputs without lineage get NULL.
    """
    lineage = F.col(SOURCE_FILE) if SOURCE_FILE in df.columns else F.lit(None).cast("string")
    values = {SILVER_TS: run_ts, QUARANTINE_TS: run_ts, SOURCE_FILE: lineage}
    body = [F.col(f"`{name}`") for name in df.columns if name != SOURCE_FILE]
    tag = [F.lit(record_source).alias(RECORD_SOURCE)] if record_source else []
    return df.select(*body, *tag, *(values[name].alias(name) for name in columns))


def row_counts(layers: Mapping[str, DataFrame]) -> DataFrame:
    """Rows per layer as ``(layer, row_count)``.

    Meant for tables already written: counting a parquet table reads footers
    only, and unlike metrics collected during the write the figures stay exact
    when tasks are re-run after an executor is lost.
    """
    counts = [
        df.agg(F.count(F.lit(1)).alias("row_count")).select(
            F.lit(layer).alias("layer"), "row_count"
        )
        for layer, df in layers.items()
    ]
    return reduce(DataFrame.unionAll, counts)
