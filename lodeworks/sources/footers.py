"""Checks answered by parquet footers.

Counts and extremes stand in every file's footer. The second version of Spark's parquet
source answers aggregates of them from there, without reading a row.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession, functions as F


def footer_session(spark: SparkSession) -> SparkSession:
    """A session of the same application whose parquet scans push aggregates down."""
    own = spark.newSession()
    own.conf.set("spark.sql.sources.useV1SourceList", "")
    own.conf.set("spark.sql.parquet.aggregatePushdown", "true")
    return own


def check_from_footers(
    spark: SparkSession,
    path: str,
    not_null: Sequence[str] = (),
    non_negative: Sequence[str] = (),
    unit_interval: Sequence[str] = (),
) -> DataFrame:
    """``check_name, column_name, passed`` like ``checks.check_table``, without row counts.

    Columns are numbers or dates. A column of NULLs alone is within every limit, and so
    is one of an empty table. Where a file has a row group without extremes, as one of
    NULLs alone, Spark refuses to answer from footers; the columns are then read.
    """
    limits = list(dict.fromkeys([*non_negative, *unit_interval]))
    wanted = [F.count("*").alias("n")]
    wanted += [F.count(f"`{c}`").alias(f"n{i}") for i, c in enumerate(not_null)]
    wanted += [f(f"`{c}`").alias(f"{k}{i}") for i, c in enumerate(limits) for k, f in (("a", F.min), ("z", F.max))]
    told = footer_session(spark).read.parquet(path).agg(*wanted)
    try:
        told.first()
    except Exception as refused:
        if "No min/max found" not in str(refused):
            raise
        told = spark.read.parquet(path).agg(*wanted)
    low = lambda c: F.coalesce(F.col(f"a{limits.index(c)}") >= 0, F.lit(True))
    high = lambda c: F.coalesce(F.col(f"z{limits.index(c)}") <= 1, F.lit(True))
    results = [("non_empty", "*", F.col("n") > 0)]
    results += [("not_null", c, F.col(f"n{i}") == F.col("n")) for i, c in enumerate(not_null)]
    results += [("non_negative", c, low(c)) for c in non_negative]
    results += [("unit_interval", c, low(c) & high(c)) for c in unit_interval]
    cells = F.array(
        *(
            F.struct(F.lit(check).alias("check_name"), F.lit(name).alias("column_name"), passed.alias("passed"))
            for check, name, passed in results
        )
    )
    return told.select(F.inline(cells))
