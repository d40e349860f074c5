"""Table checks and table comparison, both without collecting the table."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql.types import IntegerType, LongType


def missing_columns(df: DataFrame, required: Sequence[str]) -> list[str]:
    available = {name.lower() for name in df.columns}
    return [name for name in required if name.lower() not in available]


def column_report(df: DataFrame, required: Sequence[str]) -> DataFrame:
    """``column_name, present, known`` for every required column, in one pass over the rows.

    Names are compared without regard to case, like everywhere; ``known`` counts the
    values that are not NULL and is NULL for a column that is not there. A name asked for
    twice is reported once. No required columns, no rows.
    """
    own = {name.lower(): name for name in df.columns}
    first: dict[str, str] = {}
    for name in required:
        first.setdefault(name.lower(), name)
    wanted = list(first.values())
    found = [own.get(name.lower()) for name in wanted]
    totals = df.agg(
        F.count(F.lit(1)).alias("all"),
        *(F.count(f"`{name}`").alias(f"m{i}") for i, name in enumerate(found) if name),
    )
    cells = [
        F.struct(
            F.lit(name).alias("column_name"),
            F.lit(found[i] is not None).alias("present"),
            (F.col(f"m{i}") if found[i] else F.lit(None).cast("bigint")).alias("known"),
        )
        for i, name in enumerate(wanted)
    ]
    kind = "array<struct<column_name:string,present:boolean,known:bigint>>"
    return totals.select(F.inline(F.array(*cells).cast(kind)))


def _violations(condition: Column) -> Column:
    return F.count_if(F.coalesce(condition, F.lit(False)))


def check_table(
    df: DataFrame,
    not_null: Sequence[str] = (),
    non_negative: Sequence[str] = (),
    unit_interval: Sequence[str] = (),
) -> DataFrame:
    """Result of every check as ``(check_name, column_name, violations, passed)``.

    One aggregate over one scan serves all checks and columns.
    """
    measures: list[tuple[str, str, Column]] = [
        ("non_empty", "*", F.when(F.count(F.lit(1)) == 0, 1).otherwise(0).cast("bigint"))
    ]
    for name in not_null:
        measures.append(("not_null", name, _violations(F.col(name).isNull())))
    for name in non_negative:
        measures.append(("non_negative", name, _violations(F.col(name) < 0)))
    for name in unit_interval:
        outside = (F.col(name) < 0) | (F.col(name) > 1)
        measures.append(("unit_interval", name, _violations(outside)))

    totals = df.agg(*(value.alias(f"m{i}") for i, (_, _, value) in enumerate(measures)))
    rows = F.array(
        *(
            F.struct(
                F.lit(check).alias("check_name"),
                F.lit(name).alias("column_name"),
                F.col(f"m{i}").alias("violations"),
            )
            for i, (check, name, _) in enumerate(measures)
        )
    )
    return totals.select(F.inline(rows)).withColumn("passed", F.col("violations") == 0)


def assert_table(df: DataFrame, required: Sequence[str] = (), **checks: Sequence[str]) -> None:
    """Raise if columns are missing or any check of ``check_table`` fails."""
    missing = missing_columns(df, required)
    if missing:
        raise AssertionError(f"missing columns: {missing}")
    failed = check_table(df, **checks).filter(~F.col("passed")).collect()
    if failed:
        raise AssertionError(
            "; ".join(f"{r.check_name} {r.column_name}: {r.violations}" for r in failed)
        )


def _comparable_type(data_type):
    return LongType() if isinstance(data_type, IntegerType) else data_type


def schema_differences(actual: DataFrame, expected: DataFrame) -> list[str]:
    """Differences in column names, order and types.

    int and bigint count as the same type, nullability is ignored.
    """
    left = [(f.name, _comparable_type(f.dataType)) for f in actual.schema.fields]
    right = [(f.name, _comparable_type(f.dataType)) for f in expected.schema.fields]
    if len(left) != len(right):
        return [f"columns {actual.columns} against {expected.columns}"]
    return [
        f"{a[0]} {a[1].simpleString()} against {b[0]} {b[1].simpleString()}"
        for a, b in zip(left, right)
        if a != b
    ]


def compare_tables(actual: DataFrame, expected: DataFrame) -> DataFrame:
    """Rows that occur a different number of times on the two sides.

    Row order does not matter, repetitions do. Both sides are counted in one
    aggregation, so equal rows meet in one shuffle and copies are combined
    before it.
    """
    columns = actual.columns
    sides = actual.withColumns({"__a": F.lit(1), "__e": F.lit(0)}).unionByName(
        expected.withColumns({"__a": F.lit(0), "__e": F.lit(1)})
    )
    return (
        sides.groupBy(*columns)
        .agg(F.sum("__a").alias("actual_count"), F.sum("__e").alias("expected_count"))
        .filter(F.col("actual_count") != F.col("expected_count"))
    )


def _row_hash(columns: Sequence[str], seed: int) -> Column:
    """A number for a row's values, with NULL told from every value and from its place."""
    cells = [c for name in columns for c in (F.col(f"`{name}`").isNull(), F.col(f"`{name}`"))]
    return F.xxhash64(F.lit(seed), *cells).cast("decimal(38,0)")


def bucket_checksums(df: DataFrame, keys: Sequence[str], buckets: int) -> DataFrame:
    """``bucket, n, first_sum, second_sum``: rows and two order-free checksums per key bucket.

    Rows are combined before the shuffle, which carries a row per bucket and task. Equal
    rows add up equally in any order, and repeated rows count as often as they occur.
    """
    own = F.xxhash64(*(F.col(f"`{name}`") for name in keys))
    columns = sorted(df.columns)
    return (
        df.select(
            F.pmod(own, F.lit(buckets)).alias("bucket"),
            _row_hash(columns, 1).alias("h1"),
            _row_hash(columns, 2).alias("h2"),
        )
        .groupBy("bucket")
        .agg(
            F.count("*").alias("n"),
            F.sum("h1").alias("first_sum"),
            F.sum("h2").alias("second_sum"),
        )
    )


def differing_buckets(
    actual: DataFrame, expected: DataFrame, keys: Sequence[str], buckets: int
) -> list[int]:
    """Key buckets whose rows are not the same on both sides."""
    sums = ["n", "first_sum", "second_sum"]
    sides = bucket_checksums(actual, keys, buckets).withColumn("side", F.lit(0)).unionByName(
        bucket_checksums(expected, keys, buckets).withColumn("side", F.lit(1))
    )
    told = sides.groupBy("bucket").agg(
        F.count("*").alias("sides"), *(F.countDistinct(name).alias(name) for name in sums)
    )
    unlike = (F.col("sides") < 2) | (F.greatest(*sums) > 1)
    return sorted(r["bucket"] for r in told.filter(unlike).select("bucket").collect())


def compare_by_checksum(
    actual: DataFrame, expected: DataFrame, keys: Sequence[str], buckets: int = 4096
) -> DataFrame:
    """``compare_tables`` in two steps: checksums per key bucket, then rows of unlike buckets.

    Equal tables shuffle a row per bucket and task instead of every row. Buckets are at
    most ``buckets`` numbers on the driver. Two buckets of unlike rows are taken for
    like ones if both 64-bit checksums agree by chance.
    """
    unlike = differing_buckets(actual, expected, keys, buckets)
    bucket = F.pmod(F.xxhash64(*(F.col(f"`{name}`") for name in keys)), F.lit(buckets))
    return compare_tables(actual.filter(bucket.isin(unlike)), expected.filter(bucket.isin(unlike)))


def differing_columns(
    actual: DataFrame, expected: DataFrame, keys: Sequence[str], buckets: int = 4096
) -> DataFrame:
    """``column_name, n_keys``: of the keys that both sides have once, how many differ there.

    Columns without differences are left out. Only unlike buckets are joined.
    """
    unlike = differing_buckets(actual, expected, keys, buckets)
    bucket = F.pmod(F.xxhash64(*(F.col(f"`{name}`") for name in keys)), F.lit(buckets))
    others = [name for name in actual.columns if name not in keys]

    def once(df: DataFrame, side: str) -> DataFrame:
        cells = F.struct(*(F.col(f"`{name}`") for name in others))
        rows = df.filter(bucket.isin(unlike)).groupBy(*keys)
        return rows.agg(F.count("*").alias(f"n_{side}"), F.first(cells).alias(side))

    left, right = once(actual, "a"), once(expected, "e")
    same = [left[name].eqNullSafe(right[name]) for name in keys]
    both = left.join(right, reduce(and_, same)).filter("n_a = 1 AND n_e = 1")
    counts = [
        F.count_if(~F.col(f"a.`{name}`").eqNullSafe(F.col(f"e.`{name}`"))).alias(f"m{i}")
        for i, name in enumerate(others)
    ]
    cells = F.array(
        *(
            F.struct(F.lit(name).alias("column_name"), F.col(f"m{i}").alias("n_keys"))
            for i, name in enumerate(others)
        )
    )
    return both.agg(*counts).select(F.inline(cells)).filter("n_keys > 0")


def assert_tables_equal(actual: DataFrame, expected: DataFrame, show: int = 10) -> None:
    """Raise on a schema difference or on any differing row."""
    differences = schema_differences(actual, expected)
    if differences:
        raise AssertionError("; ".join(differences))
    rows = compare_tables(actual, expected).limit(show).collect()
    if rows:
        raise AssertionError("differing rows: " + "; ".join(map(str, rows)))
