"""Silver kept up to date by deltas of bronze.

A delta is cleaned and deduplicated like a whole load. Its keys are looked up in the key
columns of silver, only the partitions that hold such keys or receive rows are read, and
these are replaced; the files of all others stay as they are. Each key's newest version
wins by the same order that a full load uses, whether it came early or late, so that
deltas in any order, also repeated ones, lead to the same silver.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from datetime import date, datetime

from pyspark.sql import DataFrame, Row, functions as F

from lodeworks.contract import Contract
from lodeworks.operators.dedup import keep_latest
from lodeworks.operators.quality import require_columns
from lodeworks.plans.silver import build_silver, tie_break_columns
from lodeworks.sources import storage
from lodeworks.sources.files import scan_parquet
from lodeworks.sources.sinks import partition_filter, replace_partitions, write_parquet
from lodeworks.sources.staging import rounds_for, staged, staged_in_rounds

_FRESH, _HIT = "__fresh", "__hit"


@dataclass(frozen=True)
class Merge:
    """What a delta did: rows that silver got and lost, and the partitions replaced."""

    added: DataFrame
    removed: DataFrame
    partitions: list[Row]


def merge_rows(
    fresh: DataFrame,
    path: str,
    keys: Sequence[str],
    newest_by: Sequence[str],
    tie_break: Sequence[str],
    partition_by: Sequence[str],
) -> Merge:
    """Merge rows, one per key, into the partitioned directory at ``path``.

    A row that is there already (equal in all columns of the order) stays, so repeating a
    merge changes nothing. Should a merge fail between its partitions, repeating it
    mends it: what is written is staged first and does not depend on what was replaced.
    Partition values, one row a touched partition, are all that reaches the driver.
    """
    spark = fresh.sparkSession
    require_columns(fresh, [*keys, *newest_by, *partition_by])
    fresh = staged(fresh, "merge-delta")
    columns, nothing = fresh.columns, fresh.limit(0)
    if not storage.exists(spark, path):
        write_parquet(fresh, path, partition_by=partition_by)
        return Merge(fresh, nothing, fresh.select(*partition_by).distinct().collect())
    present = scan_parquet(spark, path, fresh.schema).select(*columns)
    wanted = fresh.select(*keys)
    held = present.select(*partition_by, *keys).join(wanted, list(keys), "left_semi")
    touched = (
        held.select(*partition_by).union(fresh.select(*partition_by)).distinct().collect()
    )
    if not touched:
        return Merge(nothing, nothing, [])
    old = present.filter(partition_filter(touched, partition_by))
    # One pass over the old rows tells those whose keys are wanted from the rest.
    hits = wanted.distinct().withColumn(_HIT, F.lit(True))
    told = staged(old.join(hits, list(keys), "left"), "merge-old")
    contested = told.filter(F.col(_HIT)).select(*columns)
    both = contested.withColumn(_FRESH, F.lit(0)).unionByName(fresh.withColumn(_FRESH, F.lit(1)))
    # Behind all other columns: of equal rows the one that is there already stays.
    settled = keep_latest(
        both.withColumn("__old", 1 - F.col(_FRESH)), keys, newest_by, [*tie_break, "__old"]
    ).drop("__old")
    # Tables staged here are narrow and cheap to read again, so rounds may be larger.
    rounds = rounds_for(spark, both.inputFiles(), at_once=3)
    settled = staged_in_rounds(settled, "merge-settled", keys, rounds)
    added = settled.filter(F.col(_FRESH) == 1).drop(_FRESH)
    removed = contested.join(added.select(*keys), list(keys), "left_semi").select(*columns)
    rest = told.filter(F.col(_HIT).isNull()).select(*columns)
    merged = settled.drop(_FRESH).unionByName(rest)
    replace_partitions(merged, path, partition_by, touched, rounds)
    return Merge(added, removed, touched)


def merge_silver(
    delta: DataFrame,
    contract: Contract,
    silver_path: str,
    quarantine_path: str | None = None,
    *,
    partition_by: Sequence[str] = ("game_year",),
    run: str = "0",
    as_of: date | None = None,
    run_ts: datetime | None = None,
    on_invalid: str | None = None,
    on_unknown: str | None = None,
) -> Merge:
    """Bring silver, and quarantine, up to date with a delta of bronze.

    Keys must not be null in accepted rows, as in all contracts. Rejected rows go to the
    quarantine's partition ``run``, which a repeated run replaces. Contracts that drop
    columns decide ties between versions by those columns that silver has.
    """
    tables = build_silver(
        delta, contract, as_of=as_of, run_ts=run_ts, on_invalid=on_invalid, on_unknown=on_unknown
    )
    available = {name.lower() for name in tables.silver.columns}
    ties = [c for c in tie_break_columns(tables.silver, contract) if c.lower() in available]
    done = merge_rows(
        tables.silver, silver_path, contract.latest.keys, contract.latest.newest_by, ties, partition_by
    )
    if quarantine_path:
        rejected = tables.quarantine.withColumn("run", F.lit(run))
        replace_partitions(staged(rejected, "merge-rejected"), quarantine_path, ["run"], [Row(run=run)])
    return done
