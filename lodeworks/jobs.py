"""Command-line jobs for spark-submit, one per stage of the pipeline.

    python -m lodeworks.jobs load games.csv /bronze/games --entity games
    python -m lodeworks.jobs silver games --table bronze.games --silver /silver/games \\
        --quarantine /quarantine/games
    python -m lodeworks.jobs gold --silver-db silver --gold-db gold --base-path /gold
    python -m lodeworks.jobs star --silver-root /silver --gold-root /gold
"""

from __future__ import annotations

import argparse
from collections.abc import Sequence
from datetime import date, datetime, timedelta, timezone

from pyspark.sql import DataFrame, Observation, SparkSession, functions as F

from lodeworks.contract import Contract
from lodeworks.contracts import CONTRACTS
from lodeworks.operators.audit import row_counts
from lodeworks.plans.gold import gold_tables_from_seasons, player_seasons, team_seasons
from lodeworks.plans.silver import build_silver
from lodeworks.plans.star import STAR, sources, star_table
from lodeworks.sources import storage
from lodeworks.sources.files import (
    scan_csv_with_header,
    scan_delimited,
    scan_parquet,
    with_lineage,
)
from lodeworks.sources.jdbc import (
    Split,
    append_jdbc,
    bounds_query,
    derived_split,
    replace_jdbc,
    scan_jdbc,
)
from lodeworks.sources.session import session
from lodeworks.sources.sinks import replace_parquet, write_delimited, write_parquet
from lodeworks.sources.snapshots import publish_set, remove_snapshots
from lodeworks.sources.staging import fresh_path
from lodeworks.sources.tables import ensure_database, register_external, scan_table
from lodeworks.streaming.incremental import (
    CUTOFF,
    incremental_append,
    last_value,
    since_cutoff,
)
from lodeworks.streaming.load_log import logged_append
from lodeworks.streaming.merge import merge_silver


def load_csv(
    spark: SparkSession,
    path: str,
    contract: Contract,
    cutoff: str = CUTOFF,
    rejects: str | None = None,
    multiline: bool = False,
) -> DataFrame:
    """Typed rows of a CSV with header; time-based tables start at the cutoff.

    Records that do not fit their columns are written to ``rejects``, if that is given,
    with their text; ``multiline`` reads quoted line breaks.
    """
    corrupt = "_corrupt_record" if rejects else None
    rows = scan_csv_with_header(spark, path, contract.bronze, multiline, corrupt)
    if rejects:
        replace_parquet(rows.filter(F.col(corrupt).isNotNull()), rejects)
        rows = rows.filter(F.col(corrupt).isNull()).drop(corrupt)
    ts_column = contract.timestamp_from
    return since_cutoff(rows, ts_column, cutoff) if ts_column else rows


def run_silver(
    bronze: DataFrame,
    contract: Contract,
    silver_path: str,
    quarantine_path: str | None = None,
    *,
    as_of: date | None = None,
    partition_by: Sequence[str] = (),
    num_partitions: int | None = None,
    on_invalid: str | None = None,
    on_unknown: str | None = None,
) -> DataFrame:
    """Write both outputs and return the row counts per layer.

    Each output is its own scan of bronze: the quarantine pass has no shuffle,
    which is cheaper than writing and re-reading all cleaned rows. Both carry
    the same run timestamp, so they can be matched afterwards.

    Bronze is counted while the quarantine is written, in a pass without a shuffle, whose
    tasks count once however often they were run; a third scan is made only if no
    quarantine is asked for. The other counts come from the footers of what was written.
    """
    started = datetime.now(timezone.utc)
    options = {
        "as_of": as_of or started.date(),
        "run_ts": started,
        "on_invalid": on_invalid,
        "on_unknown": on_unknown,
    }
    replace_parquet(
        build_silver(bronze, contract, **options).silver,
        silver_path,
        partition_by=partition_by,
        num_partitions=num_partitions,
    )
    spark = bronze.sparkSession
    silver = {"silver": scan_parquet(spark, silver_path)}
    if not quarantine_path:
        return row_counts({"bronze": bronze, **silver})
    seen = Observation()
    watched = bronze.observe(seen, F.count(F.lit(1)).alias("rows"))
    replace_parquet(build_silver(watched, contract, **options).quarantine, quarantine_path)
    # Nothing is observed where the optimizer sees that there are no rows.
    observed = spark.createDataFrame(
        [("bronze", seen.get.get("rows", 0))], "layer string, row_count long"
    )
    return observed.unionAll(
        row_counts({**silver, "quarantine": scan_parquet(spark, quarantine_path)})
    )


def run_gold(
    stats: DataFrame, games: DataFrame, gold_db: str, base_path: str, keep: int = 1
) -> list[str]:
    """Publish all gold tables as one snapshot, from one pass over each silver table.

    All names change in one catalog operation (see ``snapshots.publish_set``). Afterwards
    the staged aggregates and all but ``keep`` earlier snapshots are deleted.
    """
    spark = stats.sparkSession
    players, teams = fresh_path(spark, "player-seasons"), fresh_path(spark, "team-seasons")
    write_parquet(player_seasons(stats), players)
    write_parquet(team_seasons(games), teams)
    tables = gold_tables_from_seasons(scan_parquet(spark, players), scan_parquet(spark, teams))
    publish_set(spark, tables, gold_db, base_path)
    remove_snapshots(spark, gold_db, base_path, tables, keep)
    for path in (players, teams):
        storage.remove(spark, path)
    return list(tables)


def run_star(
    spark: SparkSession, silver_root: str, gold_root: str, names: Sequence[str] | None = None
) -> list[str]:
    """Write dimensions and fact, or those named, next to each other below ``gold_root``.

    Only the silver that the tables to write are made from has to be there.
    """
    names = list(names or STAR)
    silver = {name: scan_parquet(spark, f"{silver_root}/{name}") for name in sources(names)}
    for name in names:
        replace_parquet(star_table(name, silver), f"{gold_root}/{name}")
    return names


# -- command line ----------------------------------------------------------


def _pairs(options: Sequence[str]) -> dict[str, str]:
    return dict(option.split("=", 1) for option in options)


def _parser() -> argparse.ArgumentParser:
    parser = argparse.ArgumentParser(prog="lodeworks.jobs")
    parser.add_argument("--hive", action="store_true", help="use the Hive metastore")
    jobs = parser.add_subparsers(dest="job", required=True)

    load = jobs.add_parser("load", help="CSV with header into a bronze table")
    load.add_argument("csv")
    load.add_argument("target", help="parquet directory, or table with --url")
    load.add_argument("--entity", required=True, choices=CONTRACTS)
    load.add_argument("--cutoff", default=CUTOFF)
    load.add_argument("--replace", action="store_true")
    load.add_argument("--rejects", help="directory for records that do not fit")
    load.add_argument("--multiline", action="store_true", help="quoted line breaks")
    load.add_argument("--url", help="JDBC url; writes to a database instead of files")
    load.add_argument("--property", action="append", default=[], metavar="KEY=VALUE")

    pull = jobs.add_parser("import", help="database table into bronze")
    pull.add_argument("table")
    pull.add_argument("target")
    pull.add_argument("--url", required=True)
    pull.add_argument("--property", action="append", default=[], metavar="KEY=VALUE")
    pull.add_argument("--split", nargs=4, metavar=("COLUMN", "LOWER", "UPPER", "PARTITIONS"))
    pull.add_argument("--split-by", nargs=2, metavar=("COLUMN", "PARTITIONS"),
                      help="bounds are asked from the database, for the new rows only")
    pull.add_argument("--one-task", action="store_true", help="read a small table in one task")
    pull.add_argument("--key", action="append", default=[], help="tells repeated rows in a lookback")
    pull.add_argument("--undated", help="directory for rows without a time (default: TARGET-undated)")
    pull.add_argument("--newer-by", metavar="COLUMN", help="append rows past the watermark")
    pull.add_argument("--lookback-days", type=float)
    pull.add_argument("--floor", help="a value the watermark is known to have reached")
    pull.add_argument("--delimited", action="store_true")
    pull.add_argument("--log", action="store_true",
                      help="record loads next to the target and read its watermark from there")

    silver = jobs.add_parser("silver", help="bronze into silver and quarantine")
    silver.add_argument("entity", choices=CONTRACTS)
    source = silver.add_mutually_exclusive_group(required=True)
    source.add_argument("--table", help="database.table")
    source.add_argument("--parquet")
    source.add_argument("--delimited")
    silver.add_argument("--plain", action="store_true", help="delimited text without escapes")
    silver.add_argument("--merge", metavar="RUN", help="the input is a delta: merge it as this run")
    silver.add_argument("--silver", required=True)
    silver.add_argument("--quarantine")
    silver.add_argument("--register", metavar="DATABASE.TABLE")
    silver.add_argument("--as-of", type=date.fromisoformat)
    silver.add_argument("--partition-by", action="append", default=[])
    silver.add_argument("--num-partitions", type=int)
    silver.add_argument("--on-invalid", choices=("quarantine", "discard"))
    silver.add_argument("--on-unknown", choices=("quarantine", "discard"))

    gold = jobs.add_parser("gold", help="silver tables into gold tables")
    gold.add_argument("--silver-db", required=True)
    gold.add_argument("--gold-db", required=True)
    gold.add_argument("--base-path", required=True)
    gold.add_argument("--keep", type=int, default=1, help="earlier publications to keep")

    star = jobs.add_parser("star", help="silver directories into dimensions and fact")
    star.add_argument("--silver-root", required=True)
    star.add_argument("--gold-root", required=True)
    star.add_argument("--table", action="append", choices=STAR, help="default: all")
    return parser


def _load(spark: SparkSession, args: argparse.Namespace) -> None:
    rows = load_csv(
        spark, args.csv, CONTRACTS[args.entity], args.cutoff, args.rejects, args.multiline
    )
    if args.url:
        write = replace_jdbc if args.replace else append_jdbc
        write(rows, args.url, args.target, _pairs(args.property))
    else:
        write_parquet(rows, args.target, mode="overwrite" if args.replace else "append")


def _import(spark: SparkSession, args: argparse.Namespace) -> None:
    properties, split = _pairs(args.property), None
    if args.split:
        column, lower, upper, partitions = args.split
        split = Split(column, lower, upper, int(partitions))
    elif args.split_by:
        column, partitions = args.split_by
        after = None
        if args.newer_by and not args.delimited:
            after = last_value(spark, args.target, args.newer_by, args.floor)
        bounds = bounds_query(args.table, column, args.newer_by, after)
        split = derived_split(spark, args.url, bounds, properties, column, int(partitions))
    elif not args.one_task:
        raise SystemExit("give --split-by, --split or, for a small table, --one-task")
    rows = scan_jdbc(spark, args.url, args.table, properties, split)
    if args.newer_by:
        lookback = timedelta(days=args.lookback_days) if args.lookback_days else None
        if args.log:
            logged_append(
                rows, args.target, args.newer_by, lookback, args.delimited, args.key, args.undated
            )
            return
        incremental_append(
            rows,
            args.target,
            args.newer_by,
            lookback,
            args.delimited,
            args.floor,
            args.key,
            args.undated,
        )
    elif args.delimited:
        write_delimited(rows, args.target)
    else:
        write_parquet(rows, args.target)


def _silver(spark: SparkSession, args: argparse.Namespace) -> None:
    contract = CONTRACTS[args.entity]
    if args.table:
        bronze = scan_table(spark, *args.table.split(".", 1))
    elif args.parquet:
        bronze = scan_parquet(spark, args.parquet)
    else:
        escape = None if args.plain else "\\"
        bronze = scan_delimited(spark, args.delimited, contract.bronze, escape=escape)
    if args.merge:
        if not args.partition_by:
            raise SystemExit("--merge needs --partition-by")
        merge_silver(
            with_lineage(bronze),
            contract,
            args.silver,
            args.quarantine,
            partition_by=args.partition_by,
            run=args.merge,
            as_of=args.as_of,
            run_ts=datetime.now(timezone.utc),
            on_invalid=args.on_invalid,
            on_unknown=args.on_unknown,
        )
    else:
        _rebuild(bronze, contract, args)
    if args.register:
        ensure_database(spark, args.register.split(".")[0])
        register_external(spark, args.register, args.silver)


def _rebuild(bronze: DataFrame, contract: Contract, args: argparse.Namespace) -> None:
    run_silver(
        with_lineage(bronze),
        contract,
        args.silver,
        args.quarantine,
        as_of=args.as_of,
        partition_by=args.partition_by,
        num_partitions=args.num_partitions,
        on_invalid=args.on_invalid,
        on_unknown=args.on_unknown,
    ).show()


def _gold(spark: SparkSession, args: argparse.Namespace) -> None:
    stats = scan_table(spark, args.silver_db, "player_statistics_silver")
    games = scan_table(spark, args.silver_db, "games_silver")
    print("\n".join(run_gold(stats, games, args.gold_db, args.base_path, args.keep)))


def _star(spark: SparkSession, args: argparse.Namespace) -> None:
    print("\n".join(run_star(spark, args.silver_root, args.gold_root, args.table)))


_JOBS = {"load": _load, "import": _import, "silver": _silver, "gold": _gold, "star": _star}


def main(argv: Sequence[str] | None = None) -> None:
    args = _parser().parse_args(argv)
    _JOBS[args.job](session(f"lodeworks {args.job}", hive=args.hive), args)


if __name__ == "__main__":
    main()
