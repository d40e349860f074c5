"""Sets of tables that are published together.

Every table of a set is written below ``<base>/<table>/snapshot=<id>``. The names are views
that read the one snapshot which the set's pointer names, and the pointer is a view of
one row: replacing it is a single catalog operation, by which all names change at once.
Until then readers see the previous set, whatever was already written or has failed.
Earlier snapshots stay readable and can be pointed at again.
"""

from __future__ import annotations

from collections.abc import Mapping
from uuid import uuid4

from pyspark.sql import DataFrame, SparkSession, functions as F

from lodeworks.sources import storage
from lodeworks.sources.sinks import write_parquet
from lodeworks.sources.tables import ensure_database, table_type

#: The pointer stands in a database beside the set's own, which so holds the set alone.
POINTER = "_publication.published_snapshot"
#: Orders snapshots by the time of their publication.
_STAMP = "yyyyMMddHHmmssSSSSSS"


def _pointer(database: str) -> str:
    return f"{database}{POINTER}"


def current(spark: SparkSession, database: str) -> str | None:
    """The snapshot that the names of the set read; none before the first publication."""
    if not spark.catalog.tableExists(_pointer(database)):
        return None
    return spark.read.table(_pointer(database)).first()["snapshot"]


def point_at(spark: SparkSession, database: str, snapshot: str) -> None:
    """Let all names read another snapshot, in one catalog operation."""
    spark.sql(f"CREATE OR REPLACE VIEW {_pointer(database)} AS SELECT '{snapshot}' AS snapshot")


def _directory(base_path: str, table: str, snapshot: str) -> str:
    return f"{base_path.rstrip('/')}/{table}/snapshot={snapshot}"


def read_snapshot(spark: SparkSession, base_path: str, table: str, snapshot: str) -> DataFrame:
    """One table of an earlier, or the current, snapshot."""
    return spark.read.parquet(_directory(base_path, table, snapshot))


def publish_set(
    spark: SparkSession, tables: Mapping[str, DataFrame], database: str, base_path: str
) -> str:
    """Write all tables as one snapshot, then switch all names to it. Returns its id.

    A table whose columns differ from those it is published with is an error, as readers
    of its name would see the new columns before the switch: publish that set below a
    database of its own.
    """
    ensure_database(spark, database)
    ensure_database(spark, _pointer(database).split(".")[0])
    before = current(spark, database)
    for name, table in tables.items():
        view = f"{database}.{name}"
        kind = table_type(spark, view)
        if kind not in (None, "VIEW"):
            raise ValueError(f"{view} is a table of its own")
        if kind and spark.read.table(view).dtypes != table.dtypes:
            raise ValueError(f"{view} is published with other columns")
    stamp = spark.range(1).select(F.date_format(F.current_timestamp(), _STAMP)).first()[0]
    snapshot = f"{stamp}-{uuid4().hex[:8]}"
    for name, table in tables.items():
        write_parquet(table, _directory(base_path, name, snapshot))
    if before is None:
        point_at(spark, database, snapshot)
    for name, table in tables.items():
        if not _follows(spark, database, name):
            _create_view(spark, database, name, table, base_path)
    if before is not None:
        point_at(spark, database, snapshot)
    return snapshot


def _follows(spark: SparkSession, database: str, name: str) -> bool:
    """Whether the name is a view that reads what the pointer says."""
    view = f"{database}.{name}"
    if table_type(spark, view) is None:
        return False
    return POINTER.split(".")[1] in spark.sql(f"SHOW CREATE TABLE {view}").first()[0]


def _create_view(
    spark: SparkSession, database: str, name: str, table: DataFrame, base_path: str
) -> None:
    # The pointer is looked up before the scan, as a filter on the partition column, so that
    # only the directory of one snapshot is read.
    listed = ", ".join(f"`{column}`" for column in table.columns)
    spark.sql(
        f"CREATE OR REPLACE VIEW {database}.{name} AS SELECT {listed} "
        f"FROM parquet.`{base_path.rstrip('/')}/{name}` "
        f"WHERE snapshot = (SELECT snapshot FROM {_pointer(database)})"
    )


def snapshots(spark: SparkSession, base_path: str, tables: Mapping[str, object]) -> list[str]:
    """Snapshots that all tables have, oldest first; unfinished ones lack some."""
    found = [
        {path.rstrip("/").rsplit("snapshot=", 1)[-1] for path in storage.children(spark, f"{base_path.rstrip('/')}/{name}")}
        for name in tables
    ]
    return sorted(set.intersection(*found)) if found else []


def remove_snapshots(
    spark: SparkSession, database: str, base_path: str, tables: Mapping[str, object], keep: int = 1
) -> list[str]:
    """Delete all but the current snapshot and the ``keep`` newest finished ones before it,
    and what unfinished runs before it left. Returns what was deleted."""
    now = current(spark, database)
    finished = [s for s in snapshots(spark, base_path, tables) if now is None or s < now]
    stay = {now, *finished[len(finished) - keep :]} if keep else {now}
    gone = set()
    for name in tables:
        for path in storage.children(spark, f"{base_path.rstrip('/')}/{name}"):
            snapshot = path.rstrip("/").rsplit("snapshot=", 1)[-1]
            if snapshot not in stay and now is not None and snapshot < now:
                storage.remove(spark, path)
                gone.add(snapshot)
    return sorted(gone)
