"""Catalog tables: scans, databases and publication."""

from __future__ import annotations

from urllib.parse import unquote
from uuid import uuid4

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType

from lodeworks.sources import storage
from lodeworks.sources.sinks import write_parquet


def scan_table(spark: SparkSession, database: str, table: str) -> DataFrame:
    return spark.read.table(f"{database}.{table}")


def ensure_database(spark: SparkSession, database: str, location: str | None = None) -> None:
    where = f" LOCATION '{location}'" if location else ""
    spark.sql(f"CREATE DATABASE IF NOT EXISTS {database}{where}")


def register_external(spark: SparkSession, name: str, path: str) -> DataFrame:
    """A catalog entry over parquet files that stay where they are.

    On every call the entry is brought up to date with the files, without a moment in
    which it is missing: another place and further columns are set on it, new partitions
    are added and those that are gone are dropped. Only an entry whose columns were
    removed, retyped or partitioned otherwise is dropped and made anew. Only entries of
    external data are changed; a managed table of that name is an error.
    """
    files = spark.read.parquet(path)
    kind = table_type(spark, name)
    if kind == "MANAGED":
        raise ValueError(f"{name} is a managed table; dropping it would delete its data")
    if kind is not None and not (kind == "EXTERNAL" and _extended(spark, name, files, path)):
        spark.sql(f"DROP {'VIEW' if kind == 'VIEW' else 'TABLE'} {name}")
        kind = None
    if kind is None:
        spark.catalog.createTable(name, path=path, source="parquet")
    if _partition_columns(spark, name):
        spark.catalog.recoverPartitions(name)
        _drop_gone_partitions(spark, name, path)
    spark.catalog.refreshTable(name)
    return spark.read.table(name)


def _partition_columns(spark: SparkSession, name: str) -> list[str]:
    return [column.name for column in spark.catalog.listColumns(name) if column.isPartition]


def _extended(spark: SparkSession, name: str, files: DataFrame, path: str) -> bool:
    """Set place and further columns of an entry; false if it has others than the files."""
    has, wanted = dict(_shape(spark.read.table(name).schema)), dict(_shape(files.schema))
    keys = _partition_columns(spark, name)
    if any(wanted.get(column) != kind for column, kind in has.items()):
        return False
    if set(keys) != set(_directory_keys(files)):
        return False
    more = [f"`{column}` {kind}" for column, kind in wanted.items() if column not in has]
    if more:
        spark.sql(f"ALTER TABLE {name} ADD COLUMNS ({', '.join(more)})")
    if _location(spark, name) != path.removeprefix("file:").rstrip("/"):
        for spec in _partition_specs(spark, name) if keys else ():
            spark.sql(f"ALTER TABLE {name} DROP IF EXISTS PARTITION ({spec})")
        spark.sql(f"ALTER TABLE {name} SET LOCATION '{path}'")
    return True


def _directory_keys(files: DataFrame) -> list[str]:
    """The columns that stand in the names of the files' directories."""
    relation = files._jdf.queryExecution().analyzed().collectLeaves().head().relation()
    return list(relation.partitionSchema().fieldNames())


def _partition_specs(spark: SparkSession, name: str) -> list[str]:
    """All partitions of an entry, as the catalog is told them."""
    rows = spark.sql(f"SHOW PARTITIONS {name}").collect()
    return [_spec(dict(cell.split("=", 1) for cell in r["partition"].split("/"))) for r in rows]


def _spec(values: dict[str, str]) -> str:
    def told(key: str, value: str) -> str:
        if value == "__HIVE_DEFAULT_PARTITION__":
            return f"`{key}` = NULL"
        text = unquote(value).replace("\\", "\\\\").replace("'", "\\'")
        return f"`{key}` = '{text}'"

    return ", ".join(told(key, value) for key, value in values.items())


def _drop_gone_partitions(spark: SparkSession, name: str, path: str) -> None:
    """Drop the partitions whose directories no longer hold files."""
    held = {unquote(file.rpartition("/")[0]) for file in storage.files_below(spark, path)}
    for row in spark.sql(f"SHOW PARTITIONS {name}").collect():
        if unquote(row["partition"]) not in held:
            cells = dict(cell.split("=", 1) for cell in row["partition"].split("/"))
            spark.sql(f"ALTER TABLE {name} DROP IF EXISTS PARTITION ({_spec(cells)})")


def table_type(spark: SparkSession, name: str) -> str | None:
    """MANAGED, EXTERNAL or VIEW; none if there is no such table."""
    if not spark.catalog.tableExists(name):
        return None
    return spark.catalog.getTable(name).tableType


def _location(spark: SparkSession, name: str) -> str:
    rows = spark.sql(f"DESCRIBE TABLE EXTENDED {name}").where("col_name = 'Location'").collect()
    return rows[0]["data_type"].removeprefix("file:").rstrip("/") if rows else ""


def register_delimited(
    spark: SparkSession, name: str, path: str, schema: StructType, sep: str = ","
) -> DataFrame:
    """A catalog entry with a fixed schema over headerless delimited text.

    Entries read plain fields only; files with escaped separators need ``scan_delimited``.
    """
    spark.catalog.createTable(
        name, path=path, source="csv", schema=schema, sep=sep, quote="", header="false"
    )
    return spark.read.table(name)


def overwrite_table(df: DataFrame, name: str, path: str | None = None) -> None:
    """Replace a table in place. Readers find it missing while it is written."""
    writer = df.write.mode("overwrite").format("parquet")
    if path is not None:
        writer = writer.option("path", path)
    writer.saveAsTable(name)


def publish_table(df: DataFrame, name: str, base_path: str) -> str:
    """Replace a table without a moment in which it is missing or half written.

    Data goes to a new directory below ``base_path``. Once the write has succeeded the
    name, a view over the directory, is pointed at it in one catalog operation, whether
    the columns changed or not. A failed run leaves the previous contents in place. A
    managed table of that name is an error, as its data would be lost; an external one
    is dropped (its files stay) before the first view is made. Superseded directories
    stay for readers that began before the switch, see ``remove_superseded``. Returns
    the directory that the name now reads.
    """
    spark = df.sparkSession
    kind = table_type(spark, name)
    if kind == "MANAGED":
        raise ValueError(f"{name} is a managed table; dropping it would delete its data")
    location = f"{_versions(name, base_path)}/{uuid4().hex}"
    write_parquet(df, location)
    if kind == "EXTERNAL":
        spark.sql(f"DROP TABLE {name}")
    spark.sql(f"CREATE OR REPLACE VIEW {name} AS SELECT * FROM parquet.`{location}`")
    return location


def _versions(name: str, base_path: str) -> str:
    return f"{base_path.rstrip('/')}/{name.split('.')[-1]}"


def remove_superseded(
    spark: SparkSession, name: str, base_path: str, current: str, keep: int = 1
) -> list[str]:
    """Delete directories that publications of ``name`` before ``current`` have left.

    The ``keep`` newest of them stay for running readers. Returns what was deleted.
    """
    own = current.rstrip("/").rsplit("/", 1)[-1]
    old = [x for x in storage.children(spark, _versions(name, base_path)) if x.rsplit("/", 1)[-1] != own]
    gone = old[: len(old) - keep] if keep else old
    for path in gone:
        storage.remove(spark, path)
    return gone


def _shape(schema) -> list[tuple[str, str]]:
    return [(field.name, field.dataType.simpleString()) for field in schema.fields]
