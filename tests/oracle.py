"""Side-by-side comparison of a Spark result with DuckDB SQL."""

from __future__ import annotations

from collections import Counter

import duckdb

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings "
    "pages benchmark labels conversations"
).split()
TYPES = {
    "string": "VARCHAR",
    "int": "INTEGER",
    "bigint": "BIGINT",
    "double": "DOUBLE",
    "date": "DATE",
    "timestamp": "TIMESTAMP",
    "timestamp_ntz": "TIMESTAMP",
    "boolean": "BOOLEAN",
}


def connect(sf_dir):
    connection = duckdb.connect()
    for table in TABLES:
        connection.sql(
            f"CREATE VIEW {table} AS SELECT * FROM read_parquet('{sf_dir}/{table}.parquet')"
        )
    return connection


def differences(frame, relation):
    """Human-readable differences in names, types or rows; empty if none."""
    found = []
    expected = dict(zip(relation.columns, map(str, relation.types)))
    actual = {name: TYPES.get(kind, kind) for name, kind in frame.dtypes}
    if actual != expected:
        found.append(f"schema: {sorted(actual.items() ^ expected.items())}")
    names = sorted(actual)
    if names != sorted(expected):
        return found
    left = Counter(frame.select(*(f"`{n}`" for n in names)).collect())
    right = Counter(relation.project(", ".join(f'"{n}"' for n in names)).fetchall())
    left = Counter({tuple(row): count for row, count in left.items()})
    if left != right:
        only_left, only_right = left - right, right - left
        found.append(
            f"rows: {sum(left.values())} against {sum(right.values())}, "
            f"{sum(only_left.values())} and {sum(only_right.values())} unmatched, for instance "
            f"{sorted(map(str, only_left))[:1]} against {sorted(map(str, only_right))[:1]}"
        )
    return found
