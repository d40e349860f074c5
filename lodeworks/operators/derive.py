"""Apply derivation steps of a contract."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame

from lodeworks.contract import Step


def derive(df: DataFrame, steps: Iterable[Step], as_of: Column) -> DataFrame:
    """Run the steps in order; later ones may use columns of earlier ones."""
    for step in steps:
        df = df.withColumns(step(as_of))
    return df
