"""Cleansing operators: null tokens, types, text, timestamps.

Each operator is a single ``select`` or ``withColumns`` call, so a whole chain
stays one projection after optimisation and analysis cost does not grow with
the number of columns touched.
"""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame, functions as F
from pyspark.sql.types import IntegerType, LongType, StringType, StructType

from lodeworks.functions.numeric import whole_number
from lodeworks.functions.temporal import calendar_parts, parsed_timestamp
from lodeworks.functions.text import NULL_TOKENS, null_if_token


def blank_null_tokens(
    df: DataFrame,
    tokens: tuple[str, ...] = NULL_TOKENS,
    except_columns: Iterable[str] = (),
) -> DataFrame:
    """Turn null tokens into NULL in every string column not excepted."""
    skipped = {name.lower() for name in except_columns}
    textual = [
        field.name
        for field in df.schema.fields
        if isinstance(field.dataType, StringType) and field.name.lower() not in skipped
    ]
    return df.withColumns({name: null_if_token(F.col(name), tokens) for name in textual})


def enforce_types(df: DataFrame, schema: StructType, carry: Iterable[str] = ()) -> DataFrame:
    """Project to the schema's columns and types; unusable values become NULL.

    Columns in ``carry`` follow unchanged (file lineage, for one). Values that
    already have the right type are passed through without a cast, and whole numbers
    written with a fraction lose it.
    """
    actual = {field.name.lower(): field.dataType for field in df.schema.fields}

    def typed_column(field):
        column, given = F.col(field.name), actual.get(field.name.lower())
        if given == field.dataType:
            return column
        if isinstance(given, StringType) and isinstance(field.dataType, (IntegerType, LongType)):
            return whole_number(column, field.dataType)
        return column.try_cast(field.dataType)

    typed = [typed_column(field).alias(field.name) for field in schema.fields]
    return df.select(*typed, *(F.col(name) for name in carry))


def tidy_text(
    df: DataFrame,
    trim: Iterable[str] = (),
    upper: Iterable[str] = (),
    initcap: Iterable[str] = (),
) -> DataFrame:
    """Trim spaces, then apply casing; a column may appear in several lists."""
    tidied = {name: F.trim(F.col(name)) for name in trim}
    for names, casing in ((upper, F.upper), (initcap, F.initcap)):
        for name in names:
            tidied[name] = casing(tidied.get(name, F.col(name)))
    return df.withColumns(tidied)


def parse_game_time(df: DataFrame, source: str, target: str) -> DataFrame:
    """Parse the text timestamp and add its date, year and month.

    With ``source == target`` the text column is overwritten in place.
    """
    ts = parsed_timestamp(F.col(source))
    return df.withColumns({target: ts, **calendar_parts(ts)})


def rename_by_position(df: DataFrame, names: Iterable[str]) -> DataFrame:
    """Give the columns new names in order."""
    return df.toDF(*names)


def drop_columns(df: DataFrame, names: Iterable[str]) -> DataFrame:
    return df.drop(*names)
