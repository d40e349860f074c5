"""File scans with explicit schemas and file lineage."""

from __future__ import annotations

import re

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, DataFrameReader, SparkSession, functions as F
from pyspark.sql.types import IntegerType, LongType, StringType, StructField, StructType

from lodeworks.operators.audit import SOURCE_FILE
from lodeworks.operators.clean import enforce_types, rename_by_position


# One fixed-width form, so that timestamps written as text sort in time order and
# keep their microseconds.
TEXT_TIMESTAMP = "yyyy-MM-dd HH:mm:ss.SSSSSS"


def with_lineage(scan: DataFrame) -> DataFrame:
    """Add the file each row was read from; only possible right at a scan.

    Scans without a metadata column (tables of other storage handlers) fall back
    to the name of the file being read, and rows from no file get NULL.
    """
    try:
        return scan.withColumn(SOURCE_FILE, F.col("_metadata.file_path"))
    except AnalysisException:
        return scan.withColumn(SOURCE_FILE, F.nullif(F.input_file_name(), F.lit("")))


def scan_parquet(spark: SparkSession, path: str, schema: StructType | None = None) -> DataFrame:
    reader = spark.read if schema is None else spark.read.schema(schema)
    return reader.parquet(path)


_PARTS = "__parts"


def _split(lines: DataFrame, sep: str, escape: str | None, schema: StructType) -> DataFrame:
    """Fields of each line, split at separators that no ``escape`` stands before.

    A line is split once, into a column of its own that all fields are taken from: split
    within each field's expression, a line is split as often as it has fields.
    """
    raw = F.col("value")
    if escape is None:
        parts = F.split(raw, re.escape(sep), -1)
    else:
        # An escaped escape and an escaped separator are written as a mark and a digit
        # meanwhile, and so is the mark itself: whatever the text holds comes back.
        mark = "\ue000"
        if sep in (mark, escape) or sep.isdigit():
            raise ValueError(f"{sep!r} cannot be a separator of escaped text")
        line = raw
        held = ((mark, mark + "0"), (escape * 2, mark + "1"), (escape + sep, mark + "2"))
        for plain, code in held:
            line = F.replace(line, F.lit(plain), F.lit(code))
        codes = [(escape + "n", "\n"), (escape + "r", "\r"), (mark + "2", sep), (mark + "1", escape)]
        codes.append((mark + "0", mark))

        def decoded(text: Column) -> Column:
            for code, plain in codes:
                text = F.replace(text, F.lit(code), F.lit(plain))
            return text

        # Most lines hold neither: their fields are what stands between separators.
        coded = F.contains(raw, F.lit(escape)) | F.contains(raw, F.lit(mark))
        parts = F.when(
            coded, F.transform(F.split(line, re.escape(sep), -1), decoded)
        ).otherwise(F.split(raw, re.escape(sep), -1))
    names = schema.fieldNames()
    return lines.select(parts.alias(_PARTS)).select(
        *(F.get(_PARTS, F.lit(i)).alias(name) for i, name in enumerate(names))
    )


def scan_delimited(
    spark: SparkSession,
    path: str | list[str],
    schema: StructType,
    sep: str = ",",
    null_value: str | None = None,
    escape: str | None = "\\",
) -> DataFrame:
    """Headerless delimited text without quoting, columns by position.

    Fields that do not parse as their type become NULL, and so do empty ones and those
    equal to ``null_value``; fields beyond the schema are left out. Separators, line
    breaks and escapes within a field are written with an ``escape``, as ``write_delimited``
    does, so no record spans lines and files stay splittable. Files of other writers have
    none: with ``escape=None`` every separator separates and all other characters are
    what they are, like in a catalog entry of ``register_delimited``.
    """
    texts = _split(spark.read.text(path), sep, escape, schema)
    empty = ("",) if null_value is None else ("", null_value)
    texts = texts.select(
        *(F.when(~F.col(f"`{n}`").isin(*empty), F.col(f"`{n}`")).alias(n) for n in texts.columns)
    )
    return enforce_types(texts, schema)


def _quoted(reader: DataFrameReader, multiline: bool) -> DataFrameReader:
    """Options for quoted fields: a doubled quote within one is one quote."""
    return reader.option("quote", '"').option("escape", '"').option("multiLine", multiline)


def _lenient(schema: StructType) -> StructType:
    """Whole numbers as text first, since ``9.0`` is one as well."""
    whole = (IntegerType, LongType)
    return StructType(
        [
            StructField(f.name, StringType() if isinstance(f.dataType, whole) else f.dataType, True)
            for f in schema.fields
        ]
    )


def scan_headerless_csv(
    spark: SparkSession,
    path: str,
    schema: StructType,
    null_value: str = "null",
    multiline: bool = False,
    corrupt_column: str | None = None,
) -> DataFrame:
    """Headerless quoted CSV whose columns are named by position.

    The types are declared instead of inferred, which would read the data twice. See
    ``scan_csv_with_header`` for ``multiline`` and ``corrupt_column``.
    """
    reader = spark.read
    lenient = StructType(
        [StructField(f"_c{i}", f.dataType, True) for i, f in enumerate(_lenient(schema).fields)]
    )
    carried = [corrupt_column] if corrupt_column else []
    if corrupt_column:
        lenient = lenient.add(corrupt_column, StringType())
        reader = reader.option("columnNameOfCorruptRecord", corrupt_column)
    reader = _quoted(reader.schema(lenient).option("header", False), multiline)
    rows = reader.option("nullValue", null_value).csv(path)
    return enforce_types(
        rename_by_position(rows, [*schema.fieldNames(), *carried]), schema, carried
    )


def scan_csv_with_header(
    spark: SparkSession,
    path: str,
    schema: StructType | None = None,
    multiline: bool = False,
    corrupt_column: str | None = None,
) -> DataFrame:
    """CSV whose header names the columns.

    Only one header line is read up front. Columns found in ``schema`` (in any
    order and case) get its names and types, all others are text. A file whose header
    differs from that of the first file fails instead of being read under wrong names.

    ``multiline`` lets quoted fields hold line breaks, at the price that a file is read by
    one task. ``corrupt_column`` adds a column with the text of records that do not fit,
    which otherwise only show as NULLs.
    """
    header = _quoted(spark.read.option("header", True), multiline).csv(path).columns
    known = {} if schema is None else {f.name.lower(): f for f in schema.fields}
    by_header = StructType(
        [
            StructField(name, known[name.lower()].dataType if name.lower() in known else StringType())
            for name in header
        ]
    )
    lenient = _lenient(by_header)
    reader = spark.read.option("header", True).option("enforceSchema", False)
    if corrupt_column:
        lenient = lenient.add(corrupt_column, StringType())
        reader = reader.option("columnNameOfCorruptRecord", corrupt_column)
    rows = _quoted(reader.schema(lenient), multiline).csv(path)
    rows = enforce_types(rows, by_header, [corrupt_column] if corrupt_column else [])
    return rows.withColumnsRenamed(
        {name: known[name.lower()].name for name in header if name.lower() in known}
    )
