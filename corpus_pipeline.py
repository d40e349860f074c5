"""A corpus through language filter, near-dedup, decontamination, secret scan and packing.

Each stage takes ``(spark, docs, sf_dir)``. ``run`` writes what a stage returns as Parquet
and reads it back as the next one's documents, so a lost executor never costs more than
the stage at hand. All stages but the last return the columns of ``documents``.

``documents`` columns may hold nulls, and rows may repeat. Every row is judged by itself,
whatever rows of the same ``doc_id`` or without one hold: stages carry their decisions by
the id and the text. Of each near-duplicate group, repeated rows included, exactly one
row stays. A null text goes in the language stage. Further columns pass through every
stage but the last.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from lodeworks.llm import language_id, secret_scan
from lodeworks.llm.common import fresh_path, released, table
from lodeworks.llm.decontamination import contamination
from lodeworks.llm.minhash import one_of_each_group
from lodeworks.llm.packing import pack_documents
from lodeworks.sources import storage

import public_tokenizers  # noqa: E402 - behind lodeworks.llm, whose absence is to be told first

#: Words of a benchmark passage for which a document goes, and ids of a packed sequence.
PASSAGE_WORDS, CAPACITY = 10, 2048


def filter_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drop documents that are in none of the languages that ``lang`` labels.

    The models learn from the labelled documents themselves. Texts that no model explains
    go, and so do texts without a letter. If no document has a label all are kept.
    """
    model = language_id.train(docs.select("doc_id", "text", "lang"))
    if model is None:
        return docs
    return language_id.predict(docs, model).where("NOT rejected").select(*docs.columns)


def _row_key() -> Column:
    """A hash of id and text: equal rows are judged alike."""
    return F.xxhash64("doc_id", "text")


def _without(docs: DataFrame, keys: DataFrame) -> DataFrame:
    """Rows whose key is not among those of the one column of ``keys``."""
    gone = keys.toDF("_gone_key").distinct()
    own = docs.withColumn("_row_key", _row_key())
    return own.join(gone, F.col("_row_key") == F.col("_gone_key"), "left_anti").select(*docs.columns)


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keep of each group of near-duplicates one row, of the document with the smallest ``doc_id``.

    Five-word shingles, similarity of 0.8 or more. Null ids are never the smallest. Of
    several texts of that id one stays, and of equal rows one. Documents without words
    are kept.
    """

    def keyed(rows: DataFrame, text_hash: Column) -> DataFrame:
        number = F.col("doc_id").cast("long")
        return rows.withColumns(
            {
                "_near_id": F.coalesce(number, F.lit(0)),
                "_near_null": number.isNull(),
                "_near_hash": text_hash,
            }
        )

    keys = ["_near_id", "_near_null", "_near_hash"]
    kept = keyed(one_of_each_group(docs, size=5, percent=80), F.col("text_hash")).select(
        *keys, F.col("linked").alias("_near_linked")
    )
    # Rows of one id and text differ in other columns at most. The window is partitioned
    # like the join, so texts are shuffled once.
    others = [F.col(f"`{c}`") for c in docs.columns if c not in ("doc_id", "text")]
    order = F.xxhash64(F.to_json(F.struct(*others))) if others else F.lit(0)
    copy = F.row_number().over(Window.partitionBy(*keys).orderBy(order))
    return (
        keyed(docs, F.xxhash64("text"))
        .join(kept, keys)
        .withColumn("_near_copy", copy)
        .where(~F.col("_near_linked") | (F.col("_near_copy") == 1))
        .select(*docs.columns)
    )


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drop documents that hold a passage of ``PASSAGE_WORDS`` words of a benchmark item,
    or a whole shorter item, whether the item has an id or not."""
    rows = docs.select(_row_key().alias("doc_id"), "text")
    found = contamination(rows, table(spark, sf_dir, "benchmark"), size=PASSAGE_WORDS)
    return _without(docs, found.where("contaminated").select("doc_id"))


def drop_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drop documents in which a secret is found."""
    ledger = fresh_path(spark, "secret-ledger")
    rows = docs.select(_row_key().alias("row_key"), "text")
    found = secret_scan.scan_history(rows, ledger)
    return _without(docs, found.where(F.size("findings") > 0).select("row_key"))


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pack what is left into sequences; one row per piece."""
    return pack_documents(docs, public_tokenizers.path("byte_bpe_50k.json"), CAPACITY).select(
        "doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset"
    )


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("language", filter_language),
    ("near_duplicates", drop_near_duplicates),
    ("decontamination", drop_contaminated),
    ("secrets", drop_secrets),
    ("packing", pack),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``.

    What a stage wrote for itself is deleted when its result is written, and that result
    when the next one's is.
    """
    docs, before = table(spark, sf_dir, "documents"), None
    for name, stage in STAGES:
        path = fresh_path(spark, f"stage-{name}")
        with released(spark):
            stage(spark, docs, sf_dir).write.option("compression", "zstd").parquet(path)
        docs = spark.read.parquet(path)
        if before:
            storage.remove(spark, before)
        before = path
    return docs


#: Tokenization and packing have no SQL; tests compare with a brute-force version.
ORACLE_SQL: str | None = None

QUERIES = {"pipeline": run}
ORACLE: dict[str, str] = {}
