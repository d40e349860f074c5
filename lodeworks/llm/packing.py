"""Packing of documents into fixed-length training sequences.

Shortest-pack-first over the length histogram. Documents are cut into pieces of at
most ``capacity`` ids. Only the histogram of piece lengths, at most ``capacity``
numbers, reaches the driver; there the lengths are placed longest first, each into
the open pattern with the least filling that it fits into, and a pattern stands for
as many equal sequences as its count says. Pieces of a length are then numbered and
each takes the slot that the patterns hold for its number.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from lodeworks.llm.common import blocks, staged
from lodeworks.llm.token_ids import encoder, with_end

PIECES = "doc_id long, start long, length long, ids_crc32 long, doc_tokens long"
#: Bytes of text that a task encodes at once.
ENCODED_BYTES = 4 << 20
#: Parts into which the numbering of one length is split, so that a frequent length
#: (full pieces can be most of a corpus of long texts) is no single task.
SALTS = 1024


def token_pieces(
    docs: DataFrame, tokenizer: str, capacity: int, end_id: int, with_ids: bool = False
) -> DataFrame:
    """Each document's ids and the end id, cut every ``capacity`` ids.

    A null text is empty and gives one piece of the end id alone. Repeated rows are
    separate documents. ``with_ids`` adds the ids themselves (little-endian uint32).
    """

    def pieces(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in blocks(batches, limit=ENCODED_BYTES):
            ids, begins = with_end(*encoder(tokenizer).encode(batch.column("text")), end_id)
            raw = memoryview(ids.astype("<u4").tobytes())
            sizes = np.diff(begins)
            cuts = -(-sizes // capacity)
            owner = np.repeat(np.arange(len(sizes)), cuts)
            start = (np.arange(len(owner)) - np.repeat(np.cumsum(cuts) - cuts, cuts)) * capacity
            length = np.minimum(capacity, sizes[owner] - start)
            first = (begins[:-1][owner] + start) * 4
            parts = [raw[a : a + 4 * n] for a, n in zip(first.tolist(), length.tolist())]
            columns = {
                "doc_id": batch.column("doc_id").take(pa.array(owner)),
                "start": start,
                "length": length,
                "ids_crc32": np.fromiter(map(zlib.crc32, parts), np.int64, len(parts)),
                "doc_tokens": sizes[owner],
            }
            if with_ids:
                columns["ids"] = pa.array(map(bytes, parts), pa.binary())
            yield pa.RecordBatch.from_pydict(columns)

    schema = PIECES + (", ids binary" if with_ids else "")
    return docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(pieces, schema)


@dataclass(frozen=True)
class Slots:
    """Where the pieces of one length go: those numbered from ``rank`` on to
    sequences from ``sequence`` on, at one offset."""

    length: int
    rank: int
    sequence: int
    offset: int


def place(histogram: dict[int, int], capacity: int) -> list[Slots]:
    """Patterns for a histogram of lengths, as slots.

    Longest first, each into the open pattern with the smallest filling. A pattern with
    fewer copies than there are pieces takes that many; one with more is split. A pattern
    takes a length at most capacity / length times, so the number of steps is bounded by
    the capacity, whatever the number of pieces.
    """
    # filling -> list of (sequence, count): copies of a pattern have adjacent numbers.
    opened: dict[int, list[tuple[int, int]]] = {}
    slots, sequences = [], 0
    for length in sorted(histogram, reverse=True):
        rank, left = 0, histogram[length]
        while left:
            filling = min((x for x in opened if x + length <= capacity), default=None)
            if filling is None:
                sequence, count, filling = sequences, left, 0
                sequences += left
            else:
                sequence, count = opened[filling].pop()
                if not opened[filling]:
                    del opened[filling]
            used = min(count, left)
            slots.append(Slots(length, rank, sequence, filling))
            if used < count:
                opened.setdefault(filling, []).append((sequence + used, count - used))
            if filling + length < capacity:
                opened.setdefault(filling + length, []).append((sequence, used))
            rank, left = rank + used, left - used
    return slots


def pack(pieces: DataFrame, capacity: int) -> DataFrame:
    """Add ``sequence_id`` and ``offset`` to pieces with ``doc_id, start, length``.

    Pieces of length 0 or none at all give no rows; lengths above ``capacity`` are an
    error of the caller and raise. Other columns are kept.
    """
    spark = pieces.sparkSession
    columns = [c for c in pieces.columns if c not in ("_salt", "_before", "sequence_id", "offset")]
    salted = (
        pieces.where("length > 0")
        .select(*columns)
        .withColumn("_salt", F.pmod(F.xxhash64("doc_id", "start"), F.lit(SALTS)).cast("int"))
    )
    counts = salted.groupBy("length", "_salt").agg(F.count("*").alias("_n"))
    # The histogram is all that reaches the driver: at most ``capacity`` rows.
    histogram = {
        int(r["length"]): int(r["n"])
        for r in counts.groupBy("length").agg(F.sum("_n").alias("n")).collect()
    }
    if max(histogram, default=0) > capacity:
        raise ValueError(f"a piece is longer than {capacity}")
    by_length: dict[int, list[Slots]] = {}
    for slot in place(histogram, capacity):
        by_length.setdefault(slot.length, []).append(slot)
    shared = spark.sparkContext.broadcast(
        {
            n: tuple(np.array([getattr(s, f) for s in x]) for f in ("rank", "sequence", "offset"))
            for n, x in by_length.items()
        }
    )

    # A piece's number among those of its length: pieces of lower salts, then its own place.
    lower = Window.partitionBy("length").orderBy("_salt")
    before = counts.select(
        "length", "_salt", (F.sum("_n").over(lower) - F.col("_n")).alias("_before")
    )
    own = F.row_number().over(Window.partitionBy("length", "_salt").orderBy("doc_id", "start"))
    ranked = (
        salted.withColumn("_own", own)
        .join(before, ["length", "_salt"])
        .select(*columns, (F.col("_before") + F.col("_own") - 1).alias("_rank"))
    )

    def seat(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        lookup = shared.value
        for batch in batches:
            length = batch.column("length").to_numpy()
            rank = batch.column("_rank").to_numpy()
            sequence, offset = np.zeros(len(rank), np.int64), np.zeros(len(rank), np.int64)
            order = np.argsort(length, kind="stable")
            cuts = np.flatnonzero(np.diff(length[order], prepend=-1))
            for a, b in zip(cuts, [*cuts[1:], len(order)]):
                rows = order[a:b]
                ranks, sequences, offsets = lookup[int(length[rows[0]])]
                at = np.searchsorted(ranks, rank[rows], "right") - 1
                sequence[rows] = sequences[at] + rank[rows] - ranks[at]
                offset[rows] = offsets[at]
            kept = [batch.column(c) for c in columns]
            yield pa.RecordBatch.from_arrays(
                [*kept, pa.array(sequence), pa.array(offset)], [*columns, "sequence_id", "offset"]
            )

    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in ranked.select(*columns).schema)
    return ranked.mapInArrow(seat, f"{schema}, sequence_id long, offset long")


def pack_documents(
    docs: DataFrame, tokenizer: str, capacity: int = 2048, end_id: int = 1, with_ids: bool = False
) -> DataFrame:
    """Tokenize, cut and pack whole documents; one row per piece.

    Texts are tokenized once, into a written table of pieces.
    """
    return pack(
        staged(token_pieces(docs, tokenizer, capacity, end_id, with_ids), "pieces"), capacity
    )
