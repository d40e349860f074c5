"""Token ids in files of Simple-8b words.

A 64-bit word holds a selector in its top 4 bits and equal-width ids in the other
60: sixty of 1 bit, or thirty of 2, down to one of 60. Selector 15 is an escape: the
next word is one id, as it is. Ids are coded in chunks of ``CHUNK``; the last word of
a chunk may be part empty. A block (one row of the Parquet container) keeps whole
documents and, besides its words, the word where each chunk starts, so that chunks
are coded and decoded side by side with numpy.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from uuid import uuid4

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from lodeworks.llm.common import blocks
from lodeworks.llm.token_ids import encoder, with_end

CHUNK = 256
COUNTS = np.array([60, 30, 20, 15, 12, 10, 8, 7, 6, 5, 4, 3, 2, 1])
ESCAPE = 15
BLOCK_IDS = 1 << 18
#: Characters by which rows of one id are dealt to ranges. Whole texts order them.
TIE = 64
FILE_SCHEMA = (
    "shard int, block int, doc_ids array<long>, doc_tokens array<long>, "
    "chunk_words binary, words binary"
)


def _small_lengths() -> np.ndarray:
    return np.frexp(np.arange(1 << 16, dtype=np.float64))[1].astype(np.uint8)


_LENGTHS = _small_lengths()


def bit_lengths(values: np.ndarray) -> np.ndarray:
    """Bits of each unsigned value: 0 for 0, 1 for 1, 2 for 2 and 3, ..."""
    if not values.size or values.max() < len(_LENGTHS):
        return _LENGTHS[values]
    bits = np.zeros(values.shape, np.uint8)
    for shift in range(0, 8 * values.dtype.itemsize, 16):
        part = (values >> values.dtype.type(shift)) & values.dtype.type(0xFFFF)
        np.putmask(bits, part > 0, _LENGTHS[part] + np.uint8(shift))
    return bits


def encode(ids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Words for ids (any unsigned 64-bit values), and the number of words of each chunk."""
    ids = np.asarray(ids)
    rows = -(-len(ids) // CHUNK)
    kind = np.uint32 if len(ids) and ids.max() < 1 << 32 else np.uint64
    lanes = np.zeros((rows, CHUNK + COUNTS[0]), kind)
    full = np.zeros(rows * CHUNK, kind)
    full[: len(ids)] = ids
    lanes[:, :CHUNK] = full.reshape(rows, CHUNK)
    size = np.full(rows, CHUNK)
    if rows:
        size[-1] = len(ids) - (rows - 1) * CHUNK
    # The largest bit length among the next n ids, for growing n: each count is at most
    # twice the one before, so two overlapping stretches of that length cover it.
    widest = bit_lengths(lanes)
    selector = np.full(lanes.shape, ESCAPE, np.uint8)
    reach = 1
    for s in range(len(COUNTS) - 1, -1, -1):
        step = COUNTS[s] - reach
        if step:
            widest[:, :-step] = np.maximum(widest[:, :-step], widest[:, step:])
        reach = COUNTS[s]
        np.putmask(selector, widest <= 60 // COUNTS[s], np.uint8(s))
    # Greedy walk, one word of every chunk at a time.
    takes = np.ones(16, np.int64)
    takes[:14] = COUNTS
    at, live = np.zeros(rows, np.int64), np.arange(rows)
    steps = []
    while len(live):
        chosen = selector[live, at[live]]
        steps.append((live, at[live], chosen))
        at[live] += takes[chosen]
        live = live[at[live] < size[live]]
    if not steps:
        return np.zeros(0, np.uint64), np.zeros(0, np.int64)
    lane, place, chosen = (np.concatenate(x) for x in zip(*steps))
    order = np.lexsort((place, lane))
    lane, place, chosen = lane[order], place[order], chosen[order]
    lengths = np.where(chosen == ESCAPE, 2, 1)
    ends = np.cumsum(lengths)
    words = np.zeros(int(ends[-1]), np.uint64)
    for s in np.unique(chosen):
        rows_s = np.flatnonzero(chosen == s)
        out = ends[rows_s] - lengths[rows_s]
        words[out] = np.uint64(s) << np.uint64(60)
        if s == ESCAPE:
            words[out + 1] = lanes[lane[rows_s], place[rows_s]]
            continue
        for j in range(COUNTS[s]):
            part = lanes[lane[rows_s], place[rows_s] + j].astype(np.uint64)
            words[out] |= part << np.uint64(j * (60 // COUNTS[s]))
    return words, np.bincount(lane, lengths, rows).astype(np.int64)


def decode(words: np.ndarray, chunk_words: np.ndarray, n_ids: int) -> np.ndarray:
    """The ids that ``encode`` was given."""
    rows = len(chunk_words)
    if not rows:
        return np.zeros(0, np.uint64)
    chosen = (words >> np.uint64(60)).astype(np.int64)
    # A raw word may look like any selector: find those behind an escape, in runs.
    raw = np.zeros(len(words), bool)
    maybe = np.flatnonzero(chosen == ESCAPE)
    if len(maybe):
        first = np.concatenate(([True], np.diff(maybe) > 1))
        begin = maybe[first][np.cumsum(first) - 1]
        escapes = maybe[(maybe - begin) % 2 == 0]
        raw[escapes[escapes + 1 < len(words)] + 1] = True
    head = np.flatnonzero(~raw)
    chosen = chosen[head]
    takes = np.ones(16, np.int64)
    takes[:14] = COUNTS
    counts = takes[chosen]
    chunk = np.repeat(np.arange(rows), chunk_words)[head]
    sizes = np.full(rows, CHUNK)
    sizes[-1] = n_ids - (rows - 1) * CHUNK
    ends = np.cumsum(counts)
    per_chunk = np.bincount(chunk, counts, rows).astype(np.int64)
    start = ends - counts - np.repeat(np.cumsum(per_chunk) - per_chunk, np.bincount(chunk, minlength=rows))
    out = np.zeros((rows, CHUNK + COUNTS[0]), np.uint64)
    for s in np.unique(chosen):
        at = np.flatnonzero(chosen == s)
        if s == ESCAPE:
            out[chunk[at], start[at]] = words[head[at] + 1]
            continue
        width = 60 // COUNTS[s]
        mask = np.uint64((1 << int(width)) - 1)
        for j in range(COUNTS[s]):
            out[chunk[at], start[at] + j] = (words[head[at]] >> np.uint64(j * width)) & mask
    return out[:, :CHUNK].reshape(-1)[:n_ids]


def write_token_files(docs: DataFrame, path: str, tokenizer: str, end_id: int = 1) -> None:
    """Encode every text (null: empty), append ``end_id``, write in ascending ``doc_id`` order.

    Documents are range partitioned by id; a file holds one range and is written by one
    task, so a task that is run again replaces its own file. Repeated ids keep all their
    rows, in text order, null ids come first. Rows of one id, also where all are null, are
    dealt to ranges by how their texts begin (``TIE``); only texts that begin alike share one.
    """

    def code(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        block = 0
        held: list[tuple[np.ndarray, pa.Array, np.ndarray]] = []

        def flush(shard: int) -> pa.RecordBatch:
            ids, sizes = (np.concatenate([x[k] for x in held]) for k in (0, 2))
            docs = pa.concat_arrays([x[1] for x in held])
            words, chunk_words = encode(ids)
            return pa.RecordBatch.from_pydict(
                {
                    "shard": pa.array([shard], pa.int32()),
                    "block": pa.array([block], pa.int32()),
                    "doc_ids": pa.ListArray.from_arrays([0, len(docs)], docs),
                    "doc_tokens": pa.array([sizes], pa.list_(pa.int64())),
                    "chunk_words": pa.array([chunk_words.astype("<u2").tobytes()], pa.binary()),
                    "words": pa.array([words.astype("<u8").tobytes()], pa.binary()),
                }
            )

        shard = None
        for batch in blocks(batches, limit=2 << 20):
            ids, begins = with_end(*encoder(tokenizer).encode(batch.column("text")), end_id)
            held.append((ids, batch.column("doc_id"), np.diff(begins)))
            shard = batch.column("shard")[0].as_py()
            if sum(len(x[0]) for x in held) >= BLOCK_IDS:
                yield flush(shard)
                block, held = block + 1, []
        if held:
            yield flush(shard)

    ordered = (
        docs.select(F.col("doc_id").cast("long"), F.coalesce("text", F.lit("")).alias("text"))
        .repartitionByRange("doc_id", F.substring("text", 1, TIE))
        .sortWithinPartitions("doc_id", "text")
        .withColumn("shard", F.spark_partition_id())
    )
    ordered.mapInArrow(code, FILE_SCHEMA).write.option("compression", "none").parquet(path)


def read_token_files(spark: SparkSession, path: str, with_ids: bool = False) -> DataFrame:
    """One row per document: ``doc_id, start, n_tokens, ids_crc32``.

    ``start`` counts the ids of all documents before. ``with_ids`` adds the ids
    themselves, as little-endian unsigned 32-bit numbers.
    """
    files = spark.read.schema(FILE_SCHEMA).parquet(path)
    sizes = files.select(
        "shard", "block", F.aggregate("doc_tokens", F.lit(0).cast("long"), lambda a, x: a + x).alias("n")
    )
    # One row per block, a few hundred thousand ids each.
    shards = sizes.groupBy("shard").agg(F.sum("n").alias("n"))
    shard_start = shards.select(
        "shard", (F.sum("n").over(Window.orderBy("shard")) - F.col("n")).alias("shard_start")
    )
    starts = (
        sizes.withColumn(
            "in_shard",
            F.sum("n").over(Window.partitionBy("shard").orderBy("block")) - F.col("n"),
        )
        .join(shard_start, "shard")
        .select("shard", "block", (F.col("in_shard") + F.col("shard_start")).alias("block_start"))
    )

    def unpack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in range(batch.num_rows):
                docs, tokens, chunk_words, words = (
                    batch.column(c)[row]
                    for c in ("doc_ids", "doc_tokens", "chunk_words", "words")
                )
                tokens = tokens.values.to_numpy()
                ids = decode(
                    np.frombuffer(words.as_buffer(), "<u8"),
                    np.frombuffer(chunk_words.as_buffer(), "<u2").astype(np.int64),
                    int(tokens.sum()),
                )
                raw = memoryview(ids.astype("<u4").tobytes())
                ends = np.cumsum(tokens)
                parts = [raw[4 * (b - n) : 4 * b] for b, n in zip(ends.tolist(), tokens.tolist())]
                yield pa.RecordBatch.from_pydict(
                    ({"ids": pa.array(map(bytes, parts), pa.binary())} if with_ids else {})
                    | {
                        "shard": np.full(len(tokens), batch.column("shard")[row].as_py(), np.int32),
                        "block": np.full(len(tokens), batch.column("block")[row].as_py(), np.int32),
                        "doc_id": docs.values,
                        "in_block": ends - tokens,
                        "n_tokens": tokens,
                        "ids_crc32": np.fromiter(map(zlib.crc32, parts), np.int64, len(parts)),
                    }
                )

    ids = ["ids"] if with_ids else []
    docs = files.mapInArrow(
        unpack,
        ("ids binary, " if with_ids else "")
        + "shard int, block int, doc_id long, in_block long, n_tokens long, ids_crc32 long",
    )
    start = (F.col("block_start") + F.col("in_block")).alias("start")
    return docs.join(starts, ["shard", "block"]).select(
        "doc_id", start, "n_tokens", "ids_crc32", *ids
    )


def token_file_path(folder: str) -> str:
    return f"{folder}/tokens-{uuid4().hex}"
