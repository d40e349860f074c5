"""Resampling of a corpus towards a target distribution.

Texts are bags of hashed word runs. Each bucket's gain, the logarithm of its share of the
target over its share of the corpus, stands in one array that every task holds; a text's
weight is the mean gain of its features, and noise drawn from its id is added, so that the
highest scores are a sample in proportion to the weights. The scores are written once.
The cutoff is then found by bisection: jobs that count exactly how many of the written
rows lie below numeric thresholds, first of the score, then of the id among equal scores,
then of the row among equal ids. Only what lies above the cutoff is range-partitioned for
its ranks.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lodeworks.llm.common import blocks, ragged, staged, text_bytes
from lodeworks.llm.words import LOWER

#: Word bytes: digits, lower-case letters and every byte outside ASCII.
WORD_BYTES = np.zeros(256, bool)
WORD_BYTES[0x30:0x3A] = WORD_BYTES[0x61:0x7B] = WORD_BYTES[0x80:] = True
#: Thresholds that one counting job looks at.
PROBES = 15
GREATEST = 2**63 - 1
_BLANK = np.uint32(zlib.crc32(b" "))


def _one_byte() -> np.ndarray:
    """What a checksum with one bit set becomes when a zero byte follows, for each bit."""
    register = np.uint32(1) << np.arange(32, dtype=np.uint32)
    for _ in range(8):
        register = np.where(register & 1, (register >> 1) ^ np.uint32(0xEDB88320), register >> 1)
    return register


def _lookup(bits: np.ndarray) -> np.ndarray:
    """The same linear map for each value of each of the four bytes."""
    table = np.zeros((4, 256), np.uint32)
    for byte in range(4):
        for k in range(8):
            table[byte] ^= np.where(np.arange(256) >> k & 1, bits[8 * byte + k], np.uint32(0))
    return table


def _apply(table: np.ndarray, crc: np.ndarray) -> np.ndarray:
    return (
        table[0][crc & 255]
        ^ table[1][crc >> 8 & 255]
        ^ table[2][crc >> 16 & 255]
        ^ table[3][crc >> 24]
    )


#: Maps for 1, 2, 4 ... following zero bytes, as far as any text was long.
_FOLLOWING: list[np.ndarray] = []


def joined_crc(first: np.ndarray, second: np.ndarray, length: np.ndarray) -> np.ndarray:
    """CRC-32 of two byte strings end to end, from both checksums and the second's length."""
    out = first.copy()
    bit = 0
    while len(length) and (int(length.max()) >> bit):
        if bit == len(_FOLLOWING):
            _FOLLOWING.append(
                _lookup(_apply(_FOLLOWING[-1], _apply(_FOLLOWING[-1], np.uint32(1) << np.arange(32, dtype=np.uint32))))
                if _FOLLOWING
                else _lookup(_one_byte())
            )
        some = (length >> bit & 1).astype(bool)
        out[some] = _apply(_FOLLOWING[bit], out[some])
        bit += 1
    return out ^ second


def feature_buckets(
    texts: pa.Array, grams: int, buckets: int
) -> tuple[list[tuple[np.ndarray, np.ndarray]], np.ndarray]:
    """Buckets of all runs of 1 to ``grams`` words, and the first word of each text (plus the end).

    For each run length: the words at which runs begin, and their buckets.
    """
    data, offsets = text_bytes(texts)
    data = LOWER[data]
    inside = WORD_BYTES[data]
    starts = inside.copy()
    starts[1:] &= ~inside[:-1]
    begin = offsets[:-1][offsets[:-1] < offsets[1:]]
    starts[begin] = inside[begin]
    first = np.concatenate(([0], np.cumsum(starts, dtype=np.int64)))[offsets]
    packed = np.ascontiguousarray(data[inside])
    places = (np.cumsum(inside, dtype=np.int64) - 1)[starts]
    ends = np.append(places, len(packed)).astype(np.int64)
    size = np.diff(ends)
    words = pa.LargeBinaryArray.from_buffers(
        pa.large_binary(), len(size), [None, pa.py_buffer(ends), pa.py_buffer(packed)]
    ).dictionary_encode()
    distinct = np.fromiter(map(zlib.crc32, words.dictionary.to_pylist()), np.uint32, len(words.dictionary))
    word = distinct[words.indices.to_numpy()] if len(size) else np.zeros(0, np.uint32)
    runs, out = word, []
    last = np.repeat(first[1:], np.diff(first))
    for n in range(1, grams + 1):
        if n > 1:
            blank = joined_crc(runs[:-1], np.full(max(len(runs) - 1, 0), _BLANK), np.ones(max(len(runs) - 1, 0), np.int64))
            runs = joined_crc(blank, word[n - 1 :], size[n - 1 :])
        at = np.flatnonzero(np.arange(len(runs)) + n <= last[: len(runs)])
        out.append((at, (runs[at] % np.uint32(buckets)).astype(np.int32)))
    return out, first


def bucket_counts(docs: DataFrame, grams: int, buckets: int) -> np.ndarray:
    """How many features of all texts fall into each bucket: one number a bucket."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(buckets, np.int64)
        for batch in blocks(batches):
            for _, found in feature_buckets(batch.column("text"), grams, buckets)[0]:
                total += np.bincount(found, minlength=buckets)
        held = np.flatnonzero(total)
        yield pa.RecordBatch.from_pydict({"bucket": held.astype(np.int32), "n": total[held]})

    rows = docs.select("text").mapInArrow(count, "bucket int, n long").groupBy("bucket").agg(F.sum("n").alias("n"))
    out = np.zeros(buckets, np.int64)
    for row in rows.collect():
        out[row["bucket"]] = row["n"]
    return out


def gains(source: np.ndarray, target: np.ndarray) -> np.ndarray:
    """Thousandths of the logarithm of the smoothed shares' ratio, rounded down, per bucket."""
    n = len(source)
    s, t = source.astype(np.float64), target.astype(np.float64)
    ratio = (t + 1) * (s.sum() + n) / ((s + 1) * (t.sum() + n))
    return np.floor(1000 * np.log(ratio)).astype(np.int64)


def weights(docs: DataFrame, gain: np.ndarray, grams: int) -> DataFrame:
    """``doc_id, n_words, n_features, weight`` of every row of ``doc_id, text``."""
    buckets = len(gain)
    shared = docs.sparkSession.sparkContext.broadcast(gain)

    def weigh(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        gain = shared.value
        for batch in blocks(batches):
            runs, first = feature_buckets(batch.column("text"), grams, buckets)
            features = np.zeros(len(first) - 1, np.int64)
            total = np.zeros(len(first) - 1, np.int64)
            for at, found in runs:
                cuts = np.searchsorted(at, first)
                sums = np.concatenate(([0], np.cumsum(gain[found])))
                features += np.diff(cuts)
                total += np.diff(sums[cuts])
            yield pa.RecordBatch.from_pydict(
                {
                    "doc_id": batch.column("doc_id"),
                    "n_words": np.diff(first),
                    "n_features": features,
                    "weight": np.where(features > 0, total // np.maximum(features, 1), 0),
                }
            )

    rows = docs.select(F.col("doc_id").cast("long"), "text")
    return rows.mapInArrow(weigh, "doc_id long, n_words long, n_features long, weight long")


def _noise(doc_id: Column, seed: int) -> Column:
    """Thousandths of a Gumbel variate drawn from the id."""
    name = F.concat(F.lit(f"{seed}:"), F.coalesce(doc_id.cast("string"), F.lit("")))
    head = F.conv(F.substring(F.sha2(name.cast("binary"), 256), 1, 8), 16, 10).cast("long")
    uniform = (head.cast("double") + 0.5) / F.lit(4294967296.0)
    return F.floor(F.lit(-1000.0) * F.ln(-F.ln(uniform)))


def threshold(rows: DataFrame, column: Column, need: int) -> tuple[int, int, int]:
    """The smallest number that at least ``need`` rows reach from below.

    Also how many rows are smaller, and how many are not greater. ``column`` is a long
    without nulls, and there are ``need`` rows or more. Each job counts the rows up to
    ``PROBES`` thresholds between the bounds that are left, so 16 jobs settle any column.
    """
    keyed = rows.select(column.alias("key"))
    low, high, upto = keyed.agg(F.min("key"), F.max("key"), F.count("*")).first()
    below = 0
    while low < high:
        step = high - low
        probes = sorted({low + step * k // (PROBES + 1) for k in range(1, PROBES + 1)} | {low})
        probes = [p for p in probes if p < high]
        counts = keyed.agg(
            *(F.count_if(F.col("key") <= F.lit(p).cast("long")).alias(f"n{i}") for i, p in enumerate(probes))
        ).first()
        for probe, count in zip(probes, counts):
            if count < need:
                low, below = probe + 1, count
            else:
                high, upto = probe, count
                break
    return low, below, upto


def resample(
    docs: DataFrame,
    target: DataFrame,
    percent: int = 25,
    *,
    grams: int = 2,
    buckets: int = 10_000,
    least_words: int = 20,
    seed: int = 7,
) -> DataFrame:
    """Draw ``percent`` of the documents with ``least_words`` words or more, those likeliest
    under the target first.

    ``docs`` has ``doc_id, text`` and ``target`` has ``text``; further columns are not
    read. Returns for every row of ``docs``: ``doc_id, n_words, n_features, weight, score``
    and ``rank``, from 1 by falling score and then rising id, null for rows not drawn. A
    null or empty text has no features and weight 0. Rows without an id share the noise of
    an empty id and come last among equal scores; rows of one id and score are drawn in the
    order of the table. Repeated rows are separate documents. Without documents there are
    no rows; without a target text the weights only favour rare features. Only bucket
    counts, bounded by ``buckets``, and the bisection's counts reach the driver.
    """
    gain = gains(bucket_counts(docs, grams, buckets), bucket_counts(target, grams, buckets))
    scored = weights(docs, gain, grams).withColumn(
        "score", F.col("weight") + _noise(F.col("doc_id"), seed)
    )
    scored = staged(scored.withColumn("row", F.monotonically_increasing_id()), "scores")
    keys = {
        "_key": -F.col("score"),
        "_tie": F.coalesce("doc_id", F.lit(GREATEST)),
        "_row": F.col("row"),
    }
    keyed = scored.withColumns(keys)
    rows = keyed.where(F.col("n_words") >= least_words)
    need = rows.count() * percent // 100
    drawn = F.lit(False)
    if need:
        same = F.col("n_words") >= least_words
        for name in keys:
            value, below, upto = threshold(rows, F.col(name), need)
            limit = F.lit(value).cast("long")
            if upto == need:
                drawn = drawn | (same & (F.col(name) <= limit))
                break
            drawn = drawn | (same & (F.col(name) < limit))
            same = same & (F.col(name) == limit)
            rows, need = rows.where(F.col(name) == limit), need - below
    columns = ["doc_id", "n_words", "n_features", "weight", "score"]
    return _ranked(keyed.where(drawn), list(keys), columns).unionByName(
        keyed.where(~drawn).select(*columns, F.lit(None).cast("long").alias("rank"))
    )


def _ranked(rows: DataFrame, order: list[str], columns: list[str]) -> DataFrame:
    """Number rows by a unique order: ranges of it are sorted apart, then counted up."""
    # The upper bits of the id are the range's number, the lower ones the place in it.
    ranges = staged(
        rows.repartitionByRange(*order)
        .sortWithinPartitions(*order)
        .select(*columns, F.monotonically_increasing_id().alias("_at")),
        "ranges",
    ).withColumn("_range", F.shiftright("_at", 33))
    counts = ranges.groupBy("_range").agg(F.count("*").alias("_n"))
    # One row a range, hence no more than there are shuffle partitions.
    before = counts.select(
        "_range", (F.sum("_n").over(Window.orderBy("_range")) - F.col("_n")).alias("_before")
    )
    rank = F.col("_before") + F.col("_at").bitwiseAND(F.lit((1 << 33) - 1)) + 1
    return ranges.join(F.broadcast(before), "_range").select(*columns, rank.alias("rank"))
