"""Removal of repeated passages: byte strings of a minimum length that occur earlier.

1. *Candidates.* Every window of ``length`` bytes is given to an anchor: the byte gram in
   it with the smallest hash, the leftmost of equals. Equal windows have equal anchors at
   equal places, so they can only be found below one anchor. The windows of an anchor
   occurrence are adjacent and make a segment. Only hashes of anchors and segments are
   shuffled; anchors that occur once are done.
2. *Equal segments* below an anchor are collapsed to the earliest, the others removed.
3. *Different segments* below an anchor may share part of their windows. They are dealt
   out by anchor, and each task works through its anchors in shards of bounded size. For a
   shard it builds the Burrows-Wheeler transform of its segments and expands intervals
   breadth first by backward extension. That yields the common prefixes of neighbouring
   suffixes in increasing order, and stops at ``length``: suffixes still undivided then
   start with equal windows, of which all but the earliest are removed.

An anchor with more than ``SHARED`` occurrences would not fit a shard. Its windows are
dealt out one by one, by a 128-bit hash of their bytes, and the earliest stays.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lodeworks.llm.common import blocks, mix, ragged, spans_of, staged, text_bytes
from lodeworks.llm.words import byte_sums, gram_hashes, span_hashes

#: Bytes of an anchor; occurrences of an anchor that may share a shard; bytes of a shard.
GRAM, SHARED, SHARD = 24, 4000, 1 << 20


def anchors(data: np.ndarray, offsets: np.ndarray, length: int) -> dict[str, np.ndarray]:
    """Anchor occurrences of all texts of a block.

    For each: its text, the first byte of its first window (``start``, within the text),
    its number of windows, the anchor's place behind ``start``, and the hashes of the anchor
    and of the segment.
    """
    names = ("text", "start", "windows", "place", "anchor", "segment")
    if len(data) < length:
        return {x: np.zeros(0, np.uint64 if x in names[4:] else np.int64) for x in names}
    sums = byte_sums(data)
    hashes = gram_hashes(sums, GRAM)
    least = (hashes >> np.uint64(32) << np.uint64(32)) | np.arange(len(hashes), dtype=np.uint64)
    # Minima over as many grams as a window holds, from minima over powers of two.
    wanted, reach = length - GRAM + 1, 1
    while reach < wanted:
        step = min(reach, wanted - reach)
        least = np.minimum(least[:-step], least[step:])
        reach += step
    least &= np.uint64(0xFFFFFFFF)
    sizes = np.diff(offsets)
    inside = np.maximum(sizes - length + 1, 0)
    at = ragged(offsets[:-1], inside)
    place = least[at].astype(np.int64)
    first = np.flatnonzero(np.diff(place, prepend=-1))
    windows = np.diff(np.append(first, len(place)))
    start, place = at[first], place[first]
    text = np.repeat(np.arange(len(sizes)), inside)[first]
    segment = span_hashes(data, start, start + windows + length - 1, sums)
    return {
        "text": text,
        "start": start - offsets[text],
        "windows": windows,
        "place": place - start,
        "anchor": hashes[place],
        "segment": mix(segment ^ mix(place - start, 3) ^ mix(windows, 4)),
    }


OCCURRENCES = (
    "anchor long, segment long, doc_id long, text_hash long, start long, windows int, "
    "place int, repeated boolean"
)


def occurrences(rows: DataFrame, length: int) -> DataFrame:
    """``OCCURRENCES`` of all documents.

    Of equal segments within a block of documents only the earliest is an occurrence; the
    others are told as ``repeated`` runs of windows, under an anchor of their own.
    """

    def find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in blocks(batches, limit=4 << 20):
            found = anchors(*text_bytes(batch.column("text")), length)
            ids = batch.column("doc_id").to_numpy()
            text, start = found["text"], found["start"]
            doc = ids[text]
            order = np.lexsort((start, doc, found["segment"], found["anchor"]))
            same = np.zeros(len(order), bool)
            same[1:] = (np.diff(found["segment"][order]) == 0) & (np.diff(found["anchor"][order]) == 0)
            # The same place of the same id, in a repeated row, is not later.
            head = order[np.maximum.accumulate(np.where(same, 0, np.arange(len(order))))]
            later = np.zeros(len(order), bool)
            later[order] = (doc[head] != doc[order]) | (start[head] != start[order])
            runs, ends = spans_of(later)
            # A run stays within a text, where its segments are adjacent.
            cut = np.flatnonzero(np.diff(text)) + 1
            inner = cut[later[cut] & later[cut - 1]] if len(cut) else cut
            runs, ends = np.sort(np.append(runs, inner)), np.sort(np.append(ends, inner))
            total = np.concatenate(([0], np.cumsum(found["windows"])))
            kept = np.flatnonzero(~later)
            which = np.concatenate((kept, runs))
            own = mix(batch.column("text_hash").to_numpy()[text[runs]] + start[runs], 9)
            yield pa.RecordBatch.from_pydict(
                {
                    "anchor": np.concatenate((found["anchor"][kept], own)).view(np.int64),
                    "segment": np.concatenate((found["segment"][kept], own)).view(np.int64),
                    "doc_id": doc[which],
                    "text_hash": batch.column("text_hash").to_numpy()[text[which]],
                    "start": start[which],
                    "windows": np.concatenate(
                        (found["windows"][kept], total[ends] - total[runs])
                    ).astype(np.int32),
                    "place": found["place"][which].astype(np.int32),
                    "repeated": np.arange(len(which)) >= len(kept),
                }
            )

    return rows.mapInArrow(find, OCCURRENCES)


def _sorted(keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The order of unsigned keys, and the keys in that order."""
    bits = np.uint64(max(1, (len(keys) - 1).bit_length()))
    if len(keys) and int(keys.max()).bit_length() + int(bits) <= 64:
        # Keys that leave room for their place are sorted with it, which takes far less time.
        joined = np.sort((keys << bits) | np.arange(len(keys), dtype=np.uint64))
        return (joined & ((np.uint64(1) << bits) - np.uint64(1))).astype(np.int64), joined >> bits
    order = np.argsort(keys)
    return order, keys[order]


def transform(symbols: np.ndarray, depth: int) -> tuple[np.ndarray, np.ndarray]:
    """Suffix array by the first ``depth`` symbols at least, and the Burrows-Wheeler transform.

    Ranks of the first few symbols are doubled to those of twice as many, and so on.
    """
    n = len(symbols)
    rank_bits = n.bit_length()
    kinds, code = np.unique(symbols, return_inverse=True)
    width = max(1, (len(kinds) - 1).bit_length())
    reach = max(1, min(2 * rank_bits, 63) // width)
    padded = np.concatenate((code.astype(np.uint64), np.zeros(reach, np.uint64)))
    key = np.zeros(n, np.uint64)
    for k in range(reach):
        key = (key << np.uint64(width)) | padded[k : k + n]
    while True:
        order, ordered = _sorted(key)
        rank = np.empty(n, np.uint64)
        rank[order] = np.cumsum(np.diff(ordered, prepend=ordered[:1]) != 0) + 1
        if reach >= depth or rank[order[-1]] == n:
            return order, symbols[order - 1]
        behind = np.zeros(n, np.uint64)
        behind[:-reach] = rank[reach:] if reach < n else 0
        key = (rank << np.uint64(rank_bits)) | behind
        reach *= 2


def common_prefixes(bwt: np.ndarray, stop: int) -> np.ndarray:
    """For each place in suffix order, the length of the prefix that the suffix there shares
    with the one before; ``stop`` where that is ``stop`` or more (or spans symbol 0).

    Breadth first: all intervals of strings of one length are extended to the left by
    every symbol in front of their suffixes at once. An extended interval is followed up
    only if it settles the place behind its end, so each place is settled once, with the
    length it is found at.
    """
    n = len(bwt)
    ahead = np.empty(n, np.int64)
    ahead[np.argsort(bwt, kind="stable")] = np.arange(n)
    shared = np.full(n + 1, stop, np.int64)
    open_ = np.ones(n + 1, bool)
    shared[0] = 0
    open_[0] = open_[n] = False
    low, high = np.zeros(1, np.int64), np.full(1, n, np.int64)
    for size in range(stop):
        at = ragged(low, high - low)
        owner = np.repeat(np.arange(len(low)), high - low)
        real = bwt[at] != 0
        at, owner = at[real], owner[real]
        if not len(at):
            break
        to = ahead[at]
        by_place, to = _sorted(to.astype(np.uint64))
        to, owner, symbol = to.astype(np.int64), owner[by_place], bwt[at[by_place]]
        new = np.ones(len(to), bool)
        new[1:] = (np.diff(to) != 1) | (np.diff(owner) != 0) | (symbol[1:] != symbol[:-1])
        begin = np.flatnonzero(new)
        low = to[begin]
        high = to[np.append(begin[1:], len(to)) - 1] + 1
        # The last place of all needs following up too, though there is nothing behind it.
        settles = open_[high] | ((high == n) & (size == 0))
        low, high = low[settles], high[settles]
        shared[high[high < n]] = size
        open_[high] = False
    return shared[:n]


def repeated_windows(
    segments: list[bytes], doc: np.ndarray, start: np.ndarray, length: int
) -> list[np.ndarray]:
    """For each segment, which of its windows occur at an earlier (doc, start) in the others."""
    sizes = np.array([len(x) for x in segments])
    text = np.frombuffer(b"\0".join(segments) + b"\0", np.uint8).astype(np.int16) + 1
    begins = np.concatenate(([0], np.cumsum(sizes + 1)))
    text[begins[1:] - 1] = 0
    order, bwt = transform(text, length)
    shared = common_prefixes(bwt, length)
    owner = np.searchsorted(begins, order, "right") - 1
    within = order - begins[owner]
    valid = within <= sizes[owner] - length
    joined = shared >= length
    joined[1:] &= valid[1:] & valid[:-1]
    joined[0] = False
    group = np.cumsum(~joined)
    # Earlier ones by rank of (doc, start).
    place = start[owner] + within
    rows = np.flatnonzero(valid)
    by_key = np.lexsort((place[rows], doc[owner[rows]]))
    key = np.zeros(len(order), np.int64)
    ordered = rows[by_key]
    moved = np.ones(len(ordered), bool)
    moved[1:] = (np.diff(place[ordered]) != 0) | (np.diff(doc[owner[ordered]]) != 0)
    key[ordered] = np.cumsum(moved)
    first = np.full(group[-1] + 1, np.iinfo(np.int64).max)
    np.minimum.at(first, group[rows], key[rows])
    late = rows[key[rows] > first[group[rows]]]
    marks = np.zeros(len(text), bool)
    marks[order[late]] = True
    return [marks[b : b + max(0, n - length + 1)] for b, n in zip(begins[:-1], sizes)]


def _windows_left(found: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Split occurrences of repeated anchors into removed runs of windows, and the earliest
    of each segment where an anchor has different ones (with the anchor's occurrences)."""
    own = found.where("not repeated")
    # Combined before the shuffle and joined, so that one segment of the whole corpus is
    # no single task.
    first = own.groupBy("anchor", "segment").agg(F.min(F.struct("doc_id", "start")).alias("first"))
    rows = own.join(staged(first, "first-segments"), ["anchor", "segment"]).select(*own.columns, "first")
    is_first = F.struct("doc_id", "start") == F.col("first")
    removed = found.where("repeated").unionByName(rows.where(~is_first).drop("first"))
    contested = rows.where(is_first & F.col("contested")).drop("first", "segment")
    return removed.select("doc_id", "text_hash", "start", "windows"), contested


def _cut(docs: DataFrame, contested: DataFrame, length: int) -> DataFrame:
    """The bytes of segments: ``anchor, n, doc_id, text_hash, start, segment``."""
    wanted = contested.groupBy("doc_id", "text_hash").agg(
        F.collect_list(F.struct("anchor", "n", "start", "windows")).alias("wanted")
    )

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in blocks(batches, limit=4 << 20):
            data, offsets = text_bytes(batch.column("text"))
            lists = batch.column("wanted")
            sizes = np.diff(lists.offsets.to_numpy())
            cells = lists.flatten()
            row = np.repeat(np.arange(len(sizes)), sizes)
            start, windows = cells.field("start"), cells.field("windows")
            first = offsets[row] + start.to_numpy()
            last = first + windows.to_numpy() + length - 1
            raw = memoryview(data)
            yield pa.RecordBatch.from_pydict(
                {
                    "anchor": cells.field("anchor"),
                    "n": cells.field("n"),
                    "doc_id": batch.column("doc_id").take(pa.array(row)),
                    "text_hash": batch.column("text_hash").take(pa.array(row)),
                    "start": start,
                    "segment": pa.array(
                        [bytes(raw[a:b]) for a, b in zip(first.tolist(), last.tolist())], pa.binary()
                    ),
                }
            )

    return docs.join(wanted, ["doc_id", "text_hash"]).mapInArrow(
        cut, "anchor long, n long, doc_id long, text_hash long, start long, segment binary"
    )


RUNS = "doc_id long, text_hash long, start long, windows int"


def _within_shards(segments: DataFrame, length: int) -> DataFrame:
    """Removed runs of windows by interval expansion, anchors dealt out over tasks."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []

        def shard(upto: int | None = None) -> Iterator[pa.RecordBatch]:
            rows = pa.Table.from_batches(held)
            part = rows if upto is None else rows.slice(0, upto)
            held[:] = [] if upto is None else rows.slice(upto).to_batches()
            doc, start = part["doc_id"].to_numpy(), part["start"].to_numpy()
            marks = repeated_windows(part["segment"].to_pylist(), doc, start, length)
            row, first, n = [], [], []
            for k, mark in enumerate(marks):
                if mark.any():
                    a, b = spans_of(mark)
                    row.append(np.full(len(a), k))
                    first.append(a)
                    n.append(b - a)
            if row:
                row, first, n = map(np.concatenate, (row, first, n))
                yield pa.RecordBatch.from_pydict(
                    {
                        "doc_id": doc[row],
                        "text_hash": part["text_hash"].to_numpy()[row],
                        "start": start[row] + first,
                        "windows": n.astype(np.int32),
                    }
                )

        for batch in blocks(batches, "segment", SHARD // 2):
            held.append(batch)
            if sum(x.column("segment").nbytes for x in held) >= SHARD:
                # An anchor's segments stay together: cut where the last one begins.
                anchor = np.concatenate([x.column("anchor").to_numpy() for x in held])
                cut = int(np.flatnonzero(np.diff(anchor, prepend=anchor[0] + 1))[-1])
                if cut:
                    yield from shard(cut)
        if held:
            yield from shard()

    return (
        segments.repartition("anchor").sortWithinPartitions("anchor").mapInArrow(work, RUNS)
    )


def _by_window(segments: DataFrame, length: int) -> DataFrame:
    """Removed windows of anchors with very many occurrences, window by window."""

    def split(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in blocks(batches, "segment", 1 << 18):
            row, first, key = [], [], []
            for k, segment in enumerate(batch.column("segment").to_pylist()):
                for a in range(len(segment) - length + 1):
                    row.append(k)
                    first.append(a)
                    key.append(hashlib.blake2b(segment[a : a + length], digest_size=16).digest())
            start = batch.column("start").to_numpy()[np.array(row, np.int64)] + np.array(first, np.int64)
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(key, pa.binary()),
                    *(batch.column(c).take(pa.array(row, pa.int64())) for c in ("doc_id", "text_hash")),
                    pa.array(start),
                ],
                ["window", "doc_id", "text_hash", "start"],
            )

    rows = segments.mapInArrow(split, "window binary, doc_id long, text_hash long, start long")
    first = rows.groupBy("window").agg(
        F.count("*").alias("n"), F.min(F.struct("doc_id", "start")).alias("first")
    )
    return (
        rows.join(first.where("n > 1"), "window")
        .where(F.struct("doc_id", "start") != F.col("first"))
        .select("doc_id", "text_hash", "start", F.lit(1).alias("windows"))
    )


DIGEST = "doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string"


def remove_repeats(docs: DataFrame, length: int = 100, with_text: bool = False) -> DataFrame:
    """Remove each byte covered by a ``length``-byte string that also starts earlier.

    Earlier is at a smaller ``doc_id``, or in the same document at a smaller place; texts
    (null: empty) are judged as UTF-8 bytes and as they came, overlaps count and strings
    never cross documents. Rows of one id are one document for that order, so equal places
    in repeated rows do not remove each other. A null id is smaller than all others.

    Returns ``doc_id, n_bytes, n_removed, n_spans`` (maximal removed runs) and
    ``kept_sha256``; ``with_text`` adds ``kept`` (binary: a cut may split a character).
    """
    if length <= GRAM:
        raise ValueError(f"length must be above {GRAM}")
    none = -(1 << 63)
    rows = docs.select(
        F.coalesce(F.col("doc_id").cast("long"), F.lit(none)).alias("doc_id"),
        F.coalesce("text", F.lit("")).alias("text"),
    ).withColumn("text_hash", F.xxhash64("text"))
    every = staged(occurrences(rows, length), "occurrences")
    counts = staged(
        every.groupBy("anchor")
        .agg(
            F.count("*").alias("n"),
            (F.min("segment") != F.max("segment")).alias("contested"),
        )
        .where("n > 1"),
        "anchor-counts",
    )
    found = (
        every.join(counts, "anchor", "left")
        .where("n > 1 OR repeated")
        .withColumns(
            {"n": F.coalesce("n", F.lit(1)), "contested": F.coalesce("contested", F.lit(False))}
        )
    )
    removed, contested = _windows_left(staged(found, "anchors"))
    segments = staged(_cut(rows, contested, length), "segments")
    runs = (
        removed.unionByName(_within_shards(segments.where(F.col("n") <= SHARED), length))
        .unionByName(_by_window(segments.where(F.col("n") > SHARED), length))
        .groupBy("doc_id", "text_hash")
        .agg(F.collect_list(F.struct("start", "windows")).alias("runs"))
    )

    def finish(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in blocks(batches):
            data, offsets = text_bytes(batch.column("text"))
            lists = batch.column("runs")
            sizes = np.diff(lists.offsets.to_numpy())
            cells = lists.flatten()
            first = cells.field("start").to_numpy() + offsets[:-1][np.repeat(np.arange(len(sizes)), sizes)]
            last = first + cells.field("windows").to_numpy() + length - 1
            edges = np.zeros(len(data) + 1, np.int64)
            np.add.at(edges, first, 1)
            np.add.at(edges, last, -1)
            gone = np.cumsum(edges)[:-1] > 0
            out = {name: [] for name in ("n_bytes", "n_removed", "n_spans", "kept_sha256", "kept")}
            for a, b in zip(offsets[:-1].tolist(), offsets[1:].tolist()):
                mask = gone[a:b]
                kept = data[a:b][~mask].tobytes()
                out["n_bytes"].append(b - a)
                out["n_removed"].append(b - a - len(kept))
                out["n_spans"].append(len(spans_of(mask)[0]) if len(kept) < b - a else 0)
                out["kept_sha256"].append(hashlib.sha256(kept).hexdigest())
                if with_text:
                    out["kept"].append(kept)
            if not with_text:
                del out["kept"]
            yield pa.RecordBatch.from_pydict({"doc_id": batch.column("doc_id"), **out})

    empty = F.array().cast("array<struct<start:bigint,windows:int>>")
    return (
        rows.join(runs, ["doc_id", "text_hash"], "left")
        .select("doc_id", "text", F.coalesce("runs", empty).alias("runs"))
        .mapInArrow(finish, DIGEST + (", kept binary" if with_text else ""))
        .withColumn("doc_id", F.when(F.col("doc_id") != none, F.col("doc_id")))
    )
