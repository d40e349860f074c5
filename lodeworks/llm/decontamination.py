"""Benchmark decontamination over a distributed positional inverted index.

The index is partitioned by document: a row covers a block of documents and holds,
for each of its terms, the ascending word positions at which the term stands. It is
written once and answers any number of phrase sets. A phrase is looked up in a block
from its rarest term there: that term's list, moved by the term's place in the phrase,
is intersected with the lists of the other terms, rarer ones first.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lodeworks.llm.common import blocks, ragged, staged, text_bytes
from lodeworks.llm.words import LOWER, words

#: Word bytes: digits, lower-case letters and every byte outside ASCII.
TERM_BYTES = np.zeros(256, bool)
TERM_BYTES[0x30:0x3A] = TERM_BYTES[0x61:0x7B] = TERM_BYTES[0x80:] = True
#: Bytes of text in an index block, whose words a task sorts at once, and of benchmark text
#: that it cuts into windows of about 20 times the size at once.
INDEXED_BYTES, CUT_BYTES = 4 << 20, 1 << 20
#: Phrase rows (phrase and item) that are sent to the executors at once: 20 MB.
PHRASES_AT_ONCE = 200_000
INDEX = (
    "block long, doc_ids array<long>, doc_words array<long>, terms binary, term_counts binary, "
    "postings binary"
)
#: Free positions between documents, so that no phrase reaches from one into the next;
#: a proximity search needs more than twice its slack of them.
GAP = 16
#: Positions of a block stay below this, so that (term, position) fits one integer.
SPAN = np.int64(1) << np.int64(36)


def _terms(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    data, offsets = text_bytes(column)
    _, _, hashes, first = words(LOWER[data], offsets, TERM_BYTES)
    return hashes, first


def build_index(docs: DataFrame) -> DataFrame:
    """Postings of every term of every text, as a written table (see ``INDEX``).

    A null text has no words. ``terms`` are sorted 64-bit term hashes, ``postings`` the
    differences of successive positions (unsigned 32-bit, wrapping), term by term.
    """

    def index(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for number, batch in enumerate(blocks(batches, limit=INDEXED_BYTES)):
            hashes, first = _terms(batch.column("text"))
            order = np.argsort(hashes, kind="stable")
            hashes = hashes[order]
            begins = np.flatnonzero(np.concatenate(([True], hashes[1:] != hashes[:-1]))[: len(hashes)])
            terms, counts = hashes[begins], np.diff(begins, append=len(hashes))
            moved = np.repeat(np.arange(len(first) - 1, dtype="<u4") * np.uint32(GAP), np.diff(first))
            positions = order.astype("<u4") + moved[order]
            ids = batch.column("doc_id")
            yield pa.RecordBatch.from_pydict(
                {
                    "block": np.array([number]),
                    "doc_ids": pa.ListArray.from_arrays([0, len(ids)], ids),
                    "doc_words": pa.array([np.diff(first)], pa.list_(pa.int64())),
                    "terms": pa.array([terms.astype("<u8").tobytes()], pa.binary()),
                    "term_counts": pa.array([counts.astype("<u4").tobytes()], pa.binary()),
                    "postings": pa.array(
                        [np.diff(positions, prepend=np.uint32(0)).tobytes()], pa.binary()
                    ),
                }
            )

    rows = docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(index, INDEX)
    part = F.spark_partition_id().cast("long") * (1 << 32)
    return staged(rows.withColumn("block", F.col("block") + part), "postings")


def phrases(items: DataFrame, size: int, unnamed: bool = True) -> DataFrame:
    """Distinct ``terms, item_id``: each item's windows of ``size`` words.

    An item of fewer words is one window, one of none has no window. Items without an
    id have windows as well, unless not ``unnamed``; a repeated id stands for all its texts.
    """

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in blocks(batches, limit=CUT_BYTES):
            hashes, first = _terms(batch.column("text"))
            count = np.diff(first)
            windows = np.where(count > 0, np.maximum(count - size, 0) + 1, 0)
            owner = np.repeat(np.arange(len(count)), windows)
            start = ragged(first[:-1], windows)
            length = np.minimum(size, count[owner])
            raw = hashes.astype("<u8").tobytes()
            yield pa.RecordBatch.from_pydict(
                {
                    "terms": pa.array(
                        [raw[8 * a : 8 * (a + n)] for a, n in zip(start.tolist(), length.tolist())],
                        pa.binary(),
                    ),
                    "item_id": batch.column("item_id").take(pa.array(owner)),
                }
            )

    return (
        items.where(F.lit(unnamed) | F.col("item_id").isNotNull())
        .select(F.col("item_id").cast("string").alias("item_id"), "text")
        .mapInArrow(cut, "terms binary, item_id string")
        .distinct()
    )


class _Postings:
    """The lists of one block."""

    def __init__(self, row: dict[str, np.ndarray]):
        self.terms = row["terms"]
        self.counts = row["term_counts"].astype(np.int64)
        self.begins = np.cumsum(self.counts) - self.counts
        self.positions = np.cumsum(row["postings"], dtype=np.uint32).astype(np.int64)
        # Sorted, as lists stand in term order and ascend.
        self.keys = np.repeat(np.arange(len(self.terms)), self.counts) * SPAN + self.positions

    def places(self, terms: np.ndarray) -> np.ndarray:
        """The number of each term in this block, -1 where the block lacks it."""
        at = np.searchsorted(self.terms, terms)
        at[at == len(self.terms)] = 0
        return np.where(self.terms[at] == terms, at, -1) if len(self.terms) else at - 1

    def near(self, term: np.ndarray, position: np.ndarray, slack: int) -> np.ndarray:
        """Whether the term stands within ``slack`` words of the position."""
        low = np.maximum(position - slack, 0)
        at = np.searchsorted(self.keys, term * SPAN + low)
        found = self.keys[np.minimum(at, len(self.keys) - 1)]
        return (at < len(self.keys)) & (found <= term * SPAN + position + slack) & (position + slack >= 0)


def _matches(
    lists: _Postings, flat: np.ndarray, begins: np.ndarray, sizes: np.ndarray, slack: int
) -> tuple[np.ndarray, np.ndarray]:
    """Phrase numbers and start positions of all matches in a block."""
    place = lists.places(flat)
    missing = np.logical_or.reduceat(place < 0, begins) if len(begins) else np.zeros(0, bool)
    alive = np.flatnonzero(~missing)
    if not len(alive):
        return alive, alive
    often = np.where(place < 0, 0, lists.counts[place])
    phrase, start = [], []
    for size in np.unique(sizes[alive]).tolist():
        mine = alive[sizes[alive] == size]
        grid = begins[mine][:, None] + np.arange(size)
        by_rarity = np.argsort(often[grid], axis=1, kind="stable")
        row = np.arange(len(mine))
        rarest = place[grid[row, by_rarity[:, 0]]]
        n = lists.counts[rarest]
        anchors = lists.positions[ragged(lists.begins[rarest], n)] - by_rarity[np.repeat(row, n), 0]
        for shift in range(-slack, slack + 1):
            who, at = np.repeat(row, n), anchors + shift
            who, at = who[at >= 0], at[at >= 0]
            for k in range(1, size):
                offset = by_rarity[who, k]
                ok = lists.near(place[grid[who, offset]], at + offset, slack)
                who, at = who[ok], at[ok]
            phrase.append(mine[who])
            start.append(at)
    return np.concatenate(phrase), np.concatenate(start)


def search(index: DataFrame, phrase_rows: DataFrame, slack: int = 0) -> DataFrame:
    """Matches of phrases in every indexed document.

    Returns ``doc_id, n_words, n_hit`` (words inside an exact occurrence),
    ``n_items, items_sha256`` (items with an id and an exact occurrence), and with a ``slack``
    ``n_near`` (phrases not found exactly whose words all stand within ``slack`` words of
    their places in some alignment).
    Phrase sets above ``PHRASES_AT_ONCE`` rows are searched in blocks, whose hits are
    united. An empty phrase set leaves every document without hits.
    """
    if not 0 <= 2 * slack < GAP:
        raise ValueError(f"slack must be below {GAP // 2}")
    spark = index.sparkSession
    rounds = max(1, -(-phrase_rows.count() // PHRASES_AT_ONCE))
    # Dealt by phrase and item, so that no phrase of many items makes a block larger.
    dealt = phrase_rows.withColumn("_round", F.pmod(F.xxhash64("terms", "item_id"), F.lit(rounds)))
    hits = None
    for number in range(rounds):
        rows = dealt.where(F.col("_round") == number).select("terms", "item_id").collect()
        known: dict[bytes, list[str | None]] = {}
        for row in rows:
            known.setdefault(bytes(row["terms"]), []).append(row["item_id"])
        shared = spark.sparkContext.broadcast(known)
        found = index.mapInArrow(_searcher(shared, slack), FOUND)
        hits = found if hits is None else hits.unionByName(found)
    if rounds > 1:
        hits = hits.groupBy("block", "row", "doc_id", "n_words").agg(
            F.array_distinct(F.flatten(F.collect_list("hit_words"))).alias("hit_words"),
            F.array_sort(F.array_distinct(F.flatten(F.collect_list("items")))).alias("items"),
            F.sum("n_near").alias("n_near"),
        )
    return hits.select(
        "doc_id",
        "n_words",
        F.size("hit_words").cast("long").alias("n_hit"),
        F.size("items").cast("long").alias("n_items"),
        F.sha2(F.array_join("items", ",").cast("binary"), 256).alias("items_sha256"),
        (F.size("hit_words") > 0).alias("contaminated"),
        *(["n_near"] if slack else []),
    )


FOUND = (
    "block long, row long, doc_id long, n_words long, hit_words array<long>, "
    "items array<string>, n_near long"
)


def _searcher(shared, slack: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = shared.value
        items = [[x for x in names if x is not None] for names in known.values()]
        sizes = np.array([len(x) // 8 for x in known], np.int64)
        flat = np.frombuffer(b"".join(known), "<u8")
        begins = np.cumsum(sizes) - sizes
        for batch in batches:
            for i in range(batch.num_rows):
                cell = {
                    name: np.frombuffer(batch.column(name)[i].as_buffer(), kind)
                    for name, kind in (("terms", "<u8"), ("term_counts", "<u4"), ("postings", "<u4"))
                }
                n_words = batch.column("doc_words")[i].values.to_numpy()
                ids = batch.column("doc_ids")[i].values
                begin = np.cumsum(n_words + GAP) - n_words - GAP
                lists = _Postings(cell)
                phrase, start = _matches(lists, flat, begins, sizes, 0)
                hit = np.zeros(int((n_words + GAP).sum()) + 1, np.int32)
                np.add.at(hit, start, 1)
                np.add.at(hit, start + sizes[phrase], -1)
                word = np.flatnonzero(np.cumsum(hit) > 0)
                word_doc = np.searchsorted(begin, word, "right") - 1
                word = word - begin[word_doc]
                doc = np.searchsorted(begin, start, "right") - 1
                exact = np.unique(doc * len(sizes) + phrase)
                by_doc: dict[int, set[str]] = {}
                for pair in exact.tolist():
                    by_doc.setdefault(pair // len(sizes), set()).update(items[pair % len(sizes)])
                near = np.zeros(len(n_words), np.int64)
                if slack:
                    phrase, start = _matches(lists, flat, begins, sizes, slack)
                    doc = np.searchsorted(begin, start + GAP // 2, "right") - 1
                    pairs = np.setdiff1d(doc * len(sizes) + phrase, exact)
                    near += np.bincount(pairs // max(1, len(sizes)), minlength=len(n_words))
                cuts = np.searchsorted(word_doc, np.arange(len(n_words) + 1))
                yield pa.RecordBatch.from_pydict(
                    {
                        "block": pa.array([batch.column("block")[i].as_py()] * len(ids), pa.int64()),
                        "row": np.arange(len(ids)),
                        "doc_id": ids,
                        "n_words": n_words,
                        "hit_words": pa.ListArray.from_arrays(cuts.astype(np.int32), pa.array(word)),
                        "items": pa.array(
                            [sorted(by_doc.get(d, ())) for d in range(len(ids))], pa.list_(pa.string())
                        ),
                        "n_near": near,
                    }
                )

    return run


def contamination(
    docs: DataFrame, benchmark: DataFrame, size: int = 10, slack: int = 0, unnamed: bool = True
) -> DataFrame:
    """Index ``docs`` (``doc_id, text``) and search the windows of ``benchmark`` in it.

    See ``search`` for the columns; there is one row per input row, also for null or
    repeated ids. ``benchmark`` has ``item_id, text``. Passages of items without an id are hits
    too, only that no item is reported for them; without ``unnamed`` they are left out.
    """
    return search(build_index(docs), phrases(benchmark, size, unnamed), slack)
