"""Near-duplicate documents by b-bit MinHash.

A document is the set of its word shingles. Equal sets are one class. A class has
``MINIMA`` minima; four of them make a band, and classes that share a band meet in a
bucket. Only the low ``BITS`` bits of the minima are kept, packed by bit so that a few
xor, or and bit counts tell how many minima agree, from which a similarity corrected for
chance agreement is estimated. What passes is confirmed on the full sets.

A bucket is not expanded into pairs. Its members are first linked to its smallest and
largest member. Of members that are then still in different components, those whose
estimate allows a link across are compared in tiles, and only links that join components
leave a tile.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce
from math import comb

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lodeworks.llm.common import blocks, mix, ragged, staged, text_bytes
from lodeworks.llm.components import components
from lodeworks.llm.words import LOWER, words

#: A pair at similarity 0.85 shares none of the 24 bands with a probability of 2e-8.
MINIMA, BAND, BITS = 96, 4, 4
#: Classes, and shingles of all of them, that a tile of a group holds on average.
TILE_CLASSES, TILE_SHINGLES = 512, 1 << 20
#: Probability that a pair at the threshold fails the estimate.
MISSED = 1e-8
WORD_BYTES = np.ones(256, bool)
WORD_BYTES[[9, 10, 11, 12, 13, 32]] = False

_rng = np.random.default_rng(20240301)
_XOR = _rng.integers(0, 2**63, MINIMA, dtype=np.uint64)
_FACTOR = _rng.integers(0, 2**63, MINIMA, dtype=np.uint64) | np.uint64(1)
_SHINGLE = _rng.integers(0, 2**63, 64, dtype=np.uint64) | np.uint64(1)


def shingle_sets(texts: pa.Array, size: int) -> tuple[np.ndarray, np.ndarray]:
    """Sorted distinct hashes of each text's shingles, and where each set begins.

    A text of fewer words than ``size`` is one shingle, one without words has none.
    """
    data, offsets = text_bytes(texts)
    _, _, hashes, first = words(LOWER[data], offsets, WORD_BYTES)
    count = np.diff(first)
    shingles = np.where(count > 0, np.maximum(count - size, 0) + 1, 0)
    start = ragged(first[:-1], shingles)
    length = np.repeat(np.minimum(count, size), shingles)
    sums = length.astype(np.uint64)
    for k in range(size):
        part = hashes[np.minimum(start + k, max(0, len(hashes) - 1))] * _SHINGLE[k]
        sums += np.where(k < length, part, np.uint64(0))
    out = mix(sums)
    ends = np.cumsum(shingles)
    for a, b in zip((ends - shingles).tolist(), ends.tolist()):
        out[a:b].sort()
    new = np.ones(len(out), bool)
    new[1:] = out[1:] != out[:-1]
    new[(ends - shingles)[shingles > 0]] = True
    total = np.concatenate(([0], np.cumsum(new)))
    return out[new], total[np.concatenate(([0], ends))]


def signatures(sets: np.ndarray, begins: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For each set that is not empty, its band keys and its packed low bits."""
    starts = begins[:-1][np.diff(begins) > 0]
    n = len(starts)
    minima = np.zeros((MINIMA, n), np.uint64)
    if n:
        for k in range(MINIMA):
            minima[k] = np.minimum.reduceat((sets ^ _XOR[k]) * _FACTOR[k], starts)
    minima >>= np.uint64(32)
    bands = np.zeros((n, MINIMA // BAND), np.uint64)
    for k in range(MINIMA // BAND):
        key = np.full(n, k, np.uint64)
        for row in minima[k * BAND : (k + 1) * BAND]:
            key = mix(key ^ row, k + 1)
        bands[:, k] = key
    # One long per bit and 64 minima.
    longs = -(-MINIMA // 64)
    packed = np.zeros((n, BITS * longs), np.uint64)
    for k in range(MINIMA):
        for bit in range(BITS):
            value = (minima[k] >> np.uint64(bit)) & np.uint64(1)
            packed[:, bit * longs + k // 64] |= value << np.uint64(k % 64)
    return bands, packed


SKETCH = (
    "doc_id long, text_hash long, n_shingles long, class long, check long, "
    "bands array<long>, bits array<long>"
)


def _lists(values: np.ndarray) -> pa.Array:
    width = values.shape[1]
    return pa.ListArray.from_arrays(
        np.arange(0, values.size + 1, width, dtype=np.int32), pa.array(values.reshape(-1).view(np.int64))
    )


def sketches(docs: DataFrame, size: int) -> DataFrame:
    """``SKETCH`` rows of all documents. ``class`` and ``check`` are 128 bits of the set's
    own hash; a document with an empty set has class 0 and a null sketch."""

    def sketch(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in blocks(batches, limit=2 << 20):
            sets, begins = shingle_sets(batch.column("text"), size)
            n = np.diff(begins)
            some = n > 0
            bands, bits = signatures(sets, begins)
            own = []
            for seed in (101, 102):
                value = np.zeros(len(n), np.uint64)
                if some.any():
                    sums = np.add.reduceat(mix(sets, seed), begins[:-1][some])
                    value[some] = mix(sums + n[some].astype(np.uint64))
                own.append(value.view(np.int64))
            place = pa.array(np.cumsum(some) - 1, mask=~some)
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("doc_id"),
                    batch.column("text_hash"),
                    pa.array(n),
                    *map(pa.array, own),
                    _lists(bands).take(place),
                    _lists(bits).take(place),
                ],
                ["doc_id", "text_hash", "n_shingles", "class", "check", "bands", "bits"],
            )

    return _rows(docs).mapInArrow(sketch, SKETCH)


def _rows(docs: DataFrame) -> DataFrame:
    return docs.select(
        F.col("doc_id").cast("long"), "text", F.xxhash64("text").alias("text_hash")
    )


def _full_sets(docs: DataFrame, wanted: DataFrame, size: int) -> DataFrame:
    """``class, shingles`` for classes, each read from one of its documents.

    ``wanted`` has ``class, doc_id, text_hash``.
    """

    def sets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in blocks(batches, limit=2 << 20):
            values, begins = shingle_sets(batch.column("text"), size)
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("class"),
                    pa.LargeListArray.from_arrays(begins, values.view(np.int64)).cast(pa.list_(pa.int64())),
                ],
                ["class", "shingles"],
            )

    rows = _rows(docs).withColumnRenamed("doc_id", "own_id")
    found = wanted.join(
        rows, (wanted["text_hash"] == rows["text_hash"]) & wanted["doc_id"].eqNullSafe(rows["own_id"])
    ).select("class", "text")
    # A repeated row gives its set twice: any one will do.
    return found.mapInArrow(sets, "class long, shingles array<long>").dropDuplicates(["class"])


def agreeing(x: Column, y: Column) -> Column:
    """How many minima of two packed sketches agree in their low bits."""
    longs = -(-MINIMA // 64)
    differ = [
        F.bit_count(
            reduce(
                lambda p, q: p.bitwiseOR(q),
                [x[bit * longs + k].bitwiseXOR(y[bit * longs + k]) for bit in range(BITS)],
            )
        )
        for k in range(longs)
    ]
    return F.lit(MINIMA) - reduce(lambda p, q: p + q, differ)


def similarity(agreeing_minima: Column) -> Column:
    """The estimate of the Jaccard similarity, corrected for bits that agree by chance."""
    chance = 2.0**-BITS
    return (agreeing_minima / F.lit(float(MINIMA)) - chance) / (1 - chance)


def least_agreeing(percent: int) -> int:
    """The count that a pair at the threshold stays below with probability ``MISSED``."""
    p = percent / 100 + (1 - percent / 100) * 2.0**-BITS
    below = 0.0
    for k in range(MINIMA + 1):
        below += comb(MINIMA, k) * p**k * (1 - p) ** (MINIMA - k)
        if below > MISSED:
            return k
    return MINIMA


def _may_link(a: str, b: str, percent: int) -> Column:
    sizes = (F.col(f"{a}.n_shingles"), F.col(f"{b}.n_shingles"))
    return (100 * F.least(*sizes) >= percent * F.greatest(*sizes)) & (
        agreeing(F.col(f"{a}.bits"), F.col(f"{b}.bits")) >= least_agreeing(percent)
    )


def _confirmed(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """The pairs ``a, b`` of classes whose full sets are similar enough."""
    left = sets.select(F.col("class").alias("a"), F.col("shingles").alias("left"))
    right = sets.select(F.col("class").alias("b"), F.col("shingles").alias("right"))
    both = F.size(F.array_intersect("left", "right"))
    union = F.size("left") + F.size("right") - both
    return (
        pairs.join(left, "a").join(right, "b").where(100 * both >= percent * union).select("a", "b")
    )


def _joining_links(candidates: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """Links ``a, b`` that join components, found on the full sets of each group.

    A group is cut into tiles of bounded size and every tile meets every other one in a
    task. There all pairs are compared, and of those similar enough only the ones that join
    two components are returned: fewer than there are classes, whatever the pairs.
    """
    # Written, so that the join below is free to split the rows of a large group.
    sizes = staged(
        candidates.groupBy("low").agg(F.count("*").alias("n"), F.sum("n_shingles").alias("total")),
        "group-sizes",
    )
    tiles = F.greatest(
        F.ceil(F.col("n") / TILE_CLASSES), F.ceil(F.col("total") / TILE_SHINGLES)
    ).cast("int")
    own = F.pmod(F.xxhash64("class"), F.col("tiles")).cast("int")
    cells = (
        candidates.join(sizes.select("low", tiles.alias("tiles")), "low")
        .withColumn("own", own)
        .withColumn("other", F.explode(F.sequence(F.lit(0), F.col("tiles") - 1)))
        .select(
            "low",
            F.least("own", "other").alias("i"),
            F.greatest("own", "other").alias("j"),
            "class",
            "component",
        )
        .join(sets, "class")
        .repartition("low", "i", "j")
        .sortWithinPartitions("low", "i", "j")
    )

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []
        key = None
        for batch in batches:
            columns = np.stack([batch.column(c).to_numpy() for c in ("low", "i", "j")], axis=1)
            cuts = np.flatnonzero((np.diff(columns, axis=0) != 0).any(axis=1)) + 1
            for a, b in zip([0, *cuts], [*cuts, batch.num_rows]):
                if held and tuple(columns[a]) != key:
                    yield _spanning(held, percent)
                    held = []
                key = tuple(columns[a])
                held.append(batch.slice(a, b - a))
        if held:
            yield _spanning(held, percent)

    return cells.mapInArrow(compare, "a long, b long").distinct()


def _spanning(parts: list[pa.RecordBatch], percent: int) -> pa.RecordBatch:
    rows = pa.Table.from_batches(parts)
    classes, component = rows["class"].to_numpy(), rows["component"].to_numpy()
    lists = rows["shingles"].combine_chunks()
    values = lists.flatten().to_numpy()
    sizes = np.diff(lists.offsets.to_numpy())
    shared = common_counts(values, sizes)
    similar = 100 * shared >= percent * (sizes[:, None] + sizes[None, :] - shared)
    similar &= component[:, None] != component[None, :]
    top: dict[int, int] = {}

    def root(x: int) -> int:
        while x in top:
            x = top[x]
        return x

    links = []
    for a, b in zip(*np.nonzero(np.triu(similar, 1))):
        u, v = root(int(component[a])), root(int(component[b]))
        if u != v:
            top[u] = v
            links.append((classes[a], classes[b]))
    ends = np.array(links, np.int64).reshape(-1, 2)
    return pa.RecordBatch.from_pydict({"a": ends[:, 0].copy(), "b": ends[:, 1].copy()})


def common_counts(values: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """How many values each two of the sets share, as products of membership matrices."""
    n = len(sizes)
    owner = np.repeat(np.arange(n), sizes)
    order = np.argsort(values, kind="stable")
    ordered = values[order]
    new = np.concatenate(([True], ordered[1:] != ordered[:-1])) if len(values) else np.zeros(0, bool)
    column = np.cumsum(new) - 1
    # Values of one set alone are shared with nobody.
    often = np.bincount(column) > 1
    column = (np.cumsum(often) - 1)[column[often[column]]] if len(values) else column
    member = owner[order][often[np.cumsum(new) - 1]] if len(values) else owner
    shared = np.zeros((n, n), np.float64)
    width = 8192
    for first in range(0, int(often.sum()), width):
        a, b = np.searchsorted(column, (first, first + width))
        matrix = np.zeros((n, width), np.float32)
        matrix[member[a:b], column[a:b] - first] = 1
        shared += matrix @ matrix.T
    return shared.astype(np.int64)


def near_duplicates(docs: DataFrame, size: int = 5, percent: int = 80) -> DataFrame:
    """``doc_id, n_shingles, component_id, kept`` for every row of ``doc_id, text``.

    Documents are linked when ``100 * intersection >= percent * union`` holds for their
    shingle sets; a component is what links connect, and ``component_id`` its smallest
    ``doc_id``. A document without words is linked with nothing. Repeated rows and ids
    are separate members of their sets' classes; null ids are never the smallest, and
    a component of null ids alone has a null ``component_id`` and keeps all its rows.
    """
    return _labelled(docs, size, percent).select(
        "doc_id",
        "n_shingles",
        "component_id",
        F.col("doc_id").eqNullSafe(F.col("component_id")).alias("kept"),
    )


def one_of_each_group(docs: DataFrame, size: int = 5, percent: int = 80) -> DataFrame:
    """``doc_id, text_hash, linked`` of the documents that stay, each pair once.

    ``text_hash`` is ``xxhash64(text)``. Of each component of ``near_duplicates`` the
    pair with the smallest id stays, null ids last, and of one id that with the smallest
    hash. ``linked`` is false for documents without words, which all stay.
    """
    linked = F.col("n_shingles") > 0
    first = F.col("doc_id").eqNullSafe(F.col("component_id")) & (F.col("text_hash") == F.col("first_hash"))
    return (
        _labelled(docs, size, percent)
        .where(~linked | first)
        .select("doc_id", "text_hash", linked.alias("linked"))
        .distinct()
    )


def _labelled(docs: DataFrame, size: int, percent: int) -> DataFrame:
    """``doc_id, text_hash, n_shingles, component_id`` of every row, and the hash of its
    component's first text."""
    rows = staged(sketches(docs, size), "sketches")
    classes = staged(
        rows.where("n_shingles > 0")
        .groupBy("class", "check", "n_shingles")
        .agg(
            F.min(F.struct(F.col("doc_id").isNull().alias("unnamed"), "doc_id", "text_hash")).alias(
                "source"
            ),
            F.first("bands").alias("bands"),
            F.first("bits").alias("bits"),
        ),
        "classes",
    )
    in_buckets = classes.select("class", F.explode("bands").alias("bucket"))
    buckets = (
        in_buckets.groupBy("bucket")
        .agg(F.count("*").alias("n"), F.min("class").alias("low"), F.max("class").alias("high"))
        .where("n > 1")
    )
    members = staged(in_buckets.join(buckets, "bucket").select("bucket", "class", "low", "high"), "members")
    sketch = classes.select("class", F.struct("n_shingles", "bits").alias("s"))

    def ends(pairs: DataFrame) -> DataFrame:
        return (
            pairs.join(sketch.withColumnsRenamed({"class": "a", "s": "x"}), "a")
            .join(sketch.withColumnsRenamed({"class": "b", "s": "y"}), "b")
            .where(_may_link("x", "y", percent))
            .select("a", "b")
        )

    star = (
        members.select(F.explode(F.array("low", "high")).alias("end"), "class")
        .where("end <> class")
        .select(F.least("end", "class").alias("a"), F.greatest("end", "class").alias("b"))
        .distinct()
    )
    star = staged(ends(star), "pairs")
    source = classes.select("class", "source.doc_id", "source.text_hash")
    sets = staged(
        _full_sets(docs, members.select("class").distinct().join(source, "class"), size), "sets"
    )
    links = staged(_confirmed(star, sets, percent), "links")

    # Groups that the first links left in several components. All classes of a bucket share
    # its smallest class, so pairs of a bucket are pairs of a group.
    first = components(links)
    placed = (
        members.select("low", "class")
        .distinct()
        .join(first.withColumnRenamed("node", "class"), "class", "left")
        .withColumn("component", F.coalesce("component", "class"))
    )
    placed = staged(placed, "placed")
    split = staged(
        placed.groupBy("low")
        .agg(F.min("component").alias("from"), F.max("component").alias("to"))
        .where("from < to")
        .select("low"),
        "split-groups",
    )
    apart = staged(placed.join(split, "low").join(sketch.select("class", "s.*"), "class"), "apart")
    x, y = apart.alias("x"), apart.alias("y")
    # Classes with a candidate in another component; one is enough to stay.
    candidates = x.join(
        y,
        (F.col("x.low") == F.col("y.low"))
        & (F.col("x.component") != F.col("y.component"))
        & _may_link("x", "y", percent),
        "left_semi",
    ).select("low", "class", "component", "n_shingles")
    more = staged(_joining_links(staged(candidates, "candidates"), sets, percent), "links")

    # Second links join components of the first.
    root = first.withColumnsRenamed({"node": "b", "component": "to_b"})
    joined = (
        more.join(first.withColumnsRenamed({"node": "a", "component": "to_a"}), "a", "left")
        .join(root, "b", "left")
        .select(F.coalesce("to_a", "a").alias("a"), F.coalesce("to_b", "b").alias("b"))
    )
    second = components(joined).select(
        F.col("node").alias("component"), F.col("component").alias("final")
    )
    placed = (
        classes.select("class", "source")
        .join(first.withColumnRenamed("node", "class"), "class", "left")
        .withColumn("component", F.coalesce("component", "class"))
        .join(second, "component", "left")
        .select("class", "source", F.coalesce("final", "component").alias("component"))
    )
    lowest = placed.groupBy("component").agg(F.min("source").alias("lowest"))
    labels = placed.join(lowest, "component").select(
        "class", F.col("lowest.doc_id").alias("component_id"), F.col("lowest.text_hash").alias("first_hash")
    )
    return (
        rows.select("doc_id", "text_hash", "n_shingles", "class")
        .join(labels, "class", "left")
        .withColumn(
            "component_id", F.when(F.col("n_shingles") == 0, F.col("doc_id")).otherwise(F.col("component_id"))
        )
        .select("doc_id", "text_hash", "n_shingles", "component_id", "first_hash")
    )
