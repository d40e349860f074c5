"""Exact top-k search by inner product, as tiled matrix products.

Queries and candidates are packed into blocks of a fixed number of vectors. A tile is
one query block against one candidate block: a matrix product, then a partial
selection of k for each query. The lists of a query are merged in two levels, tiles
into groups and groups into the result. Neither side is broadcast or collected.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

#: Vectors of a block, and blocks that a band of the tile grid holds.
QUERY_BLOCK, SHARD_BLOCK, BAND_BLOCKS = 512, 4096, 16
#: Blocks' worth of vectors that a task gathers at once over all its bands.
HELD_BLOCKS = 4
#: Products of doubles are exact up to here, and of longs below here.
EXACT, WRAPS = 2.0**53, 2.0**63


def quantized(vectors: DataFrame, id_col: str, vector_col: str, scale: int) -> DataFrame:
    """``id, vector`` with components floor(scale * x) as double.

    Vectors that are null or hold a null, NaN or infinite component are left out.
    """
    x = F.col(vector_col)
    finite = F.forall(
        x, lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c.cast("double")) < float("inf"))
    )
    return vectors.where(x.isNotNull() & finite & F.col(id_col).isNotNull()).select(
        F.col(id_col).cast("long").alias("id"),
        F.transform(x, lambda c: F.floor(c.cast("double") * scale).cast("double")).alias("vector"),
    )


def _packed(vectors: DataFrame, size: int, band: str, bands: int) -> DataFrame:
    """Rows ``dim, ids, matrix`` and the band: vectors of one length and band, ``size`` at
    most in a row.

    A vector's band is a hash of its id and content. Rows that a lost task gives again in
    another order make other blocks, but every vector stays in its band.
    """

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[tuple[int, int], list] = {}
        count: Counter[tuple[int, int]] = Counter()

        def row(key: tuple[int, int]) -> pa.RecordBatch:
            del count[key]
            ids, matrix = (np.concatenate(x) for x in zip(*held.pop(key)))
            return pa.RecordBatch.from_pydict(
                {
                    "dim": pa.array(key[:1], pa.int32()),
                    band: pa.array(key[1:], pa.int32()),
                    "ids": pa.array([ids.astype("<i8").tobytes()], pa.binary()),
                    "matrix": pa.array([matrix.astype("<f8").tobytes()], pa.binary()),
                }
            )

        for batch in batches:
            vectors, ids = batch.column("vector"), batch.column("id").to_numpy()
            own = batch.column(band).to_numpy()
            sizes = np.diff(vectors.offsets.to_numpy())
            values = vectors.flatten().to_numpy()
            ends = np.cumsum(sizes)
            for dim, number in set(zip(sizes.tolist(), own.tolist())):
                key = dim, number
                rows = np.flatnonzero((sizes == dim) & (own == number))
                places = (ends[rows] - dim)[:, None] + np.arange(dim)
                first = 0
                while first < len(rows):
                    part = slice(first, first + size - count[key])
                    held.setdefault(key, []).append((ids[rows[part]], values[places[part]]))
                    count[key] += len(rows[part])
                    first = part.stop
                    if count[key] >= size:
                        yield row(key)
            # Many bands hold no more than a few blocks.
            while count.total() > HELD_BLOCKS * size:
                yield row(count.most_common(1)[0][0])
        for key in list(held):
            yield row(key)

    own = F.pmod(F.xxhash64("id", "vector"), F.lit(bands)).cast("int")
    return vectors.select("id", "vector", own.alias(band)).mapInArrow(
        pack, f"dim int, {band} int, ids binary, matrix binary"
    )


def _scores(left: np.ndarray, right: np.ndarray) -> np.ndarray:
    """The exact inner products. One that no long holds is given as the nearest of
    -(2^63 - 1) and 2^63 - 1."""
    rows, columns = (np.abs(x).max(axis=1, initial=0) * np.sqrt(x.shape[1]) for x in (left, right))
    bound = rows.max(initial=0) * columns.max(initial=0)
    if bound < EXACT:
        return left @ right.T
    # Values that are too large for a long are only in rows that are done again below.
    first, second = (np.where(np.abs(x) < WRAPS, x, 0).astype(np.int64) for x in (left, right))
    scores = first @ second.T
    if bound < WRAPS / 2:
        return scores
    last = 2**63 - 1
    for row in np.flatnonzero(rows * columns.max(initial=0) >= WRAPS / 2):
        query = [int(x) for x in left[row]]
        for column in np.flatnonzero(rows[row] * columns >= WRAPS / 2):
            exact = sum(a * int(b) for a, b in zip(query, right[column]))
            scores[row, column] = max(-last, min(last, exact))
    return scores


def _tile(left, q_ids, right, c_ids, k: int, skip_same_id: bool):
    """Rows of each query's k best candidates in one tile: query row, candidate row, score."""
    scores = _scores(left, right)
    valid = np.ones(scores.shape, bool)
    if skip_same_id:
        order = np.argsort(c_ids, kind="stable")
        first = np.searchsorted(c_ids[order], q_ids, "left")
        last = np.searchsorted(c_ids[order], q_ids, "right")
        for row in np.flatnonzero(last > first):
            valid[row, order[first[row] : last[row]]] = False
    lowest = scores.min() - 1 if scores.size else 0
    shown = np.where(valid, scores, lowest)
    least = np.partition(shown, -min(k, shown.shape[1]), axis=1)[:, -min(k, shown.shape[1])]
    rows, columns = np.nonzero(valid & (shown >= least[:, None]))
    order = np.lexsort((c_ids[columns], -scores[rows, columns], rows))
    rows, columns = rows[order], columns[order]
    rank = np.arange(len(rows)) - np.searchsorted(rows, rows, "left")
    rows, columns = rows[rank < k], columns[rank < k]
    return rows, columns, scores[rows, columns].astype(np.int64)


def _best(lists: DataFrame, keys: list[str], k: int) -> DataFrame:
    order = Window.partitionBy(*keys).orderBy(F.desc("score"), "vec_id")
    return lists.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)


def top_k(queries: DataFrame, candidates: DataFrame, k: int, skip_same_id: bool = True) -> DataFrame:
    """The k candidates with the largest inner product for each query.

    Both sides are ``id, vector`` (whole numbers as double, as ``quantized`` makes them);
    only vectors of equal length meet. Ties go to the smaller id. With ``skip_same_id`` a
    query does not find rows of its own id. Repeated candidate rows count each. Query rows
    of one id are one query: equal ones count once, of different ones the best scores count.
    Scores beyond a long are its ends (see ``_scores``); empty vectors score 0. Returns
    ``query_id, rank, vec_id, score``; a query with no candidate has no row, and empty
    sides give no rows.
    """
    # The grid: each side is cut into bands of a bounded number of vectors, and every band
    # of queries meets every band of candidates in a cell of its own. Small sides get more
    # bands of candidates, so that every core has a cell.
    queries = queries.distinct()
    n_queries, n_candidates = queries.count(), candidates.count()
    cores = queries.sparkSession.sparkContext.defaultParallelism
    q_bands = 1 + n_queries // (QUERY_BLOCK * BAND_BLOCKS)
    c_bands = max(
        1 + n_candidates // (SHARD_BLOCK * BAND_BLOCKS),
        min(-(-cores // q_bands), 1 + n_candidates // SHARD_BLOCK),
    )

    def every(side: DataFrame, other: str, others: int) -> DataFrame:
        return side.withColumn(other, F.explode(F.sequence(F.lit(0), F.lit(others - 1))))

    q = every(_packed(queries, QUERY_BLOCK, "q_band", q_bands), "c_band", c_bands)
    c = every(_packed(candidates, SHARD_BLOCK, "c_band", c_bands), "q_band", q_bands)
    grid = q.select(
        "dim", "q_band", "c_band", F.col("ids").alias("q_ids"), F.col("matrix").alias("q_matrix")
    ).join(c.select("dim", "q_band", "c_band", "ids", "matrix"), ["dim", "q_band", "c_band"])

    def tiles(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                dim = batch.column("dim")[i].as_py()

                def cell(name: str, kind: str) -> np.ndarray:
                    return np.frombuffer(batch.column(name)[i].as_buffer(), kind)

                q_ids, c_ids = cell("q_ids", "<i8"), cell("ids", "<i8")
                rows, columns, scores = _tile(
                    cell("q_matrix", "<f8").reshape(len(q_ids), dim),
                    q_ids,
                    cell("matrix", "<f8").reshape(len(c_ids), dim),
                    c_ids,
                    k,
                    skip_same_id,
                )
                band = np.full(len(rows), batch.column("c_band")[i].as_py(), np.int32)
                yield pa.RecordBatch.from_pydict(
                    {
                        "query_id": q_ids[rows],
                        "vec_id": c_ids[columns],
                        "score": scores,
                        "band": band,
                    }
                )

    lists = grid.mapInArrow(tiles, "query_id long, vec_id long, score long, band int")
    merged = _best(lists, ["query_id", "band"], k).drop("rank")
    return _best(merged, ["query_id"], k).select("query_id", "rank", "vec_id", "score")
