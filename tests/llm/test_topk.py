"""Exact search and components against brute force."""

import numpy as np
import pytest

from lodeworks.llm import topk
from lodeworks.llm.components import components


def brute(queries, rows, k):
    out = []
    for q, x in queries:
        found = sorted(
            ((int(np.dot(x, y)), v) for v, y in rows if v != q and len(x) == len(y)), key=lambda t: (-t[0], t[1])
        )
        out += [(q, rank, v, s) for rank, (s, v) in enumerate(found[:k], 1)]
    return sorted(out)


@pytest.mark.parametrize("block", (3, 4096))
def test_top_k_matches_brute_force(spark, monkeypatch, block):
    monkeypatch.setattr(topk, "SHARD_BLOCK", block)
    monkeypatch.setattr(topk, "QUERY_BLOCK", 2)
    monkeypatch.setattr(topk, "BAND_BLOCKS", 2)
    rng = np.random.default_rng(1)
    rows = [(i, rng.uniform(-1, 1, 4).round(1).tolist(), "x") for i in range(40)]
    rows += [(40, [0.5] * 4, "x")] * 3 + [(41, [1e6] * 4, "x"), (42, [1.0, 2.0], "x"), (43, [3.0, 1.0], "x")]
    bad = [
        (50, None, "x"),
        (51, [1.0, None, 1.0, 1.0], "x"),
        (52, [float("nan")] * 4, "x"),
        (53, [float("inf"), 1.0, 1.0, 1.0], "x"),
        (None, [1.0] * 4, "x"),
    ]
    table = spark.createDataFrame(rows + bad, "vec_id long, embedding array<double>, score string")
    vectors = topk.quantized(table, "vec_id", "embedding", 256)
    whole = [(i, np.floor(np.array(x) * 256)) for i, x, _ in rows]
    got = topk.top_k(vectors.where("id % 4 = 0"), vectors, 5).collect()
    assert sorted(map(tuple, got)) == brute([(i, x) for i, x in {i: x for i, x in whole if i % 4 == 0}.items()], whole, 5)


def test_bands_do_not_depend_on_the_order_of_rows(spark, monkeypatch):
    taken = []
    packed = topk._packed
    monkeypatch.setattr(topk, "_packed", lambda *given: taken.append(packed(*given)) or taken[-1])
    monkeypatch.setattr(topk, "QUERY_BLOCK", 4)
    monkeypatch.setattr(topk, "SHARD_BLOCK", 4)
    monkeypatch.setattr(topk, "BAND_BLOCKS", 2)
    rows = [(i, [float(i % 7), float(i % 5)]) for i in range(60)]
    for order in (rows, rows[::-1]):
        vectors = spark.createDataFrame(order, "id long, vector array<double>").coalesce(1)
        topk.top_k(vectors, vectors, 3)
    bands = []
    for side in taken:
        # The band's column, or a hash that gives it.
        last = [c for c in side.columns if c.endswith(("band", "salt"))][0]
        bands.append({(x, r[last]) for r in side.collect() for x in np.frombuffer(r["ids"], "<i8").tolist()})
    assert bands[0] == bands[2] and bands[1] == bands[3]
    assert [len(b) for b in bands] == [60] * 4 and len({k for _, k in bands[1]}) > 1


def test_large_products_are_exact(spark):
    rows = [(0, [float(2**30 + 1)] * 2), (1, [float(2**30 + 3)] * 2), (2, [float(2**30)] * 2)]
    vectors = spark.createDataFrame(rows, "id long, vector array<double>")
    got = topk.top_k(vectors.where("id = 0"), vectors, 5).orderBy("rank").collect()
    assert [r["score"] for r in got] == [2 * (2**30 + 1) * (2**30 + 3), 2 * (2**30 + 1) * 2**30]


def test_scores_beyond_a_long_are_its_ends(spark):
    big = 2.0**40
    rows = [(0, [big, 3.0]), (1, [big, 1.0]), (2, [-big, 1.0]), (3, [2.0, 1.0]), (4, [2.0**63, -(2.0**63)])]
    rows += [(5, []), (6, [])]
    vectors = spark.createDataFrame(rows, "id long, vector array<double>")
    got = topk.top_k(vectors, vectors, 5).collect()
    last = 2**63 - 1
    whole = {i: [int(c) for c in x] for i, x in rows}
    want = []
    for q, x in whole.items():
        scores = [
            (max(-last, min(last, sum(a * b for a, b in zip(x, y)))), v)
            for v, y in whole.items()
            if v != q and len(x) == len(y)
        ]
        want += [(q, k, v, s) for k, (s, v) in enumerate(sorted(scores, key=lambda t: (-t[0], t[1])), 1)]
    assert sorted(map(tuple, got)) == sorted(want)


def test_search_of_nothing(spark):
    empty = spark.createDataFrame([], "id long, vector array<double>")
    one = spark.createDataFrame([(1, [1.0])], "id long, vector array<double>")
    assert topk.top_k(empty, one, 5).count() == 0
    assert topk.top_k(one, empty, 5).count() == 0
    assert topk.top_k(one, one, 5).count() == 0


def test_components_of_chains_and_stars(spark):
    links = [(i, i + 1) for i in range(0, 60)] + [(100, k) for k in range(101, 160)] + [(7, 7), (200, 201), (201, 200)]
    got = components(spark.createDataFrame(links, "a long, b long")).collect()
    want = {i: 0 for i in range(61)} | {k: 100 for k in range(100, 160)} | {200: 200, 201: 200}
    assert {r["node"]: r["component"] for r in got} == want and len(got) == len(want)
    assert components(spark.createDataFrame([], "a long, b long")).count() == 0
