"""Exact top-k against brute force."""

import math

import numpy as np
import pytest

from starloom.llm import top_k


def brute(rows, k, asked, scale=1024):
    good = [(i, [math.floor(scale * x) if abs(x) < 2**40 else scale * int(x) for x in v]) for i, v in rows
            if i is not None and v is not None and all(x is not None and math.isfinite(x) for x in v)]
    out = []
    for q, w in good:
        if asked(q):
            scored = sorted((-sum(a * b for a, b in zip(w, v)), i) for i, v in good if i != q)
            out += [(q, n, i, max(-(2**63), min(2**63 - 1, -s))) for n, (s, i) in enumerate(scored[:k], 1)]
    return sorted(out)


@pytest.mark.parametrize("slab,group", [(2048, 4096), (40, 3)])
def test_against_brute_force(spark, slab, group):
    rng = np.random.default_rng(8)
    vectors = np.round(rng.normal(0, 1, (400, 12)), 1)  # coarse, so that scores tie
    rows = [(i, [float(x) for x in v]) for i, v in enumerate(vectors)]
    rows += [(5, rows[5][1]), (5, rows[6][1]), (401, rows[7][1]), (402, None), (403, [None] + rows[0][1][1:]), (404, [math.nan] * 12),
             (405, [math.inf] * 12), (None, rows[1][1]), (406, [0.0] * 12), (410, []), (420, [1.0, 2.0]), (20, rows[20][1]), (20, rows[21][1])]
    df = spark.createDataFrame(rows, "vec_id bigint, embedding array<double>").selectExpr("*", "1 AS id", "2 AS v", "3 AS score")
    v = top_k.finite_vectors(df, "vec_id", "embedding")
    got = top_k.top_k(v, v.filter("id % 10 = 0"), 10, slab, group)
    assert sorted(tuple(r) for r in got.collect()) == brute(rows, 10, lambda i: i % 10 == 0)


def test_large_components_take_part(spark):
    rng = np.random.default_rng(9)
    rows = [(i, [float(x) for x in rng.normal(0, 1, 4)]) for i in range(60)]
    rows += [(60, [1e6, -1e6, 3.0, 0.0]), (61, [200_000.0, 0.0, 0.0, 0.0]), (70, [1e30, 1e30, 1.0, 1.0]), (71, [1e30, 1.1e30, -1.0, 1.0]),
             (72, [-3e38, 1e300, 0.0, 2.0]), (3, [1e6, 0.0, 0.0, 0.0])]
    df = spark.createDataFrame(rows, "vec_id bigint, embedding array<double>")
    v = top_k.finite_vectors(df, "vec_id", "embedding")
    got = top_k.top_k(v, v.filter("id % 10 = 0"), 10, 16, 3)
    assert sorted(tuple(r) for r in got.collect()) == brute(rows, 10, lambda i: i % 10 == 0)


def test_few_rows(spark):
    df = spark.createDataFrame([(0, [1.0]), (1, [2.0])], "vec_id bigint, embedding array<float>")
    v = top_k.finite_vectors(df, "vec_id", "embedding")
    assert [tuple(r) for r in top_k.top_k(v, v.filter("id = 0")).collect()] == [(0, 1, 1, 1024 * 2048)]
    assert top_k.top_k(v.limit(0), v.limit(0)).count() == 0


def test_candidates_are_dropped_by_their_bounds(monkeypatch):
    """Few candidates are left to sum up, and the bounds hold for each depth."""
    rng = np.random.default_rng(1)
    vectors = rng.integers(-900, 900, (3000, 24))
    vectors[:40] = vectors[3] + rng.integers(-90, 90, (40, 24))
    lists = top_k.SortedLists(np.arange(3000), vectors)
    queries = vectors[[3, 700, 40]]
    for (ids, scores), query, skip in zip(lists.best(queries, [3, 700, 40], 10), queries, [3, 700, 40]):
        want = sorted((-(vectors[i] @ query), i) for i in range(3000) if i != skip)[:10]
        assert [(-s, i) for i, s in zip(ids.tolist(), scores.tolist())] == want
    for depth in (1, 100, 1500, 3000):
        high, low, worst_high, worst_low = lists._read_to(depth)
        for query in queries:
            rise, fall, true = np.maximum(query, 0), np.minimum(query, 0), vectors @ query
            assert (high @ rise + low @ fall >= true).all() and (worst_high @ rise + worst_low @ fall <= true).all()
    high, low, _, _ = lists._read_to(1500)
    upper = high @ np.maximum(queries[0], 0) + low @ np.minimum(queries[0], 0)
    assert (upper >= np.sort(vectors @ queries[0])[-10]).sum() < 300
