"""Product codes against k-means that tries every entry."""

import hashlib
import math

import numpy as np
import pytest

from starloom.llm import vector_codes as vc


def brute(rows, parts, entries, rounds, scale):
    kept = [(i, [math.floor(scale * x) if abs(x) < 2**53 else scale * int(x) for x in v], lab)
            for i, v, lab in rows if v and len(v) % parts == 0 and all(x is not None and math.isfinite(x) for x in v)]
    kept.sort(key=lambda r: (r[0] is None, r[0] or 0, r[1]))
    kept = [r for r in kept if len(r[1]) == len(kept[0][1])]
    width = len(kept[0][1]) // parts

    def cut(v):
        return [v[p * width : (p + 1) * width] for p in range(parts)]

    book = [[cut(v)[p] for _, v, _ in kept[:entries]] for p in range(parts)]

    def nearest(p, x):
        return min((sum((a - b) ** 2 for a, b in zip(x, c)), e) for e, c in enumerate(book[p]))

    for _ in range(rounds):
        for p in range(parts):
            held = {}
            for _, v, _ in kept:
                x = cut(v)[p]
                held.setdefault(nearest(p, x)[1], []).append(x)
            new = list(book[p])
            for e, xs in held.items():
                new[e] = [sum(col) // len(xs) for col in zip(*xs)]
            book[p] = new
    digest = hashlib.sha256(",".join(str(x) for p in book for e in p for x in e).encode()).hexdigest()
    found = []
    for i, v, lab in kept:
        best = [nearest(p, x) for p, x in enumerate(cut(v))]
        found.append((i, lab, "".join(f"{e:02x}" for _, e in best), sum(d for d, _ in best)))
    by_label = {}
    for _, lab, _, e in found:
        by_label[lab] = by_label.get(lab, 0) + e
    most = vc.MOST_LONG
    return sorted(((i, lab, c, min(e, most), min(by_label[lab], most), digest) for i, lab, c, e in found), key=repr)


def result(df, **options):
    return sorted((tuple(r) for r in vc.quantised(df, **options).collect()), key=repr)


@pytest.mark.parametrize("entries,spread", [(16, 1.0), (5, 0.2), (40, 3.0)])
def test_against_brute_force(spark, entries, spread):
    rng = np.random.default_rng(entries)
    centres = rng.normal(0, spread, (7, 12))
    v = np.round(centres[rng.integers(0, 7, 300)] + rng.normal(0, 0.3, (300, 12)), 2)
    rows = [(i * 3, [float(x) for x in r], i % 4 or None) for i, r in enumerate(v)]
    df = spark.createDataFrame(rows, "vec_id bigint, embedding array<double>, label int").repartition(5)
    options = dict(parts=4, entries=entries, rounds=6, scale=64)
    assert result(df, **options) == brute(rows, **options)


def test_odd_rows(spark):
    rows = [(4, [1.0, -2.0], 1), (4, [1.0, -2.0], 1), (1, None, 1), (2, [None, 1.0], 2), (3, [math.nan, 1.0], 2),
            (5, [math.inf, 0.0], None), (None, [0.5, 0.25], None), (6, [], 1), (7, [1.0, 2.0, 3.0, 4.0], 1), (8, [1.0], 1),
            (9, [1e30, -3.4e38], 3), (10, [1e30, -3.3e38], None), (11, [131073.0, 5e9], 2), (12, [0.0, 0.0], 2)]
    df = spark.createDataFrame(rows, "vec_id bigint, embedding array<double>, label int").withColumnsRenamed({})
    df = df.selectExpr("*", "'x' AS code", "'y' AS id", "1 AS error", "2 AS v")
    options = dict(parts=2, entries=3, rounds=3, scale=4096)
    assert result(df, **options) == brute(rows, **options)
    assert vc.quantised(df.limit(0)).count() == 0
    assert vc.quantised(df.filter("vec_id = 1")).columns == ["id", "label", "code", "error", "label_error", "codebooks_sha256"]


def test_rings_and_still_balls_skip_work():
    rng = np.random.default_rng(2)
    centres = rng.integers(-4000, 4000, (16, 8))
    v = np.repeat(centres, 200, axis=0) + rng.integers(-300, 300, (3200, 8))
    book = vc.Codebook([v[::200].astype(object)])
    codes, _, full = vc.assigned(v, None, book)
    assert full == 16 * len(v)
    for n in range(4):
        sums, radii = vc.shares(v, codes, vc.assigned(v, codes, vc.Codebook(book.entries, [[math.inf] * 16]), every=True)[1], 16)
        entries = np.array([[s // sums[i * 9] for s in sums[i * 9 + 1 : i * 9 + 9]] for i in range(16)], object)
        moved = [list(entries[i]) != list(book.entries[0][i]) for i in range(16)]
        bound = [[radii[i] + 1 + math.dist(map(int, entries[i]), map(int, book.entries[0][i])) for i in range(16)]]
        book = vc.Codebook([entries], bound, [moved])
        codes, far, visits = vc.assigned(v, codes, book)
        want, exact, _ = vc.assigned(v, None, vc.Codebook([entries]))
        assert (codes == want).all() and ((far == exact) | (far == -1)).all()
        assert visits < 0.3 * full
    assert any(book.stable[0]) and visits < len(v)


def test_ties_go_to_the_lower_index():
    v = np.array([[0, 0], [2, 0], [4, 0], [1, 0]])
    book = vc.Codebook([np.array([[2, 0], [0, 0], [2, 0]], object)], [[9.0] * 3], [[True] * 3])
    codes, far, _ = vc.assigned(v, np.array([[2], [2], [2], [1]], np.uint8), book)
    assert codes[:, 0].tolist() == [1, 0, 0, 0] and far[:, 0].tolist() == [0, 0, 4, 1]


@pytest.mark.parametrize("values", [[0], [1, -1, 2**31, -(2**31), 2**32], [2**200, -(2**200) - 7, 5]])
def test_limbs(values):
    got = vc.limbs(values)
    assert [sum(limb[i] << (32 * n) for n, limb in enumerate(got)) for i in range(len(values))] == values
    v = np.array(values, object).reshape(1, -1)
    assert vc.unpacked(vc.packed(v), len(values)).tolist() == v.tolist()
