"""Collocations against plain counting, and filters that lose nothing."""

import re
from collections import Counter

import numpy as np
import pytest

from starloom.llm import collocations as co


def brute(rows, least=10, covered=50, top=2000):
    counts, total = {}, Counter()
    for lang, text in rows:
        lang = "und" if lang is None else lang
        text = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
        for piece in re.split("[.,;:!?\n-\r]", text):
            w = re.findall("[^ \t]+", piece)
            total[lang] += len(w)
            for m in (1, 2, 3):
                for i in range(len(w) - m + 1):
                    counts.setdefault(lang, Counter())[tuple(w[i : i + m])] += 1
    out = []
    for lang, f in counts.items():
        often = {p: a for p, a in f.items() if len(p) > 1 and a >= least}
        hidden = {p[k : k + 2] for p, a in often.items() if len(p) == 3 for k in (0, 1) if 100 * a >= covered * f[p[k : k + 2]]}
        scored = []
        for p, a in often.items():
            if p in hidden:
                continue
            score, k = min((1_000_000 * a * a // (f[p[:k]] * f[p[k:]]), k) for k in range(1, len(p)))
            scored.append((-score, -a, " ".join(p).encode(), f[p[:k]], f[p[k:]]))
        out += [(lang, n, p.decode(), -a, left, right, total[lang], -s)
                for n, (s, a, p, left, right) in enumerate(sorted(scored)[:top], 1)]
    return sorted(out)


def texts(n=400):
    rng = np.random.default_rng(5)
    words = ["the", "of", "New", "york", "City", "é", "ß", "你好", "a b", "in", "x" * 300]
    gaps = [" ", " ", " ", "\t", "  ", ". ", ",", "\r\n", "!"]
    rows = []
    for k in range(n):
        w = rng.choice(words, 40, p=[0.25, 0.2, 0.1, 0.1, 0.1, 0.05, 0.05, 0.05, 0.04, 0.05, 0.01])
        g = rng.choice(gaps, 40, p=[0.3, 0.2, 0.2, 0.05, 0.05, 0.05, 0.05, 0.05, 0.05])
        rows.append(([None, "en", "de", "und"][k % 4], "".join(a + b for a, b in zip(w, g)) + ("new york city " * (k % 3))))
    return rows


@pytest.mark.parametrize("top,least", [(2000, 10), (7, 3)])
def test_against_brute_force(spark, monkeypatch, top, least):
    # Small parts, so that tasks emit several filters over many ranges.
    rows = texts() + [("en", None), ("en", ""), (None, "one"), ("fr", ",,, ;\n"), ("en", "é ß " * 5000), ("en", "ab" * 40_000)]
    monkeypatch.setattr(co, "RANGE_ENTRIES", 300)
    df = spark.createDataFrame(rows, "lang string, text string").selectExpr("*", "1 AS n", "2 AS id", "'z' AS word").repartition(6)
    got = sorted(tuple(r) for r in co.collocations(df, top=top, least=least).collect())
    assert got == brute(rows, least=least, top=top) and len(got) > 20


def test_nothing_frequent(spark, no_texts, odd_texts):
    assert co.collocations(no_texts.selectExpr("*", "'en' AS lang")).count() == 0
    assert co.collocations(odd_texts.selectExpr("*", "'en' AS lang").filter("doc_id <> 6")).count() == 0


def test_another_seed_after_a_collision(spark, monkeypatch):
    real = co.word_counts
    tried = []

    def merged_ids(texts, seed):
        tried.append(seed)
        return real(texts, seed) if seed else real(texts, seed).selectExpr("1L AS id", "lang", "word", "n")

    monkeypatch.setattr(co, "word_counts", merged_ids)
    rows = [("en", "big apple " * 20)]
    got = [tuple(r) for r in co.collocations(spark.createDataFrame(rows, "lang string, text string")).collect()]
    assert sorted(got) == brute(rows) and tried == [0, 1]


@pytest.mark.parametrize("size", [2, 3])
@pytest.mark.parametrize("range_bits", [0, 3, 8, 13])
def test_filters_are_lossless(size, range_bits):
    rng = np.random.default_rng(size)
    raw = [rng.integers(0, 2**64, 5000, dtype=np.uint64) for _ in range(size)]
    assert all((x == y).all() for x, y in zip(co.restored(co.permuted(raw)), raw))
    stirred = co.permuted([x[rng.integers(0, 3000, 20_000)] for x in raw])
    limbs, counts = co.merged(stirred, rng.integers(1, 400, 20_000))
    assert counts.max() > 255
    for prefix in np.unique(limbs[0] >> np.uint64(64 - range_bits)) if range_bits else [0]:
        mine = (limbs[0] >> np.uint64(64 - range_bits)) == prefix if range_bits else np.ones(len(counts), bool)
        data = co.encoded([x[mine] for x in limbs], counts[mine], range_bits)
        back, n = co.decoded(data, int(prefix), range_bits, size)
        assert all((x == y[mine]).all() for x, y in zip(back, limbs)) and (n == counts[mine]).all()
        large = 8 * (n >= 255).sum()
        assert len(data) - large <= 8 * size * mine.sum() + mine.sum() / 8 + 5000  # quotients and small counters cost what they save


def test_equal_leading_limbs_are_told_apart():
    limbs = [np.array([7, 7, 7, 7, 3], np.uint64), np.array([2, 1, 2, 1, 9], np.uint64)]
    got, counts = co.merged(limbs, np.array([1, 10, 100, 1000, 5]))
    assert [x.tolist() for x in got] == [[3, 7, 7], [9, 1, 2]] and counts.tolist() == [5, 1010, 101]


def test_long_pieces_and_chunks(monkeypatch):
    import pyarrow as pa

    monkeypatch.setattr(co, "CHUNK_BYTES", 50)
    batch = pa.RecordBatch.from_pydict({"lang": ["a", "b", "a"], "text": ["one two. " * 30, "x" * 200 + " y", None]})
    chunks = list(co.pieces_of_batches([batch]))
    assert len(chunks) > 4 and b"".join(c[0] for c in chunks) == b"one two\n " * 30 + b"\n" + b"x" * 200 + b" y\n\n"
    assert all(c[0].endswith(b"\n") and c[1][-1] == len(c[0]) for c in chunks)


def test_cuts_are_exact_beyond_64_bits(spark):
    a, b = 4 * 10**18, 4 * 10**18 + 1
    rows = spark.createDataFrame([("x", a, a, b, b, a), ("y", a, b, b, None, None)], "phrase string, a bigint, l1 bigint, r1 bigint, l2 bigint, r2 bigint")
    got = {r["phrase"]: (r["l"], r["r"], r["score"]) for r in co.least_cuts(rows).collect()}
    assert got == {"x": (a, b, 1_000_000 * a * a // (a * b)), "y": (b, b, 1_000_000 * a * a // (b * b))}
