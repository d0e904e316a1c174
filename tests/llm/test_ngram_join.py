"""Near duplicates against brute force."""

import random
import re
from itertools import combinations

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from starloom.llm import ngram_join
from starloom.llm.components import components


def shingles(text):
    words = [w for w in re.split(rb"[\x20\x09-\x0D]+", (text or "").encode().lower()) if w]
    return {tuple(words[i : i + 5]) for i in range(len(words) - 4)} if len(words) >= 5 else {tuple(words)} if words else set()


def brute(rows):
    sets = [shingles(t) for _, t in rows]
    root = list(range(len(rows)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for i, j in combinations(range(len(rows)), 2):
        if sets[i] and sets[j] and 100 * len(sets[i] & sets[j]) >= 75 * len(sets[i] | sets[j]):
            root[find(j)] = find(i)
    out = []
    for i, (key, _) in enumerate(rows):
        keys = [rows[j][0] for j in range(len(rows)) if find(j) == find(i) and rows[j][0] is not None]
        out.append((key, len(sets[i]), min(keys, default=None) if sets[i] else key))
    return sorted(out, key=repr)


def corpus(seed=5):
    rnd = random.Random(seed)
    word = lambda: rnd.choice("abcdefghij") + rnd.choice("klmnop") + str(rnd.randint(0, 60))
    common = " ".join(word() for _ in range(30))
    rows = []
    for base in range(60):
        text = [word() for _ in range(rnd.choice([1, 3, 5, 6, 8, 9, 10, 12, 16, 17, 20, 40, 90]))]
        for _ in range(rnd.randint(1, 6)):
            near = list(text)
            for _ in range(rnd.randint(0, 3)):
                at = rnd.randrange(len(near)) if near else 0
                near[at : at + 1] = rnd.choice([[], [word()], [*near[at : at + 1], word()]])
            rows.append(" ".join(near) + (" " + common if rnd.random() < 0.4 else ""))
    # One long chain, and one large group of near copies of different texts.
    chain = [word() for _ in range(60)]
    for i in range(25):
        chain[(7 * i) % 60] = word()
        rows.append(" ".join(chain))
    core = [word() for _ in range(120)]
    for i in range(90):
        copy = list(core)
        copy[i] = word()
        rows.append(" ".join(copy))
    rows += rows[::17]
    rnd.shuffle(rows)
    return list(enumerate(rows))


@pytest.mark.parametrize("frequent", [16, 1000, 0])
def test_against_all_pairs(spark, monkeypatch, frequent):
    monkeypatch.setattr(ngram_join, "FREQUENT", frequent)
    rows = corpus()
    df = spark.createDataFrame(rows, "doc_id bigint, text string")
    got = ngram_join.near_duplicates(df).select("doc_id", "n_shingles", "component_id").collect()
    assert sorted((tuple(r) for r in got), key=repr) == brute(rows)
    kept = {r["doc_id"] for r in ngram_join.one_of_each(df).collect()}
    assert kept == {k for k, n, c in brute(rows) if n == 0 or k == c}


@pytest.mark.parametrize("light", [0, 3, 12])
def test_any_boundary_gives_the_same(spark, monkeypatch, light):
    monkeypatch.setattr(ngram_join, "boundary", lambda counts, percent: light)
    rows = [(i, t) for i, t in corpus(9) if len(t.split()) < 25][:150]
    df = spark.createDataFrame(rows, "doc_id bigint, text string")
    got = ngram_join.near_duplicates(df).select("doc_id", "n_shingles", "component_id").collect()
    assert sorted((tuple(r) for r in got), key=repr) == brute(rows)


def test_odd_rows(odd_texts, no_texts):
    got = ngram_join.near_duplicates(odd_texts).select("doc_id", "n_shingles", "component_id").collect()
    assert sorted((tuple(r) for r in got), key=repr) == brute([(r["doc_id"], r["text"]) for r in odd_texts.collect()])
    assert ngram_join.one_of_each(odd_texts).count() == odd_texts.count()
    assert ngram_join.near_duplicates(no_texts).count() == 0


def test_copies_without_a_key(spark):
    """A row without a key stands for a set; the smallest key of its copies still counts."""
    text = [f"word{i}" for i in range(60)]
    other = " ".join([*text[:40], "changed", *text[41:]])
    rows = [(None, "a copy of one short text stands here"), (5, "a copy of one short text stands here"),
            (9, "a copy of one short text stands here"), (None, " ".join(text)), (3, " ".join(text)), (4, " ".join(text)),
            (7, other), (None, "alone without a key and without a copy")]
    df = spark.createDataFrame(rows, "doc_id bigint, text string")
    got = ngram_join.near_duplicates(df).select("doc_id", "n_shingles", "component_id").collect()
    assert sorted((tuple(r) for r in got), key=repr) == brute(rows)
    assert {r["doc_id"] for r in ngram_join.one_of_each(df).collect()} == {3, 5, None}


@given(st.integers(1, 400), st.integers(1, 400))
@settings(max_examples=300)
def test_sizes(a, b):
    """What two sets of these sizes must share agrees with the definition."""
    o = ngram_join.overlap_of(a, b)
    assert 100 * o >= 75 * (a + b - o) and 100 * (o - 1) < 75 * (a + b - o + 1)
    possible = o <= min(a, b)
    assert possible == (b in ngram_join.sizes_near(a) and o <= min(a, b))
    assert not possible or o >= a - ngram_join.front(a) + 1


def test_words_are_told_apart_by_bytes():
    sets = ngram_join.shingle_sets(["A b\tc\nd\x0be f", "a B c d e f", "a b c d e f", "a\x1cb c d e f", None, " "])
    assert np.array_equal(sets[0], sets[1]) and len(sets[0]) == 2
    assert len(sets[2]) == len(sets[3]) == 1 and not len(sets[4]) and not len(sets[5])


def test_components(spark):
    rnd = random.Random(2)
    links = [(i, i + 1) for i in range(100, 180)] + [(rnd.randint(200, 400), rnd.randint(200, 400)) for _ in range(120)] + [(5, 5), (900, 901), (900, 901)]
    root = {n: n for pair in links for n in pair if pair[0] != pair[1]}
    changed = True
    while changed:
        changed = False
        for a, b in links:
            if a != b and root[a] != root[b]:
                root[a] = root[b] = min(root[a], root[b])
                changed = True
    got = components(spark.createDataFrame(links, "a bigint, b bigint"))
    assert {tuple(r) for r in got.collect()} == set(root.items())


@given(st.integers(1, 4000), st.integers(0, 300), st.integers(0, 300))
@settings(deadline=None, max_examples=200)
def test_fewest_lists_bounds_all_sizes(n, below, above):
    """The same formulas in plain Python: no size between the ends needs fewer lists."""
    low, high = max(-(-75 * n // 100), n - below), min(100 * n // 75, n + above)
    needed = lambda m: max(-(-75 * (n + m) // 175) + 1 - max(-(-75 * n // 100), -(-75 * m // 100)), 1)
    at = lambda m: (3 * (n + m) * 4 - 3 * max(n, m) * 7) // 28 + 1
    assert max(min(at(low), at(high)), 1) <= min(needed(m) for m in range(low, high + 1))


def test_sets_of_a_group_meet_in_few_lists(spark):
    """40 sets that share 17 lists with each of 200 linked ones, which is as many as alike ones need."""
    group = [(shingle, sig, 146, 141) for sig in range(200) for shingle in range(17 + sig % 10)]
    others = [(shingle, sig, 146, 126) for sig in range(1000, 1040) for shingle in range(17)]
    lists = spark.createDataFrame(group + others, "shingle bigint, sig bigint, n int, most int").selectExpr("shingle", "sig", "n", "most")
    roots = spark.createDataFrame([(sig, 0) for sig in range(200)], "node bigint, root bigint")
    expected = {(other, sig) for other in range(1000, 1040) for sig in range(200)} | set(
        (b, a) for a, b in combinations(range(1000, 1040), 2))
    assert ngram_join.meetings(lists, roots, 6, 75).count() <= len(expected)
    found = [(r["a"], r["b"]) for r in ngram_join.unjoined_pairs(lists, roots, 6, 75).collect()]
    assert len(found) == len(set(found)) and set(found) == expected
