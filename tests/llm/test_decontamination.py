"""Benchmark passages against plain edit distance."""

import random

import numpy as np
from hypothesis import given, settings
from hypothesis import strategies as st

from odd_rows import LONG
from starloom.llm import decontamination


def distance(pattern, text):
    """The smallest edit distance of the pattern from any part of the text."""
    row = [0] * (len(text) + 1)
    for i, p in enumerate(pattern, 1):
        new = [i]
        for j, t in enumerate(text, 1):
            new.append(min(row[j - 1] + (p != t), row[j] + 1, new[-1] + 1))
        row = new
    return min(row)


@settings(max_examples=400, deadline=None)
@given(st.lists(st.integers(0, 4), min_size=1, max_size=90), st.lists(st.integers(0, 4), max_size=120))
def test_myers(pattern, text):
    best, end = decontamination.nearest(pattern, text)
    assert best == distance(pattern, text)
    d, start, stop = decontamination._located(pattern, text)
    assert d == best and 0 <= start <= stop == end


@given(st.integers(0, 500))
def test_pieces(m):
    edits = decontamination.budget(m)
    pieces = decontamination.pieces_of(m, edits)
    assert len(pieces) == edits + 1 and sum(n for _, n in pieces) == m and (m == 0 or min(n for _, n in pieces) > 0)


def corpus():
    rnd = random.Random(6)
    word = lambda: "".join(rnd.choice("abcdefg") for _ in range(3))
    items = [(i, " ".join(word() for _ in range(n))) for i, n in enumerate([3, 5, 6, 12, 25, 40, 60, 200])]
    items += [(20, None), (21, ""), (22, "?!"), (0, items[0][1]), (30, items[5][1]), (31, items[4][1] + ". Extra")]
    docs = []
    for i in range(250):
        text = [word() for _ in range(rnd.randint(0, 60))]
        for _ in range(rnd.randint(0, 2)):
            _, t = rnd.choice(items[:8])
            inner = t.split()
            for _ in range(rnd.randint(0, max(1, len(inner) // 4))):
                at = rnd.randrange(len(inner))
                inner[at : at + 1] = rnd.choice([[], [word()], [word(), inner[at]]])
                inner = inner or ["x"]
            at = rnd.randint(0, len(text))
            text[at:at] = inner
        docs.append((i, " ".join(text).upper() if i % 3 else ", ".join(text)))
    return items, docs + [(900, None), (901, ""), (902, LONG), (None, items[5][1]), (5, docs[5][1])]


def test_against_edit_distance(spark):
    items, docs = corpus()
    i = spark.createDataFrame(items, "item_id bigint, text string")
    d = spark.createDataFrame([(k, t, "x", "y") for k, t in docs], "doc_id bigint, text string, start string, item string")
    got = {(r["doc_id"], r["item_id"]): r["distance"] for r in decontamination.passages(d, i).collect()}
    words = lambda t: decontamination.as_words(t).split()
    want = {}
    for key, text in docs:
        for item, t in items:
            m = len(words(t))
            if m and text and text != LONG:
                best = distance(words(t), words(text))
                if best <= m // decontamination.WORDS_PER_EDIT:
                    want[key, item] = min(best, want.get((key, item), best))
    assert got == want
    kept = [r["doc_id"] for r in decontamination.clean(d, i).collect()]
    held = {k for k, _ in want if k is not None}
    assert sorted(kept, key=repr) == sorted([k for k, _ in docs if k not in held], key=repr)


def test_place(spark):
    items = spark.createDataFrame([(1, "one two three four five six seven eight nine ten eleven twelve")], "item_id bigint, text string")
    docs = spark.createDataFrame([(1, "a b c One two, THREE four five six seven 8 nine ten eleven twelve d e")], "doc_id bigint, text string")
    assert decontamination.passages(docs, items).collect() == [(1, 1, 1, 12, 3, 15)]


def test_empty_tables(spark, no_texts):
    items = spark.createDataFrame([], "item_id bigint, text string")
    docs = spark.createDataFrame([(1, "some text")], "doc_id bigint, text string")
    assert decontamination.passages(docs, items).count() == 0 and decontamination.clean(docs, items).count() == 1
    full = spark.createDataFrame([(1, "some text")], "item_id bigint, text string")
    assert decontamination.passages(no_texts, full).count() == 0


def test_grams_depend_on_order_and_size():
    words, _ = decontamination.word_digests([b"a b c", b"b a c"])
    assert len(np.unique(words)) == 3
    assert len({*decontamination.grams(words, 2).tolist()}) == 5
