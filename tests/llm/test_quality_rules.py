"""Quality rules against plain Python, and the two multinomials against plain counts."""

import math
import re
from collections import Counter

import numpy as np
import pytest
import xxhash
from odd_rows import TEXTS

from starloom.llm import quality_rules as q

WORD = re.compile("[^ \t-\r]+")


def grams(words):
    for i, w in enumerate(words):
        digest = xxhash.xxh64_intdigest(w.encode(), seed=42)
        yield digest
        if i + 1 < len(words):
            # Spark hashes a further column with the digest so far as seed.
            yield xxhash.xxh64_intdigest(words[i + 1].encode(), seed=digest)


def brute_ratios(raw, target, bits, smoothing):
    buckets = 1 << bits
    counts = [Counter(d >> (64 - bits) for t in texts for d in grams(WORD.findall(t or ""))) for texts in (raw, target)]
    r, t = ([c[b] + smoothing for b in range(buckets)] for c in counts)
    return [1_000_000 * (math.log(a / sum(t)) - math.log(b / sum(r))) for a, b in zip(t, r)]


def brute(text, ratios, threshold):
    text = text or ""
    words = WORD.findall(text)
    lines = [x for x in text.split("\n") if WORD.search(x)]
    windows = Counter(tuple(words[i : i + 3]) for i in range(len(words) - 2))
    repeated = {i + k for i in range(len(words) - 2) if windows[tuple(words[i : i + 3])] > 1 for k in range(3)}
    bits = len(ratios).bit_length() - 1
    total = sum(ratios[d >> (64 - bits)] for d in grams(words))
    n = max(1, 2 * len(words) - 1)
    failed = len(words) < 50 or 100 * len(repeated) > 50 * len(words)
    return (len(words), sum(map(len, words)), sum(text.count(c) for c in "#*$%&|<>"), len(lines) - len(set(lines)),
            len(repeated), total / n / 1_000_000, failed, not failed and total >= round(threshold * 1_000_000) * n)


def texts():
    rng = np.random.default_rng(4)
    words = np.array(["the", "of", "a#", "<b>", "ß", "你好", "\U0001F600", "x|y", "quite", "long", "ago", "and", "so"])
    return [" ".join(rng.choice(words, n)) + end for n in (1, 2, 3, 4, 60, 61, 300) for end in ("", "\n", "\r\n \x85 \x1c", " \f\v ")] + [
        "a b c a b c", "a a a a", "a a a", "one\none \none\n\n \none", "one two three four " * 20, "\n\n \t", "w " * 49, "w1 " * 25 + "w2 " * 25,
        " ".join(f"w{i}" for i in range(50)), " ".join(f"w{i}" for i in range(49)), " ".join(f"w{i % 60}" for i in range(80)), None, ""]


@pytest.mark.parametrize("threshold", [-0.35, 0.0])
def test_against_python(spark, threshold):
    rows = list(enumerate(texts() + [t for _, t in TEXTS]))
    df = spark.createDataFrame(rows, "doc_id int, text string")
    target = df.filter("doc_id % 3 = 0")
    ratios = q.fit(df, target, bits=6)
    numbers = [int(x) for x in ratios.split(",")]
    want = brute_ratios([t for _, t in rows], [t for i, t in rows if i % 3 == 0], 6, q.SMOOTHING)
    assert len(numbers) == 64 and max(abs(a - b) for a, b in zip(numbers, want)) <= 0.51
    got = {r["doc_id"]: tuple(r)[1:] for r in q.judged(df, ratios, threshold=threshold).select("doc_id", *q.RESULT).collect()}
    for i, t in rows:
        assert got[i] == pytest.approx(brute(t, numbers, threshold), abs=1e-12), (i, t)


def test_odd_rows_and_names(spark, odd_texts, no_texts):
    ratios = q.fit(odd_texts, no_texts, bits=3)
    rows = q.judged(odd_texts.withColumn("words", odd_texts["label"]), ratios, keep=("doc_id", "words", "cut"))
    assert rows.count() == odd_texts.count() and rows.columns == ["doc_id", "words", "cut", *q.RESULT]
    assert rows.filter("words = 'l' AND cut = 'c'").count() == odd_texts.count()
    assert rows.filter("doc_id = 2").select("n_words", "score", "base_failed", "kept").first() == (0, 0.0, True, False)
    assert q.judged(no_texts, q.fit(no_texts, no_texts, bits=3)).count() == 0


def test_no_python_runs(odd_texts):
    plan = q.judged(odd_texts, q.fit(odd_texts, odd_texts, bits=3))._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan
    plan = q.log_ratios(odd_texts, odd_texts)._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan


def test_unlike_texts_fall_below(spark):
    good = [" ".join(f"w{(i * k) % 50}" for i in range(60)) for k in range(1, 40)]
    bad = [" ".join(f"junk{(i * k) % 50}" for i in range(60)) for k in range(1, 8)]
    df = spark.createDataFrame(list(enumerate(good + bad)), "doc_id int, text string")
    ratios = q.fit(df, df.filter(f"doc_id < {len(good)}"))
    kept = {r["doc_id"] for r in q.judged(df, ratios).filter("n_repeat_words < 30 AND kept").collect()}
    assert kept and kept <= set(range(len(good)))
