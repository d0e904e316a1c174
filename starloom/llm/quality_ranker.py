"""Quality by pairwise ranking: scores whose differences explain which text is preferred.

A pair of labelled texts, one good and one bad, is a preference. The probability that
the good one wins is the logistic function of the difference of their scores, and a
score is linear in features of the text; so the loss is logistic in the difference of
the features. The cut between good and bad is a quantile of the learned scores: the share of
bad texts among the labels.
"""

from collections import Counter
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import functions as F
from pyspark.sql import types as T

from starloom.llm.bpe import chunks

SAMPLE_LABELS = 20_000
PAIRS = 200_000
CUT_SCORE = 0.3
BASIC = ("chars", "words", "word_length", "upper", "digits", "marks", "odd_marks", "bars", "end_marks", "other_bytes",
         "line_words", "distinct", "commonest", "same_neighbours", "repeated_lines", "short_words", "long_words", "spaces")
_CLASS = np.zeros(256, np.int64)
_CLASS[65:91] = 1
_CLASS[97:123] = 2
_CLASS[48:58] = 3
for _c in b".,;:'\"()-":
    _CLASS[_c] = 4
for _c in b"!?":
    _CLASS[_c] = 5
for _c in b"|":
    _CLASS[_c] = 6
for _c in b"#$%&*+<=>@[\\]^_`{}~/":
    _CLASS[_c] = 7
_CLASS[128:] = 8
for _c in b" \t\n\r\x0b\x0c":
    _CLASS[_c] = 9


def features(text):
    """The basic features of a whole text; zeros for NULL and empty texts."""
    data = (text or "").encode("utf-8", "replace")
    n = len(data)
    if not n:
        return [0.0] * len(BASIC)
    counts = np.bincount(_CLASS[np.frombuffer(data, np.uint8)], minlength=10)
    words = data.split()
    m = max(1, len(words))
    tally = Counter(words)
    lines = [line for line in data.split(b"\n") if line]
    sizes = np.fromiter(map(len, words), np.int64, len(words)) if words else np.zeros(1, np.int64)
    upper = counts[1] + sum(1 for c in text if c.isupper() and not c.isascii()) if counts[8] else counts[1]
    letters = max(1, counts[1] + counts[2] + counts[8])
    return [
        np.log1p(n), np.log1p(len(words)), sizes.mean(), upper / letters, counts[3] / n, counts[4] / n, counts[7] / m,
        counts[6] / m, counts[5] / m, counts[8] / n, np.log1p(m / max(1, len(lines))),
        len(tally) / m**0.75, max(tally.values(), default=0) / m,
        sum(map(bytes.__eq__, words, words[1:])) / m, 1 - len(set(lines)) / max(1, len(lines)),
        (sizes <= 3).mean(), (sizes >= 12).mean(), counts[9] / n,
    ]


@dataclass
class Ranker:
    mean: np.ndarray
    scale: np.ndarray
    weights: np.ndarray
    cut: float

    def inputs(self, basic):
        z = np.clip((np.asarray(basic, np.float64) - self.mean) / self.scale, -6, 6)
        return np.concatenate([z, z * z, np.abs(z)], axis=1)

    def raw(self, basic):
        return self.inputs(basic) @ self.weights

    def scores(self, basic):
        """From 0 to 1; CUT_SCORE at the cut."""
        shift = np.log(CUT_SCORE / (1 - CUT_SCORE))
        return 1 / (1 + np.exp(-np.clip(self.raw(basic) - self.cut + shift, -40, 40)))


def train(basic, good, pairs=PAIRS, penalty=1e-3, steps=30, seed=3, quantile=None):
    """A ranker from features and labels (1 good, 0 bad).

    With labels of one kind only, or none, there is no preference: all weights are 0
    and every text scores above the cut. `quantile` is the share of texts below the cut;
    without it, the share of bad labels.
    """
    basic, good = np.asarray(basic, np.float64).reshape(-1, len(BASIC)), np.asarray(good, bool)
    mean = basic.mean(axis=0) if len(basic) else np.zeros(len(BASIC))
    scale = np.maximum(basic.std(axis=0), 1e-6) if len(basic) else np.ones(len(BASIC))
    ranker = Ranker(mean, scale, np.zeros(3 * len(BASIC)), 0.0)
    if not good.any() or good.all():
        ranker.cut = -1.0
        return ranker
    rng = np.random.default_rng(seed)
    x = ranker.inputs(basic)
    better, worse = np.flatnonzero(good), np.flatnonzero(~good)
    a, b = rng.choice(better, pairs), rng.choice(worse, pairs)
    # Newton steps on the logistic loss of the pairs' differences, in slices of bounded size.
    w = ranker.weights
    for _ in range(steps):
        gradient, curvature = penalty * w, penalty * np.eye(len(w))
        for at in range(0, pairs, 20_000):
            d = x[a[at : at + 20_000]] - x[b[at : at + 20_000]]
            lost = 1 / (1 + np.exp(np.clip(d @ w, -40, 40)))
            gradient = gradient - d.T @ lost / pairs
            curvature = curvature + (d * (lost * (1 - lost))[:, None]).T @ d / pairs
        move = np.linalg.solve(curvature, gradient)
        w = w - move * min(1.0, 4.0 / max(1e-9, np.abs(move).max()))
        if np.abs(move).max() < 1e-4:
            break
    ranker.weights = w
    raw = np.sort(ranker.raw(basic))
    share = (~good).mean() if quantile is None else quantile
    at = min(len(raw) - 1, max(1, round(share * len(raw))))
    ranker.cut = float((raw[at - 1] + raw[at]) / 2)
    return ranker


def with_features(df, text="text", name="features"):
    """`df` with an array of the basic features of its texts."""
    rows = df.select([F.col(f"`{c}`") for c in df.columns if c != name])
    schema = T.StructType(list(rows.schema.fields)).add(name, T.ArrayType(T.DoubleType()))
    return _mapped(rows, schema, text, lambda basic: pa.array(list(map(list, basic)), pa.list_(pa.float64())))


def _mapped(rows, schema, text, column):
    place = rows.columns.index(text)

    def run(batches):
        for batch in batches:
            for part, texts in chunks(batch, place):
                basic = np.array([features(t) for t in texts], np.float64).reshape(-1, len(BASIC))
                yield pa.RecordBatch.from_arrays([*part.columns, column(basic)], names=schema.names)

    return rows.mapInArrow(run, schema)


def fit(documents, labels, key="doc_id", text="text", label="quality", most=SAMPLE_LABELS, **options):
    """A ranker from `labels` (key and label) and the documents with these keys.

    At most `most` labels are used, those whose keys have the smallest digests; NULL
    keys and labels and labels without a document are left out. A key that repeats
    counts as often as it does.
    """
    sample = (
        labels.filter(F.col(f"`{key}`").isNotNull() & F.col(f"`{label}`").isNotNull())
        .select(F.col(f"`{key}`").alias("__key"), F.col(f"`{label}`").alias("__good"))
        .orderBy(F.xxhash64("__key"), "__key", "__good").limit(most)
    )
    # The sample has at most `most` rows of two numbers.
    rows = documents.select(F.col(f"`{key}`").alias("__key"), F.col(f"`{text}`").alias("__text")).join(
        F.broadcast(sample), "__key")
    basic = with_features(rows, "__text", "__basic").select("__key", "__good", "__basic").orderBy("__key", "__good", "__basic").collect()
    return train([r["__basic"] for r in basic], [r["__good"] == 1 for r in basic], **options)


def scored(df, ranker, text="text"):
    """`df` with `score` (0 to 1) and `predicted` (1 from CUT_SCORE on, else 0)."""
    rows = df.select([F.col(f"`{c}`") for c in df.columns if c not in ("score", "predicted")])
    schema = T.StructType(list(rows.schema.fields)).add("score", "double")
    out = _mapped(rows, schema, text, lambda basic: pa.array(ranker.scores(basic), pa.float64()))
    return out.withColumn("predicted", F.when(F.col("score") >= CUT_SCORE, 1).otherwise(0))
