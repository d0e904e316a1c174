"""Language of a text by a convolutional network over its bytes.

Each byte has a small vector; filters of several widths slide over a window of fixed
length, the largest answer of each filter is kept, and a softmax layer names the
language. The network is trained in numpy on a bounded sample of labelled texts, and
applied to windows that together cover every byte of every text; the windows' answers
are added up by the bytes in them.
"""

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql import types as T

from starloom.llm.bpe import chunks

WINDOW = 256
WIDTHS = (2, 3, 4)
FILTERS = 8
BYTE_DIMS = 6
SAMPLE_TEXTS = 500  # labelled texts of each language at most
SAMPLE_CUTS = 6  # windows of each
BATCH_WINDOWS = 1024
STEP = WINDOW - max(WIDTHS) + 1


@dataclass
class Net:
    languages: list
    bytes: np.ndarray  # 256 x BYTE_DIMS
    filters: np.ndarray  # (widest * BYTE_DIMS) x (widths * FILTERS), zero beyond a filter's width
    bias: np.ndarray
    out: np.ndarray
    out_bias: np.ndarray


def windows_of(data):
    """Windows of WINDOW bytes that cover `data`, padded with zeros, and the bytes each adds."""
    raw = np.frombuffer(data, np.uint8)
    n = max(1, -(-max(0, len(raw) - (WINDOW - STEP)) // STEP))
    padded = np.zeros((n - 1) * STEP + WINDOW, np.uint8)
    padded[: len(raw)] = raw
    starts = np.arange(n) * STEP
    cut = np.lib.stride_tricks.sliding_window_view(padded, WINDOW)[::STEP]
    weight = np.clip(len(raw) - starts, 1, STEP)
    weight[-1] = max(1, len(raw) - starts[-1])
    return cut, weight


def _columns(net, windows):
    """For each window and place, the vectors of the bytes that the widest filter sees."""
    widest = max(WIDTHS)
    coded = net.bytes[windows]
    padded = np.concatenate([coded, np.zeros((len(windows), widest - 1, BYTE_DIMS), np.float32)], axis=1)
    return np.concatenate([padded[:, k : k + windows.shape[1]] for k in range(widest)], axis=2)


def _forward(net, windows):
    columns = _columns(net, windows)
    answers = (columns.reshape(-1, columns.shape[2]) @ net.filters).reshape(len(windows), windows.shape[1], -1)
    return columns, answers


def log_probabilities(net, windows):
    """Log of the softmax of each window, batch by batch."""
    out = np.empty((len(windows), len(net.languages)), np.float32)
    for start in range(0, len(windows), BATCH_WINDOWS):
        part = windows[start : start + BATCH_WINDOWS]
        _, answers = _forward(net, part)
        pooled = np.maximum(answers.max(axis=1) + net.bias, 0)
        z = pooled @ net.out + net.out_bias
        z -= z.max(axis=1, keepdims=True)
        out[start : start + len(part)] = z - np.log(np.exp(z).sum(axis=1, keepdims=True))
    return out


def train(windows, targets, languages, epochs=6, batch=64, rate=0.004, seed=5):
    """A network for the windows (n x WINDOW bytes) and their language numbers."""
    rng = np.random.default_rng(seed)
    widest, total = max(WIDTHS), FILTERS * len(WIDTHS)
    mask = np.zeros((widest * BYTE_DIMS, total), np.float32)
    for i, width in enumerate(WIDTHS):
        mask[: width * BYTE_DIMS, i * FILTERS : (i + 1) * FILTERS] = 1
    net = Net(
        list(languages),
        rng.normal(0, 0.5, (256, BYTE_DIMS)).astype(np.float32),
        (rng.normal(0, 0.4, mask.shape) * mask).astype(np.float32),
        np.zeros(total, np.float32),
        rng.normal(0, 0.2, (total, len(languages))).astype(np.float32),
        np.zeros(len(languages), np.float32),
    )
    weights = [net.bytes, net.filters, net.bias, net.out, net.out_bias]
    first, second = [np.zeros_like(w) for w in weights], [np.zeros_like(w) for w in weights]
    step = 0
    for _ in range(epochs):
        order = rng.permutation(len(windows))
        for at in range(0, len(order), batch):
            mine = order[at : at + batch]
            x, n = windows[mine], len(mine)
            columns, answers = _forward(net, x)
            place = answers.argmax(axis=1)
            top = np.take_along_axis(answers, place[:, None, :], axis=1)[:, 0] + net.bias
            pooled = np.maximum(top, 0)
            z = pooled @ net.out + net.out_bias
            z -= z.max(axis=1, keepdims=True)
            p = np.exp(z)
            p /= p.sum(axis=1, keepdims=True)
            p[np.arange(n), targets[mine]] -= 1
            p /= n
            g_pooled = (p @ net.out.T) * (top > 0)
            seen = columns[np.arange(n)[:, None], place]  # n x filters x inputs
            g_filters = np.einsum("nf,nfi->if", g_pooled, seen) * mask
            g_seen = np.einsum("nf,if->nfi", g_pooled, net.filters).reshape(n, total, widest, BYTE_DIMS)
            at_byte = place[:, :, None] + np.arange(widest)
            inside = at_byte < x.shape[1]
            values = np.where(inside, np.take_along_axis(x, np.minimum(at_byte, x.shape[1] - 1).reshape(n, -1), axis=1).reshape(at_byte.shape), 0)
            g_bytes = np.zeros_like(net.bytes)
            np.add.at(g_bytes, values[inside], g_seen[inside])
            step += 1
            for w, m, v, g in zip(weights, first, second, (g_bytes, g_filters, g_pooled.sum(0), pooled.T @ p, p.sum(0))):
                m += 0.1 * (g - m)
                v += 0.001 * (g * g - v)
                w -= (rate * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.999**step)) + 1e-7)).astype(np.float32)
    return net


def fit(labelled, text="text", lang="lang", key="doc_id", most=SAMPLE_TEXTS, cuts=SAMPLE_CUTS, **options):
    """A network for the languages of `labelled`; None if no row has a language and a letter.

    Learns from `cuts` windows each of at most `most` texts of each language, those whose
    keys have the smallest digests; rows without text or language are left out.
    """
    body, length = F.col(f"`{text}`"), F.length(F.col(f"`{text}`"))
    slices = F.transform(F.sequence(F.lit(0), F.lit(cuts - 1)), lambda i: F.substring(
        body, (F.lit(1) + F.pmod(F.xxhash64(F.col(f"`{key}`"), i), F.greatest(length - WINDOW // 2, F.lit(1)))).cast("int"),
        F.lit(WINDOW)))
    order = W.partitionBy("lang").orderBy("digest", "cuts")
    rows = (
        labelled.filter(body.isNotNull() & F.col(f"`{lang}`").isNotNull() & body.rlike(r"\p{L}"))
        .select(F.col(f"`{lang}`").alias("lang"), F.xxhash64(F.col(f"`{key}`")).alias("digest"), slices.alias("cuts"))
        .withColumn("n", F.row_number().over(order)).filter(F.col("n") <= most)
        .select("lang", "cuts").orderBy("lang", "cuts").collect()
    )
    if not rows:
        return None
    languages = sorted({r["lang"] for r in rows})
    number = {name: i for i, name in enumerate(languages)}
    data = [(s.encode("utf-8", "replace")[:WINDOW].ljust(WINDOW, b"\0"), number[r["lang"]])
            for r in rows for s in r["cuts"] if s]
    windows = np.frombuffer(b"".join(d for d, _ in data), np.uint8).reshape(-1, WINDOW)
    return train(windows, np.array([t for _, t in data]), languages, **options)


def predicted(df, net, text="text"):
    """`df` with lang_pred and score (the probability of that language).

    A text that is NULL, or has no letter, is `und` with score 0; so is every text if
    there is no network. Every byte of a text counts once.
    """
    rows = df.select([F.col(f"`{c}`") for c in df.columns if c not in ("lang_pred", "score")])
    schema = T.StructType(list(rows.schema.fields)).add("lang_pred", "string").add("score", "double")
    place = rows.columns.index(text)

    def judge(texts):
        names, scores = ["und"] * len(texts), [0.0] * len(texts)
        wanted = [i for i, t in enumerate(texts) if t and any(map(str.isalpha, t))] if net else []
        cut, weights, owner, held = [], [], [], 0

        def settle():
            logs = log_probabilities(net, np.concatenate(cut)) * np.concatenate(weights)[:, None]
            ends = np.cumsum([len(c) for c in cut])
            sums = np.add.reduceat(logs, np.concatenate([[0], ends[:-1]]), axis=0)
            means = np.exp(sums / np.array([w.sum() for w in weights])[:, None])
            means /= means.sum(axis=1, keepdims=True)
            for i, best, p in zip(owner, means.argmax(axis=1), means.max(axis=1)):
                names[i], scores[i] = net.languages[best], float(min(1.0, p))

        for i in wanted:
            c, w = windows_of(texts[i].encode("utf-8", "replace"))
            cut.append(c)
            weights.append(w)
            owner.append(i)
            held += len(c)
            if held >= 4 * BATCH_WINDOWS:
                settle()
                cut, weights, owner, held = [], [], [], 0
        if owner:
            settle()
        return names, scores

    def run(batches):
        for batch in batches:
            for part, texts in chunks(batch, place):
                names, scores = judge(texts)
                yield pa.RecordBatch.from_arrays(
                    [*part.columns, pa.array(names, pa.string()), pa.array(scores, pa.float64())], names=schema.names)

    return rows.mapInArrow(run, schema)
