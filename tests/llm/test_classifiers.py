"""Quality and language: held-out accuracy, gradients and odd rows."""

import numpy as np
import pytest

from starloom.llm import language_net, quality_ranker
from starloom.llm.queries import QUERIES, held_out

FOLDER = "/root/testdata/sf0.01"


def test_held_out_quality(spark):
    got = QUERIES["op1_quality_ranker"](spark, FOLDER)
    assert got.count() == spark.read.parquet(f"{FOLDER}/documents.parquet").count()
    rows = got.filter("held_out").join(spark.read.parquet(f"{FOLDER}/labels.parquet"), "doc_id").collect()
    right = np.mean([r["predicted"] == r["quality"] for r in rows])
    assert len(rows) > 50 and right >= 0.95
    assert all(0 <= r["score"] <= 1 and r["predicted"] == (r["score"] >= 0.3) for r in rows)


def test_held_out_language(spark):
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet").select("doc_id", "lang")
    rows = QUERIES["op9_language_net"](spark, FOLDER).filter("held_out").join(docs.filter("lang IS NOT NULL"), "doc_id").collect()
    assert len(rows) > 100 and np.mean([r["lang"] == r["lang_pred"] for r in rows]) >= 0.95
    assert all(0 <= r["score"] <= 1 for r in rows)


def test_held_out_rows_change_nothing(spark):
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet").select("doc_id", "text", "lang")
    nets = [language_net.fit(d.filter(~held_out()), epochs=1, most=20) for d in (docs, docs.filter(~held_out()))]
    assert np.array_equal(nets[0].filters, nets[1].filters) and nets[0].languages == nets[1].languages


def test_preferences_order_scores():
    rng = np.random.default_rng(0)
    basic = rng.normal(0, 1, (400, len(quality_ranker.BASIC)))
    good = basic[:, 3] - 0.5 * basic[:, 7] > -0.4
    ranker = quality_ranker.train(basic, good, pairs=20_000)
    scores = ranker.scores(basic)
    assert ((scores >= quality_ranker.CUT_SCORE) == good).mean() > 0.97
    half = quality_ranker.train(basic, good, pairs=20_000, quantile=0.5).scores(basic)
    assert (half < quality_ranker.CUT_SCORE).sum() == 200


@pytest.mark.parametrize("labels", [[], [(1, 1)], [(1, 0)], [(None, 1), (1, None)], [(99, 1), (98, 0)]])
def test_labels_without_a_preference(spark, odd_texts, labels):
    ranker = quality_ranker.fit(odd_texts, spark.createDataFrame(labels, "doc_id bigint, quality int"))
    rows = quality_ranker.scored(odd_texts, ranker).collect()
    assert len(rows) == odd_texts.count() and all(r["predicted"] == 1 for r in rows)


def test_odd_rows(spark, odd_texts, no_texts):
    labels = spark.createDataFrame([(1, 1), (5, 0), (3, 0), (2, 0), (6, 1), (1, 1)], "doc_id bigint, quality int")
    ranker = quality_ranker.fit(odd_texts, labels)
    rows = quality_ranker.scored(odd_texts, ranker).collect()
    assert len(rows) == odd_texts.count() and all(0 <= r["score"] <= 1 for r in rows)
    assert quality_ranker.scored(no_texts, ranker).count() == 0


def test_windows_cover_every_byte():
    for n in [0, 1, 255, 256, 257, 509, 510, 5000]:
        data = bytes(i % 251 + 1 for i in range(n))
        windows, weights = language_net.windows_of(data)
        assert weights.sum() == max(1, n) and windows.shape[1] == language_net.WINDOW
        joined = windows[0].tobytes() + b"".join(w[language_net.WINDOW - language_net.STEP:].tobytes() for w in windows[1:])
        assert joined.rstrip(b"\0") == data


def test_languages_of_odd_rows(spark, odd_texts, no_texts):
    rows = [(i, t, lang) for i, (t, lang) in enumerate([("the cat and the dog", "en"), ("der hund und die katze", "de"),
                                                         (None, "en"), ("1234", "de"), ("le chien", None)] * 6)]
    net = language_net.fit(spark.createDataFrame(rows, "doc_id bigint, text string, lang string"), epochs=30, batch=4)
    assert net.languages == ["de", "en"]
    got = language_net.predicted(odd_texts.withColumn("lang_pred", odd_texts["label"]), net).collect()
    assert len(got) == odd_texts.count()
    for r in got:
        letters = any(c.isalpha() for c in r["text"] or "")
        assert (r["lang_pred"] in net.languages and 0 < r["score"] <= 1) if letters else (r["lang_pred"], r["score"]) == ("und", 0.0)
    assert language_net.fit(no_texts.selectExpr("*", "'x' AS lang")) is None
    assert {r["lang_pred"] for r in language_net.predicted(odd_texts, None).collect()} == {"und"}
    assert language_net.predicted(no_texts, net).count() == 0


def test_ranker_is_where_the_loss_is_least():
    """Numeric gradient of the pairwise logistic loss, over the same pairs."""
    rng = np.random.default_rng(6)
    basic = rng.normal(0, 1, (200, len(quality_ranker.BASIC)))
    good = basic[:, 0] + rng.normal(0, 1, 200) > -0.3  # overlapping, so that the optimum is finite
    pairs, penalty = 3000, 1e-3
    ranker = quality_ranker.train(basic, good, pairs=pairs, penalty=penalty, seed=3)
    again = np.random.default_rng(3)
    a, b = again.choice(np.flatnonzero(good), pairs), again.choice(np.flatnonzero(~good), pairs)
    x = ranker.inputs(basic)

    def loss(w):
        return np.mean([np.logaddexp(0, -((x[i] - x[j]) @ w)) for i, j in zip(a, b)]) + penalty / 2 * w @ w

    w, step = ranker.weights, 1e-4
    at = loss(w)
    for k in range(len(w)):
        move = np.zeros(len(w))
        move[k] = step
        up, down = loss(w + move), loss(w - move)
        assert abs(up - down) / (2 * step) < 1e-3 and min(up, down) > at - 1e-9


def plain_forward(net, window):
    """The network's answer for one window, by plain loops."""
    coded = [net.bytes[b].astype(float) for b in window] + [np.zeros(language_net.BYTE_DIMS)] * (max(language_net.WIDTHS) - 1)
    pooled = []
    for f in range(net.filters.shape[1]):
        width = language_net.WIDTHS[f // language_net.FILTERS]
        weights = net.filters[: width * language_net.BYTE_DIMS, f].astype(float)
        assert not net.filters[width * language_net.BYTE_DIMS :, f].any()
        best = max(float(np.concatenate(coded[i : i + width]) @ weights) for i in range(len(window)))
        pooled.append(max(0.0, best + float(net.bias[f])))
    z = [sum(p * float(net.out[f, c]) for f, p in enumerate(pooled)) + float(net.out_bias[c]) for c in range(len(net.languages))]
    return np.array(z) - np.log(sum(np.exp(v - max(z)) for v in z)) - max(z)


def test_network_against_plain_loops_and_numeric_gradients():
    rng = np.random.default_rng(7)
    windows = rng.integers(97, 110, (12, language_net.WINDOW)).astype(np.uint8)
    windows[6:] += 5
    targets = np.arange(12) % 3
    options = dict(languages=["a", "b", "c"], batch=12, seed=4)
    net, moved = (language_net.train(windows, targets, epochs=n, **options) for n in (0, 1))
    got = language_net.log_probabilities(net, windows)
    assert np.allclose(got, [plain_forward(net, w) for w in windows], atol=1e-4)

    def loss():
        return -np.mean([plain_forward(net, w)[t] for w, t in zip(windows, targets)])

    # The first step of the optimiser goes against the sign of each gradient.
    for name in ("out", "out_bias", "bias"):
        weights, after = getattr(net, name), getattr(moved, name)
        for at in list(np.ndindex(weights.shape))[:12]:
            kept, step = weights[at], 1e-2
            weights[at] = kept + step
            up = loss()
            weights[at] = kept - step
            down = loss()
            weights[at] = kept
            slope = (up - down) / (2 * step)
            if abs(slope) > 1e-3:
                assert np.sign(after[at] - kept) == -np.sign(slope)
