"""Encoding against the tokenizers library."""

import hashlib
import random
import tracemalloc

import numpy as np
import public_tokenizers
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from odd_rows import TEXTS
from starloom.llm import bpe

PATH = public_tokenizers.path("word_bpe_49k.json")
LIBRARY = Tokenizer.from_file(PATH)
ENCODER = bpe.Encoder(PATH)


def ids_of(data):
    return np.frombuffer(data, "<u4").tolist()


def same(texts):
    want = [x.ids for x in LIBRARY.encode_batch(texts, add_special_tokens=False)]
    got = [ids_of(x) for x in ENCODER.encode(texts)]
    assert got == want
    assert [ENCODER.decode(x) for x in ENCODER.encode(texts)] == [LIBRARY.decode(w, skip_special_tokens=False) for w in want]


def test_every_character():
    characters = [chr(c) for c in range(0x110000) if not 0xD800 <= c < 0xE000]
    for i in range(0, len(characters), 50_000):
        same(characters[i : i + 50_000])


def test_random_words():
    rnd = random.Random(4)
    same(["".join(rnd.choice("etaoinshrdlucmfwyp'") for _ in range(rnd.randint(1, 40))) for _ in range(20_000)])


def test_one_very_long_word():
    """Memory and time grow with the length of a word, not with its square."""
    rnd = random.Random(6)
    word = "".join(rnd.choice("acgt") for _ in range(200_000))
    tracemalloc.start()
    data = bpe.Encoder(PATH).encode([word])[0]
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert peak < 300_000_000
    names = [ENCODER.vocabulary.names[i] for i in ids_of(data)]
    assert "".join(names) == word + ENCODER.vocabulary.suffix
    assert all(ENCODER.vocabulary.compatible(a, b) for a, b in zip(ids_of(data), ids_of(data)[1:]))
    same([word[:3000]])


@settings(max_examples=300, deadline=None)
@given(st.text(alphabet=st.characters(exclude_categories=["Cs"]), max_size=80))
def test_any_text(text):
    same([text])


def test_added_tokens_in_a_text():
    same(["a<|endoftext|>b <|startoftext|>", "<|endoftext|", "<|ENDOFTEXT|>", "<|endoftext|><|endoftext|>"])


def test_small_caches_change_nothing(monkeypatch):
    monkeypatch.setattr(bpe, "CACHED_WORDS", 3)
    monkeypatch.setattr(bpe, "CACHED_PIECES", 3)
    e = bpe.Encoder(PATH)
    texts = ["the cat sat on the mat", "the dog, the cat", "a b c d e f g the"]
    assert [ids_of(x) for t in texts for x in e.encode([t])] == [x.ids for x in LIBRARY.encode_batch(texts, add_special_tokens=False)]


def test_odd_rows(odd_texts, no_texts):
    rows = bpe.encoded(odd_texts, PATH, decode=True).collect()
    assert len(rows) == len(TEXTS)
    for r in rows:
        want = LIBRARY.encode(r["text"] or "", add_special_tokens=False).ids
        assert ids_of(r["ids"]) == want and r["n_tokens"] == len(want)
        assert r["decoded"] == LIBRARY.decode(want, skip_special_tokens=False)
    assert bpe.encoded(no_texts, PATH).count() == 0
    again = bpe.decoded(bpe.encoded(odd_texts, PATH), PATH).collect()
    assert sorted(r["decoded"] for r in again) == sorted(r["decoded"] for r in rows)


def test_query(spark):
    from starloom.llm.queries import QUERIES

    folder = "/root/testdata/sf0.001"
    texts = {r["doc_id"]: r["text"] for r in spark.read.parquet(f"{folder}/documents.parquet").collect()}
    for r in QUERIES["op2_bpe_round_trip"](spark, folder).collect():
        ids = LIBRARY.encode(texts.pop(r["doc_id"]), add_special_tokens=False).ids
        assert r["n_tokens"] == len(ids) and r["ids_sha256"] == hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest()
        assert r["decoded_sha256"] == hashlib.sha256(LIBRARY.decode(ids, skip_special_tokens=False).encode()).hexdigest()
    assert not texts
