"""Id planes: exact round trips, and starts and digests against the library."""

import zlib

import numpy as np
import public_tokenizers
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from starloom.llm import token_planes
from starloom.session import staging_path

PATH = public_tokenizers.path("word_bpe_49k.json")


@settings(max_examples=200, deadline=None)
@given(st.lists(st.integers(0, 2**32 - 1), max_size=300), st.integers(1, 70), st.sampled_from(["bit", "byte"]))
def test_round_trip(ids, block, unit):
    data = token_planes.pack(np.array(ids, "<u4"), block, unit)
    assert token_planes.unpack(data).tolist() == ids
    if ids:
        assert token_planes.unpack(data, [0]).tolist() == ids[:block]


def test_not_a_chunk():
    with pytest.raises(ValueError):
        token_planes.unpack(b"\0" * 40)


def expected(rows, end_id):
    library, start, out = Tokenizer.from_file(PATH), 0, []
    for key, text in sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0, r[1] is not None, r[1] or "")):
        ids = np.array([*library.encode(text or "", add_special_tokens=False).ids, end_id], "<u4").tobytes()
        out.append((key, start, len(ids) // 4, zlib.crc32(ids)))
        start += len(ids) // 4
    return out


@pytest.mark.parametrize("chunk_ids", [50, 1_000_000])
def test_odd_rows(spark, odd_texts, chunk_ids):
    path = staging_path(spark, "planes-test")
    token_planes.written(odd_texts, path, PATH, end_id=2, chunk_ids=chunk_ids, block_ids=64)
    got = token_planes.digests(spark, path).orderBy("start").collect()
    assert [tuple(r) for r in got] == expected([(r["doc_id"], r["text"]) for r in odd_texts.collect()], 2)
    read = {r["start"]: r["ids"] for r in token_planes.read(spark, path).collect()}
    assert {r["start"]: zlib.crc32(read[r["start"]]) for r in got} == {r["start"]: r["ids_crc32"] for r in got}


def test_no_rows(spark, no_texts):
    path = staging_path(spark, "planes-test")
    token_planes.written(no_texts, path, PATH, end_id=2)
    assert token_planes.digests(spark, path).count() == 0


def test_query(spark):
    from starloom.llm.queries import QUERIES

    folder = "/root/testdata/sf0.001"
    rows = [tuple(r) for r in spark.read.parquet(f"{folder}/documents.parquet").select("doc_id", "text").collect()]
    got = QUERIES["op3_token_planes"](spark, folder).select("doc_id", "start", "n_tokens", "ids_crc32").orderBy("start").collect()
    assert [tuple(r) for r in got] == expected(rows, 2)
