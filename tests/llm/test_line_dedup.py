"""Line dedup against plain Python."""

import random
import tracemalloc

import public_tokenizers
import pyarrow as pa
from hypothesis import given, settings
from hypothesis import strategies as st

from odd_rows import TEXTS
from starloom.llm import bpe, line_dedup

lines = st.lists(st.sampled_from("abcdefgh"), max_size=14)


@settings(max_examples=500, deadline=None)
@given(lines, lines)
def test_alignment_is_a_common_subsequence(a, b):
    pairs = line_dedup.aligned(a, b)
    assert all(a[i] == b[j] for i, j in pairs)
    assert all(x[0] < y[0] and x[1] < y[1] for x, y in zip(pairs, pairs[1:]))
    if a == b:
        assert len(pairs) == len(a)


@settings(max_examples=300, deadline=None)
@given(lines, lines)
def test_long_lines_never_stay_twice(a, b):
    cut = line_dedup.common_blocks(a, b, [40] * len(b), 30)
    assert cut == [j for j, x in enumerate(b) if x in a]


def test_blocks_of_short_lines():
    first = ["x", "p", "q", "r", "y"]
    assert line_dedup.common_blocks(first, ["p", "q", "r", "z", "p"], [12] * 5, 30) == [0, 1, 2]
    assert line_dedup.common_blocks(first, ["p", "q", "z", "r"], [12] * 4, 30) == []
    # A passage that stands twice goes twice; blank lines inside don't break it.
    later = ["p", "q", "r", "s", "p", "q", "r"]
    assert line_dedup.common_blocks(first, later, [12] * 7, 30) == [0, 1, 2, 4, 5, 6]
    assert line_dedup.common_blocks(["p", "", "q"], ["n", "p", "", "q"], [20, 20, 0, 20], 30) == [1, 2, 3]


def brute(rows, min_words=30):
    """Every document against the first holders of its lines."""
    def parts(t):
        return [x.strip(" ") for x in t.split("\n")]

    rank = lambda k: -1 if k is None else k
    first = {}
    for key, text in sorted(((k, t) for k, t in rows if t is not None), key=lambda r: rank(r[0])):
        for x in parts(text):
            first.setdefault(x, rank(key))
    out = []
    for key, text in rows:
        if text is None:
            out.append((key, None, 0))
            continue
        mine, gone = parts(text), set()
        words = [x.count(" ") + 1 if x else 0 for x in mine]
        for other, before in rows:
            if before is not None and rank(other) < rank(key) and rank(other) in {first[x] for x in mine if x}:
                gone |= set(line_dedup.common_blocks(parts(before), mine, words, min_words))
        out.append((key, "\n".join(x for i, x in enumerate(text.split("\n")) if i not in gone), len(gone)))
    return sorted(out, key=repr)


def corpus(seed=3):
    rnd = random.Random(seed)
    passages = [" ".join(rnd.choice("lorem ipsum dolor sit amet") + str(rnd.randint(0, 999)) for _ in range(55)) for _ in range(6)]
    rows = []
    for i in range(120):
        body = [" ".join(f"w{rnd.randint(0, 5000)}" for _ in range(rnd.randint(3, 20))) for _ in range(rnd.randint(1, 6))]
        for _ in range(rnd.randint(0, 2)):
            body.insert(rnd.randint(0, len(body)), rnd.choice(passages))
        body.insert(0, "a line that most documents share")
        rows.append((i, "\n".join(body)))
    rows += [(200 + i, rows[i][1]) for i in range(0, 120, 9)]
    return rows


def test_against_all_pairs(spark):
    rows = corpus()
    df = spark.createDataFrame(rows, "doc_id bigint, text string")
    got = line_dedup.deduplicated(df).select("doc_id", "text", "n_deleted").collect()
    assert sorted((tuple(r) for r in got), key=repr) == brute(rows)


def every_pair(rows, min_words=30):
    """Every document against all earlier ones: the lines of common blocks, and the common runs of `min_words` words."""
    out = {}
    for key, text in rows:
        mine, gone, runs = text.split("\n"), set(), []
        words = [len(x.split()) for x in mine]
        for other, before in rows:
            if other < key:
                theirs = before.split("\n")
                gone |= set(line_dedup.common_blocks(theirs, mine, words, min_words))
                runs += [range(i, j) for i in range(len(mine)) for j in range(i + 1, len(mine) + 1) if sum(words[i:j]) >= min_words
                         and any(theirs[k : k + j - i] == mine[i:j] for k in range(len(theirs)))]
        out[key] = (gone, runs)
    return out


def test_blocks_of_common_lines(spark):
    """Passages made of lines whose first holders are other documents."""
    rnd = random.Random(7)
    line = lambda n: " ".join(f"w{rnd.randint(0, 9999)}" for _ in range(n))
    shared = [line(10) for _ in range(6)]
    rows = [(i + 1, "\n".join([line(8), shared[i], line(9)])) for i in range(6)]
    rows += [(7, "\n".join([line(7), *shared])), (8, "\n".join([line(6), *shared, line(5)]))]
    common = [line(rnd.choice([1, 2, 5, 9, 14, 20])) for _ in range(27)]
    for i in range(9, 120):
        body = [line(6), line(3)]
        for part in (0, 9, 18):  # no line twice, so that blocks of two documents are in one order
            at = part + rnd.randint(0, 3)
            body += [*common[at : min(part + 9, at + rnd.randint(0, 7))], rnd.choice(["", line(4)])]
        rows.append((i, "\n".join(body)))
    df = spark.createDataFrame(rows, "doc_id bigint, text string")
    got = {r["rank"]: set(r["cut"]) for r in line_dedup.cuts(df).collect()}
    assert got[8] == {1, 2, 3, 4, 5, 6}
    for key, (gone, runs) in every_pair(rows).items():
        cut = got.get(key, set())
        assert cut <= gone
        # Of a common run, no 30 words in a row stay.
        for run in runs:
            assert cut & set(run)


def test_white_space_and_scripts(spark):
    rnd = random.Random(8)
    body = [" ".join(f"w{rnd.randint(0, 9999)}" for _ in range(10)) for _ in range(4)]
    han = "".join(chr(rnd.randint(0x4E00, 0x9000)) for _ in range(40))
    tabs, sparse = "\t".join(body[0].split() * 4), "a" + " " * 60 + "b"
    rows = [(1, "\n".join(body)), (2, "x\r\n" + "\r\n".join(body) + "\r\n"), (3, "\n".join("\t" + x + "\u00a0" for x in body)),
            (4, han), (5, "one\n" + han), (6, tabs), (7, "two\n" + tabs), (8, sparse), (9, sparse), (10, "\r\n" * 40), (11, "\r\n" * 40)]
    df = spark.createDataFrame(rows, "doc_id bigint, text string")
    got = {r["doc_id"]: (r["n_deleted"], r["text"]) for r in line_dedup.deduplicated(df).collect()}
    assert [got[i][0] for i in range(1, 12)] == [0, 4, 4, 0, 1, 0, 1, 0, 0, 0, 0]
    assert got[2][1] == "x\r\n" and got[5][1] == "one"


def test_odd_rows(odd_texts, no_texts):
    got = line_dedup.deduplicated(odd_texts)
    assert got.columns[: len(odd_texts.columns)] == odd_texts.columns
    rows = [(r["doc_id"], r["text"], r["n_deleted"]) for r in got.collect()]
    assert sorted(rows, key=repr) == sorted([(k, t, 0) for k, t in TEXTS], key=repr)
    assert line_dedup.deduplicated(no_texts).count() == 0
    again = odd_texts.unionAll(odd_texts.filter("doc_id = 6").selectExpr("9 AS doc_id", "text", "score", "n_words", "cut", "label"))
    assert line_dedup.deduplicated(again).filter("doc_id = 9").select("text", "sources").first() == ("", [6])


def test_tasks_hold_few_rows_and_no_encoder():
    """A batch of 5000 documents of 60 lines is taken in parts, and an earlier encoder's memory is freed."""
    bpe.encoder(public_tokenizers.path("word_bpe_49k.json")).encode(["some text"])
    rnd, n = random.Random(2), 5000
    columns = [pa.array(range(n), pa.int64()), pa.array(range(n), pa.int64()),
               pa.array([[rnd.getrandbits(62) for _ in range(60)] for _ in range(n)], pa.list_(pa.int64())),
               pa.array([[10] * 60] * n, pa.list_(pa.int32()))]
    batch = pa.RecordBatch.from_arrays(columns, names=["rank", "sig", "lines", "words"])
    tracemalloc.start()
    rows = sum(part.num_rows for part in line_dedup._led(30)([batch]))
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert rows == n * (60 + 58) and peak < 20e6
    assert bpe.encoder.cache_info().currsize == bpe.vocabulary.cache_info().currsize == 0
