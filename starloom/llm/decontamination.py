"""Passages of benchmark items in documents, with word edits, by pieces and bit vectors.

An item of m words may be altered by up to `budget(m)` inserted, deleted or replaced
words. Cut into one piece more than that, at least one piece stands unaltered: pieces
are looked up exactly, and around each hit Myers' bit-parallel algorithm, with words
as symbols, finds the smallest distance of the item from any part of the text.

Words are lower-case runs of digits, ASCII letters and other characters beyond ASCII.
Documents are read once: a bit filter of fixed size, made from all pieces, lets through
the few places worth a join with the pieces.
"""

import numpy as np
import pyarrow as pa
from pyspark.sql import functions as F

from starloom.llm.bpe import chunks
from starloom.llm.word_hashes import grams, word_digests
from starloom.operators.sizing import small

WORDS_PER_EDIT = 6
FILTER_BITS = 23  # the filter has 2^23 bits: 1 MB
_WORDS = bytes(b if 48 <= b <= 57 or 97 <= b <= 122 or b >= 128 else 32 for b in range(256))


def as_words(text):
    """The words of a text, separated by single bytes of space."""
    return (text or "").lower().encode("utf-8", "replace").translate(_WORDS)


def budget(m, words_per_edit=WORDS_PER_EDIT):
    return m // words_per_edit


def pieces_of(m, edits):
    """(offset, length) of edits + 1 pieces of about equal length."""
    cuts = [m * i // (edits + 1) for i in range(edits + 2)]
    return [(a, b - a) for a, b in zip(cuts, cuts[1:])]


def nearest(pattern, text):
    """Myers: (smallest distance of the pattern from any part of the text, where that part ends)."""
    m = len(pattern)
    mask, top = (1 << m) - 1, 1 << (m - 1)
    at = {}
    for i, w in enumerate(pattern):
        at[w] = at.get(w, 0) | 1 << i
    up, down, score = mask, 0, m
    best, end = m, 0
    for j, w in enumerate(text, 1):
        eq = at.get(w, 0)
        vertical = eq | down
        horizontal = (((eq & up) + up) ^ up) | eq
        plus = down | (~(horizontal | up) & mask)
        minus = up & horizontal
        if plus & top:
            score += 1
        elif minus & top:
            score -= 1
        plus, minus = (plus << 1) & mask, (minus << 1) & mask
        up = minus | (~(vertical | plus) & mask)
        down = plus & vertical
        if score < best:
            best, end = score, j
    return best, end


def _located(pattern, text):
    """(distance, start, end) of the best part of the text; the shortest of equal ones."""
    distance, end = nearest(pattern, text)
    back, length = nearest(pattern[::-1], text[:end][::-1])
    return distance, end - (length if back == distance else end), end


def item_pieces(items, key="item_id", text="text", words_per_edit=WORDS_PER_EDIT):
    """item, sig, words, offset, length, digest: the pieces of every item.

    Items that are NULL or have no word have no pieces. Repeated items count once.
    """
    rows = items.select(F.col(f"`{key}`").cast("long").alias("item"), F.col(f"`{text}`").alias("text")).distinct()

    def run(batches):
        for batch in batches:
            out = [[] for _ in range(5)]
            for item, t in zip(*(c.to_pylist() for c in batch.columns)):
                words, _ = word_digests([as_words(t)])
                for offset, length in pieces_of(len(words), budget(len(words), words_per_edit)) if len(words) else ():
                    digest = grams(words[offset : offset + length], min(length, 64))[0]
                    for column, value in zip(out, (item, words.view(np.int64).tolist(), offset, length, int(digest.view(np.int64)))):
                        column.append(value)
            types = (pa.int64(), pa.list_(pa.int64()), pa.int32(), pa.int32(), pa.int64())
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(out, types)],
                                             names=["item", "words", "offset", "length", "digest"])

    made = rows.mapInArrow(run, "item bigint, words array<bigint>, offset int, length int, digest bigint")
    return made.withColumn("length", F.least("length", F.lit(64)))


def bit_filter(pieces):
    """The filter's bytes: one bit for each digest's first bits. Its size is fixed."""
    place = F.shiftrightunsigned("digest", 64 - FILTER_BITS) + 1  # bitmaps count from 1
    rows = (
        pieces.select(F.bitmap_bucket_number(place).alias("bucket"), F.bitmap_bit_position(place).alias("bit"))
        .groupBy("bucket").agg(F.bitmap_construct_agg("bit").alias("bits")).collect()
    )
    size = 1 << (FILTER_BITS - 3)
    bits = np.zeros(size, np.uint8)
    for r in rows:
        part = np.frombuffer(r["bits"], np.uint8)
        start = (r["bucket"] - 1) * len(part)
        bits[start : start + len(part)] = part[: size - start]
    return bits


def passages(documents, items, key="doc_id", text="text", item_key="item_id", item_text="text",
             words_per_edit=WORDS_PER_EDIT):
    """One row per document and item found in it: key, item_id, distance, n_words, start, end.

    `distance` counts word edits and is at most the item's budget; start and end count
    the document's words, of the best place (the first of equal ones). NULL and empty
    texts hold nothing; documents with the same key give one row per item.
    """
    pieces = item_pieces(items, item_key, item_text, words_per_edit).persist()
    bits = bit_filter(pieces)
    shape = pieces.agg(F.sort_array(F.collect_set("length")).alias("sizes"), F.max(F.size("words")).alias("most")).first()
    sizes, most = shape["sizes"], shape["most"] or 0
    reach = most + budget(most, words_per_edit)
    rows = documents.select(F.col(f"`{key}`").cast("long").alias("doc"), F.col(f"`{text}`").alias("text"))
    names = ["doc", "at", "length", "digest", "before", "around"]

    def hits(batches):
        for batch in batches:
            for part, texts in chunks(batch, "text", 500_000):
                keys = part.column("doc").to_pylist()
                words, ends = word_digests([as_words(t) for t in texts])
                begins = np.concatenate([[0], ends[:-1]])
                out = [[] for _ in names]
                for size in sizes:
                    digest = grams(words, size)
                    place = digest >> np.uint64(64 - FILTER_BITS)
                    passed = np.flatnonzero((bits[place >> np.uint64(3)] >> (place & np.uint64(7)).astype(np.uint8)) & 1)
                    owner = np.searchsorted(ends, passed, "right")
                    for at, who in zip(passed.tolist(), owner.tolist()):
                        if at + size > ends[who]:
                            continue
                        low, high = max(int(begins[who]), at - reach), min(int(ends[who]), at + reach)
                        row = (keys[who], at - int(begins[who]), size, int(digest[at].view(np.int64)), at - low,
                               words[low:high].view(np.int64))
                        for column, value in zip(out, row):
                            column.append(value)
                        if len(out[0]) >= 2000:
                            yield _hit_batch(out, names)
                            out = [[] for _ in names]
                yield _hit_batch(out, names)

    found = rows.mapInArrow(hits, "doc bigint, at bigint, length int, digest bigint, before int, around array<bigint>")
    near = found.join(small(pieces), ["digest", "length"]).select("doc", "item", "at", "offset", "before", "around", "words")

    def verify(batches):
        for batch in batches:
            out = [[] for _ in range(6)]
            for doc, item, at, offset, before, around, words in zip(*(c.to_pylist() for c in batch.columns)):
                m = len(words)
                edits = budget(m, words_per_edit)
                low = max(0, before - offset - edits)
                window = around[low : before - offset + m + edits]
                distance, start, end = _located(words, window)
                if distance <= edits:
                    base = at - before + low
                    for column, value in zip(out, (doc, item, distance, m, base + start, base + end)):
                        column.append(value)
            types = (pa.int64(), pa.int64(), pa.int32(), pa.int32(), pa.int64(), pa.int64())
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(out, types)],
                                             names=["doc", "item", "distance", "n_words", "start", "end"])

    sure = near.mapInArrow(verify, "doc bigint, item bigint, distance int, n_words int, start bigint, end bigint")
    best = sure.groupBy("doc", "item").agg(F.min(F.struct("distance", "start", "end", "n_words")).alias("b"))
    return best.select(F.col("doc").alias(key), F.col("item").alias("item_id"), "b.distance", "b.n_words", "b.start", "b.end")


def _hit_batch(columns, names):
    types = (pa.int64(), pa.int64(), pa.int32(), pa.int64(), pa.int32(), pa.list_(pa.int64()))
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types)], names=names)


def clean(documents, items, key="doc_id", **options):
    """The documents that hold no item; documents without a key stay."""
    found = passages(documents, items, key, **options).select(F.col(key).alias("__held")).distinct()
    return documents.join(found, F.col(f"`{key}`").cast("long") == F.col("__held"), "left_anti")
