"""Phrases whose words stand together more often than apart, counted in quotient filters.

A word's id is a 64-bit digest of its language and its bytes; a pass over all distinct
words proves that no two share an id, or else all is counted with another seed. The ids
of an n-gram, packed side by side, are permuted invertibly. The leading bits of the
result name a range of filters and, within it, a quotient, which a run of unary bits
stores; the remainder is kept in full, so that nothing is lost and every n-gram can be
read back. Each task fills one filter; filters of the same range, all in the order of the
permuted n-grams, are merged by adding up the counters of equal entries.

A phrase of three is counted only if its two pairs may be frequent, and a pair only if
its words may be. That is asked of a bit filter, which errs on the side of counting only.
"""

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from starloom.llm.word_hashes import mixed
from starloom.operators.sizing import small
from starloom.session import staged

LEAST = 10
COVERED = 50  # percent
TOP = 2000
SCALE = 1_000_000

CHUNK_BYTES = 1 << 21
SHARD_ENTRIES = 1 << 20  # a task's filter is emitted when it has so many entries
RANGE_ENTRIES = 1 << 18  # words per range of filters
MOST_BITS = 28  # the bit filters have at most 2^28 bits: 32 MB; fuller ones only let more be counted
SALTS = 32

# What ends a piece, and the white space between words.
BREAKS = b".,;:!?\x0a\x0b\x0c\x0d"
SPACES = b"\x20\x09"
_BREAK = 0x0A
_SAME = bytes(
    _BREAK if b in BREAKS else 0x20 if b in SPACES else b + 32 if 65 <= b <= 90 else b for b in range(256))
_BASE = np.uint64(0x9E3779B97F4A7C15)


class Hasher:
    """Digests of words; another seed gives other digests."""

    def __init__(self, seed):
        self.seed = seed
        self.bytes = np.random.default_rng([97, seed]).integers(1, 2**63, 256, dtype=np.uint64) | np.uint64(1)
        self.powers = np.ones(1, np.uint64)
        self.langs = {}

    def lang(self, name):
        if name not in self.langs:
            key = self.seed.to_bytes(8, "little")
            self.langs[name] = int.from_bytes(hashlib.blake2b(name.encode(), digest_size=8, key=key).digest(), "little")
        return self.langs[name]

    def digests(self, letters, first, lengths, langs):
        """Of words whose bytes stand end to end in `letters`, starting at `first`."""
        if not len(lengths):
            return np.zeros(0, np.uint64)
        longest = int(lengths.max())
        if len(self.powers) < longest:
            self.powers = np.cumprod(np.concatenate([[np.uint64(1)], np.full(longest, _BASE, np.uint64)]), dtype=np.uint64)
        place = np.arange(len(letters)) - np.repeat(first, lengths)
        sums = np.add.reduceat(self.bytes[letters] * self.powers[place], first)
        digests = mixed(mixed(sums + lengths.astype(np.uint64)) + langs)
        self.powers = self.powers[: 1 << 16]
        return digests


def pieces_of_batches(batches):
    """(bytes, ends, langs): texts of about CHUNK_BYTES, each ended by a break, cut at breaks only."""
    parts, langs, size = [], [], 0

    def whole():
        return b"".join(parts), np.cumsum([len(p) for p in parts]), langs

    for batch in batches:
        for lang, text in zip(batch.column("lang"), batch.column("text")):
            data = (text.as_py() or "").encode("utf-8", "replace").translate(_SAME) + b"\n"
            at = 0
            while at < len(data):
                # A long text goes on in the next chunk, after a break.
                end = len(data) if len(data) - at <= CHUNK_BYTES else data.find(b"\n", at + CHUNK_BYTES) + 1
                parts.append(data[at:end])
                langs.append(lang.as_py())
                size += end - at
                at = end
                if size >= CHUNK_BYTES:
                    yield whole()
                    parts, langs, size = [], [], 0
    if parts:
        yield whole()


class Words:
    """The words of one chunk: ids, places in its bytes, and which ones the next word follows directly."""

    def __init__(self, data, ends, langs, hasher):
        self.data = data
        array = np.frombuffer(data, np.uint8)
        inside = np.zeros(len(array) + 2, bool)
        breaks = array == _BREAK
        inside[1:-1] = ~(breaks | (array == 0x20))
        edges = np.flatnonzero(inside[1:] != inside[:-1])
        self.starts, self.stops = edges[::2], edges[1::2]
        lengths = self.stops - self.starts
        self.text = np.searchsorted(ends, self.starts, side="right")
        self.langs = langs
        seeds = np.array([hasher.lang(x) for x in langs], np.uint64)
        self.ids = hasher.digests(array[inside[1:-1]], np.cumsum(lengths) - lengths, lengths, seeds[self.text])
        gone = np.cumsum(breaks)
        self.joined = gone[self.starts[1:]] == gone[self.stops[:-1] - 1] if len(self.ids) else np.zeros(0, bool)


def pair_digests(a, b):
    return mixed(a * np.uint64(0xD1B54A32D192ED03) + mixed(b))


def permuted(limbs):
    """The limbs of packed n-grams, stirred invertibly; the first one then depends on all."""
    out = list(limbs)
    for k in range(len(out) - 1, 0, -1):
        out[k - 1] = out[k - 1] ^ mixed(out[k] + np.uint64(k))
    out[-1] = out[-1] ^ mixed(out[0])
    return out


def restored(limbs):
    """The inverse of `permuted`."""
    out = list(limbs)
    out[-1] = out[-1] ^ mixed(out[0])
    for k in range(1, len(out)):
        out[k - 1] = out[k - 1] ^ mixed(out[k] + np.uint64(k))
    return out


def merged(limbs, counts):
    """Entries in order, equal ones added up. Parts that are in order already are merged, not sorted anew."""
    if not len(counts):
        return limbs, counts
    order = np.argsort(limbs[0], kind="stable")
    sorted_limbs = [x[order] for x in limbs]
    same_lead = sorted_limbs[0][1:] == sorted_limbs[0][:-1]
    differs = np.zeros(len(counts) - 1, bool)
    for x in sorted_limbs[1:]:
        differs |= x[1:] != x[:-1]
    if (same_lead & differs).any():
        order = np.lexsort(tuple(reversed(limbs)))
        sorted_limbs = [x[order] for x in limbs]
        same_lead = sorted_limbs[0][1:] == sorted_limbs[0][:-1]
        differs = np.zeros(len(counts) - 1, bool)
        for x in sorted_limbs[1:]:
            differs |= x[1:] != x[:-1]
    first = np.flatnonzero(np.concatenate([[True], ~same_lead | differs]))
    return [x[first] for x in sorted_limbs], np.add.reduceat(counts[order], first)


def quotient_bits(range_bits):
    """Bits of the quotient below those of the range, so that remainders are whole bytes."""
    return 8 + -range_bits % 8


def encoded(limbs, counts, range_bits):
    """One filter as bytes: run lengths of the quotients in unary, remainders, counters.

    The entries are in order, all of one range. A counter takes a byte; from 255 on it
    stands in a list at the end.
    """
    n, bits = len(counts), quotient_bits(range_bits)
    rest = 64 - range_bits - bits
    quotients = ((limbs[0] >> np.uint64(rest)) & np.uint64((1 << bits) - 1)).astype(np.int64)
    ends = np.cumsum(np.bincount(quotients, minlength=1 << bits)) + np.arange(1 << bits)
    unary = np.zeros(n + (1 << bits), np.uint8)
    unary[ends] = 1
    remainders = np.ascontiguousarray(limbs[0].astype("<u8")).view(np.uint8).reshape(-1, 8)[:, : rest // 8]
    large = counts >= 255
    return b"".join([
        n.to_bytes(4, "little"), np.packbits(unary).tobytes(), remainders.tobytes(),
        *[x.astype("<u8").tobytes() for x in limbs[1:]],
        np.where(large, 255, counts).astype(np.uint8).tobytes(), counts[large].astype("<i8").tobytes()])


def decoded(data, prefix, range_bits, size):
    """(limbs, counts) of `encoded`; `prefix` is the filter's range."""
    n, bits = int.from_bytes(data[:4], "little"), quotient_bits(range_bits)
    rest, at = 64 - range_bits - bits, 4

    def take(length, kind):
        nonlocal at
        part = np.frombuffer(data, kind, length // np.dtype(kind).itemsize, at)
        at += length
        return part

    unary = np.unpackbits(take((n + (1 << bits) + 7) // 8, np.uint8), count=n + (1 << bits))
    runs = np.diff(np.flatnonzero(unary) - np.arange(1 << bits), prepend=0)
    lead = np.repeat(np.arange(1 << bits, dtype=np.uint64), runs) << np.uint64(rest)
    if range_bits:
        lead |= np.uint64(prefix) << np.uint64(64 - range_bits)
    low = np.zeros((n, 8), np.uint8)
    low[:, : rest // 8] = take(n * (rest // 8), np.uint8).reshape(n, -1)
    limbs = [lead | low.view("<u8").ravel()]
    limbs += [take(8 * n, "<u8") for _ in range(size - 1)]
    counts = take(n, np.uint8).astype(np.int64)
    large = counts == 255
    counts[large] = take(8 * int(large.sum()), "<i8")
    return limbs, counts


def texts_of(df, lang="lang", text="text", unknown="und"):
    return df.select(F.coalesce(F.col(f"`{lang}`").cast("string"), F.lit(unknown)).alias("lang"), F.col(f"`{text}`").alias("text"))


def word_counts(texts, seed):
    """id, lang, word, n of all distinct words of each language."""
    schema = "id bigint, lang string, word string, n bigint"

    def run(batches):
        hasher = Hasher(seed)
        for chunk in pieces_of_batches(batches):
            words = Words(*chunk, hasher)
            ids, first, n = np.unique(words.ids, return_index=True, return_counts=True)
            bounds = zip(words.starts[first].tolist(), words.stops[first].tolist())
            spelled = pa.array([words.data[a:b] for a, b in bounds], pa.binary()).cast(pa.string())
            langs = pa.array([words.langs[k] for k in words.text[first].tolist()], pa.string())
            yield pa.RecordBatch.from_arrays([pa.array(ids.view(np.int64)), langs, spelled, pa.array(n)], names=["id", "lang", "word", "n"])

    # By id, so that words of one id meet; a chunk has each word once.
    rows = texts.mapInArrow(run, schema).repartition("id")
    return rows.groupBy("id", "lang", "word").agg(F.sum("n").alias("n"))


def bit_filter(rows, column, n):
    """Bits of the digests in `column`, some sixteen for each of the n rows, MOST_BITS at most in total."""
    bits = min(MOST_BITS, max(16, (16 * n).bit_length()))
    place = F.shiftrightunsigned(column, 64 - bits) + 1
    parts = (rows.select(F.bitmap_bucket_number(place).alias("bucket"), F.bitmap_bit_position(place).alias("bit"))
             .groupBy("bucket").agg(F.bitmap_construct_agg("bit").alias("bits")).toArrow())
    out = np.zeros(1 << (bits - 3), np.uint8)
    for bucket, part in zip(parts.column("bucket").to_pylist(), parts.column("bits").to_pylist()):
        at = (bucket - 1) * len(part)
        out[at : at + len(part)] = np.frombuffer(part, np.uint8)[: len(out) - at]
    return bits, out


def may_hold(bit_table, digests):
    bits, table = bit_table
    place = digests >> np.uint64(64 - bits)
    return ((table[place >> np.uint64(3)] >> (place & np.uint64(7)).astype(np.uint8)) & 1).astype(bool)


def phrase_counts(texts, size, seed, range_bits, words, pairs=None, least=LEAST):
    """id1, …, n of all phrases of `size` words with n >= least.

    `words` and `pairs` are broadcast bit filters of what may be frequent.
    """
    names = [f"id{k + 1}" for k in range(size)]

    def count(batches):
        hasher, held, entries = Hasher(seed), [], 0

        def emit():
            limbs, counts = merged([np.concatenate([h[0][k] for h in held]) for k in range(size)], np.concatenate([h[1] for h in held]))
            lead = limbs[0] >> np.uint64(64 - range_bits) if range_bits else np.zeros(len(counts), np.uint64)
            prefixes, first = np.unique(lead, return_index=True)
            ends = np.append(first[1:], len(lead))
            filters = [encoded([x[a:b] for x in limbs], counts[a:b], range_bits) for a, b in zip(first, ends)]
            return pa.RecordBatch.from_arrays([pa.array(prefixes.astype(np.int64)), pa.array(filters, pa.binary())], names=["prefix", "filter"])

        for chunk in pieces_of_batches(batches):
            found = Words(*chunk, hasher)
            ids, joined = found.ids, found.joined
            if len(ids) < size:
                continue
            ok = may_hold(words.value, ids)
            good = ok[:-1] & ok[1:] & joined
            if size == 3:
                at = np.flatnonzero(good)
                good[at] = may_hold(pairs.value, pair_digests(ids[at], ids[at + 1]))
                good = good[:-1] & good[1:]
            at = np.flatnonzero(good)
            if not len(at):
                continue
            held.append(merged(permuted([ids[at + k] for k in range(size)]), np.ones(len(at), np.int64)))
            entries += len(held[-1][1])
            if entries >= SHARD_ENTRIES:
                yield emit()
                held, entries = [], 0
        if held:
            yield emit()

    def merge(key, table):
        parts = [decoded(data.as_py(), key[0].as_py(), range_bits, size) for data in table.column("filter")]
        limbs, counts = merged([np.concatenate([p[0][k] for p in parts]) for k in range(size)], np.concatenate([p[1] for p in parts]))
        often = counts >= least
        limbs = restored([x[often] for x in limbs])
        return pa.table([pa.array(x.view(np.int64)) for x in limbs] + [pa.array(counts[often])], names=[*names, "n"])

    filters = texts.mapInArrow(count, "prefix bigint, filter binary")
    # The ranges are of about equal size at any size of the input: their number follows the words.
    return filters.groupBy("prefix").applyInArrow(merge, ", ".join(f"{c} bigint" for c in [*names, "n"]))


def least_cuts(rows, scale=SCALE):
    """`rows` (…, a, l1, r1, l2, r2) with l, r and score of the cut that scores least; exact for all counts."""
    schema = rows.select(*[c for c in rows.columns if c not in ("l1", "r1", "l2", "r2")],
                         F.col("l1").alias("l"), F.col("r1").alias("r"), F.lit(0).cast("long").alias("score")).schema
    kept = [c for c in rows.columns if c not in ("l1", "r1", "l2", "r2")]

    def run(batches):
        for batch in batches:
            a, l1, r1 = (np.array(batch.column(c).to_pylist(), object) for c in ("a", "l1", "r1"))
            first = scale * a * a // (l1 * r1) if len(a) else a
            # A phrase of two has no second cut.
            l2, r2 = (np.array([y if x is None else x for x, y in zip(batch.column(c).to_pylist(), d)], object) for c, d in (("l2", l1), ("r2", r1)))
            second = scale * a * a // (l2 * r2) if len(a) else a
            later = (second < first).astype(bool)
            made = [np.where(later, y, x).tolist() for x, y in ((l1, l2), (r1, r2), (first, second))]
            yield pa.RecordBatch.from_arrays(
                [batch.column(c) for c in kept] + [pa.array(x, pa.int64()) for x in made], names=schema.names)

    return rows.mapInArrow(run, schema)


def ranked(rows, top=TOP):
    """The first `top` of each language with their rank; a language's rows are dealt to SALTS tasks first."""
    order = [F.col("score").desc(), F.col("a").desc(), F.col("phrase").asc()]
    salt = F.pmod(F.xxhash64("phrase"), F.lit(SALTS))
    few = rows.withColumn("__salt", salt).withColumn("__rank", F.row_number().over(W.partitionBy("lang", "__salt").orderBy(*order)))
    few = few.filter(F.col("__rank") <= top).drop("__salt", "__rank")
    return few.withColumn("rank", F.row_number().over(W.partitionBy("lang").orderBy(*order)).cast("long")).filter(F.col("rank") <= top)


def collocations(df, lang="lang", text="text", least=LEAST, covered=COVERED, top=TOP):
    """lang, rank, phrase, a, l, r, n, score: the best phrases of two or three words per language.

    a is how often the phrase stands in the texts, l and r how often its two parts at the
    cut that scores least, n how many words the language has; score is
    floor(SCALE * a * a / (l * r)). A phrase of two inside a frequent one of three that
    makes up at least `covered` percent of it is left out. NULL and empty texts have no
    words, a NULL language is `und`, rows that repeat count each time. Equal scores go by
    a, then by the phrase's bytes. Without frequent phrases there are no rows.
    """
    texts = texts_of(df, lang, text)
    seed = 0
    while True:
        words = staged(word_counts(texts, seed), "words")
        if words.groupBy("id").count().filter("count > 1").isEmpty():
            break
        seed += 1
    context = df.sparkSession.sparkContext
    seen = words.agg(F.sum("n").alias("n"), F.count_if(F.col("n") >= least).alias("often")).first()
    range_bits = max(0, ((seen["n"] or 0) // RANGE_ENTRIES).bit_length())
    frequent = words.filter(F.col("n") >= least)
    word_bits = context.broadcast(bit_filter(frequent, F.col("id"), seen["often"]))
    pairs = staged(phrase_counts(texts, 2, seed, range_bits, word_bits, least=least), "pairs")
    pair_bits = context.broadcast(bit_filter(with_pair_digest(pairs), F.col("digest"), pairs.count()))
    triples = staged(phrase_counts(texts, 3, seed, range_bits, word_bits, pair_bits, least=least), "triples")

    dictionary = small(frequent)
    spelled = pairs.join(dictionary.select(F.col("id").alias("id1"), "lang", F.col("word").alias("w1"), F.col("n").alias("f1")), "id1").join(
        dictionary.select(F.col("id").alias("id2"), F.col("word").alias("w2"), F.col("n").alias("f2")), "id2")
    inner = triples.select("id1", "id2", "n").unionAll(triples.select(F.col("id2").alias("id1"), F.col("id3").alias("id2"), "n"))
    longest = inner.groupBy("id1", "id2").agg(F.max("n").alias("longer"))
    alone = spelled.join(longest, ["id1", "id2"], "left").filter(
        F.col("longer").isNull() | (100 * F.col("longer") < covered * F.col("n")))
    nothing = F.lit(None).cast("long")
    twos = alone.select("lang", F.concat_ws(" ", "w1", "w2").alias("phrase"), F.col("n").alias("a"),
                        F.col("f1").alias("l1"), F.col("f2").alias("r1"), nothing.alias("l2"), nothing.alias("r2"))
    front = spelled.select("id1", "id2", "lang", "w1", "w2", "f1", F.col("n").alias("f12"))
    back = spelled.select(F.col("id1").alias("id2"), F.col("id2").alias("id3"), F.col("w2").alias("w3"), F.col("f2").alias("f3"), F.col("n").alias("f23"))
    threes = triples.join(front, ["id1", "id2"]).join(back, ["id2", "id3"]).select(
        "lang", F.concat_ws(" ", "w1", "w2", "w3").alias("phrase"), F.col("n").alias("a"),
        F.col("f1").alias("l1"), F.col("f23").alias("r1"), F.col("f12").alias("l2"), F.col("f3").alias("r2"))
    best = ranked(least_cuts(twos.unionAll(threes)), top)
    total = words.groupBy("lang").agg(F.sum("n").alias("n"))
    return best.join(small(total), "lang").select("lang", "rank", "phrase", "a", "l", "r", "n", "score")


def with_pair_digest(pairs):
    """`pairs` with the digest that the bit filter of pairs is asked for."""

    def run(batches):
        for batch in batches:
            a, b = (batch.column(c).to_numpy().astype(np.int64).view(np.uint64) for c in ("id1", "id2"))
            yield pa.RecordBatch.from_arrays([pa.array(pair_digests(a, b).view(np.int64))], names=["digest"])

    return pairs.select("id1", "id2").mapInArrow(run, "digest bigint")
