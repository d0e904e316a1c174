"""Deletes from a document the blocks of lines that an earlier document already has.

Documents that overlap are found through the lines they share, and through the shortest
runs of lines with `MIN_WORDS` words: each leads from every document that holds it to
the first one, so the pairs grow with the lines and not with the square of the
documents that share one. Each pair is aligned by patience diff
on the digests of its lines: lines that occur once on both sides, and in the same
order, hold the alignment, and what stands between them is aligned in the same way.
Aligned blocks of at least `MIN_WORDS` words are deleted from the later document.

"Later" is by key; documents with the same key are never compared. Lines are compared
without the white space around them, by 64-bit digests; blank lines never lead to a
pair. A character of a script without spaces counts as a word. A line that is deleted always remains in an earlier document, as the first
document with it is never later than another one with it.
"""

from array import array
from bisect import bisect_left
from collections import Counter

import pyarrow as pa
import xxhash
from pyspark.sql import functions as F

from starloom.llm.bpe import forget
from starloom.session import staged

MIN_WORDS = 30
ROWS_AT_ONCE = 256
NO_KEY = -(2**63)
WHITE = r"[\x09-\x0D\x20\xA0]"
# Letters of scripts that are written without spaces, which count as a word each.
UNSPACED = r"[\p{IsHan}\p{IsHiragana}\p{IsKatakana}\p{IsThai}\p{IsLao}\p{IsKhmer}\p{IsMyanmar}\p{IsTibetan}]"
WORD = f"[^{WHITE[1:-1]}{UNSPACED[1:-1]}]++|{UNSPACED}"
# All of them stand from here on.
MAYBE_UNSPACED = r"[\x{E00}-\x{10FFFF}]"


def _rising(pairs):
    """The longest run of (i, j), sorted by i, whose j rise."""
    ends, at, back = [], [], [None] * len(pairs)
    for n, (_, j) in enumerate(pairs):
        place = bisect_left(ends, j)
        ends[place : place + 1] = [j]
        at[place : place + 1] = [n]
        back[n] = at[place - 1] if place else None
    out, n = [], at[-1] if at else None
    while n is not None:
        out.append(pairs[n])
        n = back[n]
    return out[::-1]


def _numbered(lines, start):
    """Lines of a range with how often each has occurred before, and their places."""
    seen, out = Counter(), {}
    for i, line in enumerate(lines, start):
        out[line, seen[line]] = i
        seen[line] += 1
    return out


def aligned(a, b):
    """Patience diff: places (i, j) of aligned equal lines, in order.

    Where no line is unique on both sides, the n-th occurrences of a line are taken for
    one another; so two sides made of the same repeated lines are aligned as well.
    """
    found, todo = [], [(0, len(a), 0, len(b))]
    while todo:
        a0, a1, b0, b1 = todo.pop()
        while a0 < a1 and b0 < b1 and a[a0] == b[b0]:
            found.append((a0, b0))
            a0, b0 = a0 + 1, b0 + 1
        while a0 < a1 and b0 < b1 and a[a1 - 1] == b[b1 - 1]:
            a1, b1 = a1 - 1, b1 - 1
            found.append((a1, b1))
        if a0 == a1 or b0 == b1:
            continue
        left, right = Counter(a[a0:a1]), Counter(b[b0:b1])
        where = {b[j]: j for j in range(b0, b1) if right[b[j]] == 1}
        anchors = [(i, where[a[i]]) for i in range(a0, a1) if left[a[i]] == 1 and a[i] in where]
        if anchors:
            i, j = a0, b0
            for x, y in [*_rising(anchors), (a1, b1)]:
                if x > i and y > j:
                    todo.append((i, x, j, y))
                if x < a1:
                    found.append((x, y))
                i, j = x + 1, y + 1
        elif left.keys() & right.keys():
            mine, other = _numbered(a[a0:a1], a0), _numbered(b[b0:b1], b0)
            found.extend(_rising([(i, other[k]) for k, i in mine.items() if k in other]))
    return sorted(found)


def common_blocks(first, later, words, min_words=MIN_WORDS):
    """Places in `later` of the lines to delete: aligned blocks of at least `min_words` words.

    The rest of `later` is aligned again until no block is left, as a passage may stand
    in it twice or in another order. `words` are the words of each line of `later`.
    """
    gone, left = set(), list(range(len(later)))
    have = set(first)
    while True:
        left = [j for j in left if later[j] in have or words[j] == 0]
        if not left:
            break
        pairs, new, at = aligned(first, [later[j] for j in left]), [], 0
        while at < len(pairs):
            end = at + 1
            while (end < len(pairs) and pairs[end][0] == pairs[end - 1][0] + 1
                   and left[pairs[end][1]] == left[pairs[end - 1][1]] + 1):
                end += 1
            block = [left[j] for _, j in pairs[at:end]]
            if sum(words[j] for j in block) >= min_words:
                new.extend(block)
            at = end
        if not new:
            break
        gone.update(new)
        # Further copies of long single lines go at once.
        alone = {later[j] for j in new if words[j] >= min_words}
        gone.update(j for j in left if later[j] in alone)
        left = [j for j in left if j not in gone]
    return sorted(gone)


def _identified(df, key, text):
    """`df` with its order `__rank` and the digest `__sig` of its text: rows alike in both are copies."""
    return df.withColumns({
        "__rank": F.coalesce(F.col(f"`{key}`").cast("long"), F.lit(NO_KEY)),
        "__sig": F.xxhash64(F.coalesce(F.col(f"`{text}`"), F.lit(""))),
    })


def shortest_runs(lines, words, min_words=MIN_WORDS):
    """Digests of the runs of several lines with `min_words` words that hold no shorter such run.

    Every block of `min_words` words that two documents share holds one of them, or one
    line of that length; so none stays whole when these lead to their first documents.
    """
    out, end, total = [], 0, 0
    for start, n in enumerate(words):
        while end < len(words) and total < min_words:
            total += words[end]
            end += 1
        if total < min_words:
            break
        total -= n
        if n and total < min_words and end - start > 1:
            out.append(xxhash.xxh3_64_intdigest(array("q", lines[start:end]).tobytes(), 1) - 2**63)
    return out


def _parts(batches, most=ROWS_AT_ONCE):
    """The rows of batches as Python values, which are several times as large: lists of a few rows.

    What an encoder has remembered in this worker goes first; a later one reads it anew.
    """
    forget()
    for batch in batches:
        for start in range(0, batch.num_rows, most):
            yield list(zip(*(c.to_pylist() for c in batch.slice(start, most).columns)))


def _led(min_words):
    """What leads a document to an earlier one: its distinct lines that have words, and its shortest runs."""
    def run(batches):
        for part in _parts(b.select(["rank", "sig", "lines", "words"]) for b in batches):
            out = ([], [], [])
            for rank, sig, lines, words in part:
                led = {x for x, n in zip(lines, words) if n}
                led.update(shortest_runs(lines, words, min_words))
                out[0].extend([rank] * len(led))
                out[1].extend([sig] * len(led))
                out[2].extend(led)
            yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in out], names=["rank", "sig", "line"])

    return run


def word_count(line):
    """Words of a line without white space at its ends; most lines need no look at scripts."""
    spaced = F.length(F.regexp_replace(line, rf"[^{WHITE[1:-1]}]++{WHITE}*+", "x"))
    return F.when(line.rlike(MAYBE_UNSPACED), F.regexp_count(line, F.lit(WORD))).otherwise(spaced)


def cuts(df, key="doc_id", text="text", min_words=MIN_WORDS):
    """rank, sig, cut (places of deleted lines), sources (keys of the documents that keep them)."""
    trimmed = F.transform(F.split(F.col(f"`{text}`"), "\n", -1), lambda s: F.btrim(s, F.lit("\t\n\x0b\x0c\r \xa0")))
    rows = _identified(df.select(F.col(f"`{key}`"), F.col(f"`{text}`")), key, text)
    lines = rows.filter(F.col(f"`{text}`").isNotNull()).select(
        F.col("__rank").alias("rank"), F.col("__sig").alias("sig"), trimmed.alias("lines"))
    digests = lines.select(
        "rank", "sig",
        F.transform("lines", lambda s: F.xxhash64(s)).alias("lines"),
        F.transform("lines", word_count).alias("words"),
    ).groupBy("rank", "sig").agg(F.first("lines").alias("lines"), F.first("words").alias("words"))
    table = staged(digests, "lines")
    held = table.mapInArrow(_led(min_words), "rank bigint, sig bigint, line bigint")
    first = held.groupBy("line").agg(F.min(F.struct("rank", "sig")).alias("first"), F.count("*").alias("n"))
    # The complement as key: no plan takes the counts' partitioning over, so that
    # adaptive execution can split a line that very many documents hold.
    shared = first.filter("n > 1").select(F.bitwise_not("line").alias("__line"), "first")
    pairs = (
        held.join(shared, F.bitwise_not("line") == F.col("__line"))
        .filter(F.col("first.rank") < F.col("rank"))
        .select("rank", "sig", F.col("first.rank").alias("rank0"), F.col("first.sig").alias("sig0"))
        .distinct()
    )
    earlier = table.select(F.col("rank").alias("rank0"), F.col("sig").alias("sig0"), F.col("lines").alias("lines0"))
    both = pairs.join(earlier, ["rank0", "sig0"]).join(table, ["rank", "sig"]).select(
        "rank", "sig", "rank0", "lines0", "lines", "words")

    def run(batches):
        for part in _parts(batches):
            out = ([], [], [], [])
            for rank, sig, rank0, lines0, lines, words in part:
                cut = common_blocks(lines0, lines, words, min_words)
                if cut:
                    for column, value in zip(out, (rank, sig, rank0, cut)):
                        column.append(value)
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, t) for c, t in zip(out, (pa.int64(), pa.int64(), pa.int64(), pa.list_(pa.int32())))],
                names=["rank", "sig", "rank0", "cut"])

    found = both.mapInArrow(run, "rank bigint, sig bigint, rank0 bigint, cut array<int>")
    return found.groupBy("rank", "sig").agg(
        F.array_sort(F.array_distinct(F.flatten(F.collect_list("cut")))).alias("cut"),
        F.array_sort(F.collect_set(F.when(F.col("rank0") != NO_KEY, F.col("rank0")))).alias("sources"))


def deduplicated(df, key="doc_id", text="text", min_words=MIN_WORDS):
    """`df` with `text` without the deleted lines, and n_lines, n_deleted, sources.

    A NULL text stays NULL with 0 lines; an empty text is one blank line. Repeated rows
    are kept, and lose the same lines. A document may lose all its lines; its text is
    then empty.
    """
    names = ("n_lines", "n_deleted", "sources")
    rows = _identified(df.select([F.col(f"`{c}`") for c in df.columns if c not in names]), key, text)
    cut = cuts(df, key, text, min_words).select(F.col("rank").alias("__rank"), F.col("sig").alias("__sig"), F.col("cut").alias("__cut"), F.col("sources").alias("__sources"))
    body = F.split(F.col(f"`{text}`"), "\n", -1)
    kept = F.array_except(F.sequence(F.lit(0), F.size(body) - 1), F.col("__cut"))
    shorter = F.array_join(F.transform(kept, lambda i: F.get(body, i)), "\n")
    joined = rows.join(cut, ["__rank", "__sig"], "left")
    return joined.select(
        *[F.when(F.col("__cut").isNull(), F.col(f"`{c}`")).otherwise(shorter).alias(c) if c == text else F.col(f"`{c}`")
          for c in rows.columns if c not in ("__rank", "__sig")],
        F.when(F.col(f"`{text}`").isNull(), 0).otherwise(F.size(body)).alias("n_lines"),
        F.coalesce(F.size("__cut"), F.lit(0)).alias("n_deleted"),
        F.coalesce("__sources", F.array().cast("array<bigint>")).alias("sources"),
    )
