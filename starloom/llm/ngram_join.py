"""Near duplicates by the Jaccard similarity of word shingles, size-aware.

Sets of at most X shingles are light: two light sets are alike exactly if they share a
subset of the size that their overlap must have, so all subsets of these sizes are
enumerated and equal ones meet. Larger sets are heavy: inverted lists of the shingles
at the front of each set, in one global order, are scanned; two alike sets share one of
these, and every candidate is verified with the whole sets. X is where the cost of
both, from the number of sets of each size, is least.

The order puts shingles that very many sets hold last, so that passages which many
documents share don't bring their documents together. Equal sets are one node. Groups
of near copies are linked without all their pairs: neighbours within many lists are
verified first, and those with the set that has least of its own in a list; then only
sets that are still in different components: every pair of them that shares as many
lists as alike sets of their sizes must, and has not too much of its own ahead of any of
these lists, is verified. Such pairs meet in few of their lists: in the shortest ones,
one more than alike sets can miss.

Shingles are 64-bit digests, and so are the sets; the rest is exact.
"""

from itertools import combinations
from math import log

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from starloom.llm.bpe import chunks
from starloom.llm.components import components
from starloom.llm.word_hashes import grams, word_digests
from starloom.session import finished, staged

SHINGLE = 5
PERCENT = 75
MOST_LIGHT = 12
NEIGHBOURS = 8
VERIFY_COST = 6  # of a posting and its verification, against one of a subset
FREQUENT = 16
MOST_FREQUENT = 1_000_000
FILTER_BITS = 26  # the filter of documents to verify has 2^26 bits: 8 MB
LARGE = 16  # sets of a component that is a class of its own in lists
SIZE_STEP = 1.1
NO_KEY = -(2**63)
_FOLD = bytes(b + 32 if 65 <= b <= 90 else 32 if 9 <= b <= 13 else b for b in range(256))


def shingle_sets(texts, size=SHINGLE):
    """The sorted distinct shingle digests of each text.

    A text of fewer words is one shingle of all its words; one without words, or NULL, has none.
    """
    folded = [(t or "").encode("utf-8", "replace").translate(_FOLD) for t in texts]
    words, ends = word_digests(folded)
    runs, out, start = grams(words, size), [], 0
    for end in ends.tolist():
        n = end - start
        if n >= size:
            out.append(np.unique(runs[start : end - size + 1]))
        elif n:
            out.append(grams(words[start:end], n))
        else:
            out.append(np.zeros(0, np.uint64))
        start = end
    return out


def signature(shingles):
    return xxhash.xxh3_64_intdigest(shingles.tobytes()) - 2**63


def overlap_of(a, b, percent=PERCENT):
    """Shingles that sets of sizes a and b must share."""
    return -(-percent * (a + b) // (100 + percent))


def sizes_near(n, percent=PERCENT):
    """The sizes a partner of a set of n may have."""
    return range(-(-percent * n // 100), 100 * n // percent + 1)


def partners(n, percent=PERCENT):
    """The sizes that a set of n can be alike to, and how many shingles they then share."""
    return [(b, overlap_of(n, b, percent)) for b in sizes_near(n, percent) if overlap_of(n, b, percent) <= min(n, b)]


def front(n, percent=PERCENT):
    """How many shingles from the front of the order one of two alike sets must share."""
    return n + (-percent * n // 100) + 1 if n else 0


def boundary(counts, percent=PERCENT):
    """The largest light size, at which the cost over {size: number of sets} is least."""
    from math import comb

    def cost(x):
        light = sum(c * sum(comb(n, k) for b, k in partners(n, percent) if b <= x) for n, c in counts.items() if n <= x)
        heavy = sum(c * VERIFY_COST * front(n, percent) for n, c in counts.items() if n > -(-percent * (x + 1) // 100) - 1)
        return light + heavy

    return min(range(MOST_LIGHT + 1), key=lambda x: (cost(x), x))


def _batch(columns, types, names):
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types)], names=names)


def _texts(df, key, text):
    body = F.col(f"`{text}`")
    return df.select(F.coalesce(F.col(f"`{key}`").cast("long"), F.lit(NO_KEY)).alias("rank"),
                     F.xxhash64(F.coalesce(body, F.lit(""))).alias("body"), body.alias("text"))


def described(df, key, text, percent):
    """rank, body, n, sig and, for a small set, all shingles of every document."""
    names = ["rank", "body", "n", "sig", "first"]
    types = (pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.list_(pa.int64()))

    def run(batches):
        for batch in batches:
            for part, texts in chunks(batch, "text", 500_000):
                sets = shingle_sets(texts)
                n = [len(s) for s in sets]
                firsts = [s.view(np.int64) if len(s) <= MOST_LIGHT else None for s in sets]
                yield _batch((part.column("rank"), part.column("body"), n, [signature(s) if len(s) else None for s in sets], firsts), types, names)

    return _texts(df, key, text).mapInArrow(run, "rank bigint, body bigint, n bigint, sig bigint, first array<bigint>")


def light_links(sets, light, percent):
    """Links of light sets through the subsets that they must share.

    A subset is enumerated for each pair of sizes. Sets of the two sizes that meet in it
    are alike; so each set is linked to the first one of the other size that has it.
    """
    def run(batches):
        for batch in batches:
            keys, owners, sides = [], [], []
            for sig, first in zip(*(c.to_pylist() for c in batch.columns)):
                n = len(first)
                for other, k in partners(n, percent):
                    if other > light:
                        continue
                    side, seed = (n > other) - (n < other), min(n, other) << 8 | max(n, other)
                    for chosen in combinations(sorted(first), k):
                        keys.append(xxhash.xxh3_64_intdigest(np.array(chosen, np.int64).tobytes(), seed) - 2**63)
                        owners.append(sig)
                        sides.append(side)
            yield _batch((keys, owners, sides), (pa.int64(), pa.int64(), pa.int32()), ["subset", "sig", "side"])

    rows = sets.filter((F.col("n") > 0) & (F.col("n") <= light)).select("sig", "first").mapInArrow(
        run, "subset bigint, sig bigint, side int")
    firsts = rows.groupBy("subset").agg(
        *[F.min(F.when(F.col("side") == side, F.col("sig"))).alias(name) for side, name in ((-1, "small"), (0, "same"), (1, "large"))],
        F.count("*").alias("n"),
    ).filter("n > 1").withColumn("subset", F.bitwise_not("subset")).withColumnRenamed("subset", "__subset")
    first = F.when(F.col("side") == 0, F.col("same")).when(F.col("side") < 0, F.col("large")).otherwise(F.col("small"))
    return rows.join(firsts, F.bitwise_not("subset") == F.col("__subset")).select(
        F.col("sig").alias("a"), first.alias("b")).filter("a <> b").distinct()


def frequent(df, text):
    """The first 32 bits of the shingles that most documents hold, MOST_FREQUENT at most, sorted.

    They only choose the order of shingles; any choice gives the same links.
    """
    def run(batches):
        for batch in batches:
            for _, texts in chunks(batch, "text", 500_000):
                heads = [(s >> np.uint64(32)).astype(np.uint32) for s in shingle_sets(texts)]
                yield _batch((np.concatenate(heads).view(np.int32),), (pa.int32(),), ["head"])

    counted = df.select(F.col(f"`{text}`").alias("text")).mapInArrow(run, "head int").groupBy("head").agg(
        F.count("*").alias("n")).filter(F.col("n") > FREQUENT)
    most = counted.orderBy(F.desc("n"), "head").limit(MOST_FREQUENT)
    return np.sort(most.select("head").toArrow().column(0).to_numpy().astype(np.int32).view(np.uint32))


def postings(df, key, text, last, least, percent):
    """shingle, sig, place of the front of each set; place is its size, then its rank in the order."""
    names = ["sig", "n", "front"]
    types = (pa.int64(), pa.int64(), pa.list_(pa.int64()))
    last = df.sparkSession.sparkContext.broadcast(last)

    def run(batches):
        seen, late = set(), last.value
        for batch in batches:
            for _, texts in chunks(batch, "text", 500_000):
                out = ([], [], [])
                for shingles in shingle_sets(texts):
                    n = len(shingles)
                    sig = signature(shingles) if n >= least else None
                    if sig is None or sig in seen:  # a copy within this task
                        continue
                    seen.add(sig)
                    k = front(n, percent)
                    if len(late):
                        heads = (shingles >> np.uint64(32)).astype(np.uint32)
                        common = late[np.minimum(np.searchsorted(late, heads), len(late) - 1)] == heads
                        shingles = np.concatenate([shingles[~common], shingles[common]])
                    for column, value in zip(out, (sig, n, shingles[:k].view(np.int64))):
                        column.append(value)
                yield _batch(out, types, names)

    rows = _texts(df, key, text).mapInArrow(run, "sig bigint, n bigint, front array<bigint>")
    return rows.select("sig", "n", F.posexplode("front").alias("rank", "shingle")).select(
        "shingle", "sig", (F.shiftleft("n", 32) + F.col("rank")).alias("place"))


def overlap_needed(na, nb, percent):
    """Shingles that alike sets of these sizes must share; sizes are columns."""
    return F.ceil(percent * (na + nb) / (100 + percent))


def may_be_alike(a, b, percent):
    """Whether sets of one list may be alike by their sizes and by what they can share.

    `a` and `b` are pairs of columns: size, and `most` of `shared_postings`.
    """
    (na, ma), (nb, mb) = a, b
    return (100 * F.least(na, nb) >= percent * F.greatest(na, nb)) & (overlap_needed(na, nb, percent) <= F.least(ma, mb))


def lists_needed(na, nb, percent):
    """How many lists two alike sets of these sizes share at least; sizes are columns.

    What they share beyond the fronts lies in the rest of the set whose front ends first.
    """
    rest = [F.ceil(percent * n / 100) - 1 for n in (na, nb)]
    return F.greatest(overlap_needed(na, nb, percent) - F.greatest(*rest), F.lit(1))


def shared_postings(rows, percent):
    """shingle, sig, n, most: the postings whose list holds another set that this one may be alike to.

    `most` is how many shingles the set can share with another one of the list: what two
    sets share ahead of a list lies in lists as well, so all shingles ahead of it but
    those without a list are a set's own. Frequent shingles come last in the order, so
    that of many copies of one text those that are changed too much go here, without pairs.
    """
    order, whole = W.partitionBy("shingle").orderBy("place", "sig"), W.partitionBy("shingle")
    near = rows.withColumns({"before": F.lag("sig").over(order), "low": F.min("sig").over(whole), "high": F.max("sig").over(whole)})
    # A set that several tasks have seen stands in a list once.
    shared = near.filter("low <> high and (before is null or before <> sig)").select(
        "shingle", "sig", F.shiftright("place", 32).alias("n"), F.expr("place & 4294967295").alias("rank"))
    own = F.col("rank") + 1 - F.row_number().over(W.partitionBy("sig").orderBy("rank"))
    return shared.withColumn("most", F.col("n") - own).filter(F.col("most") >= F.ceil(percent * F.col("n") / 100)).drop("rank")


def _bits(rows, column):
    """A filter of 2^FILTER_BITS bits of the digests in `column`; its size is fixed."""
    place = F.shiftrightunsigned(column, 64 - FILTER_BITS) + 1
    parts = (rows.select(F.bitmap_bucket_number(place).alias("bucket"), F.bitmap_bit_position(place).alias("bit"))
             .groupBy("bucket").agg(F.bitmap_construct_agg("bit").alias("bits")).toArrow())
    bits = np.zeros(1 << (FILTER_BITS - 3), np.uint8)
    for bucket, part in zip(parts.column("bucket").to_pylist(), parts.column("bits").to_pylist()):
        bits[(bucket - 1) * len(part) : bucket * len(part)] = np.frombuffer(part, np.uint8)
    return bits


def whole_sets(df, key, text, wanted):
    """sig and all shingles (binary) of the documents (rank, body) in `wanted`, and of a few more."""
    id_of = F.xxhash64("rank", "body")
    bits = df.sparkSession.sparkContext.broadcast(_bits(wanted.select(id_of.alias("id")), "id"))

    def run(batches):
        for batch in batches:
            ids = batch.column("id").to_numpy().astype(np.int64).view(np.uint64) >> np.uint64(64 - FILTER_BITS)
            passed = (bits.value[ids >> np.uint64(3)] >> (ids & np.uint64(7)).astype(np.uint8)) & 1
            some = batch.filter(pa.array(passed.astype(bool)))
            if some.num_rows:
                for _, texts in chunks(some, "text", 500_000):
                    sets = [s for s in shingle_sets(texts) if len(s)]
                    yield _batch(([signature(s) for s in sets], [s.tobytes() for s in sets]), (pa.int64(), pa.binary()), ["sig", "shingles"])

    return _texts(df, key, text).select(id_of.alias("id"), "text").mapInArrow(run, "sig bigint, shingles binary")


def verified(pairs, sets, percent):
    """The pairs (a, b) whose whole sets are alike."""
    other = sets.select(F.col("sig").alias("b"), F.col("shingles").alias("shingles_b"))
    both = pairs.join(other, "b").join(sets.withColumnRenamed("sig", "a"), "a").select("a", "b", "shingles", "shingles_b")

    def run(batches):
        for batch in batches:
            out = ([], [])
            for a, b, x, y in zip(*(c.to_pylist() for c in batch.columns)):
                joined = np.concatenate([np.frombuffer(x, np.uint64), np.frombuffer(y, np.uint64)])
                joined.sort(kind="stable")
                shared = int((joined[1:] == joined[:-1]).sum())
                if 100 * shared >= percent * (len(joined) - shared):
                    out[0].append(a)
                    out[1].append(b)
            yield _batch(out, (pa.int64(), pa.int64()), ["a", "b"])

    return both.mapInArrow(run, "a bigint, b bigint")


def fewest_lists(n, low, high, percent):
    """The least of `lists_needed` for n and the sizes from low to high, or one less.

    Without its roundings it is concave in the other size, and so least at an end.
    """
    def at(other):
        return F.floor(percent * (n + other) / (100 + percent) - percent * F.greatest(n, other) / 100) + 1

    return F.when(low == high, lists_needed(n, low, percent)).otherwise(F.greatest(F.least(at(low), at(high)), F.lit(1)))


def meetings(lists, roots, light, percent):
    """a, b: pairs of different components that may be alike, once per list in which they meet.

    The members of each list are dealt into classes by size, and by component where it
    is large. Two alike sets share `lists_needed` lists at least. So a set with s lists
    that have members of a class, k of which it must share with any one of them, meets
    all that it may be alike to in any s - k + 1 of these; the shortest ones are taken.
    """
    counted = roots.groupBy("root").agg(F.count("*").alias("members"))
    named = roots.join(counted, "root").withColumnRenamed("node", "sig")
    root, members = F.coalesce("root", "sig"), F.coalesce("members", F.lit(1))
    placed = lists.join(named, "sig", "left").select(
        "shingle", "sig", "n", "most", F.struct(members.alias("members"), root.alias("root")).alias("component"),
        F.when(members >= LARGE, root).otherwise(0).alias("of"), F.floor(F.log("n") / log(SIZE_STEP)).alias("about"))
    classes = placed.groupBy("shingle", "of", "about").agg(
        F.count("*").alias("length"), F.min("n").alias("low"), F.max("n").alias("high"), F.max("component").alias("largest"),
    ).withColumnRenamed("shingle", "__shingle")
    # Sets look for those of larger components only, so that the largest one's own pairs are never made.
    near = placed.select("shingle", "sig", "n", "most", "component").join(classes, F.col("shingle") == F.col("__shingle")).withColumns({
        "low": F.greatest("low", F.ceil(percent * F.col("n") / 100)), "high": F.least("high", F.floor(100 * F.col("n") / percent))}).filter(
        (F.col("component") < F.col("largest")) & (F.col("low") <= F.col("high"))
        & (overlap_needed(F.col("n"), F.col("low"), percent) <= F.col("most")))
    whole = W.partitionBy("sig", "of", "about")
    chosen = near.withColumns({
        "s": F.count("*").over(whole), "low": F.min("low").over(whole), "high": F.max("high").over(whole),
        "place": F.row_number().over(whole.orderBy("length", "shingle"))}).filter(
        F.col("place") <= F.col("s") - fewest_lists(F.col("n"), F.col("low"), F.col("high"), percent) + 1)
    seeking = chosen.select("shingle", "of", "about", *[F.col(c).alias(f"{c}_a") for c in ("sig", "n", "most", "component")])
    sought = placed.select("shingle", "of", "about", *[F.col(c).alias(f"{c}_b") for c in ("sig", "n", "most", "component")])
    met = seeking.join(sought, ["shingle", "of", "about"]).filter(
        (F.col("component_a") < F.col("component_b"))
        & may_be_alike((F.col("n_a"), F.col("most_a")), (F.col("n_b"), F.col("most_b")), percent)
        & (F.greatest("n_a", "n_b") > light))
    return met.select(F.greatest("sig_a", "sig_b").alias("a"), F.least("sig_a", "sig_b").alias("b"))


def unjoined_pairs(lists, roots, light, percent):
    """Pairs that share as many lists as alike sets of their sizes must, may be alike, and are in different components."""
    # The complement as key: no plan takes the partitioning over, so that adaptive
    # execution can split the pairs of a set that very many have met.
    fronts = lists.groupBy("sig").agg(F.first("n").alias("n"), F.collect_list("shingle").alias("lists")).withColumn("sig", F.bitwise_not("sig"))
    a, b = [fronts.select(*[F.col(c).alias(f"{c}_{side}") for c in fronts.columns]) for side in "ab"]
    both = meetings(lists, roots, light, percent).distinct().join(a, F.bitwise_not("a") == F.col("sig_a")).join(b, F.bitwise_not("b") == F.col("sig_b"))
    return both.filter(F.size(F.array_intersect("lists_a", "lists_b")) >= lists_needed(F.col("n_a"), F.col("n_b"), percent)).select("a", "b")


def neighbours(lists, percent):
    """Pairs of sets that are likely alike: that stand close to each other in the lists, or with a list's purest set.

    Each list is in the same order of sizes and digests, so that near copies have the
    same few neighbours in most of their lists. The purest set, with the fewest shingles
    of its own, is the text that a group of copies was made from, if it is there.
    """
    order, whole = W.partitionBy("shingle").orderBy("n", "sig").rowsBetween(-NEIGHBOURS, -1), W.partitionBy("shingle")
    around = lists.withColumns({
        "around": F.collect_list(F.struct("sig", "n", "most")).over(order),
        "purest": F.min(F.struct((F.col("n") - F.col("most")).alias("own"), "sig", "n", "most")).over(whole)})
    purest = F.struct("purest.sig", "purest.n", "purest.most")
    beside = around.withColumn("near", F.explode(F.array_union("around", F.array(purest)))).filter("sig <> near.sig").filter(
        may_be_alike((F.col("n"), F.col("most")), (F.col("near.n"), F.col("near.most")), percent)).select(
        F.greatest("sig", "near.sig").alias("a"), F.least("sig", "near.sig").alias("b"),
        F.greatest("n", "near.n").alias("na"), F.least("n", "near.n").alias("nb"))
    counted = beside.groupBy("a", "b", "na", "nb").agg(F.count("*").alias("lists"))
    return counted.filter(2 * F.col("lists") >= lists_needed(F.col("na"), F.col("nb"), percent)).select("a", "b")


def wanted_of(pairs, sets):
    """rank and body of the documents that stand for the sets of `pairs`."""
    ends = pairs.select(F.col("a").alias("sig")).unionAll(pairs.select(F.col("b").alias("sig"))).distinct()
    return ends.join(sets, "sig").select("rep.rank", "rep.body")


def near_duplicates(df, key="doc_id", text="text", percent=PERCENT):
    """key, body (digest of the text), n_shingles and component_id of every row of `df`.

    component_id is the smallest key of the documents that links lead to. A text without
    words, or NULL, has no shingles and is alone. Rows with a NULL key have a NULL
    component_id unless another document is linked to them. Repeated rows stay repeated.
    The result is a written table; what is staged on the way goes when it is done.
    """
    return finished(df.sparkSession, "near-duplicates", lambda: _near_duplicates(df, key, text, percent))


def _near_duplicates(df, key, text, percent):
    rows = staged(described(df, key, text, percent), "described")
    sets = staged(rows.filter("n > 0").groupBy("sig").agg(
        F.min(F.struct("rank", "body")).alias("rep"),
        F.min(F.when(F.col("rank") != NO_KEY, F.col("rank"))).alias("least"), F.max("n").alias("n"),
        F.min(F.when(F.col("n") <= MOST_LIGHT, F.col("first"))).alias("first")), "sets")
    counts = {r["n"]: r["c"] for r in sets.filter(F.col("n") <= 2 * MOST_LIGHT).groupBy("n").agg(F.count("*").alias("c")).collect()}
    light = boundary(counts, percent)
    least = -(-percent * (light + 1) // 100)
    small = light_links(sets, light, percent)
    lists = staged(shared_postings(postings(df, key, text, frequent(df, text), least, percent), percent), "lists")
    tried = staged(neighbours(lists, percent), "tried")
    whole = staged(whole_sets(df, key, text, wanted_of(tried, sets)), "whole")
    links = staged(verified(tried, whole, percent).unionAll(small).distinct(), "first-links")
    roots = components(links)
    left = staged(unjoined_pairs(lists, roots, light, percent).join(tried, ["a", "b"], "left_anti"), "left")
    rest = staged(whole_sets(df, key, text, wanted_of(left, sets)), "whole")
    more = staged(verified(left, rest, percent), "more-links")
    ended = components(links.unionAll(more).distinct())
    least_key = sets.select("sig", "least").join(ended.withColumnRenamed("node", "sig"), "sig").groupBy("root").agg(
        F.min("least").alias("component"))
    of_set = ended.join(least_key, "root").select(F.col("node").alias("sig"), "component")
    alone = sets.select("sig", F.col("least").alias("own"))
    named = alone.join(of_set, "sig", "left").select("sig", F.coalesce("component", "own").alias("component"))
    own = F.expr(f"nullif(rank, {NO_KEY})")
    return rows.select("rank", "body", "n", "sig").join(named, "sig", "left").select(
        own.alias(key), "body", F.col("n").alias("n_shingles"),
        F.when(F.col("n") > 0, F.coalesce("component", own)).otherwise(own).alias("component_id"))


def one_of_each(df, key="doc_id", text="text", percent=PERCENT):
    """The rows of `df` that are the first of their component; texts without words all stay.

    Rows without a key stay. Of rows that repeat key and text, all stay or all go.
    """
    found = near_duplicates(df, key, text, percent)
    gone = found.filter(F.col(key) != F.col("component_id")).select(F.col(key).alias("__key"), F.col("body").alias("__body")).distinct()
    body = F.xxhash64(F.coalesce(F.col(f"`{text}`"), F.lit("")))
    return df.join(gone, (F.col(f"`{key}`").cast("long") == F.col("__key")) & (body == F.col("__body")), "left_anti")
