"""Connected components of a table of links, by alternating stars."""

from pyspark.sql import functions as F

from starloom.session import staged


def _smallest(edges):
    """Each edge (v, u) with m, the smallest of v and its neighbours.

    The complement as key keeps the aggregate's partitioning out of the join, so that
    adaptive execution can split the edges of a node that very many have.
    """
    least = edges.groupBy("v").agg(F.least(F.col("v"), F.min("u")).alias("m")).select(F.bitwise_not("v").alias("other"), "m")
    return edges.join(least, F.bitwise_not("v") == F.col("other")).drop("other")


def components(links, most_rounds=60):
    """node, root for every node of `links` (a, b: bigint); the root is the smallest node reachable.

    Each round links every node to the smallest of its neighbourhood, first those above
    it, then those below; the rounds grow with the logarithm of the longest path. The
    links stay in tables; the driver only sees their number and a checksum.
    """
    pairs = links.filter("a <> b").select(F.greatest("a", "b").alias("v"), F.least("a", "b").alias("u")).distinct()
    pairs, before = staged(pairs, "links"), None
    for _ in range(most_rounds):
        both = pairs.unionAll(pairs.select(F.col("u").alias("v"), F.col("v").alias("u")))
        upward = _smallest(both).filter("u > v").select(F.col("u").alias("v"), F.col("m").alias("u"))
        large = upward.filter("u <> v").distinct()
        lower = _smallest(large)
        small = lower.select("u", "m").unionAll(lower.select("v", "m")).toDF("v", "u").filter("u <> v")
        pairs = staged(small.distinct(), "links")
        now = pairs.agg(F.count("*"), F.sum(F.xxhash64("v", "u").cast("decimal(38,0)"))).first()
        if now == before:
            break
        before = now
    else:
        raise RuntimeError("the links did not settle")
    roots = pairs.select(F.col("v").alias("node"), F.col("u").alias("root"))
    return roots.unionAll(pairs.select(F.col("u").alias("node"), F.col("u").alias("root")).distinct())
