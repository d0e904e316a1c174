"""Exact top-k inner products from sorted lists, read in order only.

Vectors become integers. A slab of candidates keeps one list per dimension, sorted by
that component; for a query, each list is read from the end where its products are
largest, to growing depths. What has been read of a candidate, with the best or the worst
product that the unread part of each list can still hold, gives an upper and a lower bound
of its score. The k-th best lower bound is the bar: candidates whose upper bound is below
it can't qualify any more. Reading stops when few are left, or at the ends of the lists,
where bounds are exact; the scores of what is left are then resolved.

Slabs and groups of queries have a fixed number of rows and meet in a grouped join, so
a task never holds more than one of each.
"""

import numpy as np
import pyarrow as pa
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from starloom.llm.vector_codes import integers
from starloom.session import staged

SLAB_ROWS = 2048
QUERY_ROWS = 4096
DEPTHS = (1 / 4, 1 / 2, 5 / 8, 3 / 4, 7 / 8, 1)  # parts of the lists read before bounds are compared
FEW = 4  # so many times k candidates are simply resolved
QUERY_BATCH = 256
SCALE = 1024
MOST_LONG = 2**63 - 1


def finite_vectors(df, key, vector):
    """id and v (array of doubles) of the rows that take part, repeated rows and keys included.

    NULL vectors, vectors with NULL or non-finite components, and NULL keys take no part.
    """
    v = F.col(f"`{vector}`").cast("array<double>")
    rows = df.select(F.col(f"`{key}`").cast("long").alias("id"), v.alias("v"))
    finite = F.forall("v", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf"))))
    return rows.filter(F.col("id").isNotNull() & F.col("v").isNotNull() & finite)


def _matrix(column, width, scale):
    """Vectors as integer rows of one array; shorter ones end with zeros."""
    lists = column.combine_chunks()
    lists = lists.chunk(0) if isinstance(lists, pa.ChunkedArray) else lists
    sizes = np.diff(lists.offsets.to_numpy())
    flat = integers(lists.flatten().to_numpy(zero_copy_only=False).astype(np.float64), scale)
    if len(sizes) and (sizes == width).all():
        return flat.reshape(len(sizes), width)
    out = np.zeros((len(sizes), width), flat.dtype)
    for i, (a, n) in enumerate(zip(np.cumsum([0, *sizes]), sizes)):
        out[i, :n] = flat[a : a + n]
    return out


def products(vectors, query):
    """Exact inner products: in 64 bits where they fit, in Python's integers else."""
    most = (int(np.abs(vectors).max(initial=0)) * int(np.abs(query).max(initial=0)) * max(1, len(query))) if vectors.size else 0
    if vectors.dtype == object or query.dtype == object or most >= 2**63:
        return (vectors.astype(object) * query.astype(object)).sum(axis=1) if vectors.shape[1] else np.zeros(len(vectors), object)
    return vectors @ query


class SortedLists:
    """One list per dimension over a slab of integer vectors, read from either end.

    With the lists read to some depth, a candidate's bound is a product of the query
    with what is known of the candidate: the components that have been read, and for
    the others the last value read (upper bound) or the end of the list (lower bound).
    Which end counts depends on the sign of the query's component only, so the bounds
    of many queries are two matrix products.
    """

    def __init__(self, ids, vectors):
        order = np.argsort(ids, kind="stable")
        self.ids, self.vectors = ids[order], vectors[order]
        n = len(ids)
        up = np.argsort(self.vectors, axis=0, kind="stable")
        self.rank = np.empty_like(up)
        np.put_along_axis(self.rank, up, np.broadcast_to(np.arange(n)[:, None], up.shape), axis=0)
        self.sorted = np.take_along_axis(self.vectors, up, axis=0)
        self.most = int(np.abs(self.vectors).max(initial=0))

    def _read_to(self, depth):
        """Known values with unread ones replaced: for upper and lower bounds, from the high and the low end."""
        n = len(self.ids)
        high, low = self.rank >= n - depth, self.rank < depth
        v, ends = self.vectors, self.sorted
        return (np.where(high, v, ends[n - depth]).astype(float), np.where(low, v, ends[depth - 1]).astype(float),
                np.where(high, v, ends[0]).astype(float), np.where(low, v, ends[-1]).astype(float))

    def _bounds(self, queries):
        """Upper and lower bounds at each depth, one after the other, for the columns asked for."""
        rise, fall = np.maximum(queries, 0).T.astype(float), np.minimum(queries, 0).T.astype(float)
        for part in DEPTHS:
            high, low, worst_high, worst_low = self._read_to(max(1, int(len(self.ids) * part)))
            yield lambda wide, h=high, w=low, x=worst_high, y=worst_low: (
                h @ rise[:, wide] + w @ fall[:, wide], x @ rise[:, wide] + y @ fall[:, wide])

    def best(self, queries, skips, k):
        """For each query (ids, scores) of the k largest inner products, ties to smaller ids.

        `skips` holds for each query the id that is no candidate.
        """
        n = len(self.ids)
        found = [None] * len(queries)
        for start in range(0, len(queries), QUERY_BATCH):
            part = queries[start : start + QUERY_BATCH]
            alive = [np.flatnonzero(self.ids != skip) for skip in skips[start : start + QUERY_BATCH]]
            # Numbers that doubles can't hold have no bounds.
            wide = list(range(len(part))) if n > FEW * k and self._fits_doubles(part) else []
            slack = [1e-9 * (float(np.abs(q).sum()) * max(1.0, self.most) + 1.0) for q in part] if wide else []
            for bounds_of in self._bounds(part) if wide else ():
                upper, lower = bounds_of(wide)
                again = []
                for column, one in enumerate(wide):
                    left = alive[one]
                    bar = np.partition(lower[left, column], -k)[-k]
                    alive[one] = left[upper[left, column] >= bar - slack[one]]
                    if len(alive[one]) > FEW * k:
                        again.append(one)
                wide = again
                if not wide:
                    break
            for one, left in enumerate(alive):
                scores = products(self.vectors[left], part[one])
                order = sorted(range(len(left)), key=lambda i: (-int(scores[i]), self.ids[left[i]]))[:k] if scores.dtype == object \
                    else np.lexsort((self.ids[left], -scores))[:k]
                found[start + one] = (self.ids[left][order], scores[order])
        return found

    def _fits_doubles(self, queries):
        most = int(np.abs(queries).max(initial=0))
        return self.most * most * max(1, self.vectors.shape[1]) < 2.0**1000 if self.most < 2.0**1000 and most < 2**1000 else False


def top_k(vectors, queries, k=10, slab_rows=SLAB_ROWS, query_rows=QUERY_ROWS, scale=SCALE):
    """query_id, rank, vec_id, score: the k best candidates of each query.

    Both inputs come from `finite_vectors`; component x counts as floor(scale * x). Rows
    with the query's id are its own and no candidates; all others are, rows that share an
    id included. Each query row has its result, repeated ones too. Scores are compared
    exactly; one beyond a long is given as the nearest long. Fewer than k candidates give
    fewer rows; an empty table gives none.
    """
    sizes = vectors.agg(F.count("*").alias("n"), F.max(F.size("v")).alias("w")).first()
    # Each distinct query is asked once, under a number that is written with it.
    distinct = queries.groupBy("id", "v").agg(F.count("*").alias("copies"))
    asked_rows = staged(distinct.withColumn("q", F.monotonically_increasing_id()), "queries")
    asked = asked_rows.agg(F.count("*").alias("n"), F.max(F.size("v")).alias("w")).first()
    slabs = max(1, -(-sizes["n"] // slab_rows))
    groups = max(1, -(-asked["n"] // query_rows))
    width = max(sizes["w"] or 0, asked["w"] or 0)
    # Rows of one vector and id are dealt out by their turn as well.
    own = F.pmod(F.xxhash64("id", F.monotonically_increasing_id()), F.lit(slabs)).cast("int")
    group = F.pmod(F.xxhash64("q"), F.lit(groups)).cast("int")
    left = vectors.select("id", "v", own.alias("slab"),
                          F.explode(F.sequence(F.lit(0), F.lit(groups - 1))).alias("group"))
    right = asked_rows.select("id", "v", "q", "copies", group.alias("group"),
                              F.explode(F.sequence(F.lit(0), F.lit(slabs - 1))).alias("slab"))
    names = ["q", "query_id", "copies", "vec_id", "rough", "score"]

    def run(candidates, asked):
        rows = []
        if candidates.num_rows and asked.num_rows:
            lists = SortedLists(candidates.column("id").to_numpy(), _matrix(candidates.column("v"), width, scale))
            asking = [asked.column(c).to_pylist() for c in ("q", "id", "copies")]
            for q, one, copies, (ids, scores) in zip(*asking, lists.best(_matrix(asked.column("v"), width, scale), asking[1], k)):
                rows += [(q, one, copies, int(i), max(-MOST_LONG - 1, min(MOST_LONG, int(s))), f"{int(s):d}") for i, s in zip(ids, scores)]
        kinds = [pa.int64()] * 5 + [pa.string()]
        columns = list(zip(*rows)) or [()] * 6
        return pa.table([pa.array(c, kind) for c, kind in zip(columns, kinds)], names=names)

    parts = left.groupBy("slab", "group").cogroup(right.groupBy("slab", "group")).applyInArrow(
        run, "q bigint, query_id bigint, copies bigint, vec_id bigint, rough bigint, score string")
    # Beyond a long the digits tell: by sign, length, then text.
    size = F.length("score")
    beyond = F.when(F.col("rough") == MOST_LONG, size).when(F.col("rough") == F.lit(-MOST_LONG - 1), -size).otherwise(0)
    digits = [F.when(F.col("rough") == MOST_LONG, F.col("score")).desc_nulls_last(),
              F.when(F.col("rough") == F.lit(-MOST_LONG - 1), F.col("score")).asc_nulls_last()]
    order = W.partitionBy("q").orderBy(F.desc("rough"), beyond.desc(), *digits, "vec_id")
    best = parts.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k)
    each = best.withColumn("copy", F.explode(F.sequence(F.lit(1).cast("long"), F.col("copies"))))
    return each.select("query_id", "rank", "vec_id", F.col("rough").alias("score"))
