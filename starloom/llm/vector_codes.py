"""Product codes of integer vectors, with codebooks from ball k-means.

Every vector is cut into equal parts, and each part position has its own codebook. The
parts that an entry holds are its ball. Only entries at most two radii away can take a
part from it: these are the entry's neighbours. Sorted by distance they cut the ball into
rings: a part in the stable core, nearer to its entry than half of the way to the first
neighbour, stays without a look at any other; a part in ring t is compared with the first
t neighbours only. A ball whose entry and neighbours all stood still keeps its parts
untouched. None of this is an approximation: what is skipped can't win.

Blocks of vectors carry their codes and their share of the new entries from round to
round, as tables in the shared folder. The driver sees one sum per entry and position.
All arithmetic is in integers; blocks with components too large for 64 bits use Python's.
"""

import hashlib
import math

import numpy as np
import pyarrow as pa
from pyspark.sql import functions as F
from pyspark.sql import types as T

from starloom.operators.sizing import small
from starloom.session import staging_path

PARTS, ENTRIES, ROUNDS, SCALE = 8, 16, 6, 4096
BLOCK_BYTES = 1 << 20  # of one block's vectors, as 32-bit integers
MOST_LONG = 2**63 - 1
_LIMB = 32


def integers(x, scale):
    """floor(scale * x) of finite doubles, as int64 where all of them fit."""
    if not len(x) or np.abs(x).max() < 2.0**61 / scale:
        return np.floor(x * scale).astype(np.int64)
    return np.array([math.floor(v * scale) if abs(v) < 2.0**53 else int(v) * scale for v in x.tolist()], object)


def packed(v):
    """Bytes of an integer array; `unpacked` reads them."""
    if v.dtype == object:
        return b"t" + ",".join(map(str, v.ravel())).encode()
    small_enough = not v.size or max(v.max(), -v.min()) < 2**31
    return b"i" + v.astype("<i4").tobytes() if small_enough else b"q" + v.astype("<i8").tobytes()


def unpacked(data, width):
    body = data[1:]
    if data[:1] == b"t":
        return np.array([int(x) for x in body.decode().split(",")], object).reshape(-1, width)
    return np.frombuffer(body, "<i4" if data[:1] == b"i" else "<i8").astype(np.int64).reshape(-1, width)


def _largest(v):
    return max(int(v.max()), -int(v.min())) if v.size else 0


def _distances(x, entry):
    d = x - entry
    return (d * d).sum(axis=1)


class Codebook:
    """The entries of all part positions, with what the search needs.

    `entries` has one integer array (entries, positions) per part; `radii` an upper bound
    of each ball's radius (None before the first round); `moved` tells which entries the
    last round changed.
    """

    def __init__(self, entries, radii=None, moved=None):
        self.entries, self.radii = entries, radii
        self.order, self.gaps, self.stable = [], [], []
        for p, entry in enumerate(entries):
            orders, gaps, stable = [], [], []
            wide = entry.astype(object)
            for i in range(len(entry) if radii is not None else 0):
                apart = _distances(wide, wide[i])
                near = [j for j in range(len(entry)) if j != i and _reaches(apart[j], radii[p][i])]
                near.sort(key=lambda j: (apart[j], j))
                orders.append(near)
                gaps.append([apart[j] for j in near])
                stable.append(moved is not None and not moved[p][i] and not any(moved[p][j] for j in near))
            self.order.append(orders)
            self.gaps.append(gaps)
            self.stable.append(stable)

    def digest(self):
        text = ",".join(str(int(x)) for part in self.entries for x in part.ravel())
        return hashlib.sha256(text.encode()).hexdigest()


def _reaches(apart, radius):
    """Whether an entry at squared distance `apart` may take a part of a ball of this radius."""
    try:
        return float(apart) <= 4 * radius * radius * (1 + 1e-9) + 1
    except OverflowError:
        return True


def _root(x):
    """At least the square root of an integer, as a double."""
    try:
        return math.sqrt(x) * (1 + 1e-12)
    except OverflowError:
        return math.inf


def assigned(v, codes, book, every=False):
    """(codes, squared distances, visits) of the parts of all vectors in `v`.

    Without `codes` every entry is tried. Equal distances go to the lower index. With
    `every`, distances of untouched balls are worked out too; else they are -1. `visits`
    counts the distances that were needed.
    """
    n, parts = len(v), len(book.entries)
    width = v.shape[1] // parts
    most = max([_largest(v)] + [_largest(e) for e in book.entries])
    kind = np.int64 if v.dtype != object and 16 * width * most * most < 2**63 else object
    v = v.astype(kind)
    out, far, visits = np.zeros((n, parts), np.uint8), np.full((n, parts), -1, kind), 0
    for p in range(parts):
        x, entries = v[:, p * width : (p + 1) * width], book.entries[p].astype(kind)
        if codes is None:
            best, code = _distances(x, entries[0]), np.zeros(n, np.uint8)
            for j in range(1, len(entries)):
                d = _distances(x, entries[j])
                nearer = (d < best).astype(bool)
                best[nearer], code[nearer] = d[nearer], j
            visits += n * len(entries)
            out[:, p], far[:, p] = code, best
            continue
        out[:, p] = codes[:, p]
        for i in range(len(entries)):
            members = np.flatnonzero(codes[:, p] == i)
            if not len(members) or (book.stable[p][i] and not every):
                continue
            mine = x[members]
            best, code = _distances(mine, entries[i]), np.full(len(members), i, np.uint8)
            visits += len(members)
            if not book.stable[p][i]:
                # A neighbour at exactly twice the distance may tie, so the core is open.
                ring = np.searchsorted(np.array(book.gaps[p][i], kind), 4 * best, side="right")
                for t, j in enumerate(book.order[p][i][: ring.max()]):
                    tried = np.flatnonzero(ring > t)
                    d = _distances(mine[tried], entries[j])
                    visits += len(tried)
                    wins = ((d < best[tried]) | ((d == best[tried]) & (j < code[tried]))).astype(bool)
                    best[tried[wins]], code[tried[wins]] = d[wins], j
            out[members, p], far[members, p] = code, best
    return out, far, visits


def shares(v, codes, far, entries):
    """(sums, radii) of a block: per part and entry a count and the sums of its positions, and its radius."""
    n, parts = codes.shape
    width = v.shape[1] // parts
    sums, radii = [], []
    for p in range(parts):
        code = codes[:, p].astype(np.int64)
        counts = np.bincount(code, minlength=entries)
        table = np.zeros((entries, width), object)
        for d in range(width):
            column = v[:, p * width + d]
            if column.dtype != object and n * _largest(column) < 2**53:
                table[:, d] = np.bincount(code, weights=column, minlength=entries).astype(np.int64).tolist()
            else:
                np.add.at(table[:, d], code, column.astype(object))
        known = np.array([_root(max(x, 0)) for x in far[:, p].tolist()])
        radius = np.zeros(entries)
        np.maximum.at(radius, code, known)
        sums += [x for i in range(entries) for x in (int(counts[i]), *map(int, table[i]))]
        radii += radius.tolist()
    return sums, radii


def limbs(values):
    """The integers as lists of their 32-bit limbs, lowest first; the last ones carry the sign."""
    out = []
    while not out or any(values):
        last = all(-(2**31) <= x < 2**31 for x in values)
        out.append([x if last else x & (2**_LIMB - 1) for x in values])
        if last:
            break
        values = [x >> _LIMB for x in values]
    return out


def usable(df, key, vector, label, parts=PARTS):
    """id, label and v (array of doubles) of the rows that take part.

    NULL vectors, those with NULL or non-finite components, and those that can't be cut
    into equal parts take none.
    """
    v = F.col(f"`{vector}`").cast("array<double>")
    rows = df.select(F.col(f"`{key}`").alias("id"), F.col(f"`{label}`").alias("label"), v.alias("v"))
    finite = F.forall("v", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(math.inf)))
    return rows.filter(F.col("v").isNotNull() & (F.size("v") > 0) & (F.size("v") % parts == 0) & finite)


def _block_schema(rows):
    return (T.StructType().add("ids", T.ArrayType(rows.schema["id"].dataType)).add("labels", T.ArrayType(rows.schema["label"].dataType))
            .add("vectors", "binary").add("codes", "binary")
            .add("sums", T.ArrayType(T.ArrayType(T.LongType()))).add("radii", T.ArrayType(T.DoubleType())))


def _lists(column, size):
    return pa.ListArray.from_arrays(pa.array([0, size], pa.int32()), column)


def first_blocks(rows, book, width, scale):
    """Blocks of the rows of `usable`, with their first codes."""
    most = max(1, BLOCK_BYTES // (4 * width))

    def run(batches):
        for batch in batches:
            for at in range(0, batch.num_rows, most):
                part = batch.slice(at, most)
                column = part.column("v")
                flat = column.flatten().to_numpy(zero_copy_only=False).astype(np.float64)
                v = integers(flat, scale).reshape(-1, width)
                yield _block(part.column("id"), part.column("label"), v, None, book)

    return rows.mapInArrow(run, _block_schema(rows))


def _block(ids, labels, v, codes, book):
    codes, far, _ = assigned(v, codes, book)
    sums, radii = shares(v, codes, far, len(book.entries[0]))
    n = len(v)
    return pa.RecordBatch.from_arrays(
        [_lists(ids, n), _lists(labels, n), pa.array([packed(v)], pa.binary()), pa.array([codes.tobytes()], pa.binary()),
         pa.array([limbs(sums)], pa.list_(pa.list_(pa.int64()))), pa.array([radii], pa.list_(pa.float64()))],
        names=["ids", "labels", "vectors", "codes", "sums", "radii"])


def next_blocks(blocks, book, width):
    """The same blocks with the codes that `book` gives."""
    parts = len(book.entries)

    def run(batches):
        for batch in batches:
            for r in range(batch.num_rows):
                v = unpacked(batch.column("vectors")[r].as_py(), width)
                codes = np.frombuffer(batch.column("codes")[r].as_py(), np.uint8).reshape(-1, parts)
                yield _block(batch.column("ids")[r].values, batch.column("labels")[r].values, v, codes, book)

    return blocks.select("ids", "labels", "vectors", "codes", "sums", "radii").mapInArrow(run, blocks.schema)


def moved_on(blocks, book):
    """The codebook of the next round, from the blocks' shares; the driver gets one row per sum."""
    parts, (entries, width) = len(book.entries), book.entries[0].shape
    sums = [0] * (parts * entries * (width + 1))
    each = blocks.select(F.posexplode("sums").alias("limb", "values")).select("limb", F.posexplode("values").alias("slot", "value"))
    for r in each.groupBy("limb", "slot").agg(F.sum("value").alias("s")).collect():
        sums[r["slot"]] += r["s"] << (_LIMB * r["limb"])
    radii = [0.0] * (parts * entries)
    for r in blocks.select(F.posexplode("radii").alias("slot", "r")).groupBy("slot").agg(F.max("r").alias("r")).collect():
        radii[r["slot"]] = r["r"]
    new, bounds, moved = [], [], []
    for p in range(parts):
        table, bound, went = [], [], []
        for i in range(entries):
            at = (p * entries + i) * (width + 1)
            old = [int(x) for x in book.entries[p][i]]
            count = sums[at]
            entry = [s // count for s in sums[at + 1 : at + 1 + width]] if count else old
            radius = radii[p * entries + i]
            if book.radii is not None and book.stable[p][i]:
                radius = max(radius, book.radii[p][i])
            went.append(entry != old)
            bound.append((radius + _root(sum((a - b) ** 2 for a, b in zip(entry, old)))) * (1 + 1e-12))
            table.append(entry)
        new.append(np.array(table, object))
        bounds.append(bound)
        moved.append(went)
    return Codebook(new, bounds, moved)


def coded(blocks, book, width, id_type, label_type):
    """id, label, code and error of every vector, by the last codebook."""
    parts = len(book.entries)
    schema = T.StructType().add("id", id_type).add("label", label_type).add("code", "string").add("error", "long")

    def run(batches):
        for batch in batches:
            for r in range(batch.num_rows):
                v = unpacked(batch.column("vectors")[r].as_py(), width)
                before = np.frombuffer(batch.column("codes")[r].as_py(), np.uint8).reshape(-1, parts)
                codes, far, _ = assigned(v, before, book, every=True)
                errors = [min(sum(row), MOST_LONG) for row in far.tolist()]
                yield pa.RecordBatch.from_arrays(
                    [batch.column("ids")[r].values, batch.column("labels")[r].values,
                     pa.array([c.tobytes().hex() for c in codes], pa.string()), pa.array(errors, pa.int64())],
                    names=["id", "label", "code", "error"])

    return blocks.select("ids", "labels", "vectors", "codes").mapInArrow(run, schema)


def _drop(spark, path):
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    target.getFileSystem(spark._jsc.hadoopConfiguration()).delete(target, True)


def quantised(df, key="vec_id", vector="embedding", label="label", parts=PARTS, entries=ENTRIES, rounds=ROUNDS, scale=SCALE):
    """id, label, code, error, label_error and codebooks_sha256 of the vectors of `df`.

    Component x counts as floor(scale * x). The entries start as the parts of the vectors
    with the smallest keys (NULL keys last; of rows with equal keys those with the smaller
    vector). `error` is the squared distance from the entries, `label_error` its sum over
    the rows of a label, NULL labels together; what passes a long is given as the largest
    long. Repeated rows each count. All vectors that take part have the length of the one
    with the smallest key; others are left out like those that `usable` leaves out. With
    fewer vectors than entries there are fewer entries; without any, no rows.
    """
    spark = df.sparkSession
    rows = usable(df, key, vector, label, parts)
    order = [F.col("id").asc_nulls_last(), "v", "label"]
    head = rows.orderBy(*order).limit(1).collect()
    id_type, label_type = rows.schema["id"].dataType, rows.schema["label"].dataType
    if not head:
        empty = T.StructType().add("id", id_type).add("label", label_type).add("code", "string").add("error", "long")
        return spark.createDataFrame([], empty.add("label_error", "long").add("codebooks_sha256", "string"))
    size = len(head[0]["v"])
    rows = rows.filter(F.size("v") == size)
    # At most `entries` vectors come to the driver.
    seeds = np.array([integers(np.array(r["v"], np.float64), scale).astype(object) for r in rows.orderBy(*order).limit(entries).collect()])
    width = size // parts
    book = Codebook([seeds[:, p * width : (p + 1) * width] for p in range(parts)])
    blocks, path = first_blocks(rows, book, size, scale), None
    for n in range(rounds):
        before, path = path, staging_path(spark, "blocks")
        (blocks if n == 0 else next_blocks(blocks, book, size)).write.parquet(path)
        blocks = spark.read.schema(_block_schema(rows)).parquet(path)
        if before:
            _drop(spark, before)
        book = moved_on(blocks, book)
    # The codes are a small table; the blocks they come from go.
    last = staging_path(spark, "codes")
    coded(blocks, book, size, id_type, label_type).write.parquet(last)
    if path:
        _drop(spark, path)
    codes = spark.read.parquet(last)
    totals = codes.groupBy("label").agg(F.sum(F.col("error").cast("decimal(38,0)")).alias("total")).select(
        F.col("label").alias("__label"), F.least("total", F.lit(MOST_LONG).cast("decimal(38,0)")).cast("long").alias("label_error"))
    return codes.join(small(totals), F.col("label").eqNullSafe(F.col("__label")), "left").select(
        "id", "label", "code", "error", "label_error", F.lit(book.digest()).alias("codebooks_sha256"))
