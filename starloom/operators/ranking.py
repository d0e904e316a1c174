"""Global order, positions, slices and running totals without a one-task window.

`arrange` range-partitions and sorts the rows once and stages them together with
the partition (`_part`) and the place in it (`_slot`). Everything else works from
one small row per partition: its count, or its sum, shifted by those before it.
The order should end with a unique column, so that no run of equal rows has to
share a partition.
"""

from pyspark.sql import Window
from pyspark.sql import functions as F

from starloom.operators.sizing import small
from starloom.session import staged

PART, SLOT = "_part", "_slot"
BEFORE = (Window.unboundedPreceding, -1)


def arrange(df, *order, label="arranged"):
    """Rows in global order, staged, with partition and place."""
    tag = F.col("_tag")
    laid = (
        df.repartitionByRange(*order)
        .sortWithinPartitions(*order)
        .withColumn("_tag", F.monotonically_increasing_id())
        .withColumns(
            {
                PART: F.shiftright(tag, 33).cast("long"),
                SLOT: tag.bitwiseAND(F.lit((1 << 33) - 1)),
            }
        )
        .drop("_tag")
    )
    return staged(laid, label)


def _attach(rows, blocks, by):
    """Joins one row per (group, partition) back to the rows."""
    blocks = blocks.withColumnsRenamed({n: f"_b{n}" for n in (*by, PART)})
    condition = rows[PART] == blocks[f"_b{PART}"]
    for n in by:
        condition = condition & rows[n].eqNullSafe(blocks[f"_b{n}"])
    # Without groups there is one row per shuffle partition, a number set by configuration.
    side = small(blocks) if by else F.broadcast(blocks)
    return rows.join(side, condition).drop(*[f"_b{n}" for n in (*by, PART)])


def positions(arranged, by=()):
    """Adds `position` (from 0) and `total`, over all rows or within each group of `by`.

    `by` has to be the leading part of the order the rows were arranged in.
    """
    blocks = arranged.groupBy(*by, PART).agg(
        F.min(SLOT).alias("_first"), F.count(F.lit(1)).alias("_n")
    )
    whole = Window.partitionBy(*by)
    blocks = blocks.select(
        *by,
        PART,
        (
            F.coalesce(F.sum("_n").over(whole.orderBy(PART).rowsBetween(*BEFORE)), F.lit(0))
            - F.col("_first")
        ).alias("_shift"),
        F.sum("_n").over(whole).alias("total"),
    )
    return (
        _attach(arranged, blocks, by)
        .withColumn("position", F.col(SLOT) + F.col("_shift"))
        .drop("_shift", PART, SLOT)
    )


def slice_of(position, total, slices):
    """Slice i holds the positions from i*total div slices up to (i+1)*total div slices."""
    n = F.lit(slices).cast("long")
    numerator = (F.col(position) + 1) * n + F.col(total) - 1
    return (F.call_function("div", numerator, F.col(total)) - 1).cast("int")


def sliced(df, order, key, slices, by=(), label="slices"):
    """`df` in global order with `position`, `total` and `slice`."""
    placed = positions(arrange(df, *by, *order, *key, label=label), by)
    return placed.withColumn("slice", slice_of("position", "total", slices))


def running_total(df, order, value, name="running"):
    """Sum of `value` over all rows up to and including each one, in `order`."""
    rows = arrange(df, *order, label="running")
    inside = Window.partitionBy(PART).orderBy(SLOT).rowsBetween(Window.unboundedPreceding, 0)
    blocks = rows.groupBy(PART).agg(F.sum(value).alias("_sum"))
    across = Window.orderBy(PART).rowsBetween(*BEFORE)
    blocks = blocks.select(
        PART, F.coalesce(F.sum("_sum").over(across), F.lit(0)).alias("_shift")
    )
    return (
        _attach(rows.withColumn(name, F.sum(value).over(inside)), blocks, ())
        .withColumn(name, F.col(name) + F.col("_shift"))
        .drop("_shift", PART, SLOT)
    )


def islands(df, order, key, name="island"):
    """Numbers the runs of equal `key` in `order`, from 1."""
    rows = arrange(df, *order, label="islands")
    inside = Window.partitionBy(PART).orderBy(SLOT)
    ends = rows.groupBy(PART).agg(F.max_by(F.struct(key), SLOT).alias("_last"))
    ends = ends.select(PART, F.lag("_last").over(Window.orderBy(PART)).alias("_previous"))
    seen = F.coalesce(F.lag(F.struct(key)).over(inside), F.col("_previous"))
    marked = _attach(rows, ends, ()).withColumn(
        "_new", (~seen.eqNullSafe(F.struct(key))).cast("long")
    )
    blocks = marked.groupBy(PART).agg(F.sum("_new").alias("_sum"))
    blocks = blocks.select(
        PART,
        F.coalesce(
            F.sum("_sum").over(Window.orderBy(PART).rowsBetween(*BEFORE)), F.lit(0)
        ).alias("_shift"),
    )
    running = inside.rowsBetween(Window.unboundedPreceding, 0)
    return (
        _attach(marked.withColumn(name, F.sum("_new").over(running)), blocks, ())
        .withColumn(name, F.col(name) + F.col("_shift"))
        .drop("_shift", "_previous", PART, SLOT)
        .withColumn("changed", F.col("_new") == 1)
        .drop("_new")
    )


def median(df, value):
    """Exact median as a one-row DataFrame.

    Works on the counts of distinct values, so a value that many rows share
    costs no more than any other.
    """
    counts = df.filter(F.col(value).isNotNull()).groupBy(value).agg(F.count("*").alias("_n"))
    ranked = running_total(counts, [value], "_n", "_upto")
    total = ranked.select(F.sum("_n")).scalar()
    low, high = F.expr("(_total - 1) div 2"), F.expr("_total div 2")
    ranked = ranked.withColumn("_total", total)
    start, end = F.col("_upto") - F.col("_n"), F.col("_upto")
    hit = F.when((start <= low) & (low < end), 1).otherwise(0) + F.when(
        (start <= high) & (high < end), 1
    ).otherwise(0)
    return ranked.agg((F.sum(F.col(value) * hit) / F.lit(2.0)).alias("median"))


def lowest_and_highest(df, order, n):
    """The `n` first and `n` last rows in `order` (column names), with `side`."""
    low = df.orderBy(*order).limit(n).withColumn("side", F.lit("low"))
    high = df.orderBy(*[F.desc(c) for c in order]).limit(n).withColumn("side", F.lit("high"))
    return low.unionByName(high)


def head_and_tail(placed, n):
    """The first and last `n` rows of a ranked set."""
    position, total = F.col("position"), F.col("total")
    return placed.filter((position < n) | (position >= total - n))
