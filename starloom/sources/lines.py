"""Lines of text files in their order, with each file read by as many tasks as it has blocks.

A line's place is the block of its file and its turn in that block. Numbers and running
totals over a whole file come from one small row per block, so no file has to be one row
or one task; a window holds one block at most.
"""

from pyspark.sql import Window
from pyspark.sql import functions as F

from starloom.operators.sizing import small
from starloom.session import staged

FILE, BLOCK, TURN = "_file", "_block", "_turn"


def placed_lines(spark, path, line_sep=None, label="lines"):
    """All lines below a folder as (_file, _block, _turn, value), staged; `line_sep` ends a line."""
    reader = spark.read.option("recursiveFileLookup", "true")
    if line_sep:
        reader = reader.option("lineSep", line_sep)
    rows = reader.text(path).select(
        F.col("_metadata.file_path").alias(FILE),
        F.col("_metadata.file_block_start").alias(BLOCK),
        F.monotonically_increasing_id().alias(TURN),
        "value",
    )
    return staged(rows, label)


def running(placed, value, name):
    """Adds the sum of `value` over all lines of the file up to and including each one."""
    inside = Window.partitionBy(FILE, BLOCK).orderBy(TURN).rowsBetween(Window.unboundedPreceding, 0)
    blocks = placed.groupBy(FILE, BLOCK).agg(F.sum(value).alias("_sum"))
    before = Window.partitionBy(FILE).orderBy(BLOCK).rowsBetween(Window.unboundedPreceding, -1)
    blocks = blocks.select(FILE, BLOCK, F.coalesce(F.sum("_sum").over(before), F.lit(0)).alias("_shift"))
    summed = placed.withColumn(name, F.sum(value).over(inside)).join(small(blocks), [FILE, BLOCK])
    return summed.withColumn(name, F.col(name) + F.col("_shift")).drop("_shift")


def numbered(placed):
    """Adds `n`, the number of each line in its file, from 1."""
    blocks = placed.groupBy(FILE, BLOCK).agg(F.min(TURN).alias("_first"), F.count("*").alias("_n"))
    before = Window.partitionBy(FILE).orderBy(BLOCK).rowsBetween(Window.unboundedPreceding, -1)
    shift = F.coalesce(F.sum("_n").over(before), F.lit(0)) - F.col("_first") + 1
    # A block's lines are read one after the other, so their turns have no gaps.
    blocks = blocks.select(FILE, BLOCK, shift.alias("_shift"))
    return placed.join(small(blocks), [FILE, BLOCK]).withColumn("n", F.col(TURN) + F.col("_shift")).drop("_shift")
