"""Array files: one row per line, between a prefix and a closing bracket."""

from pyspark.sql import functions as F

from starloom import fixed
from starloom.functions.rounding import fixed_text, number_text
from starloom.functions.text import array_text, quoted
from starloom.operators.ranking import arrange, positions, sliced
from starloom.session import staging


def framed(row, first, last, name):
    """A line of an array file, with the file's start and end on its first and last row."""
    start = F.when(first, F.lit(f"var {name} = [")).otherwise(F.lit(" "))
    end = F.when(last, F.lit("]")).otherwise(F.lit(","))
    return F.concat(start, row, end)


def slice_lines(placed, fields, name="data"):
    """Lines of the slice files of a set that has `slice`, `position` and `total`."""
    row = array_text([number_text(f) for f in fields])
    n = F.lit(fixed.SLICES_PER_SET)

    def slice_at(offset):
        numerator = (F.col("position") + offset + 1) * n + F.col("total") - 1
        return F.call_function("div", numerator, F.col("total")) - 1

    first = (F.col("position") == 0) | (slice_at(-1) != F.col("slice"))
    last = (F.col("position") == F.col("total") - 1) | (slice_at(1) != F.col("slice"))
    return placed.withColumn("line", framed(row, first, last, name))


def write_slices(df, order, key, fields, path, by=(), name="data"):
    """The set as 100 array files in global order, `path/[by=.../]slice=i`.

    The rows are dealt out by slice and position, so a slice of any size is written by as
    many tasks as its rows need; the parts of a slice, in the order of their names, are
    the array file. Returns the ranked rows.
    """
    placed = sliced(df, order, key, fixed.SLICES_PER_SET, by)
    lines = slice_lines(placed, fields, name).select(*by, "slice", "position", "line")
    (
        lines.repartitionByRange(*by, "slice", "position")
        .sortWithinPartitions(*by, "slice", "position")
        .drop("position")
        .write.mode("overwrite")
        .partitionBy(*by, "slice")
        .text(path)
    )
    return placed


def mixed_row(df, fields):
    """Numbers with one decimal, text in quotes."""
    types = dict(df.dtypes)
    return array_text(
        [
            quoted(f) if types[f] == "string" else F.coalesce(fixed_text(f, 1), F.lit("null"))
            for f in fields
        ]
    )


def array_lines(df, fields, order, name):
    """Ordered lines of one array file, as (position, line)."""
    placed = positions(arrange(df.select(*dict.fromkeys((*fields, *order))), *order, label="array"))
    row = mixed_row(placed, fields)
    first, last = F.col("position") == 0, F.col("position") == F.col("total") - 1
    return placed.select("position", framed(row, first, last, name).alias("line"))


def write_array(df, fields, order, name, path, parts=1):
    """One array file, or `parts` files that make one in the order of their names."""
    with staging(df.sparkSession):
        lines = array_lines(df, fields, order, name).repartitionByRange(parts, "position")
        lines.sortWithinPartitions("position").select("line").write.mode("overwrite").text(path)
