"""Text dumps of web pages."""

from pyspark.sql import functions as F

from starloom.operators.sizing import small
from starloom.sources.lines import FILE, numbered, placed_lines


def page_lines(spark, path):
    """All lines of all dumps; their order is not needed to parse a table."""
    return spark.read.option("recursiveFileLookup", "true").text(path).select(
        F.col("value").alias("line")
    )


def table_lines(spark, path, mark="^h"):
    """The lines that belong to a table, told by the mark of an hour angle."""
    return page_lines(spark, path).filter(F.col("line").contains(mark))


def numbered_lines(spark, path):
    """Lines with their number in the page (from 1); a large page is read by many tasks."""
    return numbered(placed_lines(spark, path, label="pages")).select(
        F.col(FILE).alias("page"), "n", F.col("value").alias("line")
    )


def lines_through(lines, marker):
    """Each page up to and including its first line with `marker`; all of it if there is none."""
    ends = lines.filter(F.col("line").contains(marker)).groupBy("page").agg(
        F.min("n").alias("end")
    )
    return (
        lines.join(small(ends), "page", "left")
        .filter(F.col("end").isNull() | (F.col("n") <= F.col("end")))
        .drop("end")
    )
