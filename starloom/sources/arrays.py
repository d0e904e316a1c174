"""Published array files (`var name = [[...],...]`) back to rows."""

from pyspark.sql import functions as F

from starloom.sources.lines import BLOCK, FILE, TURN, placed_lines, running

# A row: brackets around anything but brackets, which may stand in quoted text.
ROW = r'\[(?:[^\[\]"]|"(?:\\.|[^"\\])*")*\]'
BETWEEN = r"^\s*(?:var\s+\w+\s*=)?[\[\],;\s]*$"


def array_rows(spark, path, schema, wrapped=False):
    """Rows of array files, cast to `schema`.

    Files whose rows don't span lines are read line by line; a line that is something else
    is an error. `wrapped=True` reads files whose rows may span lines or share one: there
    a record ends at a closing bracket. Either way a large file is split over tasks.
    """
    texts = _wrapped_rows(spark, path) if wrapped else _line_rows(spark, path)
    rows = texts.select(F.from_json("text", "array<string>").alias("row")).filter(F.size("row") > 0)
    return rows.select(
        *[
            F.get("row", F.lit(i)).try_cast(f.dataType).alias(f.name)
            for i, f in enumerate(schema)
        ]
    )


def _rows_in(column, problem):
    """The rows in a text that holds nothing else but what stands between rows."""
    rest = F.regexp_replace(column, ROW, "")
    return F.when(rest.rlike(BETWEEN), F.regexp_extract_all(column, F.lit(ROW), F.lit(0))).otherwise(
        F.raise_error(F.concat(F.lit(f"not array rows, or {problem}: "), F.left(column, F.lit(200)))))


def _line_rows(spark, path):
    lines = spark.read.option("recursiveFileLookup", "true").text(path)
    return lines.select(F.explode(_rows_in(F.col("value"), "rows over several lines")).alias("text"))


def _wrapped_rows(spark, path):
    """Rows from pieces that end at closing brackets.

    A bracket inside quoted text ends no row: such a piece leaves an odd number of quotes
    open. Only if there is one, pieces are put together in the order of the file.
    """
    pieces = placed_lines(spark, path, line_sep="]", label="pieces")
    quotes = F.length(F.regexp_replace("value", r'\\.|[^"]', "")).cast("long")
    open_ones = pieces.withColumn("_quotes", quotes)
    if open_ones.filter("_quotes % 2 = 1").isEmpty():
        whole = pieces
    else:
        counted = running(open_ones, "_quotes", "_seen").withColumn(
            "_starts", (((F.col("_seen") - F.col("_quotes")) % 2) == 0).cast("long"))
        counted = running(counted, "_starts", "_row")
        ordered = F.sort_array(F.collect_list(F.struct(BLOCK, TURN, "value")))
        whole = counted.groupBy(FILE, "_row").agg(
            F.array_join(F.transform(ordered, lambda p: p["value"]), "]").alias("value"))
    # The bracket that ended the piece, if it is a row.
    text = F.when(F.col("value").contains("["), F.concat("value", F.lit("]"))).otherwise(F.col("value"))
    return whole.select(F.explode(_rows_in(text, "an open row")).alias("text"))
