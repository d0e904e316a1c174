"""The files that labels and nebulae come from, by the names each catalogue gives its columns.

A reader takes `columns`, our name to the file's name, so that order and further columns of
a file don't matter. Text that can't be read as the number it should be makes a row a
rejected one; it is listed with the columns at fault and takes no part.
"""

from functools import reduce

from pyspark.sql import functions as F
from pyspark.sql import types as T

from starloom.sources.tables import catalogue, in_file_order, number

CATALOGUE = T.StructType([T.StructField("hip", T.LongType()), *[T.StructField(n, T.DoubleType()) for n in ("ra", "dec", "plx", "mag", "colour")]])
NEIGHBOUR = T.StructType([T.StructField("hip", T.LongType()), T.StructField("source_id", T.LongType())])
NAMES = T.StructType([T.StructField("hip", T.StringType()), T.StructField("name", T.StringType())])
NEBULA = T.StructType(
    [T.StructField("dist", T.DoubleType()), *[T.StructField(n, T.StringType()) for n in ("ra_text", "dec_text", "name", "fieldradius_text")],
     T.StructField("rotation_deg", T.DoubleType()), T.StructField("dirname", T.StringType())])
# What stands for a missing value in the catalogues' files.
BLANK = ("", "null", "NaN", "-", "--")


def renamed(text, columns):
    """The columns of a file under our names."""
    return text.select(*[F.col(f"`{theirs}`").alias(ours) for ours, theirs in columns.items()], "pos")


def read_as(text, schema):
    """(rows, rejected) of text columns: typed rows, and those with text that isn't the number it should be.

    Rejected rows keep their text and say in `unreadable` which columns it is.
    """
    numbers = [f for f in schema if not isinstance(f.dataType, T.StringType)]
    blank = {f.name: F.col(f.name).isNull() | F.trim(f.name).isin(*BLANK) for f in numbers}
    values = {f.name: number(f.name, f.dataType) for f in numbers}
    bad = F.array_compact(F.array(*[F.when(~blank[f.name] & values[f.name].isNull(), F.lit(f.name)) for f in numbers]))
    flagged = text.withColumn("unreadable", F.array_join(bad, ","))
    rows = flagged.filter("unreadable = ''").select(
        *[values.get(f.name, F.col(f.name)).alias(f.name) for f in schema], "pos")
    return rows, flagged.filter("unreadable <> ''")


def listed_file(spark, path, schema, columns=None, names=None, sep=","):
    """(rows, rejected) of one file in its order; `names` replaces its header."""
    text = in_file_order(catalogue(spark, path, sep=sep, names=names))
    return read_as(renamed(text, columns or {f.name: f.name for f in schema}), schema)


def all_rejected(parts):
    """Rejected rows of several files as one table: file, pos, unreadable and the text as JSON."""
    each = [
        rows.select(F.lit(name).alias("file"), "pos", "unreadable",
                    F.to_json(F.struct(*[c for c in rows.columns if c not in ("pos", "unreadable")])).alias("row"))
        for name, rows in parts.items()
    ]
    return reduce(lambda a, b: a.unionByName(b), each)
