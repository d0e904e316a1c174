"""Survey files, star tables and delimited catalogues."""

import re
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from starloom import schemas
from starloom.operators.ranking import arrange, positions
from starloom.sources.streams import listed_files, with_headers


# Scheme and authority of a path.
SCHEME = r"^[A-Za-z][A-Za-z0-9+.-]*:(//[^/]*)?"


def number(name, dtype):
    """A text column as a number; `NaN` text becomes NULL."""
    value = F.col(name).try_cast(dtype)
    return F.when(~F.isnan(value), value) if isinstance(dtype, T.DoubleType) else value


def typed(df, schema):
    """The columns of `schema`, cast from text, ahead of any other named columns."""
    return df.select(*[number(f.name, f.dataType).alias(f.name) for f in schema])


def file_name(path=None):
    """Base name of the file a row came from."""
    return F.element_at(F.split(path if path is not None else F.col("_metadata.file_path"), "/"), -1)


def file_below(root, path):
    """The path of a row's file below the folder `root`: its identity among all source files."""
    depth = len([p for p in re.sub(SCHEME, "", root).split("/") if p])
    parts = F.filter(F.split(F.regexp_replace(path, SCHEME, ""), "/"), lambda p: p != "")
    return F.array_join(F.slice(parts, F.least(F.lit(depth + 1), F.size(parts)), F.size(parts)), "/")


def header_groups(spark, path, comment="#"):
    """The distinct headers below a folder, each with the files that have it.

    Reads the beginning of each file. Where only Spark can open the files, their lines are
    scanned instead. The driver gets the files' names, which it lists anyway.
    """
    seen = with_headers(listed_files(spark, path), comment).cache()
    try:
        if not seen.filter("error IS NOT NULL").isEmpty():
            lines = spark.read.option("recursiveFileLookup", "true").text(path)
            place = F.struct(F.col("_metadata.file_block_start"), F.monotonically_increasing_id())
            kept = lines.select(F.col("_metadata.file_path").alias("path"), "value", place.alias("place"))
            kept = kept.filter(~F.col("value").startswith(comment) & (F.trim("value") != ""))
            found = kept.groupBy("path").agg(F.min_by("value", "place").alias("header")).collect()
        else:
            found = seen.select("path", "header").filter("header <> ''").collect()
    finally:
        seen.unpersist()
    groups = {}
    for r in found:
        groups.setdefault(r["header"], []).append(r["path"])
    return groups


def survey_files(spark, path, schema=schemas.RAW, file_column=None):
    """Comma-separated survey files, compressed or not, with `#` comments and `null` text.

    Each file is read by the names in its own header, in whatever order they stand; files
    of equal headers are read together, and one that lacks a column makes the read fail.
    A much wider header costs nothing: the parser drops the columns that are not selected.
    One compressed file is one task, and a sky survey has thousands of files.
    """
    columns = [number(f.name, f.dataType).alias(f.name) for f in schema]
    if file_column:
        columns.append(F.col("_metadata.file_path").alias(file_column))
    groups = header_groups(spark, path)
    parts = []
    for header, files in sorted(groups.items()):
        names = [n.strip().strip('"') for n in header.split(",")]
        lacking = [f.name for f in schema if f.name not in names]
        if lacking:
            raise ValueError(f"no column {', '.join(lacking)} in {files[0]}")
        text = T.StructType([T.StructField(n, T.StringType()) for n in names])
        reader = spark.read.schema(text).options(header=True, comment="#", nullValue="null", recursiveFileLookup=True)
        parts.append(reader.csv(path if len(groups) == 1 else files).select(*columns))
    if not parts:
        empty = T.StructType([*schema, *([T.StructField(file_column, T.StringType())] if file_column else [])])
        return spark.createDataFrame([], empty)
    return reduce(DataFrame.unionAll, parts)


def star_table(spark, path, predicate=None, columns=None):
    """A star table with the predicate and the column list pushed to the scan."""
    df = spark.read.parquet(path)
    if predicate is not None:
        df = df.filter(predicate)
    return df.select(*columns) if columns else df


def filtered_tables(spark, path, file_column="file_path"):
    """All per-file filtered tables under a folder, each row with its file."""
    df = spark.read.option("recursiveFileLookup", "true").parquet(path)
    return df.select("*", F.col("_metadata.file_path").alias(file_column))


def catalogue(spark, path, sep=",", comment=None, names=None, header=True, columns=None, schema=None):
    """A delimited catalogue as text columns, or typed by `schema`.

    `names` replaces the header, which also gets rid of duplicate or awkward
    header names; `columns` keeps a subset.
    """
    options = {"sep": sep, "header": header, "mode": "PERMISSIVE"}
    if comment:
        options["comment"] = comment
    reader = spark.read.options(**options)
    if schema is not None:
        df = reader.schema(schema).csv(path)
    elif names:
        text = T.StructType([T.StructField(n, T.StringType()) for n in names])
        df = reader.schema(text).csv(path)
    else:
        df = reader.csv(path)
    return df.select(*[F.col(f"`{c}`") for c in columns]) if columns else df


def in_file_order(rows, name="pos"):
    """Numbers rows that come straight from a file scan in the order of the files.

    For lists whose order means something. The place of a row is the file, the
    block of the file and the row in the block, whichever task reads it.
    """
    place = {
        "_file": F.col("_metadata.file_path"),
        "_block": F.col("_metadata.file_block_start"),
        "_row": F.monotonically_increasing_id(),
    }
    placed = positions(arrange(rows.select("*", *[c.alias(n) for n, c in place.items()]), *place))
    return placed.withColumnRenamed("position", name).drop(*place, "total")


def identifier_list(spark, path):
    """The pipe-separated list of identifiers (oid, id, pos), ruled by lines of dashes."""
    rows = catalogue(spark, path, sep="|", comment="-", names=("oid", "id"))
    return in_file_order(rows).withColumn("oid", F.col("oid").try_cast("long"))


def cluster_list(spark, path):
    """The pipe-separated list of clusters: distance in parsec, ra and dec text, name."""
    df = catalogue(spark, path, sep="|", header=False, schema=schemas.CLUSTER)
    return df.drop("stretch")
