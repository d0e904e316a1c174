"""Which source files to fetch next, and whether fetched files are intact."""

from pyspark.sql import functions as F

from starloom import fixed
from starloom.functions.text import digest_as, digest_matches, element_name, sky_area
from starloom.operators.filters import file_gate_of
from starloom.operators.sizing import small
from starloom.sources.streams import listed_by_tasks, with_digests


def areas(digest, suffix):
    """Element name and sky area of every file of a digest."""
    return digest.select(
        element_name("filename", suffix).alias("element"), sky_area().alias("area"), "num_sources"
    )


def work_list(digest, checksums, digest_suffix, file_suffix, pattern):
    """Elements whose name matches, with the checksum of their file, largest area first."""
    wanted = areas(digest, digest_suffix).filter(F.col("element").rlike(pattern))
    named = wanted.withColumn("filename", F.concat("element", F.lit(file_suffix)))
    return named.join(checksums, "filename", "left").orderBy(F.desc("area"), "element")


def next_items(work, n):
    """At most `n` items, largest area first."""
    return work.orderBy(F.desc("area"), "element").limit(n)


def progress(work, done):
    """Listed and finished elements, as one row."""
    total = work.agg(F.count("*").alias("total"))
    finished = done.join(work.select("element"), "element", "left_semi").select(F.count("*"))
    return total.withColumn("done", finished.scalar()).withColumn(
        "share", F.try_divide(F.col("done"), F.col("total"))
    )


def verified(files, checksums):
    """Files (filename, content) against the checksum list, whatever digest it uses."""
    return files.join(checksums, "filename", "left").select(
        "filename",
        F.length("content").cast("long").alias("length"),
        digest_as("hash", "content").alias("digest"),
        digest_matches("hash", "content").alias("intact"),
    )


def verify_folder(spark, path, checksums, pattern=None):
    """Job: every file of a folder against the checksum list, read as a stream by one task.

    filename, length, digest, intact (NULL without a checksum) and error, the reason why a
    file could not be read. Files may have any size.
    """
    files = listed_by_tasks(spark, path, pattern).withColumn("filename", F.element_at(F.split("path", "/"), -1))
    sums = checksums.withColumnRenamed("filename", "_file")
    asked = files.join(small(sums), files["filename"] == sums["_file"], "left").drop("_file")
    return with_digests(asked).select(
        F.element_at(F.split("path", "/"), -1).alias("filename"), "length", "digest",
        F.when(F.col("hash").isNotNull(), F.coalesce(F.lower("hash") == F.col("digest"), F.lit(False))).alias("intact"),
        "error",
    )


# What can be said of a listed file, the worst first.
MISSING, UNREAD, DAMAGED, UNLISTED, THIN, GOOD = "missing", "unread", "damaged", "no checksum", "few rows", "good"


def checked(work, verified_files, rows=None, least=fixed.MIN_ROWS_PER_FILE):
    """The work list with the outcome of `verify_folder` and of the gate on rows.

    `rows` (element, rows) tells how many rows each file gave; without it, or for an
    element that it doesn't list, the gate is not asked.
    """
    # `filename` is the key; listed twice in the folder, the worse of two files counts.
    outcome = verified_files.groupBy("filename").agg(
        F.bool_and(F.coalesce("intact", F.lit(True))).alias("intact"),
        F.bool_or(F.col("intact").isNull()).alias("unlisted"),
        F.min("error").alias("error"),
        F.max("length").alias("length"),
    )
    seen = outcome.select(F.col("filename").alias("_file"), "intact", "unlisted", "error", "length", F.lit(True).alias("there"))
    out = work.join(seen, work["filename"] == seen["_file"], "left").drop("_file")
    if rows is not None:
        gated = file_gate_of(rows, least).withColumnRenamed("element", "_element")
        out = out.join(gated, out["element"] == gated["_element"], "left").drop("_element")
    else:
        out = out.withColumns({"rows": F.lit(None).cast("long"), "accepted": F.lit(None).cast("boolean")})
    state = (
        F.when(F.col("there").isNull(), MISSING)
        .when(F.col("error").isNotNull(), UNREAD)
        .when(~F.col("intact"), DAMAGED)
        .when(F.col("unlisted"), UNLISTED)
        .when(~F.col("accepted"), THIN)
        .otherwise(GOOD)
    )
    return out.withColumn("state", state).drop("there", "unlisted", "accepted")


def integrity(spark, path, digest, checksums, names, rows=None, least=fixed.MIN_ROWS_PER_FILE):
    """Job: what a folder still lacks. `names` has digest_suffix, file_suffix and pattern of `work_list`."""
    work = work_list(digest, checksums, **names)
    return checked(work, verify_folder(spark, path, checksums), rows, least)
