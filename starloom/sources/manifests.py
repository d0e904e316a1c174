"""Work lists, checksum lists and whole files."""

from pyspark.sql import functions as F

DIGEST_COLUMNS = ("filename", "num_sources", "ra_min", "ra_max", "dec_min", "dec_max")


def file_digest(spark, path, header="^File"):
    """Sky bounds per source file; the header is told by its first word and `+` signs go."""
    fields = F.split(F.replace(F.col("value"), F.lit("+"), F.lit("")), ",")
    names = dict(zip(DIGEST_COLUMNS, range(len(DIGEST_COLUMNS))))
    return (
        spark.read.text(path)
        .filter(~F.col("value").rlike(header))
        .select(
            *[
                F.trim(F.get(fields, F.lit(i)))
                .try_cast({"filename": "string", "num_sources": "bigint"}.get(n, "double"))
                .alias(n)
                for n, i in names.items()
            ]
        )
    )


def checksums(spark, path):
    """`hash  file name` lines."""
    fields = F.split(F.trim("value"), r"\s+")
    return spark.read.text(path).select(
        F.get(fields, F.lit(0)).alias("hash"), F.get(fields, F.lit(1)).alias("filename")
    )


def whole_files(spark, path, pattern=None):
    """Files as bytes, one row each, for integrity tests."""
    reader = spark.read.format("binaryFile").option("recursiveFileLookup", "true")
    if pattern:
        reader = reader.option("pathGlobFilter", pattern)
    return reader.load(path).select("path", "length", "content")
