"""Source files to filtered stars to the star table."""

from pyspark.sql import functions as F

from starloom import schemas
from starloom.functions.astrometry import (
    absolute_magnitude,
    distance_ly,
    signal_to_noise,
    with_position,
)
from starloom.functions.photometry import merged_colour, merged_magnitude
from starloom.operators.filters import ingest_quality, load_quality
from starloom.operators.loads import reconciled, rows_per_file, whole_files
from starloom.operators.regions import space_order
from starloom.operators.sizing import small
from starloom.session import staging
from starloom.sinks.tables import read_if_there, replace_partitions
from starloom.sources.tables import file_below, survey_files


def merged(raw, *extra):
    """Colour and magnitude merged; the columns of a filtered star."""
    return raw.withColumns({"color": merged_colour(), "mag": merged_magnitude()}).select(
        *schemas.FILTERED_COLUMNS, *extra
    )


def ingested(raw, *extra):
    """Raw rows to filtered stars: quality filter first, then the merges."""
    return merged(raw.filter(ingest_quality()), *extra)


def derived(filtered, *extra):
    """Filtered stars to star-table columns, before the load filter."""
    with_dist = filtered.withColumns(
        {
            "px_over_err": signal_to_noise("parallax", "parallax_error"),
            "dist": distance_ly("parallax"),
        }
    )
    return (
        with_position(with_dist)
        .withColumn("abs_mag", absolute_magnitude("mag", "dist"))
        .select(*schemas.STAR_COLUMNS, *extra)
    )


def loadable(filtered, *extra):
    """Star rows good enough for the star table."""
    return derived(filtered, *extra).filter(load_quality())


def ingest(spark, source_path, filtered_path):
    """Job: source files to the filtered table, one partition per file, named by its path below the folder."""
    raw = survey_files(spark, source_path, file_column="file_path")
    rows = ingested(raw, "file_path").withColumn("file_id", file_below(source_path, F.col("file_path")))
    replace_partitions(rows.drop("file_path"), filtered_path, ["file_id"])


def load(spark, filtered_path, star_path, compare=False):
    """Job: filtered table to star table, writing the files that are not there with all their rows.

    By default a file is there when the table has as many rows of it, which reads next to
    nothing. With `compare` its rows have to be the same ones, so that another version of
    a file takes the place of the one before; both tables are then read. Returns rows per file with a running total, and the reconciliation.
    """
    filtered = spark.read.parquet(filtered_path)
    good = filtered.filter(load_quality(signal_to_noise("parallax", "parallax_error")))
    stars = read_if_there(spark, star_path)
    todo = good
    with staging(spark):
        if stars is not None:
            columns = schemas.STAR_COLUMNS if compare else ()
            present = whole_files(derived(good, "file_id") if compare else good, stars, "file_id", columns)
            todo = good.join(small(present), "file_id", "left_anti")
        # Sorted by distance inside each file, so page statistics prune distance limits.
        rows = derived(todo, "file_id").sortWithinPartitions("file_id", "dist")
        replace_partitions(rows, star_path, ["file_id"])
    return rows_per_file(good, "file_id"), reconciled(good, spark.read.parquet(star_path))


def cluster(spark, star_path, path):
    """Job: the star table once more, in files that each hold one range of distances.

    A distance limit then skips whole files, which pays when sets are drawn from
    the table again and again.
    """
    stars = spark.read.parquet(star_path).select(*schemas.STAR_COLUMNS)
    ranges = stars.repartitionByRange("dist", "source_id")
    ranges.sortWithinPartitions("dist").write.mode("overwrite").parquet(path)


def cluster_in_space(spark, star_path, path):
    """Job: the star table once more, along a space-filling curve.

    Stars near a place then stand in few files and row groups, which a neighbourhood's
    bounds pick out.
    """
    stars = spark.read.parquet(star_path).select(*schemas.STAR_COLUMNS)
    along = stars.withColumn("_order", space_order()).repartitionByRange("_order", "source_id")
    along.sortWithinPartitions("_order").drop("_order").write.mode("overwrite").parquet(path)
