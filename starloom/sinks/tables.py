"""Tables: replace, append by key, and write only on change."""

from pyspark.sql import functions as F
from pyspark.sql.utils import AnalysisException

from starloom import folders
from starloom.functions.rounding import fixed_text
from starloom.operators.loads import fingerprint, insertable, new_rows, null_safe, one_per_key
from starloom.operators.filters import export_quality
from starloom.functions.text import cut_row
from starloom.operators.sizing import small
from starloom.session import staged, staging


def read_if_there(spark, path):
    """The table at `path`, or None when there is none yet."""
    try:
        return spark.read.parquet(path)
    except AnalysisException as e:
        if e.getCondition() in ("PATH_NOT_FOUND", "UNABLE_TO_INFER_SCHEMA"):
            return None
        raise


def replace(df, path, partition_by=()):
    df.write.mode("overwrite").partitionBy(*partition_by).parquet(path)


def replace_partitions(df, path, partition_by):
    """Rewrites only the partitions that `df` has rows for: a repeated load changes nothing."""
    (
        df.write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy(*partition_by)
        .parquet(path)
    )


def append_new(batch, path, order, key="source_id"):
    """Appends one row per key that the table does not have; a second run adds nothing."""
    spark = batch.sparkSession
    table = read_if_there(spark, path)
    with staging(spark):
        if table is None:
            rows = one_per_key(batch, [key], order)
        else:
            rows = insertable(staged(batch, "batch"), table, order, key)
        rows.write.mode("append").parquet(path)


def append_files(batch, path, file_column, key="source_id"):
    """Appends the rows of files none of whose keys are loaded yet; rows without a file are a file too."""
    spark = batch.sparkSession
    table = read_if_there(spark, path)
    with staging(spark):
        if table is not None:
            batch = staged(batch, "batch")
            fresh = new_rows(batch, table, key).groupBy(file_column).agg(F.count("*").alias("_new"))
            sizes = batch.groupBy(file_column).agg(F.count("*").alias("_all"))
            fresh = fresh.withColumnRenamed(file_column, "_file")
            whole = sizes.join(fresh, sizes[file_column].eqNullSafe(fresh["_file"])).filter(F.col("_new") == F.col("_all"))
            batch = null_safe(batch, small(whole.select(file_column)), file_column, "left_semi")
        batch.write.mode("append").parquet(path)


def csv_rows(df, digits=3):
    """Doubles as text with fixed decimals, other columns as they are."""
    doubles = {n for n, t in df.dtypes if t in ("double", "float")}
    return df.select(*[fixed_text(c, digits).alias(c) if c in doubles else F.col(c) for c in df.columns])


def write_csv(df, path, digits=3):
    csv_rows(df, digits).write.mode("overwrite").csv(path, header=True)


def unchanged(df, path):
    """Whether the table at `path` holds the rows of `df` already."""
    old = read_if_there(df.sparkSession, path)
    if old is None or sorted(old.dtypes) != sorted(df.dtypes):
        return False
    return fingerprint(old).first() == fingerprint(df).first()


def write_if_changed(df, path):
    """Writes `df` unless the stored rows are the same; tells whether it wrote."""
    with staging(df.sparkSession):
        rows = staged(df, "candidate")
        changed = not unchanged(rows, path)
        if changed:
            replace(rows, path)
    return changed


def file_export(filtered, columns=("x", "y", "z", "color", "abs_mag"), file_column="file_id"):
    """Array rows per source file for stars above the export quality."""
    kept = filtered.filter(export_quality())
    return kept.select(file_column, "source_id", cut_row(columns).alias("line"))


def stale_files(expected, exported, file_column="file_id"):
    """Files whose exported row count differs from the table's, with both counts.

    An exported file of which the table has no row any more counts as stale, with 0 rows.
    """
    want = expected.groupBy(file_column).agg(F.count("*").alias("rows"))
    have = exported.groupBy(file_column).agg(F.count("*").alias("exported"))
    have = have.withColumnRenamed(file_column, "_file")
    return (
        want.join(have, want[file_column].eqNullSafe(have["_file"]), "full")
        .withColumns({file_column: F.coalesce(file_column, "_file"), "rows": F.coalesce("rows", F.lit(0)), "exported": F.coalesce("exported", F.lit(0))})
        .drop("_file")
        .withColumn("stale", F.col("rows") != F.col("exported"))
    )


def write_file_export(filtered, path, file_column="file_id"):
    """Exports the files that are missing or out of date, removes the partitions of those that
    lost all rows, and leaves all other partitions alone."""
    spark = filtered.sparkSession
    rows = file_export(filtered, file_column=file_column)
    old = read_if_there(spark, path)
    with staging(spark):
        if old is not None:
            stale = staged(stale_files(rows, old, file_column).filter("stale"), "stale")
            gone = null_safe(old.select(file_column, F.col("_metadata.file_path").alias("_path")),
                             small(stale.filter("rows = 0").select(file_column)), file_column, "left_semi")
            # A folder per vanished file.
            for r in gone.select(F.regexp_replace("_path", "/[^/]*$", "").alias("folder")).distinct().collect():
                folders.drop(spark, r["folder"])
            rows = staged(null_safe(rows, small(stale.filter("rows > 0").select(file_column)), file_column, "left_semi"), "export")
        replace_partitions(rows, path, [file_column])
