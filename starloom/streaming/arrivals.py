"""Files that arrive one by one: each is processed once, and a restart resumes."""

from pyspark.sql import functions as F

from starloom import folders, schemas
from starloom.operators.bins import bin_index
from starloom.operators.loads import one_per_key
from starloom.plans.stars import ingested, loadable
from starloom.sinks.keyed import KeyedTable
from starloom.sources.streams import by_own_header
from starloom.sources.tables import typed


def arriving(spark, path, files_per_trigger=None, schema=schemas.RAW):
    """Stream of source files with the columns of `schema`, each file read by its own header."""
    reader = spark.readStream.option("recursiveFileLookup", "true")
    if files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", files_per_trigger)
    lines = reader.format("text").load(path).select(F.col("_metadata.file_path").alias("file"), "value")
    return typed(by_own_header(lines, [f.name for f in schema]), schema)


def star_stream(raw):
    """The ingest and derive transforms, as in the batch jobs."""
    return loadable(ingested(raw))


def run_to_files(stars, path, checkpoint):
    """Processes what has arrived into a table; the sink's log makes it exactly once per file."""
    return (
        stars.writeStream.format("parquet")
        .option("path", path)
        .option("checkpointLocation", checkpoint)
        .outputMode("append")
        .trigger(availableNow=True)
        .start()
    )


def run_keyed(stars, path, checkpoint, order, key="source_id", **options):
    """Loads every micro-batch by key: a replayed batch or repeated star adds nothing.

    The keyed table's filters tell which ranges may hold a key of the batch, and only
    those are read; no state grows with the number of stars. `KeyedTable(spark, path)`
    reads the result.
    """

    def load(batch, _):
        KeyedTable(batch.sparkSession, path, key, **options).insert_new(batch, order)

    return (
        stars.writeStream.foreachBatch(load)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )


def bin_stream(stars, step, mean_of, axes=("x", "y", "z")):
    """Running count and mean per bin; the state has one row per occupied bin."""
    return stars.groupBy(*[bin_index(a, step).alias(a) for a in axes]).agg(
        F.count("*").alias("rows"), F.avg(mean_of).alias("mean")
    )


CHANGES_KEPT = 8


def run_bins(bins, path, checkpoint, axes=("x", "y", "z"), most=CHANGES_KEPT):
    """Publishes the bins that changed in each micro-batch.

    `path/changes/batch=N` holds what batch N changed, `path/snapshots/N` all bins as of
    batch N. After `most` batches they are put together: the new snapshot counts once it
    is complete, and what the one before it covers goes. So there are never more than
    2 * most + 2 folders, whenever a run stops and resumes.
    """

    def publish(batch, batch_id):
        spark = batch.sparkSession
        upto = _snapshot(spark, path)
        if upto is not None and batch_id <= upto:
            return  # a replay of what the snapshot holds
        batch.write.mode("overwrite").parquet(f"{path}/changes/batch={batch_id}")
        if len(_changes(spark, path, upto)) >= most:
            whole = latest_bins(spark, path, axes)
            whole.write.mode("overwrite").parquet(f"{path}/snapshots/{batch_id}")
            # Readers may still be at the snapshot before, and the batches after it.
            for n in _changes(spark, path):
                if upto is not None and n <= upto:
                    folders.drop(spark, f"{path}/changes/batch={n}")
            for n in folders.names(spark, f"{path}/snapshots"):
                if n.isdigit() and int(n) not in (upto, batch_id):
                    folders.drop(spark, f"{path}/snapshots/{n}")

    return (
        bins.writeStream.outputMode("update")
        .foreachBatch(publish)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )


def _snapshot(spark, path):
    """The batch of the newest complete snapshot."""
    done = [int(n) for n in folders.names(spark, f"{path}/snapshots")
            if n.isdigit() and folders.exists(spark, f"{path}/snapshots/{n}/_SUCCESS")]
    return max(done, default=None)


def _changes(spark, path, after=None):
    """The batches whose changes are there and complete, beyond `after`."""
    found = [int(n.removeprefix("batch=")) for n in folders.names(spark, f"{path}/changes")
             if n.startswith("batch=") and folders.exists(spark, f"{path}/changes/{n}/_SUCCESS")]
    return sorted(n for n in found if after is None or n > after)


def latest_bins(spark, path, axes=("x", "y", "z")):
    """The newest value of every bin: one snapshot and the batches after it."""
    upto = _snapshot(spark, path)
    whole = None if upto is None else spark.read.parquet(f"{path}/snapshots/{upto}").withColumn("batch", F.lit(upto).cast("long"))
    for n in _changes(spark, path, upto):
        part = spark.read.parquet(f"{path}/changes/batch={n}").withColumn("batch", F.lit(n).cast("long"))
        whole = part if whole is None else whole.unionByName(part)
    return one_per_key(whole, axes, [F.desc("batch")]).drop("batch")
