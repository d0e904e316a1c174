"""Files of their own names, written by the tasks that hold their content."""

import os
import sys
import uuid
import zlib

import pyarrow as pa
from pyarrow import fs
from pyspark import cloudpickle
from pyspark.sql import functions as F

from starloom import folders
from starloom.sources.streams import store_of

FOLDERS = 1024  # below the path, so that no folder holds all files
TASKS_PER_CORE = 8

# Tasks get these functions themselves, as workers may not have the package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])


def _put(store, begun, place, content):
    """A file that takes its name once it is complete."""
    if isinstance(store, fs.LocalFileSystem):
        # A quarter of the time that Arrow takes for a small file.
        file, rest = os.open(begun, os.O_WRONLY | os.O_CREAT | os.O_TRUNC, 0o666), memoryview(content)
        try:
            while len(rest):
                rest = rest[os.write(file, rest):]
        finally:
            os.close(file)
        os.replace(begun, place)
    else:
        with store.open_output_stream(begun, compression=None) as out:
            out.write(content)
        store.move(begun, place)


def write_files(files, path, spread=FOLDERS):
    """One file per row (filename, content) in folders below `path`, dealt by the names' digests.

    A file is there whole or not at all: it takes its name when it is complete, and a
    repeated task writes the same one again. Stores are those that Arrow opens.
    """
    spark, whole = files.sparkSession, folders.qualified(files.sparkSession, path)

    def run(batches):
        store, top = store_of(whole)
        made = set()
        for batch in batches:
            for name, content in zip(batch.column("filename").to_pylist(), batch.column("content")):
                folder = f"{top}/{zlib.crc32(name.encode()) % spread:04d}"
                if folder not in made:
                    store.create_dir(folder, recursive=True)
                    made.add(folder)
                # Spark passes over names that begin with a dot.
                _put(store, f"{folder}/.{uuid.uuid4().hex}", f"{folder}/{name}", content.as_buffer())
            yield pa.RecordBatch.from_arrays([pa.array([batch.num_rows], pa.int64())], names=["n"])

    # By name, so that two rows of one name are written by one task.
    tasks = spark.sparkContext.defaultParallelism * TASKS_PER_CORE
    spread_out = files.select("filename", "content").repartition(tasks, F.xxhash64("filename"))
    spread_out.mapInArrow(run, "n bigint").agg(F.sum("n")).collect()
    return path
