"""Session settings and the shared folder for staged tables."""

import atexit
import shutil
import tempfile
import threading
import uuid
from contextlib import contextmanager

from pyspark.sql import SparkSession

# Settings the jobs count on; adaptive execution sizes partitions and splits skewed joins.
SETTINGS = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.parquet.filterPushdown": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    # Stream state on local disk with remote checkpoints, so that bins may outgrow memory.
    "spark.sql.streaming.stateStore.providerClass": (
        "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
    ),
}

_local_root = None


def build_session(name="starloom", master=None, **extra):
    """A session with the settings above; keyword arguments use `__` for dots."""
    builder = SparkSession.builder.appName(name)
    if master:
        builder = builder.master(master)
    for key, value in {**SETTINGS, **{k.replace("__", "."): v for k, v in extra.items()}}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def shared_root(spark):
    """The folder every executor can reach, as the cluster names it.

    Only a local session without that setting gets a temporary folder.
    """
    global _local_root
    root = spark.conf.get("spark.checkpoint.dir", None)
    if root:
        return root.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder all executors share")
    if _local_root is None:
        _local_root = tempfile.mkdtemp(prefix="starloom-")
        atexit.register(shutil.rmtree, _local_root, ignore_errors=True)
    return _local_root


def staging_path(spark, label):
    """A fresh path under the shared folder for one staged table."""
    return f"{shared_root(spark)}/starloom/{label}-{uuid.uuid4().hex}"


_scopes = threading.local()


def _open_scopes():
    if not hasattr(_scopes, "stack"):
        _scopes.stack = []
    return _scopes.stack


def staged(df, label):
    """Write `df` to the shared folder and read it back.

    What follows starts from files that outlive any executor, and nothing ahead
    of them is computed twice.
    """
    spark = df.sparkSession
    path = staging_path(spark, label)
    if _open_scopes():
        _open_scopes()[-1].append(path)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


@contextmanager
def staging(spark):
    """Drops the tables staged inside at the end: for jobs that have written their result by then."""
    _open_scopes().append([])
    try:
        yield
    finally:
        for path in _open_scopes().pop():
            target = spark._jvm.org.apache.hadoop.fs.Path(path)
            target.getFileSystem(spark._jsc.hadoopConfiguration()).delete(target, True)


def finished(spark, label, make):
    """The rows of the DataFrame that `make` returns, as a written table; what `make` stages is dropped."""
    path = staging_path(spark, label)
    if _open_scopes():
        _open_scopes()[-1].append(path)
    with staging(spark):
        df = make()
        df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)
