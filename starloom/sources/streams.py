"""Digests and headers of files of any size, read as streams by the executors.

A file is one sequence, so one task reads it, in pieces of fixed size; a task holds one
piece at a time. Local folders and the stores that Arrow knows by their address (hdfs, s3,
gs, abfs) are opened directly. A file that can't be opened or breaks off is reported with
the reason, not lost.
"""

import hashlib
import itertools
import os
import re
import sys

import pyarrow as pa
import pyarrow.compute as pc
from pyarrow import csv, fs
from pyspark import cloudpickle
from pyspark.sql import functions as F

from starloom import folders

PIECE = 4 << 20
# Digest by the length of its text.
ALGORITHMS = {32: "md5", 40: "sha1", 64: "sha256", 128: "sha512"}
TASKS_PER_CORE = 8
# What Arrow raises for a store or file that it can't open.
UNOPENED = (OSError, ValueError, pa.ArrowException)
LISTED_ROWS = 10_000  # a batch

# Tasks get these functions themselves, as workers may not have the package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])


def listed_files(spark, path, pattern=None):
    """path and length of every file below a folder; no content is read."""
    reader = spark.read.format("binaryFile").option("recursiveFileLookup", "true")
    if pattern:
        reader = reader.option("pathGlobFilter", pattern)
    return reader.load(path).select("path", "length")


def _passed_over(name, folder):
    """Whether Spark's readers pass over a file or folder of this name."""
    marked = name.startswith("_") and "=" not in name
    begun = name.startswith(".") or name.endswith("._COPYING_")
    own = name.startswith(("_common_metadata", "_metadata"))
    return ((marked or begun) and not own) or (marked and not folder)


def held_by(folder):
    """(full path, length) of what a folder holds that Spark's readers see; the length of a folder is None."""
    store, place = store_of(folder)
    if isinstance(store, fs.LocalFileSystem):
        with os.scandir(place) as found:
            for e in found:
                try:
                    e.name.encode()
                    if not _passed_over(e.name, e.is_dir()):
                        yield f"{folder}/{e.name}", None if e.is_dir() else e.stat().st_size
                except (FileNotFoundError, UnicodeEncodeError):
                    pass  # a link to nothing, or no text, which Spark passes over too
    else:
        for e in store.get_file_info(fs.FileSelector(place)):
            inner = e.type == fs.FileType.Directory
            if e.type != fs.FileType.NotFound and not _passed_over(e.base_name, inner):
                yield f"{folder}/{e.base_name}", None if inner else e.size


def _inner_folders(batches):
    """The folders in those of `batches`, and the reason why one can't be listed."""
    for batch in batches:
        found, errors = [], []
        for folder in batch.column("folder").to_pylist():
            try:
                inner = [path for path, length in held_by(folder) if length is None]
                found += inner
                errors += [None] * len(inner)
            except UNOPENED as e:
                found.append(folder)
                errors.append(f"{type(e).__name__}: {e}"[:500])
        yield pa.RecordBatch.from_arrays([pa.array(found, pa.string()), pa.array(errors, pa.string())], names=["folder", "error"])


def _files_of(batches):
    """path and length of the files in the folders of `batches`, and below those that are `deep`."""

    def found():
        for batch in batches:
            for folder, deep in zip(batch.column("folder").to_pylist(), batch.column("deep").to_pylist()):
                ahead = [folder]
                while ahead:
                    for path, length in held_by(ahead.pop()):
                        if length:
                            yield path, length
                        elif length is None and deep:
                            ahead.append(path)

    files = found()
    while rows := list(itertools.islice(files, LISTED_ROWS)):
        paths, lengths = zip(*rows)
        yield pa.RecordBatch.from_arrays([pa.array(paths, pa.string()), pa.array(lengths, pa.int64())], names=["path", "length"])


def listed_by_tasks(spark, path, pattern=None):
    """The rows of `listed_files` for a folder of any number of files, listed by tasks.

    The driver holds the names of folders only, and goes down until there is one for each
    task; files are listed when the rows are asked for. What Arrow can't list, and a path
    that is no folder, goes to `listed_files`.
    """
    context = spark.sparkContext
    tasks = context.defaultParallelism * TASKS_PER_CORE

    def dealt(rows, schema):
        return spark.createDataFrame(context.parallelize(rows, min(tasks, len(rows))), schema)

    if set(path) & set("{}[]*?\\"):  # Spark takes it for a pattern
        return listed_files(spark, path, pattern)
    level, above = [folders.qualified(spark, path)], []
    while level and (not above or len(level) < tasks):
        inner = dealt([(f,) for f in level], "folder string").mapInArrow(_inner_folders, "folder string, error string").collect()
        if any(r["error"] for r in inner):
            return listed_files(spark, path, pattern)
        above += level
        level = [r["folder"] for r in inner]
    rows = [(f, False) for f in above] + [(f, True) for f in level]
    files = dealt(rows, "folder string, deep boolean").mapInArrow(_files_of, "path string, length bigint")
    if pattern:
        matched = spark._jvm.org.apache.hadoop.fs.GlobPattern(pattern).compiled().pattern()
        files = files.filter(F.element_at(F.split("path", "/"), -1).rlike(rf"(?s)\A(?:{matched})\z"))
    return files


def store_of(path, known=None):
    """The store of a file or folder named by its full path, and its place there; `known` keeps the stores."""
    scheme, authority, place = re.fullmatch(r"(?s)(?:([A-Za-z][A-Za-z0-9+.-]*):)?(?://([^/]*))?(/.*)", path).groups()
    known = {} if known is None else known
    if (scheme, authority) not in known:
        local = scheme in (None, "file")
        known[scheme, authority] = (fs.LocalFileSystem(), "") if local else fs.FileSystem.from_uri(f"{scheme}://{authority or ''}/")
    store, base = known[scheme, authority]
    return store, base.rstrip("/") + place


def opened(path, known=None):
    """An input stream of a file named by its full path."""
    store, place = store_of(path, known)
    return store.open_input_stream(place, compression=None)


def stream_digest(source, algorithm, piece=PIECE):
    """(bytes, hex digest) of a stream, holding one piece at a time."""
    state, size = hashlib.new(algorithm), 0
    while data := source.read(piece):
        state.update(data)
        size += len(data)
    return size, state.hexdigest()


def first_line(path, comment="#", piece=1 << 16):
    """The first line of a file that is no comment; compressed files are told by their ending."""
    mark, held = comment.encode(), b""
    with opened(path) as raw:
        source = pa.CompressedInputStream(raw, "gzip") if path.endswith(".gz") else raw
        while True:
            data = source.read(piece)
            held += data
            lines = held.split(b"\n")
            held = lines.pop()  # may go on
            for line in lines if data else [*lines, held]:
                if line.strip() and not line.startswith(mark):
                    return line.rstrip(b"\r").decode("utf-8")
            if not data:
                return ""


def with_headers(files, comment="#"):
    """path, header and error of `files`; only the beginning of each file is read."""

    def run(batches):
        for batch in batches:
            headers, errors = [], []
            for path in batch.column("path").to_pylist():
                try:
                    headers.append(first_line(path, comment))
                    errors.append(None)
                except UNOPENED as e:
                    headers.append(None)
                    errors.append(f"{type(e).__name__}: {e}"[:500])
            yield pa.RecordBatch.from_arrays(
                [batch.column("path"), pa.array(headers, pa.string()), pa.array(errors, pa.string())], names=["path", "header", "error"])

    tasks = files.sparkSession.sparkContext.defaultParallelism * TASKS_PER_CORE
    spread = files.select("path").repartition(tasks, F.xxhash64("path"))
    return spread.mapInArrow(run, "path string, header string, error string")


def by_own_header(lines, names, comment="#", null="null"):
    """Text lines (file, value) of comma-separated files as the text columns `names`.

    Each file is read by the names in its own header, wherever the lines of a task begin
    in it; a column that it lacks makes the read fail.
    """

    def run(batches):
        known = {}
        for batch in batches:
            files = batch.column("file")
            for path in pc.unique(files).to_pylist():
                if path not in known:
                    known[path] = first_line(path, comment)
                header = known[path]
                mine = batch.filter(pc.equal(files, path)).column("value")
                kept = mine.filter(pc.and_(pc.not_equal(mine, header), pc.invert(pc.starts_with(mine, comment))))
                kept = kept.filter(pc.greater(pc.utf8_length(pc.utf8_trim_whitespace(kept)), 0))
                if len(kept):
                    parsed = csv.read_csv(
                        pa.py_buffer("\n".join([header, *kept.to_pylist()]).encode()),
                        convert_options=csv.ConvertOptions(
                            include_columns=names, column_types={n: pa.string() for n in names},
                            null_values=[null, ""], strings_can_be_null=True, quoted_strings_can_be_null=False),
                        read_options=csv.ReadOptions(use_threads=False))
                    yield from parsed.combine_chunks().to_batches()

    return lines.select("file", "value").mapInArrow(run, ", ".join(f"`{n}` string" for n in names))


def with_digests(files, piece=PIECE):
    """`files` (path, length, hash) with the digest that `hash` asks for and `error`.

    digest is NULL without a hash of known length, and when the file can't be read whole:
    then error says why.
    """
    names = ["path", "length", "hash", "digest", "error"]

    def run(batches):
        known = {}
        for batch in batches:
            digests, errors = [], []
            for path, length, wanted in zip(*(batch.column(c).to_pylist() for c in names[:3])):
                digest = error = None
                algorithm = ALGORITHMS.get(len(wanted or ""))
                if algorithm:
                    try:
                        with opened(path, known) as source:
                            size, digest = stream_digest(source, algorithm, piece)
                        if size != length:
                            digest, error = None, f"{size} of {length} bytes"
                    except UNOPENED as e:
                        digest, error = None, f"{type(e).__name__}: {e}"[:500]
                digests.append(digest)
                errors.append(error)
            given = [batch.column(c) for c in names[:3]]
            yield pa.RecordBatch.from_arrays([*given, pa.array(digests, pa.string()), pa.array(errors, pa.string())], names=names)

    rows = files.select("path", "length", "hash")
    # A few small files a task, one large one.
    tasks = rows.sparkSession.sparkContext.defaultParallelism * TASKS_PER_CORE
    spread = rows.repartition(tasks, F.xxhash64("path"))
    return spread.mapInArrow(run, "path string, length bigint, hash string, digest string, error string")
