"""URL rules and block lists as sorted arrays of 64-bit digests.

A list entry is a host and the start of a path, written together. A url is judged by
the entries that its host (or a parent domain) and the start of its path make: their
digests are looked up by binary search in the sorted keys, and the stored entry is
compared in full, so that equal digests of different entries do no harm.

A list within `MOST_ENTRIES` and `MOST_BYTES` becomes one file that each executor maps
into memory; a longer list stays a table, and the distinct candidates of all urls are
joined with it. Both give the same verdicts.
"""

import atexit
import os
import shutil
import struct
import tempfile
import uuid
from functools import lru_cache

import numpy as np
import pyarrow as pa
import xxhash
from pyspark import SparkFiles
from pyspark.sql import functions as F
from pyspark.sql import types as T

from starloom.operators.sizing import fits

MOST_ENTRIES = 2_000_000
MOST_BYTES = 128 * 1024 * 1024
HEAD = struct.Struct("<4sQQ")
SEED = 42  # the seed of Spark's xxhash64


def host_of(url):
    """Between the first `://` and `/`, `?`, `#` or the end, with A-Z lower-cased; else empty."""
    host = F.regexp_extract(url, r"(?s)^.*?://([^/?#]*)", 1)
    return F.coalesce(F.translate(host, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"), F.lit(""))


def path_of(url):
    """What follows the host, up to `?`, `#` or the end; else empty."""
    return F.coalesce(F.regexp_extract(url, r"(?s)^.*?://[^/?#]*([^?#]*)", 1), F.lit(""))


def digest(text):
    return xxhash.xxh64_intdigest(text.encode("utf-8", "surrogatepass"), SEED)


def pack(entries):
    """The bytes of a list of (entry, verdict): sorted keys, then the entries in their order."""
    rows = sorted((digest(e), e, v) for e, v in set(entries))
    keys = np.array([r[0] for r in rows], "<u8")
    blobs = [f"{e}\0{v}".encode("utf-8", "surrogatepass") for _, e, v in rows]
    ends = np.cumsum([0, *map(len, blobs)]).astype("<u8")
    lengths = np.array(sorted({len(e) - e.index("/") for _, e, _ in rows}), "<u8")
    return b"".join([HEAD.pack(b"URLX", len(rows), len(lengths)), b"\0" * 4, lengths.tobytes(), keys.tobytes(), ends.tobytes(), *blobs])


class DigestList:
    """A packed list, searched in place."""

    def __init__(self, data):
        magic, n, kinds = HEAD.unpack_from(data)
        if magic != b"URLX":
            raise ValueError("not a list of digests")
        at = HEAD.size + 4
        self.data = data
        self.path_lengths = np.frombuffer(data, "<u8", kinds, at).tolist()
        self.keys = np.frombuffer(data, "<u8", n, at + 8 * kinds)
        self.ends = np.frombuffer(data, "<u8", n + 1, at + 8 * kinds + 8 * n)
        self.start = at + 8 * kinds + 8 * (2 * n + 1)

    def find(self, candidates):
        """The verdict of each candidate that is an entry, else None."""
        wanted = np.array([digest(c) for c in candidates], "<u8")
        low = np.searchsorted(self.keys, wanted, "left")
        high = np.searchsorted(self.keys, wanted, "right")
        found = [None] * len(candidates)
        for i in np.flatnonzero(low < high).tolist():
            for place in range(int(low[i]), int(high[i])):
                a, b = int(self.ends[place]) + self.start, int(self.ends[place + 1]) + self.start
                entry, verdict = bytes(self.data[a:b]).decode("utf-8", "surrogatepass").rsplit("\0", 1)
                if entry == candidates[i]:
                    found[i] = verdict
        return found


@lru_cache(maxsize=4)
def _mapped(name):
    return DigestList(np.memmap(SparkFiles.get(name), dtype=np.uint8, mode="r"))


def candidates(host, path, path_lengths):
    """All entries that could fit a url, the longest first."""
    if not path:
        return []
    parts, starts = host, []
    while parts:
        starts.append(parts)
        _, _, parts = parts.partition(".")
    made = [h + path[:n] for h in starts for n in path_lengths if n <= len(path)]
    return sorted(set(made), key=lambda e: (-len(e), -e.index("/") if "/" in e else 0))


def shipped(spark, entries):
    """The name under which every executor finds the packed (entry, verdict) rows."""
    rows = [(r[0], r[1]) for r in entries.select("entry", "verdict").collect()]
    folder = tempfile.mkdtemp(prefix="starloom-list-")
    atexit.register(shutil.rmtree, folder, ignore_errors=True)
    name = f"urls-{uuid.uuid4().hex}.digests"
    with open(os.path.join(folder, name), "wb") as f:
        f.write(pack(rows))
    spark.sparkContext.addFile(os.path.join(folder, name))
    return name


def _by_file(rows, name):
    schema = T.StructType(list(rows.schema.fields)).add("entry", "string").add("listed", "string")
    hosts, paths = rows.columns.index("host"), rows.columns.index("path")

    def run(batches):
        index = _mapped(name)
        for batch in batches:
            made = [candidates(h, p, index.path_lengths)
                    for h, p in zip(batch.column(hosts).to_pylist(), batch.column(paths).to_pylist())]
            flat = [c for m in made for c in m]
            verdicts, entries, listed, at = index.find(flat), [], [], 0
            for m in made:
                hit = next((k for k in range(at, at + len(m)) if verdicts[k] is not None), None)
                entries.append(None if hit is None else flat[hit])
                listed.append(None if hit is None else verdicts[hit])
                at += len(m)
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array(entries, pa.string()), pa.array(listed, pa.string())],
                names=schema.names)

    return rows.mapInArrow(run, schema)


def _by_join(urls, entries):
    lengths = [r[0] for r in entries.select(
        (F.length("entry") - F.instr("entry", "/") + 1).alias("n")).distinct().orderBy("n").collect()]
    labels = F.split("host", r"\.")
    tails = F.transform(F.sequence(F.lit(1), F.size(labels)),
                        lambda i: F.array_join(F.slice(labels, i, F.size(labels) - i + 1), "."))
    tails = F.filter(tails, lambda t: t != "")
    made = F.flatten(F.transform(tails, lambda t: F.transform(
        F.filter(F.array(*[F.lit(n) for n in lengths]), lambda n: n <= F.length("path")),
        lambda n: F.concat(t, F.substring(F.col("path"), F.lit(1), n)))))
    each = urls.select("__url", F.explode(F.array_distinct(made)).alias("entry"))
    known = entries.groupBy("entry").agg(F.max("verdict").alias("listed"))
    # One row per distinct candidate meets the list, however many urls make it.
    hits = each.select("entry").distinct().join(known, "entry")
    best = F.struct(F.length("entry"), F.instr("entry", "/"), "entry", "listed")
    return (each.join(hits.select("entry", "listed"), "entry").groupBy("__url")
            .agg(F.max(best).alias("b")).select("__url", "b.entry", "b.listed"))


def looked_up(df, entries, url="url", most_entries=MOST_ENTRIES, most_bytes=MOST_BYTES):
    """`df` with host, path, `entry` (the longest that fits, or NULL) and `listed`, its verdict.

    `entries` has the columns entry (host and start of path) and verdict; of repeated
    entries the verdict that sorts last counts. Among entries of equal length the
    one with the longer host wins. NULL urls and urls without `://` fit no entry.
    """
    spark = df.sparkSession
    entries = entries.filter(F.contains("entry", F.lit("/"))).groupBy("entry").agg(F.max("verdict").alias("verdict"))
    kept = df.select([F.col(f"`{c}`") for c in df.columns if c not in ("host", "path", "entry", "listed")])
    link = F.col(f"`{url}`")
    rows = kept.select("*", host_of(link).alias("host"), path_of(link).alias("path"))
    if fits(entries, most_entries, most_bytes):
        return _by_file(rows, shipped(spark, entries))
    urls = rows.select(link.alias("__url"), "host", "path").filter("path <> ''").distinct()
    return rows.join(_by_join(urls, entries), link == F.col("__url"), "left").drop("__url")


def judged(df, rules, listed, url="url"):
    """`df` with host, path, `rule` (the longest that fits, or NULL) and `verdict`.

    Both lists have the columns entry and verdict. A url that no rule fits is judged by
    the second list, and allowed if it isn't in there either.
    """
    plain = df.select([F.col(f"`{c}`") for c in df.columns if c not in ("rule", "verdict")])
    ruled = looked_up(plain, rules, url).withColumnRenamed("entry", "rule").withColumnRenamed("listed", "__by_rule")
    both = looked_up(ruled, listed, url)
    verdict = F.coalesce("__by_rule", "listed", F.lit("allow"))
    return both.withColumn("verdict", verdict).drop("entry", "listed", "__by_rule")
