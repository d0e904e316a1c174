"""A stored table with one row per key, in ranges of keys that change one by one.

    rows/write=W/range=R/      the rows of range R that write W brought
    filters/write=W/range=R/   their key digests, as words of bits
    versions/N/                per range its lowest key, its live writes and their rows

A version is complete or not there: readers take the newest complete one, so a load that
dies half-way leaves the table as it was. A load places its keys by the ranges' bounds and
asks the filters of those ranges. Keys that no filter knows are new: they are added as
files of their own and no data file is read. Ranges that may hold a key are read by key
column; an upsert rewrites those that do hold one. Every other range keeps its files.
One load runs at a time. Keys are whole numbers; NULL is a key like any other, in the
first range.
"""

import math
import uuid
from typing import NamedTuple

from pyspark.sql import functions as F

from starloom import folders
from starloom.operators.loads import null_safe, one_per_key
from starloom.session import staged, staging

RANGE_ROWS = 1 << 20  # rows a range is made for; one of twice as many is split
BITS_PER_ROW = 16
MOST_WRITES = 16  # a range of more writes is put together when it is next touched
LISTING, LISTING_TASKS = "spark.sql.sources.parallelPartitionDiscovery.parallelism", 64
RANGE, SLOT, BIT = "_range", "_slot", "_bit"
VERSION = "range int, low bigint, writes array<string>, rows bigint"


class Outcome(NamedTuple):
    """What a load did: rows by kind, and the ranges that it read and rewrote."""

    inserted: int
    replaced: int
    skipped: int
    read: list
    rewritten: list


class KeyedTable:
    def __init__(self, spark, path, key="source_id", range_rows=RANGE_ROWS):
        self.spark, self.path, self.key, self.range_rows = spark, path.rstrip("/"), key, range_rows

    # Versions

    def _newest(self):
        done = [n for n in folders.names(self.spark, f"{self.path}/versions")
                if n.isdigit() and folders.exists(self.spark, f"{self.path}/versions/{n}/_SUCCESS")]
        return max(done, default=None)

    def ranges(self):
        """Range, lowest key, writes and rows of the newest version, in key order; one row per range."""
        newest = self._newest()
        if newest is None:
            return []
        rows = self.spark.read.schema(VERSION).parquet(f"{self.path}/versions/{newest}").collect()
        return sorted(rows, key=lambda r: (r["low"] is not None, r["low"]))

    def _commit(self, ranges):
        newest = self._newest()
        number = f"{int(newest or 0) + 1:010d}"
        self.spark.createDataFrame(ranges, VERSION).coalesce(1).write.parquet(f"{self.path}/versions/{number}")
        return number

    # Reading

    def _paths(self, kind, ranges):
        return [f"{self.path}/{kind}/write={w}/range={r['range']}" for r in ranges for w in r["writes"]]

    def _read(self, kind, paths):
        """The files below `paths`. By default a task lists one path, and there are as many paths as ranges."""
        before = self.spark.conf.get(LISTING)
        self.spark.conf.set(LISTING, min(LISTING_TASKS, int(before)))
        try:
            rows = self.spark.read.option("basePath", f"{self.path}/{kind}").parquet(*paths)
        finally:
            self.spark.conf.set(LISTING, before)
        return rows.withColumnRenamed("range", RANGE).drop("write")

    def _stored(self, kind, ranges):
        paths = self._paths(kind, ranges)
        return self._read(kind, paths) if paths else None

    def rows(self):
        """The table, or None before the first load."""
        stored = self._stored("rows", self.ranges())
        return stored.drop(RANGE) if stored is not None else None

    # Places

    def _placed(self, df, ranges):
        """`df` with the range of each key, by binary search among the ranges' lowest keys.

        The search is one column per halving, which Spark compiles. Filters on the range
        would be pushed through all of them: stage the rows ahead of joins by range.
        """
        lows = [r["low"] for r in ranges[1:]]
        table = F.split(F.lit(",".join(map(str, lows))), ",").cast("array<bigint>")
        names = F.split(F.lit(",".join(str(r["range"]) for r in ranges)), ",").cast("array<int>")
        key, at = F.col(self.key).cast("bigint"), F.col(RANGE)
        out = df.withColumn(RANGE, F.lit(0))
        for step in [1 << n for n in reversed(range(len(lows).bit_length()))]:
            # Beyond the table, and for a NULL key, there is nothing to compare.
            out = out.withColumn(RANGE, at + F.when(F.get(table, at + (step - 1)) <= key, step).otherwise(0))
        return out.withColumn(RANGE, F.get(names, at))

    def _slots(self):
        return max(1, self.range_rows * BITS_PER_ROW // 64)

    def _digested(self, df):
        digest = F.xxhash64(F.col(self.key).cast("bigint"))
        return df.withColumns({SLOT: F.pmod(F.shiftright(digest, 6), F.lit(self._slots())).cast("int"),
                               BIT: F.pmod(digest, F.lit(64)).cast("int")})

    def _possible(self, placed, ranges):
        """Of the given ranges those whose filters know a key of `placed`."""
        filters = self._stored("filters", ranges)
        if filters is None:
            return []
        asked = self._digested(placed.select(self.key, RANGE))
        hit = asked.join(filters, [RANGE, SLOT]).filter(F.getbit("word", F.col(BIT)) == 1)
        return sorted(r[RANGE] for r in hit.select(RANGE).distinct().collect())

    # Loads

    def insert_new(self, batch, order):
        """Adds one row for each key that the table doesn't have, the first one in `order`."""
        return self._load(batch, order, replace=False)

    def upsert(self, batch, order):
        """The first row in `order` of each key of `batch` takes the place of the key's row, or is added."""
        return self._load(batch, order, replace=True)

    def _load(self, batch, order, replace):
        with staging(self.spark):
            total = staged(batch, "batch")
            ranges = [r.asDict() for r in self.ranges()] or [{"range": 0, "low": None, "writes": [], "rows": 0}]
            by_id = {r["range"]: r for r in ranges}
            placed = staged(self._placed(one_per_key(total, [self.key], order), ranges), "placed")
            asked = {r[RANGE]: r["n"] for r in placed.groupBy(RANGE).agg(F.count("*").alias("n")).collect()}
            read = self._possible(placed, [by_id[r] for r in asked])
            known, fresh = {}, placed
            if read:
                stored = self._stored("rows", [by_id[r] for r in read]).select(self.key)
                # One join tells the known keys from the new ones: an upsert asks for the first, an insert for the second.
                if replace:
                    found = null_safe(placed.select(self.key, RANGE), stored, self.key, "left_semi")
                    known = {r[RANGE]: r["n"] for r in found.groupBy(RANGE).agg(F.count("*").alias("n")).collect()}
                else:
                    fresh = staged(null_safe(placed, stored, self.key, "left_anti"), "fresh")
                    left = {r[RANGE]: r["n"] for r in fresh.groupBy(RANGE).agg(F.count("*").alias("n")).collect()}
                    known = {r: n - left.get(r, 0) for r, n in asked.items() if n > left.get(r, 0)}
            held, given = sum(known.values()), sum(asked.values())
            counts = asked if replace else {r: n - known.get(r, 0) for r, n in asked.items() if n > known.get(r, 0)}
            rewritten = self._write(fresh, ranges, by_id, counts, known if replace else {}) if counts else []
            skipped = total.count() - given + (0 if replace else held)
            return Outcome(given - held, held if replace else 0, skipped, read, rewritten)

    def _write(self, fresh, ranges, by_id, counts, replaced):
        """Writes `fresh`, of which range r has counts[r] rows and replaced[r] known keys; the ranges written anew."""
        for r, n in counts.items():
            by_id[r]["rows"] += n - replaced.get(r, 0)
        large = [r for r in counts if by_id[r]["rows"] > 2 * self.range_rows]
        again = {r for r in counts if by_id[r]["writes"] and (replaced.get(r) or r in large or len(by_id[r]["writes"]) >= MOST_WRITES)}
        rows = fresh
        if again:
            kept = self._stored("rows", [by_id[r] for r in again])
            if replaced:
                kept = null_safe(kept, fresh.select(self.key), self.key, "left_anti")
            rows = kept.unionByName(fresh, allowMissingColumns=True)
        dead = {(w, r) for r in again for w in by_id[r]["writes"]}
        changed = ranges
        if large:
            rows = staged(rows, "loaded")
            pieces = self._split(rows, [by_id[r] for r in large], max(by_id) + 1)
            changed = sorted([r for r in ranges if r["range"] not in large] + pieces, key=lambda r: (r["low"] is not None, r["low"]))
            rows = self._placed(rows.drop(RANGE), changed)
        write = uuid.uuid4().hex
        # A range is bounded, so it is one task.
        out = rows.repartition(RANGE).sortWithinPartitions(RANGE, self.key).withColumnRenamed(RANGE, "range")
        out.write.partitionBy("range").parquet(f"{self.path}/rows/write={write}")
        written = self._read("rows", [f"{self.path}/rows/write={write}"])
        # Rows of a range stand together already, so its words need no second shuffle of rows.
        words = self._digested(written.select(self.key, RANGE)).groupBy(RANGE, SLOT).agg(
            F.bit_or(F.call_function("shiftleft", F.lit(1).cast("long"), F.col(BIT))).alias("word"))
        words.repartition(RANGE).sortWithinPartitions(RANGE, SLOT).withColumnRenamed(RANGE, "range").write.partitionBy("range").parquet(
            f"{self.path}/filters/write={write}")
        if large:
            sizes = {r[RANGE]: r["n"] for r in written.groupBy(RANGE).agg(F.count("*").alias("n")).collect()}
            for r in changed:
                if r["range"] in sizes and (r["range"] in large or r["range"] not in by_id):
                    r["writes"], r["rows"] = [write], sizes[r["range"]]
        for r in counts:
            if r not in large:
                by_id[r]["writes"] = [write] if r in again else [*by_id[r]["writes"], write]
        number = self._commit([(r["range"], r["low"], r["writes"], r["rows"]) for r in changed])
        for w, r in dead:
            folders.drop(self.spark, f"{self.path}/rows/write={w}/range={r}")
            folders.drop(self.spark, f"{self.path}/filters/write={w}/range={r}")
        for old in folders.names(self.spark, f"{self.path}/versions"):
            if old.isdigit() and int(old) < int(number) - 1:
                folders.drop(self.spark, f"{self.path}/versions/{old}")
        return sorted(again)

    def _split(self, rows, large, free):
        """Ranges in place of each of `large`, of about range_rows rows each."""
        pieces = {r[RANGE]: -(-r["n"] // self.range_rows) for r in
                  rows.filter(F.col(RANGE).isin([r["range"] for r in large])).groupBy(RANGE).agg(F.count("*").alias("n")).collect()}
        most = max(pieces.values())
        steps = [k / most for k in range(1, most)]
        cuts = rows.filter(F.col(RANGE).isin(list(pieces))).groupBy(RANGE).agg(
            F.percentile_approx(F.col(self.key).cast("bigint"), F.array(*map(F.lit, steps)), 100 * most).alias("cuts")) if steps else None
        found = {r[RANGE]: r["cuts"] or [] for r in cuts.collect()} if cuts is not None else {}
        out = []
        for r in large:
            n, cut = pieces[r["range"]], found.get(r["range"], [])
            lows = {cut[math.ceil(k * most / n) - 1] for k in range(1, n)} if cut else set()
            lows = sorted(x for x in lows if r["low"] is None or x > r["low"])
            out.append({"range": r["range"], "low": r["low"], "writes": [], "rows": 0})
            out += [{"range": free + k, "low": x, "writes": [], "rows": 0} for k, x in enumerate(lows)]
            free += len(lows)
        return out
