"""Keyed loads and the checks around them."""

from pyspark.sql import Window
from pyspark.sql import functions as F

from starloom.operators.ranking import running_total
from starloom.operators.sizing import fits, small
from starloom.session import staged


def one_per_key(df, key, order):
    """The first row of each key in `order`.

    Spark keeps only each task's best row per key ahead of the shuffle
    (WindowGroupLimit), so a key with very many rows stays cheap.
    """
    w = Window.partitionBy(*key).orderBy(*order)
    return df.withColumn("_rank", F.row_number().over(w)).filter(F.col("_rank") == 1).drop("_rank")


def null_safe(left, right, key, how):
    """A semi or anti join by one key, in which NULL equals NULL."""
    other = right.select(F.col(key).alias("_other"))
    return left.join(other, left[key].eqNullSafe(F.col("_other")), how)


def known_keys(batch, table, key):
    """The keys of `table` that matter to `batch`, each once; NULL is one of them.

    The keys of a small batch are broadcast over the table's key column, so the
    table is scanned but never shuffled.
    """
    keys, held = batch.select(key), table.select(key)
    if fits(keys):
        found = null_safe(held, F.broadcast(keys.distinct()), key, "left_semi")
        return F.broadcast(found.distinct())
    return held.distinct()


def new_rows(batch, table, key="source_id"):
    """Rows of `batch` whose key is not in `table`."""
    return null_safe(batch, known_keys(batch, table, key), key, "left_anti")


def insertable(batch, table, order, key="source_id"):
    """What an append that ignores duplicate keys adds: new keys, one row each."""
    return one_per_key(new_rows(batch, table, key), [key], order)


def insert_outcome(batch, table, key="source_id"):
    """How many rows such an append inserts and skips, as one row."""
    per_key = batch.groupBy(key).agg(F.count("*").alias("n"))
    known = known_keys(batch, table, key).select(F.col(key).alias("_other"), F.lit(True).alias("known"))
    flagged = per_key.join(known, per_key[key].eqNullSafe(F.col("_other")), "left")
    inserted = F.count_if(F.col("known").isNull())
    return flagged.agg(
        inserted.alias("inserted"),
        (F.coalesce(F.sum("n"), F.lit(0)) - inserted).alias("skipped"),
    )


def upserted(batch, table, order, key="source_id"):
    """The table after an upsert: rows of `batch` replace those with the same key."""
    latest = staged(one_per_key(batch, [key], order).select(*table.columns), "latest")
    kept = null_safe(table, small(latest.select(key)), key, "left_anti")
    return kept.unionByName(latest)


def probe_keys(filtered, file_column, key="source_id"):
    """One key per file, enough to tell whether the file has been loaded."""
    return filtered.groupBy(file_column).agg(F.min(key).alias("probe"))


def file_presence(filtered, table, file_column, key="source_id"):
    """Per file, whether its probe key is in the table."""
    probes = probe_keys(filtered, file_column, key)
    found = known_keys(probes.select(F.col("probe").alias(key)), table, key)
    found = found.select(F.col(key).alias("probe"), F.lit(True).alias("_found"))
    return probes.join(found, "probe", "left").select(
        file_column, "probe", F.col("_found").isNotNull().alias("present")
    )


def whole_files(filtered, table, file_column, columns=()):
    """Files of which the table holds as many rows as there are and, given `columns`, the same ones.

    The columns stand in both tables; per file the sums of their rows' hashes are compared.
    """
    marks = [F.count("*").alias("rows")]
    if columns:
        marks.append(F.sum(F.xxhash64(*columns).cast("decimal(20,0)")).alias("hashes"))
    names = [file_column, "rows", *(["hashes"] if columns else [])]
    want = filtered.groupBy(file_column).agg(*marks)
    have = table.groupBy(file_column).agg(*marks)
    return want.join(have, names, "left_semi").select(file_column)


def rows_per_file(filtered, file_column):
    """Rows of every file and the running total over files in name order."""
    sizes = filtered.groupBy(file_column).agg(F.count("*").alias("rows"))
    return running_total(sizes, [file_column], "rows", "running")


def reconciled(sources, table):
    """Total of the sources against the total of the table, as one row."""
    sides = sources.select(F.lit(1).alias("s"), F.lit(0).alias("t")).unionAll(
        table.select(F.lit(0), F.lit(1))
    )
    source, loaded = F.coalesce(F.sum("s"), F.lit(0)), F.coalesce(F.sum("t"), F.lit(0))
    return sides.agg(
        source.alias("source_rows"),
        loaded.alias("table_rows"),
        (source == loaded).alias("equal"),
        (source - loaded).alias("difference"),
    )


def missing_elements(listed, loaded, key):
    """Listed elements that are not loaded yet."""
    return listed.join(loaded.select(key), key, "left_anti")


def same_rows(left, right):
    """Whether two tables hold the same bag of rows, as one row."""
    right = right.select(*left.columns)
    differing = left.exceptAll(right).unionAll(right.exceptAll(left))
    return differing.agg((F.count("*") == 0).alias("equal"))


def fingerprint(df):
    """Row count and an order-free sum of row hashes, as one row."""
    hashes = F.xxhash64(*sorted(df.columns)).cast("decimal(20,0)")
    return df.agg(F.count("*").alias("rows"), F.sum(hashes).alias("hash_sum"))
