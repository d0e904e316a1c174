"""Broadcast decisions on checked sizes only."""

from pyspark.sql import functions as F
from pyspark.sql import types as T

ROWS = 500_000
BYTES = 64 * 1024 * 1024


def fits(df, rows=ROWS, size=BYTES):
    """Whether `df` has at most `rows` rows and `size` bytes, by a distributed count."""
    variable = (T.StringType, T.BinaryType)
    texts = [f.name for f in df.schema if isinstance(f.dataType, variable)]
    row_bytes = F.lit(8 * (len(df.columns) - len(texts))).cast("long")
    for t in texts:
        row_bytes = row_bytes + F.coalesce(F.octet_length(t), F.lit(0))
    seen = df.agg(F.count("*").alias("n"), F.sum(row_bytes).alias("bytes")).first()
    return seen["n"] <= rows and (seen["bytes"] or 0) <= size


def small(df, rows=ROWS, size=BYTES):
    """`df` with a broadcast hint when it fits; otherwise as it is, for a shuffled join."""
    return F.broadcast(df) if fits(df, rows, size) else df
