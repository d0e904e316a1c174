"""Quality filters, distance classes and gates."""

from pyspark.sql import functions as F

from starloom import fixed
from starloom.functions.astrometry import radius, signal_to_noise
from starloom.functions.rounding import col


def ingest_quality():
    """Rows worth keeping from a source file; a NULL drops the row."""
    return (F.col("parallax_over_error") > fixed.INGEST_SNR) & (F.col("parallax") > 0)


def load_quality(snr="px_over_err"):
    return col(snr) >= fixed.LOAD_SNR


def export_quality(parallax="parallax", error="parallax_error"):
    return signal_to_noise(parallax, error) > fixed.EXPORT_SNR


def distance_classes(dist="dist"):
    """Nearby, nearish and galactic as boolean columns."""
    d = col(dist)
    return {
        "nearby": d < 500.0,
        "nearish": d < 5000.0,
        "galactic": (d > 2000.0) & (d < 50000.0),
    }


def render_window(df):
    """Stars a viewer shows: a distance shell and a magnitude limit, from the positions."""
    r = radius()
    return df.filter(
        (r >= fixed.RENDER_NEAR)
        & (r <= fixed.RENDER_FAR)
        & (F.col("abs_mag") <= fixed.RENDER_MAG)
    )


def digits_only(text):
    return col(text).rlike(r"^[0-9]+$")


def identifier_kind(text):
    """True for the three identifier families of the cross-reference query."""
    text = col(text)
    return text.startswith("NAME ") | text.startswith("HIP ") | text.startswith("Gaia DR3 ")


def listed_under(ids, family):
    """Whether a `|`-separated identifier list has a member of `family`."""
    ids = col(ids)
    return ids.startswith(family) | ids.contains("|" + family)


def file_gate(df, file_column, minimum=fixed.MIN_ROWS_PER_FILE):
    """Rows per file and whether that is enough."""
    return file_gate_of(df.groupBy(file_column).agg(F.count("*").alias("rows")), minimum)


def file_gate_of(counts, minimum=fixed.MIN_ROWS_PER_FILE):
    """The same from counts that are there already."""
    return counts.withColumn("accepted", F.col("rows") >= minimum)
