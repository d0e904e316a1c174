"""Star sets, bins and display attributes ready for publication."""

from pyspark.sql import functions as F

from starloom import fixed, schemas
from starloom.functions.astrometry import radius
from starloom.functions.photometry import brightness, rgb, size_class, temperature
from starloom.operators import bins as B
from starloom.operators.filters import render_window
from starloom.operators.grid import accepted, threshold_counts
from starloom.operators.ranking import sliced
from starloom.operators.sets import (
    STAR_SETS,
    index_of_sets,
    memberships,
    published,
    set_counts,
    size_gate,
)
from starloom.session import staged, staging
from starloom.sinks.arrays import write_slices
from starloom.sinks.tables import write_if_changed

STAR_FIELDS = ("x", "y", "z", "color", "abs_mag")


def set_rows(stars, sets=STAR_SETS, limit=None):
    """Published rows of every set, with set name and source, in one scan.

    Only with a `limit` are sets over it left out; the gate reports them.
    """
    kept = list(sets)
    if limit is not None:
        gate = size_gate(set_counts(stars, sets), limit).filter("suitable")
        names = {r["name"] for r in gate.select("name").collect()}
        kept = [s for s in sets if s.name in names]
    if not kept:
        return published(stars.limit(0).withColumn("set_name", F.lit("")), "set_name", "source_id")
    return published(memberships(stars, kept), "set_name", "source_id")


def set_slices(stars, sets=STAR_SETS, limit=None):
    """All suitable sets ranked and cut in slices, nearest first, by one shuffle."""
    return sliced(
        set_rows(stars, sets, limit),
        schemas.SET_ORDER,
        ["source_id"],
        fixed.SLICES_PER_SET,
        by=["set_name"],
    )


def write_sets(stars, path, sets=STAR_SETS, limit=None):
    """Job: array files of all suitable sets."""
    rows = set_rows(stars, sets, limit)
    return write_slices(
        rows, schemas.SET_ORDER, ["source_id"], STAR_FIELDS, path, by=["set_name"]
    )


def write_index(stars, path, sets=STAR_SETS, bin_sets=B.BIN_SETS):
    """Job: the index of sets with their sizes, rewritten only if it changed."""
    return write_if_changed(publication_index(stars, sets, bin_sets), path)


def publication_index(stars, sets=STAR_SETS, bin_sets=B.BIN_SETS):
    cubes = None
    for specs in B.together(bin_sets):
        sizes = B.build_together(stars, specs).agg(F.count("*").alias("rows"))
        one = sizes.select(F.explode(F.array(*[F.lit(s.name) for s in specs])).alias("name"), "rows")
        cubes = one if cubes is None else cubes.unionAll(one)
    return index_of_sets(set_counts(stars, sets), cubes)


def build_bins(stars, path, bin_sets=B.BIN_SETS):
    """Job: every bin set as its own table, rewritten only if it changed.

    Sets of equal predicate and step come from one pass over the stars.
    """
    changed = {}
    with staging(stars.sparkSession):
        for specs in B.together(bin_sets):
            every = staged(B.build_together(stars, specs), "bins")
            for s in specs:
                one = every.select("x", "y", "z", F.col(f"`{s.name}`").alias(s.value))
                changed[s.name] = write_if_changed(one, f"{path}/{s.name}")
    return changed


def bin_slices(bins, value):
    """A bin set normalised, ranked by distance and cut in slices."""
    rows = B.with_distance(B.normalised(bins, value))
    return sliced(rows, ["dist", "x", "y", "z"], [value], fixed.SLICES_PER_SET)


def write_bins(bins, value, path):
    """Job: array files of one bin set."""
    rows = B.with_distance(B.normalised(bins, value))
    return write_slices(
        rows, ["dist", "x", "y", "z"], [value], ("x", "y", "z", value), path
    )


def threshold_report(stars, minimum, maximum, **axes):
    """Job: threshold combinations whose set sizes are worth publishing."""
    return accepted(threshold_counts(stars, **axes), minimum, maximum)


def render_attributes(stars, window=True):
    """What a viewer draws for every star, by default only of those in its window."""
    colour = rgb()
    shown = render_window(stars) if window else stars
    return shown.select(
        "source_id",
        "x",
        "y",
        "z",
        radius().alias("dist"),
        size_class().alias("size_class"),
        brightness().alias("brightness"),
        temperature().alias("temperature"),
        *[colour[c].alias(c) for c in "rgb"],
    )


def size_groups(attributes):
    """Stars per size class with the reach of the scene, as a report."""
    return attributes.groupBy("size_class").agg(
        F.count("*").alias("rows"), F.max("dist").alias("farthest")
    )


def write_size_groups(attributes, path):
    """Job: positions and colours grouped by size class as folders; no group is ever collected."""
    attributes.write.mode("overwrite").partitionBy("size_class").parquet(path)


def render(stars, path, window=True):
    """Job: display attributes by size class, and the report of what was written."""
    write_size_groups(render_attributes(stars, window), path)
    return size_groups(stars.sparkSession.read.parquet(path))
