"""Named star sets: membership, counts in one scan, size gate and index."""

from dataclasses import dataclass
from functools import reduce
from operator import or_

from pyspark.sql import functions as F

from starloom import fixed
from starloom.functions.rounding import fixed_text, half_away


@dataclass(frozen=True)
class StarSet:
    """Strict limits on parallax quality, distance and magnitude."""

    snr: float
    dist: float
    mag: float

    @property
    def name(self):
        return f"snr{self.snr}-dist{self.dist}-mag{self.mag}"

    def predicate(self):
        return (
            (F.col("px_over_err") > self.snr)
            & (F.col("dist") < self.dist)
            & (F.col("abs_mag") < self.mag)
        )


STAR_SETS = tuple(StarSet(*t) for t in fixed.SET_THRESHOLDS)


def memberships(stars, sets=STAR_SETS):
    """One row per star and set it belongs to, from a single scan.

    The filter ahead, which the explosion would hide, reaches the scan.
    """
    names = F.array(*[F.when(s.predicate(), F.lit(s.name)) for s in sets])
    in_any = reduce(or_, [s.predicate() for s in sets])
    return stars.filter(in_any).withColumn("set_name", F.explode(F.array_compact(names)))


def counts(stars, predicates):
    """Rows under each named predicate, all from one scan, as (name, rows)."""
    items = list(predicates.items())
    wide = stars.agg(*[F.count_if(p).alias(f"c{i}") for i, (_, p) in enumerate(items)])
    pairs = [
        F.struct(F.lit(n).alias("name"), F.col(f"c{i}").alias("rows"))
        for i, (n, _) in enumerate(items)
    ]
    return wide.select(F.inline(F.array(*pairs)))


def set_counts(stars, sets=STAR_SETS):
    return counts(stars, {s.name: s.predicate() for s in sets})


def size_gate(set_rows, limit=fixed.MAX_ROWS_PER_SET):
    """Keeps the report of all sets and tells which are small enough to publish."""
    return set_rows.withColumn("suitable", F.col("rows") <= limit)


def index_of_sets(star_set_rows, bin_set_rows):
    """Name and kind of everything published, with its size."""
    return star_set_rows.select("name", F.lit("stars").alias("kind"), "rows").unionAll(
        bin_set_rows.select("name", F.lit("cubes").alias("kind"), "rows")
    )


def published_columns():
    """The rounded projection of a published star; the distance stays as it is."""
    return {
        **{c: half_away(c, 1) for c in ("x", "y", "z", "color")},
        "abs_mag": half_away("abs_mag", 0),
        "dist": F.col("dist"),
    }


def published(stars, *extra):
    """Stars in the rounded projection, with `extra` columns kept."""
    return stars.select(*extra, *[c.alias(n) for n, c in published_columns().items()])


def published_text(stars, *extra):
    """Variant in which all five values are text with one decimal."""
    return stars.select(
        *extra,
        *[fixed_text(c, 1).alias(c) for c in ("x", "y", "z", "color", "abs_mag")],
        "dist",
    )
