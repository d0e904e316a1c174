"""Three-dimensional bins of stars: counts, means, summaries and normalised values."""

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column
from pyspark.sql import functions as F

from starloom import fixed
from starloom.functions.astrometry import radius
from starloom.functions.rounding import col, half_even_int
from starloom.operators.ranking import median
from starloom.session import staged


@dataclass(frozen=True)
class BinSet:
    """What to bin (`predicate`), how wide (`step`, light years) and what to measure."""

    name: str
    predicate: Callable[[], Column]
    step: float
    mean_of: str | None = None

    @property
    def value(self):
        return self.mean_of or "count"


def _near():
    return (F.col("dist") < 10000) & (F.col("px_over_err") > 5)


def _bright():
    return (F.col("px_over_err") > 10) & (F.col("abs_mag") < 0)


def _good():
    return F.col("px_over_err") > 10


# Predicates, steps and measures of the published bin sets.
BIN_SETS = (
    BinSet("count-near-100", _near, 100.0),
    BinSet("count-bright-10", _bright, 10.0),
    BinSet("count-good-500", _good, 500.0),
    BinSet("mean-magnitude-near-100", _near, 100.0, "abs_mag"),
    BinSet("mean-colour-near-100", _near, 100.0, "color"),
)


def bin_index(c, step):
    """Index of the bin whose centre is nearest; a half goes to the even bin."""
    return half_even_int(col(c) / F.lit(float(step)))


def binned(stars, step, *measures, axes=("x", "y", "z")):
    """One row per occupied bin with the given aggregates; one shuffle of partial results."""
    return stars.groupBy(*[bin_index(a, step).alias(a) for a in axes]).agg(*measures)


def build(stars, spec):
    """The bins of one bin set."""
    measure = F.avg(spec.mean_of) if spec.mean_of else F.count("*")
    return binned(stars.filter(spec.predicate()), spec.step, measure.alias(spec.value))


def together(bin_sets):
    """Bin sets that one pass over the stars can build, as lists of equal predicate and step."""
    groups = {}
    for s in bin_sets:
        groups.setdefault((s.predicate, s.step), []).append(s)
    return list(groups.values())


def build_together(stars, specs):
    """The bins of sets of equal predicate and step, with one column per set, named like it."""
    measures = [(F.avg(s.mean_of) if s.mean_of else F.count("*")).alias(s.name) for s in specs]
    return binned(stars.filter(specs[0].predicate()), specs[0].step, *measures)


def summary(bins, value):
    """Smallest, largest, mean and median value of a bin set, which is worked out once."""
    bins = staged(bins.select(value), "summary")
    middle = median(bins, value).scalar()
    return bins.agg(
        F.min(value).cast("double").alias("lowest"),
        F.max(value).cast("double").alias("highest"),
        F.avg(value).alias("mean"),
    ).withColumn("median", middle)


def normalised(bins, value, name=None):
    """Value scaled to 0..1 over the whole set; NULL if all values are equal."""
    low = bins.select(F.min(value).cast("double")).scalar()
    high = bins.select(F.max(value).cast("double")).scalar()
    return bins.withColumn(name or value, F.try_divide(col(value) - low, high - low))


def cut_low(bins, value, limit=fixed.BIN_CUT):
    """Drops bins whose normalised value is below `limit`."""
    return bins.filter(col(value) >= limit)


def with_distance(bins, step=None):
    """Distance of a bin from the origin, in steps; with `step` also its centre."""
    out = bins.withColumn("dist", radius())
    if step is not None:
        out = out.withColumns(
            {f"{a}_ly": F.col(a) * F.lit(float(step)) for a in ("x", "y", "z")}
        )
    return out


def magnitude_histogram(stars):
    """Rounded magnitude with the rounded mean distance and the count."""
    return stars.groupBy(half_even_int("abs_mag").alias("magnitude")).agg(
        half_even_int(F.avg("dist")).alias("mean_dist"), F.count("*").alias("rows")
    )


def magnitude_buckets(stars, by):
    """Rows per whole magnitude, cut towards 0, of each group."""
    return stars.groupBy(by, F.col("abs_mag").cast("long").alias("magnitude")).agg(F.count("*").alias("rows"))


def farthest(stars):
    """The distance of the farthest star, as one row."""
    return stars.agg(F.max(radius()).alias("farthest"))
