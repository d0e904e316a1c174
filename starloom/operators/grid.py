"""How many stars each combination of thresholds would keep."""

import pandas as pd
from pyspark.sql import Window
from pyspark.sql import functions as F

from starloom import fixed

AXES = ("snr", "dist", "mag")


def _first_kept(value, thresholds, above):
    """Place of the strictest threshold that a value satisfies; their number if none."""
    place = F
    for i, t in enumerate(thresholds):
        limit = F.lit(float(t))
        place = place.when(value > limit if above else value < limit, F.lit(i))
    return place.otherwise(F.lit(len(thresholds)))


def threshold_counts(
    stars, snr=fixed.GRID_SNR, dist=fixed.GRID_DIST, mag=fixed.GRID_MAG
):
    """Rows with px_over_err > snr, dist < dist and abs_mag < mag for every combination.

    Each list runs from strict to loose. Every star is put in the strictest cell
    it satisfies, in one scan whose partial results are at most one row per
    cell; running sums along the three axes over the small cube give the counts.
    The cost does not depend on how many thresholds there are. Stars that miss
    a loosest threshold land outside the cube and find no partner in it.
    """
    cells = (
        stars.select(
            _first_kept(F.col("px_over_err"), snr, True).alias("i_snr"),
            _first_kept(F.col("dist"), dist, False).alias("i_dist"),
            _first_kept(F.col("abs_mag"), mag, False).alias("i_mag"),
        )
        .groupBy("i_snr", "i_dist", "i_mag")
        .agg(F.count("*").alias("n"))
    )
    return _accumulated(cells, snr, dist, mag)


def _accumulated(cells, snr, dist, mag):
    spark = cells.sparkSession
    dense = spark.range(1).select()
    for axis, values in zip(AXES, (snr, dist, mag)):
        dense = dense.select(
            "*",
            F.posexplode(F.array(*[F.lit(float(v)) for v in values])).alias(f"i_{axis}", axis),
        )
    cube = dense.join(F.broadcast(cells), [f"i_{a}" for a in AXES], "left").withColumn(
        "n", F.coalesce("n", F.lit(0).cast("long"))
    )
    for axis in AXES:
        others = [f"i_{a}" for a in AXES if a != axis]
        along = (
            Window.partitionBy(*others)
            .orderBy(f"i_{axis}")
            .rowsBetween(Window.unboundedPreceding, 0)
        )
        cube = cube.withColumn("n", F.sum("n").over(along))
    return cube.withColumnRenamed("n", "rows")


def versus_nearer(grid, plateau=fixed.GRID_PLATEAU):
    """Adds the count at the previous distance and whether the count has levelled off."""
    w = Window.partitionBy("i_snr", "i_mag").orderBy("i_dist")
    return grid.withColumn("previous", F.lag("rows").over(w)).withColumn(
        "levelled", F.coalesce(F.col("previous") > F.lit(plateau) * F.col("rows"), F.lit(False))
    )


def accepted(
    grid, minimum=fixed.GRID_MIN_ROWS, maximum=fixed.GRID_MAX_ROWS, plateau=fixed.GRID_PLATEAU
):
    """The cells a search from strict to loose would report.

    The search goes through the distances of one quality level and, within each,
    through the magnitudes. It remembers the last count per magnitude, ends the
    quality level once a remembered count is above `plateau` times the present
    one, ends a distance once a count is above `maximum`, and forgets counts
    below `minimum`. A group has as many rows as there are thresholds, never
    more when the data grow.
    """

    def search(level: pd.DataFrame) -> pd.DataFrame:
        remembered, kept = {}, []
        for _, at_distance in level.sort_values(["i_dist", "i_mag"]).groupby("i_dist", sort=True):
            for row in at_distance.itertuples():
                if remembered.get(row.i_mag, 0) > plateau * row.rows:
                    return level.loc[kept]
                if row.rows >= minimum:
                    remembered[row.i_mag] = row.rows
                    if row.rows > maximum:
                        break
                    kept.append(row.Index)
        return level.loc[kept]

    columns = grid.select("i_snr", "i_dist", "i_mag", *AXES, "rows")
    return columns.groupBy("i_snr").applyInPandas(search, columns.schema)
