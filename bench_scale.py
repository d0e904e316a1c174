"""Times the heavy operators on many copies of the given line items.

    python bench_scale.py FOLDER_OF_TABLES COPIES WORK_FOLDER [name ...]

Every line item becomes COPIES stars with their own keys, directions and
distances. The star table is written once under WORK_FOLDER and used again by
later runs.
"""

import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from pyspark.sql import functions as F  # noqa: E402

from registry.fixtures import Tables  # noqa: E402
from registry.scalars import places  # noqa: E402
from starloom import schemas  # noqa: E402
from starloom.operators import bins, grid, loads, ranking, regions, sets  # noqa: E402
from starloom.plans.stars import derived  # noqa: E402
from starloom.session import build_session  # noqa: E402


def star_copies(tables, copies):
    rows = tables.positive_large.repartition(64).withColumn(
        "copy", F.explode(F.sequence(F.lit(0), F.lit(copies - 1)))
    )
    shift = F.col("copy") / F.lit(float(copies))
    return derived(
        rows.withColumns(
            {
                "source_id": F.col("source_id") * copies + F.col("copy"),
                "ra": (F.col("ra") + F.lit(360.0) * shift) % F.lit(360.0),
                "dec": F.col("dec") + shift - F.lit(0.5),
                "parallax": F.col("parallax") * (F.lit(0.9) + F.lit(0.2) * shift),
            }
        )
    )


def main(folder, copies, work, *only):
    spark = build_session(
        "scale",
        "local[8]",
        spark__sql__shuffle__partitions="64",
        spark__ui__enabled="false",
        spark__driver__memory="24g",
    )
    spark.sparkContext.setLogLevel("ERROR")
    tables = Tables(spark, folder)
    path = f"{work}/stars-{copies}"
    if not os.path.exists(f"{path}/_SUCCESS"):
        start = time.perf_counter()
        star_copies(tables, int(copies)).write.parquet(path)
        print(json.dumps({"derive_and_write": round(time.perf_counter() - start, 1)}), flush=True)
    stars = spark.read.parquet(path)
    boxes = regions.boxes(places(tables))
    jobs = {
        "rows": lambda: stars.agg(F.count("*")),
        "threshold_grid": lambda: grid.threshold_counts(stars),
        "set_counts": lambda: sets.set_counts(stars),
        "bin_count_100": lambda: bins.build(stars, bins.BIN_SETS[0]),
        "bin_count_10": lambda: bins.build(stars, bins.BIN_SETS[1]),
        "bin_mean_100": lambda: bins.build(stars, bins.BIN_SETS[4]),
        "histogram": lambda: bins.magnitude_histogram(stars),
        "within_boxes": lambda: regions.within_any(stars, boxes),
        "within_boxes_nested_loop": lambda: regions.within_any(stars, boxes, few=5000),
        "within_boxes_shuffled": lambda: regions.within_any(stars, boxes, few=0, many=0),
        "projection": lambda: sets.published(stars.filter(bins.BIN_SETS[0].predicate())),
        "slices": lambda: ranking.sliced(
            sets.published(stars.filter(sets.STAR_SETS[12].predicate()), "source_id"),
            schemas.SET_ORDER,
            ["source_id"],
            100,
        ),
        "insert_outcome": lambda: loads.insert_outcome(stars, stars.filter("abs_mag < 0")),
    }
    for name, job in jobs.items():
        if only and name not in only:
            continue
        start = time.perf_counter()
        job().write.format("noop").mode("overwrite").save()
        print(json.dumps({name: round(time.perf_counter() - start, 1)}), flush=True)
    print(json.dumps({"stars": stars.count()}))


if __name__ == "__main__":
    main(*sys.argv[1:])
