import itertools
import json
import os
import random
from contextlib import contextmanager

import pytest
from pyspark.sql import functions as F

from starloom import fixed, schemas
from starloom.operators import bins, catalogues, grid, loads, ranking, regions, sets
from starloom.operators.filters import ingest_quality, load_quality
from starloom.plans.stars import cluster_in_space
from starloom.sinks import arrays, tables
from starloom.sources.arrays import array_rows
from starloom.session import staging_path


@contextmanager
def settings(spark, **values):
    values = {k.replace("__", "."): v for k, v in values.items()}
    before = {k: spark.conf.get(k, None) for k in values}
    try:
        for k, v in values.items():
            spark.conf.set(k, v)
        yield
    finally:
        for k, v in before.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def some_stars(n, seed=1):
    rnd = random.Random(seed)
    return [
        (
            i,
            rnd.choice([1.0, 4.9, 5.0, 10.0, 30.0, 201.0]),
            rnd.uniform(-4000, 4000),
            rnd.uniform(-4000, 4000),
            rnd.uniform(-4000, 4000),
            # A third of all stars share one distance.
            500.0 if i % 3 == 0 else rnd.uniform(1, 12000),
            1.5,
            rnd.uniform(-8, 16),
        )
        for i in range(n)
    ]


def test_filters_drop_nulls_and_limits(spark):
    df = spark.createDataFrame(
        [(2.0, 1.0), (2.1, 1.0), (3.0, 0.0), (3.0, -1.0), (None, 1.0), (3.0, None)],
        "parallax_over_error double, parallax double",
    )
    assert df.filter(ingest_quality()).count() == 1
    df = spark.createDataFrame([(4.999,), (5.0,), (None,)], "px_over_err double")
    assert df.filter(load_quality()).count() == 1


@pytest.mark.parametrize("n", [0, 1, 37, 100, 1000])
def test_slices_tile_the_set(spark, star_frame, n):
    stars = some_stars(n)
    placed = ranking.sliced(star_frame(stars), schemas.SET_ORDER, ["source_id"], 100)
    got = {r.source_id: (r.position, r.slice) for r in placed.collect()}
    order = sorted(stars, key=lambda s: (s[5], s[2], s[3], s[4], s[6], s[7], s[0]))
    want = {}
    for i in range(100):
        for k in range(i * n // 100, (i + 1) * n // 100):
            want[order[k][0]] = (k, i)
    assert got == want


def test_positions_within_groups(spark):
    rows = [(g, v) for g in ("a", "b", None) for v in range(50)] + [("hot", v) for v in range(500)]
    random.Random(2).shuffle(rows)
    df = spark.createDataFrame(rows, "g string, v int")
    placed = ranking.positions(ranking.arrange(df, "g", "v"), ["g"])
    assert all(r.position == r.v for r in placed.collect())
    totals = {r.g: r.total for r in placed.select("g", "total").distinct().collect()}
    assert totals == {"a": 50, "b": 50, None: 50, "hot": 500}


def test_running_total_and_islands(spark):
    keys = [k for k, n in (("a", 30), ("b", 1), ("a", 40), (None, 5), ("c", 300)) for _ in range(n)]
    df = spark.createDataFrame(list(enumerate(keys)), "pos int, k string")
    got = [(r.pos, r.island, r.changed) for r in ranking.islands(df, ["pos"], "k").collect()]
    runs = [i for i, (_, g) in enumerate(itertools.groupby(keys), 1) for _ in g]
    want = [(p, i, p == 0 or runs[p - 1] != i) for p, i in enumerate(runs)]
    assert sorted(got) == want
    totals = ranking.running_total(df, ["pos"], "pos").collect()
    assert all(r.running == r.pos * (r.pos + 1) // 2 for r in totals)


@pytest.mark.parametrize("numbers", [[3.0], [1.0, 2.0], [5.0, 1.0, 3.0], [1.0] * 60 + [9.0, 10.0], []])
def test_exact_median(spark, numbers):
    import statistics

    df = spark.createDataFrame([(v,) for v in [*numbers, None]], "v double")
    want = statistics.median(numbers) if numbers else None
    assert ranking.median(df, "v").first()[0] == want


def test_set_counts_in_one_scan(spark, star_frame):
    stars = some_stars(500)
    got = {r.name: r.rows for r in sets.set_counts(star_frame(stars)).collect()}
    for p, d, m in fixed.SET_THRESHOLDS:
        want = sum(s[1] > p and s[5] < d and s[7] < m for s in stars)
        assert got[f"snr{p}-dist{d}-mag{m}"] == want


def test_bins_go_to_the_nearest_even_centre(spark, star_frame):
    rows = [(i, 20.0, x, 0.0, 0.0, 100.0, 1.0, float(i)) for i, x in enumerate([50.0, -50.0, 150.0, 151.0, -150.0])]
    built = bins.build(star_frame(rows), bins.BIN_SETS[0])
    assert sorted((r.x, r["count"]) for r in built.collect()) == [(-2, 1), (0, 2), (2, 2)]


def test_normalised_has_no_value_if_all_are_equal(spark):
    df = spark.createDataFrame([(1, 4), (2, 4)], "x int, n int")
    assert [r.n for r in bins.normalised(df, "n").collect()] == [None, None]
    df = spark.createDataFrame([(1, 4), (2, 8), (3, 5)], "x int, n int")
    assert sorted(r.n for r in bins.normalised(df, "n").collect()) == [0.0, 0.25, 1.0]


def test_grid_counts(spark, star_frame):
    stars = some_stars(400)
    cells = grid.threshold_counts(
        star_frame([*stars, (-1, None, 0.0, 0.0, 0.0, 1.0, 1.0, 1.0)]),
        (200, 10, 5),
        (500, 5000),
        (-1, 4, 15),
    ).collect()
    assert len(cells) == 18
    for c in cells:
        assert c.rows == sum(s[1] > c.snr and s[5] < c.dist and s[7] < c.mag for s in stars)


def test_grid_acceptance(spark):
    def cell(d, m, rows):
        return (0, d, m, 100.0, float(d), float(m), rows)

    cells = spark.createDataFrame(
        [
            cell(0, 0, 1), cell(0, 1, 20), cell(0, 2, 120),
            cell(1, 0, 10), cell(1, 1, 60), cell(1, 2, 125),
            cell(2, 0, 90), cell(2, 1, 61), cell(2, 2, 130),
        ],
        "i_snr int, i_dist int, i_mag int, snr double, dist double, mag double, rows long",
    )
    got = {(r.i_dist, r.i_mag) for r in grid.accepted(cells, 10, 100).collect()}
    # (0, 2) is too large and ends its distance; (1, 2) has levelled off and ends the level.
    assert got == {(0, 1), (1, 0), (1, 1)}


def box_frame(spark, rows):
    return spark.createDataFrame(rows, "lo_x double, hi_x double, lo_y double, hi_y double, lo_z double, hi_z double")


def test_boxes_by_every_route(spark, star_frame):
    rnd = random.Random(5)
    edges = []
    for _ in range(60):
        centre = [rnd.uniform(-4000, 4000) for _ in range(3)]
        half = rnd.choice([20.0, 200.0, 3000.0])
        edges.append(tuple(v for c in centre for v in (c - half, c + half)))
    edges.append((0.0, 0.0, 0.0, 0.0, 0.0, 0.0))
    stars = [*some_stars(600), (9001, 1.0, None, 0.0, 0.0, 1.0, 1.0, 1.0)]
    # On a face of the first box, and in the middle of one cell that holds very many.
    e = edges[0]
    stars.append((9002, 1.0, e[1], (e[2] + e[3]) / 2, (e[4] + e[5]) / 2, 1.0, 1.0, 1.0))
    stars += [(10000 + i, 1.0, (e[0] + e[1]) / 2, (e[2] + e[3]) / 2, (e[4] + e[5]) / 2, 1.0, 1.0, 1.0) for i in range(300)]

    def inside(s, b):
        return s[2] is not None and all(b[2 * a] < s[2 + a] < b[2 * a + 1] for a in range(3))

    want = sorted(s[0] for s in stars if any(inside(s, b) for b in edges))
    boxes, df = box_frame(spark, edges), star_frame(stars)
    for options in (dict(few=100), dict(few=0), dict(few=0, many=0)):
        found = regions.within_any(df, boxes, **options)
        assert found.columns == df.columns
        assert sorted(r.source_id for r in found.collect()) == want, options
    assert regions.within_any(df, boxes.limit(0), few=-1).count() == 0


def test_box_bounds(spark):
    df = spark.createDataFrame([(1000.0, -1000.0, 0.0)], "x double, y double, z double")
    r = regions.boxes(df).first()
    assert (r.lo_x, r.hi_x, r.lo_y, r.hi_y, r.lo_z, r.hi_z) == (750, 1250, -1250, -750, 0, 0)


def test_every_route_keeps_repeated_and_missing_keys(spark, star_frame):
    edges = [(0.0, 10.0, 0.0, 10.0, 0.0, 10.0)]
    df = star_frame([(k, 1.0, 5.0, 5.0, 5.0, 1.0, 1.0, 1.0) for k in (1, 2, 2)]).unionByName(
        star_frame([(3, 1.0, 5.0, 5.0, 5.0, 1.0, 1.0, 1.0)]).withColumn("source_id", F.lit(None).cast("long")))
    for options in (dict(few=100), dict(few=0), dict(few=0, many=0)):
        found = regions.within_any(df, box_frame(spark, edges), **options)
        assert sorted((r.source_id or 0) for r in found.collect()) == [0, 1, 2, 2], options


KEYED = "source_id long, rank int, v string"


def test_insert_ignoring_known_keys(spark):
    table = spark.createDataFrame([(1, 1, "old")], KEYED)
    batch = spark.createDataFrame([(1, 1, "a"), (2, 2, "b"), (2, 1, "c"), (3, 1, "d")], KEYED)
    got = loads.insertable(batch, table, ["rank"]).collect()
    assert sorted((r.source_id, r.v) for r in got) == [(2, "c"), (3, "d")]
    assert tuple(loads.insert_outcome(batch, table).first()) == (2, 2)
    assert tuple(loads.insert_outcome(batch.limit(0), table).first()) == (0, 0)


def test_upsert_takes_the_new_values(spark):
    table = spark.createDataFrame([(1, 1, "old"), (5, 1, "kept")], KEYED)
    batch = spark.createDataFrame([(1, 2, "late"), (1, 1, "new"), (2, 1, "b")], KEYED)
    got = loads.upserted(batch, table, ["rank"]).collect()
    assert sorted((r.source_id, r.v) for r in got) == [(1, "new"), (2, "b"), (5, "kept")]


def test_one_per_key_is_limited_ahead_of_the_shuffle(spark):
    df = spark.range(100).selectExpr("id % 3 AS k", "id AS v")
    plan = loads.one_per_key(df, ["k"], ["v"])._jdf.queryExecution().executedPlan().toString()
    assert "row_number(), 1, Partial" in plan


def test_repeated_loads_change_nothing(spark):
    path = staging_path(spark, "test-append")
    batch = spark.createDataFrame([(i, i % 2, "v") for i in range(50)], KEYED)
    for _ in range(2):
        tables.append_new(batch, path, ["rank"])
    assert spark.read.parquet(path).count() == 50
    path = staging_path(spark, "test-append-files")
    files = batch.withColumn("file", F.col("source_id") % 5)
    tables.append_files(files.filter("file = 1"), path, "file")
    for _ in range(2):
        tables.append_files(files, path, "file")
    assert spark.read.parquet(path).count() == 50


def test_missing_keys_and_files_are_loaded_once(spark):
    rows = spark.createDataFrame([(1, 1, "a"), (None, 1, "x"), (None, 2, "y"), (3, 1, "c")], KEYED)
    path = staging_path(spark, "test-null-keys")
    for _ in range(3):
        tables.append_new(rows, path, ["rank"])
    assert sorted(map(str, (r.source_id for r in spark.read.parquet(path).collect()))) == ["1", "3", "None"]
    assert tuple(loads.insert_outcome(rows, spark.read.parquet(path)).first()) == (0, 4)
    assert loads.upserted(rows, spark.read.parquet(path), ["rank"]).count() == 3
    path = staging_path(spark, "test-null-files")
    tables.append_files(spark.createDataFrame([(1, "a")], "source_id bigint, file string"), path, "file")
    for _ in range(2):
        more = spark.createDataFrame([(2, None), (3, "c"), (None, None)], "source_id bigint, file string")
        tables.append_files(more, path, "file")
    got = {(r.source_id, r.file) for r in spark.read.parquet(path).collect()}
    assert got == {(1, "a"), (2, None), (3, "c"), (None, None)} and spark.read.parquet(path).count() == 4


def test_write_only_when_changed(spark):
    path = staging_path(spark, "test-guarded")
    a = spark.createDataFrame([(1, "a"), (2, "b"), (2, "b")], "i int, v string")
    assert tables.write_if_changed(a, path)
    assert not tables.write_if_changed(a.orderBy(F.desc("i")), path)
    assert tables.write_if_changed(a.distinct(), path)
    assert loads.same_rows(spark.read.parquet(path), a).first()[0] is False
    assert loads.same_rows(a, a.orderBy("i")).first()[0] is True


def test_array_files_come_back(spark):
    path = staging_path(spark, "test-array")
    rows = [(float(i), -i / 7, f'name "{i}", [x]') for i in range(150)]
    df = spark.createDataFrame(rows, "x double, y double, name string")
    arrays.write_array(df, ["x", "y", "name"], ["x"], "labels", path)
    text = "\n".join(r.value for r in spark.read.text(path).collect())
    assert text.startswith('var labels = [[0.0,0.0,"name') and text.endswith("]]")
    back = array_rows(spark, path, df.schema, wrapped=True).collect()
    assert [(r.x, r.name) for r in back] == [(r[0], r[2]) for r in rows]


def test_slice_files(spark, star_frame):
    path = staging_path(spark, "test-slices")
    fields = ("x", "y", "z", "color", "abs_mag")
    arrays.write_slices(
        sets.published(star_frame(some_stars(250)), "source_id"),
        schemas.SET_ORDER,
        ["source_id"],
        fields,
        path,
    )
    import json

    files = spark.read.option("recursiveFileLookup", "true").text(path, wholetext=True).collect()
    assert len(files) == 100
    sizes = sorted(len(json.loads(f.value.removeprefix("var data = "))) for f in files)
    assert sum(sizes) == 250 and sizes[-1] - sizes[0] <= 1


def test_a_slice_of_many_parts_reads_in_order(spark, star_frame):
    rows = [(i, 10.0, float(i % 7), float(-i), 0.5, float(i * 37 % 1000), 1.0, 2.0) for i in range(1000)]
    path = staging_path(spark, "test-slice-parts")
    with settings(spark, spark__sql__shuffle__partitions="400", spark__sql__adaptive__coalescePartitions__enabled="false"):
        arrays.write_slices(star_frame(rows), ("dist", "x"), ["source_id"], ("dist", "y"), path)
    several, everything = 0, []
    for i in range(100):
        parts = sorted(n for n in os.listdir(f"{path}/slice={i}") if n.startswith("part-"))
        several += len(parts) > 1
        text = "".join(open(f"{path}/slice={i}/{n}").read() for n in parts)
        assert text.startswith("var data = [[") and text.endswith("]]\n") and text.count("var") == 1
        everything += json.loads(text.split("=", 1)[1])
    assert several > 50
    assert everything == [[float(r[5]), float(r[3])] for r in sorted(rows, key=lambda r: (r[5], r[2], r[0]))]


def clustered_stars(spark, star_frame, path):
    rng = random.Random(3)
    rows = [(i, 10.0, *(rng.uniform(-5000, 5000) for _ in range(3)), 1.0, 1.0, 2.0) for i in range(20_000)]
    star_frame(rows).repartition(1).write.option("parquet.block.size", 8192).parquet(f"{path}/plain")
    with settings(spark, spark__sql__shuffle__partitions="64", spark__sql__adaptive__coalescePartitions__enabled="false"):
        cluster_in_space(spark, f"{path}/plain", f"{path}/curve")
    return rows


def rows_scanned(df):
    """What the Parquet scans under `df` handed on after skipping row groups and files."""
    plan = df._jdf.queryExecution().executedPlan()
    df.collect()
    found, todo = 0, [plan]
    while todo:
        node = todo.pop()
        name = node.nodeName()
        if name.startswith("AdaptiveSparkPlan"):
            todo.append(node.executedPlan())
        elif "QueryStage" in name:
            todo.append(node.plan())
        if name.startswith("Scan parquet") and node.metrics().contains("numOutputRows"):
            found += node.metrics().apply("numOutputRows").value()
        children = node.children()
        todo += [children.apply(k) for k in range(children.size())]
    return found


@pytest.mark.parametrize("options", [{}, {"few": 0}, {"few": 0, "many": 0}], ids=["direct", "lookup", "shuffle"])
def test_bounds_reach_the_scan(spark, star_frame, tmp_path, options):
    stars = clustered_stars(spark, star_frame, str(tmp_path))
    places = [(f"c{i}", 3000.0 + i, 3000.0 - i, 2900.0) for i in range(3)] + [("far", -4000.0, 100.0, 50.0)]
    listed = regions.boxes(spark.createDataFrame(places, "name string, x double, y double, z double"), 0.0, 200.0)
    kept = {r[0] for r in stars if any(all(abs(r[2 + k] - p[1 + k]) < 200 for k in range(3)) for p in places)}
    curve = spark.read.parquet(f"{tmp_path}/curve")
    got = regions.within_any(curve, listed, **options)
    assert {r.source_id for r in got.select("source_id").collect()} == kept and kept
    if not options.get("many", 1):
        return  # the candidates were written on the way; what they read is the same filter
    with settings(spark, spark__sql__maxMetadataStringLength="100000"):
        plan = regions.within_any(curve, listed, **options)._jdf.queryExecution().executedPlan().toString()
    assert "GreaterThan(x" in plan and "LessThan(z" in plan


def test_a_space_order_lets_scans_skip(spark, star_frame, tmp_path):
    clustered_stars(spark, star_frame, str(tmp_path))
    listed = regions.boxes(spark.createDataFrame([("c", 3000.0, 3000.0, 3000.0)], "name string, x double, y double, z double"), 0.0, 200.0)
    edges = regions.envelopes(listed.select(*[f"{s}_{a}" for a in "xyz" for s in ("lo", "hi")]))
    read = {}
    for name in ("plain", "curve"):
        table = spark.read.parquet(f"{tmp_path}/{name}")
        read[name] = rows_scanned(table.filter(regions.within_envelopes(edges)).select("source_id"))
    assert read["curve"] < read["plain"] / 3


def test_names_joined_in_order(spark):
    df = spark.createDataFrame(
        [(1, p, f"n{p}") for p in range(25_000)] + [(2, 1, "y"), (2, 0, "x")], "k int, pos int, name string"
    )
    whole = {r.k: r.names for r in catalogues.joined_text(df, ["k"], ["pos"], "name", "names").collect()}
    assert whole == {1: " / ".join(f"n{p}" for p in range(25_000)), 2: "x / y"}


def test_objects_with_very_many_identifiers_keep_their_cross_references(spark):
    ident = spark.createDataFrame(
        [(1, f"X {i}") for i in range(12_000)] + [(1, "NAME Far "), (1, "HIP 7"), (2, "NAME Near ")], "oidref long, id string")
    ids = spark.createDataFrame(
        [(1, "|".join([*(f"X {i}" for i in range(12_000)), "NAME Far ", "HIP 7"])), (2, "NAME Near ")], "oidref long, ids string")
    found = {(r.oidref, r.id) for r in catalogues.cross_references(ident, ids).collect()}
    assert found == {(1, "NAME Far "), (1, "HIP 7")}


def test_name_lists(spark):
    schema = "hip string, name string, pos long"
    first = spark.createDataFrame([("7", "Old", 1), ("7", "New", 2), ("-", "None", 3), ("12 A", "Odd", 4)], schema)
    second = spark.createDataFrame([("7", "Second", 1), ("8", "Alone", 2), ("7", "Third", 3), ("", "No", 4)], schema)
    got = {r.hip: r.name for r in catalogues.list_names(first, second).collect()}
    assert got == {7: "New / Second / Third", 8: "Alone"}


def test_objects_without_any_identifier(spark):
    rows = [(1, 1, "NAME A "), (2, 2, "HIP 5"), (2, 3, "HIP 6"), (3, 4, "Gaia DR3 9"), (4, 5, "Gaia DR3 9"), (5, 6, "HIP 6")]
    found = catalogues.objects(spark.createDataFrame(rows, "oid long, pos long, id string"))
    numbers = catalogues.objects_by_number(found).collect()
    assert [(r.hip, r.oid) for r in numbers] == [(6, 5)]
    assert [(r.source_id, r.oid) for r in catalogues.objects_by_source(found).collect()] == [(9, 4)]
