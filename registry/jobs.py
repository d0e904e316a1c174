"""Composite jobs and streams."""

from pyspark.sql import functions as F

from registry.core import LY, published_sql, query
from registry.fixtures import write_named_files, write_pages, write_source_files
from registry.relations import (
    ACCEPT_SQL,
    INSIDE_SQL,
    LABELS_SQL,
    NEAR,
    RGB_SQL,
    SLICE_SQL,
    UNNUMBERED_SQL,
    bins_sql,
    checksums_of,
    digest_of,
    label_files,
    label_inputs,
    slice_report,
)
from registry.scalars import SETS_SQL, places, rounded
from starloom import schemas
from starloom.operators import bins
from starloom.plans import objects, publish, worklist
from starloom.plans.stars import ingest, load
from starloom.sinks.keyed import KeyedTable
from starloom.sources.labels import NEBULA, listed_file
from starloom.streaming import arrivals

FILTERED_SQL = ", ".join(schemas.FILTERED_COLUMNS)


@query("c01_ingest", f"SELECT {FILTERED_SQL} FROM t_filtered")
def _(t):
    source = write_source_files(t.raw, t.scratch("source"))
    path = t.scratch("filtered")
    ingest(t.spark, source, path)
    return t.spark.read.parquet(path).select(*schemas.FILTERED_COLUMNS)


LOADED = "FROM t_stars WHERE px_over_err >= 5 AND source_id IN (SELECT source_id FROM t_filtered)"
STARS_SQL = """SELECT source_id, round(px_over_err, 6) AS px_over_err, round(x, 6) AS x, round(y, 6) AS y,
 round(z, 6) AS z, round(dist, 6) AS dist, color, round(abs_mag, 6) AS abs_mag """


@query("c02_derive_and_load", STARS_SQL + LOADED)
def _(t):
    source, path, stars = (
        write_source_files(t.raw, t.scratch("source")),
        t.scratch("filtered"),
        t.scratch("stars"),
    )
    ingest(t.spark, source, path)
    load(t.spark, path, stars)
    # A second run finds every file loaded and adds nothing.
    load(t.spark, path, stars)
    return rounded(t.spark.read.parquet(stars).select(*schemas.STAR_COLUMNS), "color")


@query(
    "c02_load_report",
    """SELECT file_no, rows, CAST(sum(rows) OVER (ORDER BY file_no) AS BIGINT) AS running, true AS equal
FROM (SELECT file_no, count(*) AS rows FROM t_filtered WHERE parallax / parallax_error >= 5 GROUP BY file_no) f""",
)
def _(t):
    path, stars = t.scratch("filtered"), t.scratch("stars")
    kept = t.filtered.withColumn("file_id", F.format_string("%012d", "file_no"))
    kept.drop("file_no").write.partitionBy("file_id").parquet(path)
    sizes, totals = load(t.spark, path, stars)
    return sizes.select(
        F.col("file_id").cast("bigint").alias("file_no"),
        "rows",
        "running",
        totals.select("equal").scalar().alias("equal"),
    )


SET_SLICES = SLICE_SQL.replace("SELECT slice,", "SELECT set_name, slice,", 1)
SET_SLICES = SET_SLICES.replace("GROUP BY slice", "GROUP BY set_name, slice")
SET_SLICES = SET_SLICES.replace("OVER (ORDER BY dist, x", "OVER (PARTITION BY set_name ORDER BY dist, x")
SET_SLICES = SET_SLICES.replace("count(*) OVER ()", "count(*) OVER (PARTITION BY set_name)")
ALL_SETS = f"({published_sql(f"({SETS_SQL.format(source='t_stars')}) m", 'set_name, source_id')}) p"


@query("c03_set_export", SET_SLICES.format(source=ALL_SETS))
def _(t):
    return slice_report(publish.set_slices(t.stars), "set_name")


@query(
    "c04_neighbourhood_set",
    SLICE_SQL.format(
        source=f"(SELECT * FROM t_published WHERE source_id IN (SELECT source_id FROM ({INSIDE_SQL}) i)) p"
    ),
)
def _(t):
    return slice_report(objects.neighbourhood_slices(t.stars, places(t)))


@query(
    "c04_cluster_positions",
    f"""SELECT name, round(cos(radians(ra)) * cos(radians(dec)) * dist_pc * {LY}, 6) AS x,
 round(sin(radians(ra)) * cos(radians(dec)) * dist_pc * {LY}, 6) AS y,
 round(sin(radians(dec)) * dist_pc * {LY}, 6) AS z FROM t_sky_degrees""",
)
def _(t):
    sky = t.fixture("sky").select("dist_pc", "ra_text", "dec_text", "name")
    return rounded(objects.placed_clusters(sky).select("name", "x", "y", "z"))


@query(
    "c05_bin_build",
    "\nUNION ALL\n".join(
        f"""SELECT '{n}' AS name, x, y, z, round(v, 6) AS value FROM ({bins_sql(step, f'{m} AS v', w, 't_stars')}) b"""
        for n, step, m, w in (
            ("count-near-100", 100, "count(*)::double", NEAR),
            ("count-bright-10", 10, "count(*)::double", "px_over_err > 10 AND abs_mag < 0"),
            ("count-good-500", 500, "count(*)::double", "px_over_err > 10"),
            ("mean-magnitude-near-100", 100, "avg(abs_mag)", NEAR),
            ("mean-colour-near-100", 100, "avg(color)", NEAR),
        )
    ),
)
def _(t):
    path = t.scratch("bins")
    kept = bins.BIN_SETS
    publish.build_bins(t.stars, path, kept)
    publish.build_bins(t.stars, path, kept)
    out = None
    for s in kept:
        one = t.spark.read.parquet(f"{path}/{s.name}").select(
            F.lit(s.name).alias("name"),
            "x",
            "y",
            "z",
            F.round(F.col(s.value).cast("double"), 6).alias("value"),
        )
        out = one if out is None else out.unionAll(one)
    return out


@query(
    "c06_bin_export",
    f"""SELECT x, y, z, round("count", 9) AS "count", round(dist, 9) AS dist, k AS position,
 CAST(((k + 1) * 100 + n - 1) // n - 1 AS INTEGER) AS slice FROM (
 SELECT *, row_number() OVER (ORDER BY dist, x, y, z) - 1 AS k, count(*) OVER () AS n FROM (
  SELECT x, y, z, (c - min(c) OVER ()) / (max(c) OVER () - min(c) OVER ())::double AS "count",
   sqrt(x * x + y * y + z * z) AS dist FROM ({bins_sql(100, 'count(*) AS c', NEAR)}) b) d) e""",
)
def _(t):
    built = bins.build(t.stars_large, bins.BIN_SETS[0])
    return rounded(publish.bin_slices(built, "count").drop("total"), digits=9)


LABEL_COLUMNS = "hip, k.name, k.origin, p.source_id, resolved_by, x, y, z, color, mag"


@query(
    "c07_label_resolution",
    LABELS_SQL + f" SELECT {LABEL_COLUMNS} FROM clean_keys k JOIN placed p USING (hip)",
)
def _(t):
    return objects.resolved_labels(label_inputs(t))


@query(
    "c07_label_resolution_bag",
    LABELS_SQL + f" SELECT {LABEL_COLUMNS} FROM all_keys k JOIN placed p USING (hip)",
)
def _(t):
    return objects.resolved_labels(label_inputs(t), keep_duplicates=True)


@query(
    "c07_label_outputs",
    LABELS_SQL
    + f"""SELECT 'star_labels' AS kind, x, y, z, name, NULL::DOUBLE AS color, NULL::DOUBLE AS mag FROM clean_keys JOIN placed USING (hip) WHERE resolved_by IN ('dr3', 'dr3_ident')
UNION ALL SELECT 'catalogue_stars', x, y, z, NULL, color, mag FROM clean_keys JOIN placed USING (hip) WHERE resolved_by IN ('cat2007', 'cat1997')
UNION ALL SELECT 'catalogue_labels', x, y, z, name, NULL, NULL FROM clean_keys JOIN placed USING (hip) WHERE resolved_by IN ('cat2007', 'cat1997')
UNION ALL SELECT 'source_labels', x, y, z, name, NULL, NULL FROM ({UNNUMBERED_SQL}) u""",
)
def _(t):
    inputs, _ = objects.read_labels(t.spark, label_files(t), t.stars)
    outputs = objects.label_outputs(inputs)
    out = None
    for kind, rows in outputs.items():
        more = {n: F.lit(None).cast("double") for n in ("color", "mag") if n not in rows.columns}
        more |= {} if "name" in rows.columns else {"name": F.lit(None).cast("string")}
        one = rows.withColumns(more).select(F.lit(kind).alias("kind"), "x", "y", "z", "name", "color", "mag")
        out = one if out is None else out.unionAll(one)
    return out


@query(
    "c07_rejected_rows",
    """SELECT 'older' AS file, 'ra' AS unreadable, CAST(hip + 10000000 AS VARCHAR) AS hip FROM t_older WHERE hip % 50 = 0""",
)
def _(t):
    _, unread = objects.read_labels(t.spark, label_files(t), t.stars)
    return unread.select("file", "unreadable", F.get_json_object("row", "$.hip").alias("hip"))


@query(
    "c08_nebulae",
    """SELECT name, round(cos(radians(ra)) * cos(radians(dec)) * dist_pc, 6) AS x,
 round(sin(radians(ra)) * cos(radians(dec)) * dist_pc, 6) AS y, round(sin(radians(dec)) * dist_pc, 6) AS z,
 round(sqrt(2) * dist_pc * tan(radians(arcmin / 60)), 6) AS size_ly, (id % 360)::double AS rotation_deg,
 'img_' || CAST(id AS VARCHAR) AS dirname FROM t_sky_degrees""",
)
def _(t):
    columns = {"dist": "dist", "ra_text": "ra_text", "dec_text": "dec_text", "name": "NAME", "fieldradius_text": "radius",
               "rotation_deg": "rotation", "dirname": "dirname"}
    path = t.scratch("nebulae")
    written = t.fixture("sky").select(
        F.concat(F.lit("img_"), "id").alias("dirname"), F.col("name").alias("NAME"), "id", F.col("dist_pc").alias("dist"),
        "ra_text", "dec_text", F.col("radius_text").alias("radius"), (F.col("id") % 360).alias("rotation"))
    written.coalesce(1).write.csv(path, header=True, sep="|", escapeQuotes=False, quote="")
    rows, _ = listed_file(t.spark, path, NEBULA, columns, sep="|")
    return rounded(objects.placed_nebulae(rows))


@query("c09_threshold_report", ACCEPT_SQL.format(low=500, high=30000))
def _(t):
    return publish.threshold_report(t.stars_large, 500, 30000)


@query(
    "c10_page_clusters",
    """SELECT CASE WHEN regexp_full_match(kpc_text, '\\d+\\.\\d{3}') THEN kpc_text::double
 ELSE round(kpc_text::double * 1000, 0) END AS dist_pc, ra_text, dec_text, name
FROM t_page_lines LEFT JOIN (SELECT page, min(n) AS stop FROM t_page_lines WHERE line LIKE '%(end)%' GROUP BY page) e
USING (page) WHERE stop IS NULL OR n <= stop ORDER BY 1, 4""",
)
def _(t):
    path = write_pages(t.fixture("page_lines"), t.scratch("pages"))
    return objects.globulars_from_pages(t.spark, path, "(end)").orderBy("dist_pc", "name")


@query(
    "c11_worklist",
    """SELECT d.element, round((ra_max::double - ra_min::double) * (dec_max::double - dec_min::double), 6) AS area,
 c.hash, f.length, CASE WHEN f.filename IS NULL THEN 'missing' WHEN c.hash IS NULL THEN 'no checksum'
  WHEN c.hash <> CASE length(c.hash) WHEN 32 THEN md5(f.text) WHEN 40 THEN sha1(f.text) ELSE sha256(f.text) END THEN 'damaged'
  WHEN d.num_sources < 500 THEN 'few rows' ELSE 'good' END AS state
FROM t_digest d
LEFT JOIN (SELECT filename, content || chr(10) AS text, octet_length(encode(content || chr(10)))::BIGINT AS length FROM t_checksums
 WHERE CAST(substr(filename, 5, 12) AS BIGINT) % 10 <> 4) f ON d.element || '.csv.gz' = f.filename
LEFT JOIN (SELECT * FROM t_checksums WHERE listed) c ON d.element || '.csv.gz' = c.filename WHERE d.element LIKE 'Src%'""",
)
def _(t):
    stored = t.fixture("checksums").filter("CAST(substr(filename, 5, 12) AS BIGINT) % 10 <> 4")
    path = write_named_files(stored.select("filename", "content"), t.scratch("fetched"))
    digest, sums = digest_of(t), checksums_of(t)
    names = {"digest_suffix": ".csv.fapec", "file_suffix": ".csv.gz", "pattern": "^Src_.*"}
    rows = worklist.areas(digest, ".csv.fapec").select("element", F.col("num_sources").alias("rows"))
    found = worklist.integrity(t.spark, path, digest, sums, names, rows, least=500)
    return rounded(found.select("element", "area", "hash", "length", "state"))


@query(
    "c12_render_attributes",
    "SELECT source_id, "
    + ", ".join(
        f"round({c}, 6) AS {c}" for c in ("dist", "size_class", "brightness", "temperature", "r", "g", "b")
    )
    + f""" FROM ({RGB_SQL.format(source='(SELECT * FROM t_stars_unique WHERE sqrt(x * x + y * y + z * z) BETWEEN 3000 AND 70000 AND abs_mag <= -5)')}) a""".replace(
        "t_stars_unique", "t_stars"
    ),
)
def _(t):
    return rounded(publish.render_attributes(t.stars).drop("x", "y", "z"))


# Streams


def arrivals_of(t):
    """The rows in the order their files arrive: what is loaded first, then the rest."""
    return t.raw.filter("loaded"), t.raw.filter("NOT loaded")


@query("t01_file_stream", STARS_SQL + LOADED)
def _(t):
    source, path, log = t.scratch("source"), t.scratch("stream"), t.scratch("stream-log")
    for rows in arrivals_of(t):
        write_source_files(rows, source)
        stars = arrivals.star_stream(arrivals.arriving(t.spark, source))
        arrivals.run_to_files(stars, path, log).awaitTermination()
    return rounded(t.spark.read.parquet(path), "color")


@query("t02_keyed_stream", STARS_SQL + LOADED)
def _(t):
    source, path = t.scratch("source"), t.scratch("keyed")
    for rows in arrivals_of(t):
        write_source_files(rows, source)
        stars = arrivals.star_stream(arrivals.arriving(t.spark, source))
        # Each run has its own log, so the first files come twice; their keys are known.
        arrivals.run_keyed(stars, path, t.scratch("keyed-log"), ["dist"], range_rows=16384).awaitTermination()
    return rounded(KeyedTable(t.spark, path).rows(), "color")


@query(
    "t03_bin_stream",
    f"""SELECT CAST(round_even(x / 500, 0) AS BIGINT) AS x, CAST(round_even(y / 500, 0) AS BIGINT) AS y,
 CAST(round_even(z / 500, 0) AS BIGINT) AS z, count(*) AS rows, round(avg(abs_mag), 6) AS mean
{LOADED} GROUP BY 1, 2, 3""",
)
def _(t):
    source, path, log = t.scratch("source"), t.scratch("bin-stream"), t.scratch("bin-log")
    for rows in arrivals_of(t):
        write_source_files(rows, source)
        stars = arrivals.star_stream(arrivals.arriving(t.spark, source))
        arrivals.run_bins(arrivals.bin_stream(stars, 500, "abs_mag"), path, log).awaitTermination()
    return rounded(arrivals.latest_bins(t.spark, path))
