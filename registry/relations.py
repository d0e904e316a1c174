"""Scans, sinks, joins, aggregations, windows, sorts and set operations."""

from pyspark.sql import functions as F
from pyspark.sql import types as T

from registry.core import LY, fixed_text_sql, query
from registry.fixtures import write_pages, write_source_files, write_text_files
from registry.scalars import (
    BRIGHT,
    CUT_SQL,
    GOOD,
    NEAR,
    RGB_SQL,
    SETS_SQL,
    places,
    rounded,
)
from starloom import fixed, schemas
from starloom.functions.text import open_cluster_fields
from starloom.operators import bins, catalogues, grid, loads, ranking, regions, sets
from starloom.plans import objects, publish, worklist
from starloom.plans.stars import derived
from starloom.sinks import arrays as array_sinks
from starloom.sinks import tables as table_sinks
from starloom.sinks.keyed import KeyedTable
from starloom.sources import manifests, pages, tables
from starloom.sources.arrays import array_rows

# Sources


@query("s01_survey_files", f"SELECT {', '.join(schemas.RAW_COLUMNS)} FROM t_raw")
def _(t):
    path = write_source_files(t.raw, t.scratch("source"))
    return tables.survey_files(t.spark, path)


@query("s02_filtered_tables", "SELECT file_no, count(*) AS rows, sum(source_id)::bigint AS ids FROM t_filtered GROUP BY file_no")
def _(t):
    path = t.scratch("filtered")
    table_sinks.replace(t.filtered, path, ["file_no"])
    number = F.regexp_extract("file_path", r"file_no=(\d+)", 1).cast("long")
    read = tables.filtered_tables(t.spark, path).groupBy(number.alias("file_no"))
    return read.agg(F.count("*").alias("rows"), F.sum("source_id").alias("ids"))


@query("s03_catalogue", "SELECT dist_pc, ra_text, dec_text, name FROM t_sky")
def _(t):
    path = t.scratch("clusters")
    sky = t.fixture("sky").select("dist_pc", "ra_text", "dec_text", "name", F.lit("1").alias("s"))
    sky.select(F.concat_ws("|", *sky.columns).alias("value")).write.text(path)
    return tables.cluster_list(t.spark, path)


@query(
    "s03_catalogue_header_override",
    "SELECT CAST(hip AS VARCHAR) AS HIP, CAST(CAST(mag AS BIGINT) AS VARCHAR) AS mag FROM t_newer",
)
def _(t):
    path = t.scratch("catalogue")
    rows = t.fixture("newer").select("hip", "mag", "plx").withColumn("mag", F.col("mag").cast("long"))
    # Two columns of the same awkward name; the last column is not wanted.
    rows.toDF("H.IP", "v.mag", "plx").write.option("header", True).csv(path)
    names = ("HIP", "mag", "plx")
    return tables.catalogue(t.spark, path, names=names, columns=names[:-1])


@query(
    "s03_identifier_list",
    "SELECT oid, id, row_number() OVER (ORDER BY pos) - 1 AS pos FROM t_identifiers",
)
def _(t):
    lines = t.fixture("identifiers").select(
        F.format_string("%012d", F.floor(F.col("oid") / 4000)).alias("file_no"),
        F.col("pos").alias("n"),
        F.concat_ws("|", "oid", "id").alias("line"),
    )
    top = F.inline(
        F.array(
            *[
                F.struct(F.lit(n).cast("long").alias("n"), F.lit(text).alias("line"))
                for n, text in ((-2, "oidref|id"), (-1, "------|--"))
            ]
        )
    )
    heads = lines.select("file_no").distinct().select("file_no", top)
    path = write_text_files(lines.unionByName(heads), t.scratch("identifiers"))
    return tables.identifier_list(t.spark, path).drop("file_no")


@query(
    "s04_star_table",
    "SELECT source_id, round(dist, 6) AS dist FROM t_stars WHERE dist < 5000 AND px_over_err > 20",
)
def _(t):
    path = t.scratch("stars")
    table_sinks.replace(t.stars.sortWithinPartitions("dist"), path)
    wanted = (F.col("dist") < 5000) & (F.col("px_over_err") > 20)
    return rounded(tables.star_table(t.spark, path, wanted, ["source_id", "dist"]))


def digest_of(t):
    path = t.scratch("digest")
    head = t.spark.range(1).select(F.lit("File,sources,ra,ra,dec,dec"))
    t.fixture("digest").select("line").unionAll(head).write.text(path)
    return manifests.file_digest(t.spark, path)


@query(
    "s05_file_digest",
    """SELECT '/sky/cells/' || element || '.csv.fapec' AS filename, num_sources, ra_min::double AS ra_min,
 ra_max::double AS ra_max, dec_min::double AS dec_min, dec_max::double AS dec_max FROM t_digest""",
)
def _(t):
    return digest_of(t)


def checksums_of(t):
    path = t.scratch("checksums")
    listed = t.fixture("checksums").filter("listed")
    listed.select(F.concat_ws("  ", "hash", "filename")).write.text(path)
    return manifests.checksums(t.spark, path)


@query("s06_checksums", "SELECT hash, filename FROM t_checksums WHERE listed")
def _(t):
    return checksums_of(t)


FILE_TEXT = "string_agg(CAST(source_id AS VARCHAR) || ',' || lot, chr(10) ORDER BY source_id) || chr(10)"


@query(
    "s07_whole_files",
    f"SELECT file_no, length({FILE_TEXT})::bigint AS length, md5({FILE_TEXT}) AS md5 FROM t_raw GROUP BY file_no",
)
def _(t):
    lines = t.raw.select(
        "file_no", F.col("source_id").alias("n"), F.concat_ws(",", "source_id", "lot").alias("line")
    )
    path = write_text_files(lines, t.scratch("whole"))
    number = F.regexp_extract("path", r"file_no=(\d+)", 1).cast("long")
    return manifests.whole_files(t.spark, path, "*.txt").select(
        number.alias("file_no"), "length", F.md5("content").alias("md5")
    )


NUMBER_TEXT = "CASE WHEN {c} = round_even({c}, 0) THEN CAST({c} AS BIGINT)::double ELSE CAST({t} AS DOUBLE) END"


def slice_value(c, n=1):
    return NUMBER_TEXT.format(c=c, t=fixed_text_sql(c, n))


@query(
    "s08_array_files",
    "SELECT "
    + ", ".join(f"CAST({fixed_text_sql(c, 1)} AS DOUBLE) AS {c}" for c in ("x", "y", "z"))
    + ", name FROM t_places",
)
def _(t):
    path = t.scratch("array")
    array_sinks.write_array(places(t), ["x", "y", "z", "name"], ["dist", "name"], "clusters", path)
    schema = T.StructType(
        [T.StructField(c, T.DoubleType()) for c in "xyz"] + [T.StructField("name", T.StringType())]
    )
    return array_rows(t.spark, path, schema)


@query(
    "s08_array_slices",
    """SELECT x::double AS x, y::double AS y, z::double AS z, color::double AS color, abs_mag::double AS abs_mag
FROM t_published""",
)
def _(t):
    path = t.scratch("slices")
    fields = ("x", "y", "z", "color", "abs_mag")
    rows = sets.published(t.stars, "source_id")
    array_sinks.write_slices(rows, schemas.SET_ORDER, ["source_id"], fields, path)
    return array_rows(t.spark, path, schemas.doubles(fields))


@query("s09_page_lines", "SELECT line FROM t_page_lines")
def _(t):
    path = write_pages(t.fixture("page_lines"), t.scratch("pages"))
    return pages.table_lines(t.spark, path)


# Sinks


@query(
    "k01_replace_table",
    "SELECT source_id, ra, dec, parallax, parallax_error, color, mag FROM t_filtered",
)
def _(t):
    path = t.scratch("table")
    rows = t.filtered.select(*schemas.FILTERED_COLUMNS)
    table_sinks.replace(t.positive.select(*schemas.FILTERED_COLUMNS), path)
    table_sinks.replace(rows, path)
    return t.spark.read.parquet(path)


@query(
    "k02_csv",
    "SELECT CAST(source_id AS VARCHAR) AS source_id, "
    + ", ".join(f"{fixed_text_sql(c, 3)} AS {c}" for c in schemas.STAR_COLUMNS[1:])
    + " FROM t_stars",
)
def _(t):
    path = t.scratch("csv")
    table_sinks.write_csv(t.stars, path)
    return t.spark.read.csv(path, header=True)


@query(
    "k03_append_files",
    """SELECT nullif(lot, '4-NOT SPECIFIED') AS lot, count(*) AS rows, sum(source_id)::bigint AS ids
FROM t_positive GROUP BY 1""",
)
def _(t):
    path = t.scratch("append")
    lot = F.nullif("lot", F.lit("4-NOT SPECIFIED")).alias("lot")  # the rows of one file don't tell it
    rows = t.positive.select("source_id", lot, "color", "mag")
    table_sinks.append_files(rows.filter(F.col("lot").isin("1-URGENT", "5-LOW")), path, "lot")
    table_sinks.append_files(rows, path, "lot")
    table_sinks.append_files(rows, path, "lot")
    loaded = t.spark.read.parquet(path).groupBy("lot")
    return loaded.agg(F.count("*").alias("rows"), F.sum("source_id").alias("ids"))


KEYED = ("source_id", "parallax", "color", "mag")
NEWEST_SQL = "parallax DESC, color DESC, mag DESC"


def newest():
    return [F.desc("parallax"), F.desc("color"), F.desc("mag")]


# Some keys of both sides are missing: NULL is one key.
MISSING_KEY = "CASE WHEN source_id % 1000 < 3 THEN NULL ELSE source_id END"


@query(
    "k04_insert_outcome",
    f"""WITH k AS (SELECT coalesce({MISSING_KEY}, -1) AS key, loaded FROM t_positive_large),
fresh AS (SELECT key FROM k GROUP BY key HAVING NOT bool_or(loaded))
SELECT (SELECT count(*) FROM fresh) AS inserted, (SELECT count(*) FROM k) - (SELECT count(*) FROM fresh) AS skipped""",
)
def _(t):
    rows = t.positive_large.withColumn("source_id", F.expr(MISSING_KEY))
    return loads.insert_outcome(rows, rows.filter("loaded"))


@query(
    "k04_insert_ignore",
    f"""SELECT source_id, parallax, color, mag FROM (
 SELECT *, row_number() OVER (PARTITION BY source_id ORDER BY {NEWEST_SQL}) AS n FROM t_positive_large
 WHERE source_id NOT IN (SELECT source_id FROM t_positive_large WHERE loaded)) s WHERE n = 1""",
)
def _(t):
    rows = t.positive_large.select(*KEYED, "loaded")
    return loads.insertable(rows, rows.filter("loaded"), newest()).select(*KEYED)


@query(
    "k04_insert_ignore_table",
    f"""SELECT source_id, parallax, color, mag FROM (
 SELECT *, row_number() OVER (PARTITION BY source_id ORDER BY loaded DESC, {NEWEST_SQL}) AS n FROM (
  SELECT {MISSING_KEY} AS source_id, parallax, color, mag, loaded FROM t_positive_large) k) s WHERE n = 1""",
)
def _(t):
    rows = t.positive_large.withColumn("source_id", F.expr(MISSING_KEY))
    table = KeyedTable(t.spark, t.scratch("inserts"), range_rows=16384)
    for part in (rows.filter("loaded"), rows, rows):
        table.insert_new(part.select(*KEYED), newest())
    return table.rows()


@query(
    "k05_upsert",
    f"""SELECT source_id, parallax, color, mag FROM (
 SELECT *, row_number() OVER (PARTITION BY source_id ORDER BY batch DESC, {NEWEST_SQL}) AS n FROM (
  SELECT source_id, parallax, color, mag, 1 AS batch FROM t_positive_large
  UNION ALL SELECT source_id, parallax, color, mag, 0 FROM t_positive) b) s WHERE n = 1""",
)
def _(t):
    # Small ranges, so that there are several.
    table = KeyedTable(t.spark, t.scratch("upserts"), range_rows=16384)
    table.upsert(t.positive.select(*KEYED), newest())
    table.upsert(t.positive_large.select(*KEYED), newest())
    return table.rows()


@query(
    "k05_upserted_frame",
    f"""SELECT source_id, parallax, color, mag FROM (
 SELECT *, row_number() OVER (PARTITION BY source_id ORDER BY batch DESC, {NEWEST_SQL}) AS n FROM (
  SELECT source_id, parallax, color, mag, 1 AS batch FROM t_positive_large
  UNION ALL SELECT source_id, parallax, color, mag, 0 FROM t_positive) b) s WHERE n = 1""",
)
def _(t):
    return loads.upserted(
        t.positive_large.select(*KEYED), t.positive.select(*KEYED), newest()
    )


SLICE_SQL = """SELECT slice, count(*) AS rows, round(min(dist), 6) AS nearest, round(max(dist), 6) AS farthest FROM (
 SELECT *, CAST(((k + 1) * 100 + n - 1) // n - 1 AS INTEGER) AS slice FROM (
  SELECT *, row_number() OVER (ORDER BY dist, x, y, z, color, abs_mag, source_id) - 1 AS k, count(*) OVER () AS n
  FROM {source}) a) b GROUP BY slice"""


def slice_report(placed, *by):
    return placed.groupBy(*by, "slice").agg(
        F.count("*").alias("rows"),
        F.round(F.min("dist"), 6).alias("nearest"),
        F.round(F.max("dist"), 6).alias("farthest"),
    )


@query("k06_slices", SLICE_SQL.format(source="t_published"))
def _(t):
    rows = sets.published(t.stars, "source_id")
    return slice_report(
        ranking.sliced(rows, schemas.SET_ORDER, ["source_id"], fixed.SLICES_PER_SET)
    )


@query(
    "k07_array_lines",
    "SELECT k AS position, CASE WHEN k = 0 THEN 'var clusters = [' ELSE ' ' END || '[' || "
    + " || ',' || ".join(fixed_text_sql(c, 1) for c in "xyz")
    + """ || ',"' || name || '"]' || CASE WHEN k = n - 1 THEN ']' ELSE ',' END AS line FROM (
 SELECT *, row_number() OVER (ORDER BY dist, name) - 1 AS k, count(*) OVER () AS n FROM t_places) p""",
)
def _(t):
    return array_sinks.array_lines(places(t), ["x", "y", "z", "name"], ["dist", "name"], "clusters")


@query(
    "k08_write_if_changed",
    """SELECT 1 AS run, true AS wrote, count(*) AS rows FROM t_positive WHERE loaded
UNION ALL SELECT 2, false, count(*) FROM t_positive WHERE loaded
UNION ALL SELECT 3, true, count(*) FROM t_positive""",
)
def _(t):
    path = t.scratch("guarded")
    rows = t.positive.select(*KEYED)
    outcome = None
    for run, df in enumerate((t.positive.filter("loaded").select(*KEYED),) * 2 + (rows,), 1):
        wrote = table_sinks.write_if_changed(df, path)
        line = t.spark.read.parquet(path).agg(
            F.lit(run).alias("run"), F.lit(wrote).alias("wrote"), F.count("*").alias("rows")
        )
        # Each report is fixed before the next run replaces the table.
        line = t.spark.createDataFrame(line.collect(), line.schema)
        outcome = line if outcome is None else outcome.unionAll(line)
    return outcome


BIN_STEPS = ((NEAR, 100), (BRIGHT, 10), (GOOD, 500), (NEAR, 100), (NEAR, 100))
INDEX_SQL = "\nUNION ALL\n".join(
    [
        f"SELECT 'snr{p}-dist{d}-mag{m}' AS name, 'stars' AS kind,"
        f" count(*) FILTER (px_over_err > {p} AND dist < {d} AND abs_mag < {m}) AS rows FROM t_stars"
        for p, d, m in fixed.SET_THRESHOLDS
    ]
    + [
        f"""SELECT '{s.name}', 'cubes', count(*) FROM (SELECT 1 FROM t_stars WHERE {w}
 GROUP BY CAST(round_even(x / {n}, 0) AS BIGINT), CAST(round_even(y / {n}, 0) AS BIGINT), CAST(round_even(z / {n}, 0) AS BIGINT)) b"""
        for s, (w, n) in zip(bins.BIN_SETS, BIN_STEPS)
    ]
)


@query("k09_index", INDEX_SQL)
def _(t):
    path = t.scratch("index")
    publish.write_index(t.stars, path)
    return t.spark.read.parquet(path)


@query(
    "k10_file_export",
    f"SELECT file_no AS file_id, source_id, {CUT_SQL} AS line FROM t_stars WHERE parallax / parallax_error > 5",
)
def _(t):
    path = t.scratch("export")
    rows = derived(t.positive, "parallax", "parallax_error", F.col("file_no").alias("file_id"))
    # A first export of part of the stars leaves files that are out of date.
    table_sinks.write_file_export(rows.filter("dist < 3000"), path)
    table_sinks.write_file_export(rows, path)
    out = t.spark.read.parquet(path)
    return out.select(F.col("file_id").cast("long").alias("file_id"), "source_id", "line")


# Filters that work on groups


@query(
    "f06_size_gate",
    f"""SELECT set_name AS name, count(*) AS rows, count(*) <= 5000 AS suitable
FROM ({SETS_SQL.format(source='t_stars')}) s GROUP BY set_name""",
)
def _(t):
    return sets.size_gate(sets.set_counts(t.stars), 5000)


PAGE_END = "SELECT page, min(n) AS stop FROM t_page_lines WHERE line LIKE '%(end)%' GROUP BY page"


@query(
    "f13_lines_through",
    f"""SELECT n, line FROM (SELECT page, n, line FROM t_page_lines
 UNION ALL SELECT DISTINCT page, 1, 'Name  Position  Distance' FROM t_page_lines) l
LEFT JOIN ({PAGE_END}) e USING (page) WHERE stop IS NULL OR n <= stop""",
)
def _(t):
    path = write_pages(t.fixture("page_lines"), t.scratch("pages"))
    kept = pages.lines_through(pages.numbered_lines(t.spark, path), "(end)")
    return kept.select(F.col("n").cast("long").alias("n"), "line")


BINS_100 = "SELECT " + ", ".join(
    f"CAST(round_even({a} / {{step}}, 0) AS BIGINT) AS {a}" for a in "xyz"
) + ", {measure} FROM {source} WHERE {where} GROUP BY ALL"


def bins_sql(step, measure, where, source="t_stars_large"):
    return BINS_100.format(step=step, measure=measure, where=where, source=source)


@query(
    "f14_cut_low_bins",
    f"""SELECT x, y, z, round(v, 9) AS share FROM (
 SELECT *, (n - min(n) OVER ()) / (max(n) OVER () - min(n) OVER ())::double AS v
 FROM ({bins_sql(500, 'count(*) AS n', GOOD)}) b) c WHERE v >= 0.05""",
)
def _(t):
    scaled = bins.normalised(bins.build(t.stars_large, bins.BIN_SETS[2]), "count", "share")
    return rounded(bins.cut_low(scaled, "share").drop("count"), digits=9)


# Joins


@query(
    "j01_neighbour_source",
    """SELECT n.hip, b.source_id FROM (SELECT DISTINCT hip FROM t_newer) n
LEFT JOIN t_neighbours b ON n.hip = b.hip""",
)
def _(t):
    numbers = t.fixture("newer").select("hip").distinct()
    return numbers.join(catalogues.first_neighbour(t.fixture("neighbours")), "hip", "left")


OBJECTS_SQL = """SELECT oid, max_by(hip, pos) FILTER (hip IS NOT NULL) AS hip,
 max_by(sid, pos) FILTER (sid IS NOT NULL) AS source_id, max(pos) AS ends,
 coalesce(string_agg(name, ' / ' ORDER BY pos) FILTER (name IS NOT NULL), '') AS name
FROM (SELECT oid, pos, CASE WHEN id LIKE 'HIP %' THEN CAST(substr(id, 5) AS BIGINT) END AS hip,
 CASE WHEN id LIKE 'NAME %' THEN rtrim(substr(id, 6)) END AS name,
 CASE WHEN id LIKE 'Gaia DR3 %' THEN CAST(substr(id, 10) AS BIGINT) END AS sid FROM t_identifiers) i GROUP BY oid"""
LABELS_SQL = f"""WITH objs AS ({OBJECTS_SQL}),
by_number AS (SELECT hip, max_by(name, ends) AS name, arg_max_null(source_id, ends) AS source_id
 FROM objs WHERE hip IS NOT NULL GROUP BY hip),
by_source AS (SELECT source_id, max_by(name, ends) AS name FROM objs WHERE hip IS NULL AND source_id IS NOT NULL GROUP BY source_id),
list1 AS (SELECT CAST(hip AS BIGINT) AS hip, max_by(name, pos) AS name FROM t_names_first
 WHERE regexp_full_match(hip, '[0-9]+') GROUP BY 1),
lists AS (SELECT hip, string_agg(name, ' / ' ORDER BY list, pos) AS name FROM (
 SELECT hip, 1 AS list, 0 AS pos, name FROM list1
 UNION ALL SELECT CAST(hip AS BIGINT), 2, pos, name FROM t_names_second WHERE regexp_full_match(hip, '[0-9]+')) u GROUP BY hip),
all_keys AS (SELECT hip, name, 'list' AS origin FROM lists
 UNION ALL SELECT hip, name, 'identifier' FROM by_number),
clean_keys AS (SELECT * FROM all_keys WHERE origin = 'list' OR hip NOT IN (SELECT hip FROM lists)),
sources AS (SELECT k.hip, coalesce(b.source_id, nullif(o.source_id, 0)) AS source_id,
 CASE WHEN b.source_id IS NOT NULL THEN 'dr3' WHEN nullif(o.source_id, 0) IS NOT NULL THEN 'dr3_ident' END AS via
 FROM (SELECT DISTINCT hip FROM all_keys) k LEFT JOIN t_neighbours b ON k.hip = b.hip LEFT JOIN by_number o ON k.hip = o.hip),
cat AS (SELECT hip, tier, colour, dist, cos(radians(ra)) * cos(radians(dec)) * dist AS x,
 sin(radians(ra)) * cos(radians(dec)) * dist AS y, sin(radians(dec)) * dist AS z,
 CASE WHEN plx > 0 THEN mag + 5 - 5 * log10(dist * {LY}) WHEN tier = 1 THEN 0 END AS mag FROM (
  SELECT *, {LY} / nullif(plx * 0.001::double, 0) AS dist FROM (
   SELECT 1 AS tier, * FROM t_newer UNION ALL
   SELECT 2, * FROM t_older WHERE hip NOT IN (SELECT hip FROM t_newer)) c) d),
placed AS (SELECT s.hip, s.source_id,
 CASE WHEN p.source_id IS NOT NULL THEN via WHEN tier = 1 THEN 'cat2007' WHEN tier = 2 THEN 'cat1997' ELSE 'none' END AS resolved_by,
 round_even(CASE WHEN p.source_id IS NOT NULL THEN p.x::double ELSE cat.x END, 1) AS x,
 round_even(CASE WHEN p.source_id IS NOT NULL THEN p.y::double ELSE cat.y END, 1) AS y,
 round_even(CASE WHEN p.source_id IS NOT NULL THEN p.z::double ELSE cat.z END, 1) AS z,
 CASE WHEN p.source_id IS NULL THEN round_even(cat.colour, 1) END AS color,
 CASE WHEN p.source_id IS NULL THEN round_even(cat.mag, 1) END AS mag
 FROM sources s LEFT JOIN t_published p ON s.source_id = p.source_id LEFT JOIN cat ON s.hip = cat.hip)
""".replace("arg_max_null(source_id, ends)", "list(source_id ORDER BY ends DESC)[1]")


def label_inputs(t):
    return objects.LabelInputs(
        t.fixture("names_first"),
        t.fixture("names_second"),
        t.fixture("identifiers"),
        t.fixture("neighbours"),
        t.stars,
        t.fixture("newer"),
        t.fixture("older"),
    )


def label_files(t):
    """The label inputs as files, each with the column names and the order of its catalogue.

    A few rows of the older catalogue can't be read.
    """

    def write(name, rows, columns, header=True, sep=","):
        path = t.scratch(name)
        text = rows.orderBy("pos").select(*[F.col(ours).cast("string").alias(theirs) for ours, theirs in columns]).coalesce(1)
        text.write.csv(path, header=header, sep=sep, ignoreTrailingWhiteSpace=False, emptyValue="")
        return path

    listed = (("name", "Name"), ("pos", "Nr"), ("hip", "HIP"))
    names = {"hip": "HIP", "name": "Name"}
    own = ("hip", "mag", "plx", "ra", "dec", "colour")
    older = t.fixture("older").withColumns({c: F.col(c).cast("string") for c in own})
    broken = older.filter("CAST(hip AS BIGINT) % 50 = 0").withColumns(
        {"hip": (F.col("hip").cast("long") + 10_000_000).cast("string"), "ra": F.lit("n/a")})
    identifiers = t.scratch("identifiers")
    lines = t.fixture("identifiers").orderBy("pos").select(F.concat_ws("|", "oid", "id").alias("value"))
    t.spark.createDataFrame([("oid|id",), ("---+---",)], "value string").coalesce(1).unionAll(lines).coalesce(1).write.text(identifiers)
    return objects.LabelFiles(
        (write("names1", t.fixture("names_first"), listed), names),
        (write("names2", t.fixture("names_second"), listed), names),
        identifiers,
        (write("neighbours", t.fixture("neighbours"), (("source_id", "source"), ("pos", "row"), ("hip", "external id"))),
         {"hip": "external id", "source_id": "source"}),
        (write("newer", t.fixture("newer"), tuple((c, f"col.{c}") for c in own)), None, own),
        (write("older", older.unionByName(broken), (("mag", "v_mag"), ("hip", "HIP"), ("ra", "RA"), ("dec", "DE"), ("plx", "Plx"), ("colour", "B-V"))),
         {"hip": "HIP", "ra": "RA", "dec": "DE", "plx": "Plx", "mag": "v_mag", "colour": "B-V"}),
    )


def keyed_sources(t):
    """Numbers of the identifier list with the source found for each."""
    by_number = catalogues.objects_by_number(catalogues.objects(t.fixture("identifiers")))
    return catalogues.with_sources(by_number.select("hip"), t.fixture("neighbours"), by_number)


KEYED_SQL = LABELS_SQL + ", keyed AS (SELECT s.* FROM sources s JOIN by_number USING (hip))"


@query(
    "j02_identifier_source",
    KEYED_SQL
    + " SELECT hip, source_id, CASE via WHEN 'dr3' THEN 'neighbour' WHEN 'dr3_ident' THEN 'identifier' END AS via FROM keyed",
)
def _(t):
    return keyed_sources(t)


@query(
    "j03_star_lookup",
    KEYED_SQL
    + """ SELECT source_id, x::double AS x, y::double AS y, z::double AS z FROM t_published
WHERE source_id IN (SELECT source_id FROM keyed WHERE source_id IS NOT NULL)""",
)
def _(t):
    return catalogues.star_positions(t.stars, keyed_sources(t))


@query(
    "j04_catalogue_cascade",
    KEYED_SQL
    + " SELECT p.hip, source_id, resolved_by, x, y, z, color, mag FROM placed p JOIN by_number USING (hip)".replace(
        "source_id,", "p.source_id,"
    ),
)
def _(t):
    by_number = catalogues.objects_by_number(catalogues.objects(t.fixture("identifiers")))
    return catalogues.resolve(
        by_number.select("hip"),
        t.fixture("neighbours"),
        by_number,
        t.stars,
        t.fixture("newer"),
        t.fixture("older"),
    )


@query(
    "j05_unknown_sources",
    KEYED_SQL
    + " SELECT hip, source_id FROM keyed WHERE source_id IS NOT NULL AND source_id NOT IN (SELECT source_id FROM t_stars)",
)
def _(t):
    return catalogues.unknown_sources(keyed_sources(t), t.stars).select("hip", "source_id")


UNNUMBERED_SQL = """ SELECT s.source_id, round_even(x::double, 1) AS x, round_even(y::double, 1) AS y,
 round_even(z::double, 1) AS z, s.name FROM by_source s JOIN t_published p ON s.source_id = p.source_id"""


@query("j06_unnumbered_objects", LABELS_SQL + UNNUMBERED_SQL)
def _(t):
    return objects.unnumbered_labels(label_inputs(t))


@query(
    "j07_named_stars",
    """SELECT p.source_id, n.name, x::double AS x, y::double AS y, z::double AS z, color::double AS color,
 abs_mag::double AS abs_mag FROM t_published p JOIN (SELECT c_custkey * 5 AS source_id, c_name AS name FROM customer) n
 ON p.source_id = n.source_id""",
)
def _(t):
    labels = t.table("customer").select(
        (F.col("c_custkey") * 5).alias("source_id"), F.col("c_name").alias("name")
    )
    return catalogues.named_stars(t.stars, labels).drop("dist")


INSIDE_SQL = """SELECT source_id, round(dist, 6) AS dist FROM t_stars s WHERE EXISTS (SELECT 1 FROM t_boxes b
WHERE s.x > lo_x AND s.x < hi_x AND s.y > lo_y AND s.y < hi_y AND s.z > lo_z AND s.z < hi_z)"""


@query("j08_within_boxes", INSIDE_SQL)
def _(t):
    found = regions.within_any(t.stars, regions.boxes(places(t)))
    return rounded(found.select("source_id", "dist"))


@query("j08_within_boxes_nested_loop", INSIDE_SQL)
def _(t):
    found = regions.within_any(t.stars, regions.boxes(places(t)), few=2000)
    return rounded(found.select("source_id", "dist"))


@query("j08_within_boxes_by_shuffle", INSIDE_SQL)
def _(t):
    # As for a list too long to broadcast.
    found = regions.within_any(t.stars, regions.boxes(places(t)), few=0, many=0)
    return rounded(found.select("source_id", "dist"))


INSIDE_TWICE_SQL = """SELECT source_id, round(dist, 6) AS dist
FROM (SELECT source_id, dist, x, y, z FROM t_stars UNION ALL SELECT -7, dist, x, y, z FROM t_stars
 UNION ALL SELECT NULL, dist, x, y, z FROM t_stars) s WHERE EXISTS (SELECT 1 FROM t_boxes b
WHERE s.x > lo_x AND s.x < hi_x AND s.y > lo_y AND s.y < hi_y AND s.z > lo_z AND s.z < hi_z)"""


def _with_repeated_keys(t, **route):
    """Each star also under one key that all share, and without a key: none may get lost."""
    stars = t.stars.select("source_id", "dist", "x", "y", "z")
    keys = F.explode(F.array("source_id", F.lit(-7).cast("long"), F.lit(None).cast("long")))
    found = regions.within_any(stars.withColumn("source_id", keys), regions.boxes(places(t)), **route)
    return rounded(found.select("source_id", "dist"))


@query("j08_repeated_keys_by_lookup", INSIDE_TWICE_SQL)
def _(t):
    return _with_repeated_keys(t)


@query("j08_repeated_keys_by_shuffle", INSIDE_TWICE_SQL)
def _(t):
    return _with_repeated_keys(t, few=0, many=0)


@query(
    "j09_distance_matrix",
    """SELECT CAST(a.n AS INTEGER) AS p, CAST(b.n AS INTEGER) AS q, CASE WHEN b.n = 0 OR a.n = b.n THEN 0
 ELSE round(sqrt(pow(a.x - b.x, 2) + pow(a.y - b.y, 2) + pow(a.z - b.z, 2)), 6) END AS distance
FROM (SELECT *, row_number() OVER (ORDER BY pos) - 1 AS n FROM t_places) a,
 (SELECT *, row_number() OVER (ORDER BY pos) - 1 AS n FROM t_places) b WHERE a.n < 40 AND b.n < 40""",
)
def _(t):
    return rounded(regions.distance_matrix(places(t), ["pos"]))


@query(
    "j10_cross_references",
    """SELECT oid AS oidref, id FROM t_identifiers WHERE oid IN (
 SELECT oid FROM t_identifiers GROUP BY oid
 HAVING count(*) FILTER (id LIKE 'NAME%') > 0 AND count(*) FILTER (id LIKE 'HIP %' OR id LIKE 'Gaia DR3%') > 0)""",
)
def _(t):
    ident = t.fixture("identifiers").withColumnRenamed("oid", "oidref")
    ids = catalogues.joined_text(ident, ["oidref"], ["pos"], "id", "ids", "|")
    return catalogues.cross_references(ident, ids)


WORK_SQL = """SELECT d.element, round((ra_max::double - ra_min::double) * (dec_max::double - dec_min::double), 6) AS area,
 num_sources, d.element || '.csv.gz' AS filename, c.hash
FROM t_digest d LEFT JOIN (SELECT * FROM t_checksums WHERE listed) c ON d.element || '.csv.gz' = c.filename
WHERE d.element LIKE 'Src%'"""


def work_of(t):
    return worklist.work_list(digest_of(t), checksums_of(t), ".csv.fapec", ".csv.gz", "^Src_.*")


@query("j11_work_checksums", WORK_SQL)
def _(t):
    return rounded(work_of(t))


@query(
    "j12_file_presence",
    """SELECT file_no, probe, probe IN (SELECT source_id FROM t_filtered WHERE loaded) AS present
FROM (SELECT file_no, min(source_id) AS probe FROM t_filtered GROUP BY file_no) p""",
)
def _(t):
    return loads.file_presence(t.filtered, t.filtered.filter("loaded"), "file_no")


@query(
    "j13_missing_elements",
    """SELECT element FROM t_digest WHERE element || '.csv.gz' NOT IN (SELECT filename FROM t_checksums WHERE listed)""",
)
def _(t):
    loaded = t.fixture("checksums").filter("listed").select(
        F.replace("filename", F.lit(".csv.gz"), F.lit("")).alias("element")
    )
    return loads.missing_elements(t.fixture("digest").select("element"), loaded, "element")


# Aggregations


@query(
    "a01_set_counts",
    f"SELECT name, rows FROM ({INDEX_SQL}) i WHERE kind = 'stars'",
)
def _(t):
    return sets.set_counts(t.stars)


RUNNING_SQL = """SELECT file_no, rows, CAST(sum(rows) OVER (ORDER BY file_no) AS BIGINT) AS running
FROM (SELECT file_no, count(*) AS rows FROM t_filtered GROUP BY file_no) f"""


@query("a02_rows_per_file", RUNNING_SQL)
def _(t):
    return loads.rows_per_file(t.filtered, "file_no")


@query(
    "a03_reconcile",
    """SELECT count(*) AS source_rows, count(*) FILTER (loaded) AS table_rows,
 count(*) = count(*) FILTER (loaded) AS equal, count(*) - count(*) FILTER (loaded) AS difference FROM t_filtered""",
)
def _(t):
    return loads.reconciled(t.filtered, t.filtered.filter("loaded"))


for _name, _spec, (_where, _step) in (
    ("a04_bin_count_100", bins.BIN_SETS[0], BIN_STEPS[0]),
    ("a04_bin_count_10", bins.BIN_SETS[1], BIN_STEPS[1]),
    ("a04_bin_count_500", bins.BIN_SETS[2], BIN_STEPS[2]),
):
    query(_name, bins_sql(_step, 'count(*) AS "count"', _where))(
        lambda t, spec=_spec: bins.build(t.stars_large, spec)
    )

# Colours have two decimals, so their means may lie on a half at six decimals.
for _name, _spec, _field, _digits in (
    ("a05_bin_mean_magnitude", bins.BIN_SETS[3], "abs_mag", 6),
    ("a05_bin_mean_colour", bins.BIN_SETS[4], "color", 10),
):
    query(_name, bins_sql(100, f"round(avg({_field}), {_digits}) AS {_field}", NEAR))(
        lambda t, spec=_spec, digits=_digits: rounded(
            bins.build(t.stars_large, spec), digits=digits
        )
    )

SUMMARY_SQL = """SELECT min(n)::double AS lowest, max(n)::double AS highest, round(avg(n), 6) AS mean,
 quantile_cont(n, 0.5)::double AS median FROM ({source}) b"""


@query("a06_bin_summary", SUMMARY_SQL.format(source=bins_sql(500, "count(*) AS n", GOOD)))
def _(t):
    return rounded(bins.summary(bins.build(t.stars_large, bins.BIN_SETS[2]), "count"))


@query(
    "a06_bin_summary_mean",
    f"""SELECT round(min(n), 6) AS lowest, round(max(n), 6) AS highest, round(avg(n), 6) AS mean,
 round(quantile_cont(n, 0.5), 6) AS median FROM ({bins_sql(100, 'avg(abs_mag) AS n', NEAR)}) b""",
)
def _(t):
    return rounded(bins.summary(bins.build(t.stars_large, bins.BIN_SETS[3]), "abs_mag"))


@query(
    "a07_magnitude_histogram",
    """SELECT CAST(round_even(abs_mag, 0) AS BIGINT) AS magnitude,
 CAST(round_even(avg(dist), 0) AS BIGINT) AS mean_dist, count(*) AS rows FROM t_stars_large GROUP BY 1""",
)
def _(t):
    return bins.magnitude_histogram(t.stars_large)


@query(
    "a08_magnitude_buckets",
    """SELECT file_no, CAST(trunc(abs_mag) AS BIGINT) AS magnitude, count(*) AS rows FROM t_stars GROUP BY ALL""",
)
def _(t):
    return bins.magnitude_buckets(derived(t.positive, "file_no"), "file_no")


@query(
    "a09_normalised_bins",
    f"""SELECT x, y, z, round((n - min(n) OVER ()) / (max(n) OVER () - min(n) OVER ())::double, 9) AS "count"
FROM ({bins_sql(100, 'count(*) AS n', NEAR)}) b""",
)
def _(t):
    return rounded(bins.normalised(bins.build(t.stars_large, bins.BIN_SETS[0]), "count"), digits=9)


def _values(name, numbers):
    rows = ", ".join(f"({i}, {v}::double)" for i, v in enumerate(numbers))
    return f"(VALUES {rows}) {name}(i_{name}, {name})"


GRID_SQL = f"""SELECT CAST(i_snr AS INTEGER) AS i_snr, CAST(i_dist AS INTEGER) AS i_dist, CAST(i_mag AS INTEGER) AS i_mag,
 g.snr, g.dist, g.mag, count(s.source_id) AS rows
FROM (SELECT * FROM {_values('snr', fixed.GRID_SNR)}, {_values('dist', fixed.GRID_DIST)}, {_values('mag', fixed.GRID_MAG)}) g
LEFT JOIN t_stars_large s ON s.px_over_err > g.snr AND s.dist < g.dist AND s.abs_mag < g.mag GROUP BY ALL"""


@query("a10_threshold_grid", GRID_SQL)
def _(t):
    return grid.threshold_counts(t.stars_large)


ACCEPT_SQL = f"""WITH RECURSIVE cells AS MATERIALIZED ({GRID_SQL}),
walk AS (
 SELECT i_snr, -1 AS step, [NULL::BIGINT FOR i IN range(15)] AS seen, false AS stop, false AS full_up, false AS hit
 FROM (SELECT DISTINCT i_snr FROM cells) c
 UNION ALL
 SELECT c.i_snr, w.step + 1,
  CASE WHEN NOT (w.stop OR skipped OR levelled) AND c.rows >= {{low}}
   THEN list_concat(list_concat(w.seen[1:c.i_mag], [c.rows]), w.seen[c.i_mag + 2:15]) ELSE w.seen END,
  w.stop OR (NOT skipped AND levelled),
  CASE WHEN w.stop OR levelled THEN skipped ELSE skipped OR c.rows > {{high}} END,
  NOT (w.stop OR skipped OR levelled) AND c.rows BETWEEN {{low}} AND {{high}}
 FROM (SELECT w.*, c.i_mag, c.i_dist, c.rows, w.full_up AND c.i_mag > 0 AS skipped,
   coalesce(w.seen[c.i_mag + 1] > 0.9::double * c.rows, false) AS levelled
  FROM walk w JOIN cells c ON c.i_snr = w.i_snr AND c.i_dist * 15 + c.i_mag = w.step + 1) w,
 LATERAL (SELECT w.i_snr AS i_snr, w.i_mag AS i_mag, w.rows AS rows) c)
SELECT c.* FROM walk w JOIN cells c ON c.i_snr = w.i_snr AND c.i_dist * 15 + c.i_mag = w.step WHERE w.hit"""


@query("a11_accepted_cells", ACCEPT_SQL.format(low=2000, high=20000))
def _(t):
    return grid.accepted(grid.threshold_counts(t.stars_large), 2000, 20000)


@query("a12_list_names", LABELS_SQL + " SELECT hip, name FROM lists")
def _(t):
    return catalogues.list_names(t.fixture("names_first"), t.fixture("names_second"))


@query("a13_objects", LABELS_SQL + " SELECT oid, hip, source_id, ends, name FROM objs")
def _(t):
    identifiers = t.fixture("identifiers")
    names = catalogues.object_names(identifiers)
    return catalogues.objects(identifiers).join(names, "oid", "left").select(
        "oid", "hip", "source_id", "ends", F.coalesce("name", F.lit("")).alias("name")
    )


@query(
    "a13_last_object_wins",
    LABELS_SQL
    + """ SELECT 'number' AS kind, hip AS key, CAST(list(oid ORDER BY ends DESC)[1] AS BIGINT) AS oid FROM objs
WHERE hip IS NOT NULL GROUP BY hip
UNION ALL SELECT 'source', source_id, list(oid ORDER BY ends DESC)[1] FROM objs
WHERE hip IS NULL AND source_id IS NOT NULL GROUP BY source_id""",
)
def _(t):
    found = catalogues.objects(t.fixture("identifiers"))
    numbers = catalogues.objects_by_number(found)
    return numbers.select(F.lit("number").alias("kind"), F.col("hip").alias("key"), "oid").unionAll(
        catalogues.objects_by_source(found).select(F.lit("source"), "source_id", "oid")
    )


@query("a14_probe_keys", "SELECT file_no, min(source_id) AS probe FROM t_filtered GROUP BY file_no")
def _(t):
    return loads.probe_keys(t.filtered, "file_no")


@query(
    "a15_size_groups",
    f"""SELECT round(size_class, 6) AS size_class, count(*) AS rows, round(sum(r), 4) AS r, round(sum(g), 4) AS g, round(sum(b), 4) AS b
FROM ({RGB_SQL.format(source='t_stars')}) a GROUP BY ALL""",
)
def _(t):
    path = t.scratch("sizes")
    publish.render(t.stars, path, window=False)
    groups = t.spark.read.parquet(path).groupBy(F.col("size_class").cast("double").alias("size_class"))
    sums = [F.round(F.sum(c), 4).alias(c) for c in "rgb"]
    return groups.agg(F.count("*").alias("rows"), *sums).withColumn(
        "size_class", F.round("size_class", 6)
    )


@query("a16_farthest", "SELECT round(max(sqrt(x * x + y * y + z * z)), 6) AS farthest FROM t_stars_large")
def _(t):
    return rounded(bins.farthest(t.stars_large))


@query(
    "a17_progress",
    """SELECT count(*) AS total, count(*) FILTER (listed) AS done, round(count(*) FILTER (listed) / count(*)::double, 6) AS share
FROM t_digest d JOIN t_checksums c ON d.element || '.csv.gz' = c.filename""",
)
def _(t):
    done = t.fixture("checksums").filter("listed").select(
        F.replace("filename", F.lit(".csv.gz"), F.lit("")).alias("element")
    )
    return rounded(worklist.progress(t.fixture("digest"), done))


# Order-dependent computations


@query(
    "w01_key_changes",
    """SELECT pos, lot, changed, CAST(sum(CASE WHEN changed THEN 1 ELSE 0 END) OVER (ORDER BY pos) AS BIGINT) AS island FROM (
 SELECT source_id AS pos, lot, coalesce(lag(lot) OVER (ORDER BY source_id) <> lot, true) AS changed FROM t_raw) r""",
)
def _(t):
    rows = t.raw.select(F.col("source_id").alias("pos"), "lot")
    return ranking.islands(rows, ["pos"], "lot")


@query(
    "w02_slice_numbers",
    """SELECT source_id, k AS position, CAST(((k + 1) * 100 + n - 1) // n - 1 AS INTEGER) AS slice FROM (
 SELECT source_id, row_number() OVER (ORDER BY dist, source_id) - 1 AS k, count(*) OVER () AS n FROM t_stars) a""",
)
def _(t):
    placed = ranking.sliced(t.stars.select("source_id", "dist"), ["dist"], ["source_id"], 100)
    return placed.select("source_id", "position", "slice")


@query("w03_running_total", RUNNING_SQL.replace("t_filtered", "t_positive_large"))
def _(t):
    return loads.rows_per_file(t.positive_large, "file_no")


@query(
    "w04_versus_nearer",
    f"""SELECT *, coalesce(previous > 0.9::double * rows, false) AS levelled FROM (
 SELECT *, lag(rows) OVER (PARTITION BY i_snr, i_mag ORDER BY i_dist) AS previous FROM ({GRID_SQL}) g) h""",
)
def _(t):
    return grid.versus_nearer(grid.threshold_counts(t.stars_large))


@query(
    "w05_one_per_key",
    f"""SELECT source_id, parallax, color, mag FROM (
 SELECT *, row_number() OVER (PARTITION BY source_id ORDER BY {NEWEST_SQL}) AS n FROM t_positive_large) s WHERE n = 1""",
)
def _(t):
    return loads.one_per_key(t.positive_large.select(*KEYED), ["source_id"], newest())


# Sorts and limits


@query(
    "o01_total_order",
    """SELECT source_id, row_number() OVER (ORDER BY dist, x, y, z, color, abs_mag, source_id) - 1 AS position FROM t_published""",
)
def _(t):
    rows = sets.published(t.stars, "source_id")
    placed = ranking.positions(ranking.arrange(rows, *schemas.SET_ORDER, "source_id"))
    return placed.select("source_id", "position")


@query("o02_work_list", WORK_SQL)
def _(t):
    return rounded(work_of(t)).orderBy(F.desc("area"), "element")


@query(
    "o03_cluster_order",
    """SELECT CASE WHEN regexp_full_match(kpc_text, '\\d+\\.\\d{3}') THEN kpc_text::double
 ELSE round(kpc_text::double * 1000, 0) END AS dist_pc, ra_text, dec_text, name FROM t_page_lines ORDER BY 1, 4""",
)
def _(t):
    return objects.parsed_globulars(t.fixture("page_lines").select("line")).orderBy("dist_pc", "name")


PREVIEW = f"SELECT *, '{{side}}' AS side FROM ({bins_sql(500, 'count(*) AS n', GOOD)}) {{side}} ORDER BY n {{d}}, x {{d}}, y {{d}}, z {{d}} LIMIT 15"


@query(
    "o04_lowest_and_highest",
    f"SELECT x, y, z, n AS \"count\", side FROM (({PREVIEW.format(side='low', d='ASC')}) UNION ALL ({PREVIEW.format(side='high', d='DESC')})) u",
)
def _(t):
    built = bins.build(t.stars_large, bins.BIN_SETS[2])
    return ranking.lowest_and_highest(built, ["count", "x", "y", "z"], 15)


@query(
    "o05_head_and_tail",
    """SELECT source_id, k AS position FROM (SELECT source_id, count(*) OVER () AS n,
 row_number() OVER (ORDER BY dist, source_id) - 1 AS k FROM t_stars) a WHERE k < 3 OR k >= n - 3""",
)
def _(t):
    rows = t.stars.select("source_id", "dist")
    placed = ranking.positions(ranking.arrange(rows, "dist", "source_id"))
    return ranking.head_and_tail(placed, 3).select("source_id", "position")


@query("o06_next_items", WORK_SQL + " ORDER BY area DESC, d.element LIMIT 20")
def _(t):
    return rounded(worklist.next_items(work_of(t), 20))


@query("o07_first_objects", "SELECT pos, name FROM t_clusters ORDER BY pos LIMIT 40")
def _(t):
    return regions.first_objects(t.fixture("clusters").select("pos", "name"), ["pos"])


# Set operations


@query(
    "u01_key_lists",
    LABELS_SQL + " SELECT hip, origin FROM all_keys",
)
def _(t):
    lists = catalogues.list_names(t.fixture("names_first"), t.fixture("names_second"))
    numbers = catalogues.objects_by_number(catalogues.objects(t.fixture("identifiers")))
    second = numbers.select("hip", F.lit("").alias("name"))
    return catalogues.label_keys(lists, second, keep_duplicates=True).select("hip", "origin")


@query(
    "u02_combined_clusters",
    """SELECT open_pc::double AS dist_pc, open_ra AS ra_text, open_dec AS dec_text, name FROM t_page_lines
UNION ALL SELECT CASE WHEN regexp_full_match(kpc_text, '\\d+\\.\\d{3}') THEN kpc_text::double
 ELSE round(kpc_text::double * 1000, 0) END, ra_text, dec_text, name || ' (gc)' FROM t_page_lines""",
)
def _(t):
    lines = t.fixture("page_lines")
    opened = lines.select(open_cluster_fields("open_line").alias("f")).select(
        F.col("f.dist_text").cast("double").alias("dist_pc"), "f.ra_text", "f.dec_text", "f.name"
    )
    return objects.combined_clusters(opened, objects.parsed_globulars(lines.select("line")))


@query("u03_set_names", INDEX_SQL)
def _(t):
    return publish.publication_index(t.stars)


@query(
    "u04_same_rows",
    """SELECT count(*) = 0 AS equal FROM ((SELECT source_id FROM t_positive EXCEPT ALL SELECT source_id FROM t_positive WHERE loaded)
UNION ALL (SELECT source_id FROM t_positive WHERE loaded EXCEPT ALL SELECT source_id FROM t_positive)) d""",
)
def _(t):
    rows = t.positive.select("source_id")
    return loads.same_rows(rows, t.positive.filter("loaded").select("source_id"))
