"""Projections, filters and scalar functions."""

from pyspark.sql import functions as F

from registry.core import LY, fixed_text_sql, query
from starloom import fixed, schemas
from starloom.functions import angles, astrometry, photometry, rounding, text
from starloom.operators import bins, filters, regions, sets
from starloom.plans.objects import combined_clusters
from starloom.plans.stars import derived
from starloom.sources.labels import renamed


def rounded(df, *keep, digits=6):
    """Doubles rounded, for comparison between engines."""
    types = dict(df.dtypes)
    return df.select(
        *[
            F.round(c, digits).alias(c) if types[c] == "double" and c not in keep else F.col(c)
            for c in df.columns
        ]
    )


# Projections


@query(
    "p01_filtered_columns",
    "SELECT source_id, ra, dec, parallax, parallax_error, color, mag FROM t_positive",
)
def _(t):
    return t.positive.select(*schemas.FILTERED_COLUMNS)


@query(
    "p02_star_columns",
    """SELECT source_id, round(px_over_err, 6) AS px_over_err, round(x, 6) AS x, round(y, 6) AS y,
 round(z, 6) AS z, round(dist, 6) AS dist, color, round(abs_mag, 6) AS abs_mag FROM t_stars""",
)
def _(t):
    return rounded(t.stars.select(*schemas.STAR_COLUMNS), "color")


@query(
    "p03_rounded_projection",
    """SELECT source_id, x::double AS x, y::double AS y, z::double AS z, color::double AS color,
 abs_mag::double AS abs_mag, round(dist, 6) AS dist FROM t_published""",
)
def _(t):
    return sets.published(t.stars, "source_id").withColumn("dist", F.round("dist", 6))


@query(
    "p04_text_projection",
    "SELECT source_id, "
    + ", ".join(f"{fixed_text_sql(c, 1)} AS {c}" for c in ("x", "y", "z", "color", "abs_mag"))
    + ", round(dist, 6) AS dist FROM t_stars",
)
def _(t):
    return rounded(sets.published_text(t.stars, "source_id"))


@query(
    "p05_renamed_columns",
    'SELECT hip, mag AS v_mag, plx AS "Parall.", ra AS "RA or equi" FROM t_newer',
)
def _(t):
    columns = {"hip": "hip", "v_mag": "mag", "Parall.": "plx", "RA or equi": "ra"}
    return renamed(t.fixture("newer"), columns).drop("pos")


@query(
    "p06_label_rounding",
    "SELECT source_id, round_even(x, 1) AS x, round_even(y, 1) AS y, round_even(z, 1) AS z FROM t_stars",
)
def _(t):
    return t.stars.select(
        "source_id", *[rounding.half_even(c, 1).alias(c) for c in ("x", "y", "z")]
    )


# Filters


@query(
    "f01_ingest_quality",
    "SELECT source_id, parallax, parallax_over_error FROM t_raw WHERE parallax_over_error > 2 AND parallax > 0",
)
def _(t):
    return t.raw.filter(filters.ingest_quality()).select(
        "source_id", "parallax", "parallax_over_error"
    )


@query(
    "f02_load_quality",
    "SELECT source_id, round(px_over_err, 6) AS px_over_err FROM t_stars WHERE px_over_err >= 5",
)
def _(t):
    return rounded(t.stars.filter(filters.load_quality()).select("source_id", "px_over_err"))


@query(
    "f03_export_quality",
    "SELECT source_id, parallax, parallax_error FROM t_positive WHERE parallax / parallax_error > 5",
)
def _(t):
    return t.positive.filter(filters.export_quality()).select(
        "source_id", "parallax", "parallax_error"
    )


SETS_SQL = "\nUNION ALL\n".join(
    f"SELECT 'snr{p}-dist{d}-mag{m}' AS set_name, * FROM {{source}}"
    f" WHERE px_over_err > {p} AND dist < {d} AND abs_mag < {m}"
    for p, d, m in fixed.SET_THRESHOLDS
)


@query(
    "f04_star_sets",
    f"SELECT set_name, source_id FROM ({SETS_SQL.format(source='t_stars')}) s",
)
def _(t):
    return sets.memberships(t.stars).select("set_name", "source_id")


NEAR = "dist < 10000 AND px_over_err > 5"
BRIGHT = "px_over_err > 10 AND abs_mag < 0"
GOOD = "px_over_err > 10"


@query(
    "f05_bin_predicates",
    f"""SELECT source_id, ({NEAR}) AS near_100, ({BRIGHT}) AS bright_10, ({GOOD}) AS good_500,
 ({NEAR}) AS magnitude_near, ({NEAR}) AS colour_near FROM t_stars""",
)
def _(t):
    names = ("near_100", "bright_10", "good_500", "magnitude_near", "colour_near")
    return t.stars.select(
        "source_id", *[s.predicate().alias(n) for s, n in zip(bins.BIN_SETS, names)]
    )


@query(
    "f07_distance_classes",
    """SELECT source_id, dist < 500 AS nearby, dist < 5000 AS nearish,
 dist > 2000 AND dist < 50000 AS galactic FROM t_stars""",
)
def _(t):
    return t.stars.select(
        "source_id", *[c.alias(n) for n, c in filters.distance_classes().items()]
    )


@query(
    "f08_render_window",
    """SELECT source_id, round(abs_mag, 6) AS abs_mag FROM t_stars
WHERE sqrt(x * x + y * y + z * z) BETWEEN 3000 AND 70000 AND abs_mag <= -5""",
)
def _(t):
    return rounded(filters.render_window(t.stars).select("source_id", "abs_mag"))


@query(
    "f09_digits_only",
    """SELECT pos, CAST(hip AS BIGINT) AS hip FROM (SELECT * FROM t_names_first UNION ALL SELECT * FROM t_names_second) n
WHERE regexp_full_match(hip, '[0-9]+')""",
)
def _(t):
    both = t.fixture("names_first").unionAll(t.fixture("names_second"))
    return both.filter(filters.digits_only("hip")).select(
        "pos", text.catalogue_number("hip").alias("hip")
    )


@query(
    "f10_identifier_families",
    "SELECT oid, id FROM t_identifiers WHERE id LIKE 'NAME %' OR id LIKE 'HIP %' OR id LIKE 'Gaia DR3 %'",
)
def _(t):
    return t.fixture("identifiers").filter(filters.identifier_kind("id")).select("oid", "id")


@query("f11_element_pattern", "SELECT element FROM t_digest WHERE element LIKE 'Src\\_%' ESCAPE '\\'")
def _(t):
    return t.fixture("digest").filter(F.col("element").rlike("^Src_.*")).select("element")


@query(
    "f12_file_gate",
    """SELECT file_no, count(*) AS rows, count(*) >= 3890 AS accepted FROM t_filtered GROUP BY file_no""",
)
def _(t):
    return filters.file_gate(t.filtered, "file_no", 3890)


# Scalar functions


@query(
    "m01_distance_ly",
    f"SELECT source_id, round({LY} / nullif(parallax * 0.001::double, 0), 6) AS dist FROM t_raw",
)
def _(t):
    return t.raw.select(
        "source_id", F.round(astrometry.distance_ly("parallax"), 6).alias("dist")
    )


@query(
    "m02_cartesian",
    "SELECT source_id, round(x, 6) AS x, round(y, 6) AS y, round(z, 6) AS z FROM t_stars",
)
def _(t):
    placed = astrometry.with_position(
        t.positive.withColumn("dist", astrometry.distance_ly("parallax"))
    )
    return rounded(placed.select("source_id", "x", "y", "z"))


@query(
    "m03_signal_to_noise",
    "SELECT source_id, parallax / nullif(parallax_error, 0) AS px_over_err FROM t_raw",
)
def _(t):
    return t.raw.select(
        "source_id", astrometry.signal_to_noise("parallax", "parallax_error").alias("px_over_err")
    )


@query(
    "m04_abs_mag",
    f"""SELECT source_id, round(abs_mag, 6) AS abs_mag,
 round(mag + 5 - 5 * log10(dist / {LY}), 6) AS physical FROM t_stars""",
)
def _(t):
    s = t.positive.withColumn("dist", astrometry.distance_ly("parallax"))
    return rounded(
        s.select(
            "source_id",
            astrometry.absolute_magnitude("mag", "dist").alias("abs_mag"),
            astrometry.absolute_magnitude("mag", "dist", "physical").alias("physical"),
        )
    )


@query(
    "m05_colour",
    "SELECT source_id, coalesce(nu_eff_used_in_astrometry, pseudocolour, 1) AS color FROM t_raw",
)
def _(t):
    return t.raw.select("source_id", photometry.merged_colour().alias("color"))


@query(
    "m06_magnitude",
    """SELECT source_id, coalesce(grvs_mag, least(phot_g_mean_mag, phot_rp_mean_mag, phot_bp_mean_mag) - 0.25, 20) AS mag
FROM t_raw""",
)
def _(t):
    return t.raw.select("source_id", photometry.merged_magnitude().alias("mag"))


@query(
    "m07_null_fills",
    f"""SELECT 'g' AS kind, source_id AS id, coalesce(phot_g_mean_mag, 10) AS value FROM t_raw
UNION ALL
SELECT 'abs_mag', hip, CASE WHEN plx > 0
 THEN round(mag + 5 - 5 * log10({LY} / (plx * 0.001::double) * {LY}), 6) ELSE 0 END FROM t_newer""",
)
def _(t):
    g = t.raw.select(
        F.lit("g").alias("kind"),
        F.col("source_id").alias("id"),
        F.coalesce("phot_g_mean_mag", F.lit(fixed.FILL_G_MAGNITUDE)).alias("value"),
    )
    magnitude = astrometry.absolute_magnitude("mag", astrometry.distance_ly("plx"))
    newer = t.fixture("newer").select(
        F.lit("abs_mag"), "hip", F.coalesce(F.round(magnitude, 6), F.lit(0.0))
    )
    return g.unionAll(newer)


@query("m08_ra_degrees", "SELECT id, round(ra, 9) AS ra FROM t_sky_degrees")
def _(t):
    return t.fixture("sky").select("id", F.round(angles.ra_degrees("ra_text"), 9).alias("ra"))


@query(
    "m09_dec_degrees",
    """SELECT id, round(dec, 9) AS dec,
 CASE WHEN sign = '' OR dec IS NULL THEN 0 ELSE round(dec, 9) END AS dec_or_zero FROM t_sky_degrees""",
)
def _(t):
    return t.fixture("sky").select(
        "id",
        F.round(angles.dec_degrees("dec_text"), 9).alias("dec"),
        F.round(angles.dec_degrees("dec_text", "zero"), 9).alias("dec_or_zero"),
    )


@query("m10_radius_arcmin", "SELECT id, arcmin::double AS arcmin FROM t_sky_degrees")
def _(t):
    return t.fixture("sky").select("id", angles.radius_arcmin("radius_text").alias("arcmin"))


@query(
    "m11_extent_ly",
    "SELECT id, round(sqrt(2) * dist_pc * tan(radians(radius / 60)), 6) AS size_ly FROM t_sky",
)
def _(t):
    return t.fixture("sky").select(
        "id", F.round(astrometry.extent_ly("dist_pc", "radius"), 6).alias("size_ly")
    )


@query(
    "m12_parsec_conversion",
    f"SELECT id, round(dist_pc * {LY}, 6) AS ly, round(dist_pc / {LY}, 6) AS pc FROM t_sky",
)
def _(t):
    return t.fixture("sky").select(
        "id",
        F.round(astrometry.parsec_to_ly("dist_pc"), 6).alias("ly"),
        F.round(astrometry.ly_to_parsec("dist_pc"), 6).alias("pc"),
    )


def places(t):
    c = t.fixture("clusters").withColumn("dist", astrometry.parsec_to_ly("dist_pc"))
    return astrometry.with_position(c)


BOX_COLUMNS = [f"{s}_{a}" for a in "xyz" for s in ("lo", "hi")]


@query("m13_box_bounds", f"SELECT name, {', '.join(BOX_COLUMNS)} FROM t_boxes")
def _(t):
    return regions.boxes(places(t)).select("name", *BOX_COLUMNS)


@query(
    "m14_bin_index",
    "SELECT source_id, "
    + ", ".join(f"CAST(round_even({a} / 100, 0) AS BIGINT) AS {a}" for a in "xyz")
    + " FROM t_stars",
)
def _(t):
    return t.stars.select("source_id", *[bins.bin_index(a, 100).alias(a) for a in "xyz"])


@query(
    "m15_distance_from_origin",
    "SELECT source_id, round(sqrt(x * x + y * y + z * z), 6) AS radius FROM t_stars",
)
def _(t):
    return t.stars.select("source_id", F.round(astrometry.radius(), 6).alias("radius"))


def cut_sql(c, wide=False):
    """The leading part of the number's own digits, told by how many stand ahead of the point."""
    digits = f"rtrim(rtrim(CAST({c}::varchar::decimal(38,15) AS VARCHAR), '0'), '.')"
    narrow = "" if wide else f"WHEN abs({c}) < 100 THEN regexp_extract({digits}, '^-?[0-9]+([.][0-9]{{1,3}})?') "
    return f"CASE {narrow}WHEN {c} IS NOT NULL THEN regexp_extract({digits}, '^-?[0-9]+([.][0-9])?') END"


CUT_SQL = "'[' || concat_ws(',', " + ", ".join(cut_sql(c, c == "abs_mag") for c in ("x", "y", "z", "color", "abs_mag")) + ") || ']'"


@query("m16_cut_decimals", f"SELECT source_id, {CUT_SQL} AS line FROM t_stars")
def _(t):
    return t.stars.select("source_id", text.cut_row(("x", "y", "z", "color", "abs_mag")).alias("line"))


@query(
    "m17_brightness",
    """SELECT source_id, round(greatest(least((900 - pow(abs_mag + 8, 2)) / 900, 1), 0.1::double), 6) AS brightness
FROM t_stars""",
)
def _(t):
    return t.stars.select("source_id", F.round(photometry.brightness(), 6).alias("brightness"))


@query(
    "m18_temperature",
    "SELECT source_id, round(2.8977719::double * color * 1000 * 1.5::double, 6) AS temperature FROM t_stars",
)
def _(t):
    return t.stars.select("source_id", F.round(photometry.temperature(), 6).alias("temperature"))


RGB_SQL = """SELECT source_id, dist, size_class, brightness, temperature,
 CASE WHEN color = 0 THEN 1 ELSE red * brightness / 255 END AS r,
 CASE WHEN color = 0 THEN 1 ELSE green * brightness / 255 END AS g,
 CASE WHEN color = 0 THEN 1 ELSE blue * brightness / 255 END AS b
FROM (SELECT *,
 CASE WHEN t <= 66 THEN 255 ELSE least(greatest(329.698727446::double * pow(t - 60, -0.1332047592::double), 0), 255) END AS red,
 CASE WHEN t <= 66 THEN CASE WHEN t > 0 THEN least(greatest(99.4708025861::double * ln(t) - 161.1195681661::double, 0), 255) ELSE 0 END
  ELSE least(greatest(288.1221695283::double * pow(t - 60, -0.0755148492::double), 0), 255) END AS green,
 CASE WHEN t >= 66 THEN 255 WHEN t <= 19 THEN 0
  ELSE least(greatest(138.5177312231::double * ln(t - 10) - 305.0447927307::double, 0), 255) END AS blue
FROM (SELECT source_id, color, sqrt(x * x + y * y + z * z) AS dist,
 greatest(least((20 - (trunc(abs_mag) + 10)) / 5, 3), 0.2::double) AS size_class,
 greatest(least((900 - pow(abs_mag + 8, 2)) / 900, 1), 0.1::double) AS brightness,
 2.8977719::double * color * 1000 * 1.5::double AS temperature,
 2.8977719::double * color * 15::double AS t FROM {source}) a) b"""


@query(
    "m19_rgb",
    f"""SELECT source_id, round(r, 6) AS r, round(g, 6) AS g, round(b, 6) AS b
FROM ({RGB_SQL.format(source='(SELECT * REPLACE (CASE WHEN source_id % 5 = 0 THEN 0 ELSE color - (source_id % 4) * 0.4::double END AS color) FROM t_stars)')}) c""",
)
def _(t):
    # Colours from 0 (plain white) over cool to hot, so that every branch is taken.
    colour = F.when(F.col("source_id") % 5 == 0, F.lit(0.0)).otherwise(
        F.col("color") - (F.col("source_id") % 4) * F.lit(0.4)
    )
    c = photometry.rgb()
    return rounded(
        t.stars.withColumn("color", colour).select("source_id", *[c[n].alias(n) for n in "rgb"])
    )


@query(
    "m20_size_class",
    """SELECT source_id, round(greatest(least((20 - (trunc(abs_mag) + 10)) / 5, 3), 0.2::double), 6) AS size_class
FROM t_stars""",
)
def _(t):
    return t.stars.select("source_id", F.round(photometry.size_class(), 6).alias("size_class"))


@query(
    "m21_without_footnotes",
    "SELECT name, regexp_replace(line, '\\[\\d+\\]', '', 'g') AS line FROM t_page_lines",
)
def _(t):
    return t.fixture("page_lines").select("name", text.without_footnotes("line").alias("line"))


@query(
    "m22_globular_line",
    "SELECT kpc_text AS dist_text, ra_text, dec_text, name FROM t_page_lines",
)
def _(t):
    fields = text.globular_fields(text.without_footnotes("line"))
    return t.fixture("page_lines").select(fields.alias("f")).select("f.*")


@query(
    "m23_open_cluster_line",
    "SELECT CAST(open_pc AS VARCHAR) AS dist_text, open_ra AS ra_text, open_dec AS dec_text, name FROM t_page_lines",
)
def _(t):
    return t.fixture("page_lines").select(text.open_cluster_fields("open_line").alias("f")).select("f.*")


@query(
    "m24_kiloparsec_text",
    """SELECT name, CASE WHEN regexp_full_match(kpc_text, '\\d+\\.\\d{3}') THEN kpc_text::double
 ELSE round(kpc_text::double * 1000, 0) END AS dist_pc FROM t_page_lines""",
)
def _(t):
    return t.fixture("page_lines").select(
        "name", text.kiloparsec_text_to_parsec("kpc_text").alias("dist_pc")
    )


@query(
    "m25_sky_area",
    """SELECT element, (ra_max::double - ra_min::double) * (dec_max::double - dec_min::double) AS area
FROM t_digest""",
)
def _(t):
    d = t.fixture("digest").withColumns(
        {c: F.col(c).cast("double") for c in ("ra_min", "ra_max", "dec_min", "dec_max")}
    )
    return d.select("element", text.sky_area().alias("area"))


@query("m26_element_name", "SELECT id, element FROM t_digest")
def _(t):
    path = F.split("line", ",")[0]
    return t.fixture("digest").select("id", text.element_name(path, ".csv.fapec").alias("element"))


@query(
    "m27_digest_matches",
    """SELECT filename, CASE length(hash) WHEN 32 THEN md5(content) WHEN 40 THEN sha1(content)
 ELSE sha256(content) END AS digest,
 CASE length(hash) WHEN 32 THEN md5(content) WHEN 40 THEN sha1(content) ELSE sha256(content) END = hash AS intact
FROM t_checksums""",
)
def _(t):
    c = t.fixture("checksums").withColumn("content", F.encode("content", "UTF-8"))
    return c.select(
        "filename",
        text.digest_as("hash", "content").alias("digest"),
        text.digest_matches("hash", "content").alias("intact"),
    )


@query(
    "m28_identifiers",
    """SELECT oid, pos, CASE WHEN id LIKE 'HIP %' THEN CAST(substr(id, 5) AS BIGINT) END AS hip,
 CASE WHEN id LIKE 'NAME %' THEN rtrim(substr(id, 6)) END AS name,
 CASE WHEN id LIKE 'Gaia DR3 %' THEN CAST(substr(id, 10) AS BIGINT) END AS source_id FROM t_identifiers""",
)
def _(t):
    return t.fixture("identifiers").select(
        "oid",
        "pos",
        text.identifier_number("id").alias("hip"),
        text.identifier_name("id").alias("name"),
        text.identifier_source("id").alias("source_id"),
    )


@query(
    "m29_number_text",
    f"""SELECT source_id, CASE WHEN v = round_even(v, 0) THEN CAST(CAST(v AS BIGINT) AS VARCHAR)
 ELSE {fixed_text_sql('v', 1)} END AS v FROM (
 SELECT source_id, CASE WHEN source_id % 5 = 0 THEN mag ELSE x END AS v FROM t_stars) s""",
)
def _(t):
    # Spectrometer magnitudes have whole numbers among them, coordinates do not.
    stars = derived(t.positive, "mag")
    v = F.when(F.col("source_id") % 5 == 0, F.col("mag")).otherwise(F.col("x"))
    return stars.select("source_id", v.alias("v")).withColumn("v", rounding.number_text("v"))


@query(
    "m30_cluster_suffix",
    """SELECT dist_pc, name FROM t_clusters UNION ALL SELECT dist_pc, name || ' (gc)' FROM t_sky""",
)
def _(t):
    opened, globular = (t.fixture(n).select("dist_pc", "name") for n in ("clusters", "sky"))
    return combined_clusters(opened, globular)


@query(
    "m31_blend",
    """SELECT x, y, z, round(1 - v, 9) AS r, 0::double AS g, round(v, 9) AS b FROM (
 SELECT *, (n - min(n) OVER ()) / (max(n) OVER () - min(n) OVER ())::double AS v FROM (
  SELECT CAST(round_even(x / 500, 0) AS BIGINT) AS x, CAST(round_even(y / 500, 0) AS BIGINT) AS y,
   CAST(round_even(z / 500, 0) AS BIGINT) AS z, count(*) AS n
  FROM t_stars_large WHERE px_over_err > 10 GROUP BY ALL) a) b""",
)
def _(t):
    scaled = bins.normalised(bins.build(t.stars_large, bins.BIN_SETS[2]), "count")
    c = photometry.blend("count")
    return rounded(scaled.select("x", "y", "z", *[c[n].alias(n) for n in "rgb"]), digits=9)
