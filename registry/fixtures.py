"""Star-catalogue inputs derived from the given tables.

Each fixture is one SQL text that both engines run, so the inputs of a query and
of its check are the same by construction; everything after that is computed
separately.
"""

import re

from pyspark.sql import functions as F

from starloom import schemas
from starloom.plans.stars import derived, ingested, merged
from starloom.session import staging_path
from starloom.sinks.files import write_files
from starloom.sources.tables import star_table

TABLES = (
    "region nation customer supplier part orders lineitem events documents "
    "embeddings pages benchmark labels conversations"
).split()


def _raw(table, key, other, price, extra):
    return f"""
SELECT *, parallax / parallax_error AS parallax_over_error FROM (
 SELECT {key} AS source_id, CAST(floor({key} / 4000.0) AS BIGINT) AS file_no, {extra}
  ({key} * CAST(137.50776405 AS DOUBLE)) % CAST(360 AS DOUBLE) AS ra,
  CAST({other} % 179 - 89 AS DOUBLE) AS dec,
  CASE WHEN {key} % 97 = 0 THEN CAST(-1 AS DOUBLE)
   ELSE CAST(0.05 AS DOUBLE)
    + CAST(CAST(floor({price} * CAST(100 AS DOUBLE) + CAST(0.5 AS DOUBLE)) AS BIGINT) % 100000 AS DOUBLE)
    / CAST(5000 AS DOUBLE) END AS parallax,
  CAST(0.01 AS DOUBLE) + CAST({key} % 40 AS DOUBLE) / CAST(100 AS DOUBLE) AS parallax_error,
  CASE WHEN {key} % 3 = 0 THEN NULL
   ELSE CAST(1.2 AS DOUBLE) + CAST({other} % 80 AS DOUBLE) / CAST(100 AS DOUBLE) END
   AS nu_eff_used_in_astrometry,
  CASE WHEN {key} % 2 = 0 THEN NULL
   ELSE CAST(1.1 AS DOUBLE) + CAST({other} % 90 AS DOUBLE) / CAST(100 AS DOUBLE) END AS pseudocolour,
  CASE WHEN {key} % 9 = 0 THEN NULL ELSE CAST(3000 + {key} % 500 AS DOUBLE) END AS teff_gspphot,
  CASE WHEN {key} % 7 = 0 THEN NULL
   ELSE CAST(4 AS DOUBLE) + CAST({key} % 160 AS DOUBLE) / CAST(10 AS DOUBLE) END AS phot_g_mean_mag,
  CASE WHEN {key} % 7 = 0 OR {key} % 11 = 0 THEN NULL
   ELSE CAST(3.5 AS DOUBLE) + CAST({key} % 150 AS DOUBLE) / CAST(10 AS DOUBLE) END AS phot_rp_mean_mag,
  CASE WHEN {key} % 7 = 0 OR {key} % 13 = 0 THEN NULL
   ELSE CAST(4.5 AS DOUBLE) + CAST({key} % 170 AS DOUBLE) / CAST(10 AS DOUBLE) END AS phot_bp_mean_mag,
  CASE WHEN {key} % 5 <> 0 THEN NULL
   ELSE CAST(3 AS DOUBLE) + CAST({key} % 160 AS DOUBLE) / CAST(10 AS DOUBLE) END AS grvs_mag
 FROM {{{table}}}) r"""


def _two(n):
    return f"lpad(CAST({n} AS STRING), 2, '0')"


FIXTURES = {
    "raw": _raw(
        "orders",
        "o_orderkey",
        "o_custkey",
        "o_totalprice",
        "o_orderpriority AS lot, (o_orderstatus = 'F') AS loaded,",
    ),
    # The key repeats here.
    "raw_large": _raw(
        "lineitem",
        "(l_orderkey * 8 + l_linenumber)",
        "l_partkey",
        "l_extendedprice",
        "l_returnflag AS lot, (l_linestatus = 'F') AS loaded,",
    ),
    "clusters": """
SELECT s_suppkey AS pos, s_name AS name, s_suppkey * CAST(3.6 AS DOUBLE) AS ra,
 CAST((s_suppkey % 60) * 3 - 89 AS DOUBLE) AS dec, CAST(20 + s_suppkey * 10 AS DOUBLE) AS dist_pc
FROM {supplier}""",
    "sky": f"""
SELECT id, name, dist_pc, h, m, t, d, sign, notation, readable,
 CASE WHEN NOT readable THEN 'unknown'
  WHEN notation = 0 THEN hh || '^h ' || mm || '^m ' || ss || '.' || tenth || '^s'
  WHEN notation = 1 THEN hh || ':' || mm || ':' || ss || '.' || tenth
  WHEN notation = 2 THEN hh || '^h ' || mm || '^m'
  ELSE hh || 'h' || mm || 'm' || ss || 's.' || tenth END AS ra_text,
 CASE WHEN NOT readable THEN 'unknown'
  WHEN notation = 0 THEN sign || dd || '° ' || mm || '′ ' || ss || '.' || tenth || '″'
  WHEN notation = 1 THEN sign || dd || ':' || mm || ':' || ss || '.' || tenth
  WHEN notation = 2 THEN sign || dd || '° ' || mm || '′'
  ELSE sign || dd || '°' || mm || '′' || ss || '″.' || tenth END AS dec_text,
 id % 40 + CAST(0.5 AS DOUBLE) AS radius,
 CASE id % 5 WHEN 0 THEN CAST(id % 40 AS STRING) || '.5 degrees'
  WHEN 1 THEN CAST(id % 40 AS STRING) || '.5 arcmins'
  WHEN 2 THEN CAST(id % 40 AS STRING) || '.5'
  WHEN 3 THEN CAST(id % 40 AS STRING) || '.5 parsecs'
  ELSE 'about ' || CAST(id AS STRING) END AS radius_text
FROM (
 SELECT *, {_two('h')} AS hh, {_two('m')} AS mm, {_two('d')} AS dd,
  {_two('CAST(floor(t / 10.0) AS BIGINT)')} AS ss, CAST(t % 10 AS STRING) AS tenth
 FROM (
  SELECT c_custkey AS id, c_name AS name, CAST(20 + c_custkey AS DOUBLE) AS dist_pc,
   c_custkey % 24 AS h, c_custkey % 60 AS m, (c_custkey * 7) % 600 AS t, c_custkey % 90 AS d,
   CASE WHEN c_custkey % 35 = 7 THEN '' WHEN c_custkey % 3 = 0 THEN '+'
    WHEN c_custkey % 3 = 1 THEN '-' ELSE '−' END AS sign,
   c_custkey % 4 AS notation, c_custkey % 50 <> 0 AS readable
  FROM {{customer}}) a) b""",
    "names_first": """
SELECT p_partkey AS pos, p_name AS name,
 CASE p_partkey % 50 WHEN 0 THEN '-' WHEN 1 THEN '' WHEN 2 THEN '12 A'
  ELSE CAST(CAST(floor(p_partkey / 5.0) AS BIGINT) AS STRING) END AS hip
FROM {part} WHERE p_size < 20""",
    "names_second": """
SELECT p_partkey AS pos, p_name AS name,
 CASE p_partkey % 50 WHEN 0 THEN '-' WHEN 1 THEN '' WHEN 2 THEN '12 A'
  ELSE CAST(CAST(floor(p_partkey / 5.0) AS BIGINT) AS STRING) END AS hip
FROM {part} WHERE p_size >= 20""",
    # Several rows per object in order; some numbers and sources belong to two objects.
    "identifiers": """
SELECT c_custkey AS oid, c_custkey * 10 + 1 AS pos,
 'HIP ' || CAST(c_custkey - CASE WHEN c_custkey % 7 = 3 THEN 1 ELSE 0 END AS STRING) AS id
FROM {customer} WHERE c_mktsegment <> 'HOUSEHOLD'
UNION ALL
SELECT c_custkey, c_custkey * 10 + 2, 'NAME ' || c_name || ' ' FROM {customer}
UNION ALL
SELECT c_custkey, c_custkey * 10 + 3, 'NAME ' || c_mktsegment || ' ' || CAST(c_nationkey AS STRING) || ' '
FROM {customer} WHERE c_nationkey < 8
UNION ALL
SELECT c_custkey, c_custkey * 10 + 4,
 'Gaia DR3 ' || CAST(7 * (c_custkey - CASE WHEN c_custkey % 11 = 5 THEN 1 ELSE 0 END) AS STRING)
FROM {customer} WHERE c_mktsegment <> 'MACHINERY'""",
    "neighbours": """
SELECT c_custkey AS hip, c_custkey * 5 AS source_id, c_custkey AS pos
FROM {customer} WHERE c_mktsegment IN ('BUILDING', 'MACHINERY')""",
    "newer": """
SELECT c_custkey AS hip, c_custkey AS pos, CAST(c_custkey % 360 AS DOUBLE) AS ra,
 CAST(c_custkey % 170 - 85 AS DOUBLE) AS dec, c_acctbal / CAST(100 AS DOUBLE) AS plx,
 CAST(1 + c_custkey % 12 AS DOUBLE) AS mag,
 CAST(c_custkey % 30 AS DOUBLE) / CAST(10 AS DOUBLE) - CAST(0.4 AS DOUBLE) AS colour
FROM {customer} WHERE c_nationkey < 18""",
    "older": """
SELECT c_custkey AS hip, c_custkey AS pos, CAST(c_custkey % 360 AS DOUBLE) AS ra,
 CAST(c_custkey % 170 - 85 AS DOUBLE) AS dec, c_acctbal / CAST(90 AS DOUBLE) AS plx,
 CAST(1 + c_custkey % 11 AS DOUBLE) AS mag,
 CAST(c_custkey % 20 AS DOUBLE) / CAST(10 AS DOUBLE) - CAST(0.3 AS DOUBLE) AS colour
FROM {customer} WHERE c_nationkey < 22""",
    "digest": """
SELECT *, '/sky/cells/' || element || '.csv.fapec,' || CAST(num_sources AS STRING) || ',' || ra_min
 || ',' || ra_max || ',' || dec_min || ',' || dec_max AS line
FROM (
 SELECT c_custkey AS id,
  CASE WHEN c_mktsegment = 'MACHINERY' THEN 'Tmp_' ELSE 'Src_' END
   || lpad(CAST(c_custkey AS STRING), 12, '0') AS element,
  c_custkey * 10 + 7 AS num_sources,
  CAST(c_custkey % 350 AS STRING) || '.25' AS ra_min,
  CAST(c_custkey % 350 + c_custkey % 7 AS STRING) || '.5' AS ra_max,
  CASE WHEN c_custkey % 2 = 0 THEN '+' ELSE '-' END || CAST(c_custkey % 80 AS STRING) || '.25' AS dec_min,
  '+8' || CAST(c_custkey % 10 AS STRING) || '.75' AS dec_max
 FROM {customer}) a""",
    "checksums": """
SELECT element || '.csv.gz' AS filename, content, listed,
 CASE WHEN kind = 0 THEN md5(hashed) WHEN kind = 1 THEN sha1(hashed) ELSE <<sha256>> END AS hash
FROM (
 SELECT CASE WHEN c_mktsegment = 'MACHINERY' THEN 'Tmp_' ELSE 'Src_' END
   || lpad(CAST(c_custkey AS STRING), 12, '0') AS element,
  c_name AS content, c_name || CASE WHEN c_nationkey = 3 THEN '?' ELSE '' END || chr(10) AS hashed,
  c_custkey % 3 AS kind, c_nationkey <> 5 AS listed
 FROM {customer}) a""",
    "page_lines": f"""
SELECT CAST(floor(s_suppkey / 50.0) AS BIGINT) AS page, 2 + s_suppkey % 50 AS n, name, ra_text, dec_text,
 kpc_text, open_pc,
 '   ' || name || '[' || CAST(s_suppkey % 19 AS STRING) || '] ' || ra_text || ' ' || dec_text || ' Sgr '
  || kpc_text || ' ly' || CASE WHEN s_acctbal > 9000 THEN ' (end)' ELSE '' END AS line,
 '   ' || name || ' ' || open_ra || ' ' || open_dec || ' Tau ' || open_text || ' 625 note' AS open_line,
 open_ra, open_dec
FROM (
 SELECT s_suppkey, s_acctbal, s_name AS name,
  {_two('s_suppkey % 24')} || '^h ' || {_two('s_suppkey % 60')} || '^m ' || {_two('(s_suppkey * 7) % 60')} || '.5^s' AS ra_text,
  CASE WHEN s_suppkey % 2 = 0 THEN '+' ELSE '−' END || {_two('s_suppkey % 90')} || '° '
   || {_two('s_suppkey % 60')} || '′ ' || {_two('(s_suppkey * 11) % 60')} || '.3″' AS dec_text,
  CASE s_suppkey % 4 WHEN 0 THEN CAST(1 + s_suppkey % 90 AS STRING)
   WHEN 1 THEN CAST(1 + s_suppkey % 90 AS STRING) || '.4'
   WHEN 2 THEN CAST(1 + s_suppkey % 90 AS STRING) || '.24'
   ELSE CAST(1 + s_suppkey % 90 AS STRING) || '.125' END AS kpc_text,
  20 + (s_suppkey * 13) % 90000 AS open_pc,
  CASE WHEN 20 + (s_suppkey * 13) % 90000 < 1000 THEN CAST(20 + (s_suppkey * 13) % 90000 AS STRING)
   ELSE CAST(CAST(floor((20 + (s_suppkey * 13) % 90000) / 1000.0) AS BIGINT) AS STRING) || ','
    || lpad(CAST((20 + (s_suppkey * 13) % 90000) % 1000 AS STRING), 3, '0') END AS open_text,
  {_two('s_suppkey % 24')} || '^h ' || {_two('s_suppkey % 60')} || '.9^m' AS open_ra,
  CASE WHEN s_suppkey % 2 = 0 THEN '+' ELSE '−' END || {_two('s_suppkey % 90')} || '° '
   || {_two('s_suppkey % 60')} || '′' AS open_dec
 FROM {{supplier}}) a""",
}

_SHA = {"spark": "sha2(hashed, 256)", "duckdb": "sha256(hashed)"}


def text_for(name, engine):
    return FIXTURES[name].replace("<<sha256>>", _SHA[engine])


_star_tables = {}


class Tables:
    """The given tables and the fixtures of one scale, as DataFrames.

    Star sets, bins and regions work on a stored star table, as they do in
    practice; the first query of a session that needs one derives it from the
    given tables and writes it to the shared folder.
    """

    def __init__(self, spark, folder):
        self.spark, self.folder = spark, folder

    def _star_table(self, name, rows):
        key = (self.spark.sparkContext.applicationId, self.folder, name)
        if key not in _star_tables:
            path = self.scratch(name)
            # Sorted by distance inside each file, so row-group statistics prune.
            derived(rows()).sortWithinPartitions("dist").write.parquet(path)
            _star_tables[key] = path
        return star_table(self.spark, _star_tables[key])

    def table(self, name):
        return self.spark.read.parquet(f"{self.folder}/{name}.parquet")

    def fixture(self, name):
        text = text_for(name, "spark")
        used = set(re.findall(r"\{(\w+)\}", text))
        return self.spark.sql(text, **{t: self.table(t) for t in used})

    @property
    def raw(self):
        return self.fixture("raw")

    @property
    def raw_large(self):
        return self.fixture("raw_large")

    @property
    def filtered(self):
        """Filtered stars: what the ingest keeps."""
        return ingested(self.raw, "file_no", "lot", "loaded")

    @property
    def positive(self):
        """Every star with a usable parallax, whatever its quality."""
        return merged(self.raw.filter("parallax > 0"), "file_no", "lot", "loaded")

    @property
    def positive_large(self):
        return merged(self.raw_large.filter("parallax > 0"), "file_no", "lot", "loaded")

    @property
    def stars(self):
        return self._star_table("stars", lambda: self.positive)

    @property
    def stars_large(self):
        return self._star_table("stars-large", lambda: self.positive_large)

    def scratch(self, label):
        return staging_path(self.spark, label)


def write_text_files(lines, path, compression="none", file_column="file_no"):
    """One text file per value of `file_column`, lines in the order of `n`."""
    (
        lines.repartition(file_column)
        .sortWithinPartitions(file_column, "n")
        .select(file_column, "line")
        .write.mode("append")
        .partitionBy(file_column)
        .text(path, compression=compression)
    )
    return path


def write_named_files(files, path):
    """One file per row (filename, content), under its own name, its text ended by a line feed."""
    texts = files.select("filename", F.concat(F.coalesce("content", F.lit("")), F.lit("\n")).cast("binary").alias("content"))
    return write_files(texts, path)


def write_source_files(raw, path):
    """Survey files as they are downloaded: compressed, with comments, header and `null`."""
    columns = schemas.RAW_COLUMNS
    values = [F.coalesce(F.col(c).cast("string"), F.lit("null")) for c in columns]
    # Missing temperatures are written as NaN.
    values[columns.index("teff_gspphot")] = F.coalesce(F.col("teff_gspphot").cast("string"), F.lit("NaN"))
    wide = [*values, F.lit("unused"), F.lit("null")]
    header = [*columns, "notes", "random_index"]
    # Some files have two columns exchanged, and say so in their header.
    a, b = columns.index("ra"), columns.index("dec")
    other = F.col("file_no") % 3 == 1

    def line(cells):
        moved = list(cells)
        moved[a], moved[b] = moved[b], moved[a]
        return F.when(other, F.concat_ws(",", *moved)).otherwise(F.concat_ws(",", *cells)).alias("line")

    rows = raw.select("file_no", F.col("source_id").alias("n"), line(wide))
    opening = F.array(
        *[
            F.struct(F.lit(i).cast("long").alias("n"), t.alias("line"))
            for i, t in (
                (-3, F.lit("# survey extract")),
                (-2, F.lit("# units: degrees, mas")),
                (-1, line([F.lit(c) for c in header])),
            )
        ]
    )
    top = raw.select("file_no").distinct().select("file_no", F.inline(opening))
    return write_text_files(rows.unionByName(top), path, "gzip")


def write_pages(lines, path):
    """Page dumps, one file each, with a heading that is no table line."""
    heading = lines.select("page").distinct().select(
        "page", F.lit(1).cast("long").alias("n"), F.lit("Name  Position  Distance").alias("line")
    )
    return write_text_files(
        lines.select("page", "n", "line").unionByName(heading), path, file_column="page"
    )
