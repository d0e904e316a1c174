"""Registration of queries and the SQL side of the fixtures."""

import re

from registry.fixtures import FIXTURES, TABLES, Tables, text_for
from starloom import fixed

QUERIES, ORACLE = {}, {}

LY = f"{fixed.LIGHT_YEARS_PER_PARSEC}::double"

_FILTERED_COLUMNS = """source_id, file_no, lot, loaded, ra, dec, parallax, parallax_error,
 parallax_over_error,
 coalesce(nu_eff_used_in_astrometry, pseudocolour, 1::double) AS color,
 coalesce(grvs_mag, least(phot_g_mean_mag, phot_rp_mean_mag, phot_bp_mean_mag) - 0.25::double, 20::double) AS mag"""


def _stars(source):
    return f"""SELECT source_id, file_no, loaded, ra, dec, parallax, parallax_error, color, mag, dist,
 parallax / parallax_error AS px_over_err,
 cos(radians(ra)) * cos(radians(dec)) * dist AS x,
 sin(radians(ra)) * cos(radians(dec)) * dist AS y,
 sin(radians(dec)) * dist AS z,
 mag + 5::double - 5::double * log10(dist * {LY}) AS abs_mag
FROM (SELECT *, {LY} / (parallax * 0.001::double) AS dist FROM {source}) s"""


def published_sql(source, extra="source_id"):
    """The rounded projection, as decimals."""
    rounded = ", ".join(
        f"round({c}::varchar::decimal(38,15), {n}) AS {c}"
        for c, n in (("x", 1), ("y", 1), ("z", 1), ("color", 1), ("abs_mag", 0))
    )
    return f"SELECT {extra}, {rounded}, dist FROM {source}"


def fixed_text_sql(c, n):
    # By way of text: a double times a power of ten would be rounded on the way.
    return f"CAST(round({c}::varchar::decimal(38,15), {n}) AS VARCHAR)"


# Derived tables of the checks; `t_` names may be used in any check.
CTES = {f"t_{n}": text_for(n, "duckdb").format(**{t: t for t in TABLES}) for n in FIXTURES}
CTES |= {
    "t_positive": f"SELECT {_FILTERED_COLUMNS} FROM t_raw WHERE parallax > 0",
    "t_positive_large": f"SELECT {_FILTERED_COLUMNS} FROM t_raw_large WHERE parallax > 0",
    "t_filtered": f"SELECT {_FILTERED_COLUMNS} FROM t_raw WHERE parallax_over_error > 2 AND parallax > 0",
    "t_stars": _stars("t_positive"),
    "t_stars_large": _stars("t_positive_large"),
    "t_published": published_sql("t_stars"),
    "t_places": f"""SELECT *, cos(radians(ra)) * cos(radians(dec)) * dist AS x,
 sin(radians(ra)) * cos(radians(dec)) * dist AS y, sin(radians(dec)) * dist AS z
FROM (SELECT *, dist_pc * {LY} AS dist FROM t_clusters) c""",
    "t_sky_degrees": """SELECT *,
 CASE WHEN readable THEN h * 15.0::double + m * 15.0::double / 60::double
  + CASE WHEN notation = 2 THEN 0::double ELSE t / 10.0::double * 15::double / 3600::double END END AS ra,
 CASE WHEN readable THEN CASE WHEN sign IN ('-', '−') THEN -1 ELSE 1 END * (d + m / 60.0::double
  + CASE WHEN notation = 2 THEN 0::double ELSE t / 10.0::double / 3600::double END) END AS dec,
 CASE id % 5 WHEN 0 THEN radius * 60 WHEN 1 THEN radius WHEN 2 THEN radius WHEN 3 THEN 0 END AS arcmin
FROM t_sky""",
    "t_boxes": "SELECT name, "
    + ", ".join(
        f"""round_even(CASE WHEN {a} < 0 THEN {a} * 1.1::double - 150 WHEN {a} > 0
  THEN {a} * 0.9::double - 150 ELSE 0 END, 0) AS lo_{a},
 round_even(CASE WHEN {a} < 0 THEN {a} * 0.9::double + 150 WHEN {a} > 0
  THEN {a} * 1.1::double + 150 ELSE 0 END, 0) AS hi_{a}"""
        for a in "xyz"
    )
    + " FROM t_places",
}


def with_tables(sql):
    """`sql` with the derived tables it uses, and theirs, in front."""
    needed, todo = set(), [sql]
    while todo:
        for name in re.findall(r"\bt_\w+", todo.pop()):
            if name in CTES and name not in needed:
                needed.add(name)
                todo.append(CTES[name])
    parts = [f"{n} AS ({t})" for n, t in CTES.items() if n in needed]
    if not parts:
        return sql
    if sql.lstrip().upper().startswith("WITH RECURSIVE"):
        return "WITH RECURSIVE " + ",\n".join(parts) + ",\n" + sql.lstrip()[len("WITH RECURSIVE"):]
    if sql.lstrip().upper().startswith("WITH"):
        return "WITH " + ",\n".join(parts) + ",\n" + sql.lstrip()[len("WITH"):]
    return "WITH " + ",\n".join(parts) + "\n" + sql


def query(name, sql=None):
    """Registers a function of `Tables` as a query, with its check."""

    def add(fn):
        def run(spark, folder):
            return fn(Tables(spark, folder))

        run.__doc__ = fn.__doc__
        QUERIES[name] = run
        if sql is not None:
            ORACLE[name] = with_tables(sql)
        return fn

    return add
