"""The scalar helpers as SQL functions; Catalyst inlines their bodies."""

from starloom import fixed

LY = fixed.LIGHT_YEARS_PER_PARSEC


def _cut(*marks):
    """`txt` cut at its unit marks, as in `angles`."""
    text = "txt"
    for mark in marks:
        text = f"replace({text}, {mark}, ':')"
    return f"split({text}, ':', -1)"


def _sixtieths(fields, last):
    """Minutes and seconds of cut text, as in `angles`."""
    minutes, seconds = f"ltrim(get({fields}, 1))", f"regexp_extract(ltrim(get({fields}, 2)), '^[0-9.{last}]*', 0)"
    return (
        f"CASE WHEN size({fields}) > 2 AND {minutes} RLIKE '^[0-9.]+$' THEN try_cast({minutes} AS DOUBLE) END",
        f"CASE WHEN {seconds} = '' THEN 0D ELSE try_cast(replace({seconds}, '{last}', '') AS DOUBLE) END",
    )


RA = _cut("'^h'", "'^m'", "'h'", "'m'")
RA_MINUTES, RA_SECONDS = _sixtieths(RA, "s")
DEC = _cut("'°'", "'′'", "chr(39)")
DEC_MINUTES, DEC_SECONDS = _sixtieths(DEC, "″")
DEC_DIGITS = f"regexp_extract({DEC}[0], '[0-9]+$', 0)"
DEC_LEAD = f"left({DEC}[0], length({DEC}[0]) - length({DEC_DIGITS}))"

DEFINITIONS = {
    "sky_distance_ly": (
        "parallax DOUBLE",
        "DOUBLE",
        f"try_divide({LY}D, parallax * {fixed.ARCSEC_PER_MAS}D)",
    ),
    "sky_position": (
        "ra DOUBLE, dec DOUBLE, dist DOUBLE",
        "STRUCT<x DOUBLE, y DOUBLE, z DOUBLE>",
        "named_struct('x', cos(radians(ra)) * cos(radians(dec)) * dist, "
        "'y', sin(radians(ra)) * cos(radians(dec)) * dist, 'z', sin(radians(dec)) * dist)",
    ),
    "sky_abs_mag": (
        "mag DOUBLE, dist DOUBLE",
        "DOUBLE",
        f"mag + 5D - 5D * log10(dist * {LY}D)",
    ),
    "sky_ra_degrees": (
        "txt STRING",
        "DOUBLE",
        f"CASE WHEN {RA}[0] RLIKE '^[0-9]+$' THEN try_cast({RA}[0] AS DOUBLE) END * 15D"
        f" + ({RA_MINUTES}) * 15D / 60D + ({RA_SECONDS}) * 15D / 3600D",
    ),
    "sky_dec_degrees": (
        "txt STRING",
        "DOUBLE",
        f"(CASE WHEN right({DEC_LEAD}, 1) IN ('-', '−') THEN -1D ELSE 1D END) * ("
        f"CASE WHEN NOT {DEC_LEAD} RLIKE '[0-9]' THEN try_cast({DEC_DIGITS} AS DOUBLE) END"
        f" + ({DEC_MINUTES}) / 60D + ({DEC_SECONDS}) / 3600D)",
    ),
    "sky_bin": ("v DOUBLE, step DOUBLE", "BIGINT", "CAST(rint(v / step) AS BIGINT)"),
    "sky_rgb": (
        "colour DOUBLE, mag DOUBLE",
        "STRUCT<r DOUBLE, g DOUBLE, b DOUBLE>",
        None,
    ),
}


def _rgb_body():
    t = f"({fixed.WIEN_SCALE}D * colour * 1000D * {fixed.TEMPERATURE_FACTOR}D / 100D)"
    span = f"{fixed.DIM_SPAN}D"
    dim = (
        f"least(greatest(({span} - pow(mag + {fixed.DIM_CENTRE}D, 2)) / {span},"
        f" {fixed.DIM_FLOOR}D), 1D) / 255D"
    )

    def channel(v):
        return f"coalesce(least(greatest({v}, 0D), 255D), 0D)"

    red = channel(f"{fixed.RED_SCALE}D * pow({t} - 60D, {fixed.RED_POWER}D)")
    cool = channel(f"{fixed.GREEN_SCALE}D * ln({t}) - {fixed.GREEN_SHIFT}D")
    hot = channel(f"{fixed.GREEN_HOT_SCALE}D * pow({t} - 60D, {fixed.GREEN_HOT_POWER}D)")
    blue = channel(f"{fixed.BLUE_SCALE}D * ln({t} - 10D) - {fixed.BLUE_SHIFT}D")
    parts = {
        "r": f"CASE WHEN {t} <= 66D THEN 255D ELSE {red} END",
        "g": f"CASE WHEN {t} <= 66D THEN {cool} ELSE {hot} END",
        "b": f"CASE WHEN {t} >= 66D THEN 255D WHEN {t} <= 19D THEN 0D ELSE {blue} END",
    }
    fields = ", ".join(
        f"'{k}', CASE WHEN colour = 0D THEN 1D ELSE ({v}) * {dim} END" for k, v in parts.items()
    )
    return f"named_struct({fields})"


def register(spark):
    """Creates the temporary SQL functions and returns their names."""
    for name, (args, result, body) in DEFINITIONS.items():
        body = body or _rgb_body()
        spark.sql(
            f"CREATE OR REPLACE TEMPORARY FUNCTION {name}({args}) RETURNS {result} RETURN {body}"
        )
    return list(DEFINITIONS)
