"""Parsing and shaping of catalogue text."""

from pyspark.sql import functions as F

from starloom import fixed
from starloom.functions.rounding import col

# A table line: name, hour angle, declination, and the rest of the line.
LINE = r"^\s+(\S.*?)\s+(\d+\^h.*?\^{hours})\s+(\S?\d+°\s*\d+.*?{degrees})\s(.*)$"
LAST_NUMBER = r"(\d[\d.]*)\D*$"
THOUSANDS = r"(?<![\d.,])(\d{1,3}(?:,\d{3})+|\d{2,})\s"


def plain_number(value):
    """A double written without an exponent and without zeros that say nothing."""
    digits = col(value).cast("decimal(38,15)").cast("string")
    return F.rtrim(F.rtrim(digits, F.lit("0")), F.lit("."))


def cut_number(value, last=False):
    """A double as text with surplus decimals cut off, not rounded.

    Three are left, or one if three or more digits stand ahead of the point or the number
    is the `last` of its row.
    """
    text = plain_number(value)
    whole = F.substring_index(text, ".", 1)
    decimals = F.substring(text, F.length(whole) + 2, F.length(text))
    many = F.length(F.ltrim(whole, F.lit("-"))) >= fixed.CUT_WIDE_FROM
    kept = F.lit(fixed.CUT_WIDE) if last else F.when(many, fixed.CUT_WIDE).otherwise(fixed.CUT_NARROW)
    return F.when(decimals == "", whole).otherwise(F.concat(whole, F.lit("."), F.left(decimals, kept)))


def cut_row(values):
    """One row of an exported file, from columns of doubles."""
    return array_text([cut_number(v, last=k == len(values) - 1) for k, v in enumerate(values)])


def without_footnotes(line):
    return F.regexp_replace(col(line), r"\[\d+\]", "")


def _table_fields(line, hours, degrees, distance):
    """Distance, ra, dec and name of a table line as a struct; NULL for other lines.

    Whatever characters the name holds, it ends where the hour angle begins.
    """
    pattern = LINE.format(hours=hours, degrees=degrees)
    name, ra, dec, rest = (F.regexp_extract(col(line), pattern, k) for k in (1, 2, 3, 4))
    dist = distance(rest)
    return F.when(
        (name != "") & (dist != ""),
        F.struct(dist.alias("dist_text"), ra.alias("ra_text"), dec.alias("dec_text"), name.alias("name")),
    )


def globular_fields(line):
    """A line with seconds in its position; the distance is its last number."""
    return _table_fields(line, "s", "″", lambda rest: F.regexp_extract(rest, LAST_NUMBER, 1))


def open_cluster_fields(line):
    """A line without seconds; the distance is the first number after the position of two
    or more digits, and loses its thousands comma."""

    def distance(rest):
        return F.replace(F.regexp_extract(rest, THOUSANDS, 1), F.lit(","), F.lit(""))

    return _table_fields(line, "m", "′", distance)


def kiloparsec_text_to_parsec(text):
    """Parsecs from kiloparsec text of up to 2 decimals; longer text is taken as parsecs."""
    text = col(text)
    return F.when(
        text.rlike(r"^\d+(\.\d{1,2})?$"), (text.try_cast("decimal(20,3)") * 1000).cast("double")
    ).otherwise(text.try_cast("double"))


def element_name(path, suffix):
    """File name without folders and suffix."""
    base = F.element_at(F.split(col(path), "/"), -1)
    n = len(suffix)
    return F.when(base.endswith(suffix), F.left(base, F.length(base) - n)).otherwise(base)


def sky_area(ra_min="ra_min", ra_max="ra_max", dec_min="dec_min", dec_max="dec_max"):
    return (col(ra_max) - col(ra_min)) * (col(dec_max) - col(dec_min))


def digest_as(expected, content):
    """Digest of `content` by the algorithm that the length of `expected` tells; else NULL."""
    size, content = F.length(col(expected)), col(content)
    return (
        F.when(size == 32, F.md5(content))
        .when(size == 40, F.sha1(content))
        .when(size == 64, F.sha2(content, 256))
        .when(size == 128, F.sha2(content, 512))
    )


def digest_matches(expected, content):
    return F.coalesce(digest_as(expected, content) == F.lower(col(expected)), F.lit(False))


def _or_null(text):
    return F.nullif(text, F.lit(""))


def _within(text, family):
    """What follows the family's name and the blanks after it; NULL for another family."""
    text = col(text)
    parts = F.split(F.right(text, F.length(text) - len(family)), r"\s+", 2)
    return F.when(text.startswith(family) & (parts[0] == ""), F.get(parts, F.lit(1)))


def _leading_number(text):
    return _or_null(F.regexp_extract(text, "^[0-9]+", 0)).try_cast("long")


def identifier_number(text):
    return _leading_number(_within(text, "HIP"))


def identifier_name(text):
    """The name, which blanks must follow."""
    name = _within(text, "NAME")
    return F.when(F.rtrim(name) != name, _or_null(F.rtrim(name)))


def identifier_source(text):
    return _leading_number(_within(text, "Gaia DR3"))


def catalogue_number(text):
    """A catalogue number written with digits only, as a long; NULL otherwise."""
    text = col(text)
    return F.when(text.rlike(r"^[0-9]+$"), text.try_cast("long"))


def array_text(values):
    """One row of an array file: values joined by commas between brackets."""
    return F.concat(F.lit("["), F.concat_ws(",", *values), F.lit("]"))


def quoted(text):
    return F.concat(F.lit('"'), F.replace(col(text), F.lit('"'), F.lit('\\"')), F.lit('"'))
