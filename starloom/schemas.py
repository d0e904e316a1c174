"""Column lists and schemas of the tables that travel between jobs."""

from pyspark.sql import types as T

# Column names of the survey's source files.
RAW_COLUMNS = (
    "source_id",
    "ra",
    "dec",
    "parallax",
    "parallax_error",
    "parallax_over_error",
    "nu_eff_used_in_astrometry",
    "pseudocolour",
    "teff_gspphot",
    "phot_g_mean_mag",
    "phot_rp_mean_mag",
    "phot_bp_mean_mag",
    "grvs_mag",
)
FILTERED_COLUMNS = ("source_id", "ra", "dec", "parallax", "parallax_error", "color", "mag")
STAR_COLUMNS = ("source_id", "px_over_err", "x", "y", "z", "dist", "color", "abs_mag")
SET_COLUMNS = ("x", "y", "z", "color", "abs_mag", "dist")
SET_ORDER = ("dist", "x", "y", "z", "color", "abs_mag")


def doubles(names, key="source_id"):
    """A schema in which `key` is a long and every other column a double."""
    return T.StructType(
        [T.StructField(n, T.LongType() if n == key else T.DoubleType()) for n in names]
    )


RAW = doubles(RAW_COLUMNS)
FILTERED = doubles(FILTERED_COLUMNS)
STAR = doubles(STAR_COLUMNS)

CLUSTER = T.StructType(
    [
        T.StructField("dist_pc", T.DoubleType()),
        T.StructField("ra_text", T.StringType()),
        T.StructField("dec_text", T.StringType()),
        T.StructField("name", T.StringType()),
        T.StructField("stretch", T.StringType()),
    ]
)
