import math
import random
from decimal import ROUND_HALF_UP, Decimal, localcontext

import pytest
from pyspark.sql import functions as F

from starloom import fixed
from starloom.functions import angles, astrometry, photometry, rounding, sql, text
from starloom.plans.objects import placed_clusters


def values(spark, column, inputs, dtype="double"):
    rows = spark.createDataFrame([(i, v) for i, v in enumerate(inputs)], f"i int, v {dtype}")
    return [r[0] for r in rows.orderBy("i").select(column("v")).collect()]


def test_each_rounding_mode(spark):
    halves = [0.5, 1.5, -0.5, -1.5, 2.5, None]
    assert values(spark, rounding.half_even_int, halves) == [0, 2, 0, -2, 2, None]
    text_of = values(spark, lambda c: rounding.fixed_text(c, 1), [0.25, 0.35, -0.04, -0.25, 3.0])
    assert text_of == ["0.3", "0.4", "0.0", "-0.3", "3.0"]
    assert values(spark, lambda c: rounding.half_even(c, 1), [0.25, 0.35, -0.25]) == [0.2, 0.4, -0.2]
    assert values(spark, rounding.toward_zero, [-3.7, 3.7, -0.4]) == [-3, 3, 0]
    assert values(spark, rounding.number_text, [4.0, 4.25, -2.0]) == ["4", "4.3", "-2"]


@pytest.mark.parametrize("digits", [0, 1, 3])
def test_fast_rounding_equals_decimal_rounding(spark, digits):
    rnd = random.Random(7)
    numbers = [rnd.uniform(-10, 10) * 10 ** rnd.randint(-3, 9) for _ in range(300)]
    halves = [(rnd.randint(-5000, 5000) + 0.5) / 10**digits for _ in range(300)]
    numbers += halves + [math.nextafter(h, d) for h in halves for d in (-math.inf, math.inf)]
    numbers += [0.0, -0.0, 1.2 + 0.15, 0.1 + 0.2, 1e15, 12345678901234.25]

    def exact(v):
        v = Decimal(repr(v)).quantize(Decimal(1).scaleb(-15), ROUND_HALF_UP)
        return float(v.quantize(Decimal(1).scaleb(-digits), ROUND_HALF_UP))

    with localcontext(prec=60):
        assert values(spark, lambda c: rounding.half_away(c, digits), numbers) == [
            exact(v) for v in numbers
        ]
    unusable = values(spark, lambda c: rounding.half_away(c, digits), [math.nan, math.inf, None])
    assert unusable == [None, None, None]


def test_distance_has_no_value_for_parallax_zero(spark):
    got = values(spark, astrometry.distance_ly, [1.0, 0.0, None, -1.0])
    assert got[0] == pytest.approx(3261.563777)
    assert got[1] is None and got[2] is None
    assert got[3] < 0


def test_magnitude_of_unusable_distances(spark):
    got = values(spark, lambda c: astrometry.absolute_magnitude(F.lit(5.0), c), [10.0, 0.0, -1.0])
    assert got[0] == pytest.approx(5 + 5 - 5 * math.log10(10 * fixed.LIGHT_YEARS_PER_PARSEC))
    assert got[1:] == [None, None]


def test_merged_photometry(spark):
    df = spark.createDataFrame(
        [
            (3.0, 1.0, 1.0, 1.0, 1.2, 1.1),
            (None, 9.0, None, 8.5, None, 1.1),
            (None, None, None, None, None, None),
        ],
        "grvs_mag double, phot_g_mean_mag double, phot_rp_mean_mag double, phot_bp_mean_mag double,"
        " nu_eff_used_in_astrometry double, pseudocolour double",
    )
    got = df.select(photometry.merged_magnitude(), photometry.merged_colour()).collect()
    assert [tuple(r) for r in got] == [(3.0, 1.2), (8.25, 1.1), (20.0, 1.0)]


def test_display_attributes(spark):
    assert values(spark, photometry.size_class, [-3.7, -0.4, 15.0, -30.0]) == [2.6, 2.0, 0.2, 3.0]
    assert values(spark, photometry.brightness, [-8.0, 100.0]) == [1.0, 0.1]
    white = values(spark, lambda c: photometry.rgb(c, F.lit(-8.0)), [0.0])[0]
    assert tuple(white) == (1.0, 1.0, 1.0)
    # t = 19 and t = 66 are the ends of the middle branches.
    for t, blue in ((19.0, 0.0), (66.0, 1.0)):
        colour = t * 100 / (fixed.WIEN_SCALE * 1000 * fixed.TEMPERATURE_FACTOR)
        got = values(spark, lambda c: photometry.rgb(c, F.lit(-8.0)), [colour])[0]
        assert got["r"] == 1.0 and got["b"] == pytest.approx(blue, abs=1e-3)


RA = {
    "04^h 26.9^m": 66.725,
    "10^h 05^m 31.90^s": 151.382916667,
    "10:05:31.90": 151.382916667,
    "01h02m03s.4": 15.514166667,
    "nonsense": None,
    "": None,
}
DEC = {
    "+15° 52′": 15.866666667,
    "−36° 21′ 42″": -36.361666667,
    "-22°58′43″.73": -22.978813889,
    "-22:58:43.73": -22.978813889,
    "15° 52′": 15.866666667,
    "+00° 04′ 18.0″": 0.071666667,
    "nonsense": None,
}


def test_sexagesimal_text(spark):
    ra = values(spark, angles.ra_degrees, RA, "string")
    assert ra == [v if v is None else pytest.approx(v) for v in RA.values()]
    dec = values(spark, angles.dec_degrees, DEC, "string")
    assert dec == [v if v is None else pytest.approx(v) for v in DEC.values()]


def test_unreadable_text_as_zero(spark):
    def zero(f):
        return lambda c: f(c, "zero")

    assert values(spark, zero(angles.ra_degrees), ["x"], "string") == [0.0]
    assert values(spark, zero(angles.dec_degrees), ["x", "15° 52′"], "string") == [0.0, 0.0]


def test_field_radius(spark):
    inputs = ["1.5 degrees", "30 arcmins", "12.5", "7 parsecs", "wide"]
    assert values(spark, angles.radius_arcmin, inputs, "string") == [90.0, 30.0, 12.5, 0.0, None]


# Listed clusters with their published positions.
CLUSTERS = (
    (47.0, "04^h 26.9^m", "+15° 52′", "Hyades", (58.3, 135.5, 41.9)),
    (86.0, "12^h 22.5^m", "+25° 51′", "Coma Star Cluster", (-251.2, -24.7, 122.3)),
    (136.0, "03^h 47.4^m", "+24° 07′", "Messier 45 Pleiades", (221.4, 339.0, 181.2)),
    (2400.0, "17^h 40.7^m", "-53° 40.5′", "NGC 6397", (-390.0, -4620.5, -6306.6)),
    (6900.0, "11^h 15.3^m", "-61° 15′", "NGC 3603", (-10619.3, 2097.9, -19730.6)),
    (8870.0, "07^h 38.8^m", "−33° 51′", "Arp-Madore 2", (-10039.8, 21828.2, -16114.6)),
    (48500.0, "05^h 38.7^m", "−69° 06′", "NGC 2070", (5237.1, 56187.4, -147777.9)),
    (1400.0, "02^h 27^m 15^s", "+61° 37′ 28″", "FSR 584 (gc)", (1737.4, 1300.3, 4017.6)),
    (2400.0, "17^h 40^m 42.04^s", "−53° 40′ 26.3″", "NGC 6397 (gc)", (-390.0, -4620.6, -6306.5)),
    (3200.0, "18^h 36^m 23.97^s", "−23° 54′ 14.5″", "M22 (gc)", (1509.1, -9421.7, -4229.1)),
    (123300.0, "03^h 55^m 02.30^s", "−49° 36′ 55.0″", "Arp-Madore 1 (gc)", (135134.4, 222778.7, -306322.7)),
)


def test_cluster_positions(spark):
    schema = "dist_pc double, ra_text string, dec_text string, name string"
    df = spark.createDataFrame([c[:4] for c in CLUSTERS], schema)
    placed = placed_clusters(df).select("name", *[rounding.fixed_text(c, 1).alias(c) for c in "xyz"])
    got = {r.name: (float(r.x), float(r.y), float(r.z)) for r in placed.collect()}
    assert got == {c[3]: c[4] for c in CLUSTERS}


@pytest.mark.parametrize("value,inside,at_end", [
    (1.23456, "1.234", "1.2"), (1.9999999, "1.999", "1.9"), (-1.9999999, "-1.999", "-1.9"), (123.456, "123.4", "123.4"),
    (-99.98765, "-99.987", "-99.9"), (100.05, "100.0", "100.0"), (0.5, "0.5", "0.5"), (10.25, "10.25", "10.2"), (7.0, "7", "7"),
    (1.00049, "1.000", "1.0"), (0.00001, "0.000", "0.0"), (12345678.98, "12345678.9", "12345678.9"), (-0.0, "0", "0"), (None, None, None),
])
def test_numbers_are_cut_not_rounded(spark, value, inside, at_end):
    df = spark.createDataFrame([(value,)], "v double")
    assert tuple(df.select(text.cut_number("v"), text.cut_number("v", last=True)).first()) == (inside, at_end)


def test_cut_rows(spark):
    df = spark.createDataFrame([(1.99999, 456.78, 2.55)], "x double, y double, m double")
    assert df.select(text.cut_row(("x", "y", "m"))).first()[0] == "[1.999,456.7,2.5]"


def test_table_lines(spark):
    line = "   NGC 6397[12] 17^h 40^m 42.04^s −53° 40′ 26.3″ Ara 2.4 kpc"
    got = values(spark, lambda c: text.globular_fields(text.without_footnotes(c)), [line, "Name"], "string")
    assert tuple(got[0]) == ("2.4", "17^h 40^m 42.04^s", "−53° 40′ 26.3″", "NGC 6397")
    assert got[1] is None
    line = "   NGC 3603 11^h 15.3^m −61° 15′ Carina 22,500 1 note"
    got = values(spark, text.open_cluster_fields, [line], "string")
    assert tuple(got[0]) == ("22500", "11^h 15.3^m", "−61° 15′", "NGC 3603")


def test_names_of_table_lines_may_hold_any_character(spark):
    for name in ("A|B cl", "|", "$1 (x)", "Tr 14|^h"):
        line = f"   {name} 17^h 40^m 42.04^s −53° 40′ 26.3″ Ara 2.4 kpc"
        got = values(spark, text.globular_fields, [line], "string")
        assert tuple(got[0]) == ("2.4", "17^h 40^m 42.04^s", "−53° 40′ 26.3″", name)
        line = f"   {name} 11^h 15.3^m −61° 15′ Car|ina 22,500 1 note"
        got = values(spark, text.open_cluster_fields, [line], "string")
        assert tuple(got[0]) == ("22500", "11^h 15.3^m", "−61° 15′", name)


def test_kiloparsecs(spark):
    got = values(spark, text.kiloparsec_text_to_parsec, ["1.4", "2.24", "4", "1.234", "x"], "string")
    assert got == [1400.0, 2240.0, 4000.0, 1.234, None]


def test_digest_is_told_by_its_length(spark):
    import hashlib

    for name in ("md5", "sha1", "sha256", "sha512"):
        digest = getattr(hashlib, name)(b"stars").hexdigest()
        df = spark.createDataFrame([(digest, bytearray(b"stars")), ("0" * len(digest), bytearray(b"stars")), ("0", bytearray(b"stars"))], "h string, c binary")
        assert [r[0] for r in df.select(text.digest_matches("h", "c")).collect()] == [True, False, False]


def test_identifiers(spark):
    ids = ["HIP 12", "NAME Sirius ", "NAME Sirius", "Gaia DR3 99", "HIP"]
    assert values(spark, text.identifier_number, ids, "string") == [12, None, None, None, None]
    # The blank at the end belongs to the format.
    assert values(spark, text.identifier_name, ids, "string") == [None, "Sirius", None, None, None]
    assert values(spark, text.identifier_source, ids, "string") == [None, None, None, 99, None]
    assert values(spark, text.catalogue_number, ["12", "-", "", "12 A", None], "string") == [
        12,
        None,
        None,
        None,
        None,
    ]


def test_sql_functions_agree_with_columns(spark):
    assert "sky_rgb" in sql.register(spark)
    df = spark.createDataFrame(
        [(0.1, 12.0, -40.0, 7.0, 1.4, "04^h 26.9^m", "−15° 52′ 10.5″"), (5.0, 200.0, 80.0, 3.0, 0.0, "x", "+1:2:3")],
        "px double, ra double, dec double, mag double, color double, ra_t string, dec_t string",
    ).withColumn("dist", astrometry.distance_ly("px"))
    x, y, z = astrometry.cartesian("ra", "dec", "dist")
    pairs = {
        "sky_distance_ly(px)": F.col("dist"),
        "sky_position(ra, dec, dist)": F.struct(x.alias("x"), y.alias("y"), z.alias("z")),
        "sky_abs_mag(mag, dist)": astrometry.absolute_magnitude("mag", "dist"),
        "sky_ra_degrees(ra_t)": angles.ra_degrees("ra_t"),
        "sky_dec_degrees(dec_t)": angles.dec_degrees("dec_t"),
        "sky_bin(ra, 10D)": F.rint(F.col("ra") / 10).cast("long"),
        "sky_rgb(color, mag)": photometry.rgb("color", "mag"),
    }
    for call, column in pairs.items():
        for got, want in df.select(F.expr(call), column).collect():
            got = tuple(got) if hasattr(got, "__fields__") else (got,)
            want = tuple(want) if hasattr(want, "__fields__") else (want,)
            assert got == pytest.approx(want), call
