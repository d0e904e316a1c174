"""Distances, Cartesian positions and magnitudes from angles and parallax.

Angles in degrees, parallax in milliarcseconds, distances in light years. The
observer sits at the origin, x points to right ascension 0 and z to the pole.
"""

from pyspark.sql import functions as F

from starloom import fixed
from starloom.functions.rounding import col

LY = fixed.LIGHT_YEARS_PER_PARSEC


def distance_ly(parallax):
    """Distance from parallax; NULL where the parallax is 0."""
    return F.try_divide(F.lit(LY), col(parallax) * F.lit(fixed.ARCSEC_PER_MAS))


def signal_to_noise(parallax, error):
    """Parallax over its error; NULL where the error is 0."""
    return F.try_divide(col(parallax), col(error))


def cartesian(ra, dec, dist):
    """The three coordinates of a direction at a distance, as (x, y, z)."""
    ra, dec, dist = F.radians(col(ra)), F.radians(col(dec)), col(dist)
    flat = F.cos(dec)
    return F.cos(ra) * flat * dist, F.sin(ra) * flat * dist, F.sin(dec) * dist


def radius(x="x", y="y", z="z"):
    """Distance of a position from the origin."""
    x, y, z = col(x), col(y), col(z)
    return F.sqrt(x * x + y * y + z * z)


def absolute_magnitude(mag, dist, convention="published"):
    """Absolute magnitude from apparent magnitude and distance in light years.

    "published" multiplies by the light years per parsec, as every published
    threshold assumes; "physical" divides, which gives the textbook value.
    NULL where the distance is not positive.
    """
    dist = col(dist)
    scaled = {"published": dist * F.lit(LY), "physical": dist / F.lit(LY)}[convention]
    return col(mag) + F.lit(5.0) - F.lit(5.0) * F.log10(scaled)


def parsec_to_ly(c):
    return col(c) * F.lit(LY)


def ly_to_parsec(c):
    return col(c) / F.lit(LY)


def extent_ly(dist, radius_arcmin):
    """Side length of an image with the given field radius at a distance."""
    half_angle = F.radians(col(radius_arcmin) / F.lit(60.0))
    return F.sqrt(F.lit(2.0)) * col(dist) * F.tan(half_angle)


def with_position(df, ra="ra", dec="dec", dist="dist"):
    """Adds x, y and z for a distance that is already known."""
    x, y, z = cartesian(ra, dec, dist)
    return df.withColumns({"x": x, "y": y, "z": z})
