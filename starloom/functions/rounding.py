"""One helper per rounding mode, because the jobs need three different ones."""

from pyspark.sql import Column
from pyspark.sql import functions as F

EXACT = "decimal(38,15)"
NEAR_HALF = 1e-3
LARGEST = 1e12


def col(c):
    return c if isinstance(c, Column) else F.col(c)


def half_even_int(c):
    """Nearest integer as a long, halves to the even neighbour."""
    return F.rint(col(c)).cast("long")


def half_even(c, digits):
    """Halves to the even neighbour at `digits` decimals."""
    return F.bround(col(c), digits)


def half_away(c, digits):
    """Halves away from zero at `digits` decimals, on the decimal value, as a double.

    Only a value next to a half needs decimal arithmetic to tell which way it
    goes; all others are rounded in floating point, many times faster.
    """
    c = col(c)
    power = F.lit(float(10**digits))
    size = F.abs(c) * power
    whole = F.floor(size)
    plain = (F.abs(size - whole - F.lit(0.5)) > NEAR_HALF) & (size < LARGEST)
    nearest = F.floor(size + F.lit(0.5)) / power
    exact = F.round(c.try_cast(EXACT), digits).cast("double")
    # Adding 0 turns a negative zero into zero.
    return F.when(plain, F.when(c < 0, -nearest).otherwise(nearest) + F.lit(0.0)).otherwise(exact)


def toward_zero(c):
    """Integer part as a long."""
    return col(c).cast("long")


def fixed_text(c, digits):
    """Text with exactly `digits` decimals; never prints a negative zero."""
    return half_away(c, digits).try_cast(f"decimal(38,{digits})").cast("string")


def number_text(c, digits=1):
    """Whole numbers without decimals, all others with `digits`."""
    c = col(c)
    return F.when(c == F.rint(c), c.try_cast("long").cast("string")).otherwise(
        fixed_text(c, digits)
    )
