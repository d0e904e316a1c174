"""Merged colour and magnitude, and what a viewer draws from them."""

from pyspark.sql import functions as F

from starloom import fixed
from starloom.functions.rounding import col, toward_zero


def merged_colour(first="nu_eff_used_in_astrometry", second="pseudocolour"):
    return F.coalesce(col(first), col(second), F.lit(fixed.FILL_COLOUR))


def merged_magnitude(
    best="grvs_mag", g="phot_g_mean_mag", rp="phot_rp_mean_mag", bp="phot_bp_mean_mag"
):
    """The spectrometer magnitude, else the brightest band less an offset, else a fill."""
    brightest = F.least(col(g), col(rp), col(bp))
    return F.coalesce(
        col(best), brightest - F.lit(fixed.PHOTOMETRY_OFFSET), F.lit(fixed.FILL_MAGNITUDE)
    )


def clamp(c, low, high):
    return F.least(F.greatest(c, F.lit(low)), F.lit(high))


def brightness(abs_mag="abs_mag"):
    """Dimming factor between the floor and 1."""
    shifted = col(abs_mag) + F.lit(fixed.DIM_CENTRE)
    span = F.lit(fixed.DIM_SPAN)
    return clamp((span - shifted * shifted) / span, fixed.DIM_FLOOR, 1.0)


def temperature(colour="color"):
    """Effective temperature in kelvin."""
    return (
        F.lit(fixed.WIEN_SCALE)
        * col(colour)
        * F.lit(1000.0)
        * F.lit(fixed.TEMPERATURE_FACTOR)
    )


def size_class(abs_mag="abs_mag"):
    """Drawn size: brighter stars are larger, in steps of one magnitude."""
    steps = F.lit(20) - (toward_zero(abs_mag) + F.lit(10))
    return clamp(steps / F.lit(5.0), fixed.SIZE_FLOOR, fixed.SIZE_CEILING)


def _channel(value):
    # log of a non-positive number is NULL here; such a channel is dark.
    return F.coalesce(clamp(value, 0.0, 255.0), F.lit(0.0))


def rgb(colour="color", abs_mag="abs_mag"):
    """Black-body colour, dimmed, as a struct of r, g, b in 0..1; colour 0 is plain white."""
    colour = col(colour)
    t = temperature(colour) / F.lit(100.0)
    warm = t - F.lit(60.0)
    full = F.lit(255.0)
    red = F.when(t <= 66, full).otherwise(
        _channel(F.lit(fixed.RED_SCALE) * F.pow(warm, F.lit(fixed.RED_POWER)))
    )
    green = F.when(
        t <= 66, _channel(F.lit(fixed.GREEN_SCALE) * F.log(t) - F.lit(fixed.GREEN_SHIFT))
    ).otherwise(
        _channel(F.lit(fixed.GREEN_HOT_SCALE) * F.pow(warm, F.lit(fixed.GREEN_HOT_POWER)))
    )
    blue = (
        F.when(t >= 66, full)
        .when(t <= 19, F.lit(0.0))
        .otherwise(
            _channel(
                F.lit(fixed.BLUE_SCALE) * F.log(t - F.lit(10.0)) - F.lit(fixed.BLUE_SHIFT)
            )
        )
    )
    dim = brightness(abs_mag) / full
    return F.struct(
        *[
            F.when(colour == 0, F.lit(1.0)).otherwise(part * dim).alias(name)
            for name, part in (("r", red), ("g", green), ("b", blue))
        ]
    )


def blend(value, low=fixed.BLEND_LOW, high=fixed.BLEND_HIGH):
    """Colour between two endpoint colours at a value in 0..1."""
    value = col(value)
    return F.struct(
        *[
            (F.lit(a) + value * F.lit(b - a)).alias(name)
            for name, a, b in zip("rgb", low, high)
        ]
    )
