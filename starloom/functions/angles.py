"""Sexagesimal text and field radii to numbers, without leaving the JVM.

`on_error="null"` gives NULL for text that cannot be read (the caller can keep
those rows apart); `on_error="zero"` gives 0 and rejects unsigned declinations.
"""

from pyspark.sql import functions as F

from starloom.functions.rounding import col

MINUS_SIGNS = ("-", "−")
DIGITS = r"^[0-9]+$"
DECIMAL = r"^[0-9.]+$"


def _cut(text, *marks):
    """The text between its unit marks; a colon is one as well."""
    for mark in marks:
        text = F.replace(text, F.lit(mark), F.lit(":"))
    return F.split(text, ":", -1)


def _sixtieths(fields, last):
    """Minutes, which a mark must follow, and seconds, with the mark `last` anywhere in them."""
    minutes = F.ltrim(F.get(fields, F.lit(1)))
    complete = (F.size(fields) > 2) & minutes.rlike(DECIMAL)
    seconds = F.regexp_extract(F.ltrim(F.get(fields, F.lit(2))), f"^[0-9.{last}]*", 0)
    return F.when(complete, minutes).try_cast("double"), _seconds(seconds, last)


def _seconds(text, mark):
    # The unit mark may stand before the decimal point, as in 03s.4 or 43″.73.
    # No seconds are 0; seconds that can't be read make the whole text unreadable.
    return F.when(text == "", 0.0).otherwise(F.replace(text, F.lit(mark), F.lit("")).try_cast("double"))


def _settle(value, on_error):
    return F.coalesce(value, F.lit(0.0)) if on_error == "zero" else value


def ra_degrees(text, on_error="null"):
    """Right ascension in degrees from h m [s] text."""
    text = col(text)
    fields = _cut(text, "^h", "^m", "h", "m")
    first = fields[0]
    hours = F.when(first.rlike(DIGITS), first).try_cast("double")
    minutes, seconds = _sixtieths(fields, "s")
    value = hours * 15.0 + minutes * 15.0 / 60.0 + seconds * 15.0 / 3600.0
    return _settle(value, on_error)


def dec_degrees(text, on_error="null"):
    """Declination in degrees from signed d m [s] text."""
    text = col(text)
    fields = _cut(text, "°", "′", "'")
    digits = F.regexp_extract(fields[0], "[0-9]+$", 0)
    lead = F.left(fields[0], F.length(fields[0]) - F.length(digits))
    degrees = F.when(~lead.rlike("[0-9]"), digits).try_cast("double")
    minutes, seconds = _sixtieths(fields, "″")
    size = degrees + minutes / 60.0 + seconds / 3600.0
    value = F.when(F.right(lead, F.lit(1)).isin(*MINUS_SIGNS), -size).otherwise(size)
    if on_error == "zero":
        value = F.when(lead != "", value)
    return _settle(value, on_error)


def radius_arcmin(text, on_error="null"):
    """Field radius in arc minutes; a unit other than degrees or arcmins gives 0."""
    text = col(text)
    digits = F.regexp_extract(text, "^[0-9.]+", 0)
    number = digits.try_cast("double")
    unit = F.ltrim(F.right(text, F.length(text) - F.length(digits)))
    value = F.when(
        number.isNotNull(),
        F.when(unit == "degrees", number * 60.0)
        .when(unit.isin("arcmins", ""), number)
        .otherwise(F.lit(0.0)),
    ).otherwise(text.try_cast("double"))
    return _settle(value, on_error)
