"""Name lists, identifier lists and the cascade of catalogues that places a name."""

from functools import reduce

from pyspark.sql import functions as F

from starloom.functions.astrometry import absolute_magnitude, distance_ly, with_position
from starloom.functions.rounding import half_even
from starloom.functions.text import (
    catalogue_number,
    identifier_name,
    identifier_number,
    identifier_source,
)
from starloom.operators.filters import identifier_kind, listed_under
from starloom.operators.loads import one_per_key
from starloom.operators.sets import published
from starloom.operators.sizing import fits, small
from starloom.session import staged

SEPARATOR = " / "


def joined_text(df, keys, order, value, name, separator=SEPARATOR):
    """Texts of each key joined in order, as (keys, name): one row per key.

    The joined text is one value, and so is as large as the key's texts together.
    """
    listed = F.array_sort(F.collect_list(F.struct(*order, value)))
    return df.groupBy(*keys).agg(F.array_join(F.transform(listed, lambda s: s[value]), separator).alias(name))


def numbered(names):
    """Entries of a name list (hip, name, pos) whose number is written in digits only."""
    return names.withColumn("hip", catalogue_number("hip")).filter(F.col("hip").isNotNull())


def list_names(first, second):
    """Name per number: the last entry of the first list, then all of the second in order."""
    last = numbered(first).groupBy("hip").agg(F.max_by("name", "pos").alias("name"))
    both = last.select("hip", F.lit(1).alias("list"), F.lit(0).cast("long").alias("pos"), "name")
    both = both.unionByName(numbered(second).select("hip", F.lit(2).alias("list"), "pos", "name"))
    return joined_text(both, ["hip"], ["list", "pos"], "name", "name")


def parsed_identifiers(identifiers):
    """Number, name and source parsed from identifier rows (oid, id, pos)."""
    return identifiers.select(
        "oid",
        "pos",
        identifier_number("id").alias("hip"),
        identifier_name("id").alias("name"),
        identifier_source("id").alias("source_id"),
    )


def objects(identifiers):
    """One row per object: its last number and last source, and where it ends in the list."""

    def last(c):
        return F.max_by(c, F.when(F.col(c).isNotNull(), F.col("pos")))

    return parsed_identifiers(identifiers).groupBy("oid").agg(
        last("hip").alias("hip"), last("source_id").alias("source_id"), F.max("pos").alias("ends")
    )


def object_names(identifiers):
    """The names of each object in order, as (oid, name)."""
    named = parsed_identifiers(identifiers).filter(F.col("name").isNotNull())
    return joined_text(named, ["oid"], ["pos"], "name", "name")


def objects_by_number(found):
    """The last object of every number."""
    return found.filter(F.col("hip").isNotNull()).groupBy("hip").agg(
        F.max_by("oid", "ends").alias("oid"), F.max_by("source_id", "ends").alias("source_id")
    )


def objects_by_source(found):
    """The last object of every source among those without a number."""
    kept = found.filter(F.col("hip").isNull() & F.col("source_id").isNotNull())
    return kept.groupBy("source_id").agg(F.max_by("oid", "ends").alias("oid"))


def label_keys(list_labels, object_labels, keep_duplicates=False):
    """Both lists of (hip, name); by default a number in the first hides the second."""
    second = object_labels.select("hip", "name")
    if not keep_duplicates:
        second = second.join(list_labels.select("hip").distinct(), "hip", "left_anti")
    return list_labels.select("hip", "name", F.lit("list").alias("origin")).unionByName(
        second.withColumn("origin", F.lit("identifier"))
    )


def first_neighbour(neighbours):
    """The first source of every number in the neighbour table (hip, source_id, pos)."""
    return neighbours.groupBy("hip").agg(F.min_by("source_id", "pos").alias("source_id"))


def with_sources(numbers, neighbours, by_number):
    """Source of every number: from the neighbour table, else from the identifiers."""
    a = first_neighbour(neighbours).withColumnRenamed("source_id", "_near")
    b = by_number.select("hip", F.nullif("source_id", F.lit(0)).alias("_listed"))
    return (
        numbers.join(a, "hip", "left")
        .join(b, "hip", "left")
        .select(
            *numbers.columns,
            F.coalesce("_near", "_listed").alias("source_id"),
            F.when(F.col("_near").isNotNull(), "neighbour")
            .when(F.col("_listed").isNotNull(), "identifier")
            .alias("via"),
        )
    )


def star_positions(stars, keys):
    """Published position of the stars whose source is in `keys` (one scan, no shuffle of stars)."""
    wanted = small(keys.select("source_id").filter(F.col("source_id").isNotNull()).distinct())
    found = published(stars.join(wanted, "source_id", "left_semi"), "source_id")
    return found.select("source_id", "x", "y", "z")


def catalogue_positions(catalogue, fill_magnitude):
    """Positions and magnitudes of a catalogue (hip, ra, dec, plx, mag, colour, pos)."""
    first = one_per_key(catalogue, ["hip"], ["pos"])
    placed = with_position(first.withColumn("dist", distance_ly("plx")))
    magnitude = absolute_magnitude("mag", "dist")
    if fill_magnitude:
        # Without a positive parallax there is no logarithm.
        magnitude = F.coalesce(magnitude, F.lit(0.0))
    return placed.select("hip", "x", "y", "z", F.col("colour").alias("color"), magnitude.alias("mag"))


def resolve(numbers, neighbours, by_number, stars, newer, older):
    """Place every number: star table, else the newer catalogue, else the older.

    Adds `resolved_by` (dr3, dr3_ident, cat2007, cat1997 or none) and the
    position. The catalogues are joined to each other; the star table is scanned
    once against the keys that are looked up.
    """
    keyed = staged(with_sources(numbers, neighbours, by_number), "keyed")
    places = star_positions(stars, keyed)
    tiers = [
        places.select("source_id", F.struct("x", "y", "z").alias("_star")),
        *[
            catalogue_positions(c, fill).select(
                "hip", F.struct("x", "y", "z", "color", "mag").alias(n)
            )
            for c, fill, n in ((newer, True, "_newer"), (older, False, "_older"))
        ],
    ]
    joined = reduce(
        lambda left, right: left.join(right, right.columns[0], "left"), tiers, keyed
    )
    star, cat = F.col("_star"), F.coalesce("_newer", "_older")
    return joined.select(
        *numbers.columns,
        "source_id",
        F.when(star.isNotNull() & (F.col("via") == "neighbour"), "dr3")
        .when(star.isNotNull(), "dr3_ident")
        .when(F.col("_newer").isNotNull(), "cat2007")
        .when(F.col("_older").isNotNull(), "cat1997")
        .otherwise("none")
        .alias("resolved_by"),
        *[
            half_even(F.coalesce(star[a], cat[a]), 1).alias(a)
            for a in ("x", "y", "z")
        ],
        F.when(star.isNull(), half_even(cat["color"], 1)).alias("color"),
        F.when(star.isNull(), half_even(cat["mag"], 1)).alias("mag"),
    )


def unknown_sources(keyed, stars):
    """Keys whose source is not in the star table."""
    wanted = keyed.filter(F.col("source_id").isNotNull())
    if fits(wanted.select("source_id")):
        found = star_positions(stars, wanted).select("source_id")
        return wanted.join(found, "source_id", "left_anti")
    return wanted.join(stars.select("source_id"), "source_id", "left_anti")


def named_stars(stars, labels):
    """Published stars of a label list (source_id, name), in one pass over the stars."""
    found = stars.join(small(labels), "source_id")
    return published(found, "source_id", "name")


def cross_references(ident, ids):
    """Identifier rows of objects that have a name and also a number or a source."""
    named = listed_under("ids", "NAME")
    placed = listed_under("ids", "Gaia DR3") | listed_under("ids", "HIP ")
    return (
        ident.filter(identifier_kind("id"))
        .join(ids.filter(named & placed).select("oidref"), "oidref")
        .select("oidref", "id")
    )
