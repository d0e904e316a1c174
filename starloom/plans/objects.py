"""Clusters, their neighbourhoods, nebulae and labels."""

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from starloom import fixed, schemas
from starloom.functions.angles import dec_degrees, ra_degrees, radius_arcmin
from starloom.functions.astrometry import extent_ly, ly_to_parsec, parsec_to_ly, with_position
from starloom.functions.text import (
    globular_fields,
    kiloparsec_text_to_parsec,
    without_footnotes,
)
from starloom.operators import catalogues as C
from starloom.operators.ranking import sliced
from starloom.operators.regions import boxes, within_any
from starloom.operators.sets import published
from starloom.session import staged, staging
from starloom.sinks.arrays import write_array, write_slices
from starloom.sinks.tables import replace
from starloom.sources.labels import CATALOGUE, NAMES, NEBULA, NEIGHBOUR, all_rejected, listed_file
from starloom.sources.tables import identifier_list
from starloom.sources.pages import lines_through, numbered_lines, table_lines

LABEL_FIELDS = ("x", "y", "z", "name")
GLOBULAR_SUFFIX = " (gc)"


def combined_clusters(open_clusters, globular):
    """Both cluster lists as one; globular clusters are marked in their name."""
    marked = globular.withColumn("name", F.concat("name", F.lit(GLOBULAR_SUFFIX)))
    return open_clusters.unionByName(marked)


def placed_clusters(clusters, on_error="null"):
    """Clusters (dist_pc, ra_text, dec_text, name) with positions in light years."""
    return with_position(
        clusters.withColumns(
            {
                "ra": ra_degrees("ra_text", on_error),
                "dec": dec_degrees("dec_text", on_error),
                "dist": parsec_to_ly("dist_pc"),
            }
        )
    )


def rejected(placed):
    """Rows whose coordinates could not be read."""
    return placed.filter(F.col("ra").isNull() | F.col("dec").isNull())


def neighbourhood(stars, placed, **options):
    """Published rows of the stars near any of the objects."""
    usable = placed.filter(F.col("x").isNotNull())
    return published(within_any(stars, boxes(usable), **options), "source_id")


def with_place(placed):
    """The rows whose position could be read; `rejected` lists the others."""
    return placed.filter("x IS NOT NULL AND y IS NOT NULL AND z IS NOT NULL")


def neighbourhood_slices(stars, placed):
    return sliced(
        neighbourhood(stars, placed), schemas.SET_ORDER, ["source_id"], fixed.SLICES_PER_SET
    )


def write_rejected(placed, path):
    """Rows without a position, with all their columns."""
    replace(placed.filter("x IS NULL OR y IS NULL OR z IS NULL"), path)


def write_neighbourhood(stars, placed, path):
    """Job: the labels of the clusters that have a position, the set of stars around them, and
    the clusters without one."""
    write_rejected(placed, f"{path}/rejected")
    write_array(with_place(placed), LABEL_FIELDS, ["dist", "name"], "clusters", f"{path}/labels")
    return write_slices(
        neighbourhood(stars, placed),
        schemas.SET_ORDER,
        ["source_id"],
        ("x", "y", "z", "color", "abs_mag"),
        f"{path}/stars",
    )


def located_nebulae(nebulae, on_error="null"):
    """Nebulae (dist in light years, texts, rotation_deg, dirname, name) with position and size."""
    located = nebulae.withColumns(
        {
            "ra": ra_degrees("ra_text", on_error),
            "dec": dec_degrees("dec_text", on_error),
            "dist_pc": ly_to_parsec("dist"),
            "size_ly": extent_ly("dist", radius_arcmin("fieldradius_text", on_error)),
        }
    )
    return with_position(located)


NEBULA_FIELDS = ("x", "y", "z", "name", "size_ly", "rotation_deg", "dirname")


def placed_nebulae(nebulae, on_error="null"):
    """The published columns of the nebulae."""
    return located_nebulae(nebulae, on_error).select(*NEBULA_FIELDS)


def write_nebulae(located, path):
    """Job: the nebulae that have a position."""
    write_array(with_place(located), NEBULA_FIELDS, ["name", "x", "y", "z"], "nebulae", path)


def nebulae_from_file(spark, source, path, columns=None, sep="|"):
    """Job: a list of nebulae to the published set, and what of it could not be used.

    `path/nebulae` and `path/rejected`: rows with unreadable numbers or coordinates.
    """
    rows, unread = listed_file(spark, source, NEBULA, columns, sep=sep)
    located = located_nebulae(rows)
    write_nebulae(located, f"{path}/nebulae")
    texts = [f.name for f in NEBULA]
    nowhere = rejected(located).select(*[F.col(c).cast("string") for c in texts], "pos", F.lit("ra_text,dec_text").alias("unreadable"))
    replace(all_rejected({"nebulae": unread.select(*texts, "pos", "unreadable").unionByName(nowhere)}), f"{path}/rejected")


def parsed_globulars(lines):
    """Clusters from table lines: distances in parsec, so that they sort by number."""
    fields = globular_fields(without_footnotes("line"))
    return (
        lines.select(fields.alias("f"))
        .filter(F.col("f").isNotNull())
        .select(
            kiloparsec_text_to_parsec("f.dist_text").alias("dist_pc"),
            "f.ra_text",
            "f.dec_text",
            "f.name",
        )
    )


def globulars_from_pages(spark, path, marker):
    """Job: page dumps to a cluster list, up to the first line with `marker`."""
    lines = lines_through(numbered_lines(spark, path), marker)
    return parsed_globulars(lines.filter(F.col("line").contains("^h")))


@dataclass
class LabelInputs:
    """The tables that labels are resolved from."""

    first_names: DataFrame
    second_names: DataFrame
    identifiers: DataFrame
    neighbours: DataFrame
    stars: DataFrame
    newer: DataFrame
    older: DataFrame


def resolved_labels(inputs, keep_duplicates=False):
    """Every numbered name with its position and what resolved it."""
    lists = C.list_names(inputs.first_names, inputs.second_names)
    by_number = C.objects_by_number(C.objects(inputs.identifiers))
    names = by_number.join(C.object_names(inputs.identifiers), "oid", "left").select(
        "hip",
        F.coalesce("name", F.lit("")).alias("name"),
    )
    keys = C.label_keys(lists, names, keep_duplicates)
    places = C.resolve(
        keys.select("hip").distinct(),
        inputs.neighbours,
        by_number,
        inputs.stars,
        inputs.newer,
        inputs.older,
    )
    return keys.join(places, "hip")


def unnumbered_labels(inputs):
    """Named objects without a number, placed by their source; others are dropped."""
    found = C.objects_by_source(C.objects(inputs.identifiers))
    places = C.star_positions(inputs.stars, found)
    named = found.join(C.object_names(inputs.identifiers), "oid", "left")
    return named.join(places, "source_id").select(
        "source_id",
        "x",
        "y",
        "z",
        F.coalesce("name", F.lit("")).alias("name"),
    )


def label_outputs(inputs, keep_duplicates=False):
    """The four published tables, by name.

    The cascade is run once and staged; the star table is scanned once for the numbered
    names and once for the others.
    """
    labels = staged(resolved_labels(inputs, keep_duplicates), "labels")
    others = staged(unnumbered_labels(inputs), "unnumbered")
    from_stars = F.col("resolved_by").isin("dr3", "dr3_ident")
    from_catalogues = F.col("resolved_by").isin("cat2007", "cat1997")
    place = ("x", "y", "z")
    return {
        "star_labels": labels.filter(from_stars).select(*place, "name"),
        "catalogue_labels": labels.filter(from_catalogues).select(*place, "name"),
        "catalogue_stars": labels.filter(from_catalogues).select(*place, "color", "mag"),
        "source_labels": others.select(*place, "name"),
    }


def write_labels(inputs, path, keep_duplicates=False):
    """Job: the four label files."""
    with staging(inputs.stars.sparkSession):
        for name, df in label_outputs(inputs, keep_duplicates).items():
            write_array(df, df.columns, df.columns, name, f"{path}/{name}")


@dataclass
class LabelFiles:
    """Where the label inputs are: a path each, or (path, columns) or (path, columns, header)."""

    first_names: object
    second_names: object
    identifiers: str
    neighbours: object
    newer: object
    older: object


def read_labels(spark, files, stars):
    """(inputs, rejected) of the label job, from files and a star table."""
    schemas_of = {"first_names": NAMES, "second_names": NAMES, "neighbours": NEIGHBOUR, "newer": CATALOGUE, "older": CATALOGUE}
    rows, unread = {}, {}
    for name, schema in schemas_of.items():
        given = getattr(files, name)
        path, columns, header = (*((given,) if isinstance(given, str) else given), None, None)[:3]
        rows[name], unread[name] = listed_file(spark, path, schema, columns, header)
    inputs = LabelInputs(identifiers=identifier_list(spark, files.identifiers), stars=stars, **rows)
    return inputs, all_rejected(unread)


def labels_from_files(spark, files, stars, path, keep_duplicates=False):
    """Job: name lists, identifiers and catalogues to the four label files and `path/rejected`."""
    with staging(spark):
        inputs, unread = read_labels(spark, files, stars)
        replace(unread, f"{path}/rejected")
        write_labels(inputs, path, keep_duplicates)


def list_from_page(spark, path):
    """Clusters of a dump whose lines are all wanted."""
    return parsed_globulars(table_lines(spark, path))
