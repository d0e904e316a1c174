"""Neighbourhood boxes around a list of objects and the stars inside them."""

from functools import reduce
from operator import and_, or_

from pyspark.sql import functions as F

from starloom import fixed
from starloom.operators.sizing import ROWS, fits, small
from starloom.session import staged

AXES = ("x", "y", "z")
FEW_BOXES = 32
FINEST_CELL = 64.0
MOST_ENVELOPES = 12  # a longer condition costs more to plan and test than it skips


def bounds(c, relative=fixed.BOX_RELATIVE, margin=fixed.BOX_MARGIN):
    """Lower and upper bound of a box along one axis; (0, 0) for a coordinate of 0."""
    v = F.col(c)
    wide, narrow = v * F.lit(1.0 + relative), v * F.lit(1.0 - relative)
    low = F.when(v < 0, wide - margin).when(v > 0, narrow - margin).otherwise(F.lit(0.0))
    high = F.when(v < 0, narrow + margin).when(v > 0, wide + margin).otherwise(F.lit(0.0))
    return low, high


def boxes(objects, relative=fixed.BOX_RELATIVE, margin=fixed.BOX_MARGIN, whole=True):
    """Adds lo_x, hi_x, ... to objects with positions; `whole` rounds them to integers."""
    out = {}
    for a in AXES:
        for side, v in zip(("lo", "hi"), bounds(a, relative, margin)):
            out[f"{side}_{a}"] = F.rint(v) if whole else v
    return objects.withColumns(out)


def _inside(position, box):
    """Strictly inside on all axes; `position` and `box` give the columns by name."""
    return reduce(
        and_, [(position(a) > box(f"lo_{a}")) & (position(a) < box(f"hi_{a}")) for a in AXES]
    )


def _of(alias):
    return lambda name: F.col(f"{alias}.{name}")


def within_any(stars, box_list, few=FEW_BOXES, many=ROWS):
    """Stars strictly inside at least one box, each as often as it is in the table.

    The outer bounds of the boxes reach the scan as plain comparisons; a table laid out by
    `space_order` then skips what lies elsewhere. Of what is left, every star is tested
    against a handful of boxes directly. A longer list is laid out on a grid of cells, so
    that a star only meets the boxes of its own cells: as a broadcast lookup while the
    cells are at most `many`, so that the stars are scanned but never shuffled, and beyond
    that as a shuffled join.
    """
    edges = box_list.select(*[f"{s}_{a}" for a in AXES for s in ("lo", "hi")])
    bounds_of_all = envelopes(edges)
    if not bounds_of_all:
        return stars.limit(0)
    near = stars.filter(within_envelopes(bounds_of_all))
    if fits(edges, rows=few):
        return (
            near.alias("s")
            .join(F.broadcast(edges).alias("b"), _inside(_of("s"), _of("b")), "left_semi")
            .select("s.*")
        )
    cells = staged(box_cells(edges), "cells")
    # Levels are powers of two of a length, so there are a few dozen at most.
    levels = sorted(r["level"] for r in cells.select("level").distinct().collect())
    if fits(cells, rows=many):
        return _by_lookup(near, cells, levels)
    return _by_shuffle(near, cells, levels)


def envelopes(edges, most=MOST_ENVELOPES):
    """Outer bounds of the boxes, one set per level of size and octant of their centres.

    There are a few dozen levels and eight octants; beyond `most` sets there is one per
    level, so that large boxes don't widen what the others cover, and beyond that one.
    """
    octant = [(F.col(f"lo_{a}") + F.col(f"hi_{a}") >= 0).alias(f"o{a}") for a in AXES]
    outer = [F.min(f"lo_{a}").alias(f"lo_{a}") for a in AXES] + [F.max(f"hi_{a}").alias(f"hi_{a}") for a in AXES]
    placed = _with_level(edges)
    for by in (["level", *octant], ["level"]):
        found = placed.groupBy(*by).agg(*outer).limit(most + 1).collect()
        if len(found) <= most:
            return found
    return placed.agg(*outer).collect()


def within_envelopes(bounds_of_all):
    """A predicate of comparisons with constants, which a scan can take."""
    each = [
        reduce(and_, [(F.col(a) > r[f"lo_{a}"]) & (F.col(a) < r[f"hi_{a}"]) for a in AXES])
        for r in bounds_of_all
    ]
    return reduce(or_, each)


def space_order(axes=AXES, cell=FINEST_CELL):
    """A number along a space-filling curve: stars close to each other mostly have close numbers.

    The bits of the three cell numbers, 21 each, take turns; cells beyond that count as the
    outermost ones.
    """
    half = 1 << 20
    code = F.lit(0).cast("long")
    for k, a in enumerate(axes):
        place = F.floor(F.col(a) / F.lit(cell)).cast("long")
        v = F.coalesce(F.greatest(F.lit(0), F.least(F.lit(2 * half - 1), place + half)), F.lit(0)).cast("long")
        # Each step moves half of the bits apart, until two places are free after each.
        for shift in (32, 16, 8, 4, 2):
            v = v.bitwiseOR(F.shiftleft(v, shift)).bitwiseAND(F.lit(_spread_mask(shift)))
        code = code.bitwiseOR(F.shiftleft(v, k))
    return code


def _spread_mask(shift):
    """Of 63 bits, runs of shift / 2 bits (at least one) that are 3 * shift / 2 places apart."""
    run = shift // 2
    return sum(((1 << run) - 1) << at for at in range(0, 63, 3 * run)) & ((1 << 63) - 1)


def _cell(v, level, finest=FINEST_CELL):
    return F.floor(v / (F.lit(finest) * F.pow(F.lit(2.0), level))).cast("long")


def _with_level(edges, finest=FINEST_CELL):
    """The boxes that hold anything, with the level of their size."""
    longest = F.greatest(*[F.col(f"hi_{a}") - F.col(f"lo_{a}") for a in AXES])
    shortest = F.least(*[F.col(f"hi_{a}") - F.col(f"lo_{a}") for a in AXES])
    return edges.filter(shortest > 0).withColumn(
        "level", F.greatest(F.ceil(F.log2(longest / F.lit(finest))), F.lit(0)).cast("int")
    )


def box_cells(edges, finest=FINEST_CELL):
    """One row per box and grid cell it touches.

    A box goes to the level whose cells are at least as long as its longest
    edge, so it touches at most two cells per axis, however large it is.
    """
    out = _with_level(edges, finest)
    level = F.col("level")
    for a in AXES:
        first, last = _cell(F.col(f"lo_{a}"), level), _cell(F.col(f"hi_{a}"), level)
        out = out.withColumn(f"c{a}", F.explode(F.sequence(first, last)))
    return out


def _by_lookup(stars, cells, levels):
    """One existence test per level in use; no star is repeated, moved or counted twice."""
    tests = []
    for level in levels:
        here = F.broadcast(cells.filter(F.col("level") == level).alias("b"))
        same_cell = reduce(
            and_,
            [
                F.col(f"b.c{a}") == _cell(F.col(f"s.{a}").outer(), F.lit(level))
                for a in AXES
            ],
        )
        inside = _inside(lambda n: F.col(f"s.{n}").outer(), _of("b"))
        tests.append(here.where(same_cell & inside).exists())
    return stars.alias("s").where(reduce(or_, tests)).select("s.*")


def _by_shuffle(stars, cells, levels):
    """A star looks up one cell per level in a join by cell, which adaptive execution splits.

    Only positions and places travel to the cells; the stars themselves are written once
    and move at most once, to the places that were found.
    """
    names = ["level", *[f"c{a}" for a in AXES]]
    placed = staged(stars.withColumn("_place", F.monotonically_increasing_id()), "candidates")
    probes = placed.select("_place", *AXES, F.explode(F.array(*[F.lit(v) for v in levels])).alias("level"))
    probes = probes.withColumns({f"c{a}": _cell(F.col(a), F.col("level")) for a in AXES})
    same_cell = reduce(and_, [F.col(f"s.{n}") == F.col(f"b.{n}") for n in names])
    found = probes.alias("s").join(cells.alias("b"), same_cell & _inside(_of("s"), _of("b")), "left_semi")
    places = staged(found.select("_place").distinct(), "places")
    return placed.join(small(places), "_place", "left_semi").drop("_place")


def first_objects(objects, order, points=40):
    """The first `points` objects of a list."""
    return objects.orderBy(*order).limit(points)


def distance_matrix(objects, order, points=40, open_tour=True):
    """Distances between the first `points` objects, as (p, q, distance).

    The diagonal is 0; for an open tour so is the column of the first object.
    The size is the square of `points`, whatever the size of the list: the points are one
    row, their pairs are made one by one.
    """
    first = first_objects(objects, order, points)
    listed = first.agg(
        F.array_sort(F.collect_list(F.struct(*order, *AXES))).alias("points")
    )
    pairs = listed.select("points", F.posexplode("points").alias("p", "a")).select(
        "p", "a", F.posexplode("points").alias("q", "b")
    )
    gap = reduce(
        lambda s, t: s + t,
        [F.pow(F.col(f"a.{v}") - F.col(f"b.{v}"), F.lit(2.0)) for v in AXES],
    )
    distance = F.when(F.col("p") == F.col("q"), F.lit(0.0)).otherwise(F.sqrt(gap))
    if open_tour:
        distance = F.when(F.col("q") == 0, F.lit(0.0)).otherwise(distance)
    return pairs.select("p", "q", distance.alias("distance"))
