"""Point in polygon as an equi-join on grid cells, built from single edges.

Every edge is laid into the cells it touches, and no others: work and rows grow with the length of the
outlines, not with edges times cells. Along the middle line of each grid row the crossings of a
shape are counted from west to east; where the count is odd the row's cells have their anchor point inside.
A cell without edges whose anchor is inside is whole and needs no test. A cell with edges carries these edges and
whether its anchor is inside; a point of that cell is inside if the way from the point to the anchor, along the
point's latitude and then along the anchor's longitude, crosses an even number of them (odd, if the
anchor is outside).

Points meet polygons on their cell number, so no point is ever paired with a polygon that is not nearby.
Points on an edge or corner count as inside, in every polygon that shares it.

Anchors lie off the round fractions of a cell, so that corners of outlines do not fall on their lines.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from txlens.sources.tables import stage

CELL_DEGREES = 0.5
MAX_BROADCAST_EDGES = 2_000_000  # four doubles each
_PAD = 1e-9


def _edges(rings: Column) -> Column:
    """All edges of all rings; an open ring is closed."""

    def of_ring(ring: Column) -> Column:
        def edge(p: Column, i: Column) -> Column:
            q = F.element_at(ring, F.pmod(i + 1, F.size(ring)) + 1)
            return F.struct(
                p["lon"].alias("x1"), p["lat"].alias("y1"),
                q["lon"].alias("x2"), q["lat"].alias("y2"),
            )

        return F.transform(ring, edge)

    return F.flatten(F.transform(rings, of_ring))


def _side(e: Column, x: Column, y: Column) -> Column:
    """Sign tells on which side of the edge the point lies; 0 is on its line."""
    return (e["x2"] - e["x1"]) * (y - e["y1"]) - (x - e["x1"]) * (e["y2"] - e["y1"])


def _on_edge(e: Column, x: Column, y: Column) -> Column:
    return (
        (_side(e, x, y) == 0)
        & x.between(F.least(e["x1"], e["x2"]), F.greatest(e["x1"], e["x2"]))
        & y.between(F.least(e["y1"], e["y2"]), F.greatest(e["y1"], e["y2"]))
    )


def _crosses(e: Column, x: Column, y: Column) -> Column:
    """The eastward ray from the point crosses the edge (no division needed)."""
    spans = (e["y1"] > y) != (e["y2"] > y)
    upward = e["y2"] > e["y1"]
    return spans & ((_side(e, x, y) > 0) == upward)


# An anchor's place in its cell, in both directions.
_ANCHOR_X, _ANCHOR_Y = 0.6180339887498949, 0.4142135623730951


def _anchor(cell: Column, size: float, share: float) -> Column:
    return (cell.cast("double") + share) * size


def contains(edges: Column, anchor_inside: Column, x: Column, y: Column, ax: Column, ay: Column) -> Column:
    """Whether (x, y) is inside, from the edges of its cell and the cell's anchor (ax, ay).

    The way is taken a shade north of the point's latitude, as the half-open test of ``spans`` implies.
    """

    def left(e: Column, px: Column, py: Column) -> Column:
        side = _side(e, px, py)
        return (side > 0) | ((side == 0) & (e["x2"] > e["x1"]))

    def crossings(e: Column) -> Column:
        turn = left(e, ax, y)  # the corner of the way from the point to the anchor
        across = ((e["y1"] > y) != (e["y2"] > y)) & (left(e, x, y) != turn)
        along = ((e["x1"] > ax) != (e["x2"] > ax)) & (turn != left(e, ax, ay))
        return across.cast("int") + along.cast("int")

    count = F.aggregate(edges, F.lit(0), lambda n, e: n + crossings(e))
    return F.exists(edges, lambda e: _on_edge(e, x, y)) | ((count % 2 == 1) != anchor_inside)


def shape_edges(shapes: DataFrame) -> DataFrame:
    """One row per edge: shape (number of its outline), the shape's names, edge."""
    names = [c for c in shapes.columns if c != "rings"]
    numbered = shapes.select(F.monotonically_increasing_id().alias("shape"), F.struct(*names).alias("names"), "rings")
    return numbered.select("shape", "names", F.explode(_edges(F.col("rings"))).alias("edge"))


def _cells_between(low: Column, high: Column, size: float) -> Column:
    return F.sequence(F.floor((low - _PAD) / size), F.floor((high + _PAD) / size))


def touched_cells(edges: DataFrame, size: float) -> DataFrame:
    """(shape, cell_x, cell_y, edge) for every cell that an edge reaches, borders included."""
    x1, y1, x2, y2 = (F.col(f"edge.{c}") for c in ("x1", "y1", "x2", "y2"))
    low_y, high_y = F.least(y1, y2), F.greatest(y1, y2)
    rows = edges.withColumn("cell_y", F.explode(_cells_between(low_y, high_y, size)))

    def at(border: Column) -> Column:
        """Longitude of the edge where it enters or leaves the grid row."""
        y = F.least(F.greatest(border, low_y), high_y)
        return x1 + (y - y1) * (x2 - x1) / F.when(y2 != y1, y2 - y1)

    below, above = F.col("cell_y") * size - _PAD, (F.col("cell_y") + 1) * size + _PAD
    west = F.when(y1 == y2, F.least(x1, x2)).otherwise(F.least(at(below), at(above)))
    east = F.when(y1 == y2, F.greatest(x1, x2)).otherwise(F.greatest(at(below), at(above)))
    return rows.withColumn("cell_x", F.explode(_cells_between(west, east, size)))


def anchored_cells(edges: DataFrame, size: float) -> DataFrame:
    """(shape, cell_x, cell_y) of all cells with their anchor inside the shape."""
    e = F.col("edge")
    first = F.ceil(F.least(e["y1"], e["y2"]) / size - _ANCHOR_Y) - 1
    last = F.floor(F.greatest(e["y1"], e["y2"]) / size - _ANCHOR_Y) + 1
    line = _anchor(F.col("cell_y"), size, _ANCHOR_Y)
    spans = (e["y1"] > line) != (e["y2"] > line)
    crossed = edges.withColumn("cell_y", F.explode(F.sequence(first, last))).filter(spans)
    where = e["x1"] + (line - e["y1"]) * (e["x2"] - e["x1"]) / (e["y2"] - e["y1"])
    guess = F.ceil(where / size - _ANCHOR_X)

    def is_east(cell: Column) -> Column:
        """The anchor of that cell lies west of the crossing; by the sign that ``contains`` uses."""
        return _crosses(e, _anchor(cell, size, _ANCHOR_X), line)

    # The first cell whose anchor the crossing does not lie east of; division may miss it by one.
    start = F.when(~is_east(guess - 1), guess - 1).when(is_east(guess), guess + 1).otherwise(guess)
    turns = crossed.withColumn("start", start).groupBy("shape", "cell_y", "start").agg(F.count(F.lit(1)).alias("n"))
    row = Window.partitionBy("shape", "cell_y").orderBy("start")
    runs = turns.withColumns({"_odd": F.sum("n").over(row) % 2 == 1, "_next": F.lead("start").over(row)})
    inside = runs.filter("_odd AND _next IS NOT NULL")
    return inside.select("shape", F.explode(F.sequence(F.col("start"), F.col("_next") - 1)).alias("cell_x"), "cell_y")


def boundary_cells(shapes: DataFrame, size: float = CELL_DEGREES) -> DataFrame:
    """One row per (shape, cell it reaches): cell number, whole-cell flag, anchor flag, edges to test.

    The edges are stored first: the number that tells shapes apart must not change.
    """
    names = [c for c in shapes.columns if c != "rings"]
    edges, _ = stage(shape_edges(shapes), "edges")
    cell = ["shape", "cell_x", "cell_y"]
    parts = touched_cells(edges, size).select(*cell, "edge", F.lit(False).alias("inside")).unionByName(
        anchored_cells(edges, size).select(*cell, F.lit(None).cast(edges.schema["edge"].dataType).alias("edge"), F.lit(True).alias("inside"))
    )
    cells = parts.groupBy(*cell).agg(F.collect_list("edge").alias("edges"), F.max("inside").alias("inside"))
    named = edges.groupBy("shape").agg(F.first("names").alias("names"))
    return cells.join(named, "shape").select(
        *[F.col("names")[c].alias(c) for c in names],
        "cell_x",
        "cell_y",
        (F.size("edges") == 0).alias("whole"),
        "inside",
        "edges",
    )


def shape_index(shapes: DataFrame, size: float = CELL_DEGREES) -> DataFrame:
    """Cell table of a boundary layer, ready to join with any number of point tables.

    It is broadcast only when its counted edges are few; otherwise the join shuffles on the
    cell number and a crowded cell is split at run time.
    """
    cells = boundary_cells(shapes, size).withColumnsRenamed(
        {"cell_x": "_cx", "cell_y": "_cy", "whole": "_whole", "inside": "_inside", "edges": "_edges"}
    )
    cells, seen = stage(cells, "cells", weight=F.sum(1 + F.size("_edges")))
    return F.broadcast(cells) if (seen.get("weight") or 0) <= MAX_BROADCAST_EDGES else cells


def spatial_join(
    points: DataFrame,
    index: DataFrame,
    *,
    lat: str = "latitude",
    lon: str = "longitude",
    size: float = CELL_DEGREES,
) -> DataFrame:
    """Left join of points to the polygons that contain them; ``size`` is the index's."""
    x, y = F.col(lon), F.col(lat)
    located = points.withColumns({"_px": F.floor(x / size), "_py": F.floor(y / size)})
    anchor = (_anchor(F.col("_cx"), size, _ANCHOR_X), _anchor(F.col("_cy"), size, _ANCHOR_Y))
    match = (
        (F.col("_px") == F.col("_cx"))
        & (F.col("_py") == F.col("_cy"))
        & (F.col("_whole") | contains(F.col("_edges"), F.col("_inside"), x, y, *anchor))
    )
    return located.join(index, match, "left").drop(
        "_px", "_py", "_cx", "_cy", "_whole", "_inside", "_edges"
    )
