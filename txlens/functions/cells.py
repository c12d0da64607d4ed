"""Location cells: parents of hexagon ids, and a square grid for raw coordinates."""

from __future__ import annotations

import math

from pyspark.sql import Column
from pyspark.sql import functions as F

# Layout of a hexagon cell id: resolution in bits 52-55, then 15 digits of 3 bits.
_RES_SHIFT, _DIGIT_BITS, _MAX_RES = 52, 3, 15


# A square cell stands in for a hexagon where only coordinates are known: its id is MARK and a quadkey of
# FINEST digits, about the area of a hexagon at resolution 8.
MARK, FINEST = "q", 15


def location_cell(lat: Column, lon: Column) -> Column:
    """Cell id of a point; null outside the ranges of latitude and longitude."""
    inside = lat.between(-90, 90) & lon.between(-180, 180)
    return F.when(inside, F.concat(F.lit(MARK), grid_cell(lat, lon, FINEST)))


def square_level(resolution: int) -> int:
    """Quadkey digits whose squares come nearest in area to hexagons of a resolution (steps of 4 against 7)."""
    return round(FINEST - math.log(7, 4) * (8 - resolution))


def cell_parent(cell: Column, resolution: int) -> Column:
    """Ancestor of a cell id at a coarser resolution, of hexagons (hex text) and of ``location_cell``."""
    square = F.substring(cell, 1, len(MARK) + square_level(resolution))
    return F.when(cell.startswith(MARK), square).otherwise(_hexagon_parent(cell, resolution))


def _hexagon_parent(cell: Column, resolution: int) -> Column:
    bits = F.conv(cell, 16, 10).cast("bigint")
    unused = (1 << (_DIGIT_BITS * (_MAX_RES - resolution))) - 1
    cleared = bits.bitwiseAND(F.lit(~(0xF << _RES_SHIFT)))
    parent = cleared.bitwiseOR(F.lit(resolution << _RES_SHIFT)).bitwiseOR(F.lit(unused))
    return F.lower(F.hex(parent))


def grid_cell(lat: Column, lon: Column, level: int) -> Column:
    """Quadkey of a point: ``level`` digits, each halving the box in both directions.

    A cell's parent is its key without the last digit.
    """
    side = float(1 << level)
    top = F.lit((1 << level) - 1)
    x = F.least(F.floor((lon + 180.0) / 360.0 * side), top)
    y = F.least(F.floor((lat + 90.0) / 180.0 * side), top)
    digits = []
    for shift in range(level - 1, -1, -1):
        x_bit = F.shiftright(x, shift).bitwiseAND(F.lit(1))
        y_bit = F.shiftright(y, shift).bitwiseAND(F.lit(1))
        digits.append((x_bit + y_bit * 2).cast("string"))
    return F.concat(*digits)
