"""The polygon index against a plain even-odd test, on outlines of any shape."""

import math
import random

import pytest
from pyspark.sql import functions as F

from txlens.operators import spatial

SHAPES = "name string, rings array<array<struct<lon:double,lat:double>>>"


def plain_inside(rings, x, y):
    odd = False
    for ring in rings:
        for (x1, y1), (x2, y2) in zip(ring, ring[1:] + ring[:1]):
            side = (x2 - x1) * (y - y1) - (x - x1) * (y2 - y1)
            if side == 0 and min(x1, x2) <= x <= max(x1, x2) and min(y1, y2) <= y <= max(y1, y2):
                return True
            if (y1 > y) != (y2 > y) and (side > 0) == (y2 > y1):
                odd = not odd
    return odd


def star(rnd, cx, cy, radius, n):
    """A jagged outline around a point; its corners lie on a fine grid, so many meet cell borders."""
    angles = sorted(rnd.random() * 2 * math.pi for _ in range(n))
    size = [radius * rnd.uniform(0.4, 1) for _ in angles]
    return [(round((cx + r * math.cos(a)) * 8) / 8, round((cy + r * math.sin(a)) * 8) / 8) for a, r in zip(angles, size)]


@pytest.mark.parametrize("size", [0.5, 0.25, 3.0])
def test_random_outlines(spark, size):
    rnd = random.Random(int(size * 100))
    shapes = [(f"s{i}", [star(rnd, rnd.uniform(-3, 3), rnd.uniform(-3, 3), rnd.uniform(0.3, 4), rnd.randrange(3, 40)) for _ in range(rnd.randrange(1, 4))]) for i in range(12)]
    shapes += [("s0", shapes[0][1]), ("bow", [[(0.0, 0.0), (2.0, 2.0), (2.0, 0.0), (0.0, 2.0)]]), ("line", [[(0.0, 0.0), (3.0, 0.0)]]), ("none", [])]
    points = [(rnd.uniform(-5, 5), rnd.uniform(-5, 5)) for _ in range(300)]
    points += [(round(x * 8) / 8, round(y * 8) / 8) for x, y in points[:200]]  # borders of cells
    points += [p for _, rings in shapes for ring in rings for p in ring]  # corners
    df = spark.createDataFrame([(i, y, x) for i, (x, y) in enumerate(points)], "id long, latitude double, longitude double")
    index = spatial.shape_index(spark.createDataFrame(shapes, SHAPES), size)
    got = sorted((r.id, r["name"]) for r in spatial.spatial_join(df, index, size=size).filter("name IS NOT NULL").collect())
    assert got == sorted((i, n) for i, (x, y) in enumerate(points) for n, rings in shapes if plain_inside(rings, x, y))


def test_long_outline_is_spread_over_cells(spark):
    """A circle of 6000 edges: every edge lies in the few cells it touches, and no row has more than a fraction."""
    ring = [(70 + 5 * math.cos(i * math.pi / 3000), 20 + 5 * math.sin(i * math.pi / 3000)) for i in range(6000)]
    shapes = spark.createDataFrame([("circle", [ring])], SHAPES)
    cells = spatial.boundary_cells(shapes).select(F.size("edges").alias("n"), "whole").collect()
    assert max(c.n for c in cells) < 400 and sum(c.n for c in cells) < 6200
    assert sum(c.whole for c in cells) > 200
    points = spark.range(2000).select(
        "id", (15 + F.rand(1) * 10).alias("latitude"), (65 + F.rand(2) * 10).alias("longitude")
    ).checkpoint()
    found = spatial.spatial_join(points, spatial.shape_index(shapes)).collect()
    assert len(found) == 2000
    assert all((r["name"] is not None) == plain_inside([ring], r.longitude, r.latitude) for r in found)
