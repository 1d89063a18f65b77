"""The quadtree cover against a test of all edges."""

import math
import random

import numpy as np
from pyspark.sql import functions as F

from walkgrid.operators import polygons as pg
from walkgrid.operators.cover import base_cells


def inside(rings, x, y):
    crossed = 0
    for ring in rings:
        for a, b in zip(ring, ring[1:] + ring[:1], strict=True):
            if (a["lat"] > y) != (b["lat"] > y) and x < (b["lng"] - a["lng"]) * (y - a["lat"]) / (b["lat"] - a["lat"]) + a["lng"]:
                crossed += 1
    return crossed % 2 == 1


def shape(rng, on_grid):
    rings = []
    for _ in range(rng.randint(1, 3)):
        k, cx, cy, size = rng.choice([3, 5, 12, 60]), rng.uniform(-3, 3), rng.uniform(-3, 3), rng.uniform(0.2, 4)
        turns = [(2 * math.pi * i / k, size * rng.uniform(0.4, 1)) for i in range(k)]
        points = [(cx + r * math.cos(a), cy + r * math.sin(a)) for a, r in turns]
        rings.append([{"lng": round(x * 4) / 4 if on_grid else x, "lat": round(y * 4) / 4 if on_grid else y} for x, y in points])
    return rings


def test_cells_answer_like_all_edges():
    """On a grid of vertices and points too, where points lie on edges, vertices and cell borders."""
    rng = random.Random(8)
    for t in range(30):
        rings, side, times = shape(rng, t % 2 == 0), 2.0 ** rng.randint(-1, 2), rng.randint(0, 4)
        cells = [c for b in base_cells(rings, side) for c in b.split(times)]
        for _ in range(150):
            x, y = (rng.uniform(-7, 7), rng.uniform(-7, 7)) if t % 2 else (rng.randint(-28, 28) / 4, rng.randint(-28, 28) / 4)
            at = [c for c in cells if (math.floor(x / c.side), math.floor(y / c.side)) == (c.x, c.y)]
            found = False
            if at:
                e = at[0].edges[(at[0].edges[:, 1] > y) != (at[0].edges[:, 3] > y)]
                east = x < (e[:, 2] - e[:, 0]) * (y - e[:, 1]) / (e[:, 3] - e[:, 1]) + e[:, 0]
                found = bool((at[0].odd + (at[0].turns <= y).sum() + east.sum()) % 2)
            assert len(at) <= 1 and found == inside(rings, x, y)


def test_no_cell_of_a_polygon_without_edges():
    assert base_cells([], 1.0) == base_cells([[]], 1.0) == base_cells([[{"lng": 1.0, "lat": 2.0}, None]], 1.0) == []


def test_polygons_of_all_sizes_at_once(spark, monkeypatch):
    """Names of overlapping polygons, from 0.1 to 40 degrees, for points all over; the large one has few index rows."""
    rng = random.Random(3)
    shapes = [(f"p{i:02}", shape(rng, i % 3 == 0)) for i in range(25)]
    shapes += [("huge", [[{"lng": float(x), "lat": float(y)} for x, y in ((-20, -20), (20, -20), (20, 20), (0, 3), (-20, 20))]])]
    shapes += [(None, shapes[0][1]), ("none", None), ("empty", [])]
    polygons = spark.createDataFrame(shapes, "name string, rings array<array<struct<lng: double, lat: double>>>")
    points = [(i, rng.uniform(-8, 8), rng.uniform(-8, 8)) for i in range(400)] + [(400 + i, rng.uniform(-30, 30), rng.uniform(-30, 30)) for i in range(200)]
    points += [(900, None, 1.0), (901, 1.0, None), (902, 0.0, 0.0), (902, 0.0, 0.0)]
    df = spark.createDataFrame(points, "id int, lng double, lat double").selectExpr("*", "id as bx", "'x' as name", "lat as inner")
    named = [(n, r) for n, r in shapes if n and r]
    want = sorted((i, min((n for n, r in named if None not in (x, y) and inside(r, x, y)), default=None)) for i, x, y in points)
    for edges in (16, 2):
        monkeypatch.setattr(pg, "CELL_EDGES", edges)
        found = pg.with_containing_polygon(df, polygons, "name")
        assert sorted(found.columns) == sorted(df.columns)
        assert sorted((r["id"], r["name"]) for r in found.collect()) == want
    bases, fine = pg._cover(polygons.filter(F.col("name") == "huge"), "name", pg._side(polygons))
    assert bases.count() <= 2 * (pg.BASE_CELLS + 1) ** 2 and fine.filter(F.size("leaves") > 0).count() < 400
    assert {r["name"] for r in pg.with_containing_polygon(df, polygons.limit(0), "name").collect()} == {None}
    assert np.isfinite(pg._side(polygons))
