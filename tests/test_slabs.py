"""Rings of very many edges against the even-odd rule for each pixel."""

import math

import numpy as np
import pytest
from pixelquery import Grid
from pixelquery.operators import spatial


def ring(n, cx, cy, radius, waves, depth):
    angle = np.linspace(0, 2 * math.pi, n, endpoint=False)
    r = radius * (1 + depth * np.sin(waves * angle))
    points = list(zip((cx + r * np.cos(angle)).tolist(), (cy + r * np.sin(angle)).tolist()))
    return [*points, points[0]]


def inside(points, x, y):
    odd = np.zeros(np.broadcast(x, y).shape, bool)
    for (x1, y1), (x2, y2) in zip(points, points[1:]):
        if y1 != y2:
            at = (x2 - x1) * (y - y1) / (y2 - y1) + x1
            odd ^= ((y1 > y) != (y2 > y)) & (x < at)
    return odd


def labelled(spark, grid, shapes):
    rows = [(k, [{"x": x, "y": y} for x, y in points]) for k, points in enumerate(shapes)]
    polygons = spark.createDataFrame(rows, "k INT, ring ARRAY<STRUCT<x: DOUBLE, y: DOUBLE>>")
    found = spatial.label_pixels(grid.cells(spark), polygons, grid)
    return sorted((r.k, r.row, r.col) for r in found.select("k", "row", "col").collect())


@pytest.mark.parametrize("broadcast", [32 << 20, 0])
def test_long_rings(spark, monkeypatch, broadcast):
    monkeypatch.setattr(spatial, "BROADCAST_BYTES", broadcast)
    monkeypatch.setattr(spatial, "HEAVY_EDGES", 20)
    grid = Grid(x0=1000.0, y0=5000.0, res=10.0, height=130, width=170, tile=64)
    shapes = [
        ring(700, 1800.0, 4400.0, 500.0, 9, 0.4),
        ring(60, 1000.0, 5000.0, 900.0, 3, 0.2),  # over the corner of the raster
        ring(300, 2700.0, 3700.0, 120.0, 40, 0.9),
        ring(200, 1500.0, 4500.0, 3000.0, 2, 0.1),  # around the whole raster
        [(1200.0, 4800.0), (1200.0, 4000.0), (2000.0, 4000.0), (2000.0, 4800.0), (1200.0, 4800.0)],  # light
        # steps along pixel centres, upright and level edges
        [(1105.0 + 10 * (k // 2), 4895.0 - 10 * ((k + 1) // 2)) for k in range(80)] + [(1105.0, 4495.0), (1105.0, 4895.0)],
    ]
    x = 1000.0 + (np.arange(170)[None, :] + 0.5) * 10
    y = 5000.0 - (np.arange(130)[:, None] + 0.5) * 10
    want = [(k, int(r), int(c)) for k, points in enumerate(shapes) for r, c in np.argwhere(inside(points, x, y))]
    assert labelled(spark, grid, shapes) == sorted(want)


def test_edges_sent_grow_with_edges_plus_buckets(spark):
    grid = Grid(x0=0.0, y0=10_000.0, res=10.0, height=1000, width=1000, tile=256)
    points = ring(100_000, 5000.0, 5000.0, 4000.0, 12, 0.2)
    rows = [(0, [{"x": x, "y": y} for x, y in points])]
    polygons = spark.createDataFrame(rows, "k INT, ring ARRAY<STRUCT<x: DOUBLE, y: DOUBLE>>")
    held = spatial.polygon_buckets(polygons, grid).selectExpr("size(_edges) AS n").collect()
    assert len(held) <= 1024 + 200
    assert sum(r.n for r in held) < 3 * 100_000
    found = spatial.label_pixels(grid.cells(spark), polygons, grid).count()
    x, y = np.array(points[:-1]).T
    area = abs(np.sum(x * np.roll(y, -1) - np.roll(x, -1) * y)) / 2
    assert abs(found * 100 - area) < 0.001 * area


def test_rings_of_many_edges_are_sent_as_bits(spark, monkeypatch):
    monkeypatch.setattr(spatial, "HEAVY_EDGES", 1000)
    grid = Grid(x0=1000.0, y0=5000.0, res=10.0, height=130, width=170, tile=64)
    shapes = [ring(100 + k, 1200.0 + 90 * k, 4900.0 - 70 * k, 60.0 + 30 * k, 9, 0.3) for k in range(14)]
    shapes.append([(1200.0, 4800.0)] * 20 + shapes[3])
    for k, odd in enumerate(((None, None), (None, 4500.0), (1700.0, None), (float("nan"), 4500.0), (1700.0, float("nan")))):
        points = list(shapes[5 + k])
        points[40] = odd
        shapes.append(points)
    plain = labelled(spark, grid, shapes)
    monkeypatch.setattr(spatial, "HEAVY_EDGES", 64)
    assert labelled(spark, grid, shapes) == plain
    monkeypatch.setattr(spatial, "MASK_BLOCK", 300)  # one ring at a time, in bands
    assert labelled(spark, grid, shapes) == plain
    rows = [(k, [{"x": x, "y": y} for x, y in points]) for k, points in enumerate(shapes)]
    polygons = spark.createDataFrame(rows, "k INT, ring ARRAY<STRUCT<x: DOUBLE, y: DOUBLE>>")
    held = spatial.polygon_buckets(polygons, grid).selectExpr("count_if(_edges IS NOT NULL)", "max(size(_mask))").first()
    assert held[0] == 0  # no edges
    assert held[1] == spatial.bucket_size(grid)


def test_rings_in_slabs(spark, monkeypatch):
    grid = Grid(x0=1000.0, y0=5000.0, res=10.0, height=130, width=170, tile=64)
    shapes = [ring(100 + k, 1200.0 + 90 * k, 4900.0 - 70 * k, 60.0 + 30 * k, 9, 0.3) for k in range(14)]
    bits = labelled(spark, grid, shapes)
    monkeypatch.setattr(spatial, "LONG_EDGES", 104)
    assert labelled(spark, grid, shapes) == bits
