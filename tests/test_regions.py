import math
from collections import Counter

import numpy as np
import pytest
from helpers import frame
from pixelquery import Grid
from pixelquery.operators import regions, simplify
from pyspark.sql import functions as F


def flood(a):
    """Region id (first pixel in reading order) of each pixel by plain search."""
    height, width = a.shape
    label = np.full(a.shape, -1)
    for r in range(height):
        for c in range(width):
            if np.isnan(a[r, c]) or label[r, c] >= 0:
                continue
            stack = [(r, c)]
            label[r, c] = r * width + c
            while stack:
                y, x = stack.pop()
                for v, u in ((y - 1, x), (y + 1, x), (y, x - 1), (y, x + 1)):
                    if 0 <= v < height and 0 <= u < width and label[v, u] < 0 and a[v, u] == a[r, c]:
                        label[v, u] = r * width + c
                        stack.append((v, u))
    return label


def spiral(n):
    a = np.zeros((n, n))
    r, c, dr, dc = 0, 0, 0, 1
    for _ in range(n * n):
        a[r, c] = 1
        ahead = (r + dr, c + dc)
        beyond = (r + 2 * dr, c + 2 * dc)
        free = 0 <= ahead[0] < n and 0 <= ahead[1] < n and a[ahead] == 0
        if not free or (0 <= beyond[0] < n and 0 <= beyond[1] < n and a[beyond] == 1):
            dr, dc = dc, -dr
            ahead = (r + dr, c + dc)
            if not (0 <= ahead[0] < n and 0 <= ahead[1] < n) or a[ahead] == 1:
                break
        r, c = ahead
    return a


def noisy():
    a = np.random.default_rng(7).integers(0, 3, (17, 19)).astype(float)
    a[np.random.default_rng(8).random(a.shape) < 0.1] = np.nan
    return a


CASES = {
    "noise": noisy(),
    "spiral": spiral(15),
    "one class": np.zeros((13, 14)),
    "checkerboard": np.indices((9, 10)).sum(axis=0) % 2.0,
    "nodata": np.full((5, 6), np.nan),
}


def pixels(spark, a):
    return frame(spark, v=a).select("row", "col", F.col("v").cast("int").alias("class_id"))


@pytest.mark.parametrize("name", CASES)
def test_regions_match_flood_fill(spark, name):
    a = CASES[name]
    grid = Grid(0, 0, 10, *a.shape, tile=4)
    got = {r.region_id: r for r in regions.connected_regions(pixels(spark, a), grid).collect()}
    label = flood(a)
    sizes = Counter(label[label >= 0].tolist())
    assert {k: r.pixels for k, r in got.items()} == dict(sizes)
    framed = np.pad(label, 1, constant_values=-2)
    for k, r in got.items():
        rows, cols = np.nonzero(label == k)
        assert (r.min_row, r.max_row, r.min_col, r.max_col) == (
            rows.min(), rows.max(), cols.min(), cols.max(),
        )
        inner = framed[1:-1, 1:-1] == k
        sides = sum(
            int((inner & (np.roll(framed, s, axis)[1:-1, 1:-1] != k)).sum())
            for axis in (0, 1)
            for s in (1, -1)
        )
        assert r.perimeter == sides * 10.0
    assert sum(r.pixels for r in got.values()) == int((~np.isnan(a)).sum())


def test_roots_of_a_path_and_a_hub(spark):
    path = [(i, i + 1) for i in range(100, 140)]
    hub = [(999, i) for i in range(200, 260)] + [(1000, 999)]
    pairs = [(5, 7), (7, 5), (6, 6)]
    edges = spark.createDataFrame(path + hub + pairs, "a LONG, b LONG")
    got = {r.node: r.root for r in regions.connected_roots(edges).collect()}
    assert all(got[i] == 100 for i in range(100, 141))
    assert all(got[i] == 200 for i in [*range(200, 260), 999, 1000])
    assert got[5] == got[7] == 5 and 6 not in got


def test_dissolve_counts_parts(spark):
    a = np.array([[0, 1, 0], [1, 1, 0], [0, 1, 0]], float)
    grid = Grid(0, 0, 10, 3, 3, tile=2)
    rows = regions.dissolve(regions.connected_regions(pixels(spark, a), grid)).collect()
    assert {r.class_id: (r.parts, r.pixels) for r in rows} == {0: (3, 5), 1: (1, 4)}


@pytest.mark.parametrize("name", ["noise", "spiral", "one class", "checkerboard"])
def test_unsimplified_arcs_cover_every_boundary(spark, name):
    a = CASES[name]
    grid = Grid(0, 0, 10, *a.shape, tile=4)
    arcs = simplify.boundary_arcs(pixels(spark, a), grid, tolerance=0.0)
    lengths = simplify.class_boundaries(arcs).groupBy("class_id").agg(F.sum("length").alias("m"))
    got = {r.class_id: r.m for r in lengths.collect()}
    expected = Counter()
    framed = np.pad(np.where(np.isnan(a), -1, a), 1, constant_values=-1)
    core = framed[1:-1, 1:-1]
    for axis in (0, 1):
        for s in (1, -1):
            other = np.roll(framed, s, axis)[1:-1, 1:-1]
            for v in core[(core >= 0) & (other != core)]:
                expected[int(v)] += 10.0
    assert got == pytest.approx(dict(expected))


def test_simplified_lines_stay_close_and_keep_ends(spark):
    a = (np.arange(40)[:, None] > np.arange(40)[None, :]).astype(float)  # staircase
    grid = Grid(0, 0, 10, 40, 40, tile=16)
    rough = simplify.boundary_arcs(pixels(spark, a), grid, 0.0).where("class_a = 0 AND class_b = 1")
    smooth = simplify.boundary_arcs(pixels(spark, a), grid, 20.0).where(
        "class_a = 0 AND class_b = 1"
    )

    def points(df):
        return [[(p.x, p.y) for p in r.points] for r in df.collect()]

    before, after = points(rough), points(smooth)
    assert sum(map(len, after)) < sum(map(len, before)) / 3
    assert sorted((line[0], line[-1]) for line in before) == sorted(
        (line[0], line[-1]) for line in after
    )
    for line in after:
        for x, y in line:
            assert any(math.dist((x, y), q) == 0 for other in before for q in other)


def test_douglas_peucker_keeps_far_points():
    line = np.array([(0, 0), (1, 0.1), (2, 5), (3, 0.1), (4, 0)])
    assert simplify.douglas_peucker(line, 1.0).tolist() == [0, 2, 4]
    assert simplify.douglas_peucker(line, 10.0).tolist() == [0, 4]
    ring = np.array([(0, 0), (4, 0), (4, 4), (0, 4), (0, 0)])
    assert simplify.douglas_peucker(ring, 1.0).tolist() == [0, 1, 2, 3, 4]
