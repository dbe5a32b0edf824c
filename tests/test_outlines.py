"""Rings of regions and lines between junctions: areas, corners and lines for several sizes of tiles."""

import numpy as np
import pytest
from helpers import frame
from pixelquery import Grid
from pixelquery.operators import outlines, regions, simplify
from pixelquery.queries import regions as region_queries


def raster(seed, shape=(23, 31), classes=3):
    draw = np.random.default_rng(seed)
    coarse = draw.integers(0, classes, (shape[0] // 3 + 1, shape[1] // 3 + 1)).astype(float)
    out = np.kron(coarse, np.ones((3, 3)))[: shape[0], : shape[1]]
    noise = draw.random(shape) < 0.15
    out[noise] = draw.integers(0, classes, int(noise.sum()))
    out[draw.random(shape) < 0.05] = np.nan
    return out


def made(spark, values, tile):
    grid = Grid(x0=0.0, y0=0.0, res=1.0, height=values.shape[0], width=values.shape[1], tile=tile)
    return frame(spark, class_id=values).selectExpr("row", "col", "CAST(class_id AS INT) AS class_id"), grid


def shoelace(points):
    x, y = np.array(points, float).T
    return float(np.sum(x * np.roll(y, -1) - np.roll(x, -1) * y)) / 2


@pytest.mark.parametrize(("seed", "tile"), [(1, 8), (2, 64)])
def test_rings(spark, seed, tile):
    values = raster(seed)
    pred, grid = made(spark, values, tile)
    rings, corners = outlines.region_rings(pred, grid)
    found = rings.collect()
    areas, perimeter = {}, {}
    for r in found:
        areas[r.region_id] = areas.get(r.region_id, 0) + r.area
        perimeter[r.region_id] = perimeter.get(r.region_id, 0) + r.edges
    want = {r.region_id: r for r in regions.connected_regions(pred, grid).collect()}
    assert areas == {k: r.pixels for k, r in want.items()}
    assert perimeter == {k: r.perimeter for k, r in want.items()}
    assert sum(not r.hole for r in found) == len(want) and any(r.hole for r in found)
    points = {}
    for c in corners.orderBy("place").collect():
        points.setdefault(c.ring, []).append((c.col, c.row))
    inside = np.zeros(values.shape, int)
    for r in found:
        ring = points[r.ring]
        assert shoelace(ring) == r.area and len(ring) >= 4
        steps = np.diff(np.array([*ring, ring[0]]), axis=0)
        assert ((steps == 0).sum(1) == 1).all() and np.abs(steps).sum() == r.edges
        # counting upright sides to the left of a pixel, with sign, puts it inside or outside the ring
        for (x, y), (dx, dy) in zip(ring, steps):
            if dy:
                low, high = sorted((y, y + dy))
                inside[low:high, x:] += -1 if dy > 0 else 1
    assert (inside == ~np.isnan(values)).all()
    layer = outlines.ring_layer(rings, corners, grid, most=7).collect()
    assert sum(len(p.points) for p in layer) == corners.count() and max(len(p.points) for p in layer) <= 7


def test_a_single_ring_over_many_tiles(spark):
    values = np.zeros((40, 40))
    values[1:39, 1:39] = np.nan
    pred, grid = made(spark, values, 4)
    rings, corners = outlines.region_rings(pred, grid)
    assert sorted((r.area, r.edges, r.hole) for r in rings.collect()) == [(-1444, 152, True), (1600, 160, False)]
    assert corners.count() == 8
    empty, grid = made(spark, np.full((5, 5), np.nan), 4)
    assert [df.count() for df in outlines.region_rings(empty, grid)] == [0, 0]
    assert outlines.boundary_lines(empty, grid).count() == 0


def lines_of(pred, grid, tolerance, **more):
    rows = outlines.boundary_lines(pred, grid, tolerance, **more).collect()
    return sorted((r.class_a, r.class_b, r.edges, r.closed, tuple((p.x, p.y) for p in r.points)) for r in rows)


@pytest.mark.parametrize("tolerance", [0.0, 1.5])
def test_lines_do_not_depend_on_tiles(spark, tolerance):
    values = raster(3)
    small, large = made(spark, values, 5), made(spark, values, 64)
    got = lines_of(*small, tolerance)
    assert got == lines_of(*large, tolerance)
    framed = np.pad(np.where(np.isnan(values), -1, values), 1, constant_values=-1).astype(int)
    sides = [(framed[:-1, :], framed[1:, :]), (framed[:, :-1], framed[:, 1:])]
    want = sum(int((a != b).sum()) for a, b in sides)
    assert sum(edges for *_, edges, _, _ in [(a, b, e, c, p) for a, b, e, c, p in got]) == want
    nw, ne, sw, se = framed[:-1, :-1], framed[:-1, 1:], framed[1:, :-1], framed[1:, 1:]
    degree = (nw != ne).astype(int) + (sw != se) + (nw != sw) + (ne != se)
    for a, b, _, closed, points in got:
        assert a < b
        if closed:
            assert points[0] == points[-1]
        else:
            assert all(degree[int(-y), int(x)] != 2 for x, y in (points[0], points[-1]))
    if not tolerance:
        assert sum(np.abs(np.diff(np.array(p), axis=0)).sum() for *_, p in got) == want


def test_parts_of_a_long_line_meet(spark):
    values = np.zeros((30, 30))
    values[np.tril_indices(30)] = 1
    pred, grid = made(spark, values, 7)
    whole = [r for r in lines_of(pred, grid, 0.0) if r[:2] == (0, 1)]
    parts = [r for r in lines_of(pred, grid, 0.0, longest=9) if r[:2] == (0, 1)]
    assert len(whole) == 1 < len(parts) and sum(p[2] for p in parts) == whole[0][2]
    assert {q for p in parts for q in p[4]} == set(whole[0][4])


@pytest.mark.parametrize("tolerance", [0.0, 0.8, 2.0])
def test_lines_simplified_together_are_those_simplified_alone(tolerance):
    draw = np.random.default_rng(6)
    lines = [np.cumsum(draw.integers(-1, 2, (n, 2)), 0).astype(float) for n in [*draw.integers(2, 40, 60), 2, 3, 500]]
    lines += [np.array([[0, 0], [3, 0], [3, 3], [0, 3], [0, 0]], float), np.zeros((4, 2))]  # closed, and one spot
    points, ends = np.concatenate(lines), np.cumsum([len(x) for x in lines])
    starts = ends - [len(x) for x in lines]
    keep = simplify.simplified_lines(points, starts, ends - 1, tolerance)
    for line, a, b in zip(lines, starts, ends):
        assert np.flatnonzero(keep[a:b]).tolist() == simplify.douglas_peucker(line, tolerance).tolist()


def test_only_chains_with_neighbours_are_ordered(spark, monkeypatch):
    rows = [(1, None, 4), (2, 3, 5), (3, None, 6), (4, 4, 7), (5, 6, 1), (6, 5, 2), (7, None, 3)]
    links = spark.createDataFrame(rows, "chain BIGINT, next BIGINT, edges BIGINT")
    sizes, kept = {}, outlines.cut_lineage

    def noted(df, label):
        out = kept(df, label)
        sizes[label] = out.count()
        return out

    monkeypatch.setattr(outlines, "cut_lineage", noted)
    got = sorted(map(tuple, outlines.ordered(links).collect()))
    assert got == [(1, 1, 0), (2, 2, 0), (3, 2, 5), (4, 4, 0), (5, 5, 0), (6, 5, 1), (7, 7, 0)]
    assert set(sizes.values()) == {4}


def test_the_query_simplifies_lines_once(spark):
    made = region_queries.QUERIES["agg19_simplified_boundaries"](spark, "/root/testdata/sf0.001")
    assert made._jdf.queryExecution().executedPlan().toString().count("MapInArrow") == 1
