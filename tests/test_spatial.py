import random

import pytest
from pixelquery import Grid
from pixelquery.functions import geodesy
from pixelquery.operators import catalog, classify, spatial
from pixelquery.queries import training
from pixelquery.schema import training_areas
from pyspark.sql import functions as F

STUDY_GRID = Grid(399960, 3729900, 10, 3966, 3517)


def test_projection_round_trip_and_columns_agree(spark):
    points = [(-112.4, 33.2), (-111.0, 33.5), (-111.7, 33.7)]
    df = spark.createDataFrame(points, "lon DOUBLE, lat DOUBLE")
    x, y = geodesy.lonlat_to_utm(F.col("lon"), F.col("lat"))
    for row in df.select("lon", "lat", x.alias("x"), y.alias("y")).collect():
        assert (row.x, row.y) == pytest.approx(geodesy.lonlat_to_utm_point(row.lon, row.lat))
        assert geodesy.utm_to_lonlat_point(row.x, row.y) == pytest.approx(
            (row.lon, row.lat), abs=1e-8
        )


def test_threshold_row_of_the_study_area():
    assert classify.threshold_row(STUDY_GRID) == 1727


def test_training_pixels_of_the_study_area(spark):
    """The published total over the 28 areas, counted on the full 13.9 M pixel grid."""
    polygons = spatial.project_polygons(spatial.box_polygons(training_areas(spark)))
    hits = spatial.label_pixels(
        STUDY_GRID.cells(spark), polygons.select("class", "ring"), STUDY_GRID
    )
    counts = {r["class"]: r["count"] for r in hits.groupBy("class").count().collect()}
    assert sum(counts.values()) == 265284
    assert counts == {
        "Urban": 37941,
        "Vegetation": 38683,
        "Agricultural": 34235,
        "Bare_Soil": 103337,
        "Water": 20586,
        "Industrial": 30502,
    }


def even_odd(ring, x, y):
    inside = False
    for (x1, y1), (x2, y2) in zip(ring, ring[1:], strict=False):
        if (y1 > y) != (y2 > y) and x < (x2 - x1) * (y - y1) / (y2 - y1) + x1:
            inside = not inside
    return inside


def polygon_frame(spark, rings):
    rows = [(f"p{i}", [{"x": float(x), "y": float(y)} for x, y in ring]) for i, ring in enumerate(rings)]
    return spark.createDataFrame(rows, "desc STRING, ring ARRAY<STRUCT<x: DOUBLE, y: DOUBLE>>")


@pytest.fixture(scope="module")
def rings():
    rng = random.Random(6)
    out = []
    for _ in range(25):
        ring = [(rng.uniform(-40, 340), rng.uniform(-340, 40)) for _ in range(rng.randint(3, 7))]
        out.append([*ring, ring[0]])
    out.append([(0, 0), (100, 0), (100, -100), (50, -20), (0, -100), (0, 0)])  # concave
    out.append([(1000, 1000), (1010, 1000), (1010, 1010), (1000, 1000)])  # away from the raster
    return out


@pytest.mark.parametrize("limit,join", [(1 << 25, "BroadcastHashJoin"), (0, "SortMergeJoin")])
def test_pixels_in_polygons_brute_force(spark, rings, limit, join, monkeypatch):
    grid = Grid(0, 0, 10, 30, 31, tile=16)
    polygons = polygon_frame(spark, rings)
    monkeypatch.setattr(spatial, "BROADCAST_BYTES", limit)
    hits = spatial.label_pixels(grid.cells(spark), polygons, grid)
    assert join in hits._jdf.queryExecution().executedPlan().toString()
    got = sorted((r.desc, r.row, r.col) for r in hits.collect())
    expected = sorted(
        (f"p{i}", r, c)
        for i, ring in enumerate(rings)
        for r in range(30)
        for c in range(31)
        if even_odd(ring, (c + 0.5) * 10, -(r + 0.5) * 10)
    )
    assert got == expected


def test_adjacent_boxes_share_no_pixel(spark):
    boxes = [
        [(0, 0), (55, 0), (55, -100), (0, -100), (0, 0)],
        [(55, 0), (100, 0), (100, -100), (55, -100), (55, 0)],
    ]
    grid = Grid(0, 0, 10, 10, 10)
    hits = spatial.label_pixels(grid.cells(spark), polygon_frame(spark, boxes), grid)
    assert hits.count() == hits.select("row", "col").distinct().count() == 100


def test_clip_polygons(spark):
    grid = Grid(0, 0, 10, 10, 10)
    shapes = [
        [(-50, 50), (50, 50), (50, -50), (-50, -50), (-50, 50)],
        [(10, -10), (20, -10), (20, -20), (10, -20), (10, -10)],
        [(200, 0), (210, 0), (210, -10), (200, 0)],
        [(-100, -50), (50, 100), (200, -50), (50, -200), (-100, -50)],
    ]
    clipped = spatial.clip_polygons(polygon_frame(spark, shapes), grid)
    areas = {
        r.desc: r.a for r in clipped.select("desc", spatial.ring_area(F.col("ring")).alias("a")).collect()
    }
    assert areas == {"p0": pytest.approx(2500), "p1": pytest.approx(100), "p3": pytest.approx(10000)}


def test_skipped_is_the_complement(spark, rings):
    grid = Grid(0, 0, 10, 30, 31)
    polygons = polygon_frame(spark, rings)
    kept = {r.desc for r in spatial.polygons_on_raster(polygons, grid).collect()}
    skipped = {r.desc for r in spatial.skipped_polygons(polygons, grid).collect()}
    assert kept | skipped == {f"p{i}" for i in range(len(rings))} and not kept & skipped
    assert f"p{len(rings) - 1}" in skipped


def test_pixel_address_truncates_and_clamps(spark):
    grid = Grid(100, 100, 10, 5, 5)
    df = spark.createDataFrame([(104.0, 96.0), (-500.0, 900.0), (1e6, -1e6)], "x DOUBLE, y DOUBLE")
    got = df.select(grid.row_at(F.col("y")).alias("r"), grid.col_at(F.col("x")).alias("c")).collect()
    assert [(g.r, g.c) for g in got] == [(0, 0), (0, 0), (5, 5)]


def test_unknown_cloud_counts_as_full(spark, monkeypatch):
    monkeypatch.setattr(catalog, "complete_scenes", lambda files: files)
    scenes = spark.createDataFrame([("a", None), ("b", 1.0)], "scene_id STRING, cloud DOUBLE")
    found = catalog.best_scene(scenes, scenes.select("scene_id")).collect()
    assert [tuple(r) for r in found] == [("b", 1.0)]


def test_areas_of_a_one_file_table_are_projected_by_many_tasks(spark):
    polygons = training._area_polygons(spark, "/root/testdata/sf0.001")
    assert polygons.rdd.getNumPartitions() == int(spark.conf.get("spark.sql.shuffle.partitions"))
