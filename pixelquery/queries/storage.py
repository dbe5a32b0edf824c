"""Write-and-read-back of every sink and source (SRC8-10, SRC12, SNK1-9)."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from pixelquery import fixtures
from pixelquery.functions import geodesy
from pixelquery.operators import classify, ml, outlines, spatial
from pixelquery.plans import landcover
from pixelquery.queries import classes, geodesy_sql, learning, spectral, training
from pixelquery.queries import regions as region_queries
from pixelquery.queries.common import r, rounded, with_grid, with_grid_recursive
from pixelquery.schema import BAND_NAMES, SPECTRAL_BANDS
from pixelquery.session import scratch_path
from pixelquery.sources import raster, tables, vector

QUERIES = {}
ORACLES = {}

_LAYERS = [*SPECTRAL_BANDS, "Elevation"]
_LAYER_SQL = (
    ", ".join(f"{r(b.lower())} AS {b}" for b in SPECTRAL_BANDS) + f", {r('z')} AS Elevation"
)


# rasters --------------------------------------------------------------------------------------
def _stored(spark, sf_dir):
    grid = fixtures.pixel_grid(spark, sf_dir)
    path = scratch_path(spark, "raster")
    raster.write_raster(
        spectral.reflectances(spark, sf_dir).select("row", "col", *_LAYERS), grid, path
    )
    return path, grid


def _stack_round_trip(spark, sf_dir):
    path, grid = _stored(spark, sf_dir)
    back = raster.read_raster(spark, path, _LAYERS, tile=grid.tile)
    return rounded(back.select("row", "col", *_LAYERS), *_LAYERS)


QUERIES["snk1_feature_raster"] = _stack_round_trip
ORACLES["snk1_feature_raster"] = with_grid(f"SELECT r AS row, c AS col, {_LAYER_SQL} FROM grid")


def _windowed(spark, sf_dir):
    path, grid = _stored(spark, sf_dir)
    window = (grid.height // 4, grid.height // 2, 10, 60)
    back = raster.read_raster(spark, path, _LAYERS, window, grid.tile)
    return rounded(back.select("row", "col", *_LAYERS), *_LAYERS)


QUERIES["src8_window_scan"] = _windowed
ORACLES["src8_window_scan"] = with_grid(
    f"SELECT r AS row, c AS col, {_LAYER_SQL} FROM grid, size "
    "WHERE r >= h // 4 AND r < h // 2 AND c >= 10 AND c < 60"
)


def _blocks(spark, sf_dir):
    path, grid = _stored(spark, sf_dir)
    back = raster.read_raster(spark, path, _LAYERS, tile=grid.tile)
    return back.groupBy("tile_row").agg(
        F.count("*").alias("pixels"), F.count("B02").alias("valid")
    )


QUERIES["src12_row_blocks"] = _blocks
ORACLES["src12_row_blocks"] = with_grid(
    "SELECT r // 64 AS tile_row, count(*) AS pixels, count(b02) AS valid FROM grid GROUP BY 1"
)


def _class_raster(spark, sf_dir):
    path = scratch_path(spark, "classes")
    raster.write_classes(
        fixtures.classes(spark, sf_dir), fixtures.pixel_grid(spark, sf_dir), path
    )
    return path


def _stored_classes(spark, sf_dir):
    stored = spark.read.parquet(_class_raster(spark, sf_dir))
    return stored.select("row", "col", "class_id")


QUERIES["snk4_class_raster"] = _stored_classes
ORACLES["snk4_class_raster"] = with_grid(
    "SELECT r AS row, c AS col, coalesce(y_pred, 255) AS class_id FROM grid"
)


def _updated(spark, sf_dir):
    grid = fixtures.pixel_grid(spark, sf_dir)
    path = _class_raster(spark, sf_dir)
    north = classify.north_by_row(grid.height // 2)
    path = raster.update_classes(spark, path, grid, lambda p: classify.water_rule(p, north))
    return raster.read_classes(spark, path).select("row", "col", "class_id")


QUERIES["snk6_raster_update"] = _updated
ORACLES["snk6_raster_update"] = classes.ORACLES["flt4_water_rule"]


# vector layers --------------------------------------------------------------------------------
def _geojson(spark, sf_dir):
    path = scratch_path(spark, "polygons")
    boxes = spatial.box_polygons(fixtures.areas(spark, sf_dir)).drop("area_id")
    vector.write_geojson(boxes, path)
    back = vector.read_geojson_lines(spark, path)
    corners = back.select(
        "class", "class_id", "desc", "width_m", "height_m", F.posexplode("ring").alias("i", "p")
    )
    flat = corners.select("*", F.col("p.x").alias("x"), F.col("p.y").alias("y")).drop("p")
    return rounded(flat, "x", "y")


_BOX_SQL = training.ORACLES["prj30_boxes"].replace(
    "SELECT area_id, round_even",
    "SELECT class_ AS class, cid AS class_id, desc_ AS desc, round_even",
)
QUERIES["snk2_geojson_polygons"] = _geojson
ORACLES["snk2_geojson_polygons"] = _BOX_SQL


def _feature_collections(spark, sf_dir):
    """Documents with holes (even areas) and second parts (odd ones), scanned by pieces of a few kilobytes."""
    path = scratch_path(spark, "collections")
    areas = fixtures.areas(spark, sf_dir)
    lon, lat, dlon, dlat = (F.col(c) for c in ("lon", "lat", "dlon", "dlat"))
    even = F.col("area_id") % 2 == 0
    half, shift = F.when(even, 0.5).otherwise(1.0), F.when(even, 0.0).otherwise(3.0)

    def box(x, dx, dy):
        ring = geodesy.box_ring(x - dx, lat - dy, x + dx, lat + dy)
        return F.transform(ring, lambda p: F.array(p["x"], p["y"]))

    outer, second = box(lon, dlon, dlat), box(lon + dlon * shift, dlon * half, dlat * half)
    holed, parts = F.array(outer, second), F.array(F.array(outer), F.array(second))
    shape = lambda kind, nested: F.to_json(F.struct(F.lit(kind).alias("type"), nested.alias("coordinates")))
    geometry = F.when(even, shape("Polygon", holed)).otherwise(shape("MultiPolygon", parts))
    about = F.to_json(F.struct("class", "class_id", "desc"))
    feature = F.concat(F.lit('{"type": "Feature", "properties": '), about, F.lit(', "geometry": '), geometry, F.lit("}"))
    vector.write_feature_collections(areas.select(feature.alias("value")), path)
    corners = vector.scan_geojson(spark, path).select("class", "class_id", "desc", F.posexplode("ring").alias("i", "p"))
    flat = corners.select("class", "class_id", "desc", "i", F.col("p.x").alias("x"), F.col("p.y").alias("y"))
    return rounded(flat, "x", "y")


QUERIES["src9_geojson_scan"] = _feature_collections
ORACLES["src9_geojson_scan"] = (
    f"WITH {geodesy_sql.AREAS_CTE}, "
    "k(i, sx, sy) AS (VALUES (0, 1, -1), (1, 1, 1), (2, -1, 1), (3, -1, -1), (4, 1, -1)), "
    "pts AS (SELECT area_id, i, lon + sx * dlon AS x, lat + sy * dlat AS y FROM areas, k "
    "UNION ALL SELECT area_id, i + 5, CASE WHEN area_id % 2 = 0 THEN lon + sx * (dlon * 0.5::DOUBLE) "
    "ELSE lon + dlon * 3.0::DOUBLE + sx * dlon END, CASE WHEN area_id % 2 = 0 THEN lat + sy * (dlat * 0.5::DOUBLE) "
    "ELSE lat + sy * dlat END FROM areas, k "
    "UNION ALL SELECT area_id, 10, lon + dlon, lat - dlat FROM areas) "
    f"SELECT class_ AS class, cid AS class_id, desc_ AS desc, CAST(i AS INT) AS i, {r('x')} AS x, {r('y')} AS y "
    "FROM pts JOIN areas USING (area_id)"
)


def _region_layer(spark, sf_dir):
    """The stored layer, read back: rings, points and the area within the points, by class."""
    path = scratch_path(spark, "regions")
    grid = fixtures.pixel_grid(spark, sf_dir)
    outlines.ring_layer(*region_queries.rings_of(spark, sf_dir), grid, most=64).write.parquet(path)
    layer = spark.read.parquet(path).withColumn(
        "points", F.transform("points", lambda p: F.struct((p["x"] - grid.x0).alias("x"), (p["y"] - grid.y0).alias("y")))
    )
    # parts follow one another, so a part's last point meets the first of the next, or of the ring
    parts = layer.select(
        "class_id", "ring", "part", F.size("points").alias("n"), F.element_at("points", 1).alias("first"),
        F.element_at("points", -1).alias("last"),
        F.expr("IF(size(points) > 1, aggregate(sequence(1, size(points) - 1), CAST(0 AS DOUBLE), (s, i) -> s + "
               "points[i].x * points[i - 1].y - points[i - 1].x * points[i].y), 0D)").alias("twice"),
    )
    around = Window.partitionBy("ring").orderBy("part")
    following = F.coalesce(F.lead("first").over(around), F.first("first").over(around))
    crossed = following["x"] * F.col("last")["y"] - F.col("last")["x"] * following["y"]
    return parts.withColumn("twice", F.col("twice") + crossed).groupBy("class_id").agg(
        F.countDistinct("ring").alias("rings"), F.sum("n").alias("points"), (F.sum("twice") / 2).alias("area_m2")
    )


QUERIES["snk7_region_layer"] = _region_layer
ORACLES["snk7_region_layer"] = with_grid_recursive(
    "SELECT class_id, CAST(sum(2 - (s.pixels - pairs + squares)) AS BIGINT) AS rings, "
    "CAST(sum(corners) AS BIGINT) AS points, CAST(sum(s.pixels) * 122500 AS DOUBLE) AS area_m2 "
    "FROM shape s JOIN reg USING (region_id) GROUP BY class_id",
    *region_queries.RING_CTES,
)


# tables ---------------------------------------------------------------------------------------
def _training_csv(spark, sf_dir):
    path = scratch_path(spark, "training-csv")
    tables.write_training_csv(training.training_rows(spark, sf_dir), path)
    return rounded(tables.read_training_csv(spark, path), *BAND_NAMES)


QUERIES["snk3_training_csv"] = _training_csv
ORACLES["snk3_training_csv"] = training.ORACLES["training_table"]


# the scan is that of the whole written table
QUERIES["src10_training_csv_scan"] = _training_csv
ORACLES["src10_training_csv_scan"] = training.ORACLES["training_table"]


def _area_csv(spark, sf_dir):
    path = scratch_path(spark, "area-csv")
    table = classify.area_table(
        fixtures.classes(spark, sf_dir), fixtures.pixel_grid(spark, sf_dir)
    )
    tables.write_area_csv(table, path)
    return rounded(tables.read_area_csv(spark, path), "area_km2", "pct")


QUERIES["snk5_area_csv"] = _area_csv
ORACLES["snk5_area_csv"] = classes.ORACLES["set2_area_table_with_total"]


def _published(spark, sf_dir):
    """Two datasets are published; the third fails on purpose and is reported, not fatal."""
    root = scratch_path(spark, "published")

    def broken():
        raise ValueError("source is not available")

    manifest = tables.publish(
        spark,
        {
            "classes": lambda: fixtures.classes(spark, sf_dir),
            "broken": broken,
            "scenes": lambda: fixtures.scenes(spark, sf_dir).select("scene_id", "cloud"),
        },
        root,
    )
    sizes = None
    for title in ("classes", "scenes"):
        size = tables.published(spark, root, title).agg(F.count("*").alias("rows"))
        size = size.select(F.lit(title).alias("title"), "rows")
        sizes = size if sizes is None else sizes.unionByName(size)
    return manifest.select("title", "status").join(sizes, "title", "left")


QUERIES["snk9_publish"] = _published
ORACLES["snk9_publish"] = (
    "SELECT 'classes' AS title, 'PUBLISHED' AS status, count(*) AS rows FROM orders "
    "UNION ALL SELECT 'scenes', 'PUBLISHED', count(*) FROM events "
    "UNION ALL SELECT 'broken', 'FAILED', NULL"
)


# models ---------------------------------------------------------------------------------------
def _model_round_trip(spark, sf_dir):
    """Scores of a saved and reloaded model next to those of the model itself."""
    path = scratch_path(spark, "model")
    model = learning.small_forest(spark, sf_dir)
    landcover.save_model(model, path)
    stack = learning.scene_stack(spark, sf_dir)
    models = {"class_id": model, "reloaded": landcover.load_model(spark, path)}
    both = ml.scores(models, stack).dropna("any", subset=["row", "col"])
    return both.select("row", "col", F.col("class_id").eqNullSafe(F.col("reloaded")).alias("same"))


QUERIES["snk8_model_round_trip"] = _model_round_trip
ORACLES["snk8_model_round_trip"] = with_grid("SELECT r AS row, c AS col, true AS same FROM grid")
