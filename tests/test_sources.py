import json
import os
from functools import reduce

import pytest
from pixelquery import Grid, fixtures
from pixelquery.operators import catalog, classify, spatial
from pixelquery.queries import ORACLES, QUERIES
from pixelquery.schema import BAND_NAMES, TRAINING_AREAS, training_areas
from pixelquery.session import cut_lineage, discard, scratch_root
from pixelquery.sources import raster, tables, vector
from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def test_window_scan_prunes_directories(spark, tmp_path):
    grid = Grid(0, 0, 10, 40, 40, tile=8)
    df = grid.cells(spark).withColumn("B02", F.col("row") * 100.0 + F.col("col"))
    path = str(tmp_path / "stack")
    raster.write_raster(df, grid, path)
    back = raster.read_raster(spark, path, ["B02"], window=(9, 15, 17, 30), tile=8)
    assert back.count() == 6 * 13
    assert back.where(F.col("B02") != F.col("row") * 100.0 + F.col("col")).isEmpty()
    plan = back._jdf.queryExecution().toString()
    assert "PartitionFilters: [isnotnull(tile_row" in plan
    assert "GreaterThanOrEqual(tile_col,2)" in plan
    assert len(back.inputFiles()) <= len(spark.read.parquet(path).inputFiles())


def test_class_raster_versions(spark, tmp_path):
    grid = Grid(0, 0, 10, 2, 2, tile=2)
    pred = spark.createDataFrame(
        [(0, 0, 5), (0, 1, None), (1, 0, 5), (1, 1, 0)], "row INT, col INT, class_id INT"
    )
    first = str(tmp_path / "classes")
    raster.write_classes(pred, grid, first)
    stored = {(r.row, r.col): r.class_id for r in spark.read.parquet(first).collect()}
    assert stored[0, 1] == 255
    rule = lambda p: classify.water_rule(p, classify.north_by_row(1))
    second = raster.update_classes(spark, first, grid, rule)
    third = raster.update_classes(spark, second, grid, rule)
    assert len({first, second, third}) == 3

    def values(path):
        return {(r.row, r.col): r.class_id for r in raster.read_classes(spark, path).collect()}

    assert values(first)[0, 0] == 5
    assert values(second) == values(third) == {(0, 0): 1, (0, 1): None, (1, 0): 5, (1, 1): 0}


def test_feature_collection_document(spark, tmp_path):
    boxes = spatial.box_polygons(training_areas(spark))
    texts = [r.value for r in vector.to_geojson(boxes).collect()]
    document = {"type": "FeatureCollection", "features": [json.loads(t) for t in texts]}
    path = tmp_path / "areas.geojson"
    path.write_text(json.dumps(document, indent=1))
    back = vector.read_geojson(spark, str(path))
    assert back.count() == len(TRAINING_AREAS)
    first = back.where("desc = 'Old Town Scottsdale'").first()
    assert (first["class"], first.class_id, first.width_m, first.height_m) == (
        "Urban", 1, 1114.0, 891.0,
    )
    assert [(round(p.x, 3), round(p.y, 3)) for p in first.ring] == [
        (-111.921, 33.49), (-111.921, 33.498), (-111.933, 33.498), (-111.933, 33.49), (-111.921, 33.49),
    ]


def test_scene_metadata_files(spark, tmp_path):
    cases = {
        "good": "scene_id    : a\ncloud_cover : 1.25%\n",
        "bad": "cloud_cover : unknown%\n",
        "none": "scene_id    : c\n",
    }
    for key, text in cases.items():
        (tmp_path / key).mkdir()
        (tmp_path / key / "metadata.txt").write_text(text)
    lines = tables.read_scene_metadata(spark, str(tmp_path))
    got = {r.scene_key: r.cloud for r in catalog.parse_cloud_cover(lines).collect()}
    assert got == {"good": 1.25, "bad": 100.0, "none": 100.0}


def test_scene_metadata_written_together(spark, tmp_path):
    rows = [(f"k{i:04d}", line) for i in range(500) for line in (f"scene_id    : {i}", f"cloud_cover : {i / 8}%")]
    rows += [("odd=/key", "a\tb : 1"), ("odd=/key", ""), ("k0001", "cloud_cover : 0.1%")]
    lines = spark.createDataFrame(rows, "scene_key STRING, line STRING").repartition(3)
    tables.write_scene_metadata(lines, str(tmp_path))
    files = [f for _, _, names in os.walk(tmp_path) for f in names if f.endswith(".txt")]
    assert len(files) <= 3  # not one for each scene
    (tmp_path / "single").mkdir()
    (tmp_path / "single" / "metadata.txt").write_text("cloud_cover : 7%\n")
    found = tables.read_scene_metadata(spark, str(tmp_path))
    assert sorted(map(tuple, found.collect())) == sorted([*rows, ("single", "cloud_cover : 7%")])


def test_search_limits(spark):
    rows = [
        ("in", "2023-06-01 00:00:00", 4.99),
        ("last-day", "2023-08-31 23:59:59", 0.0),
        ("cloudy", "2023-07-01 00:00:00", 5.0),
        ("late", "2023-09-01 00:00:00", 0.0),
        ("undated", None, 0.0),
    ]
    scenes = spark.createDataFrame(rows, "scene_id STRING, acquired STRING, cloud DOUBLE").select(
        "scene_id",
        F.col("acquired").cast("timestamp").alias("acquired"),
        "cloud",
        F.expr("named_struct('west', -111.7D, 'south', 33.0D, 'east', -111.0D, 'north', 33.2D)").alias(
            "bbox"
        ),
    )
    found = catalog.search_scenes(scenes)
    assert {r.scene_id for r in found.collect()} == {"in", "last-day"}  # boxes that only touch count
    assert [r.scene_id for r in catalog.clearest(found, 1).collect()] == ["last-day"]


def test_training_csv_round_trip(spark, tmp_path):
    row = ("Urban", 1, *[i / 7 for i in range(len(BAND_NAMES))])
    fields = "class STRING, class_id INT, " + ", ".join(f"{b} DOUBLE" for b in BAND_NAMES)
    path = str(tmp_path / "csv")
    tables.write_training_csv(spark.createDataFrame([row], fields), path)
    assert tuple(tables.read_training_csv(spark, path).first()) == row


def test_csv_scan_returns_the_whole_training_table(spark):
    sf_dir = "/root/testdata/sf0.001"
    whole, scanned = (QUERIES[name](spark, sf_dir) for name in ("training_table", "src10_training_csv_scan"))
    assert scanned.columns == whole.columns
    assert sorted(map(repr, scanned.collect())) == sorted(map(repr, whole.collect()))
    assert ORACLES["src10_training_csv_scan"] == ORACLES["training_table"]


def test_publish_replaces_and_reports(spark, tmp_path):
    root = str(tmp_path / "pub")

    def fail():
        raise RuntimeError("no connection")

    tables.publish(spark, {"a": lambda: spark.range(3), "b": fail}, root)
    result = tables.publish(spark, {"a": lambda: spark.range(2)}, root)
    assert [(r.title, r.status) for r in result.collect()] == [("a", "PUBLISHED")]
    assert tables.published(spark, root, "a").count() == 2
    log = {(r.title, r.status, r.detail) for r in spark.read.parquet(f"{root}/_manifest").collect()}
    assert ("b", "FAILED", "no connection") in log and len(log) == 2


def test_a_build_that_dies_while_writing_leaves_the_version_before(spark, tmp_path):
    root = str(tmp_path / "pub")
    tables.publish(spark, {"a": lambda: spark.range(3)}, root)
    before = tables.published(spark, root, "a")
    dies = lambda: spark.range(0, 9, 1, 3).selectExpr("IF(id > 7, raise_error('lost'), id) AS id")
    result = tables.publish(spark, {"a": dies}, root).first()
    assert result.status == "FAILED"
    assert tables.published(spark, root, "a").count() == before.count() == 3
    with pytest.raises(ValueError, match="not published: b"):
        tables.published(spark, root, "b")


def test_intermediate_tables_use_the_session_folder(spark):
    assert scratch_root(spark) == spark.conf.get("spark.checkpoint.dir")
    table = cut_lineage(spark.range(5), "t")
    assert all(scratch_root(spark) in f for f in table.inputFiles())


def test_only_intermediate_tables_are_discarded(spark, tmp_path):
    gone, stays = cut_lineage(spark.range(5), "gone"), cut_lineage(spark.range(7), "stays")
    discard(gone)
    assert stays.count() == 7
    assert not any(os.path.exists(f.removeprefix("file://")) for f in gone.inputFiles())
    spark.range(3).write.parquet(str(tmp_path / "own"))
    with pytest.raises(ValueError):
        discard(spark.read.parquet(str(tmp_path / "own")))
    assert spark.read.parquet(str(tmp_path / "own")).count() == 3


@pytest.mark.parametrize("height,width", [(3966, 3517), (1, 1)])
def test_tiles_cover_the_grid(height, width):
    grid = Grid(0, 0, 10, height, width)
    assert (grid.tile_rows - 1) * 256 < height <= grid.tile_rows * 256
    assert (grid.tile_cols - 1) * 256 < width <= grid.tile_cols * 256


def test_projected_layer_returns_to_lonlat(spark):
    boxes = spatial.box_polygons(training_areas(spark))
    back = spatial.unproject_polygons(spatial.project_polygons(boxes))
    both = boxes.select("desc", F.col("ring").alias("a")).join(
        back.select("desc", F.col("ring").alias("b")), "desc"
    )
    shift = F.array_max(F.zip_with("a", "b", lambda p, q: F.abs(p["x"] - q["x"])))
    assert both.agg(F.max(shift)).first()[0] < 1e-8


def test_boundary_lines_as_geojson(spark):
    arcs = spark.createDataFrame(
        [(3, [{"x": 1.0, "y": 2.0}, {"x": 3.0, "y": 4.0}])],
        "class_id INT, points ARRAY<STRUCT<x: DOUBLE, y: DOUBLE>>",
    )
    feature = json.loads(vector.lines_to_geojson(arcs).first().value)
    assert feature["properties"] == {"class_id": 3}
    assert feature["geometry"] == {"type": "LineString", "coordinates": [[1.0, 2.0], [3.0, 4.0]]}


def test_window_scan_without_tile_size_keeps_all_rows(spark, tmp_path):
    grid = Grid(0, 0, 10, 100, 100, tile=64)
    pixels = grid.cells(spark).select("row", "col", F.lit(1.0).alias("v"))
    raster.write_raster(pixels, grid, str(tmp_path / "r"))
    assert raster.read_raster(spark, str(tmp_path / "r"), ["v"], (60, 70, 60, 70)).count() == 100


def test_holes_and_parts_of_a_geojson_layer(spark):
    def box(a, b):
        return [[a, a], [b, a], [b, b], [a, b], [a, a]]

    shapes = {"Polygon": [box(0, 60), box(20, 40)], "MultiPolygon": [[box(0, 60), box(20, 40)], [box(70, 90)]]}
    lines = [
        (json.dumps({"type": "Feature", "properties": {"class": t, "class_id": 1}, "geometry": {"type": t, "coordinates": c}}),)
        for t, c in shapes.items()
    ]
    layer = vector.from_geojson(spark.createDataFrame(lines, "value STRING"))
    grid = Grid(0, 100, 10, 10, 10)
    hits = spatial.label_pixels(grid.cells(spark), layer.select("class", "class_id", "ring"), grid)
    found = {r["class"]: r["count"] for r in hits.groupBy("class").count().collect()}
    assert found == {"Polygon": 36 - 4, "MultiPolygon": 36 - 4 + 4}


def test_collections_are_scanned_in_parts(spark, tmp_path):
    """The same rows from one and from many splits, holes and parts included."""
    box = lambda x, y, d: [[x, y], [x + d, y], [x + d, y + d], [x, y + d], [x, y]]
    features = [
        {
            "type": "Feature",
            "properties": {"class": "Urban", "class_id": k, "desc": 'a "quoted" {name}, [x]', "width_m": 1.0, "height_m": 2.0},
            "geometry": {"type": "MultiPolygon", "coordinates": [[box(k, 0, 1), box(k + 0.2, 0.2, 0.3)], [box(k, 5, 1)]]}
            if k % 2
            else {"type": "Polygon", "coordinates": [box(k, 0, 1), box(k + 0.2, 0.2, 0.3)]},
        }
        for k in range(300)
    ]
    for indent in (None, 1):
        folder = tmp_path / f"layer{indent}"
        folder.mkdir()
        (folder / "a.geojson").write_text(json.dumps({"type": "FeatureCollection", "name": "x", "features": features}, indent=indent))
        whole = sorted(map(str, vector.read_geojson(spark, str(folder)).collect()))
        spark.conf.set("spark.sql.files.maxPartitionBytes", "8k")
        try:
            parts = vector.scan_geojson(spark, str(folder))
            assert parts.rdd.getNumPartitions() > 4
            assert sorted(map(str, parts.collect())) == whole and len(whole) == 300
        finally:
            spark.conf.unset("spark.sql.files.maxPartitionBytes")
    (tmp_path / "odd.geojson").write_text('{"type": "FeatureCollection", "features": [{"geometry": null, "type": "Feature"}]}')
    with pytest.raises(Exception, match="does not start with its type"):
        vector.scan_geojson(spark, str(tmp_path / "odd.geojson")).collect()


def test_reference_grid_of_the_study_area(spark):
    tile = Grid(x0=399960.0, y0=3800040.0, res=10.0, height=10980, width=10980)
    box = "named_struct('west', -112.5D, 'south', 33.2D, 'east', -111.7D, 'north', 33.7D) AS bbox"
    scenes = spark.range(1).selectExpr("'a' AS scene_id", box)
    far = spark.range(1).selectExpr("'far'", box.replace("-112.5D", "-100D").replace("-111.7D", "-99D"))
    found = catalog.reference_grids(scenes.union(far), tile).collect()
    assert [(r.scene_id, r.x0, r.y0, r.height, r.width) for r in found] == [("a", 399960.0, 3729900.0, 3966, 3517)]
    assert 0.33 < found[0].coverage < 0.34  # 47 % of the width, 70 % of the height


def test_boxes_are_projected_in_many_tasks(spark):
    scenes = fixtures.scenes(spark, "/root/testdata/sf0.001").coalesce(1)
    boxes = catalog.projected_boxes(scenes)
    assert boxes.rdd.getNumPartitions() == int(spark.conf.get("spark.sql.shuffle.partitions"))
    assert "transform" not in boxes._jdf.queryExecution().optimizedPlan().toString()  # once for each box, in batches
    odd = "named_struct('west', {}, 'south', {}, 'east', -111.7D, 'north', 33.7D) AS bbox"
    rows = [("whole", "-112.5D", "33.2D"), ("half", "CAST(NULL AS DOUBLE)", "33.2D"), ("wrong", "double('NaN')", "33.2D"),
            ("none", "CAST(NULL AS DOUBLE)", "CAST(NULL AS DOUBLE)")]
    few = [spark.range(2).selectExpr(f"'{k}' AS scene_id", odd.format(w, s)) for k, w, s in rows]
    got = {(r.scene_id, *(None if v is None else round(v) for v in r[1:] if v == v)) for r in catalog.projected_boxes(reduce(DataFrame.union, few)).collect()}
    # the eastern side alone is left of a box without its west; what is not a number is the greatest
    assert got == {("whole", 360187, 3673678, 435130, 3729903), ("half", 434756, 3673678, 435130, 3729113),
                   ("wrong", 434756, 3673678), ("none", None, None, None, None)}
