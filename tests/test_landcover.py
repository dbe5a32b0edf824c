"""The jobs end to end on the smallest tables."""

import pytest
from helpers import exchanges
from pixelquery import fixtures
from pixelquery.operators import ml, spatial
from pixelquery.plans import landcover
from pixelquery.sources import raster
from pyspark.sql import functions as F

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def scene(spark, tmp_path_factory):
    grid = fixtures.pixel_grid(spark, SF, tile=8)
    path = str(tmp_path_factory.mktemp("landcover") / "stack")
    return grid, landcover.build_features(fixtures.pixels(spark, SF), grid, path)


def test_stored_stack_is_whole(spark, scene):
    grid, stack = scene
    assert stack.count() == stack.select("row", "col").distinct().count() == grid.height * grid.width


def test_train_and_classify(spark, scene, tmp_path):
    grid, stack = scene
    areas = fixtures.areas(spark, SF).drop("area_id")
    rows = landcover.training_set(stack, grid, areas).cache()
    polygons = spatial.project_polygons(spatial.box_polygons(areas))
    assert rows.count() == spatial.training_table(stack, polygons, grid).count() > 100
    best, models, scores = landcover.train(rows, trees=3, iterations=2)
    assert best in models and scores.count() == 2

    model = models[ml.RANDOM_FOREST]
    landcover.save_model(model, str(tmp_path / "model"))
    model = landcover.load_model(spark, str(tmp_path / "model"))
    pred = landcover.classify_scene(model, stack, grid)
    assert exchanges(pred) == 0  # scoring and both rules stay in the scan stage
    path = str(tmp_path / "classes")
    raster.write_classes(pred, grid, path)
    table = landcover.summarise(spark, path, grid).collect()
    assert table[-1].class_name == "TOTAL"
    valid = stack.dropna("any").count()
    assert sum(r.pixels for r in table[:-1]) == table[-1].pixels == valid


def test_scaler_uses_population_std(spark):
    df = spark.createDataFrame([(1.0, 4.0), (3.0, 4.0)], "B02 DOUBLE, B03 DOUBLE")
    scaled = ml.fit_scaler(df, ["B02", "B03"]).transform(df).orderBy("B02")
    assert [(r.z_B02, r.z_B03) for r in scaled.collect()] == [(-1.0, 0.0), (1.0, 0.0)]


def test_importances_of_both_models(spark, scene):
    _, stack = scene
    features = ["B02", "B03"]
    df = stack.dropna("any").select("row", "col", *features, (F.col("row") % 2).cast("double").alias("label"))
    boosted = ml.fit(df, ml.gradient_boosting(1, 2), features)
    assert sum(ml.feature_importances(boosted, features).values()) == pytest.approx(1.0)
    forest = ml.feature_importances(ml.fit(df, ml.random_forest(2, 3), features), features)
    assert sum(forest.values()) == pytest.approx(1.0)
