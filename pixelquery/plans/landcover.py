"""The land-cover jobs end to end: features, training, scoring, correction and reports."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pixelquery.grid import Grid
from pixelquery.operators import classify, features, metrics, ml, spatial
from pixelquery.operators.ensembles import TreeModel
from pixelquery.schema import BAND_NAMES, training_areas
from pixelquery.session import cut_lineage
from pixelquery.sources import raster


def build_features(pixels: DataFrame, grid: Grid, path: str) -> DataFrame:
    """Compute the 29 bands once and store them by tile; later jobs read the stored stack."""
    raster.write_raster(features.feature_stack(pixels, grid), grid, path, clustered=True)
    return raster.read_raster(pixels.sparkSession, path, BAND_NAMES)


def training_set(stack: DataFrame, grid: Grid, areas: DataFrame | None = None) -> DataFrame:
    """Labelled rows of the training areas, encoded and split."""
    areas = training_areas(stack.sparkSession) if areas is None else areas
    polygons = spatial.project_polygons(spatial.box_polygons(areas))
    rows = spatial.training_table(stack, polygons, grid, keep=("row", "col"))
    # encoding and splitting read the rows several times; the spatial join should run once
    return ml.stratified_split(ml.encode_labels(cut_lineage(rows, "labelled")))


def train(
    rows: DataFrame, trees: int = 200, iterations: int = 200
) -> tuple[str, dict[str, TreeModel], DataFrame]:
    """Fit both models on the training split and pick the better one on validation."""
    fitting = rows.where("split = 'train'")
    models = {
        ml.RANDOM_FOREST: ml.fit(fitting, ml.random_forest(trees)),
        ml.GRADIENT_BOOSTING: ml.fit(fitting, ml.gradient_boosting(iterations)),
    }
    scores = ml.evaluate(models, rows.where("split = 'validation'"))
    best = metrics.best_model(scores, [ml.RANDOM_FOREST, ml.GRADIENT_BOOSTING]).first()["model"]
    return best, models, scores


def save_model(model: TreeModel, path: str) -> None:
    model.save(path)


def load_model(spark: SparkSession, path: str) -> TreeModel:
    return TreeModel.load(spark, path)


def classify_scene(
    model: TreeModel, stack: DataFrame, grid: Grid, mask: bool = True
) -> DataFrame:
    """Score every pixel and apply the water rule and, with ``mask``, the northern mask.

    Scoring and both rules are projections, so the whole job is one scan without a shuffle.
    """
    north = classify.north_by_row(classify.threshold_row(grid))
    pred = classify.water_rule(ml.score(model, stack), north)
    return classify.northern_mask(pred, north) if mask else pred


def summarise(spark: SparkSession, path: str, grid: Grid) -> DataFrame:
    """Area report of a stored class raster, always computed from the version it names."""
    return classify.area_table(raster.read_classes(spark, path), grid).orderBy(
        F.col("class_id") == -1, "class_id"
    )
