"""Class rasters: rules, colours, area reports and accuracy (FLT4-6, PRJ24, PRJ29, PRJ32, AGG8-16)."""

from __future__ import annotations

from pyspark.sql import functions as F

from pixelquery import fixtures
from pixelquery.functions.geodesy import lonlat_to_utm
from pixelquery.operators import classify, metrics, stats
from pixelquery.queries import geodesy_sql
from pixelquery.queries.common import r, rounded, with_grid
from pixelquery.schema import CLASSES

QUERIES = {}
ORACLES = {}

_DIM = (
    "dim(class_id, class_name, red, green, blue) AS (VALUES "
    + ", ".join(f"({i}, '{n}', {c[0]}, {c[1]}, {c[2]})" for i, n, c, _ in CLASSES)
    + ")"
)
# northern zone: the upper half of the grid
_NORTH = "r < (SELECT h // 2 FROM size)"


def _classes(spark, sf_dir):
    return fixtures.classes(spark, sf_dir)


def _north(spark, sf_dir):
    return classify.north_by_row(fixtures.pixel_grid(spark, sf_dir).height // 2)


def _rule(operator):
    return lambda spark, sf_dir: operator(_classes(spark, sf_dir), _north(spark, sf_dir))


QUERIES["flt4_water_rule"] = _rule(classify.water_rule)
ORACLES["flt4_water_rule"] = with_grid(
    f"SELECT r AS row, c AS col, CASE WHEN {_NORTH} AND y_pred = 5 THEN 1 ELSE y_pred END "
    "AS class_id FROM grid"
)
QUERIES["flt5_northern_mask"] = _rule(classify.northern_mask)
ORACLES["flt5_northern_mask"] = with_grid(
    f"SELECT r AS row, c AS col, CASE WHEN {_NORTH} AND y_pred IN (4, 5) THEN 1 ELSE y_pred END "
    "AS class_id FROM grid"
)


def _by_latitude(spark, sf_dir):
    grid = fixtures.pixel_grid(spark, sf_dir)
    return classify.northern_mask(_classes(spark, sf_dir), classify.north_by_latitude(grid))


QUERIES["flt5_northern_mask_by_latitude"] = _by_latitude
ORACLES["flt5_northern_mask_by_latitude"] = with_grid(
    "SELECT r AS row, c AS col, CASE WHEN lat > 33.55 AND y_pred IN (4, 5) THEN 1 ELSE y_pred END "
    "AS class_id FROM ll",
    *geodesy_sql.inverse("grid", "x", "y", "ll"),
)

QUERIES["flt6_valid_pixels"] = lambda spark, sf_dir: classify.valid_pixels(_classes(spark, sf_dir))
ORACLES["flt6_valid_pixels"] = with_grid(
    "SELECT r AS row, c AS col, y_pred AS class_id FROM grid WHERE y_pred IS NOT NULL"
)


# addresses ------------------------------------------------------------------------------------
def _pixel_to_map(spark, sf_dir):
    grid = fixtures.pixel_grid(spark, sf_dir)
    px = fixtures.pixels(spark, sf_dir).select("row", "col")
    return px.select("row", "col", grid.x(F.col("col")).alias("x"), grid.y(F.col("row")).alias("y"))


QUERIES["prj24_pixel_to_map"] = _pixel_to_map
ORACLES["prj24_pixel_to_map"] = with_grid("SELECT r AS row, c AS col, x, y FROM grid")


def _map_to_pixel(spark, sf_dir):
    grid = fixtures.pixel_grid(spark, sf_dir)
    x, y = lonlat_to_utm(F.col("lon"), F.col("lat"))
    placed = fixtures.areas(spark, sf_dir).select("area_id", x.alias("x"), y.alias("y"))
    return placed.select(
        "area_id", grid.row_at(F.col("y")).alias("row"), grid.col_at(F.col("x")).alias("col")
    )


QUERIES["prj24_map_to_pixel"] = _map_to_pixel
ORACLES["prj24_map_to_pixel"] = with_grid(
    "SELECT area_id, "
    "CAST(greatest(0, least(h, trunc((3729900 - north) / 350))) AS INT) AS row, "
    "CAST(greatest(0, least(w, trunc((east - 399960) / 350))) AS INT) AS col FROM en, size",
    geodesy_sql.AREAS_CTE,
    *geodesy_sql.forward("areas", "lon", "lat", "en"),
)

QUERIES["prj29_colours"] = lambda spark, sf_dir: classify.colours(_classes(spark, sf_dir)).select(
    "row", "col", "red", "green", "blue"
)
ORACLES["prj29_colours"] = with_grid(
    "SELECT r AS row, c AS col, "
    + ", ".join(
        f"CASE WHEN y_pred IS NULL THEN 200 ELSE coalesce({b}, 0) END AS {b}"
        for b in ("red", "green", "blue")
    )
    + " FROM grid LEFT JOIN dim ON y_pred = class_id",
    _DIM,
)


def _pixel_area(spark, sf_dir):
    grid = fixtures.pixel_grid(spark, sf_dir)
    area = F.lit(grid.pixel_area_km2).cast("double")
    per_row = _classes(spark, sf_dir).groupBy("row").agg((F.count("*") * area).alias("area_km2"))
    return rounded(per_row, "area_km2")


QUERIES["prj32_pixel_area"] = _pixel_area
ORACLES["prj32_pixel_area"] = with_grid(
    f"SELECT r AS row, {r('count(*) * 0.1225')} AS area_km2 FROM grid GROUP BY r"
)

QUERIES["jon5_class_names"] = lambda spark, sf_dir: classify.with_class_names(
    _classes(spark, sf_dir)
)
ORACLES["jon5_class_names"] = with_grid(
    "SELECT r AS row, c AS col, y_pred AS class_id, class_name "
    "FROM grid LEFT JOIN dim ON y_pred = class_id",
    _DIM,
)


# area reports ---------------------------------------------------------------------------------
def _area(column_rule=None, source=_classes, **options):
    def query(spark, sf_dir):
        pred = source(spark, sf_dir)
        if column_rule:
            pred = column_rule(pred, _north(spark, sf_dir))
        return rounded(
            classify.area_table(pred, fixtures.pixel_grid(spark, sf_dir), **options),
            "area_km2",
            "pct",
        )

    return query


def _area_sql(pred: str, rounded_rows: bool) -> str:
    area, pct = "CAST(n AS DECIMAL(20,0)) * 0.1225", "coalesce(n * 100.0 / nullif(total, 0), 0)"
    if rounded_rows:
        area, pct = f"round({area}, 2)", f"round(CAST({pct} AS DOUBLE), 1)"
    rows = (
        f"cnt AS (SELECT coalesce(class_id, p) AS class_id, coalesce(class_name, 'Other') AS class_name, "
        f"CAST(count(p) AS BIGINT) AS n FROM dim FULL JOIN (SELECT p FROM (SELECT {pred} AS p FROM grid) "
        "WHERE p IS NOT NULL) ON p = class_id GROUP BY 1, 2), "
        f"rows_ AS (SELECT class_id, class_name, n AS pixels, {area} AS a, {pct} AS pct "
        "FROM cnt, (SELECT sum(n) AS total FROM cnt))"
    )
    return with_grid(
        f"SELECT class_id, class_name, pixels, {r('a')} AS area_km2, {r('pct')} AS pct FROM rows_ "
        f"UNION ALL SELECT -1, 'TOTAL', CAST(sum(pixels) AS BIGINT), {r('sum(a)')}, 100.0 FROM rows_",
        _DIM,
        rows,
    )


_MASKED = f"CASE WHEN {_NORTH} AND y_pred IN (4, 5) THEN 1 ELSE y_pred END"
QUERIES["agg9_area_table"] = lambda spark, sf_dir: _area()(spark, sf_dir).where("class_id >= 0")
ORACLES["agg9_area_table"] = (
    "SELECT * FROM (" + _area_sql("y_pred", True) + ") WHERE class_id >= 0"
)
QUERIES["agg10_area_total"] = lambda spark, sf_dir: _area()(spark, sf_dir).where("class_id < 0")
ORACLES["agg10_area_total"] = (
    "SELECT * FROM (" + _area_sql("y_pred", True) + ") WHERE class_id < 0"
)
QUERIES["set2_area_table_with_total"] = _area()
ORACLES["set2_area_table_with_total"] = _area_sql("y_pred", True)


def _with_other_ids(spark, sf_dir):
    """The class raster with an id that the class table lacks in every third row."""
    other = F.when((F.col("row") % 3 == 0) & F.col("class_id").isNotNull(), 7)
    return _classes(spark, sf_dir).withColumn("class_id", other.otherwise(F.col("class_id")))


_OTHER_SQL = "CASE WHEN r % 3 = 0 AND y_pred IS NOT NULL THEN 7 ELSE y_pred END"
QUERIES["agg10_area_with_other_ids"] = _area(source=_with_other_ids)
ORACLES["agg10_area_with_other_ids"] = _area_sql(_OTHER_SQL, True)
QUERIES["agg13_area_after_mask"] = _area(classify.northern_mask, rounded=False)
ORACLES["agg13_area_after_mask"] = _area_sql(_MASKED, False)


def _coverage(spark, sf_dir):
    return rounded(
        stats.prediction_coverage(_classes(spark, sf_dir)), "predicted_pct", "nodata_pct"
    )


QUERIES["agg8_prediction_coverage"] = _coverage
ORACLES["agg8_prediction_coverage"] = with_grid(
    "SELECT count(*) AS total, count(y_pred) AS predicted, count(*) - count(y_pred) AS nodata, "
    f"{r('100.0 * count(y_pred) / count(*)')} AS predicted_pct, "
    f"{r('100.0 * (count(*) - count(y_pred)) / count(*)')} AS nodata_pct FROM grid"
)


def _reclassified(spark, sf_dir):
    counts = classify.reclassified_counts(
        _classes(spark, sf_dir),
        _north(spark, sf_dir),
        [4, 5],
        fixtures.pixel_grid(spark, sf_dir),
    )
    return rounded(counts, "area_km2")


QUERIES["agg11_reclassified_counts"] = _reclassified
ORACLES["agg11_reclassified_counts"] = with_grid(
    f"SELECT y_pred AS from_class, 1 AS to_class, count(*) AS pixels, "
    f"{r('count(*) * 0.1225')} AS area_km2 FROM grid WHERE {_NORTH} AND y_pred IN (4, 5) "
    "GROUP BY y_pred"
)


def _zone(spark, sf_dir):
    north = _north(spark, sf_dir)
    masked = classify.northern_mask(_classes(spark, sf_dir), north)
    return rounded(classify.zone_counts(masked, north), "pct")


QUERIES["agg12_zone_counts"] = _zone
ORACLES["agg12_zone_counts"] = with_grid(
    f"SELECT z.class_id, class_name, pixels, {r('100.0 * pixels / total')} AS pct FROM "
    f"(SELECT {_MASKED} AS class_id, count(*) AS pixels, "
    f"CAST(sum(count(*)) OVER () AS BIGINT) AS total FROM grid WHERE {_NORTH} GROUP BY 1) z "
    "JOIN dim ON z.class_id = dim.class_id",
    _DIM,
)


def _class_order(spark, sf_dir):
    named = classify.with_class_names(classify.valid_pixels(_classes(spark, sf_dir)))
    counts = stats.class_distribution(named, "class_name")
    return rounded(stats.in_report_order(counts, "class_name"), "pct")


QUERIES["srt3_report_order"] = _class_order
ORACLES["srt3_report_order"] = with_grid(
    f"SELECT class_name, count(*) AS pixels, "
    f"{r('100.0 * count(*) / sum(count(*)) OVER ()')} AS pct "
    "FROM grid JOIN dim ON y_pred = class_id GROUP BY class_name",
    _DIM,
)


# accuracy -------------------------------------------------------------------------------------
def _pairs(spark, sf_dir):
    return metrics.pair_counts(fixtures.pixels(spark, sf_dir), "y_true", "y_pred")


_PAIRS = (
    "pairs AS (SELECT y_true AS label, y_pred AS prediction, count(*) AS n FROM grid "
    "WHERE y_true IS NOT NULL AND y_pred IS NOT NULL GROUP BY 1, 2)"
)
_PER_CLASS = (
    "sup AS (SELECT label AS class_id, sum(n) AS support, "
    "sum(CASE WHEN label = prediction THEN n ELSE 0 END) AS hits FROM pairs GROUP BY 1), "
    "prd AS (SELECT prediction AS class_id, sum(n) AS predicted FROM pairs GROUP BY 1), "
    "per AS (SELECT coalesce(sup.class_id, prd.class_id) AS class_id, coalesce(support, 0) AS "
    "support, coalesce(predicted, 0) AS predicted, coalesce(hits, 0) AS hits "
    "FROM sup FULL JOIN prd ON sup.class_id = prd.class_id), "
    "rep AS (SELECT *, coalesce(hits / nullif(predicted, 0), 0) AS prec, "
    "coalesce(hits / nullif(support, 0), 0) AS rec, "
    "coalesce(2.0 * hits / nullif(support + predicted, 0), 0) AS f1 FROM per)"
)
_MATRIX = [*[f"p{i}" for i, *_ in CLASSES], "p_other"]


def _other_pairs(spark, sf_dir):
    """Predictions in every third row are of an id that the class table lacks."""
    truth = fixtures.pixels(spark, sf_dir).select("row", "col", "y_true")
    pred = _with_other_ids(spark, sf_dir)
    return metrics.pair_counts(truth.join(pred, ["row", "col"]), "y_true", "class_id")


def _matrix_sql(pairs: str) -> str:
    ids = ", ".join(str(i) for i, *_ in CLASSES)
    cells = [(f"prediction = {i}", f"p{i}") for i, *_ in CLASSES] + [(f"prediction NOT IN ({ids})", "p_other")]
    shares = [r(f"sum(CASE WHEN {test} THEN n ELSE 0 END) / sum(n)") + f" AS {name}" for test, name in cells]
    return with_grid(f"SELECT label, {', '.join(shares)} FROM pairs GROUP BY label", pairs)



QUERIES["agg14_confusion_matrix"] = lambda spark, sf_dir: rounded(
    metrics.confusion_matrix(_pairs(spark, sf_dir)), *_MATRIX
)
ORACLES["agg14_confusion_matrix"] = _matrix_sql(_PAIRS)
QUERIES["agg14_confusion_with_other_ids"] = lambda spark, sf_dir: rounded(
    metrics.confusion_matrix(_other_pairs(spark, sf_dir)), *_MATRIX
)
ORACLES["agg14_confusion_with_other_ids"] = _matrix_sql(
    f"pairs AS (SELECT y_true AS label, {_OTHER_SQL} AS prediction, count(*) AS n FROM grid "
    "WHERE y_true IS NOT NULL AND y_pred IS NOT NULL GROUP BY 1, 2)"
)
QUERIES["agg15_overall_scores"] = lambda spark, sf_dir: rounded(
    metrics.overall_scores(_pairs(spark, sf_dir)), "accuracy", "f1_weighted", "kappa"
)
_SCORES = (
    "sc AS (SELECT CAST(sum(hits) AS DOUBLE) / sum(support) AS po, "
    "sum(f1 * support) / sum(support) AS f1w, CAST(sum(CAST(support AS DOUBLE) * predicted) AS "
    "DOUBLE) / (CAST(sum(support) AS DOUBLE) * CAST(sum(support) AS DOUBLE)) AS pe FROM rep)"
)
ORACLES["agg15_overall_scores"] = with_grid(
    f"SELECT {r('po')} AS accuracy, {r('f1w')} AS f1_weighted, "
    f"{r('coalesce((po - pe) / nullif(1 - pe, 0), 0)')} AS kappa FROM sc",
    _PAIRS,
    _PER_CLASS,
    _SCORES,
)
QUERIES["agg16_class_report"] = lambda spark, sf_dir: rounded(
    metrics.named_class_report(_pairs(spark, sf_dir)), "precision", "recall", "f1"
)
ORACLES["agg16_class_report"] = with_grid(
    f"SELECT rep.class_id, class_name, {r('prec')} AS precision, {r('rec')} AS recall, "
    f"{r('f1')} AS f1, CAST(support AS BIGINT) AS support "
    "FROM rep JOIN dim ON rep.class_id = dim.class_id",
    _DIM,
    _PAIRS,
    _PER_CLASS,
)
