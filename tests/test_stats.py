import numpy as np
import pytest
from pixelquery.functions import reflectance as R
from pixelquery.operators import classify, metrics, ml, stats
from pixelquery.schema import CLASSES
from pyspark.sql import functions as F


@pytest.mark.parametrize("buckets", [2, 16, 1024])
def test_quantiles_are_exact_under_skew(spark, buckets):
    rng = np.random.default_rng(5)
    # a third of all values equal, a far outlier, negatives
    values = np.concatenate([np.full(400, 3.25), rng.normal(0, 1e-3, 800), [1e9, -7.5]])
    df = spark.createDataFrame([(float(v),) for v in values] + [(None,)] * 9, "v DOUBLE")
    probs = [0.0, 0.02, 0.25, 0.5, 0.98, 1.0]
    got = stats.exact_quantiles(df, ["v"], probs, buckets)["v"]
    assert np.allclose(got, np.percentile(values, [100 * p for p in probs]), rtol=1e-12, atol=0)


def test_quantiles_of_nothing(spark):
    df = spark.createDataFrame([(None, 4.0)], "a DOUBLE, b DOUBLE")
    assert stats.exact_quantiles(df, ["a", "b"], [0.5]) == {"a": [None], "b": [4.0]}
    stretched = stats.percentile_stretch(df, ["a", "b"]).first()
    assert (stretched.a, stretched.b) == (None, 0.0)


def test_band_statistics_ignore_nodata(spark):
    df = spark.createDataFrame([(1.0,), (3.0,), (None,), (None,)], "v DOUBLE")
    row = stats.band_statistics(df, ["v"]).first()
    assert (row.band, row.min, row.max, row.mean, row.std) == ("v", 1.0, 3.0, 2.0, 1.0)
    assert row.nodata_pct == 50.0


def test_null_rules_of_indices(spark):
    df = spark.createDataFrame(
        [(0.1, 0.2, 0.3, None, 0.5, 0.6), (0.1, 0.2, None, 0.4, 0.5, 0.6), (0.1, 0.0, 0.3, 0.4, 0.5, 0.6)],
        "b DOUBLE, g DOUBLE, r DOUBLE, n DOUBLE, s1 DOUBLE, s2 DOUBLE",
    )
    idx = R.spectral_indices(*[F.col(c) for c in ("b", "g", "r", "n", "s1", "s2")])
    no_nir, no_red, no_green = df.select(*[c.alias(n) for n, c in idx.items()]).collect()
    assert no_nir.NDVI == no_nir.NBI == no_nir.SWIRRatio == 0.0
    assert no_nir.SR is None  # valid denominator, missing numerator
    assert no_red.NDVI == 0.0 and no_red.NBI is None and no_red.RedGreen is None
    assert no_green.RedGreen == 0.0
    clipped = df.select(R.clip_evi(F.col("n") * 100).alias("v")).collect()
    assert [r.v for r in clipped] == [None, 2.0, 2.0]


def test_published_area_table(spark):
    """Published pixel counts of the study area give the published areas and shares."""
    from pixelquery import Grid

    counts = [585856, 5702244, 1176968, 1994577, 2278813, 2209958]
    ends = np.cumsum(counts).tolist()
    column = F.lit(len(counts) - 1)
    for cid in reversed(range(len(counts) - 1)):
        column = F.when(F.col("id") < ends[cid], cid).otherwise(column)
    pred = spark.range(ends[-1] + 6).select(
        F.when(F.col("id") < ends[-1], column).alias("class_id")
    )
    grid = Grid(399960, 3729900, 10, 3966, 3517)
    table = {r.class_id: r for r in classify.area_table(pred, grid).collect()}
    published = {
        0: (58.59, 4.2), 1: (570.22, 40.9), 2: (117.7, 8.4),
        3: (199.46, 14.3), 4: (227.88, 16.3), 5: (221.0, 15.8),
    }
    for cid, (km2, pct) in published.items():
        assert (table[cid].pixels, table[cid].area_km2, table[cid].pct) == (counts[cid], km2, pct)
    assert (table[-1].pixels, table[-1].area_km2) == (13948416, 1394.85)


def test_area_table_lists_absent_classes(spark):
    from pixelquery import Grid

    grid = Grid(0, 0, 10, 1, 2)
    pred = spark.createDataFrame([(None,), (None,)], "class_id INT")
    rows = classify.area_table(pred, grid).collect()
    assert len(rows) == len(CLASSES) + 1
    assert all(r.pixels == 0 and r.area_km2 == 0 for r in rows)


def test_masks_are_idempotent(spark):
    pred = spark.createDataFrame(
        [(0, 0, 5), (0, 1, 4), (0, 2, None), (5, 0, 5), (5, 1, 4)], "row INT, col INT, class_id INT"
    )
    north = classify.north_by_row(3)
    once = classify.northern_mask(pred, north)
    assert [r.class_id for r in once.orderBy("row", "col").collect()] == [1, 1, None, 5, 4]
    assert once.exceptAll(classify.northern_mask(once, north)).isEmpty()
    water = classify.water_rule(pred, north).orderBy("row", "col").collect()
    assert [r.class_id for r in water] == [1, 4, None, 5, 4]


def test_scores_against_hand_count(spark):
    pairs = [(0, 0)] * 4 + [(0, 1)] * 1 + [(1, 1)] * 3 + [(1, 2)] * 2
    df = spark.createDataFrame(pairs + [(1, None)], "y INT, p INT")
    counts = metrics.pair_counts(df, "y", "p")
    row = metrics.overall_scores(counts).first()
    assert row.accuracy == pytest.approx(0.7)
    expected = 0.5 * 0.4 + 0.5 * 0.4
    assert row.kappa == pytest.approx((0.7 - expected) / (1 - expected))
    f1 = [2 * 4 / (5 + 4), 2 * 3 / (5 + 4)]
    assert row.f1_weighted == pytest.approx(0.5 * f1[0] + 0.5 * f1[1])
    report = {r.class_id: r for r in metrics.class_report(counts).collect()}
    assert report[2].recall == report[2].precision == report[2].f1 == 0.0
    matrix = metrics.confusion_matrix(counts).collect()
    assert all(sum(r[f"p{i}"] for i in range(6)) == pytest.approx(1.0) for r in matrix)


def test_single_class_kappa_is_zero(spark):
    df = spark.createDataFrame([(1, 1)] * 3, "y INT, p INT")
    row = metrics.overall_scores(metrics.pair_counts(df, "y", "p")).first()
    assert (row.accuracy, row.kappa) == (1.0, 0.0)


def test_best_model_prefers_forest_on_ties(spark):
    scores = spark.createDataFrame(
        [(ml.GRADIENT_BOOSTING, 0.9), (ml.RANDOM_FOREST, 0.9)], "model STRING, f1_weighted DOUBLE"
    )
    best = metrics.best_model(scores, [ml.RANDOM_FOREST, ml.GRADIENT_BOOSTING]).first()
    assert best.model == ml.RANDOM_FOREST


def test_stratified_split_with_a_hot_class(spark):
    df = spark.range(4000).select(
        F.col("id").alias("row"),
        F.lit(0).alias("col"),
        F.when(F.col("id") < 3500, 0).when(F.col("id") < 3999, 1).otherwise(2).alias("label"),
    )
    split = ml.stratified_split(df)
    assert split.count() == 4000
    got = {(r.label, r.split): r["count"] for r in split.groupBy("label", "split").count().collect()}
    assert (got[0, "train"], got[0, "validation"], got[0, "test"]) == (2450, 525, 525)
    assert (got[1, "train"], got[1, "validation"], got[1, "test"]) == (349, 75, 75)
    assert got == {k: v for k, v in got.items() if k[0] != 2} | {(2, "train"): 1}
    again = ml.stratified_split(df)
    assert split.exceptAll(again).isEmpty()


def test_balanced_weights_sum_equally(spark):
    df = spark.createDataFrame([(0,)] * 6 + [(1,)] * 2, "label INT")
    sums = stats.balanced_weights(df, "label").groupBy("label").agg(F.sum("weight").alias("w"))
    assert {r.label: r.w for r in sums.collect()} == {0: pytest.approx(4), 1: pytest.approx(4)}
