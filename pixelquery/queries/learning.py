"""Training, evaluation and scoring (WIN7, ML1-8, AGG22, SRT2, SRT4)."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Window
from pyspark.sql import functions as F

from pixelquery import fixtures
from pixelquery.operators import classify, metrics, ml, stats
from pixelquery.queries import spectral, surface
from pixelquery.queries.classes import _DIM, _PER_CLASS
from pixelquery.queries.common import INDEX_CTE, r, rounded, with_grid
from pixelquery.schema import BAND_NAMES, SPECTRAL_BANDS
from pixelquery.session import cut_lineage

QUERIES = {}
ORACLES = {}

_LOWER = [b.lower() for b in SPECTRAL_BANDS]

# tables and models of a session, by kind and folder: all queries below read the same ones
_MADE = {}


def _once(kind, make, spark, sf_dir):
    key = spark.sparkContext.applicationId, sf_dir, kind
    if key not in _MADE:
        _MADE[key] = make(spark, sf_dir)
    return _MADE[key]


def _labelled(spark, sf_dir):
    return fixtures.pixels(spark, sf_dir).withColumn(ml.LABEL, F.col("y_true").cast("double"))


_SPLIT = (
    "ranked AS (SELECT *, row_number() OVER (PARTITION BY y_true ORDER BY "
    "md5(r || ',' || c || ',42')) AS i, count(*) OVER (PARTITION BY y_true) AS n_c FROM idx), "
    "cut AS (SELECT *, floor(n_c * 0.7 + 0.5) AS n_train FROM ranked), "
    "split AS (SELECT *, CASE WHEN i <= n_train THEN 'train' "
    "WHEN i <= n_train + floor((n_c - n_train) / 2.0) THEN 'validation' ELSE 'test' END AS part "
    "FROM cut)"
)


def _split(spark, sf_dir):
    return ml.stratified_split(_labelled(spark, sf_dir)).select("row", "col", "y_true", "split")


QUERIES["win7_stratified_split"] = _split
ORACLES["win7_stratified_split"] = with_grid(
    "SELECT r AS row, c AS col, y_true, part AS split FROM split", INDEX_CTE, _SPLIT
)


def _encoded(spark, sf_dir):
    named = classify.with_class_names(fixtures.pixels(spark, sf_dir), "y_true")
    return ml.encode_labels(named, "class_name").select("row", "col", "class_name", ml.LABEL)


QUERIES["ml1_encode_labels"] = _encoded
ORACLES["ml1_encode_labels"] = with_grid(
    "SELECT r AS row, c AS col, g.class_name, CAST(code AS DOUBLE) AS label FROM "
    "(SELECT r, c, class_name FROM grid JOIN dim ON y_true = class_id) g JOIN "
    "(SELECT class_name, row_number() OVER (ORDER BY class_name) - 1 AS code FROM "
    "(SELECT DISTINCT class_name FROM grid JOIN dim ON y_true = class_id)) e "
    "ON g.class_name = e.class_name",
    _DIM,
)


def _standardised(spark, sf_dir):
    px = spectral.reflectances(spark, sf_dir).select("row", "col", "y_true", *SPECTRAL_BANDS)
    parts = ml.stratified_split(px, "y_true")
    scaler = ml.fit_scaler(parts.where("split = 'train'"), SPECTRAL_BANDS)
    columns = [f"z_{b}" for b in SPECTRAL_BANDS]
    return rounded(scaler.transform(parts).select("row", "col", *columns), *columns)


QUERIES["ml2_standardise"] = _standardised
ORACLES["ml2_standardise"] = with_grid(
    "SELECT r AS row, c AS col, "
    + ", ".join(f"{r(f'({b} - m_{b}) / s_{b}')} AS z_{b.upper()}" for b in _LOWER)
    + " FROM split, fitted",
    INDEX_CTE,
    _SPLIT,
    "fitted AS (SELECT "
    + ", ".join(f"avg({b}) AS m_{b}, stddev_pop({b}) AS s_{b}" for b in _LOWER)
    + " FROM split WHERE part = 'train')",
)


def _weights(spark, sf_dir):
    px = fixtures.pixels(spark, sf_dir).select("row", "col", "y_true")
    return rounded(stats.balanced_weights(px, "y_true"), "weight")


QUERIES["agg22_balanced_weights"] = _weights
ORACLES["agg22_balanced_weights"] = with_grid(
    f"SELECT r AS row, c AS col, y_true, {r('n / (k_ * n_c)')} AS weight FROM "
    "(SELECT r, c, y_true, CAST(count(*) OVER () AS DOUBLE) AS n, "
    "count(*) OVER (PARTITION BY y_true) AS n_c FROM grid), "
    "(SELECT count(DISTINCT y_true) AS k_ FROM grid)"
)


# models ---------------------------------------------------------------------------------------
def scene_stack(spark, sf_dir):
    """The stored 29 bands with the true class."""
    return _once("stack", lambda s, d: cut_lineage(surface.stack(s, d, "y_true"), "stack"), spark, sf_dir)


def land_class(clean: bool = False):
    """The class to learn: a rule on five bands, wrong for every 20th pixel unless ``clean``."""
    rule = (
        F.when(F.col("B08") < 0.12, 5).when(F.col("B04") >= 0.2, 0).when(F.col("B11") >= 0.28, 1)
        .when(F.col("Elevation") > 500, 2).when(F.col("B03") >= 0.14, 3).otherwise(4)
    )
    return rule if clean else F.when((F.col("row") * 100 + F.col("col")) % 20 == 7, (rule + 1) % 6).otherwise(rule)


_RULE = (
    "CASE WHEN B08 < 0.12 THEN 5 WHEN B04 >= 0.2 THEN 0 WHEN B11 >= 0.28 THEN 1 "
    "WHEN Elevation > 500 THEN 2 WHEN B03 >= 0.14 THEN 3 ELSE 4 END"
)
_VALID = " AND ".join(f"{b} IS NOT NULL" for b in BAND_NAMES)
_LEARNING_CTES = (
    *surface.STACK_CTES,
    f"ruled AS (SELECT r, c, {_RULE} AS rule FROM stack WHERE {_VALID})",
    "idx2 AS (SELECT r, c, rule, CASE WHEN (r * 100 + c) % 20 = 7 THEN (rule + 1) % 6 ELSE rule END AS label FROM ruled)",
    "ranked AS (SELECT *, row_number() OVER (PARTITION BY label ORDER BY "
    "md5(r || ',' || c || ',42')) AS i, count(*) OVER (PARTITION BY label) AS n_c FROM idx2)",
    "cut AS (SELECT *, floor(n_c * 0.7 + 0.5) AS n_train FROM ranked)",
    "split AS (SELECT *, CASE WHEN i <= n_train THEN 'train' "
    "WHEN i <= n_train + floor((n_c - n_train) / 2.0) THEN 'validation' ELSE 'test' END AS part FROM cut)",
)


def _split_rows(spark, sf_dir):
    px = scene_stack(spark, sf_dir).dropna("any", subset=BAND_NAMES)
    px = px.withColumn(ml.LABEL, land_class().cast("double"))
    return cut_lineage(ml.stratified_split(px.select("row", "col", ml.LABEL, *BAND_NAMES)), "training")


def learning_rows(spark, sf_dir):
    """Pixels with all 29 bands valid, label and split; stored."""
    return _once("rows", _split_rows, spark, sf_dir)


def _fitted(estimator, spark, sf_dir):
    return ml.fit(learning_rows(spark, sf_dir).where("split = 'train'"), estimator)


def forest(spark, sf_dir):
    """The forest of the operator's defaults, fitted once a session on all labelled rows and bands."""
    return _once("forest", lambda s, d: _fitted(ml.random_forest(), s, d), spark, sf_dir)


def boosting(spark, sf_dir):
    """The boosted ensemble of the operator's defaults, fitted once a session on all labelled rows and bands."""
    return _once("boosting", lambda s, d: _fitted(ml.gradient_boosting(), s, d), spark, sf_dir)


def small_forest(spark, sf_dir):
    """A forest for what does not depend on the quality of a model."""
    return _once("small", lambda s, d: _fitted(ml.random_forest(3, 6), s, d), spark, sf_dir)


def _recalled(model):
    def query(spark, sf_dir):
        """Test rows of each label, and whether the model finds three quarters of them."""
        rows = learning_rows(spark, sf_dir).where("split = 'test'")
        scored = model(spark, sf_dir).transform(rows)
        hit = (F.col("prediction") == F.col(ml.LABEL)).cast("double")
        return scored.groupBy(F.col(ml.LABEL).cast("int").alias("label")).agg(
            F.count("*").alias("test_rows"), (F.avg(hit) >= 0.75).alias("recalled")
        )

    return query


QUERIES["ml3_random_forest"] = _recalled(forest)
QUERIES["ml4_gradient_boosting"] = _recalled(boosting)
ORACLES["ml3_random_forest"] = ORACLES["ml4_gradient_boosting"] = with_grid(
    "SELECT label, count(*) AS test_rows, true AS recalled FROM split WHERE part = 'test' GROUP BY label",
    *_LEARNING_CTES,
)


def _both(spark, sf_dir):
    return {ml.RANDOM_FOREST: forest(spark, sf_dir), ml.GRADIENT_BOOSTING: boosting(spark, sf_dir)}


def evaluations(spark, sf_dir):
    """Scores of both models on validation and test rows."""
    rows = learning_rows(spark, sf_dir)
    models = _both(spark, sf_dir)
    scores = None
    for part in ("validation", "test"):
        one = ml.evaluate(models, rows.where(F.col("split") == part))
        one = one.select(F.lit(part).alias("split"), "*")
        scores = one if scores is None else scores.unionByName(one)
    return scores


def _evaluated(spark, sf_dir):
    """Whether each model's accuracy is a quarter above the share of the largest class, and the others as good."""
    rows = learning_rows(spark, sf_dir).groupBy("split", ml.LABEL).count()
    share = rows.groupBy("split").agg(F.sum("count").alias("rows"), (F.max("count") / F.sum("count")).alias("most"))
    scores = evaluations(spark, sf_dir).join(share, "split")
    return scores.select(
        "split", "model", "rows", (F.col("accuracy") >= F.col("most") + 0.25).alias("above_majority"),
        (F.col("f1_weighted") >= 0.85).alias("f1_high"), (F.col("kappa") >= 0.8).alias("kappa_high"),
    )


QUERIES["ml5_evaluate"] = _evaluated
ORACLES["ml5_evaluate"] = with_grid(
    "SELECT part AS split, model, count(*) AS rows, true AS above_majority, true AS f1_high, true AS kappa_high "
    f"FROM split, (VALUES ('{ml.RANDOM_FOREST}'), ('{ml.GRADIENT_BOOSTING}')) AS models(model) "
    "WHERE part <> 'train' GROUP BY part, model",
    *_LEARNING_CTES,
)


def _selected(spark, sf_dir):
    """Whether the model chosen has the best validation score of all, and how many rows decide."""
    rows = learning_rows(spark, sf_dir).where("split = 'validation'")
    scores = ml.evaluate(_both(spark, sf_dir), rows)
    best = metrics.best_model(scores, [ml.RANDOM_FOREST, ml.GRADIENT_BOOSTING])
    held = scores.select("model", F.col("f1_weighted").alias("own")).join(best, "model")
    return held.select(
        F.lit(rows.count()).alias("rows"), (F.col("own") == F.col("f1_weighted")).alias("best"), (F.col("own") >= 0.85).alias("f1_high")
    )


QUERIES["ml6_model_selection"] = _selected
ORACLES["ml6_model_selection"] = with_grid(
    "SELECT count(*) AS rows, true AS best, true AS f1_high FROM split WHERE part = 'validation'", *_LEARNING_CTES
)


def _scene_agreement(spark, sf_dir):
    """All pixels by the class of the rule, those without a score apart, and whether the scores agree with it."""
    stack = scene_stack(spark, sf_dir)
    valid = reduce(lambda a, b: a & b, [F.col(b).isNotNull() for b in BAND_NAMES])
    ruled = stack.withColumn("rule", F.when(valid, land_class(clean=True)))
    both = ml.scores({"class_id": forest(spark, sf_dir)}, ruled, keep=["rule"]).dropna("any", subset=["row", "col"])
    agrees = F.col("rule").eqNullSafe(F.col("class_id")).cast("double")
    return both.groupBy("rule").agg(F.count("*").alias("pixels"), (F.avg(agrees) >= 0.85).alias("agrees"))


QUERIES["ml7_score_scene"] = _scene_agreement
ORACLES["ml7_score_scene"] = with_grid(
    f"SELECT CASE WHEN {_VALID} THEN {_RULE} END AS rule, count(*) AS pixels, true AS agrees FROM stack GROUP BY 1",
    *surface.STACK_CTES,
)


def importances(spark, sf_dir):
    """The features by mean importance of both models."""
    shares = [ml.feature_importances(m, BAND_NAMES) for m in _both(spark, sf_dir).values()]
    return metrics.top_features(ml.importance_table(spark, *shares), len(BAND_NAMES))


def _importances(spark, sf_dir):
    """Of each feature, whether the forest and the boosting use it, and whether boosting ranks it among its five best."""
    table = importances(spark, sf_dir)
    place = F.rank().over(Window.orderBy(F.desc("gb")))  # one row for each of 29 bands
    return table.select("feature", (F.col("rf") > 0).alias("used"), (place <= 5).alias("decides"))


QUERIES["ml8_feature_importances"] = _importances
ORACLES["ml8_feature_importances"] = (
    "SELECT feature, true AS used, feature IN ('B03', 'B04', 'B08', 'B11', 'Elevation') AS decides FROM (VALUES "
    + ", ".join(f"('{b}')" for b in BAND_NAMES)
    + ") AS bands(feature)"
)


def _masked_coverage(spark, sf_dir):
    """Which pixels a model scores: exactly those with all bands valid."""
    scored = ml.score(small_forest(spark, sf_dir), scene_stack(spark, sf_dir))
    return scored.select("row", "col", F.col("class_id").isNotNull().alias("scored"))


QUERIES["flt2_scored_pixels"] = _masked_coverage
ORACLES["flt2_scored_pixels"] = with_grid(
    f"SELECT r AS row, c AS col, {_VALID} AS scored FROM stack",
    *surface.STACK_CTES,
)


# rankings over measures taken from the data ---------------------------------------------------
_RANKED = [*BAND_NAMES, "x", "y"]


def _ranked_features(spark, sf_dir):
    """Rank features by their correlation with the label and with the elevation."""
    px = surface.stack(spark, sf_dir, "x", "y", "y_true").where("y_true IS NOT NULL")
    pairs = F.array(
        *[F.struct(F.lit(f).alias("feature"), F.col(f).alias("v")) for f in _RANKED]
    )
    long = px.select("y_true", F.col("B11").alias("b"), F.inline(pairs))
    table = long.groupBy("feature").agg(
        F.abs(F.corr("v", F.col("y_true").cast("double"))).alias("rf"),
        F.abs(F.corr("v", "b")).alias("gb"),
    )
    return rounded(metrics.top_features(table), "rf", "gb", "mean_importance")


QUERIES["srt2_top_features"] = _ranked_features
ORACLES["srt2_top_features"] = with_grid(
    f"SELECT feature, {r('rf')} AS rf, {r('gb')} AS gb, {r('(rf + gb) / 2')} AS mean_importance "
    "FROM imp ORDER BY (rf + gb) / 2 DESC, feature LIMIT 20",
    *surface.STACK_CTES[:-1],
    surface.STACK_CTES[-1].replace("stack AS (", "stack AS MATERIALIZED (", 1),
    "imp AS ("
    + " UNION ALL ".join(
        f"SELECT '{f}' AS feature, abs(corr({f}, y_true)) AS rf, abs(corr({f}, B11)) AS gb FROM stack"
        for f in _RANKED
    )
    + ")",
)


def _best(spark, sf_dir):
    """Two class maps against the truth: the prediction, and the prediction without water."""
    px = fixtures.pixels(spark, sf_dir)
    dry = F.when(F.col("y_pred") == 5, 1).otherwise(F.col("y_pred"))
    both = F.array(
        F.struct(F.lit("Random Forest").alias("model"), F.col("y_pred").alias("p")),
        F.struct(F.lit("Gradient Boosting").alias("model"), dry.alias("p")),
    )
    pairs = metrics.pair_counts(
        px.select("y_true", F.inline(both)), "y_true", "p", ["model"]
    )
    best = metrics.best_model(
        metrics.overall_scores(pairs, ["model"]), [ml.RANDOM_FOREST, ml.GRADIENT_BOOSTING]
    )
    return rounded(best, "f1_weighted")


QUERIES["srt4_best_model"] = _best


def _f1(name: str, prediction: str) -> str:
    ctes = (
        "pairs AS (SELECT y_true AS label, "
        f"{prediction} AS prediction, count(*) AS n FROM grid WHERE y_pred IS NOT NULL "
        f"GROUP BY 1, 2), {_PER_CLASS}"
    )
    return (
        f"(WITH {ctes} SELECT '{name}' AS model, sum(f1 * support) / sum(support) AS f1 FROM rep)"
    )


ORACLES["srt4_best_model"] = with_grid(
    f"SELECT model, {r('f1')} AS f1_weighted FROM ("
    + _f1("Random Forest", "y_pred")
    + " UNION ALL "
    + _f1("Gradient Boosting", "CASE WHEN y_pred = 5 THEN 1 ELSE y_pred END")
    + ") ORDER BY f1 DESC, model DESC LIMIT 1"
)
