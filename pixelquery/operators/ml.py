"""Training and scoring of land-cover classifiers (ML1-8, WIN7)."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.ml.feature import SQLTransformer, StringIndexer
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from pixelquery.operators import ensembles
from pixelquery.operators.ensembles import Boosting, Forest, TreeModel
from pixelquery.operators.metrics import overall_scores, pair_counts
from pixelquery.schema import BAND_NAMES, RANDOM_STATE
from pixelquery.session import cut_lineage, discard

RANDOM_FOREST = "Random Forest"
GRADIENT_BOOSTING = "Gradient Boosting"
LABEL = "label"


# labels and split ---------------------------------------------------------------------------
def encode_labels(df: DataFrame, column: str = "class") -> DataFrame:
    """Class names to 0..k-1 in alphabetical order."""
    indexer = StringIndexer(
        inputCol=column, outputCol=LABEL, stringOrderType="alphabetAsc"
    ).fit(df)
    return indexer.transform(df)


def _split_key(keys: Sequence[str], seed: int):
    return F.md5(F.concat_ws(",", *[F.col(k).cast("string") for k in keys], F.lit(str(seed))))


def stratified_split(
    df: DataFrame,
    label: str = LABEL,
    keys: Sequence[str] = ("row", "col"),
    seed: int = RANDOM_STATE,
) -> DataFrame:
    """Add ``split``: 70 % train, 15 % validation, 15 % test of every class, to the row.

    Rows are ordered by a hash of their key, and each class is cut at two ranks.  The two cut
    hashes are found by counting (class, hash prefix) and ranking only the rows that share a
    prefix with a cut, so a class holding most of the table is never sorted as a whole; assigning
    the rows is then a comparison of hashes.
    """
    hashed = df.withColumn("_h", _split_key(keys, seed)).withColumn("_p", F.substring("_h", 1, 4))
    prefixes = hashed.groupBy(label, "_p").agg(F.count("*").alias("_n"))
    # at most 65536 prefixes per class
    by_class = Window.partitionBy(label)
    prefixes = prefixes.withColumns(
        {
            "_all": F.sum("_n").over(by_class),
            "_upto": F.sum("_n").over(
                by_class.orderBy("_p").rowsBetween(Window.unboundedPreceding, 0)
            ),
        }
    )
    train = F.floor(F.col("_all") * 0.7 + 0.5)
    held = F.col("_all") - train
    cuts = F.array(
        F.struct(F.lit("train").alias("cut"), train.alias("rank")),
        F.struct(
            F.lit("validation").alias("cut"), (train + F.floor(held / 2.0)).alias("rank")
        ),
    )
    wanted = (
        prefixes.select(label, "_p", "_n", "_upto", F.inline(cuts))
        .where("rank > _upto - _n AND rank <= _upto")
        .select(label, "_p", "cut", (F.expr("rank - (_upto - _n)")).alias("_k"))
    )
    in_prefix = Window.partitionBy(label, "_p", "cut").orderBy("_h")
    last_rows = (
        hashed.select(label, "_h", "_p")
        .join(F.broadcast(wanted), [label, "_p"])  # two rows per class
        .withColumn("_i", F.row_number().over(in_prefix))
        .where("_i = _k")
        .groupBy(label)
        .agg(
            F.max(F.when(F.col("cut") == "train", F.col("_h"))).alias("_train"),
            F.max(F.when(F.col("cut") == "validation", F.col("_h"))).alias("_valid"),
        )
    )
    split = (
        F.when(F.col(label).isNull(), None)  # nothing to learn or to test
        .when(F.col("_h") <= F.col("_train"), "train")
        .when(F.col("_h") <= F.col("_valid"), "validation")
        .otherwise("test")
    )
    return (
        hashed.join(F.broadcast(last_rows), label, "left")  # one row per class
        .withColumn("split", split)
        .drop("_h", "_p", "_train", "_valid")
    )


# scaling ------------------------------------------------------------------------------------
def fit_scaler(train: DataFrame, features: Sequence[str] = tuple(BAND_NAMES)) -> SQLTransformer:
    """Standardise by the training mean and population std, as a persistable MLlib stage.

    A constant feature is only centred.
    """
    row = train.agg(
        *[F.avg(f).alias(f"m_{f}") for f in features],
        *[F.stddev_pop(f).alias(f"s_{f}") for f in features],
    ).first()
    scaled = ", ".join(
        f"(`{f}` - {row[f'm_{f}']!r}D) / {(row[f's_{f}'] or 1.0)!r}D AS `z_{f}`" for f in features
    )
    return SQLTransformer(statement=f"SELECT *, {scaled} FROM __THIS__")


# models -------------------------------------------------------------------------------------
def random_forest(trees: int = 200, depth: int = 20, seed: int = RANDOM_STATE) -> Forest:
    return Forest(trees=trees, depth=depth, seed=seed)


def gradient_boosting(iterations: int = 200, depth: int = 6, seed: int = RANDOM_STATE) -> Boosting:
    return Boosting(rounds=iterations, depth=depth, seed=seed)


def fit(
    train: DataFrame,
    estimator: Forest | Boosting,
    features: Sequence[str] = tuple(BAND_NAMES),
    keys: Sequence[str] = ("row", "col"),
) -> TreeModel:
    """Fit an ensemble with equally weighted classes; the result can be saved.

    The rows are evaluated once and stored.  Bands are not scaled first: cuts between quantiles are the
    same cuts after any scaling (``fit_scaler`` is there for other models).
    """
    stored = cut_lineage(train, "fitting")
    model = ensembles.fit(stored, estimator, features, LABEL, keys)
    discard(stored)
    return model


def feature_importances(model: TreeModel, features: Sequence[str]) -> dict[str, float]:
    """Importance by feature name."""
    shares = model.importances()
    return {f: shares[f] for f in features}


def importance_table(spark, rf: dict[str, float], gb: dict[str, float]) -> DataFrame:
    return spark.createDataFrame(
        [(f, rf[f], gb[f]) for f in rf], "feature STRING, rf DOUBLE, gb DOUBLE"
    )


def scores(
    models: dict[str, TreeModel], stack: DataFrame, features: Sequence[str] = tuple(BAND_NAMES), keep: Sequence[str] = ()
) -> DataFrame:
    """Classes of every pixel by some models, a column each, next to the columns to ``keep``, in one scan.

    Pixels whose bands are not all valid keep a NULL class: they pass through with their bands zero-filled and
    the class removed afterwards, so the scene is neither split nor joined back.
    """
    keys = [c for c in ("tile_row", "tile_col", "row", "col") if c in stack.columns]
    valid = F.lit(True)
    for f in features:
        valid = valid & F.col(f).isNotNull()
    scored = stack.select(
        *keys, *keep, valid.alias("_valid"), *[F.coalesce(F.col(f), F.lit(0.0)).alias(f) for f in features]
    )
    for i, model in enumerate(models.values()):
        scored = model.transform(scored, f"_class_{i}")
    classes = [F.when(F.col("_valid"), F.col(f"_class_{i}").cast("int")).alias(name) for i, name in enumerate(models)]
    return scored.select(*keys, *keep, *classes)


def score(
    model: TreeModel, stack: DataFrame, features: Sequence[str] = tuple(BAND_NAMES)
) -> DataFrame:
    """Class of every pixel whose bands are all valid; the others keep a NULL class."""
    return scores({"class_id": model}, stack, features)


def evaluate(models: dict[str, TreeModel], data: DataFrame) -> DataFrame:
    """Accuracy, weighted F1 and kappa, one row per model."""
    pairs = None
    for name, model in models.items():
        scored = model.transform(data).select(F.lit(name).alias("model"), LABEL, "prediction")
        counts = pair_counts(scored, LABEL, "prediction", ["model"])
        pairs = counts if pairs is None else pairs.unionByName(counts)
    return overall_scores(pairs, ["model"])
