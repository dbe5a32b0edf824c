"""Accuracy measures from label / prediction pairs (AGG14-16, SRT2, SRT4).

Every measure is derived from one grouped count of (label, prediction): the pixels are read once and
all further steps see at most classes x classes rows.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from pixelquery.operators.classify import with_class_names
from pixelquery.schema import CLASSES


def pair_counts(
    df: DataFrame, label: str, prediction: str, keys: Sequence[str] = ()
) -> DataFrame:
    """Counts per (label, prediction), separately per ``keys`` if given; NULLs are left out."""
    return (
        df.where(F.col(label).isNotNull() & F.col(prediction).isNotNull())
        .groupBy(
            *keys,
            F.col(label).cast("int").alias("label"),
            F.col(prediction).cast("int").alias("prediction"),
        )
        .agg(F.count("*").alias("n"))
    )


def confusion_matrix(pairs: DataFrame) -> DataFrame:
    """Row-normalised matrix: one row per label, one column ``p<id>`` per class.

    ``p_other`` is the share of predictions outside the class table, so that a row adds up to 1.
    """
    ids = [cid for cid, *_ in CLASSES]
    total = F.sum("n")
    cells = [
        (F.coalesce(F.sum(F.when(F.col("prediction") == i, F.col("n"))), F.lit(0)) / total).alias(
            f"p{i}"
        )
        for i in ids
    ]
    other = F.sum(F.when(~F.col("prediction").isin(ids), F.col("n")).otherwise(0)) / total
    return pairs.groupBy("label").agg(*cells, other.alias("p_other"))


def class_report(pairs: DataFrame, keys: Sequence[str] = ()) -> DataFrame:
    """Precision, recall, F1 and support per class; an undefined ratio counts as 0."""
    sides = F.array(
        F.struct(F.col("label").alias("class_id"), F.lit(True).alias("truth")),
        F.struct(F.col("prediction").alias("class_id"), F.lit(False).alias("truth")),
    )
    marginals = (
        pairs.select(
            *keys,
            "n",
            (F.col("label") == F.col("prediction")).alias("hit"),
            F.inline(sides),
        )
        .groupBy(*keys, "class_id")
        .agg(
            F.sum(F.when(F.col("truth"), F.col("n")).otherwise(0)).alias("support"),
            F.sum(F.when(~F.col("truth"), F.col("n")).otherwise(0)).alias("predicted"),
            F.sum(F.when(F.col("truth") & F.col("hit"), F.col("n")).otherwise(0)).alias("hits"),
        )
    )

    def ratio(num, den):
        return F.coalesce(F.try_divide(num.cast("double"), den), F.lit(0.0))

    hits, support, predicted = F.col("hits"), F.col("support"), F.col("predicted")
    return marginals.select(
        *keys,
        "class_id",
        ratio(hits, predicted).alias("precision"),
        ratio(hits, support).alias("recall"),
        ratio(hits * 2.0, support + predicted).alias("f1"),
        "support",
        "predicted",
        "hits",
    )


def named_class_report(pairs: DataFrame) -> DataFrame:
    """The per-class report with names taken in encoder order."""
    report = with_class_names(class_report(pairs))
    return report.select("class_id", "class_name", "precision", "recall", "f1", "support")


def overall_scores(pairs: DataFrame, keys: Sequence[str] = ()) -> DataFrame:
    """Accuracy, weighted F1 and Cohen's kappa."""
    report = class_report(pairs, keys)
    support, predicted = F.col("support").cast("double"), F.col("predicted").cast("double")
    sums = report.groupBy(*keys).agg(
        F.sum("support").cast("double").alias("n"),
        F.sum("hits").cast("double").alias("hits"),
        F.sum(F.col("f1") * support).alias("f1_sum"),
        F.sum(support * predicted).alias("chance"),
    )
    n = F.col("n")
    observed = F.try_divide(F.col("hits"), n)
    expected = F.try_divide(F.col("chance"), n * n)
    return sums.select(
        *keys,
        observed.alias("accuracy"),
        F.try_divide(F.col("f1_sum"), n).alias("f1_weighted"),
        F.coalesce(
            F.try_divide(observed - expected, F.lit(1.0) - expected), F.lit(0.0)
        ).alias("kappa"),
    )


def best_model(scores: DataFrame, preference: Sequence[str]) -> DataFrame:
    """The model with the highest weighted F1; earlier entries of ``preference`` win ties."""
    rank = -F.array_position(F.array(*[F.lit(m) for m in preference]), F.col("model"))
    key = F.struct(F.col("f1_weighted"), rank)
    return scores.agg(
        F.max_by("model", key).alias("model"), F.max("f1_weighted").alias("f1_weighted")
    )


def top_features(importances: DataFrame, n: int = 20) -> DataFrame:
    """Top features by the mean of two models' importances (columns ``rf``, ``gb``)."""
    mean = (F.col("rf") + F.col("gb")) / 2.0
    return (
        importances.withColumn("mean_importance", mean)
        .orderBy(F.desc("mean_importance"), "feature")
        .limit(n)
    )
