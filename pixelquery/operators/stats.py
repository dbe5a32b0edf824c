"""Statistics over pixel tables (AGG1-8, AGG22-23) and exact percentiles (AGG2, AGG3, PRJ28)."""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Observation, Window
from pyspark.sql import functions as F

from pixelquery.functions.reflectance import clamp
from pixelquery.schema import KEY_FEATURES, REPORT_CLASS_ORDER
from pixelquery.session import cut_lineage, discard


def _long_form(df: DataFrame, key: str, columns: Sequence[str], measures) -> DataFrame:
    """One row per column with the given measures of it.

    The columns are unpivoted to (index, value) pairs ahead of the partial aggregation, which then
    keeps one small buffer per column.  A single wide aggregate over 29 columns generates a method
    too large for the JIT compiler and measured three times slower.
    """
    pairs = F.array(
        *[
            F.struct(F.lit(i).alias("i"), F.col(c).cast("double").alias("v"))
            for i, c in enumerate(columns)
        ]
    )
    per_column = (
        df.select(F.inline(pairs))
        .groupBy("i")
        .agg(*[m(F.col("v")).alias(name) for name, m in measures.items()])
    )
    names = F.array(*[F.lit(c) for c in columns])
    return per_column.select(F.get(names, F.col("i")).alias(key), *measures)


def _null_pct(c: Column) -> Column:
    return F.avg(F.when(c.isNull(), 100.0).otherwise(0.0))


def band_statistics(df: DataFrame, bands: Sequence[str]) -> DataFrame:
    """min, max, mean, population std and nodata % per band, nodata left out of the first four."""
    return _long_form(
        df,
        "band",
        bands,
        {
            "min": F.min,
            "max": F.max,
            "mean": F.avg,
            "std": F.stddev_pop,
            "nodata_pct": _null_pct,
        },
    )


def feature_statistics(df: DataFrame, features: Sequence[str]) -> DataFrame:
    """min, max, mean and sample std per training feature."""
    return _long_form(
        df,
        "feature",
        features,
        {"min": F.min, "max": F.max, "mean": F.avg, "std": F.stddev_samp},
    )


#: A rank is first looked for between the approximate quantiles this far from it on both sides.
MARGIN = 0.002


def _bracketed(
    df: DataFrame, columns: Sequence[str], probs: Sequence[float]
) -> tuple[dict, DataFrame, dict[tuple[str, int], tuple[float, float, int]], set[tuple[str, int]]]:
    """Counts and extremes, the stored values near the wanted ranks, the interval of each rank there with the
    values below it, and the ranks that are not there.

    Two scans of ``df``: one makes a quantile summary of bounded error in the tasks, one writes the values
    inside the brackets and, as an observation on the same job, counts those below.
    """
    shares = sorted({min(1.0, max(0.0, p + d)) for p in probs for d in (-MARGIN, MARGIN)})
    head = df.agg(
        *[f(c).alias(f"{f.__name__}|{c}") for c in columns for f in (F.count, F.min, F.max)],
        *[F.percentile_approx(F.col(c).cast("double"), shares, 10_000).alias(f"near|{c}") for c in columns],
    ).first()
    brackets: dict[tuple[str, float], tuple[float, float]] = {}
    for c in columns:
        if head[f"count|{c}"]:
            ends = {0.0: float(head[f"min|{c}"]), 1.0: float(head[f"max|{c}"])}
            at = dict(zip(shares, head[f"near|{c}"])) | ends
            for p in probs:
                brackets[c, p] = at[max(0.0, p - MARGIN)], at[min(1.0, p + MARGIN)]
    keys = sorted(brackets)
    below, entries, seen = [], [], Observation()
    for i, (c, p) in enumerate(keys):
        (low, high), v = brackets[c, p], F.col(c).cast("double")
        below += [F.count_if(v < low).alias(f"below{i}"), F.count_if((v >= low) & (v <= high)).alias(f"in{i}")]
        entries.append(F.when((v >= low) & (v <= high), F.struct(F.lit(i).alias("i"), v.alias("v"))))
    if not keys:
        return head.asDict(), df.sparkSession.range(0), {}, set()
    near = df.observe(seen, *below).select(F.explode(F.array(*entries)).alias("e")).where("e IS NOT NULL")
    near = cut_lineage(near.select("e.i", "e.v"), "near")
    counts, open_, missed = seen.get, {}, set()
    for i, (c, p) in enumerate(keys):
        n = head[f"count|{c}"]
        for rank in {math.floor((n - 1) * p), math.ceil((n - 1) * p)}:
            if counts[f"below{i}"] <= rank < counts[f"below{i}"] + counts[f"in{i}"]:
                open_[f"k{i}", rank] = (*brackets[c, p], counts[f"below{i}"])
            else:
                missed.add((c, rank))
    names = {f"k{i}": c for i, (c, _) in enumerate(keys)}
    one = near.select(*[F.when(F.col("i") == i, F.col("v")).alias(f"k{i}") for i in range(len(keys))])
    return head.asDict() | {"names": names}, one, open_, missed


def exact_quantiles(
    df: DataFrame, columns: Sequence[str], probs: Sequence[float], buckets: int = 1024
) -> dict[str, list[float | None]]:
    """Exact percentiles with linear interpolation, NULLs ignored, in two scans of ``df``.

    A quantile summary brackets each wanted rank, and the values inside the brackets (some thousandths of
    all) are stored with the numbers of values below.  A rank outside its bracket, as may be in small
    tables, is looked for among all values.
    """
    head, near, open_, missed = _bracketed(df, columns, probs)
    found = {(head["names"][i], rank): v for (i, rank), v in _narrowed(near, open_, buckets).items()}
    discard(near)
    whole = {(c, rank): (float(head[f"min|{c}"]), float(head[f"max|{c}"]), 0) for c, rank in missed}
    settled = found | _narrowed(df, whole, buckets)
    out: dict[str, list[float | None]] = {}
    for c in columns:
        n = head[f"count|{c}"]
        out[c] = []
        for p in probs:
            if not n:
                out[c].append(None)
                continue
            position = (n - 1) * p
            low, high = settled[c, math.floor(position)], settled[c, math.ceil(position)]
            out[c].append(low + (high - low) * (position - math.floor(position)))
    return out


def _narrowed(
    df: DataFrame, open_: dict[tuple[str, int], tuple[float, float, int]], buckets: int
) -> dict[tuple[str, int], float]:
    """The values of ranks, each known to lie in an interval of a column with so many values below.

    Each pass counts the values of the still open intervals in ``buckets`` equal parts and narrows
    every wanted rank to the one part that holds it; a part with a single distinct value settles its
    rank.  A pass is a map-side-combined aggregate that returns at most ``buckets`` rows per rank, so
    neither a task nor the driver ever holds the values themselves, however skewed they are.
    """
    settled: dict[tuple[str, int], float] = {}
    while open_:
        for key, (low, high, _) in list(open_.items()):
            if low == high:
                settled[key] = low
                del open_[key]
        intervals = sorted({(c, low, high) for (c, _), (low, high, _) in open_.items()})
        if not intervals:
            break
        entries = []
        for i, (c, low, high) in enumerate(intervals):
            v = F.col(c).cast("double")
            part = F.floor((v - low) / (high - low) * buckets).cast("int")
            entries.append(
                F.when(
                    (v >= low) & (v <= high),
                    F.struct(
                        F.lit(i).alias("i"),
                        F.least(part, F.lit(buckets - 1)).alias("part"),
                        v.alias("v"),
                    ),
                )
            )
        parts = (
            df.select(F.explode(F.array(*entries)).alias("e"))
            .where("e IS NOT NULL")
            .groupBy("e.i", "e.part")
            .agg(F.count("*").alias("n"), F.min("e.v").alias("low"), F.max("e.v").alias("high"))
            .collect()
        )
        by_interval: dict[int, list] = {}
        for r in sorted(parts, key=lambda r: (r["i"], r["part"])):
            by_interval.setdefault(r["i"], []).append(r)
        index = {interval: i for i, interval in enumerate(intervals)}
        for (c, rank), (low, high, below) in list(open_.items()):
            for r in by_interval[index[c, low, high]]:
                if rank < below + r["n"]:
                    open_[c, rank] = (r["low"], r["high"], below)
                    break
                below += r["n"]

    return settled


def exact_median(df: DataFrame, column: str) -> float | None:
    return exact_quantiles(df, [column], [0.5])[column][0]


def quantile_table(df: DataFrame, columns: Sequence[str], probs: dict[str, float]) -> DataFrame:
    """One row per column with a percentile per entry of ``probs``."""
    values = exact_quantiles(df, columns, list(probs.values()))
    fields = ", ".join(f"{name} DOUBLE" for name in probs)
    return df.sparkSession.createDataFrame(
        [(c, *values[c]) for c in columns], f"band STRING, {fields}"
    )


def percentile_stretch(
    df: DataFrame, columns: Sequence[str], low: float = 0.02, high: float = 0.98
) -> DataFrame:
    """Stretch each column linearly between two of its percentiles and clip to [0, 1]."""
    limits = exact_quantiles(df, columns, [low, high])
    stretched = {}
    for c in columns:
        lo, hi = limits[c]
        if lo is not None:
            stretched[c] = clamp((F.col(c) - lo) / max(hi - lo, 1e-6), 0.0, 1.0)
    return df.withColumns(stretched)


def class_distribution(df: DataFrame, label: str = "class") -> DataFrame:
    """Rows and share of the total per class."""
    counts = df.groupBy(label).agg(F.count("*").alias("pixels"))
    # the window sees one row per class
    total = F.sum("pixels").over(Window.partitionBy())
    return counts.withColumn("pct", F.col("pixels") * 100.0 / total)


def polygons_per_class(polygons: DataFrame) -> DataFrame:
    return polygons.groupBy("class").agg(F.count("*").alias("polygons"))


def class_feature_means(df: DataFrame, features: Sequence[str] = tuple(KEY_FEATURES)) -> DataFrame:
    """Mean of the key features per class; classes without rows do not appear."""
    return df.groupBy("class").agg(*[F.avg(f).alias(f) for f in features])


def prediction_coverage(pred: DataFrame, column: str = "class_id") -> DataFrame:
    """How many pixels carry a class and how many are nodata, with shares."""
    counts = pred.agg(
        F.count("*").alias("total"),
        F.count(column).alias("predicted"),
        F.count_if(F.col(column).isNull()).alias("nodata"),
    )
    return counts.withColumns(
        {
            "predicted_pct": F.try_divide(F.col("predicted") * 100.0, F.col("total")),
            "nodata_pct": F.try_divide(F.col("nodata") * 100.0, F.col("total")),
        }
    )


def balanced_weights(df: DataFrame, label: str) -> DataFrame:
    """Add ``weight = n / (k * n_c)`` so that every class counts the same in training.

    Counting first and joining the k class rows back avoids a window over a whole class; the join
    is a broadcast of one row per class, because a shuffle by label would send a class to one task.
    """
    counts = df.groupBy(label).agg(F.count("*").alias("_n_c"))
    whole = Window.partitionBy()
    weights = counts.select(
        label,
        (
            F.sum("_n_c").over(whole).cast("double")
            / (F.count("*").over(whole) * F.col("_n_c"))
        ).alias("weight"),
    )
    return df.join(F.broadcast(weights), label)


def distinct_classes(df: DataFrame, label: str = "class") -> DataFrame:
    return df.select(label).where(F.col(label).isNotNull()).distinct().orderBy(label)


def in_report_order(df: DataFrame, label: str = "class") -> DataFrame:
    """Sort a per-class table in the fixed order of the reports (SRT3)."""
    rank = F.array_position(F.array(*[F.lit(c) for c in REPORT_CLASS_ORDER]), F.col(label))
    return df.orderBy(rank, label)
