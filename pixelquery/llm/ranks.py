"""Ranks within groups without gathering any group in one task."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from pixelquery.session import cut_lineage


def ranked(df: DataFrame, by: list[str], order: list[str], rank: str = "rank") -> DataFrame:
    """Add ``rank``: the row's place, from 0, among the rows with equal ``by`` columns, in ``order``.

    Rows are range-sorted by ``by`` and ``order`` together, so one large group covers many tasks.  Each
    row stores its task and its place there; a table of one row per task and group holds how many rows
    of the group earlier tasks have.  Nulls are equal to one another and come first.  ``df`` is read
    twice (sampling, sorting), so it should be a stored table.  Column names ``_task``, ``_at``,
    ``_first``, ``_before`` and ``_n`` are used inside.
    """
    placed = cut_lineage(
        df.repartitionByRange(*by, *order)
        .sortWithinPartitions(*by, *order)
        .select("*", F.spark_partition_id().alias("_task"), F.monotonically_increasing_id().alias("_at")),
        "ranked",
    )
    counts = placed.groupBy("_task", *by).agg(F.count("*").alias("_n"), F.min("_at").alias("_first"))
    earlier = W.partitionBy(*by).orderBy("_task").rowsBetween(W.unboundedPreceding, -1)
    starts = counts.select(
        F.col("_task").alias("_of"),
        "_first",
        F.coalesce(F.sum("_n").over(earlier), F.lit(0)).alias("_before"),
        *[F.col(c).alias(f"_by{i}") for i, c in enumerate(by)],
    )
    same = reduce(
        lambda a, b: a & b,
        [F.col(c).eqNullSafe(F.col(f"_by{i}")) for i, c in enumerate(by)],
        F.col("_task") == F.col("_of"),
    )
    return placed.join(starts, same).select(
        *df.columns, (F.col("_before") + F.col("_at") - F.col("_first")).alias(rank)
    )
