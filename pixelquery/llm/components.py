"""Connected components of a graph whose edges are spread over the cluster."""

from __future__ import annotations

import math
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pixelquery.session import cut_lineage, discard

#: Edges that one task contracts at first.
SHARE = 100_000


def stars(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The same components with one edge per node, to the smallest node that the edges join it to."""
    nodes, number = np.unique(np.concatenate([a, b]), return_inverse=True)
    u, v = number[: len(a)], number[len(a) :]
    label = np.arange(len(nodes))
    while True:
        least = label.copy()
        low = np.minimum(label[u], label[v])
        for end in (u, v, label[u], label[v]):
            np.minimum.at(least, end, low)
        least = least[least]
        if (least == label).all():
            break
        label = least
    hung = np.flatnonzero(label != np.arange(len(nodes)))
    return nodes[hung], nodes[label[hung]]


def _forest(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    parts = [(b.column("a").to_numpy(), b.column("b").to_numpy()) for b in batches if b.num_rows]
    if parts:
        yield pa.RecordBatch.from_arrays(list(map(pa.array, stars(*map(np.concatenate, zip(*parts))))), ["a", "b"])


def _mark(edges: DataFrame) -> tuple:
    return tuple(edges.agg(F.count("*"), F.bit_xor(F.xxhash64("a", "b"))).first())


def _towards(pairs: DataFrame, least: DataFrame) -> DataFrame:
    return pairs.join(least, "u").select("u", "v", "m")


def roots(edges: DataFrame) -> DataFrame:
    """``a, b`` (longs) to ``node, root``: the smallest node of its component, for all nodes with an edge.

    Each round hangs every neighbour of a node on the smallest one, first those above the node, then
    those below; rounds go on until all nodes hang on their root, about the logarithm of the longest
    path.  Before that, tasks of ``SHARE`` edges each contract what they hold, so that a dense part costs
    no more rows than a tree in every round.  A node with many neighbours is met by one row, so its neighbours can be split over tasks.
    Every round is stored in the shared folder and the one before is deleted.  Loops and repeated edges are allowed.
    """
    given = cut_lineage(edges.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")), "edges")
    tasks = max(1, math.ceil(given.count() / SHARE))
    now = cut_lineage(given.repartition(tasks).mapInArrow(_forest, "a BIGINT, b BIGINT").distinct(), "edges")
    discard(given)
    before, mark = None, _mark(now)
    while mark != before:
        both = now.select(F.col("a").alias("u"), F.col("b").alias("v")).union(
            now.select(F.col("b").alias("u"), F.col("a").alias("v"))
        )
        least = both.groupBy("u").agg(F.min("v").alias("w")).select("u", F.least("u", "w").alias("m"))
        up = _towards(both.where("v > u"), least).select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        up = cut_lineage(up, "edges")
        least = up.groupBy("u").agg(F.min("v").alias("m"))
        down = _towards(up, least)
        hung = down.select(F.col("v").alias("a"), F.col("m").alias("b")).union(down.select(F.col("u").alias("a"), F.col("m").alias("b")))
        last, now = now, cut_lineage(hung.where("a <> b").distinct(), "edges")
        discard(last, up)
        before, mark = mark, _mark(now)
    root = now.select(F.col("a").alias("node"), F.col("b").alias("root"))
    return root.union(now.select(F.col("b").alias("node"), F.col("b").alias("root")).distinct())
