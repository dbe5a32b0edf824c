"""Connected regions of equal class, and their dissolve (AGG17-18).

Regions are found in three steps, none of which needs a whole region in one place:

1. each tile labels its own patches (one shuffle; a task sees one tile at a time) and hands on only
   patch totals and the patches along its four sides;
2. sides of neighbouring tiles are matched, which gives a graph of patches that continue across a
   tile border; it is contracted by repeated hooking and pointer jumping, written out each round;
3. patch totals are summed per region.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pixelquery.grid import Grid
from pixelquery.operators.classify import with_class_names
from pixelquery.operators.focal import by_tile
from pixelquery.session import cut_lineage

_TILE_SCHEMA = (
    "patch BIGINT, class_id INT, pixels BIGINT, min_row INT, max_row INT, min_col INT, "
    "max_col INT, edges BIGINT, side STRING, at_row INT, at_col INT"
)


def label_patches(classes: np.ndarray) -> np.ndarray:
    """4-connected patches of one tile; -1 is nodata.  Labels are the lowest flat index inside."""
    height, width = classes.shape
    flat = np.arange(height * width).reshape(height, width)
    starts = np.ones((height, width), bool)
    starts[:, 1:] = classes[:, 1:] != classes[:, :-1]
    # horizontal runs, numbered in reading order, then joined vertically
    run = np.cumsum(starts).reshape(height, width) - 1
    same = (classes[1:] == classes[:-1]) & (classes[1:] >= 0)
    upper, lower = run[:-1][same], run[1:][same]
    parent = np.arange(run[-1, -1] + 1)
    while True:
        a, b = parent[upper], parent[lower]
        low, high = np.minimum(a, b), np.maximum(a, b)
        apart = low != high
        if not apart.any():
            break
        np.minimum.at(parent, high[apart], low[apart])
        while True:
            jumped = parent[parent]
            if (jumped == parent).all():
                break
            parent = jumped
    return np.where(classes >= 0, flat[starts][parent[run]], -1)


def _tile_summary(grid: Grid):
    """Task body: one tile's pixels to its patch totals and side rows."""

    def summarise(key: tuple, pdf: pd.DataFrame) -> pd.DataFrame:
        top, left = int(key[0]) * grid.tile, int(key[1]) * grid.tile
        height, width = min(grid.tile, grid.height - top), min(grid.tile, grid.width - left)
        classes = np.full((height, width), -1, np.int64)
        valid = pdf["class_id"].notna().to_numpy()
        r = pdf["row"].to_numpy()[valid] - top
        c = pdf["col"].to_numpy()[valid] - left
        classes[r, c] = pdf["class_id"].to_numpy()[valid].astype(np.int64)
        local = label_patches(classes)
        # sides facing another class, nodata, or the outside of the tile
        framed = np.pad(classes, 1, constant_values=-1)
        core = framed[1:-1, 1:-1]
        edges = (
            (framed[:-2, 1:-1] != core).astype(np.int64)
            + (framed[2:, 1:-1] != core)
            + (framed[1:-1, :-2] != core)
            + (framed[1:-1, 2:] != core)
        )
        rows, cols = np.nonzero(classes >= 0)
        labels = local[rows, cols]
        # the patch id is the raster-wide index of its first pixel in reading order
        ids = (labels // width + top) * grid.width + labels % width + left
        cells = pd.DataFrame(
            {"patch": ids, "class_id": classes[rows, cols], "row": rows + top, "col": cols + left}
        )
        order = np.argsort(ids, kind="stable")
        first = np.flatnonzero(np.diff(ids[order], prepend=-1))
        row, col = cells["row"].to_numpy()[order], cells["col"].to_numpy()[order]

        def per_patch(reduce, values):
            return reduce.reduceat(values, first) if len(first) else values

        totals = pd.DataFrame(
            {
                "patch": ids[order][first],
                "class_id": cells["class_id"].to_numpy()[order][first],
                "pixels": np.diff(first, append=len(ids)),
                "min_row": per_patch(np.minimum, row),
                "max_row": per_patch(np.maximum, row),
                "min_col": per_patch(np.minimum, col),
                "max_col": per_patch(np.maximum, col),
                "edges": per_patch(np.add, edges[rows, cols][order]),
            }
        )
        parts = [totals]
        # a side row is keyed by the pixel below or right of the tile border it touches
        for side, at, shift_row, shift_col in (
            ("h", cells["row"] == top, 0, 0),
            ("h", cells["row"] == top + height - 1, 1, 0),
            ("v", cells["col"] == left, 0, 0),
            ("v", cells["col"] == left + width - 1, 0, 1),
        ):
            hit = cells[at]
            parts.append(
                pd.DataFrame(
                    {
                        "patch": hit["patch"],
                        "class_id": hit["class_id"],
                        "side": side,
                        "at_row": hit["row"] + shift_row,
                        "at_col": hit["col"] + shift_col,
                    }
                )
            )
        out = pd.concat(parts, ignore_index=True)
        integers = [n for n in out.columns if n != "side"]
        out[integers] = out[integers].astype("Int64")
        return out[[field.split()[0] for field in _TILE_SCHEMA.split(", ")]]

    return summarise


def tile_patches(pred: DataFrame, grid: Grid, column: str) -> DataFrame:
    cells = grid.with_tiles(pred.select("row", "col", F.col(column).alias("class_id")))
    return by_tile(cells, grid).groupBy("tile_row", "tile_col").applyInPandas(_tile_summary(grid), _TILE_SCHEMA)


def _jump(links: DataFrame) -> DataFrame:
    """Replace every parent by its own parent, marking the links that moved."""
    up = links.select(F.col("node").alias("parent"), F.col("parent").alias("_up"))
    return links.join(up, "parent", "left").select(
        "node",
        F.coalesce("_up", "parent").alias("parent"),
        F.col("_up").isNotNull().alias("moved"),
    )


def _jump_to_roots(links: DataFrame) -> DataFrame:
    """Follow ``node -> parent`` links (parent < node) until every node points at its root.

    The longest path halves every round.
    """
    links = cut_lineage(_jump(links), "links")
    while not links.where("moved").isEmpty():
        links = cut_lineage(_jump(links), "links")
    return links.drop("moved")


def _contracted(edges: DataFrame) -> DataFrame:
    """Each remaining edge once, smaller end first, without loops."""
    return (
        edges.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b"))
        .where("a < b")
        .distinct()
    )


def connected_roots(edges: DataFrame) -> DataFrame:
    """Smallest node of each connected component of an undirected graph ``a, b``.

    ``edges`` should be a stored table: it is read more than once.  Each round hooks every node to
    its smallest neighbour below it, flattens the resulting forest and contracts the graph.  The
    aggregate combines map-side and every join has one row per node on one side, so a hub with a
    third of all edges is split by the adaptive skew join.
    """
    edges = _contracted(edges)
    roots = edges.select(F.explode(F.array("a", "b")).alias("node")).distinct()
    roots = roots.withColumn("root", F.col("node"))
    while not edges.isEmpty():
        hooks = _jump_to_roots(
            edges.groupBy(F.col("b").alias("node")).agg(F.min("a").alias("parent"))
        )
        # composed lazily: one join per round, and the rounds grow with the log of the graph
        to_root = hooks.select(F.col("node").alias("root"), F.col("parent").alias("_up"))
        roots = roots.join(to_root, "root", "left").select(
            "node", F.coalesce("_up", "root").alias("root")
        )
        for end in ("a", "b"):
            moved = hooks.select(F.col("node").alias(end), F.col("parent").alias("_up"))
            edges = edges.join(moved, end, "left").withColumn(end, F.coalesce("_up", end))
            edges = edges.drop("_up")
        edges = cut_lineage(_contracted(edges), "edges")
    return roots


def patch_borders(tiles: DataFrame) -> DataFrame:
    """``a, b, sides``: patches of neighbouring tiles that are one region, and the pixel sides they share."""
    return (
        tiles.where("side IS NOT NULL")
        .groupBy("side", "at_row", "at_col", "class_id")
        .agg(F.min("patch").alias("a"), F.max("patch").alias("b"), F.count("*").alias("n"))
        .where("n = 2")
        .groupBy("a", "b")
        .agg(F.count("*").alias("sides"))
    )


def connected_regions(pred: DataFrame, grid: Grid, column: str = "class_id") -> DataFrame:
    """4-connected regions of equal class, nodata left out.

    ``region_id`` is the raster-wide index (row * width + col) of the region's first pixel; the
    perimeter is the length of pixel edges that face another class, nodata or the outside.
    """
    tiles = cut_lineage(tile_patches(pred, grid, column), "patches")
    totals = tiles.where("side IS NULL")
    borders = cut_lineage(patch_borders(tiles), "borders")
    roots = connected_roots(borders)
    # both sides of a matched border pair were counted as boundary inside their tiles
    inner = (
        borders.select(F.explode(F.array("a", "b")).alias("patch"), "sides")
        .groupBy("patch")
        .agg(F.sum("sides").alias("_inner"))
    )
    mapped = (
        totals.drop("side", "at_row", "at_col")
        .join(roots.withColumnRenamed("node", "patch"), "patch", "left")
        .join(inner, "patch", "left")
    )
    regions = mapped.groupBy(F.coalesce("root", "patch").alias("region_id"), "class_id").agg(
        F.sum("pixels").alias("pixels"),
        F.min("min_row").alias("min_row"),
        F.max("max_row").alias("max_row"),
        F.min("min_col").alias("min_col"),
        F.max("max_col").alias("max_col"),
        (F.sum(F.col("edges") - F.coalesce("_inner", F.lit(0))) * float(grid.res)).alias(
            "perimeter"
        ),
    )
    return with_class_names(regions)


def dissolve(regions: DataFrame) -> DataFrame:
    """One multi-part layer row per class: parts, pixels, extent and boundary length."""
    return regions.groupBy("class_id", "class_name").agg(
        F.count("*").alias("parts"),
        F.sum("pixels").alias("pixels"),
        F.min("min_row").alias("min_row"),
        F.max("max_row").alias("max_row"),
        F.min("min_col").alias("min_col"),
        F.max("max_col").alias("max_col"),
        F.sum("perimeter").alias("perimeter"),
    )
