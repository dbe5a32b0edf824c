"""Boundary lines of a class raster, simplified with shared edges kept shared (AGG19).

A boundary is cut into arcs at the points where three or more areas meet and where it passes from one
tile to the next; these points never move.  An arc separates exactly two classes and is simplified once, so
neighbouring areas keep a common edge.  Arcs never leave their tile, so a task handles one tile.
"""

from __future__ import annotations

import math

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pixelquery.functions.geodesy import point
from pixelquery.grid import Grid
from pixelquery.operators.focal import halo
from pixelquery.schema import SIMPLIFY_TOLERANCE_M

_ARC_SCHEMA = (
    "tile_row INT, tile_col INT, class_a INT, class_b INT, length DOUBLE, "
    "xs ARRAY<DOUBLE>, ys ARRAY<DOUBLE>"
)
OUTSIDE = -1  # nodata or beyond the grid, on one side of an arc


def douglas_peucker(points: np.ndarray, tolerance: float) -> np.ndarray:
    """Indices kept when simplifying a line; both ends stay."""
    keep = np.zeros(len(points), bool)
    keep[[0, -1]] = True
    stack = [(0, len(points) - 1)]
    while stack:
        first, last = stack.pop()
        if last - first < 2:
            continue
        start, chord = points[first], points[last] - points[first]
        offsets = points[first + 1 : last] - start
        squared = float(chord @ chord)
        if squared == 0.0:
            distance = np.hypot(offsets[:, 0], offsets[:, 1])
        else:
            share = np.clip(offsets @ chord / squared, 0.0, 1.0)[:, None]
            rest = offsets - share * chord
            distance = np.hypot(rest[:, 0], rest[:, 1])
        far = int(distance.argmax())
        if distance[far] > tolerance:
            middle = first + 1 + far
            keep[middle] = True
            stack += [(first, middle), (middle, last)]
    return np.flatnonzero(keep)


def simplified_lines(points: np.ndarray, first: np.ndarray, last: np.ndarray, tolerance: float) -> np.ndarray:
    """Which points stay when many lines are simplified together, each as by ``douglas_peucker``.

    Line i has the points ``first[i]`` to ``last[i]``, after those of the line before.  All stretches still to
    be looked at take a step at once, so short lines cost no loop of their own.
    """
    keep = np.zeros(len(points), bool)
    keep[first] = keep[last] = True
    while True:
        long = last - first >= 2
        first, last = first[long], last[long]
        if not len(first):
            return keep
        inner = last - first - 1
        starts = inner.cumsum() - inner
        of = np.repeat(np.arange(len(first)), inner)
        at = np.arange(len(of)) + (first + 1 - starts)[of]
        chord, offsets = points[last] - points[first], points[at] - points[first][of]
        squared = (chord**2).sum(1)
        along = (offsets * chord[of]).sum(1)
        share = np.clip(along / np.where(squared == 0.0, 1.0, squared)[of], 0.0, 1.0)[:, None]
        rest = offsets - share * chord[of]
        distance = np.hypot(rest[:, 0], rest[:, 1])
        most = np.maximum.reduceat(distance, starts)
        hits = np.flatnonzero(distance == most[of])
        far = at[hits[np.searchsorted(of[hits], np.arange(len(first)))]]
        bent = most > tolerance
        first, far, last = first[bent], far[bent], last[bent]
        keep[far] = True
        first, last = np.append(first, far), np.append(far, last)
        order = np.argsort(first, kind="stable")
        first, last = first[order], last[order]


def trace_arcs(framed: np.ndarray, owns_bottom: bool, owns_right: bool):
    """Arcs of one tile as ``(class_a, class_b, corner list)`` in tile corner coordinates.

    ``framed`` holds the tile with one cell of its surroundings on every side.  A tile owns its upper
    and left edges; the lower and right ones only where the grid ends.
    """
    height, width = framed.shape[0] - 2, framed.shape[1] - 2
    segments: dict[tuple[int, int], list] = {}

    def add(p, q, one, other):
        pair = (min(one, other), max(one, other))
        segments.setdefault(p, []).append((q, pair))
        segments.setdefault(q, []).append((p, pair))

    inner_rows = framed[:, 1:-1]
    for r, c in np.argwhere(inner_rows[:-1] != inner_rows[1:]).tolist():
        if r < height or owns_bottom:
            add((r, c), (r, c + 1), int(inner_rows[r, c]), int(inner_rows[r + 1, c]))
    inner_cols = framed[1:-1, :]
    for r, c in np.argwhere(inner_cols[:, :-1] != inner_cols[:, 1:]).tolist():
        if c < width or owns_right:
            add((r, c), (r + 1, c), int(inner_cols[r, c]), int(inner_cols[r, c + 1]))

    # lines meeting at each corner, from the four cells around it, so that edges owned by a
    # neighbour tile count too
    nw, ne, sw, se = framed[:-1, :-1], framed[:-1, 1:], framed[1:, :-1], framed[1:, 1:]
    degree = ((nw != ne).astype(int) + (sw != se) + (nw != sw) + (ne != se)).tolist()

    def fixed(p) -> bool:
        own = segments[p]
        return (
            degree[p[0]][p[1]] != 2
            or len(own) != 2
            or own[0][1] != own[1][1]
            or (p[0] in (0, height) and p[1] in (0, width))
        )

    used = set()

    def walk(start, step, pair):
        line = [start, step]
        used.add((min(start, step), max(start, step)))
        while line[-1] != start and not fixed(line[-1]):
            here, before = line[-1], line[-2]
            ahead = next(q for q, _ in segments[here] if q != before)
            used.add((min(here, ahead), max(here, ahead)))
            line.append(ahead)
        return (*pair, line)

    # arcs between fixed points first; what is left are closed rings
    ordered = sorted(segments)
    for start in [p for p in ordered if fixed(p)] + ordered:
        for step, pair in segments[start]:
            if (min(start, step), max(start, step)) not in used:
                yield walk(start, step, pair)


def _tile_arcs(grid: Grid, tolerance: float):
    def simplify(key: tuple, pdf: pd.DataFrame) -> pd.DataFrame:
        tile_row, tile_col = int(key[0]), int(key[1])
        top, left = tile_row * grid.tile, tile_col * grid.tile
        height, width = min(grid.tile, grid.height - top), min(grid.tile, grid.width - left)
        framed = np.full((height + 2, width + 2), OUTSIDE, np.int64)
        row, col = pdf["row"].to_numpy(), pdf["col"].to_numpy()
        # mirrored copies beyond the grid do not count as neighbours
        real = pdf["class_id"].notna().to_numpy() & (row >= 0) & (col >= 0)
        real &= (row < grid.height) & (col < grid.width)
        framed[row[real] - top + 1, col[real] - left + 1] = pdf["class_id"].to_numpy()[real]
        out = []
        for one, other, line in trace_arcs(
            framed, top + height == grid.height, left + width == grid.width
        ):
            points = [
                (grid.x0 + (c + left) * grid.res, grid.y0 - (r + top) * grid.res) for r, c in line
            ]
            if len(points) > 2:
                array = np.array(points)
                points = array[douglas_peucker(array, tolerance)].tolist()
            xs, ys = zip(*points, strict=True)
            length = sum(map(math.dist, points, points[1:]))
            out.append((tile_row, tile_col, one, other, length, xs, ys))
        return pd.DataFrame(
            out, columns=["tile_row", "tile_col", "class_a", "class_b", "length", "xs", "ys"]
        )

    return simplify


def boundary_arcs(
    pred: DataFrame,
    grid: Grid,
    tolerance: float = SIMPLIFY_TOLERANCE_M,
    column: str = "class_id",
) -> DataFrame:
    """Simplified arcs with the classes on both sides; -1 stands for nodata or the outside."""
    cells = halo(pred.select("row", "col", F.col(column).alias("class_id")), grid, 1)
    arcs = cells.groupBy("tile_row", "tile_col").applyInPandas(
        _tile_arcs(grid, tolerance), _ARC_SCHEMA
    )
    return arcs.withColumn("points", F.zip_with("xs", "ys", point)).drop("xs", "ys")


def class_boundaries(arcs: DataFrame) -> DataFrame:
    """Arcs listed under each class they bound: the simplified dissolved layer, one line per row."""
    sides = F.explode(F.array("class_a", "class_b"))
    return arcs.select(
        sides.alias("class_id"), "tile_row", "tile_col", "length", "points"
    ).where(F.col("class_id") != OUTSIDE)
