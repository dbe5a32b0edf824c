"""Neighbourhood operators over the pixel grid (WIN1-6).

A moving window crosses tile borders, so every tile is first handed the few pixels around it that
its windows can reach (the halo).  All passes then run inside one tile: one shuffle by tile, a sort
along rows and a sort along columns, whatever the number of windows.  A tile is at most
``(tile + 2 * radius) ** 2`` rows, so no task grows with the raster.
"""

from __future__ import annotations

import math
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from pixelquery.grid import Grid


def along(axis: str):
    """Window over one pixel row or column of a tile; satisfied by the shuffle by tile."""
    line, position = ("row", "col") if axis == "row" else ("col", "row")
    return Window.partitionBy("tile_row", "tile_col", line).orderBy(position)



@dataclass(frozen=True)
class LocalStats:
    """Mean and population standard deviation of ``value`` over ``size`` x ``size`` pixels.

    ``value`` may not be NULL.  Give ``mean`` and / or ``std`` the output names wanted.
    """

    value: str
    size: int
    mean: str | None = None
    std: str | None = None


@dataclass(frozen=True)
class Derivatives:
    """First and second derivatives of the surface ``value``; adds zx, zy, zxx, zxy, zyy."""

    value: str
    cellsize: float = 10.0


def _mirrored(position: Column, extent: int, radius: int) -> Column:
    """Positions in ``[-radius, extent + radius)`` that repeat this one (WIN4).

    The edge is included in the reflection: ``-1`` repeats 0, ``-2`` repeats 1, and so on.
    """
    if extent >= 2 * radius:
        return (
            F.when(position < radius, F.array(position, -position - 1))
            .when(
                position >= extent - radius, F.array(position, F.lit(2 * extent - 1) - position)
            )
            .otherwise(F.array(position))
        )
    # the window is wider than the raster: reflect back and forth
    periods = math.ceil((radius + extent) / (2 * extent))
    images = []
    for k in range(-periods, periods + 1):
        images += [position + 2 * extent * k, F.lit(2 * extent * k - 1) - position]
    return F.filter(F.array(*images), lambda p: (p >= -radius) & (p < extent + radius))


def mirror_pad(df: DataFrame, grid: Grid, radius: int) -> DataFrame:
    """The raster with a border of ``radius`` mirrored pixels on every side."""
    values = [c for c in df.columns if c not in ("row", "col")]
    rows = df.select(
        F.explode(_mirrored(F.col("row"), grid.height, radius)).alias("row"), "col", *values
    )
    return rows.select(
        "row", F.explode(_mirrored(F.col("col"), grid.width, radius)).alias("col"), *values
    )


def _reached_tiles(position: Column, grid: Grid, tiles: int, radius: int) -> Column:
    return F.sequence(
        F.greatest(F.lit(0), grid.tile_of(position - radius)),
        F.least(F.lit(tiles - 1), grid.tile_of(position + radius)),
    )


def by_tile(df: DataFrame, grid: Grid) -> DataFrame:
    """Shuffle whole tiles together.

    The partition count is fixed: tile work is heavy per byte, and merging partitions by their size
    alone would leave executors idle.
    """
    wanted = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return df.repartition(min(wanted, grid.tile_rows * grid.tile_cols), "tile_row", "tile_col")


def halo(df: DataFrame, grid: Grid, radius: int) -> DataFrame:
    """Copy each pixel to every tile whose windows reach it, and shuffle by tile.

    ``row`` and ``col`` become positions that may lie outside the grid (mirror images).  Nearly every
    pixel yields one row; the copies add about ``4 * radius / tile`` to the volume.
    """
    pixels = mirror_pad(df.drop("tile_row", "tile_col"), grid, radius)
    rows_of = _reached_tiles(F.col("row"), grid, grid.tile_rows, radius)
    cols_of = _reached_tiles(F.col("col"), grid, grid.tile_cols, radius)
    copies = pixels.select(F.explode(rows_of).alias("tile_row"), "*")
    copies = copies.select(F.explode(cols_of).alias("tile_col"), "*")
    return by_tile(copies, grid)


def in_tile(axis: str, grid: Grid) -> Column:
    """True for positions that belong to the tile itself, not to its halo."""
    tile, position = F.col(f"tile_{axis}"), F.col(axis)
    extent = grid.height if axis == "row" else grid.width
    return (
        (position >= tile * grid.tile)
        & (position < (tile + 1) * grid.tile)
        & (position >= 0)
        & (position < extent)
    )


def _complete(axis: str, grid: Grid, radius: int) -> Column:
    """True where a line of the tile goes on without a gap, from one end of the halo to the other.

    Windows count rows, so a missing or repeated pixel would shift all that follow; it is an error.
    """
    line = "row" if axis == "col" else "col"
    window, tile, position = along(line), F.col(f"tile_{axis}"), F.col(axis)
    extent = grid.height if axis == "row" else grid.width
    first = tile * grid.tile - radius
    last = F.least((tile + 1) * grid.tile, F.lit(extent)) + F.lit(radius - 1)
    before, after = F.lag(axis).over(window), F.lead(axis).over(window)
    return F.coalesce(before == position - 1, position == first) & F.coalesce(
        after == position + 1, position == last
    )


def _checked(axis: str) -> Column:
    message = f"windows need every pixel once: a {axis} is missing or repeated, see Grid.densify"
    return F.when(F.col(f"_whole_{axis}"), F.lit(True)).otherwise(
        F.raise_error(F.lit(message)).cast("boolean")
    )


def _gradient(value: str, window, axis: str, extent: int, step: float) -> Column:
    """Central difference, one-sided at the edges of the grid."""
    if extent == 1:
        return F.lit(0.0)
    here, before, after = F.col(value), F.lag(value).over(window), F.lead(value).over(window)
    return (
        F.when(F.col(axis) == 0, (after - here) / step)
        .when(F.col(axis) == extent - 1, (here - before) / step)
        .otherwise((after - before) / (2.0 * step))
    )


def focal(
    df: DataFrame,
    grid: Grid,
    stats: Sequence[LocalStats] = (),
    derivatives: Derivatives | None = None,
) -> DataFrame:
    """Add all the asked-for neighbourhood columns in one shuffle.

    Every pixel of the grid must be there once, or the job fails.  For a sparse raster, add the missing
    pixels with ``Grid.densify`` and choose what stands in for their values.
    """
    radius = max([s.size // 2 for s in stats] + ([2] if derivatives else []))
    kept = [c for c in df.columns if c not in ("tile_row", "tile_col")]
    tiles = halo(df, grid, radius)

    along_row, along_col = along("row"), along("col")
    moments: dict[str, tuple[Column, int]] = {}
    for s in stats:
        moments[f"_m{s.size}_{s.value}"] = (F.col(s.value), s.size // 2)
        if s.std:
            moments[f"_q{s.size}_{s.value}"] = (F.col(s.value) * F.col(s.value), s.size // 2)

    row_pass = {
        name: F.avg(v).over(along_row.rowsBetween(-r, r)) for name, (v, r) in moments.items()
    }
    if derivatives:
        step = float(derivatives.cellsize)
        row_pass["zx"] = _gradient(derivatives.value, along_row, "col", grid.width, step)
    row_pass["_whole_col"] = _complete("col", grid, radius)
    tiles = tiles.withColumns(row_pass)
    if derivatives:
        tiles = tiles.withColumn("zxx", _gradient("zx", along_row, "col", grid.width, step))
    tiles = tiles.where(_checked("col") & in_tile("col", grid))

    col_pass = {
        name: F.avg(name).over(along_col.rowsBetween(-r, r)) for name, (_, r) in moments.items()
    }
    if derivatives:
        col_pass["zy"] = _gradient(derivatives.value, along_col, "row", grid.height, step)
        col_pass["zxy"] = _gradient("zx", along_col, "row", grid.height, step)
    col_pass["_whole_row"] = _complete("row", grid, radius)
    tiles = tiles.withColumns(col_pass)
    if derivatives:
        tiles = tiles.withColumn("zyy", _gradient("zy", along_col, "row", grid.height, step))
    tiles = tiles.where(_checked("row") & in_tile("row", grid))

    out = [F.col("tile_row"), F.col("tile_col")] + [F.col(c) for c in kept]
    if derivatives:
        out += [F.col(c) for c in ("zx", "zy", "zxx", "zxy", "zyy")]
    for s in stats:
        mean = F.col(f"_m{s.size}_{s.value}")
        if s.mean:
            out.append(mean.alias(s.mean))
        if s.std:
            spread = F.col(f"_q{s.size}_{s.value}") - mean * mean
            out.append(F.sqrt(F.greatest(spread, F.lit(0.0))).alias(s.std))
    return tiles.select(*out)
