"""Mosaic and bilinear resampling (JON6-8, PRJ25)."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pixelquery.functions.geodesy import utm_to_lonlat
from pixelquery.grid import Grid
from pixelquery.operators.focal import along, halo


def mosaic(sources: DataFrame, value: str, rank: str = "source_rank") -> DataFrame:
    """Merge overlapping tiles cell by cell: the lowest-ranked source with a valid cell wins.

    Cells that no source covers with data stay NULL.
    """
    first = F.min_by(value, F.when(F.col(value).isNotNull(), F.col(rank)))
    return sources.groupBy("row", "col").agg(first.alias(value))


def _blend(corners: Sequence[tuple[Column, Column]]) -> Column:
    """Weighted mean over the corners that carry data; NULL if none does or all weights are 0."""
    total = weight = F.lit(0.0)
    for value, w in corners:
        total = total + F.when(value.isNotNull(), value * w).otherwise(0.0)
        weight = weight + F.when(value.isNotNull(), w).otherwise(0.0)
    return F.when(weight > 1e-12, total / weight)


def _quads(df: DataFrame, grid: Grid, values: Sequence[str]) -> DataFrame:
    """Each cell with its right, lower and lower-right neighbour, in one shuffle by tile.

    Quads also exist one step outside the grid, where the edge cell repeats.
    """
    right_of, below = along("row"), along("col")
    tiles = halo(df.select("row", "col", *values), grid, 1)
    tiles = tiles.withColumns({f"_r_{v}": F.lead(v).over(right_of) for v in values})
    down = {}
    for v in values:
        down[f"_b_{v}"] = F.lead(v).over(below)
        down[f"_d_{v}"] = F.lead(f"_r_{v}").over(below)
    tiles = tiles.withColumns(down)

    def owned(axis: str, extent: int, tiles_on_axis: int) -> Column:
        # a quad belongs to the tile of its upper-left cell; -1 belongs to the first tile
        home = F.greatest(F.lit(0), grid.tile_of(F.col(axis)))
        home = F.least(F.lit(tiles_on_axis - 1), home)
        return (F.col(f"tile_{axis}") == home) & F.col(axis).between(-1, extent - 1)

    tiles = tiles.where(
        owned("row", grid.height, grid.tile_rows) & owned("col", grid.width, grid.tile_cols)
    )
    return tiles.drop("tile_row", "tile_col")


def _corner_values(v: str, fy: Column, fx: Column):
    return [
        (F.col(v), (1.0 - fy) * (1.0 - fx)),
        (F.col(f"_r_{v}"), (1.0 - fy) * fx),
        (F.col(f"_b_{v}"), fy * (1.0 - fx)),
        (F.col(f"_d_{v}"), fy * fx),
    ]


def upsample_bilinear(df: DataFrame, grid: Grid, factor: int, values: Sequence[str]) -> DataFrame:
    """Refine a coarse raster by a whole factor, e.g. 20 m bands to 10 m.

    ``grid`` describes the coarse raster.  Fine cells are generated from the quad of coarse cells
    around them, so neither a join nor an aggregation touches the fine resolution.
    """
    quads = _quads(df, grid, values)
    # fine offsets whose centre lies between this coarse centre and the next one
    offsets = F.array(*[F.lit(factor // 2 + i) for i in range(factor)])

    def fine(axis: str) -> Column:
        return F.col(axis) * factor + F.col(f"_o_{axis}")

    def fraction(axis: str) -> Column:
        return (F.col(f"_o_{axis}") + 0.5) / float(factor) - 0.5

    cells = quads.withColumn("_o_row", F.explode(offsets))
    cells = cells.where(fine("row").between(0, grid.height * factor - 1))
    cells = cells.withColumn("_o_col", F.explode(offsets))
    cells = cells.where(fine("col").between(0, grid.width * factor - 1))
    fy, fx = fraction("row"), fraction("col")
    return cells.select(
        fine("row").alias("row"),
        fine("col").alias("col"),
        *[_blend(_corner_values(v, fy, fx)).alias(v) for v in values],
    )


def warp_bilinear(
    source: DataFrame,
    source_grid: Grid,
    lon_step: float,
    lat_step: float,
    target: DataFrame,
    values: Sequence[str],
    zone: int = 12,
) -> DataFrame:
    """Resample a lon/lat raster onto UTM pixels ``target(row, col, x, y)``.

    ``source_grid`` gives the origin (west, north) and size of the source, the steps are its pixel
    size in degrees.  Every target pixel is projected back and finds its four neighbours with one
    equi-join on the quad address.  Pixels outside the source get NULL.
    """
    lon, lat = utm_to_lonlat(F.col("x"), F.col("y"), zone)
    placed = target.select(
        "row",
        "col",
        ((F.lit(source_grid.y0) - lat) / lat_step - 0.5).alias("_sy"),
        ((lon - source_grid.x0) / lon_step - 0.5).alias("_sx"),
    ).withColumns({"_qr": F.floor("_sy").cast("int"), "_qc": F.floor("_sx").cast("int")})
    covered = F.col("_sy").between(-0.5, source_grid.height - 0.5) & F.col("_sx").between(
        -0.5, source_grid.width - 0.5
    )
    quads = _quads(source, source_grid, values).withColumnsRenamed({"row": "_qr", "col": "_qc"})
    joined = placed.join(quads, ["_qr", "_qc"], "left")
    fy, fx = F.col("_sy") - F.col("_qr"), F.col("_sx") - F.col("_qc")
    return joined.select(
        "row",
        "col",
        *[F.when(covered, _blend(_corner_values(v, fy, fx))).alias(v) for v in values],
    )


def clip_to_aoi(bounds: DataFrame, aoi: Sequence[float], strict: bool = False) -> DataFrame:
    """Intersect each scene's ``left, bottom, right, top`` with the AOI given in the same CRS.

    Adds the clip window and the share of the AOI it covers.  Scenes that miss the AOI are dropped,
    or fail the job with ``strict``.
    """
    left, bottom, right, top = (F.lit(float(v)) for v in aoi)
    aoi_area = float((aoi[2] - aoi[0]) * (aoi[3] - aoi[1]))
    clipped = bounds.withColumns(
        {
            "clip_left": F.greatest("left", left),
            "clip_bottom": F.greatest("bottom", bottom),
            "clip_right": F.least("right", right),
            "clip_top": F.least("top", top),
        }
    )
    meets = (F.col("clip_left") < F.col("clip_right")) & (
        F.col("clip_bottom") < F.col("clip_top")
    )
    if strict:
        meets = F.when(meets, F.lit(True)).otherwise(
            F.raise_error(F.lit("area of interest does not intersect the scene"))
        )
    area = (F.col("clip_right") - F.col("clip_left")) * (F.col("clip_top") - F.col("clip_bottom"))
    return clipped.where(meets).withColumn("coverage_pct", area / aoi_area * 100.0)
