"""The 29-band feature grid: bands, indices, terrain and texture (PRJ1-23, PRJ31, JON4)."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pixelquery.functions import reflectance as R
from pixelquery.functions import surface as S
from pixelquery.grid import Grid
from pixelquery.operators.focal import Derivatives, LocalStats, focal
from pixelquery.operators.stats import exact_median
from pixelquery.schema import BAND_NAMES, SPECTRAL_BANDS

TEXTURE_SIZE = 7
_TERRAIN_STATS = [
    LocalStats("_z", 3, mean="_z3"),
    LocalStats("_z", 11, mean="_z11"),
]
_TEXTURE_STATS = [
    LocalStats("_ndvi", TEXTURE_SIZE, std="NDVI_std"),
    LocalStats("_nir", TEXTURE_SIZE, mean="NIR_mean", std="NIR_std"),
]


def to_reflectance(pixels: DataFrame, bands=tuple(SPECTRAL_BANDS)) -> DataFrame:
    """Digital numbers to reflectance in place; DN 0 becomes NULL."""
    return pixels.withColumns({b: R.reflectance(F.col(b)) for b in bands})


def with_indices(pixels: DataFrame) -> DataFrame:
    """Add the twelve spectral indices to a reflectance table."""
    return pixels.withColumns(_index_columns())


def _index_columns():
    return R.spectral_indices(*[F.col(b) for b in SPECTRAL_BANDS])


def align_layers(*layers: DataFrame) -> DataFrame:
    """Put separately stored layers on one row per pixel; what a layer lacks at a pixel is NULL.

    Every pixel of any layer stays.  The layers are stacked and grouped by pixel, which is one shuffle
    whatever their number; a layer has a pixel once, so each column has one value to take.
    """
    values = [c for layer in layers for c in layer.columns if c not in ("row", "col")]
    if len(set(values)) < len(values):
        raise ValueError(f"layers share a column: {sorted(values)}")
    stacked = reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), layers)
    return stacked.groupBy("row", "col").agg(*[F.first(c, ignorenulls=True).alias(c) for c in values])


def _filled_surface(pixels: DataFrame, fill: float | None) -> DataFrame:
    """``_z``: the elevation with its gaps filled by the overall median."""
    if fill is None:
        fill = exact_median(pixels, "Elevation")
    return pixels.withColumn("_z", F.coalesce(F.col("Elevation"), F.lit(fill or 0.0)))


def _terrain_columns():
    zx, zy, zxx, zxy, zyy = (F.col(c) for c in ("zx", "zy", "zxx", "zxy", "zyy"))
    derived = {
        "Slope": S.slope_degrees(zx, zy),
        "Aspect_sin": F.sin(S.aspect(zx, zy)),
        "Aspect_cos": F.cos(S.aspect(zx, zy)),
        "PlanCurv": S.plan_curvature(zx, zy, zxx, zxy, zyy),
        "ProfCurv": S.profile_curvature(zx, zy, zxx, zxy, zyy),
        "TRI": F.abs(F.col("_z") - F.col("_z3")),
        "TPI": F.col("_z") - F.col("_z11"),
    }
    return {name: F.when(F.col("Elevation").isNotNull(), c) for name, c in derived.items()}


def terrain(
    pixels: DataFrame, grid: Grid, cellsize: float = 10.0, fill: float | None = None
) -> DataFrame:
    """Elevation plus seven terrain bands; nodata in the DEM stays nodata in all of them."""
    pixels = _filled_surface(pixels.select("row", "col", "Elevation"), fill)
    surface = focal(pixels, grid, _TERRAIN_STATS, Derivatives("_z", cellsize))
    derived = _terrain_columns()
    return surface.select(
        "tile_row", "tile_col", "row", "col", "Elevation", *[c.alias(n) for n, c in derived.items()]
    )


def _texture_inputs(pixels: DataFrame) -> DataFrame:
    return pixels.withColumns(
        {
            "_ndvi": R.zero_filled(_index_columns()["NDVI"]),
            "_nir": R.zero_filled(F.col("B08")),
        }
    )


def texture(pixels: DataFrame, grid: Grid) -> DataFrame:
    """Local NDVI spread and local NIR mean and spread of a reflectance table."""
    inputs = _texture_inputs(pixels).select("row", "col", "_ndvi", "_nir")
    return focal(inputs, grid, _TEXTURE_STATS).drop("_ndvi", "_nir")


def feature_stack(
    pixels: DataFrame,
    grid: Grid,
    cellsize: float = 10.0,
    fill: float | None = None,
    keep: Sequence[str] = (),
) -> DataFrame:
    """All 29 bands of a table ``row, col, B02..B12 (DN), Elevation``, in stack order.

    Only the six bands and the elevation travel through the shuffle; terrain and texture windows
    share it, and the indices are computed after it.  Columns to ``keep`` travel along.
    """
    pixels = to_reflectance(pixels.select("row", "col", *SPECTRAL_BANDS, "Elevation", *keep))
    pixels = _texture_inputs(_filled_surface(pixels, fill))
    windows = focal(
        pixels, grid, _TERRAIN_STATS + _TEXTURE_STATS, Derivatives("_z", cellsize)
    )
    bands = windows.withColumns({**_index_columns(), **_terrain_columns()})
    return bands.select("tile_row", "tile_col", "row", "col", *BAND_NAMES, *keep)
