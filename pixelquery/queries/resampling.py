"""Mosaic and bilinear resampling (JON6-8)."""

from __future__ import annotations

from pyspark.sql import functions as F

from pixelquery import fixtures
from pixelquery.grid import Grid
from pixelquery.operators import features, resample
from pixelquery.queries import geodesy_sql
from pixelquery.queries.common import r, rounded, with_grid

QUERIES = {}
ORACLES = {}


def _mosaic(spark, sf_dir):
    """Elevation first, a surface made of the B12 layer where elevation has gaps."""
    primary = fixtures.elevation_layer(spark, sf_dir).select(
        "row", "col", F.col("Elevation").alias("value"), F.lit(1).alias("source_rank")
    )
    secondary = fixtures.band_layer(spark, sf_dir).select(
        "row", "col", (F.col("B12") / 8.0).alias("value"), F.lit(2).alias("source_rank")
    )
    return rounded(resample.mosaic(primary.unionByName(secondary), "value"), "value")


QUERIES["jon6_mosaic"] = _mosaic
ORACLES["jon6_mosaic"] = with_grid(
    f"SELECT r AS row, c AS col, {r('coalesce(z, CAST(d12 AS DOUBLE) / 8)')} AS value FROM grid"
)


def _upsampled(spark, sf_dir):
    px = features.to_reflectance(fixtures.pixels(spark, sf_dir), ["B02", "B12"])
    grid = fixtures.pixel_grid(spark, sf_dir)
    fine = resample.upsample_bilinear(px, grid, 2, ["B02", "B12"])
    return rounded(fine, "B02", "B12", digits=9)


QUERIES["jon7_upsample_bilinear"] = _upsampled


def _corners(values: dict[str, str], source: str, on_row: str, on_col: str, fy: str, fx: str):
    """Four neighbours as joins, and the renormalised weighted mean of each value."""
    joins, weights = "", {}
    for name, dr, dc in (("q00", 0, 0), ("q01", 0, 1), ("q10", 1, 0), ("q11", 1, 1)):
        joins += (
            f" JOIN {source} {name} ON {name}.r = greatest(0, least(h - 1, {on_row} + {dr})) "
            f"AND {name}.c = greatest(0, least(w - 1, {on_col} + {dc}))"
        )
        weights[name] = (
            f"({fy if dr else f'(1 - {fy})'} * {fx if dc else f'(1 - {fx})'})"
        )
    means = {}
    for out, value in values.items():
        num = " + ".join(f"coalesce({q}.{value} * {w}, 0)" for q, w in weights.items())
        den = " + ".join(
            f"CASE WHEN {q}.{value} IS NULL THEN 0 ELSE {w} END" for q, w in weights.items()
        )
        means[out] = f"CASE WHEN {den} > 1e-12 THEN ({num}) / ({den}) END"
    return joins, means


_UP_JOINS, _UP_MEANS = _corners(
    {"B02": "b02", "B12": "b12"}, "grid", "qr", "qc", "(sy - qr)", "(sx - qc)"
)
ORACLES["jon7_upsample_bilinear"] = with_grid(
    "SELECT fr AS row, fc AS col, "
    + ", ".join(f"{r(sql, 9)} AS {n}" for n, sql in _UP_MEANS.items())
    + f" FROM fine, size {_UP_JOINS}",
    "two(i) AS (VALUES (0), (1))",
    "fine0 AS (SELECT 2 * r + a.i AS fr, 2 * c + b.i AS fc FROM grid, two a, two b)",
    "fine1 AS (SELECT *, (fr + CAST(0.5 AS DOUBLE)) / 2 - 0.5 AS sy, "
    "(fc + CAST(0.5 AS DOUBLE)) / 2 - 0.5 AS sx FROM fine0)",
    "fine AS (SELECT *, CAST(floor(sy) AS INT) AS qr, CAST(floor(sx) AS INT) AS qc FROM fine1)",
)

_WEST, _NORTH, _DLON, _DLAT = -112.08, 33.71, 0.0038, 0.0032


def _warped(spark, sf_dir):
    grid = fixtures.pixel_grid(spark, sf_dir)
    source = fixtures.elevation_layer(spark, sf_dir)
    lonlat = Grid(_WEST, _NORTH, _DLON, grid.height, grid.width, epsg=4326, tile=grid.tile)
    target = fixtures.pixels(spark, sf_dir).select("row", "col", "x", "y")
    out = resample.warp_bilinear(source, lonlat, _DLON, _DLAT, target, ["Elevation"])
    return rounded(out, "Elevation", digits=3)


QUERIES["jon8_warp_to_utm"] = _warped
_WARP_JOINS, _WARP_MEANS = _corners(
    {"Elevation": "z"}, "grid", "qr", "qc", "(sy - qr)", "(sx - qc)"
)
_COVERED = "sy BETWEEN -0.5 AND h - 0.5 AND sx BETWEEN -0.5 AND w - 0.5"
ORACLES["jon8_warp_to_utm"] = with_grid(
    f"SELECT tr AS row, tc AS col, CASE WHEN {_COVERED} THEN {r(_WARP_MEANS['Elevation'], 3)} END "
    f"AS Elevation FROM put, size {_WARP_JOINS}",
    *geodesy_sql.inverse("grid", "x", "y", "ll"),
    f"put0 AS (SELECT r AS tr, c AS tc, ({_NORTH} - lat) / {_DLAT} - 0.5 AS sy, "
    f"(lon - ({_WEST})) / {_DLON} - 0.5 AS sx FROM ll)",
    "put AS (SELECT *, CAST(floor(sy) AS INT) AS qr, CAST(floor(sx) AS INT) AS qc FROM put0)",
)
