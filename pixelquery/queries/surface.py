"""Neighbourhood windows, terrain and texture, and the whole 29-band stack (WIN1-6, PRJ16-23)."""

from __future__ import annotations

from pyspark.sql import functions as F

from pixelquery import fixtures
from pixelquery.operators import features, stats
from pixelquery.operators.focal import Derivatives, LocalStats, focal, mirror_pad
from pixelquery.queries.common import INDEX_CTE, INDEX_SQL, r, rounded, with_grid
from pixelquery.schema import BAND_NAMES, SPECTRAL_BANDS

QUERIES = {}
ORACLES = {}

# surface with gaps filled by the median, and the texture inputs
_BASE = (
    "base AS (SELECT g.*, coalesce(z, (SELECT quantile_cont(z, 0.5) FROM grid)) AS zf, "
    "coalesce(NDVI, 0) AS nd, coalesce(b08, 0) AS nir FROM idx g)"
)
# mirrored border: -1 repeats 0, h repeats h - 1
_PAD = """
padr AS (
  SELECT r AS pr, c, zf, nd, nir FROM base
  UNION ALL SELECT -r - 1, c, zf, nd, nir FROM base WHERE r < 5
  UNION ALL SELECT 2 * h - 1 - r, c, zf, nd, nir FROM base, size WHERE r >= h - 5),
pad AS (
  SELECT pr, c AS pc, zf, nd, nir FROM padr
  UNION ALL SELECT pr, -c - 1, zf, nd, nir FROM padr WHERE c < 5
  UNION ALL SELECT pr, 2 * w - 1 - c, zf, nd, nir FROM padr, size WHERE c >= w - 5)"""


def _moving(name: str, value: str, radius: int, rowwise: bool) -> str:
    part, order = ("pr", "pc") if rowwise else ("pc", "pr")
    return (
        f"avg({value}) OVER (PARTITION BY {part} ORDER BY {order} "
        f"ROWS BETWEEN {radius} PRECEDING AND {radius} FOLLOWING) AS {name}"
    )


_MOMENTS = {
    "z3": ("zf", 1),
    "z11": ("zf", 5),
    "n1": ("nd", 3),
    "n2": ("nd * nd", 3),
    "i1": ("nir", 3),
    "i2": ("nir * nir", 3),
}
_MEANS = (
    "hpass AS (SELECT pr, pc, "
    + ", ".join(_moving(m, v, k, True) for m, (v, k) in _MOMENTS.items())
    + " FROM pad), vpass AS (SELECT pr, pc, "
    + ", ".join(_moving(m, m, k, False) for m, (_, k) in _MOMENTS.items())
    + " FROM hpass)"
)


def _diff(value: str, along: str) -> str:
    part, order, last = ("r", "c", "w - 1") if along == "c" else ("c", "r", "h - 1")
    win = f"OVER (PARTITION BY {part} ORDER BY {order})"
    return (
        f"CASE WHEN {order} = 0 THEN (lead({value}) {win} - {value}) / 10 "
        f"WHEN {order} = {last} THEN ({value} - lag({value}) {win}) / 10 "
        f"ELSE (lead({value}) {win} - lag({value}) {win}) / 20 END"
    )


_SLOPES = (
    f"g1 AS (SELECT b.*, h, w, {_diff('zf', 'c')} AS zx, {_diff('zf', 'r')} AS zy "
    "FROM base b, size), "
    f"g2 AS (SELECT g1.*, {_diff('zx', 'c')} AS zxx, {_diff('zx', 'r')} AS zxy, "
    f"{_diff('zy', 'r')} AS zyy, zx * zx + zy * zy AS pp FROM g1)"
)
_SPREAD = "sqrt(greatest({0}2 - {0}1 * {0}1, 0))"

_TERRAIN_SQL = {
    "Elevation": "z",
    "Slope": "degrees(atan(sqrt(pp)))",
    "Aspect_sin": "sin(atan2(-zx, zy))",
    "Aspect_cos": "cos(atan2(-zx, zy))",
    "PlanCurv": "CASE WHEN pp > 1e-8 THEN -(zxx * zy * zy - 2 * zxy * zx * zy + zyy * zx * zx) "
    "/ (pp * sqrt(1 + pp)) ELSE 0 END",
    "ProfCurv": "CASE WHEN pp > 1e-8 THEN -(zxx * zx * zx + 2 * zxy * zx * zy + zyy * zy * zy) "
    "/ (pp * pow(1 + pp, 1.5)) ELSE 0 END",
    "TRI": "abs(zf - z3)",
    "TPI": "zf - z11",
}
_TEXTURE_SQL = {
    "NDVI_std": _SPREAD.format("n"),
    "NIR_mean": "i1",
    "NIR_std": _SPREAD.format("i"),
}
_ALL_CTES = (INDEX_CTE, _BASE, _PAD, _MEANS, _SLOPES)


def _surface_oracle(columns: dict[str, str], digits: int = 6) -> str:
    return with_grid(
        "SELECT r AS row, c AS col, "
        + ", ".join(f"{r(sql, digits)} AS {name}" for name, sql in columns.items())
        + " FROM g2 JOIN vpass ON r = pr AND c = pc",
        *_ALL_CTES,
    )


def _guarded(sql: str) -> str:
    return f"CASE WHEN z IS NOT NULL THEN {sql} END"


def _filled(spark, sf_dir):
    px = fixtures.pixels(spark, sf_dir)
    fill = stats.exact_median(px, "Elevation")
    return px.select("row", "col", F.coalesce("Elevation", F.lit(fill)).alias("z"))


# windows --------------------------------------------------------------------------------------
def _local_stats(spark, sf_dir):
    px, grid = fixtures.pixels(spark, sf_dir), fixtures.pixel_grid(spark, sf_dir)
    out = features.texture(features.to_reflectance(px), grid)
    return rounded(
        out.select("row", "col", "NDVI_std", "NIR_mean", "NIR_std"),
        "NDVI_std",
        "NIR_mean",
        "NIR_std",
    )


QUERIES["win1_local_mean_std"] = _local_stats
ORACLES["win1_local_mean_std"] = _surface_oracle(_TEXTURE_SQL)


def _mean_query(size):
    def query(spark, sf_dir):
        grid = fixtures.pixel_grid(spark, sf_dir)
        out = focal(_filled(spark, sf_dir), grid, [LocalStats("z", size, mean="mean")])
        return rounded(out.select("row", "col", "mean"), "mean")

    return query


def _sparse_layer(spark, sf_dir):
    """A layer that lacks pixels, completed: 0.25 stands in for B03 where there is none."""
    layer = features.to_reflectance(fixtures.band_layer(spark, sf_dir), ["B03"]).select("row", "col", "B03")
    dense = fixtures.pixel_grid(spark, sf_dir).densify(layer)
    return dense.withColumn("v", F.coalesce("B03", F.lit(0.25)))


def _sparse_windows(spark, sf_dir):
    grid = fixtures.pixel_grid(spark, sf_dir)
    stats_ = [LocalStats("v", 3, mean="mean")]
    out = focal(_sparse_layer(spark, sf_dir), grid, stats_, Derivatives("v", 10.0))
    return rounded(out.select("row", "col", "mean", "zx", "zy"), "mean", "zx", "zy")


QUERIES["win1_windows_of_sparse_layer"] = _sparse_windows
ORACLES["win1_windows_of_sparse_layer"] = (
    with_grid(
        f"SELECT r AS row, c AS col, {r('z3')} AS mean, {r('zx')} AS zx, {r('zy')} AS zy "
        "FROM g2 JOIN vpass ON r = pr AND c = pc",
        INDEX_CTE,
        "base AS (SELECT g.*, coalesce(b03, 0.25) AS zf, 0.0 AS nd, 0.0 AS nir FROM idx g)",
        _PAD,
        _MEANS,
        _SLOPES,
    )
)
QUERIES["win2_mean_3x3"] = _mean_query(3)
ORACLES["win2_mean_3x3"] = _surface_oracle({"mean": "z3"})
QUERIES["win3_mean_11x11"] = _mean_query(11)
ORACLES["win3_mean_11x11"] = _surface_oracle({"mean": "z11"})


def _padded(spark, sf_dir):
    grid = fixtures.pixel_grid(spark, sf_dir)
    return rounded(mirror_pad(_filled(spark, sf_dir), grid, 5), "z")


QUERIES["win4_mirror_border"] = _padded
ORACLES["win4_mirror_border"] = with_grid(
    f"SELECT pr AS row, pc AS col, {r('zf')} AS z FROM pad", INDEX_CTE, _BASE, _PAD
)


def _derivative_query(*columns, digits=6):
    def query(spark, sf_dir):
        grid = fixtures.pixel_grid(spark, sf_dir)
        out = focal(_filled(spark, sf_dir), grid, derivatives=Derivatives("z", 10.0))
        return rounded(out.select("row", "col", *columns), *columns, digits=digits)

    return query


QUERIES["win5_first_derivatives"] = _derivative_query("zx", "zy")
ORACLES["win5_first_derivatives"] = _surface_oracle({"zx": "zx", "zy": "zy"})
QUERIES["win6_second_derivatives"] = _derivative_query("zxx", "zxy", "zyy", digits=9)
ORACLES["win6_second_derivatives"] = _surface_oracle(
    {"zxx": "zxx", "zxy": "zxy", "zyy": "zyy"}, digits=9
)


# terrain --------------------------------------------------------------------------------------
def _terrain_query(*columns):
    def query(spark, sf_dir):
        grid = fixtures.pixel_grid(spark, sf_dir)
        out = features.terrain(fixtures.pixels(spark, sf_dir), grid)
        return rounded(out.select("row", "col", *columns), *columns)

    return query


_TERRAIN_QUERIES = {
    "prj16_elevation": ["Elevation"],
    "prj17_slope": ["Slope"],
    "prj18_aspect": ["Aspect_sin", "Aspect_cos"],
    "prj19_plan_curvature": ["PlanCurv"],
    "prj20_profile_curvature": ["ProfCurv"],
    "prj21_ruggedness": ["TRI"],
    "prj22_topographic_position": ["TPI"],
    "prj23_terrain_with_nodata": list(_TERRAIN_SQL),
}
for _key, _columns in _TERRAIN_QUERIES.items():
    QUERIES[_key] = _terrain_query(*_columns)
    ORACLES[_key] = _surface_oracle({c: _guarded(_TERRAIN_SQL[c]) for c in _columns})


def _median(spark, sf_dir):
    px = fixtures.pixels(spark, sf_dir)
    table = stats.quantile_table(px, ["Elevation"], {"median": 0.5})
    return rounded(table, "median")


QUERIES["agg2_elevation_median"] = _median
ORACLES["agg2_elevation_median"] = with_grid(
    f"SELECT 'Elevation' AS band, {r('quantile_cont(z, 0.5)')} AS median FROM grid"
)


# whole stack ----------------------------------------------------------------------------------
def stack(spark, sf_dir, *keep):
    grid = fixtures.pixel_grid(spark, sf_dir)
    return features.feature_stack(fixtures.pixels(spark, sf_dir), grid, keep=keep)


def _stack_rows(spark, sf_dir):
    return rounded(stack(spark, sf_dir).select("row", "col", *BAND_NAMES), *BAND_NAMES)


STACK_SQL = {
    **{b: b.lower() for b in SPECTRAL_BANDS},
    **{name: name for name in INDEX_SQL},
    **{name: _guarded(sql) for name, sql in _TERRAIN_SQL.items()},
    **_TEXTURE_SQL,
}
STACK_CTES = (
    *_ALL_CTES,
    "stack AS (SELECT r, c, x, y, y_true, y_pred, "
    + ", ".join(f"CAST({sql} AS DOUBLE) AS {name}" for name, sql in STACK_SQL.items())
    + " FROM g2 JOIN vpass ON r = pr AND c = pc)",
)
QUERIES["feature_stack"] = _stack_rows
ORACLES["feature_stack"] = with_grid(
    "SELECT r AS row, c AS col, "
    + ", ".join(f"{r(name)} AS {name}" for name in STACK_SQL)
    + " FROM stack",
    *STACK_CTES,
)

QUERIES["feature_stack_statistics"] = lambda spark, sf_dir: rounded(
    stats.band_statistics(stack(spark, sf_dir), BAND_NAMES),
    "min",
    "max",
    "mean",
    "std",
    "nodata_pct",
)
ORACLES["feature_stack_statistics"] = with_grid(
    " UNION ALL ".join(
        f"SELECT '{b}' AS band, {r(f'min({b})')} AS min, {r(f'max({b})')} AS max, "
        f"{r(f'avg({b})')} AS mean, {r(f'stddev_pop({b})')} AS std, "
        + r(f"100.0 * count(*) FILTER ({b} IS NULL) / count(*)")
        + " AS nodata_pct FROM stack"
        for b in BAND_NAMES
    ),
    *STACK_CTES[:-1],
    STACK_CTES[-1].replace("stack AS (", "stack AS MATERIALIZED (", 1),
)
