"""Reflectance, indices, band statistics and stretch (PRJ1-15, PRJ27-28, PRJ31, AGG1, AGG3, JON4)."""

from __future__ import annotations

from pyspark.sql import functions as F

from pixelquery import fixtures
from pixelquery.functions import reflectance as R
from pixelquery.operators import features, stats
from pixelquery.queries import surface
from pixelquery.queries.common import INDEX_CTE, INDEX_SQL, r, rounded, with_grid
from pixelquery.schema import BAND_NAMES, SPECTRAL_BANDS

_SPECTRAL = BAND_NAMES[:18]
_BANDS_SQL = {b: b.lower() for b in SPECTRAL_BANDS}

QUERIES = {}
ORACLES = {}


def reflectances(spark, sf_dir):
    return features.to_reflectance(fixtures.pixels(spark, sf_dir))


def indices(spark, sf_dir):
    return features.with_indices(reflectances(spark, sf_dir))


def _nodata_mask(spark, sf_dir):
    px = fixtures.pixels(spark, sf_dir)
    return px.select("row", "col", *[R.mask_nodata(F.col(b)).alias(b) for b in SPECTRAL_BANDS])


QUERIES["prj1_nodata_mask"] = _nodata_mask
ORACLES["prj1_nodata_mask"] = with_grid(
    "SELECT r AS row, c AS col, "
    + ", ".join(f"nullif(d{b[1:]}, 0) AS {b}" for b in SPECTRAL_BANDS)
    + " FROM grid"
)

QUERIES["prj2_reflectance"] = lambda spark, sf_dir: rounded(
    reflectances(spark, sf_dir).select("row", "col", *SPECTRAL_BANDS), *SPECTRAL_BANDS
)
ORACLES["prj2_reflectance"] = with_grid(
    "SELECT r AS row, c AS col, "
    + ", ".join(f"{r(sql)} AS {b}" for b, sql in _BANDS_SQL.items())
    + " FROM grid"
)


def _safe_divide(spark, sf_dir):
    px = reflectances(spark, sf_dir)
    ratio = R.safe_divide(F.col("B02"), F.col("B08") - F.col("B04"))
    return rounded(px.select("row", "col", ratio.alias("ratio")), "ratio")


QUERIES["prj3_safe_divide"] = _safe_divide
ORACLES["prj3_safe_divide"] = with_grid(
    "SELECT r AS row, c AS col, "
    + r("CASE WHEN abs(b08 - b04) > 1e-6 THEN b02 / (b08 - b04) ELSE 0 END")
    + " AS ratio FROM grid"
)


def _one_index(name):
    def query(spark, sf_dir):
        return rounded(indices(spark, sf_dir).select("row", "col", name), name)

    return query


for _number, _name in enumerate(INDEX_SQL, 4):
    _key = f"prj{_number}_{_name.lower()}"
    QUERIES[_key] = _one_index(_name)
    ORACLES[_key] = with_grid(
        f"SELECT r AS row, c AS col, {r(_name)} AS {_name} FROM idx", INDEX_CTE
    )


def _evi_clip(spark, sf_dir):
    px = indices(spark, sf_dir)
    return rounded(px.select("row", "col", R.clip_evi(F.col("EVI")).alias("EVI")), "EVI")


QUERIES["prj27_evi_clip"] = _evi_clip
ORACLES["prj27_evi_clip"] = with_grid(
    "SELECT r AS row, c AS col, "
    + r("CASE WHEN EVI < -1 THEN -1 WHEN EVI > 2 THEN 2 ELSE EVI END")
    + " AS EVI FROM idx",
    INDEX_CTE,
)


def _zero_filled(spark, sf_dir):
    px = reflectances(spark, sf_dir)
    return rounded(px.select("row", "col", R.zero_filled(F.col("B08")).alias("NIR")), "NIR")


QUERIES["prj31_zero_filled"] = _zero_filled
ORACLES["prj31_zero_filled"] = with_grid(
    f"SELECT r AS row, c AS col, {r('coalesce(b08, 0)')} AS NIR FROM grid"
)


def _stretch(spark, sf_dir):
    px = reflectances(spark, sf_dir).select("row", "col", "B08", "B04", "B03")
    return rounded(stats.percentile_stretch(px, ["B08", "B04", "B03"]), "B08", "B04", "B03")


def _stretch_sql(b):
    return (
        f"greatest(0.0, least(1.0, ({b} - {b}_lo) / greatest({b}_hi - {b}_lo, 1e-6)))",
        f"quantile_cont({b}, 0.02) AS {b}_lo, quantile_cont({b}, 0.98) AS {b}_hi",
    )


QUERIES["prj28_percentile_stretch"] = _stretch
ORACLES["prj28_percentile_stretch"] = with_grid(
    "SELECT r AS row, c AS col, "
    + ", ".join(
        f"CASE WHEN {b} IS NOT NULL THEN {r(_stretch_sql(b)[0])} END AS {b.upper()}"
        for b in ("b08", "b04", "b03")
    )
    + " FROM grid, lim",
    "lim AS (SELECT " + ", ".join(_stretch_sql(b)[1] for b in ("b08", "b04", "b03")) + " FROM grid)",
)

QUERIES["agg1_band_statistics"] = lambda spark, sf_dir: rounded(
    stats.band_statistics(indices(spark, sf_dir), [*_SPECTRAL, "Elevation"]),
    "min",
    "max",
    "mean",
    "std",
    "nodata_pct",
)


def _stats_sql(name, source, std="stddev_pop", key="band", nodata=True):
    parts = [
        f"SELECT '{name}' AS {key}",
        f"{r(f'min({source})')} AS min",
        f"{r(f'max({source})')} AS max",
        f"{r(f'avg({source})')} AS mean",
        f"{r(f'{std}({source})')} AS std",
    ]
    if nodata:
        parts.append(
            r(f"100.0 * count(*) FILTER ({source} IS NULL) / count(*)") + " AS nodata_pct"
        )
    return ", ".join(parts)


ORACLES["agg1_band_statistics"] = with_grid(
    " UNION ALL ".join(
        _stats_sql(b, s) + " FROM idx"
        for b, s in [*_BANDS_SQL.items(), *[(n, n) for n in INDEX_SQL], ("Elevation", "z")]
    ),
    INDEX_CTE,
)

_PROBS = {"p02": 0.02, "p98": 0.98}
QUERIES["agg3_percentiles"] = lambda spark, sf_dir: rounded(
    stats.quantile_table(reflectances(spark, sf_dir), SPECTRAL_BANDS, _PROBS), *_PROBS
)
ORACLES["agg3_percentiles"] = with_grid(
    " UNION ALL ".join(
        f"SELECT '{b}' AS band, {r(f'quantile_cont({s}, 0.02)')} AS p02, "
        f"{r(f'quantile_cont({s}, 0.98)')} AS p98 FROM grid"
        for b, s in _BANDS_SQL.items()
    )
)


def _align(spark, sf_dir):
    layers = fixtures.band_layer(spark, sf_dir), fixtures.elevation_layer(spark, sf_dir)
    stacked = features.to_reflectance(features.align_layers(*layers))
    return rounded(stacked, *SPECTRAL_BANDS, "Elevation")


QUERIES["jon4_align_layers"] = _align
ORACLES["jon4_align_layers"] = with_grid(
    "SELECT r AS row, c AS col, "
    + ", ".join(f"{r(sql)} AS {b}" for b, sql in _BANDS_SQL.items())
    + f", {r('z')} AS Elevation FROM grid"
)


def _valid_rows(spark, sf_dir):
    px = surface.stack(spark, sf_dir).dropna("any", subset=BAND_NAMES)
    return rounded(px.select("row", "col", "NDVI", "SR", "Elevation"), "NDVI", "SR", "Elevation")


QUERIES["flt1_valid_in_all_bands"] = _valid_rows
ORACLES["flt1_valid_in_all_bands"] = with_grid(
    f"SELECT r AS row, c AS col, {r('NDVI')} AS NDVI, {r('SR')} AS SR, {r('Elevation')} AS Elevation "
    "FROM stack WHERE " + " AND ".join(f"{b} IS NOT NULL" for b in BAND_NAMES),
    *surface.STACK_CTES,
)
