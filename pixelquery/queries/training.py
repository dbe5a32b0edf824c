"""Training areas against pixels (PRJ26, PRJ30, SRC11, JON1-3, FLT1, FLT7, AGG4-7, AGG23, SET1)."""

from __future__ import annotations

import math

from pyspark.sql import functions as F

from pixelquery import fixtures
from pixelquery.functions.geodesy import lonlat_to_utm, point, utm_to_lonlat
from pixelquery.operators import spatial, stats
from pixelquery.queries import geodesy_sql, surface
from pixelquery.queries.common import r, rounded, with_grid
from pixelquery.schema import BAND_NAMES, EVI_RANGE, KEY_FEATURES, TRAINING_AREAS, training_areas

QUERIES = {}
ORACLES = {}

_INLINE_CTE = (
    "inline_areas(class_, cid, lon, lat, dlon, dlat, desc_) AS (VALUES "
    + ", ".join(
        f"('{c}', {i}, {lon}::DOUBLE, {lat}::DOUBLE, {dlon}::DOUBLE, {dlat}::DOUBLE, '{d}')"
        for c, i, lon, lat, dlon, dlat, d in TRAINING_AREAS
    )
    + ")"
)
_INLINE_RINGS = (_INLINE_CTE, *geodesy_sql.rings("inline_areas", "desc_"))
_AREA_RINGS = (geodesy_sql.AREAS_CTE, *geodesy_sql.rings("areas", "area_id"))


def _inline_polygons(spark):
    return spatial.project_polygons(spatial.box_polygons(training_areas(spark)))


def _area_polygons(spark, sf_dir):
    # much work for a short row, so the rows of the one-file table are spread first
    areas = fixtures.areas(spark, sf_dir).repartition(int(spark.conf.get("spark.sql.shuffle.partitions")))
    return spatial.project_polygons(spatial.box_polygons(areas))


# projection -----------------------------------------------------------------------------------
def _to_lonlat(spark, sf_dir):
    lon, lat = utm_to_lonlat(F.col("x"), F.col("y"))
    px = fixtures.pixels(spark, sf_dir)
    return rounded(px.select("row", "col", lon.alias("lon"), lat.alias("lat")), "lon", "lat")


QUERIES["prj26_utm_to_lonlat"] = _to_lonlat
ORACLES["prj26_utm_to_lonlat"] = with_grid(
    f"SELECT r AS row, c AS col, {r('lon')} AS lon, {r('lat')} AS lat FROM ll",
    *geodesy_sql.inverse("grid", "x", "y", "ll"),
)


def _to_utm(spark, sf_dir):
    x, y = lonlat_to_utm(F.col("lon"), F.col("lat"))
    areas = fixtures.areas(spark, sf_dir)
    return rounded(areas.select("area_id", x.alias("x"), y.alias("y")), "x", "y", digits=3)


QUERIES["prj26_lonlat_to_utm"] = _to_utm
ORACLES["prj26_lonlat_to_utm"] = (
    "WITH "
    + ", ".join([geodesy_sql.AREAS_CTE, *geodesy_sql.forward("areas", "lon", "lat", "en")])
    + f" SELECT area_id, {r('east', 3)} AS x, {r('north', 3)} AS y FROM en"
)


def _boxes(spark, sf_dir):
    boxes = spatial.box_polygons(fixtures.areas(spark, sf_dir))
    corners = boxes.select(
        "area_id", "width_m", "height_m", F.posexplode("ring").alias("i", "p")
    )
    flat = corners.select(
        "area_id", "width_m", "height_m", "i", F.col("p.x").alias("x"), F.col("p.y").alias("y")
    )
    return rounded(flat, "x", "y")


QUERIES["prj30_boxes"] = _boxes
ORACLES["prj30_boxes"] = (
    "WITH "
    + geodesy_sql.AREAS_CTE
    + " SELECT area_id, "
    "round_even(2 * dlon * 111320 * cos(radians(lat)), 0) AS width_m, "
    "round_even(2 * dlat * 111320, 0) AS height_m, CAST(i - 1 AS INT) AS i, "
    f"{r('lon + sx * dlon')} AS x, {r('lat + sy * dlat')} AS y FROM areas, "
    "(VALUES (1, 1, -1), (2, 1, 1), (3, -1, 1), (4, -1, -1), (5, 1, -1)) AS k(i, sx, sy)"
)


# pixels in polygons ---------------------------------------------------------------------------
def _positions(spark, sf_dir):
    return fixtures.pixels(spark, sf_dir).select("row", "col")


def _inline_hits(spark, sf_dir):
    grid = fixtures.pixel_grid(spark, sf_dir)
    hits = spatial.label_pixels(_positions(spark, sf_dir), _inline_polygons(spark), grid)
    return hits.select("class", "class_id", "desc", "row", "col")


QUERIES["jon1_pixels_in_training_areas"] = _inline_hits
ORACLES["jon1_pixels_in_training_areas"] = with_grid(
    "SELECT class_ AS class, cid AS class_id, a.desc_ AS desc, h.r AS row, h.c AS col "
    "FROM hits h JOIN inline_areas a ON h.desc_ = a.desc_",
    *_INLINE_RINGS,
    geodesy_sql.inside("grid", "desc_"),
)


def _area_hits(spark, sf_dir):
    grid = fixtures.pixel_grid(spark, sf_dir)
    hits = spatial.label_pixels(_positions(spark, sf_dir), _area_polygons(spark, sf_dir), grid)
    return hits.select("area_id", "class", "row", "col")


QUERIES["jon1_pixels_in_many_polygons"] = _area_hits
ORACLES["jon1_pixels_in_many_polygons"] = with_grid(
    "SELECT h.area_id, class_ AS class, h.r AS row, h.c AS col "
    "FROM hits h JOIN areas a ON h.area_id = a.area_id",
    *_AREA_RINGS,
    geodesy_sql.inside("grid", "area_id"),
)


_LONG = 100  # corners of a ring, more than spatial.HEAVY_EDGES


def _long_ring_hits(spark, sf_dir):
    """Pixels in a star of many corners around every customer's area."""
    grid = fixtures.pixel_grid(spark, sf_dir)
    areas = fixtures.areas(spark, sf_dir)

    def corner(i):
        angle = (i % _LONG).cast("double") * (2 * math.pi / _LONG)
        reach = (F.sin(angle * 9.0) * 0.3 + 1.0) * 5.0
        return point(F.col("lon") + F.col("dlon") * reach * F.cos(angle), F.col("lat") + F.col("dlat") * reach * F.sin(angle))

    star = F.transform(F.sequence(F.lit(0), F.lit(_LONG)), corner)
    # much work for a short row, so the rows of the one-file table are spread first
    areas = areas.repartition(int(spark.conf.get("spark.sql.shuffle.partitions")))
    polygons = spatial.project_polygons(areas.select("area_id", star.alias("ring")))
    return spatial.label_pixels(_positions(spark, sf_dir), polygons, grid).select("area_id", "row", "col")


QUERIES["jon1_pixels_in_long_rings"] = _long_ring_hits
ORACLES["jon1_pixels_in_long_rings"] = with_grid(
    "SELECT area_id, r AS row, c AS col FROM hits",
    geodesy_sql.AREAS_CTE,
    f"turns AS (SELECT i, CAST(i % {_LONG} AS DOUBLE) * CAST({2 * math.pi / _LONG!r} AS DOUBLE) AS a FROM range(0, {_LONG + 1}) AS t(i))",
    "ring AS (SELECT area_id, i, lon + dlon * ((sin(a * 9.0) * 0.3 + 1.0) * 5.0) * cos(a) AS plon, "
    "lat + dlat * ((sin(a * 9.0) * 0.3 + 1.0) * 5.0) * sin(a) AS plat FROM areas, turns)",
    *geodesy_sql.forward("ring", "plon", "plat", "ringxy"),
    "edges AS (SELECT a.area_id, a.east AS x1, a.north AS y1, b.east AS x2, b.north AS y2 "
    "FROM ringxy a JOIN ringxy b ON a.area_id = b.area_id AND b.i = a.i + 1)",
    "ext AS (SELECT area_id, min(east) AS xmin, max(east) AS xmax, min(north) AS ymin, max(north) AS ymax "
    "FROM ringxy GROUP BY area_id)",
    geodesy_sql.inside("grid", "area_id"),
)


def _pixels_per_area(spark, sf_dir):
    hits = _inline_hits(spark, sf_dir).groupBy("desc").agg(F.count("*").alias("pixels"))
    areas = training_areas(spark).select("class", "class_id", "desc")
    return areas.join(hits, "desc", "left").fillna(0, ["pixels"])


QUERIES["src11_training_areas"] = _pixels_per_area
ORACLES["src11_training_areas"] = with_grid(
    "SELECT a.desc_ AS desc, class_ AS class, cid AS class_id, count(h.r) AS pixels "
    "FROM inline_areas a LEFT JOIN hits h ON h.desc_ = a.desc_ GROUP BY 1, 2, 3",
    *_INLINE_RINGS,
    geodesy_sql.inside("grid", "desc_"),
)


def _concatenated(spark, sf_dir):
    per_class = _area_hits(spark, sf_dir).groupBy("class")
    return per_class.agg(
        F.count("*").alias("rows"), F.count_distinct("row", "col").alias("pixels")
    )


QUERIES["set1_rows_per_polygon"] = _concatenated
ORACLES["set1_rows_per_polygon"] = with_grid(
    "SELECT class_ AS class, count(*) AS rows, count(DISTINCT h.r * 1000 + h.c) AS pixels "
    "FROM hits h JOIN areas a ON h.area_id = a.area_id GROUP BY 1",
    *_AREA_RINGS,
    geodesy_sql.inside("grid", "area_id"),
)

# extent ---------------------------------------------------------------------------------------
_MEETS = "xmin <= 399960 + w * 350 AND xmax >= 399960 AND ymin <= 3729900 AND ymax >= 3729900 - h * 350"


def _extent_query(select):
    def query(spark, sf_dir):
        return select(_area_polygons(spark, sf_dir), fixtures.pixel_grid(spark, sf_dir))

    return query


QUERIES["jon2_polygons_on_raster"] = _extent_query(
    lambda p, g: spatial.polygons_on_raster(p, g).select("area_id", "class")
)
ORACLES["jon2_polygons_on_raster"] = with_grid(
    "SELECT a.area_id, class_ AS class FROM areas a JOIN ext USING (area_id), size WHERE " + _MEETS,
    *_AREA_RINGS,
)
QUERIES["jon2_polygons_skipped"] = _extent_query(
    lambda p, g: spatial.skipped_polygons(p, g).select("area_id", "class")
)
ORACLES["jon2_polygons_skipped"] = with_grid(
    f"SELECT a.area_id, class_ AS class FROM areas a JOIN ext USING (area_id), size "
    f"WHERE NOT ({_MEETS})",
    *_AREA_RINGS,
)


def _extent_report(polygons, grid):
    return polygons.groupBy(spatial.meets_extent(polygons, grid).alias("kept")).agg(
        F.count("*").alias("polygons")
    )


QUERIES["flt7_extent_report"] = _extent_query(_extent_report)
ORACLES["flt7_extent_report"] = with_grid(
    f"SELECT {_MEETS} AS kept, count(*) AS polygons FROM ext, size GROUP BY 1", *_AREA_RINGS
)


def _clipped(polygons, grid):
    areas = spatial.clip_polygons(polygons, grid).select(
        "area_id", spatial.ring_area(F.col("ring")).alias("area_m2")
    )
    return rounded(areas, "area_m2", digits=1)


QUERIES["jon3_clip_polygons"] = _extent_query(_clipped)


def _cut_sql(name: str, source: str, axis: str, limit: str, sign: str) -> str:
    """One side of the clip on numbered ring edges: each edge gives 0-2 new points."""
    a, b = f"{axis}1", f"{axis}2"
    share = f"(({limit}) - {a}) / ({b} - {a})"
    return (
        f"{name}_p AS (SELECT area_id, i, 1 AS j, x1 + (x2 - x1) * {share} AS x, "
        f"y1 + (y2 - y1) * {share} AS y FROM {source}, size "
        f"WHERE ({a} {sign} {limit}) <> ({b} {sign} {limit}) "
        f"UNION ALL SELECT area_id, i, 2, x2, y2 FROM {source}, size WHERE {b} {sign} {limit}), "
        f"{name} AS (SELECT area_id, row_number() OVER (PARTITION BY area_id ORDER BY i, j) AS i, "
        "coalesce(lag(x) OVER o, last_value(x) OVER full_) AS x1, "
        "coalesce(lag(y) OVER o, last_value(y) OVER full_) AS y1, x AS x2, y AS y2 "
        f"FROM {name}_p WINDOW o AS (PARTITION BY area_id ORDER BY i, j), full_ AS (PARTITION BY "
        "area_id ORDER BY i, j ROWS BETWEEN UNBOUNDED PRECEDING AND UNBOUNDED FOLLOWING))"
    )


ORACLES["jon3_clip_polygons"] = with_grid(
    f"SELECT area_id, {r('abs(sum(x1 * y2 - x2 * y1)) / 2', 1)} AS area_m2 FROM s4 "
    "GROUP BY area_id HAVING abs(sum(x1 * y2 - x2 * y1)) > 0",
    *_AREA_RINGS,
    "s0 AS (SELECT a.area_id, a.i, a.east AS x1, a.north AS y1, b.east AS x2, b.north AS y2 "
    "FROM ringxy a JOIN ringxy b ON a.area_id = b.area_id AND b.i = a.i + 1)",
    _cut_sql("s1", "s0", "x", "399960", ">="),
    _cut_sql("s2", "s1", "x", "399960 + w * 350", "<="),
    _cut_sql("s3", "s2", "y", "3729900 - h * 350", ">="),
    _cut_sql("s4", "s3", "y", "3729900", "<="),
)

QUERIES["agg5_polygons_per_class"] = lambda spark, sf_dir: stats.polygons_per_class(
    fixtures.areas(spark, sf_dir)
)
ORACLES["agg5_polygons_per_class"] = (
    "WITH "
    + geodesy_sql.AREAS_CTE
    + " SELECT class_ AS class, count(*) AS polygons FROM areas GROUP BY 1"
)


# training table -------------------------------------------------------------------------------
def training_rows(spark, sf_dir, keep=()):
    grid = fixtures.pixel_grid(spark, sf_dir)
    stack = surface.stack(spark, sf_dir)
    return spatial.training_table(stack, _area_polygons(spark, sf_dir), grid, keep=keep)


TRAINING_CTES = (
    *surface.STACK_CTES,
    *_AREA_RINGS,
    geodesy_sql.inside("grid", "area_id"),
    "train AS (SELECT class_ AS class, cid AS class_id, "
    + ", ".join(
        f"greatest({EVI_RANGE[0]}, least({EVI_RANGE[1]}, EVI)) AS EVI" if b == "EVI" else f"s.{b}"
        for b in BAND_NAMES
    )
    + " FROM hits h JOIN areas a ON h.area_id = a.area_id "
    "JOIN stack s ON s.r = h.r AND s.c = h.c WHERE "
    + " AND ".join(f"s.{b} IS NOT NULL" for b in BAND_NAMES)
    + ")",
)

QUERIES["training_table"] = lambda spark, sf_dir: rounded(
    training_rows(spark, sf_dir), *BAND_NAMES
)
ORACLES["training_table"] = with_grid(
    "SELECT class, class_id, " + ", ".join(f"{r(b)} AS {b}" for b in BAND_NAMES) + " FROM train",
    *TRAINING_CTES,
)

QUERIES["agg4_class_distribution"] = lambda spark, sf_dir: rounded(
    stats.in_report_order(stats.class_distribution(training_rows(spark, sf_dir))), "pct"
)
ORACLES["agg4_class_distribution"] = with_grid(
    f"SELECT class, count(*) AS pixels, {r('100.0 * count(*) / sum(count(*)) OVER ()')} AS pct "
    "FROM train GROUP BY class",
    *TRAINING_CTES,
)
QUERIES["agg6_class_feature_means"] = lambda spark, sf_dir: rounded(
    stats.class_feature_means(training_rows(spark, sf_dir)), *KEY_FEATURES
)
ORACLES["agg6_class_feature_means"] = with_grid(
    "SELECT class, "
    + ", ".join(f"{r(f'avg({f})')} AS {f}" for f in KEY_FEATURES)
    + " FROM train GROUP BY class",
    *TRAINING_CTES,
)
QUERIES["agg7_feature_statistics"] = lambda spark, sf_dir: rounded(
    stats.feature_statistics(training_rows(spark, sf_dir), BAND_NAMES), "min", "max", "mean", "std"
)
ORACLES["agg7_feature_statistics"] = with_grid(
    " UNION ALL ".join(
        f"SELECT '{b}' AS feature, {r(f'min({b})')} AS min, {r(f'max({b})')} AS max, "
        f"{r(f'avg({b})')} AS mean, {r(f'stddev_samp({b})')} AS std FROM train"
        for b in BAND_NAMES
    ),
    *TRAINING_CTES[:-1],
    TRAINING_CTES[-1].replace("train AS (", "train AS MATERIALIZED (", 1),
)
QUERIES["agg23_distinct_classes"] = lambda spark, sf_dir: stats.distinct_classes(
    training_rows(spark, sf_dir)
)
ORACLES["agg23_distinct_classes"] = with_grid("SELECT DISTINCT class FROM train", *TRAINING_CTES)
