"""Scene catalogue (SRC1-7, FLT3, AGG20-21, SET3, SRT1) and AOI clip (PRJ25)."""

from __future__ import annotations

from pyspark.sql import functions as F

from pixelquery import fixtures
from pixelquery.grid import Grid
from pixelquery.operators import catalog, resample
from pixelquery.queries import geodesy_sql
from pixelquery.queries.common import r, rounded
from pixelquery.schema import AOI_WGS84, SCENE_BANDS, SPECTRAL_BANDS
from pixelquery.session import scratch_path
from pixelquery.sources import tables

QUERIES = {}
ORACLES = {}

_DATES = ("2024-01-05", "2024-01-20")
_WEST, _SOUTH, _EAST, _NORTH = AOI_WGS84

_SCENES = """
WITH scenes AS (
  SELECT 'S2_MSIL2A_' || lpad(CAST(event_id AS VARCHAR), 9, '0') AS scene_id,
         CASE WHEN event_type <> 'click' THEN ts END AS acquired, value AS cloud,
         CAST(-113.4 AS DOUBLE) + CAST(user_id * 7 % 240 AS DOUBLE) / 100 AS west,
         CAST(32.4 AS DOUBLE) + CAST(event_id * 13 % 200 AS DOUBLE) / 100 AS south,
         CASE WHEN event_type <> 'purchase' THEN '32612' END AS epsg, event_id,
         CASE event_type WHEN 'error' THEN 'B11' WHEN 'signup' THEN 'SCL' WHEN 'view' THEN 'B02'
              ELSE 'none' END AS missing
  FROM events),
box AS (SELECT *, west + CAST(1.1 AS DOUBLE) AS east, south + CAST(0.9 AS DOUBLE) AS north
        FROM scenes),
"""
_BANDS = (
    "wanted(band) AS (VALUES " + ", ".join(f"('{b}')" for b in SCENE_BANDS) + "), "
    "files AS (SELECT scene_id, band, 's/' || CAST(event_id AS VARCHAR) || '/' || band AS href "
    "FROM scenes, wanted WHERE band <> missing), "
)
_FETCHED = (
    "fetched AS (SELECT 'S2_MSIL2A_' || lpad(CAST(event_id AS VARCHAR), 9, '0') AS scene_id, "
    "band, CAST(floor(value * 10000) AS BIGINT) AS bytes FROM events JOIN (VALUES "
    "('purchase', 'B02'), ('purchase', 'B08'), ('view', 'B04')) AS f(kind, band) "
    "ON event_type = kind), "
)
_FOUND = (
    f"found AS (SELECT * FROM box WHERE west <= {_EAST} AND east >= {_WEST} "
    f"AND south <= {_NORTH} AND north >= {_SOUTH} AND acquired >= TIMESTAMP '{_DATES[0]}' "
    f"AND acquired < TIMESTAMP '{_DATES[1]}' + INTERVAL 1 DAY AND cloud < 5) "
)


def _scenes(spark, sf_dir):
    return fixtures.scenes(spark, sf_dir)


def _found(spark, sf_dir):
    return catalog.search_scenes(_scenes(spark, sf_dir), dates=_DATES)


def _listed(df):
    return df.select("scene_id", F.date_format("acquired", "yyyy-MM-dd").alias("date"), "cloud")


_LISTED = "SELECT scene_id, strftime(acquired, '%Y-%m-%d') AS date, cloud FROM found"

QUERIES["src1_search_scenes"] = lambda spark, sf_dir: _listed(_found(spark, sf_dir))
ORACLES["src1_search_scenes"] = _SCENES + _FOUND + _LISTED
QUERIES["srt1_scenes_by_cloud"] = lambda spark, sf_dir: _listed(
    catalog.by_cloud(_found(spark, sf_dir))
)
ORACLES["srt1_scenes_by_cloud"] = _SCENES + _FOUND + _LISTED + " ORDER BY cloud, scene_id"
QUERIES["src2_clearest_scenes"] = lambda spark, sf_dir: _listed(
    catalog.clearest(_found(spark, sf_dir))
)
ORACLES["src2_clearest_scenes"] = _SCENES + _FOUND + _LISTED + " ORDER BY cloud, scene_id LIMIT 3"

QUERIES["src3_scene_bands"] = lambda spark, sf_dir: catalog.scene_bands(_scenes(spark, sf_dir))
ORACLES["src3_scene_bands"] = (
    _SCENES
    + _BANDS[:-2]
    + " SELECT s.scene_id, w.band, f.href FROM scenes s CROSS JOIN wanted w "
    "LEFT JOIN files f ON f.scene_id = s.scene_id AND f.band = w.band"
)
QUERIES["set3_missing_bands"] = lambda spark, sf_dir: catalog.missing_bands(_scenes(spark, sf_dir))
ORACLES["set3_missing_bands"] = (
    _SCENES
    + _BANDS[:-2]
    + " SELECT s.scene_id, w.band FROM scenes s CROSS JOIN wanted w WHERE NOT EXISTS "
    "(SELECT 1 FROM files f WHERE f.scene_id = s.scene_id AND f.band = w.band)"
)


def _to_fetch(spark, sf_dir):
    wanted = catalog.scene_bands(_scenes(spark, sf_dir))
    return catalog.not_yet_fetched(wanted, fixtures.fetched(spark, sf_dir))


QUERIES["src4_not_yet_fetched"] = _to_fetch
ORACLES["src4_not_yet_fetched"] = (
    _SCENES
    + _BANDS
    + _FETCHED[:-2]
    + " SELECT scene_id, band, href FROM files f WHERE NOT EXISTS (SELECT 1 FROM fetched m "
    "WHERE m.scene_id = f.scene_id AND m.band = f.band)"
)
QUERIES["src5_scene_metadata"] = lambda spark, sf_dir: catalog.scene_metadata(
    _scenes(spark, sf_dir)
)
_META = (
    "meta AS (SELECT scene_id, coalesce(strftime(acquired, '%Y%m%d'), 'unknown') AS date, "
    "coalesce(cloud, 0) AS cloud, coalesce(epsg, 'N/A') AS epsg FROM scenes) "
)
_KEY = "date || '_' || right(scene_id, 6)"
ORACLES["src5_scene_metadata"] = (
    _SCENES + _META + f"SELECT scene_id, {_KEY} AS scene_key, date, cloud, epsg FROM meta"
)


def _dem_catalog(spark, sf_dir):
    """Elevation tiles: scenes with a known projection carry the data asset."""
    scenes = _scenes(spark, sf_dir)
    asset = F.when(F.col("epsg").isNotNull(), F.lit("data")).otherwise(F.lit("thumbnail"))
    return scenes.withColumn(
        "assets", F.create_map(asset, F.concat(F.lit("d/"), F.col("scene_id")))
    )


QUERIES["src6_dem_tiles"] = lambda spark, sf_dir: catalog.dem_tiles(_dem_catalog(spark, sf_dir))
ORACLES["src6_dem_tiles"] = (
    _SCENES.rstrip().rstrip(",")
    + f" SELECT scene_id, 'd/' || scene_id AS href FROM box WHERE west <= {_EAST} AND "
    f"east >= {_WEST} AND south <= {_NORTH} AND north >= {_SOUTH} AND epsg IS NOT NULL"
)


def _cloud_from_text(spark, sf_dir):
    """Metadata text in which covers of 100 % and more are not readable as numbers."""
    lines = catalog.metadata_lines(_scenes(spark, sf_dir))
    damaged = F.regexp_replace("line", r"(cloud_cover : )\d\d\d.*", "$1n/a")
    return catalog.parse_cloud_cover(lines.withColumn("line", damaged))


QUERIES["src7_cloud_from_metadata"] = _cloud_from_text
ORACLES["src7_cloud_from_metadata"] = (
    _SCENES
    + _META
    + f"SELECT {_KEY} AS scene_key, CASE WHEN cloud >= 100 THEN 100.0 "
    "ELSE CAST(printf('%.2f', cloud) AS DOUBLE) END AS cloud FROM meta"
)

QUERIES["flt3_complete_scenes"] = lambda spark, sf_dir: catalog.complete_scenes(
    _available(spark, sf_dir)
)


def _available(spark, sf_dir):
    return catalog.scene_bands(_scenes(spark, sf_dir)).where("href IS NOT NULL")


_SPECTRAL = ", ".join(f"'{b}'" for b in SPECTRAL_BANDS)
_COMPLETE = (
    f"SELECT scene_id, count(DISTINCT band) AS bands FROM files WHERE band IN ({_SPECTRAL}) "
    "GROUP BY scene_id HAVING count(DISTINCT band) = 6"
)
ORACLES["flt3_complete_scenes"] = _SCENES + _BANDS[:-2] + " " + _COMPLETE
QUERIES["agg21_best_scene"] = lambda spark, sf_dir: catalog.best_scene(
    _scenes(spark, sf_dir), _available(spark, sf_dir)
)
ORACLES["agg21_best_scene"] = (
    _SCENES
    + _BANDS[:-2]
    + f" SELECT s.scene_id, s.cloud FROM scenes s JOIN ({_COMPLETE}) c ON s.scene_id = c.scene_id "
    "ORDER BY s.cloud, s.scene_id LIMIT 1"
)
QUERIES["agg20_fetched_bytes"] = lambda spark, sf_dir: rounded(
    catalog.fetched_bytes(fixtures.fetched(spark, sf_dir)), "mb"
)
ORACLES["agg20_fetched_bytes"] = (
    "WITH "
    + _FETCHED[:-2]
    + f" SELECT scene_id, CAST(sum(bytes) AS BIGINT) AS bytes, {r('sum(bytes) / 1048576.0')} AS mb "
    "FROM fetched GROUP BY ROLLUP (scene_id)"
)

# clip -----------------------------------------------------------------------------------------
_AOI_UTM = (362000.0, 3674000.0, 435000.0, 3730000.0)


def _clipped(spark, sf_dir):
    bounds = catalog.projected_boxes(_scenes(spark, sf_dir))
    clipped = resample.clip_to_aoi(bounds, _AOI_UTM)
    columns = ["clip_left", "clip_bottom", "clip_right", "clip_top", "coverage_pct"]
    return rounded(clipped.select("scene_id", *columns), *columns, digits=3)


QUERIES["prj25_clip_to_aoi"] = _clipped
_L, _B, _R, _T = _AOI_UTM
ORACLES["prj25_clip_to_aoi"] = (
    _SCENES
    + "steps AS (SELECT CAST(i AS DOUBLE) / 22 AS s FROM range(0, 23) AS t(i)), "
    "rim AS (SELECT scene_id, west + (east - west) * s AS lon, south AS lat FROM box, steps "
    "UNION ALL SELECT scene_id, west + (east - west) * s, north FROM box, steps "
    "UNION ALL SELECT scene_id, west, south + (north - south) * s FROM box, steps "
    "UNION ALL SELECT scene_id, east, south + (north - south) * s FROM box, steps), "
    + ", ".join(geodesy_sql.forward("rim", "lon", "lat", "rimxy"))
    + f", clip AS (SELECT scene_id, greatest(min(rimxy.east), {_L}) AS l, "
    f"greatest(min(rimxy.north), {_B}) AS b, least(max(rimxy.east), {_R}) AS r, "
    f"least(max(rimxy.north), {_T}) AS t FROM rimxy GROUP BY scene_id) "
    f"SELECT scene_id, {r('l', 3)} AS clip_left, {r('b', 3)} AS clip_bottom, "
    f"{r('r', 3)} AS clip_right, {r('t', 3)} AS clip_top, "
    f"{r(f'100.0 * (r - l) * (t - b) / {(_R - _L) * (_T - _B)}', 3)} AS coverage_pct "
    "FROM clip WHERE l < r AND b < t"
)


# files and grids of scenes ----------------------------------------------------------------------
def _cloud_from_files(spark, sf_dir):
    """Metadata texts written and scanned; scenes with an unknown projection have none, those from 100 % no number."""
    path = scratch_path(spark, "metadata")
    scenes = _found(spark, sf_dir)
    lines = catalog.metadata_lines(scenes.where("epsg IS NOT NULL"), downloaded="2024-01-21T00:00:00")
    tables.write_scene_metadata(lines, path)
    return catalog.cloud_of_scenes(scenes, tables.read_scene_metadata(spark, path))


QUERIES["src7_cloud_from_files"] = _cloud_from_files
ORACLES["src7_cloud_from_files"] = (
    _SCENES + _FOUND + f"SELECT scene_id, strftime(acquired, '%Y%m%d') || '_' || right(scene_id, 6) AS scene_key, "
    "CASE WHEN epsg IS NULL THEN 100.0 ELSE CAST(printf('%.2f', cloud) AS DOUBLE) END AS cloud FROM found"
)

_TILE = Grid(x0=399960.0, y0=3800040.0, res=10.0, height=10980, width=10980)


def _reference_grids(spark, sf_dir):
    """Whole-pixel grids that the scenes share with one 110 km scene tile."""
    return rounded(catalog.reference_grids(_scenes(spark, sf_dir), _TILE), "coverage")


_BOX_EDGES = (
    "rim AS (SELECT scene_id, CASE side WHEN 1 THEN east WHEN 3 THEN west ELSE west + (east - west) * s END AS lon, "
    "CASE side WHEN 0 THEN south WHEN 2 THEN north ELSE south + (north - south) * s END AS lat FROM box, "
    "(SELECT side, CAST(i AS DOUBLE) / 22 AS s FROM range(0, 4) AS a(side), range(0, 23) AS b(i)) AS steps), "
)
QUERIES["prj26_reference_grids"] = _reference_grids
ORACLES["prj26_reference_grids"] = (
    _SCENES
    + _BOX_EDGES
    + ", ".join(geodesy_sql.forward("rim", "lon", "lat", "rimxy"))
    + ", ends AS (SELECT scene_id, min(east_) AS l, min(north_) AS b, max(east_) AS r, max(north_) AS t FROM "
    "(SELECT scene_id, east AS east_, north AS north_ FROM rimxy) GROUP BY scene_id), "
    "cut AS (SELECT *, greatest(l, 399960.0) AS l1, greatest(b, 3690240.0) AS b1, least(r, 509760.0) AS r1, "
    "least(t, 3800040.0) AS t1 FROM ends) "
    "SELECT scene_id, CAST(399960 + floor((l1 - 399960) / 10 + 0.5) * 10 AS DOUBLE) AS x0, "
    "CAST(3800040 - floor((3800040 - t1) / 10 + 0.5) * 10 AS DOUBLE) AS y0, "
    "CAST(floor((t1 - b1) / 10 + 0.5) AS INT) AS height, CAST(floor((r1 - l1) / 10 + 0.5) AS INT) AS width, "
    + r("(r1 - l1) * (t1 - b1) / ((r - l) * (t - b))")
    + " AS coverage FROM cut WHERE l1 < r1 AND b1 < t1"
)


def _report(spark, sf_dir):
    dem = _dem_catalog(spark, sf_dir).where("epsg IS NOT NULL").select(F.floor(F.col("cloud") * 1000).cast("bigint").alias("bytes"))
    return rounded(catalog.download_report(fixtures.fetched(spark, sf_dir), dem), "mb")


QUERIES["agg20_download_report"] = _report
ORACLES["agg20_download_report"] = (
    _SCENES + _FETCHED + "lines AS (SELECT scene_id AS item, sum(bytes) AS bytes FROM fetched GROUP BY scene_id "
    "UNION ALL SELECT 'DEM tiles', sum(CAST(floor(cloud * 1000) AS BIGINT)) FROM scenes WHERE epsg IS NOT NULL), "
    "every_ AS (SELECT item, bytes FROM lines UNION ALL SELECT 'Total downloaded', sum(bytes) FROM lines) "
    "SELECT item, CAST(bytes AS BIGINT) AS bytes, "
    + r("CAST(bytes AS DOUBLE) / 1048576")
    + " AS mb FROM every_"
)
