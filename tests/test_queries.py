"""Registered queries against their SQL in DuckDB.

A sample runs by default; PIXELQUERY_ALL_QUERIES=1 runs every query that has SQL.
"""

import os
from pathlib import Path

import duckdb
import pytest
from pixelquery.queries import ORACLES, QUERIES

SF = Path("/root/testdata/sf0.001")
SAMPLE = [
    "prj9_evi",
    "agg1_band_statistics",
    "agg3_percentiles",
    "feature_stack",
    "prj25_clip_to_aoi",
    "training_table",
    "jon8_warp_to_utm",
    "set2_area_table_with_total",
    "agg10_area_with_other_ids",
    "agg14_confusion_with_other_ids",
    "jon4_align_layers",
    "agg16_class_report",
    "agg17_connected_regions",
    "src4_not_yet_fetched",
    "src7_cloud_from_metadata",
    "win7_stratified_split",
    "agg21_best_scene",
    "jon2_polygons_on_raster",
    "jon2_polygons_skipped",
    "snk2_geojson_polygons",
    "src9_geojson_scan",
    "src7_cloud_from_files",
    "prj26_reference_grids",
    "agg18_region_rings",
    "agg19_simplified_boundaries",
    "snk7_region_layer",
    "flt2_scored_pixels",
]


@pytest.fixture(scope="module")
def database():
    connection = duckdb.connect()
    for file in SF.glob("*.parquet"):
        connection.execute(f"CREATE VIEW {file.stem} AS SELECT * FROM '{file}'")
    return connection


def test_every_sql_belongs_to_a_query():
    assert set(ORACLES) <= set(QUERIES)
    without = set(QUERIES) - set(ORACLES)
    assert all(name.startswith(("ml", "agg19")) for name in without)


@pytest.mark.parametrize("name", ORACLES if os.environ.get("PIXELQUERY_ALL_QUERIES") else SAMPLE)
def test_same_rows_as_sql(spark, database, name):
    df = QUERIES[name](spark, str(SF))
    columns = sorted(df.columns)
    cursor = database.execute(ORACLES[name])
    order = [d[0] for d in cursor.description]
    assert sorted(order) == columns
    expected = [tuple(row[order.index(c)] for c in columns) for row in cursor.fetchall()]
    got = [tuple(row) for row in df.select(*columns).collect()]
    assert sorted(map(repr, got)) == sorted(map(repr, expected))
