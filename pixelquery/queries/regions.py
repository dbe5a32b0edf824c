"""Connected regions, dissolve and boundary simplification (AGG17-19)."""

from __future__ import annotations

from pyspark.sql import functions as F

from pixelquery import fixtures
from pixelquery.operators import outlines, regions
from pixelquery.queries.classes import _DIM
from pixelquery.queries.common import with_grid, with_grid_recursive

QUERIES = {}
ORACLES = {}


def _regions(spark, sf_dir):
    return regions.connected_regions(
        fixtures.classes(spark, sf_dir), fixtures.pixel_grid(spark, sf_dir)
    )


# the lowest pixel id of a region spreads to all its pixels, which all have higher ids
_REGIONS = (
    "cells AS (SELECT k, r, c, y_pred AS v FROM grid WHERE y_pred IS NOT NULL)",
    "near AS (SELECT a.k AS k1, b.k AS k2 FROM cells a JOIN cells b ON a.v = b.v AND "
    "((a.r = b.r AND abs(a.c - b.c) = 1) OR (a.c = b.c AND abs(a.r - b.r) = 1)))",
    "reach(k, lbl) AS (SELECT k, k FROM cells UNION SELECT n.k2, reach.lbl FROM reach "
    "JOIN near n ON n.k1 = reach.k WHERE reach.lbl < n.k2)",
    "labels AS (SELECT k, min(lbl) AS region_id FROM reach GROUP BY k)",
    "sides AS (SELECT k1 AS k, count(*) AS inner_ FROM near GROUP BY k1)",
    "reg AS (SELECT l.region_id, v AS class_id, count(*) AS pixels, min(r) AS min_row, "
    "max(r) AS max_row, min(c) AS min_col, max(c) AS max_col, "
    "CAST(sum(4 - coalesce(inner_, 0)) * 350 AS DOUBLE) AS perimeter "
    "FROM labels l JOIN cells ON cells.k = l.k LEFT JOIN sides ON sides.k = l.k GROUP BY 1, 2)",
)

QUERIES["agg17_connected_regions"] = _regions
ORACLES["agg17_connected_regions"] = with_grid_recursive(
    "SELECT reg.*, class_name FROM reg JOIN dim ON reg.class_id = dim.class_id", _DIM, *_REGIONS
)
QUERIES["agg18_dissolve"] = lambda spark, sf_dir: regions.dissolve(_regions(spark, sf_dir))
ORACLES["agg18_dissolve"] = with_grid_recursive(
    "SELECT reg.class_id, class_name, count(*) AS parts, CAST(sum(pixels) AS BIGINT) AS pixels, "
    "min(min_row) AS min_row, max(max_row) AS max_row, min(min_col) AS min_col, "
    "max(max_col) AS max_col, sum(perimeter) AS perimeter "
    "FROM reg JOIN dim ON reg.class_id = dim.class_id GROUP BY 1, 2",
    _DIM,
    *_REGIONS,
)


def rings_of(spark, sf_dir):
    return outlines.region_rings(fixtures.classes(spark, sf_dir), fixtures.pixel_grid(spark, sf_dir))


def _rings(spark, sf_dir):
    """Rings, holes, corners and area of every region, from its ordered boundary."""
    rings, corners = rings_of(spark, sf_dir)
    turns = corners.groupBy("ring").agg(F.count("*").alias("turns"))
    cell = fixtures.PIXEL_M**2
    return rings.join(turns, "ring").groupBy("region_id", "class_id").agg(
        F.count("*").alias("rings"), F.sum(F.col("hole").cast("long")).alias("holes"), F.sum("edges").alias("edges"),
        F.sum("turns").alias("corners"), (F.sum("area") * cell).alias("area_m2"),
    )


# a region's holes follow from pixels, pairs and squares; a pixel's corner turns where both neighbours
# differ, or where both are alike and the one between them is not
_NEAR = {"u": (-1, 0), "d": (1, 0), "l": (0, -1), "r_": (0, 1), "ul": (-1, -1), "ur": (-1, 1), "dl": (1, -1), "dr": (1, 1)}
RING_CTES = (
    *_REGIONS,
    "nb AS (SELECT a.k, " + ", ".join(f"coalesce({n}.v = a.v, false) AS {n}" for n in _NEAR) + " FROM cells a "
    + " ".join(f"LEFT JOIN cells {n} ON {n}.r = a.r + {y} AND {n}.c = a.c + {x}" for n, (y, x) in _NEAR.items()) + ")",
    "shape AS (SELECT region_id, count(*) AS pixels, sum(CAST(r_ AS INT) + CAST(d AS INT)) AS pairs, "
    "sum(CAST(r_ AND d AND dr AS INT)) AS squares, "
    "sum(4 - CAST(u AS INT) - CAST(d AS INT) - CAST(l AS INT) - CAST(r_ AS INT)) AS edges, sum("
    + " + ".join(
        f"CAST((NOT {a} AND NOT {b}) OR ({a} AND {b} AND NOT {ab}) AS INT)"
        for a, b, ab in (("u", "l", "ul"), ("u", "r_", "ur"), ("d", "l", "dl"), ("d", "r_", "dr"))
    )
    + ") AS corners FROM nb JOIN labels USING (k) GROUP BY region_id)",
)
QUERIES["agg18_region_rings"] = _rings
ORACLES["agg18_region_rings"] = with_grid_recursive(
    "SELECT region_id, class_id, CAST(2 - (s.pixels - pairs + squares) AS BIGINT) AS rings, "
    "CAST(1 - (s.pixels - pairs + squares) AS BIGINT) AS holes, CAST(edges AS BIGINT) AS edges, "
    "CAST(corners AS BIGINT) AS corners, CAST(s.pixels * 122500 AS DOUBLE) AS area_m2 "
    "FROM shape s JOIN reg USING (region_id)",
    *RING_CTES,
)


def _boundaries(spark, sf_dir):
    """Lines between each two classes: unit edges before, end points and distinct ends after simplifying."""
    grid = fixtures.pixel_grid(spark, sf_dir)
    lines = outlines.boundary_lines(fixtures.classes(spark, sf_dir), grid, 2.0 * grid.res)
    # the edges of a line go with its first end, so the lines are made once
    spot = lambda p, edges: F.struct(p.alias("p"), edges.cast("long").alias("edges"))
    first, last = (F.element_at("points", i) for i in (1, -1))
    ends = F.when(~F.col("closed"), F.array(spot(first, F.col("edges")), spot(last, F.lit(0))))
    spots = F.coalesce(ends, F.array(spot(F.lit(None).cast("struct<x: double, y: double>"), F.col("edges"))))
    return lines.select("class_a", "class_b", F.inline(spots)).groupBy("class_a", "class_b").agg(
        F.sum("edges").alias("edges"), F.countDistinct("p.x", "p.y").alias("ends")
    )


QUERIES["agg19_simplified_boundaries"] = _boundaries
ORACLES["agg19_simplified_boundaries"] = with_grid(
    "SELECT a AS class_a, b AS class_b, n AS edges, count(DISTINCT p) AS ends FROM "
    "(SELECT a, b, count(*) AS n FROM sides GROUP BY a, b) "
    "LEFT JOIN (SELECT a AS a1, b AS b1, p FROM spots JOIN (SELECT p FROM spots GROUP BY p HAVING count(*) <> 2) USING (p)) "
    "ON a = a1 AND b = b1 GROUP BY a, b, n",
    "full_ AS (SELECT r, c, coalesce(y_pred, -1) AS v FROM grid)",
    "facing AS (SELECT r, c, v, coalesce(lag(v) OVER (PARTITION BY c ORDER BY r), -1) AS up, "
    "coalesce(lag(v) OVER (PARTITION BY r ORDER BY c), -1) AS le FROM full_)",
    "met AS (SELECT r AS r1, c AS c1, r AS r2, c + 1 AS c2, v, up AS w FROM facing "
    "UNION ALL SELECT r, c, r + 1, c, v, le FROM facing "
    "UNION ALL SELECT r + 1, c, r + 1, c + 1, v, -1 FROM full_, size WHERE r + 1 = h "
    "UNION ALL SELECT r, c + 1, r + 1, c + 1, v, -1 FROM full_, size WHERE c + 1 = w)",
    "sides AS (SELECT *, least(v, met.w) AS a, greatest(v, met.w) AS b FROM met WHERE v <> met.w)",
    "spots AS (SELECT a, b, [r1, c1] AS p FROM sides UNION ALL SELECT a, b, [r2, c2] FROM sides)",
)
