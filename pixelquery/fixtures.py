"""Pixel grid, scene catalogue and training areas derived from the star-schema test tables.

One order is one pixel of a grid 100 columns wide, so the grid grows with the tables.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pixelquery.grid import Grid
from pixelquery.schema import SCENE_BANDS, SPECTRAL_BANDS

GRID_WIDTH = 100
ORIGIN = (399960.0, 3729900.0)
PIXEL_M = 350.0


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def pixel_grid(spark: SparkSession, sf_dir: str, tile: int = 64) -> Grid:
    last = table(spark, sf_dir, "orders").agg(F.max("o_orderkey")).first()[0]
    return Grid(*ORIGIN, PIXEL_M, height=last // GRID_WIDTH + 1, width=GRID_WIDTH, tile=tile)


def _address(key: str):
    return [
        F.floor(F.col(key) / 100.0).cast("int").alias("row"),
        (F.col(key) % 100).cast("int").alias("col"),
    ]


def line_totals(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Per order: lines, whole quantity and whole price."""
    return (
        table(spark, sf_dir, "lineitem")
        .groupBy(F.col("l_orderkey").alias("k"))
        .agg(
            F.count("*").alias("n"),
            F.sum(F.floor("l_quantity").cast("bigint")).alias("q"),
            F.sum(F.floor("l_extendedprice").cast("bigint")).alias("p"),
        )
    )


def _band_columns():
    n, q, p = F.col("n"), F.col("q"), F.col("p")
    return {
        "B02": F.when(q % 97 == 0, F.lit(0)).otherwise(F.lit(200) + (q * 7) % 1800),
        "B03": F.lit(300) + (q * 11 + n * 131) % 2200,
        "B04": F.lit(250) + p % 2800,
        "B08": F.when(p % 89 == 0, F.lit(0)).otherwise(F.lit(400) + (p * 3 + q) % 4600),
        "B11": F.lit(500) + (p * 5 + n) % 3900,
        "B12": F.lit(450) + (p * 7 + q * 13) % 3100,
    }


def pixels(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``row, col, x, y, B02..B12 (DN), Elevation, y_true, y_pred``; NULL class is nodata."""
    # spread the one-file table by the join key: the shuffle the join to the line totals needs anyway
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    orders = (
        table(spark, sf_dir, "orders")
        .select(F.col("o_orderkey").alias("k"), "o_custkey", "o_orderpriority")
        .repartition(parts, "k")
    )
    customers = table(spark, sf_dir, "customer").select(
        F.col("c_custkey").alias("o_custkey"), "c_acctbal"
    )
    joined = orders.join(line_totals(spark, sf_dir), "k", "left").join(
        customers, "o_custkey", "left"
    )
    bands = _band_columns()
    row, col = _address("k")
    px = joined.select(
        "k",
        row,
        col,
        *[c.alias(name) for name, c in bands.items()],
        F.when(F.col("o_custkey") % 50 != 0, F.col("c_acctbal") * 0.05 + 300.0).alias("Elevation"),
        F.when(F.col("k") % 11 == 0, F.lit(5))
        .otherwise(F.substring("o_orderpriority", 1, 1).cast("int") - 1)
        .alias("y_true"),
    )
    no_scene = F.col("B02").isNull() | (F.col("B02") == 0) | (F.col("B08") == 0)
    return px.select(
        "row",
        "col",
        ((F.col("col") + 0.5) * PIXEL_M + ORIGIN[0]).alias("x"),
        (F.lit(ORIGIN[1]) - (F.col("row") + 0.5) * PIXEL_M).alias("y"),
        *SPECTRAL_BANDS,
        "Elevation",
        "y_true",
        F.when(no_scene, F.lit(None).cast("int"))
        .when(F.col("k") % 9 == 0, (F.col("y_true") + 1) % 6)
        .otherwise(F.col("y_true"))
        .alias("y_pred"),
    )


def classes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The class raster: ``row, col, class_id``."""
    return pixels(spark, sf_dir).select("row", "col", F.col("y_pred").alias("class_id"))


def band_layer(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Spectral layer on its own, from lineitem only (pixels without lines are absent)."""
    row, col = _address("k")
    return line_totals(spark, sf_dir).select(
        row, col, *[c.alias(name) for name, c in _band_columns().items()]
    )


def elevation_layer(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Terrain layer on its own, from orders and customer."""
    return pixels(spark, sf_dir).select("row", "col", "Elevation")


def scenes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Scene catalogue: one event is one scene.

    The event type decides which band is missing from the asset map and which property is unknown.
    """
    e = table(spark, sf_dir, "events")
    west = F.lit(-113.4) + (F.col("user_id") * 7 % 240) / 100.0
    south = F.lit(32.4) + (F.col("event_id") * 13 % 200) / 100.0
    missing = (
        F.when(F.col("event_type") == "error", F.lit("B11"))
        .when(F.col("event_type") == "signup", F.lit("SCL"))
        .when(F.col("event_type") == "view", F.lit("B02"))
        .otherwise(F.lit("none"))
    )
    present = F.filter(F.array(*[F.lit(b) for b in SCENE_BANDS]), lambda b: b != missing)
    return e.select(
        F.concat(F.lit("S2_MSIL2A_"), F.lpad(F.col("event_id").cast("string"), 9, "0")).alias(
            "scene_id"
        ),
        F.when(F.col("event_type") != "click", F.col("ts")).alias("acquired"),
        F.col("value").alias("cloud"),
        F.struct(
            west.alias("west"),
            south.alias("south"),
            (west + 1.1).alias("east"),
            (south + 0.9).alias("north"),
        ).alias("bbox"),
        F.when(F.col("event_type") != "purchase", F.lit("32612")).alias("epsg"),
        F.map_from_arrays(
            present,
            F.transform(
                present,
                lambda b: F.concat(F.lit("s/"), F.col("event_id").cast("string"), F.lit("/"), b),
            ),
        ).alias("assets"),
    )


def fetched(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Manifest of scene bands already fetched: those of purchase scenes, with their sizes."""
    e = table(spark, sf_dir, "events").where("event_type IN ('purchase', 'view')")
    bands = F.when(F.col("event_type") == "purchase", F.array(F.lit("B02"), F.lit("B08"))).otherwise(
        F.array(F.lit("B04"))
    )
    return e.select(
        F.concat(F.lit("S2_MSIL2A_"), F.lpad(F.col("event_id").cast("string"), 9, "0")).alias(
            "scene_id"
        ),
        F.explode(bands).alias("band"),
        F.floor(F.col("value") * 10000).cast("bigint").alias("bytes"),
    )


def areas(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Training areas that grow with the data: one box per customer, class by market segment."""
    key = F.col("c_custkey")
    segment = F.array_position(
        F.array(*[F.lit(s) for s in SEGMENTS]), F.col("c_mktsegment")
    ).cast("int")
    return table(spark, sf_dir, "customer").select(
        key.alias("area_id"),
        F.element_at(F.array(*[F.lit(c) for c in SEGMENT_CLASSES]), segment).alias("class"),
        segment.alias("class_id"),
        (F.lit(-112.10) + (key * 37 % 430) / 1000.0).alias("lon"),
        (F.lit(33.73) - (key * 53 % 520) / 1000.0).alias("lat"),
        (F.lit(0.004) + (F.col("c_nationkey") % 5) / 1000.0).alias("dlon"),
        (F.lit(0.003) + (F.col("c_nationkey") % 4) / 1000.0).alias("dlat"),
        F.col("c_name").alias("desc"),
    )


SEGMENTS = ["AUTOMOBILE", "BUILDING", "FURNITURE", "HOUSEHOLD", "MACHINERY"]
SEGMENT_CLASSES = ["Urban", "Vegetation", "Agricultural", "Bare_Soil", "Industrial"]
