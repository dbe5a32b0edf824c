"""Rasters as Parquet, partitioned by tile row (SRC8, SRC12, SNK1, SNK4, SNK6)."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from pixelquery.grid import Grid
from pixelquery.operators.focal import by_tile
from pixelquery.schema import NODATA_CLASS


def write_raster(df: DataFrame, grid: Grid, path: str, clustered: bool = False) -> None:
    """Compressed, one directory per tile row, pixels of a tile next to each other.

    Rows are shuffled by tile so that a file holds whole tiles and row-group statistics on
    ``tile_col`` prune; a tile row is spread over many tasks, not written by one.  Say ``clustered``
    if the rows of a tile already share a task, as after the focal operators, to save that shuffle.
    """
    if "tile_row" not in df.columns:
        df = grid.with_tiles(df)
    if not clustered:
        df = by_tile(df, grid)
    (
        df.sortWithinPartitions("tile_row", "tile_col", "row", "col")
        .write.option("compression", "zstd")
        .partitionBy("tile_row")
        .parquet(path)
    )


def raster_schema(bands: dict[str, T.DataType] | list[str]) -> T.StructType:
    """Schema of a stored raster; a list of names means DOUBLE bands."""
    if not isinstance(bands, dict):
        bands = {b: T.DoubleType() for b in bands}
    fields = {"tile_col": T.IntegerType(), "row": T.IntegerType(), "col": T.IntegerType()}
    fields |= bands
    fields["tile_row"] = T.IntegerType()
    return T.StructType([T.StructField(n, t) for n, t in fields.items()])


def read_raster(
    spark: SparkSession,
    path: str,
    bands: dict[str, T.DataType] | list[str],
    window: tuple[int, int, int, int] | None = None,
    tile: int | None = None,
) -> DataFrame:
    """Scan bands, optionally only rows ``[r0, r1)`` and columns ``[c0, c1)``.

    With the tile size that the raster was written with, the window also restricts ``tile_row``
    (directory pruning) and ``tile_col`` (row-group pruning); without it, row groups are pruned by
    ``row`` and ``col`` alone.
    """
    df = spark.read.schema(raster_schema(bands)).parquet(path)
    if window:
        r0, r1, c0, c1 = window
        if tile:
            df = df.where(
                F.col("tile_row").between(r0 // tile, (r1 - 1) // tile)
                & F.col("tile_col").between(c0 // tile, (c1 - 1) // tile)
            )
        df = df.where(F.col("row").between(r0, r1 - 1) & F.col("col").between(c0, c1 - 1))
    return df


def write_classes(
    pred: DataFrame, grid: Grid, path: str, column: str = "class_id"
) -> None:
    """Class raster with nodata stored as 255."""
    stored = pred.select("row", "col", F.coalesce(column, F.lit(NODATA_CLASS)).alias("class_id"))
    write_raster(stored, grid, path)


def read_classes(spark: SparkSession, path: str, **options) -> DataFrame:
    raw = read_raster(spark, path, {"class_id": T.IntegerType()}, **options)
    return raw.withColumn("class_id", F.nullif(F.col("class_id"), F.lit(NODATA_CLASS)))


def update_classes(spark: SparkSession, path: str, grid: Grid, rule) -> str:
    """Apply ``rule`` to a stored class raster and return the path of the new version.

    The version being read stays untouched, so a failed or retried job never loses the input.
    """
    base = path.rstrip("/").split("@v-")[0]
    target = f"{base}@v-{uuid.uuid4().hex}"
    write_classes(rule(read_classes(spark, path)), grid, target)
    return target
