"""Class rasters: reclassification rules, colours and area reports (FLT4-6, PRJ29, AGG8-13)."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from pixelquery.functions.geodesy import lonlat_to_utm_point, utm_to_lonlat
from pixelquery.grid import Grid
from pixelquery.schema import (
    BARE_SOIL_ID,
    LAT_WATER_THRESHOLD,
    LON_REFERENCE,
    NODATA_RGB,
    VEGETATION_ID,
    WATER_ID,
    class_dimension,
)

OTHER = "Other"


def threshold_row(
    grid: Grid, lat: float = LAT_WATER_THRESHOLD, lon: float = LON_REFERENCE
) -> int:
    """First row that is not north of the latitude, taken at one reference longitude."""
    return grid.row_of(lonlat_to_utm_point(lon, lat)[1])


def north_by_row(limit: int) -> Column:
    return F.col("row") < limit


def north_by_latitude(grid: Grid, lat: float = LAT_WATER_THRESHOLD) -> Column:
    """Exact alternative to the row rule: the latitude of each pixel centre."""
    return utm_to_lonlat(grid.x(F.col("col")), grid.y(F.col("row")))[1] > lat


def reclassify(
    pred: DataFrame,
    where: Column,
    sources: Sequence[int],
    target: int = BARE_SOIL_ID,
    column: str = "class_id",
) -> DataFrame:
    """Give ``target`` to the pixels of ``sources`` that meet a condition; nodata stays NULL."""
    hit = where & F.col(column).isin(*sources)
    return pred.withColumn(column, F.when(hit, F.lit(target)).otherwise(F.col(column)))


def water_rule(pred: DataFrame, where: Column) -> DataFrame:
    """Water in the northern zone becomes bare soil."""
    return reclassify(pred, where, [WATER_ID])


def northern_mask(pred: DataFrame, where: Column) -> DataFrame:
    """Vegetation and water in the northern zone become bare soil."""
    return reclassify(pred, where, [VEGETATION_ID, WATER_ID])


def valid_pixels(pred: DataFrame, column: str = "class_id") -> DataFrame:
    return pred.where(F.col(column).isNotNull())


def with_class_names(df: DataFrame, column: str = "class_id") -> DataFrame:
    """Look up the class name of an id; the class table has six rows, so it is broadcast."""
    names = class_dimension(df.sparkSession).select(F.col("class_id").alias(column), "class_name")
    return df.join(F.broadcast(names), column, "left")


def colours(pred: DataFrame, column: str = "class_id") -> DataFrame:
    """RGB per pixel: class colour, light grey for nodata, black for unknown ids."""
    palette = class_dimension(pred.sparkSession).select(
        F.col("class_id").alias(column), "red", "green", "blue"
    )
    painted = pred.join(F.broadcast(palette), column, "left")
    missing = F.col(column).isNull()
    return painted.withColumns(
        {
            band: F.when(missing, F.lit(grey)).otherwise(F.coalesce(F.col(band), F.lit(0)))
            for band, grey in zip(("red", "green", "blue"), NODATA_RGB, strict=True)
        }
    )


def class_counts(pred: DataFrame, column: str = "class_id") -> DataFrame:
    """Pixels per class: classes of the class table without pixels have 0, other ids are named Other."""
    counts = valid_pixels(pred, column).groupBy(column).agg(F.count("*").alias("n"))
    dim = class_dimension(pred.sparkSession).select("class_id", "class_name")
    joined = dim.join(counts.withColumnRenamed(column, "class_id"), "class_id", "full")
    name = F.coalesce("class_name", F.lit(OTHER)).alias("class_name")
    return joined.select("class_id", name, F.coalesce("n", F.lit(0)).alias("pixels"))


def area_table(
    pred: DataFrame, grid: Grid, column: str = "class_id", rounded: bool = True
) -> DataFrame:
    """Area and share per class, then a TOTAL row.  Shares and TOTAL are of all valid pixels.

    Areas are exact decimals, so rounding to 2 places and the total of the rounded areas do not
    depend on the order of summation.  ``rounded=False`` gives the plain doubles.
    """
    counts = class_counts(pred, column)
    # a row per class: the window does not touch pixels
    all_valid = F.sum("pixels").over(Window.partitionBy())
    area = F.col("pixels").cast("decimal(20,0)") * F.lit(grid.pixel_area_km2).cast("decimal(18,10)")
    share = F.coalesce(
        F.try_divide(F.col("pixels").cast("double"), all_valid) * 100.0, F.lit(0.0)
    )
    rows = counts.select(
        "class_id",
        "class_name",
        "pixels",
        (F.round(area, 2) if rounded else area).alias("area_km2"),
        (F.round(share, 1) if rounded else share).alias("pct"),
    )
    total = rows.agg(
        F.lit(-1).alias("class_id"),
        F.lit("TOTAL").alias("class_name"),
        F.sum("pixels").alias("pixels"),
        F.sum("area_km2").alias("area_km2"),
        F.lit(100.0).alias("pct"),
    )
    return rows.unionByName(total).withColumn("area_km2", F.col("area_km2").cast("double"))


def reclassified_counts(
    before: DataFrame, where: Column, sources: Sequence[int], grid: Grid, column: str = "class_id"
) -> DataFrame:
    """How many pixels of each source class the rule moves, with their area."""
    after = reclassify(before.withColumn("_before", F.col(column)), where, sources, column=column)
    moved = after.where(F.col("_before") != F.col(column))
    area = F.count("*").cast("decimal(20,0)") * F.lit(grid.pixel_area_km2).cast("decimal(18,10)")
    return moved.groupBy(
        F.col("_before").alias("from_class"), F.col(column).alias("to_class")
    ).agg(F.count("*").alias("pixels"), area.cast("double").alias("area_km2"))


def zone_counts(pred: DataFrame, where: Column, column: str = "class_id") -> DataFrame:
    """Class counts inside a zone; nodata pixels count in the denominator but get no row."""
    counts = pred.where(where).groupBy(column).agg(F.count("*").alias("pixels"))
    whole = F.sum("pixels").over(Window.partitionBy())
    shares = counts.withColumn("pct", F.col("pixels") * 100.0 / whole)
    return with_class_names(shares.where(F.col(column).isNotNull()), column)
