"""Regular map grid: pixel addressing, tiling and extent."""

from __future__ import annotations

from dataclasses import dataclass
from decimal import Decimal

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


@dataclass(frozen=True)
class Grid:
    """North-up grid: upper-left corner ``(x0, y0)``, square pixels of ``res`` map units."""

    x0: float
    y0: float
    res: float
    height: int
    width: int
    epsg: int = 32612
    tile: int = 256

    @property
    def tile_rows(self) -> int:
        return -(-self.height // self.tile)

    @property
    def tile_cols(self) -> int:
        return -(-self.width // self.tile)

    @property
    def bounds(self) -> tuple[float, float, float, float]:
        """left, bottom, right, top"""
        return (
            self.x0,
            self.y0 - self.height * self.res,
            self.x0 + self.width * self.res,
            self.y0,
        )

    @property
    def pixel_area_km2(self) -> Decimal:
        """Exact pixel area (PRJ32)."""
        return Decimal(str(self.res)) ** 2 / Decimal(1_000_000)

    # pixel <-> map (PRJ24) ------------------------------------------------------------------
    def x(self, col: Column) -> Column:
        """Easting of the pixel centre."""
        return F.lit(float(self.x0)) + (col + F.lit(0.5)) * F.lit(float(self.res))

    def y(self, row: Column) -> Column:
        """Northing of the pixel centre."""
        return F.lit(float(self.y0)) - (row + F.lit(0.5)) * F.lit(float(self.res))

    def row_at(self, y: Column) -> Column:
        """Row of a northing: truncated towards zero, then clamped to ``[0, height]``."""
        raw = ((F.lit(float(self.y0)) - y) / F.lit(float(self.res))).cast("int")
        return F.greatest(F.lit(0), F.least(F.lit(self.height), raw))

    def col_at(self, x: Column) -> Column:
        raw = ((x - F.lit(float(self.x0))) / F.lit(float(self.res))).cast("int")
        return F.greatest(F.lit(0), F.least(F.lit(self.width), raw))

    def row_of(self, y: float) -> int:
        """Driver-side ``row_at`` for a single constant."""
        return max(0, min(self.height, int((self.y0 - y) / self.res)))

    def window(self, left: Column, bottom: Column, right: Column, top: Column) -> Column:
        """The reference grid of a box on this grid: the part they share, in whole pixels.

        ``x0, y0, height, width, coverage`` (share of the box); null where they do not meet.  Lengths are
        rounded to the nearest pixel, and so are offsets, separately.
        """
        l0, b0, r0, t0 = (F.lit(float(v)) for v in self.bounds)
        l, b, r, t = F.greatest(left, l0), F.greatest(bottom, b0), F.least(right, r0), F.least(top, t0)  # noqa: E741
        res = F.lit(float(self.res))
        size = lambda v: F.floor(v / res + 0.5)
        return F.when(
            (l < r) & (b < t),
            F.struct(
                (l0 + size(l - l0) * res).alias("x0"), (t0 - size(t0 - t) * res).alias("y0"),
                size(t - b).cast("int").alias("height"), size(r - l).cast("int").alias("width"),
                ((r - l) * (t - b) / ((right - left) * (top - bottom))).alias("coverage"),
            ),
        )

    # tables ---------------------------------------------------------------------------------
    def tile_of(self, position: Column) -> Column:
        return F.floor(position / F.lit(self.tile)).cast("int")

    def with_tiles(self, df: DataFrame) -> DataFrame:
        return df.withColumns(
            {"tile_row": self.tile_of(F.col("row")), "tile_col": self.tile_of(F.col("col"))}
        )

    def cells(self, spark: SparkSession) -> DataFrame:
        """Every pixel address of the grid, generated on the executors."""
        return spark.range(self.height * self.width).select(
            F.expr(f"CAST(id DIV {self.width} AS INT)").alias("row"),
            F.expr(f"CAST(id % {self.width} AS INT)").alias("col"),
        )

    def densify(self, df: DataFrame) -> DataFrame:
        """Add the missing pixels of a sparse raster as all-NULL rows."""
        return self.cells(df.sparkSession).join(df, ["row", "col"], "left")
