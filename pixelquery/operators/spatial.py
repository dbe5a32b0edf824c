"""Polygons against pixels (JON1-3, FLT1, FLT7, PRJ27, PRJ30, SET1)."""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from pixelquery.functions import geodesy
from pixelquery.functions.reflectance import clip_evi
from pixelquery.grid import Grid
from pixelquery.schema import BAND_NAMES
from pixelquery.session import cut_lineage


def box_polygons(areas: DataFrame) -> DataFrame:
    """Areas given by centre and half extents in degrees to polygons in lon/lat."""
    lon, lat, dlon, dlat = (F.col(c) for c in ("lon", "lat", "dlon", "dlat"))
    return areas.select(
        *[c for c in areas.columns if c not in ("lon", "lat", "dlon", "dlat")],
        geodesy.box_width_m(dlon, lat).alias("width_m"),
        geodesy.box_height_m(dlat).alias("height_m"),
        geodesy.box_ring(lon - dlon, lat - dlat, lon + dlon, lat + dlat).alias("ring"),
    )


def project_polygons(polygons: DataFrame, zone: int = 12) -> DataFrame:
    """Lon/lat rings to UTM; corners only, edges stay straight."""
    return _with_ring(polygons, geodesy.project_ring(F.col("ring"), zone))


def unproject_polygons(polygons: DataFrame, zone: int = 12) -> DataFrame:
    return _with_ring(polygons, geodesy.unproject_ring(F.col("ring"), zone))


def _with_ring(polygons: DataFrame, ring: Column) -> DataFrame:
    """Replace the ring by a computed one that is evaluated once per polygon.

    A plain projection would be merged into every later expression that mentions the ring, and the
    map projection repeated each time; the optimizer does not merge across ``explode``.
    """
    others = [c for c in polygons.columns if c != "ring"]
    return polygons.select(*others, F.explode(F.array(ring)).alias("ring"))


def _ring_extent(ring: Column) -> dict[str, Column]:
    return {
        "_xmin": F.array_min(ring["x"]),
        "_xmax": F.array_max(ring["x"]),
        "_ymin": F.array_min(ring["y"]),
        "_ymax": F.array_max(ring["y"]),
    }


def _edges(ring: Column) -> Column:
    """Consecutive point pairs of a closed ring."""
    return F.transform(
        F.slice(ring, F.lit(2), F.greatest(F.size(ring) - 1, F.lit(0))),
        lambda p, i: F.struct(
            F.get(ring, i)["x"].alias("x1"),
            F.get(ring, i)["y"].alias("y1"),
            p["x"].alias("x2"),
            p["y"].alias("y2"),
        ),
    )


def _let(value: Column, body) -> Column:
    """``body(value)`` with ``value`` evaluated once, however often the body mentions it."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def _inside(edges: Column, x: Column, y: Column) -> Column:
    """Even-odd test; an edge owns its lower end, so a shared edge counts once."""

    def crosses(e: Column) -> Column:
        at = (e["x2"] - e["x1"]) * (y - e["y1"]) / (e["y2"] - e["y1"]) + e["x1"]
        return F.when((e["y1"] > y) != (e["y2"] > y), x < at).otherwise(F.lit(False))

    return F.aggregate(edges, F.lit(False), lambda odd, e: odd != crosses(e))


def meets_extent(polygons: DataFrame, grid: Grid) -> Column:
    """True for projected polygons whose bounding box meets the raster."""
    left, bottom, right, top = grid.bounds
    e = _ring_extent(F.col("ring"))
    return (
        (e["_xmin"] <= right) & (e["_xmax"] >= left) & (e["_ymin"] <= top) & (e["_ymax"] >= bottom)
    )


def polygons_on_raster(polygons: DataFrame, grid: Grid) -> DataFrame:
    """Polygons that meet the raster extent."""
    return polygons.where(meets_extent(polygons, grid))


def skipped_polygons(polygons: DataFrame, grid: Grid) -> DataFrame:
    """The report of polygons left out: those that do not meet the raster."""
    return polygons.where(~F.coalesce(meets_extent(polygons, grid), F.lit(False)))


def clip_polygons(polygons: DataFrame, grid: Grid) -> DataFrame:
    """Cut rings at the raster extent, one side after the other; empty results are dropped."""
    left, bottom, right, top = grid.bounds

    def cut(axis: str, limit: float, keep_above: bool):
        def keeps(value: Column) -> Column:
            return value >= limit if keep_above else value <= limit

        def step(e: Column) -> Column:
            start, end = e[f"{axis}1"], e[f"{axis}2"]
            share = (F.lit(limit) - start) / (end - start)
            crossing = geodesy.point(
                e["x1"] + (e["x2"] - e["x1"]) * share, e["y1"] + (e["y2"] - e["y1"]) * share
            )
            finish = geodesy.point(e["x2"], e["y2"])
            return (
                F.when(keeps(start) & keeps(end), F.array(finish))
                .when(keeps(start), F.array(crossing))
                .when(keeps(end), F.array(crossing, finish))
                .otherwise(F.slice(F.array(finish), 1, 0))
            )

        return lambda ring: _let(F.flatten(F.transform(_edges(ring), step)), _closed)

    ring = F.col("ring")
    for axis, limit, keep_above in (
        ("x", left, True),
        ("x", right, False),
        ("y", bottom, True),
        ("y", top, False),
    ):
        ring = _let(ring, cut(axis, float(limit), keep_above))
    touching = _with_ring(polygons.where(meets_extent(polygons, grid)), ring)
    return touching.where(_let(F.col("ring"), ring_area) > 0)


def _closed(ring: Column) -> Column:
    """Repeat the first point at the end."""
    return F.concat(ring, F.slice(ring, 1, 1))


def ring_area(ring: Column) -> Column:
    """Area of a closed ring in square map units."""
    twice = F.aggregate(
        _edges(ring), F.lit(0.0), lambda s, e: s + (e["x1"] * e["y2"] - e["x2"] * e["y1"])
    )
    return F.abs(twice) / 2.0


# upper bound of a polygon table that is sent to every executor
BROADCAST_BYTES = 32 * 1024 * 1024
# rings with more edges are tested once, a bit for each pixel of a bucket
HEAVY_EDGES = 64
# rings with more edges are cut into slabs, so that many tasks share them
LONG_EDGES = 20_000
# crossings of edges with rows of pixels, and buckets, that a task holds at once
MASK_BLOCK = 500_000


def bucket_size(grid: Grid) -> int:
    """Side of the join buckets in pixels: about an eighth of a tile and at most 63, dividing it evenly."""
    return next(b for b in range(min(63, max(1, grid.tile // 8)), 0, -1) if grid.tile % b == 0)


def _pixel_ranges(polygons: DataFrame, grid: Grid) -> DataFrame:
    """Pixel rows and columns whose centre lies in the bounding box, and the ring edges."""
    e = _ring_extent(F.col("ring"))
    top, left, res = float(grid.y0), float(grid.x0), float(grid.res)
    return polygons.withColumns(
        {
            "_r0": F.greatest(F.lit(0), F.ceil((F.lit(top) - e["_ymax"]) / res - 0.5).cast("int")),
            "_r1": F.least(
                F.lit(grid.height - 1), F.floor((F.lit(top) - e["_ymin"]) / res - 0.5).cast("int")
            ),
            "_c0": F.greatest(F.lit(0), F.ceil((e["_xmin"] - left) / res - 0.5).cast("int")),
            "_c1": F.least(
                F.lit(grid.width - 1), F.floor((e["_xmax"] - left) / res - 0.5).cast("int")
            ),
            "_edges": _edges(F.col("ring")),
        }
    ).where("_r0 <= _r1 AND _c0 <= _c1")


def polygon_buckets(polygons: DataFrame, grid: Grid) -> DataFrame:
    """Projected polygons, once per pixel bucket they may touch, with their pixel range and ``_edges``.

    Rings of up to ``HEAVY_EDGES`` edges go whole to each bucket.  Of longer ones a bucket gets, in ``_mask``,
    the columns of each of its rows whose centres lie inside (see ``_masks``).  Of those with more than
    ``LONG_EDGES`` it gets the edges near it and, in ``_odd``, a bit for each of its rows: whether an odd number
    of the other edges lies to the right of the bucket there (see ``_slabs``).  So what is sent grows with the
    edges and the buckets, not with their product.  The table is marked for broadcast if its measured size is small, and for a merge
    join otherwise; the optimizer's own estimate does not see how many buckets a polygon covers.
    """
    size = bucket_size(grid)
    per_tile = grid.tile // size
    # rings are read several times, and may be costly to make
    polygons = cut_lineage(polygons, "polygons")
    ranged = _pixel_ranges(polygons, grid)
    rows = (F.col("_r1") - F.col("_r0")) / size + 2
    cols = (F.col("_c1") - F.col("_c0")) / size + 2
    heavy, long_ = F.size("_edges") > HEAVY_EDGES, F.size("_edges") > max(HEAVY_EDGES, LONG_EDGES)
    weight = rows * cols * (F.when(heavy, 2).otherwise(F.size("_edges")) * 48 + 256)
    weight = weight + F.when(long_, F.size("_edges") * 3 * 48).when(heavy, rows * cols * size * 8).otherwise(0)
    measured, n_heavy, n_long = ranged.agg(F.sum(weight), F.count_if(heavy), F.count_if(long_)).first()
    none = F.lit(None).cast("array<bigint>")
    bucketed = ranged.where(~heavy).withColumn("_br", _bucket_range("_r0", "_r1", size)).withColumn(
        "_bc", _bucket_range("_c0", "_c1", size)
    )
    bucketed = bucketed.withColumns({"_odd": F.lit(0).cast("bigint"), "_mask": none})
    if n_heavy > n_long:
        bucketed = bucketed.unionByName(_masks(ranged.where(heavy & ~long_), grid, size))
    if n_long:
        bucketed = bucketed.unionByName(_slabs(ranged.where(long_), grid, size).withColumn("_mask", none))
    bucketed = bucketed.withColumns(
        {
            "tile_row": F.floor(F.col("_br") / per_tile).cast("int"),
            "tile_col": F.floor(F.col("_bc") / per_tile).cast("int"),
        }
    )
    return bucketed.hint("broadcast" if (measured or 0) <= BROADCAST_BYTES else "merge")


def _blocks(weight: np.ndarray, first: np.ndarray, last: np.ndarray) -> Iterator[tuple[slice, np.ndarray, np.ndarray]]:
    """Rings to do together, with their first and last rows; one of very much weight is cut into bands of rows."""
    at = 0
    while at < len(weight):
        stop = at + max(1, int(np.searchsorted(np.cumsum(weight[at:]), MASK_BLOCK, "right")))
        low, high = first[at:stop], last[at:stop]
        step = -(-int(high.max() - low.min() + 1) // (-(-int(weight[at:stop].sum()) // MASK_BLOCK) if stop == at + 1 else 1))
        for band in range(int(low.min()), int(high.max()) + 1, step):
            yield slice(at, stop), np.maximum(low, band), np.minimum(high, band + step - 1)
        at = stop


def _masks(ranged: DataFrame, grid: Grid, size: int) -> DataFrame:
    """Buckets of rings with many edges, and of each of their rows, a bit for each column inside.

    A ring is tested once for each row of pixels that an edge crosses, by the arithmetic of ``_inside``, and
    not once for each pixel.  A task takes rings by blocks of bounded size.
    """
    names = [c for c in ranged.columns if c not in ("ring", "_edges")]
    spread = int(ranged.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    top, left, res, width = float(grid.y0), float(grid.x0), float(grid.res), grid.width
    centres = left + (np.arange(width) + 0.5) * res

    def repeated(first: np.ndarray, last: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        n = np.maximum(last - first + 1, 0)
        of = np.repeat(np.arange(len(n)), n)
        return of, first[of] + np.arange(len(of)) - (np.cumsum(n) - n)[of]

    def block(points: tuple, ring: np.ndarray, low: np.ndarray, high: np.ndarray, c0: np.ndarray, c1: np.ndarray):
        """Ring, bucket row and column, and the bits of the rows of each bucket with pixels inside."""
        x, y, no_x, no_y = points
        edge = np.flatnonzero((ring[1:] == ring[:-1]) & ~no_y[1:] & ~no_y[:-1])
        greater, less = np.maximum(y[edge], y[edge + 1]), np.fmin(y[edge], y[edge + 1])
        first = np.nan_to_num(np.floor((top - greater) / res - 1.5), nan=-np.inf, posinf=np.inf, neginf=-np.inf)
        last = np.nan_to_num(np.ceil((top - less) / res + 0.5), nan=-np.inf, posinf=np.inf, neginf=-np.inf)
        low_of, high_of = low[ring[edge]], high[ring[edge]]
        of, row = repeated(np.clip(first, low_of, high_of + 1).astype(int), np.clip(last, low_of - 1, high_of).astype(int))
        edge = edge[of]
        at_row = top - (row + 0.5) * res
        x1, y1, x2, y2 = x[edge], y[edge], x[edge + 1], y[edge + 1]
        # what is not a number is the greatest, as in SQL
        crosses = (np.isnan(y1) | (y1 > at_row)) != (np.isnan(y2) | (y2 > at_row))
        edge, row, at_row, x1, y1, x2, y2 = (v[crosses] for v in (edge, row, at_row, x1, y1, x2, y2))
        at = (x2 - x1) * (at_row - y1) / (y2 - y1) + x1
        line = ring[edge] * grid.height + row
        unknown = np.unique(line[no_x[edge] | no_x[edge + 1]])  # nothing is known to be inside there
        known = ~np.isin(line, unknown)
        # a crossing turns all columns before it; in order, each second one ends a run
        key = line[known] * (width + 1) + np.searchsorted(centres, at[known], "left")
        lines, counts = np.unique(key // (width + 1), return_counts=True)
        key = np.sort(np.concatenate([key, lines[counts % 2 == 1] * (width + 1)])).reshape(-1, 2)
        line = key[:, 0] // (width + 1)
        of_ring, row = line // grid.height, line % grid.height
        begin = np.maximum(key[:, 0] % (width + 1), c0[of_ring])
        end = np.minimum(key[:, 1] % (width + 1), c1[of_ring] + 1)
        run, bucket = repeated(begin // size, np.where(begin < end, (end - 1) // size, -1))
        one = np.uint64(1)
        bits = (one << np.minimum(end[run] - bucket * size, size).astype(np.uint64)) - (
            one << np.maximum(begin[run] - bucket * size, 0).astype(np.uint64)
        )
        tall, wide = grid.height // size + 1, width // size + 1
        cells, cell = np.unique((of_ring[run] * tall + row[run] // size) * wide + bucket, return_inverse=True)
        masks = np.zeros(len(cells) * size, np.uint64)
        np.bitwise_or.at(masks, cell * size + row[run] % size, bits)
        return cells // wide // tall, cells // wide % tall, cells % wide, masks.view(np.int64)

    def masked(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rings, held = batch.column("ring"), batch.select(names)
            flat, n = rings.flatten(), rings.value_lengths().to_numpy(zero_copy_only=False).astype(int)
            until = np.cumsum(n)
            x, y = (pc.struct_field(flat, i) for i in ("x", "y"))
            points = [v.to_numpy(zero_copy_only=False) for v in (x, y, x.is_null(), y.is_null())]
            r0, r1, c0, c1 = (batch.column(c).to_numpy().astype(int) for c in ("_r0", "_r1", "_c0", "_c1"))
            weight = n * 3 + ((r1 - r0) // size + 2) * ((c1 - c0) // size + 2) + np.add.reduceat(
                np.abs(np.diff(np.nan_to_num(points[1]), append=0.0)) / res, until - n
            ).clip(0, n * (r1 - r0 + 1))
            for part, low, high in _blocks(weight, r0, r1):
                span = slice(until[part][0] - n[part][0], until[part][-1])
                ring = np.repeat(np.arange(part.stop - part.start), n[part])
                with np.errstate(all="ignore"):
                    of, br, bc, masks = block([p[span] for p in points], ring, low, high, c0[part], c1[part])
                if len(of):
                    listed = pa.ListArray.from_arrays(pa.array(np.arange(len(of) + 1) * size, pa.int32()), pa.array(masks))
                    kept = held.take(pa.array(of + part.start))
                    yield pa.RecordBatch.from_arrays(
                        [*kept.columns, pa.array(br, pa.int32()), pa.array(bc, pa.int32()), listed], [*names, "_br", "_bc", "_mask"]
                    )

    made = StructType.fromDDL("_br INT, _bc INT, _mask ARRAY<BIGINT>")
    schema = StructType([*[ranged.schema[c] for c in names], *made])
    found = ranged.select(*names, "ring").repartition(spread).mapInArrow(masked, schema)
    kinds = {c: ranged.schema[c].dataType for c in ("ring", "_edges")}
    return found.withColumns({c: F.lit(None).cast(kind) for c, kind in kinds.items()} | {"_odd": F.lit(0).cast("bigint")})


def _slabs(ranged: DataFrame, grid: Grid, size: int) -> DataFrame:
    """Buckets of rings with very many edges.

    An edge meets few bands of ``size`` pixel rows, and in each a few buckets near it.  For all buckets to
    the left of these it is one crossing to the right, in the rows it spans: bits that are combined by
    exclusive or along each band, from right to left.  Both parts follow the test of ``_inside`` row by row.
    """
    wide = cut_lineage(ranged.withColumn("_id", F.monotonically_increasing_id()), "rings")
    top, left, res = float(grid.y0), float(grid.x0), float(grid.res)
    edge = F.col("e")
    edges = wide.select("_id", "_r0", "_r1", "_c0", "_c1", F.explode("_edges").alias("e")).where("e.y1 <> e.y2")
    # rows between the ends of an edge, and one more on both sides for the sake of rounding
    first = F.floor((F.lit(top) - F.greatest(edge["y1"], edge["y2"])) / res - 1.5).cast("int")
    last = F.ceil((F.lit(top) - F.least(edge["y1"], edge["y2"])) / res + 0.5).cast("int")
    edges = edges.withColumns({"f": F.greatest("_r0", first), "l": F.least("_r1", last)}).where("f <= l")
    bands = edges.withColumn("_br", _bucket_range("f", "l", size))
    bands = bands.withColumns(
        {"f": F.greatest("f", F.col("_br") * size), "l": F.least("l", (F.col("_br") + 1) * size - 1)}
    )

    def crossing(row: Column) -> Column:
        y = F.lit(top) - (row + F.lit(0.5)) * res
        at = (edge["x2"] - edge["x1"]) * (y - edge["y1"]) / (edge["y2"] - edge["y1"]) + edge["x1"]
        return F.greatest(F.least(at, F.greatest(edge["x1"], edge["x2"])), F.least(edge["x1"], edge["x2"]))

    low, high = F.least(crossing(F.col("f")), crossing(F.col("l"))), F.greatest(crossing(F.col("f")), crossing(F.col("l")))
    spans = F.transform(
        F.sequence("f", "l"),
        lambda row: F.when(
            (edge["y1"] > F.lit(top) - (row + F.lit(0.5)) * res) != (edge["y2"] > F.lit(top) - (row + F.lit(0.5)) * res),
            F.call_function("shiftleft", F.lit(1).cast("bigint"), row - F.col("_br") * size),
        ).otherwise(F.lit(0).cast("bigint")),
    )
    bands = bands.withColumns(
        {
            "n0": F.floor((low - left) / res / size - 2.0 / size).cast("int"),
            "n1": F.floor((high - left) / res / size + 2.0 / size).cast("int"),
            "bits": F.aggregate(spans, F.lit(0).cast("bigint"), lambda s, bit: s.bitwiseOR(bit)),
        }
    )
    begin, end = F.floor(F.col("_c0") / size).cast("int"), F.floor(F.col("_c1") / size).cast("int")
    # every bucket of the ring's range, so that those without an edge nearby get their bits too
    cells = wide.select("_id", "_r0", "_r1", "_c0", "_c1", _bucket_range("_r0", "_r1", size).alias("_br"))
    cells = cells.select("_id", "_br", _bucket_range("_c0", "_c1", size).alias("_bc"))
    # the bits of an edge count for buckets before the first near one: they are kept at that border
    border = F.greatest(F.least("n0", end + 1), begin)
    bits = bands.where(F.col("n0") > begin).groupBy("_id", "_br", (border - 1).alias("_bc")).agg(F.bit_xor("bits").alias("bits"))
    near = bands.select(
        "_id", "_br", F.explode(F.when(F.greatest("n0", begin) <= F.least("n1", end),
        F.sequence(F.greatest("n0", begin), F.least("n1", end))).otherwise(F.array().cast("array<int>"))).alias("_bc"), "e",
    ).groupBy("_id", "_br", "_bc").agg(F.collect_list("e").alias("_edges"))
    key = ["_id", "_br", "_bc"]
    from_right = Window.partitionBy("_id", "_br").orderBy(F.desc("_bc")).rowsBetween(Window.unboundedPreceding, 0)
    table = cells.join(bits, key, "left").withColumn("_odd", F.coalesce(F.bit_xor("bits").over(from_right), F.lit(0)))
    table = table.drop("bits").join(near, key, "left").where("_odd <> 0 OR _edges IS NOT NULL")
    none = F.array().cast(ranged.schema["_edges"].dataType)
    table = table.withColumn("_edges", F.coalesce("_edges", none))
    return table.join(wide.drop("_edges"), "_id").drop("_id")


def _bucket_range(first: str, last: str, size: int) -> Column:
    return F.explode(
        F.sequence(F.floor(F.col(first) / size).cast("int"), F.floor(F.col(last) / size).cast("int"))
    )


def _bit(bits: Column, place: Column) -> Column:
    return F.call_function("shiftright", bits, place).bitwiseAND(F.lit(1).cast("bigint")) == 1


def label_pixels(pixels: DataFrame, polygons: DataFrame, grid: Grid) -> DataFrame:
    """Pixels whose centre lies in a projected polygon, once per polygon that holds them.

    Polygons are bucketed by small squares of pixels, which turns the range condition into an
    equi-join with a cheap range test and a ring test on the few candidates.  The tile is part of
    the key, so a raster stored by tile row is pruned to the tiles that carry polygons.  The polygon
    side is broadcast only if its measured size is small; otherwise both sides are shuffled by
    bucket, and a bucket with very many polygons is split by the adaptive skew join.
    """
    size = bucket_size(grid)
    if "tile_row" not in pixels.columns:
        pixels = grid.with_tiles(pixels)
    keyed = pixels.withColumns(
        {
            "_br": F.floor(F.col("row") / size).cast("int"),
            "_bc": F.floor(F.col("col") / size).cast("int"),
        }
    )
    shapes = polygon_buckets(polygons, grid)
    carried = [c for c in polygons.columns if c != "ring"]
    joined = keyed.join(shapes, ["tile_row", "tile_col", "_br", "_bc"])
    row, col = keyed["row"], keyed["col"]
    hits = joined.where(
        row.between(F.col("_r0"), F.col("_r1"))
        & col.between(F.col("_c0"), F.col("_c1"))
        & F.when(F.col("_mask").isNotNull(), _bit(F.get("_mask", row - F.col("_br") * size), col - F.col("_bc") * size))
        .otherwise(_inside(F.col("_edges"), grid.x(col), grid.y(row)) != _bit(F.col("_odd"), row - F.col("_br") * size))
    )
    return hits.select(*[F.col(c) for c in carried], *[keyed[c] for c in pixels.columns])


def training_table(
    stack: DataFrame,
    polygons: DataFrame,
    grid: Grid,
    clip: bool = True,
    keep: tuple[str, ...] = (),
) -> DataFrame:
    """Labelled feature rows: pixels inside polygons, EVI clipped, any nodata band drops the row."""
    labelled = label_pixels(stack, polygons.select("class", "class_id", "ring"), grid)
    if clip:
        labelled = labelled.withColumn("EVI", clip_evi(F.col("EVI")))
    return labelled.dropna("any", subset=BAND_NAMES).select(
        "class", "class_id", *keep, *BAND_NAMES
    )
