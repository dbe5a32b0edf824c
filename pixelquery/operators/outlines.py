"""Outlines of a class raster: rings of regions, and lines between junctions (AGG18-19).

Every side of a pixel that faces another class is a directed edge with the pixel on its right; its
follower around the same region is known from the cells around its end.  A tile joins its edges into
chains; chains are linked across tiles by the number of the edge that follows, and ordered by pointer
jumping, so no task holds more than a tile and nothing depends on the size of tiles.  An edge is numbered
by its pixel and side (top, right, bottom, left).
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from pixelquery.functions.geodesy import point
from pixelquery.grid import Grid
from pixelquery.operators.focal import halo
from pixelquery.operators.regions import connected_roots, label_patches, patch_borders, tile_patches
from pixelquery.operators.simplify import OUTSIDE, simplified_lines
from pixelquery.schema import SIMPLIFY_TOLERANCE_M
from pixelquery.session import cut_lineage, discard

#: Steps in row and column from a pixel to the one that each side faces, to the next one along the side, and
#: to the one beside that; and to the corner where the side ends.
FACING = ((-1, 0), (0, 1), (1, 0), (0, -1))
AHEAD = ((0, 1), (1, 0), (0, -1), (-1, 0))
BESIDE = ((-1, 1), (1, 1), (1, -1), (-1, -1))
END = ((0, 1), (1, 1), (1, 0), (0, 0))
#: Unit edges of a line that are simplified together; longer lines keep a point there.
LONGEST = 100_000
_FIELDS = pa.schema(
    [("kind", pa.string()), ("chain", pa.int64()), ("next", pa.int64()), ("patch", pa.int64()),
     ("class_id", pa.int32()), ("other", pa.int32()), ("edges", pa.int64()), ("area", pa.int64()),
     ("low", pa.int64()), ("low_at", pa.int64()), ("at", pa.int64()), ("row", pa.int32()), ("col", pa.int32())]
)
_SCHEMA = (
    "kind STRING, chain BIGINT, next BIGINT, patch BIGINT, class_id INT, other INT, edges BIGINT, area BIGINT, "
    "low BIGINT, low_at BIGINT, at BIGINT, row INT, col INT"
)


def followed(after: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Start of each edge's chain, its place there, and whether the chain is closed.

    ``after`` is the edge that follows each edge, -1 for none.  A closed chain starts at its first edge.
    """
    n = len(after)
    every = np.arange(n)
    rounds = int(n).bit_length() + 1
    jump, least = np.where(after < 0, every, after), every.copy()
    for _ in range(rounds):
        least = np.minimum(least, least[jump])
        jump = jump[jump]
    closed = after[jump] >= 0
    before = np.full(n, -1)
    before[after[after >= 0]] = np.flatnonzero(after >= 0)
    before[closed & (least == every)] = -1
    start, place = np.where(before < 0, every, before), (before >= 0).astype(np.int64)
    for _ in range(rounds):
        place = place + place[start]
        start = start[start]
    return start, place, closed


def tile_chains(framed: np.ndarray, top: int, left: int, width: int, lines: bool) -> pa.Table:
    """Chains of one tile and the corners where they turn.

    ``framed`` has the tile's classes, -1 for none, with one cell around.  Of ``lines``, each edge between
    two classes counts once, on the side of the larger class, and chains end at junctions; else all edges
    count and chains go around regions.
    """
    rows, cols = framed.shape[0] - 2, framed.shape[1] - 2
    own = framed[1:-1, 1:-1]
    nw, ne, sw, se = framed[:-1, :-1], framed[:-1, 1:], framed[1:, :-1], framed[1:, 1:]
    junction = (nw != ne).astype(int) + (sw != se) + (nw != sw) + (ne != se) != 2

    def shifted(step: tuple[int, int]) -> np.ndarray:
        return framed[1 + step[0] : 1 + step[0] + rows, 1 + step[1] : 1 + step[1] + cols]

    edge = np.stack([(own >= 0) & (shifted(s) != own) & (not lines or own > shifted(s)) for s in FACING], -1)
    number = np.where(edge, np.cumsum(edge).reshape(edge.shape) - 1, -1)
    r, c, side = np.nonzero(edge)
    value, other = own[r, c], np.choose(side, [shifted(s)[r, c] for s in FACING])
    steps = np.array(AHEAD)[side], np.array(BESIDE)[side], np.array(END)[side]
    ahead = framed[1 + r + steps[0][:, 0], 1 + c + steps[0][:, 1]] == value
    beside = ahead & (framed[1 + r + steps[1][:, 0], 1 + c + steps[1][:, 1]] == value)
    move = np.where(beside[:, None], steps[1], np.where(ahead[:, None], steps[0], 0))
    nr, nc = r + move[:, 0], c + move[:, 1]
    nside = (side + np.where(beside, 3, np.where(ahead, 0, 1))) % 4
    follower = ((nr + top) * width + nc + left) * 4 + nside
    ends = junction[r + steps[2][:, 0], c + steps[2][:, 1]] if lines else np.zeros(len(r), bool)
    inside = (nr >= 0) & (nr < rows) & (nc >= 0) & (nc < cols)
    after = np.where(inside & ~ends, number[np.clip(nr, 0, rows - 1), np.clip(nc, 0, cols - 1), nside], -1)

    start, place, closed = followed(after)
    ids = ((r + top) * width + c + left) * 4 + side
    heads = np.flatnonzero(start == np.arange(len(start)))
    sizes = np.bincount(start, minlength=len(start))[heads]
    last = np.empty(len(start), np.int64)
    tails = np.flatnonzero(place + 1 == np.bincount(start, minlength=len(start))[start]) if len(start) else heads
    last[start[tails]] = tails
    of = last[heads]
    following = np.where(closed[heads], ids[heads], follower[of])
    open_ = ~closed[heads] & ends[of]
    # rows below minus rows above add up to the pixels inside, holes counting against them
    signed = np.where(side == 2, r + top + 1, 0) - np.where(side == 0, r + top, 0)
    area = np.zeros(len(start), np.int64)
    np.add.at(area, start, signed)
    low = np.full(len(start), len(start))
    np.minimum.at(low, start, np.arange(len(start)))
    low = low[heads]
    labels = label_patches(own)[r[heads], c[heads]]
    patch = (labels // cols + top) * width + labels % cols + left
    chains = pa.table(
        [pa.array(["chain"] * len(heads)), pa.array(ids[heads]), pa.array(following, mask=open_), pa.array(patch),
         pa.array(value[heads]), pa.array(other[heads]), pa.array(sizes.astype(np.int64)), pa.array(area[heads]),
         pa.array(ids[low]), pa.array(place[low]), *[pa.nulls(len(heads))] * 3], names=_FIELDS.names,
    )
    turn = np.flatnonzero((nside != side) | ends)
    corner = np.array(END)[side[turn]] + np.stack([r[turn] + top, c[turn] + left], 1)
    at = place[turn] + 1
    begin = np.flatnonzero(start == np.arange(len(start))) if lines else heads[:0]
    at_begin = np.array(END)[(side[begin] + 3) % 4] + np.stack([r[begin] + top, c[begin] + left], 1)
    corner, at = np.concatenate([at_begin, corner]), np.concatenate([np.zeros(len(begin), np.int64), at])
    chain = ids[start[np.concatenate([begin, turn])]]
    n = len(chain)
    corners = pa.table(
        [pa.array(["corner"] * n), pa.array(chain), *[pa.nulls(n)] * 8, pa.array(at), pa.array(corner[:, 0]),
         pa.array(corner[:, 1])], names=_FIELDS.names,
    )
    return pa.concat_tables([chains.cast(_FIELDS), corners.cast(_FIELDS)])


def chains(pred: DataFrame, grid: Grid, column: str, lines: bool) -> DataFrame:
    """The stored chains and corners of all tiles (see ``tile_chains``)."""
    cells = halo(pred.select("row", "col", F.col(column).alias("class_id")), grid, 1)
    tile, height, width = grid.tile, grid.height, grid.width

    def tile_rows(key: tuple, table: pa.Table) -> pa.Table:
        top, left = key[0].as_py() * tile, key[1].as_py() * tile
        framed = np.full((min(tile, height - top) + 2, min(tile, width - left) + 2), OUTSIDE, np.int64)
        row, col = table.column("row").to_numpy(), table.column("col").to_numpy()
        value = table.column("class_id").to_numpy()
        # mirrored copies beyond the grid do not count as neighbours
        real = ~np.isnan(value.astype(float)) & (row >= 0) & (col >= 0) & (row < height) & (col < width)
        framed[row[real] - top + 1, col[real] - left + 1] = value[real]
        return tile_chains(framed, top, left, width, lines)

    return cut_lineage(cells.groupBy("tile_row", "tile_col").applyInArrow(tile_rows, _SCHEMA), "chains")


# order across tiles -------------------------------------------------------------------------------
def _rounds(nodes: DataFrame, step, label: str) -> DataFrame:
    """Apply ``step`` to stored nodes until none of them moves."""
    nodes = cut_lineage(nodes, label)
    while True:
        following = cut_lineage(step(nodes), label)
        discard(nodes)
        nodes = following
        if nodes.where("moved").isEmpty():
            return nodes.drop("moved")


def ordered(links: DataFrame) -> DataFrame:
    """``chain, head, before``: the first chain of each ring or line, and the edges before a chain.

    ``links`` (stored) has ``chain, next, edges``; a ring starts at its smallest chain.  Two rounds of
    pointer jumping, each of which doubles its reach: one finds the smallest chain of what goes round,
    where it is cut, and one adds up edges from the start.  A round joins one row a chain with one row.
    """
    linked = links.where("next <> chain")
    earlier = linked.select(F.col("next").alias("chain"), F.col("chain").alias("up"), F.col("edges").alias("skip"))
    # most lines lie in one tile: a chain that none leads to and that leads nowhere is in order by itself
    last, followers = links.where("next IS NULL"), earlier.select("chain")
    single = links.where("next = chain").unionByName(last.join(followers, "chain", "left_anti").select(links.columns))
    alone = single.select("chain", F.col("chain").alias("head"), F.lit(0).cast("long").alias("before"))
    many = linked.select("chain").union(last.select("chain").join(followers, "chain", "left_semi"))
    nodes = cut_lineage(many.join(earlier, "chain", "left"), "nodes")

    def nearer(n: DataFrame) -> DataFrame:
        to = n.select(F.col("chain").alias("up"), F.col("up").alias("_up"), F.col("least").alias("_least"))
        least = F.least("least", F.coalesce("_least", "least"))
        moved = (least < F.col("least")) | (F.col("up").isNotNull() & F.col("_up").isNull())
        return n.drop("moved").join(to, "up", "left").select(
            "chain", F.col("_up").alias("up"), least.alias("least"), moved.alias("moved")
        )

    found = nodes.select("chain", "up", F.col("chain").alias("least"), F.lit(True).alias("moved"))
    found = _rounds(found, nearer, "least")
    cuts = found.where("up IS NOT NULL AND least = chain").select("chain", F.lit(True).alias("cut"))
    starts = F.col("cut").isNotNull() | F.col("up").isNull()
    lists = nodes.join(cuts, "chain", "left").select(
        "chain", F.when(starts, F.col("chain")).otherwise(F.col("up")).alias("up"),
        F.when(starts, 0).otherwise(F.col("skip")).alias("skip"), F.lit(True).alias("moved"),
    )

    def added(n: DataFrame) -> DataFrame:
        to = n.select(F.col("chain").alias("up"), F.col("up").alias("_up"), F.col("skip").alias("_skip"))
        return n.drop("moved").join(to, "up").select(
            "chain", F.col("_up").alias("up"), (F.col("skip") + F.col("_skip")).alias("skip"),
            (F.col("_up") != F.col("up")).alias("moved"),
        )

    ranked = _rounds(lists, added, "order")
    discard(nodes, found)
    return alone.unionByName(ranked.select("chain", F.col("up").alias("head"), F.col("skip").alias("before")))


def region_rings(pred: DataFrame, grid: Grid, column: str = "class_id") -> tuple[DataFrame, DataFrame]:
    """Rings and their corners, both stored: the boundaries of all 4-connected regions.

    Rings: ``ring, region_id, class_id, hole, edges, area`` (pixels inside; of a hole, negative, so the areas
    of a region add up to its pixels).  Corners: ``ring, place, row, col``, in order of ``place`` (edges from
    the start of the ring's edge with the smallest number, which names it) with the region on the right.  ``region_id`` is that of ``connected_regions``.
    """
    made = chains(pred, grid, column, lines=False)
    links = made.where("kind = 'chain'")
    order = cut_lineage(ordered(links.select("chain", "next", "edges")), "ordered")
    tiles = cut_lineage(tile_patches(pred, grid, column), "patches")
    borders = cut_lineage(patch_borders(tiles), "borders")
    roots = connected_roots(borders).withColumnRenamed("node", "patch")
    placed = links.join(order, "chain").join(roots, "patch", "left")
    sums = placed.groupBy("head").agg(
        F.min(F.coalesce("root", "patch")).alias("region_id"),
        F.min("class_id").alias("class_id"),
        F.sum("edges").alias("edges"),
        F.sum("area").alias("area"),
        F.min(F.struct("low", (F.col("before") + F.col("low_at")).alias("shift"))).alias("l"),
    )
    rings = sums.select("head", F.col("l.low").alias("ring"), "region_id", "class_id", (F.col("area") < 0).alias("hole"), "edges", "area", "l.shift")
    rings = cut_lineage(rings, "rings")
    turns = made.where("kind = 'corner'").join(order, "chain").join(rings.select("head", "ring", F.col("edges").alias("total"), "shift"), "head")
    place = F.pmod(F.col("before") + F.col("at") - F.col("shift") - 1, F.col("total")) + 1
    corners = cut_lineage(turns.select("ring", place.alias("place"), "row", "col"), "corners")
    rings = rings.drop("head", "shift")
    discard(made, order, tiles, borders)
    return rings, corners


def ring_layer(rings: DataFrame, corners: DataFrame, grid: Grid, most: int = 10_000) -> DataFrame:
    """The layer to store: rings with their points, in parts of at most ``most`` edges.

    ``region_id, class_id, ring, hole, part, points`` (x, y in order); no row grows with a region.
    """
    parted = corners.withColumn("part", F.expr(f"CAST((place - 1) div {most} AS INT)"))
    xy = F.struct(
        "place", (F.lit(grid.x0) + F.col("col") * grid.res).alias("x"), (F.lit(grid.y0) - F.col("row") * grid.res).alias("y")
    )
    points = parted.groupBy("ring", "part").agg(F.sort_array(F.collect_list(xy)).alias("p"))
    points = points.withColumn("points", F.transform("p", lambda p: point(p["x"], p["y"]))).drop("p")
    return rings.join(points, "ring").select("region_id", "class_id", "ring", "hole", "part", "points")


def boundary_lines(
    pred: DataFrame, grid: Grid, tolerance: float = SIMPLIFY_TOLERANCE_M, column: str = "class_id", longest: int = LONGEST
) -> DataFrame:
    """Simplified lines between junctions, with the classes on both sides; -1 is nodata or the outside.

    ``line, part, class_a, class_b, edges, closed, length, points``; ``class_b`` is the larger class, on the
    right.  A line runs from junction to junction, or round, through any number of tiles, and is simplified
    once, so both sides keep it.  Its ends stay, and so does a corner about every ``longest`` unit edges, which
    bounds what a task holds (parts of a line share these).  The result does not depend on the size of tiles.
    """
    made = chains(pred, grid, column, lines=True)
    links = made.where("kind = 'chain'")
    order = cut_lineage(ordered(links.select("chain", "next", "edges")), "ordered")
    heads = links.join(order, "chain").groupBy("head").agg(
        F.min("other").alias("class_a"), F.min("class_id").alias("class_b"), F.sum("edges").alias("total"),
        (F.count("next") == F.count("*")).alias("closed"),
        F.min(F.struct("low", (F.col("before") + F.col("low_at")).alias("shift"))).alias("l"),
    )
    # a closed line is named by its smallest edge and starts at the first corner from there on
    heads = heads.withColumn("line", F.when(F.col("closed"), F.col("l.low")).otherwise(F.col("head")))
    turns = made.where("kind = 'corner'").join(order, "chain").join(heads, "head")
    turns = turns.where("at > 0 OR (before = 0 AND NOT closed)")
    along = F.col("before") + F.col("at")
    around = F.pmod(along - F.col("l.shift"), F.col("total"))
    turns = turns.select("line", "closed", "total", F.when(F.col("closed"), around).otherwise(along).alias("place"), "row", "col")
    bases = turns.where("closed").groupBy("line").agg(F.min("place").alias("base"))
    turns = turns.join(bases, "line", "left").withColumn("place", F.col("place") - F.coalesce("base", F.lit(0)))
    again = turns.where("closed AND place = 0").withColumn("place", F.col("total"))
    corners = turns.unionByName(again).select("line", "place", "row", "col")
    heads = heads.select("line", "class_a", "class_b", "total", "closed")
    corners = corners.withColumn("part", F.expr(f"CAST(place div {longest} AS INT)"))
    # the first corner of a part also ends the part before it
    first = corners.groupBy("line", "part").agg(F.min(F.struct("place", "row", "col")).alias("f"))
    previous = F.lag("part").over(Window.partitionBy("line").orderBy("part"))  # a row for each part
    shared = first.withColumn("part", previous).where("part IS NOT NULL")
    corners = corners.select("line", "part", "place", "row", "col").union(shared.select("line", "part", "f.*"))
    parted = corners.join(heads, "line")
    x0, y0, res = grid.x0, grid.y0, grid.res

    kinds = [pa.int64(), pa.int32(), pa.int32(), pa.int32(), pa.int64(), pa.bool_(), pa.float64()] + [pa.list_(pa.float64())] * 2
    names = ["line", "part", "class_a", "class_b", "edges", "closed", "length", "xs", "ys"]

    def simplified(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []

        def closed(rows: pa.Table, cuts: np.ndarray) -> pa.RecordBatch:
            cuts = cuts.astype(np.intp)
            first, last = cuts[:-1], cuts[1:] - 1
            first, last = first[last > first], last[last > first]
            points = np.stack([x0 + rows["col"].to_numpy() * res, y0 - rows["row"].to_numpy() * res], 1)
            keep = simplified_lines(points, first, last, tolerance)
            kept = np.flatnonzero(keep)
            ends = np.searchsorted(kept, last, side="right")
            starts = np.searchsorted(kept, first)
            steps = np.append(np.hypot(*np.diff(points[kept], axis=0).T), 0.0)
            steps[ends - 1] = 0.0  # from a line to the next one
            length = np.add.reduceat(steps, starts) if len(starts) else np.empty(0)
            offsets = pa.array(np.append(0, ends), pa.int32())
            xs, ys = (pa.ListArray.from_arrays(offsets, pa.array(points[kept, i])) for i in (0, 1))
            place = rows["place"].to_numpy()
            about = [rows[c].combine_chunks().take(pa.array(first)) for c in ("line", "part", "class_a", "class_b", "closed")]
            found = [*about[:4], pa.array(place[last] - place[first]), about[4], pa.array(length), xs, ys]
            return pa.RecordBatch.from_arrays([f.cast(k) for f, k in zip(found, kinds)], names)

        for batch in batches:
            held.append(batch)
            rows = pa.Table.from_batches(held).combine_chunks()
            line, part = rows["line"].to_numpy(), rows["part"].to_numpy()
            starts = np.flatnonzero(np.append(True, (line[1:] != line[:-1]) | (part[1:] != part[:-1]))) if len(line) else []
            if len(starts) > 1:  # the last one may go on in the next batch
                yield closed(rows, starts)
                held = rows.slice(starts[-1]).to_batches()
        if held:
            rows = pa.Table.from_batches(held).combine_chunks()
            if len(rows):
                yield closed(rows, np.array([0, len(rows)]))

    fields = "line BIGINT, part INT, class_a INT, class_b INT, edges BIGINT, closed BOOLEAN, length DOUBLE, xs ARRAY<DOUBLE>, ys ARRAY<DOUBLE>"
    lines = parted.repartition("line", "part").sortWithinPartitions("line", "part", "place").mapInArrow(simplified, fields)
    return lines.withColumn("points", F.zip_with("xs", "ys", point)).drop("xs", "ys")
