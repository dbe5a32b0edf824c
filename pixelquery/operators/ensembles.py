"""Tree ensembles on binned rows: a forest and multiclass boosting, grown in tasks and scored in batches.

The bands are binned once, by at most 255 quantiles, to one byte each, and every labelled row is learned from.
Trees of a forest are dealt over the tasks, and boosting deals its classes, as each round has one tree for each
class.  A growing task passes over all rows block by block; what it has for each row is in memory up to
``HELD_ROWS`` rows and in files above, so its memory does not grow with the rows.
"""

from __future__ import annotations

import heapq
import json
import os
import tempfile
from collections.abc import Callable, Iterable, Iterator, Sequence
from dataclasses import asdict, dataclass
from functools import partial

import numpy as np
import pyarrow as pa
from pyspark import BarrierTaskContext, TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, StructField, StructType

from pixelquery.session import cut_lineage, discard

BINS = 255
PACKED_ROWS = 20_000
#: Up to so many rows a growing task has what it keeps for each row in memory, above in files.
HELD_ROWS = 4_000_000
#: Bytes of trees that scoring sends to all tasks at once; a larger model is sent in parts, one scan each.
MODEL_BYTES = 512 << 20
#: Up to so many rows one task grows all classes: waiting for other tasks takes about a second a round.
ALONE_ROWS = 150_000
#: From so many rows on, two bands are counted together.
PAIRED_ROWS = 50_000
#: Rows that are worked on at a time where a pass needs several values for each row.
BLOCK_ROWS = 1 << 16
#: Rows that are counted or moved at a time.
COUNT_ROWS = 1 << 20
#: Rows of neighbouring nodes of a forest whose cuts are looked for together, and the mean rows of a node
#: from which all its 256 codes are counted, present or not.
NODE_ROWS = 1 << 14
DENSE_ROWS = 192
TREES = (
    "tree INT, class INT, feature BINARY, cut BINARY, child BINARY, value BINARY, importance BINARY"
)


@dataclass(frozen=True)
class Forest:
    """A random forest: bootstrapped trees, the square root of the bands tried at each node."""

    trees: int = 200
    depth: int = 20
    least_rows: int = 5
    seed: int = 42


@dataclass(frozen=True)
class Boosting:
    """Boosted trees with one tree a class and round, grown best leaf first.

    Above ``stop_above`` rows a tenth is held out, and rounds end when its loss has not fallen for ``patience``.
    """

    rounds: int = 200
    depth: int = 6
    least_rows: int = 20
    leaves: int = 31
    rate: float = 0.1
    stop_above: int = 10_000
    patience: int = 10
    seed: int = 42


@dataclass
class Tree:
    """Nodes as arrays.  A row goes to ``child`` if its code is at most ``cut``, else to the node after it.

    A leaf is its own child.
    """

    feature: np.ndarray
    cut: np.ndarray
    child: np.ndarray
    value: np.ndarray
    importance: np.ndarray

    def leaves(self, codes: np.ndarray, depth: int) -> np.ndarray:
        """The leaf of every row of ``codes`` (rows by bands)."""
        flat, start = codes.ravel(), np.arange(len(codes)) * codes.shape[1]
        node = np.zeros(len(codes), np.int32)
        for _ in range(depth):
            over = flat[start + self.feature[node]] > self.cut[node]
            following = self.child[node] + over
            if np.array_equal(following, node):
                break
            node = following
        return node

    def leaves_by_columns(self, columns: np.ndarray) -> np.ndarray:
        """The leaf of every row of ``columns`` (bands by rows), for small trees.

        Children have larger numbers than their parent, so nodes are settled from the last one back: each is
        one comparison of a whole band and one choice between what its children say.
        """
        out = row_array(columns.shape[1:], np.min_scalar_type(len(self.child)))
        inner = [node for node in range(len(self.child) - 1, -1, -1) if self.child[node] != node]
        for a in range(0, len(out), BLOCK_ROWS):
            part = columns[:, a : a + BLOCK_ROWS]
            said = {node: out.dtype.type(node) for node in range(len(self.child))}
            for node in inner:
                child = int(self.child[node])
                over = out.dtype.type(0) - (part[self.feature[node]] > self.cut[node]).astype(out.dtype)  # all bits
                low, high = said.pop(child), said.pop(child + 1)
                said[node] = low ^ ((low ^ high) & over)
            out[a : a + BLOCK_ROWS] = said[0]
        return out


# rows of a task -----------------------------------------------------------------------------------
def row_array(shape: tuple[int, ...], kind) -> np.ndarray:
    """An array to fill with values of each row: above ``HELD_ROWS`` rows in a file, which is gone with the array."""
    if max(shape) <= HELD_ROWS or 0 in shape:
        return np.empty(shape, kind)
    with tempfile.TemporaryFile() as file:
        if hasattr(os, "posix_fallocate"):  # a full disk is an error here, not where the array is filled
            os.posix_fallocate(file.fileno(), 0, int(np.prod(shape)) * np.dtype(kind).itemsize)
        return np.memmap(file, kind, "w+", shape=shape).view(np.ndarray)


def blocks(n: int, size: int | None = None) -> Iterator[slice]:
    """The rows from 0 to ``n``, ``COUNT_ROWS`` or ``size`` at a time."""
    size = size or COUNT_ROWS
    return (slice(a, min(a + size, n)) for a in range(0, n, size))


# growing ------------------------------------------------------------------------------------------
def _ranks(keys: np.ndarray, high: int) -> tuple[np.ndarray, np.ndarray]:
    """The sorted different keys below ``high``, and each row's place among them."""
    held = np.zeros(high, bool)
    held[keys] = True
    found = np.flatnonzero(held)
    place = np.empty(high, np.intp)
    place[found] = np.arange(len(found))
    return found, place[keys]


def _by_node(at: np.ndarray, count: np.ndarray) -> np.ndarray:
    """The rows of nodes with a ``count``, ordered by node and else as they are.

    Rows lie by pairs of nodes, the two of a pair mixed.
    """
    order = np.empty(count.sum(), np.intp)
    starts = count.cumsum() - count
    for odd in (0, 1):
        mine = np.where(np.arange(len(count)) % 2 == odd, count, 0)
        rows = np.flatnonzero((mine > 0)[at])
        order[np.arange(len(rows)) + (starts - mine.cumsum() + mine)[at[rows]]] = rows
    return order


def _best_cuts(
    codes: np.ndarray, label: np.ndarray, weight: np.ndarray, count: np.ndarray, total: np.ndarray,
    tried: np.ndarray, least_rows: int,
) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Gain, band (-1 for none) and cut of the best cut of some nodes, whose rows follow one another.

    ``total`` has the weights of the nodes by class, ``tried`` the bands to try for each.  Classes come first
    in all tables here, so that each step runs along the codes.
    """
    m, classes = total.shape
    gain, feature, cut = np.full(m, 1e-12), np.full(m, -1, np.int16), np.zeros(m, np.uint8)
    full, whole = np.ascontiguousarray(total.T), total.sum(1)
    before = (total**2).sum(1) / whole
    edges, flat = np.append(0, count.cumsum()), codes.ravel()
    dense = len(codes) >= DENSE_ROWS * m

    def ranks(part: slice) -> Iterator[np.ndarray]:
        """Node and code of the rows of a ``part``, for each band tried."""
        where = np.repeat(np.arange(m), np.diff(edges.clip(part.start, part.stop)))
        first_code = np.arange(part.start, part.stop) * codes.shape[1]
        for j in range(tried.shape[1]):
            yield where * 256 + flat.take(first_code + tried[:, j].take(where))

    def fall(left: np.ndarray, left_n: np.ndarray, of: Callable[[np.ndarray], np.ndarray]) -> np.ndarray:
        """What each cut gains; ``of`` spreads a value of each node over its cuts."""
        fits = (left_n >= least_rows) & (of(count) - left_n >= least_rows)
        right, left_w = of(full) - left, left.sum(0)
        squares, right_squares = (np.einsum("c...,c...->...", part, part) for part in (left, right))
        with np.errstate(divide="ignore", invalid="ignore"):
            found = squares / left_w + right_squares / (of(whole) - left_w) - of(before)
        return np.where(fits & np.isfinite(found), found, -1.0)

    if dense:
        tables = np.zeros((tried.shape[1], classes * m * 256))
        rows = np.zeros((tried.shape[1], m * 256), np.intp)
        for part in blocks(len(codes)):
            of_class = label[part] * np.intp(m * 256)
            for j, rank in enumerate(ranks(part)):
                tables[j] += np.bincount(of_class + rank, weight[part], m * 256 * classes)
                rows[j] += np.bincount(rank, minlength=m * 256)
        ranked = range(tried.shape[1])
    else:  # so few rows a node that those of a block are few
        ranked = ranks(slice(0, len(codes)))
    for j, rank in enumerate(ranked):
        if dense:
            sums, numbers = tables[j].reshape(classes, m, 256), rows[j].reshape(m, 256)
            falls = fall(sums.cumsum(2), numbers.cumsum(1), lambda v: v[..., None])
            code = falls.argmax(1)
            best = falls[np.arange(m), code]
        else:
            keys, rank = _ranks(rank, m * 256)
            k, node = len(keys), keys >> 8
            sums = np.bincount(label * np.intp(k) + rank, weight, k * classes).reshape(classes, k).cumsum(1)
            numbers = np.bincount(rank, minlength=k).cumsum()
            starts = np.searchsorted(node, np.arange(m))
            base = np.where(starts > 0, sums[:, starts - 1], 0)
            base_n = np.where(starts > 0, numbers[starts - 1], 0)
            falls = fall(sums - base.take(node, axis=1), numbers - base_n.take(node), lambda v: v.take(node, axis=-1))
            best = np.maximum.reduceat(falls, starts)
            hit = np.flatnonzero(falls == best.take(node))
            code = keys[hit[np.unique(node[hit], return_index=True)[1]]] & 255
        better = np.flatnonzero(best > gain)
        gain[better], feature[better], cut[better] = best[better], tried[better, j], code[better]
    return gain, feature, cut


def _bootstrap(
    codes: np.ndarray, label: np.ndarray, weight: np.ndarray, draw: np.random.Generator
) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Codes, label and weight of the rows that are in a sample with replacement, once each."""
    n = len(codes)
    times = row_array((n,), np.int32)
    times[:] = 0
    for part in blocks(n):
        np.add.at(times, draw.integers(0, n, part.stop - part.start), 1)
    size = sum(int(np.count_nonzero(times[part])) for part in blocks(n))
    held = row_array((size, codes.shape[1]), np.uint8), row_array((size,), np.int32), row_array((size,), float)
    made = 0
    for part in blocks(n):
        rows = np.flatnonzero(times[part])
        to = slice(made, made := made + len(rows))
        held[0][to], held[1][to] = codes[part].take(rows, axis=0), label[part].take(rows)
        held[2][to] = (times[part] * weight[part]).take(rows)
    on_grid(held[2], held[2])
    return held


def grow_forest_tree(
    codes: np.ndarray, label: np.ndarray, weight: np.ndarray, classes: int, plan: Forest, draw: np.random.Generator
) -> Tree:
    """One tree, level by level; rows are kept in the order of their nodes, so nodes are looked at in blocks.

    Each node tries a few bands drawn for it.  Rows are counted by node, code and class; the cut with the
    greatest fall of Gini impurity that leaves ``least_rows`` different rows on both sides is taken.  The rows
    of a block then go, ordered by child, to a second table, those of children that stay as they are left out.
    """
    rows = _bootstrap(codes, label, weight, draw)
    bands, size = codes.shape[1], len(rows[0])
    spare = tuple(row_array((size, *part.shape[1:]), part.dtype) for part in rows)
    tries = max(1, int(np.sqrt(bands)))
    features, cuts, children, values = [], [], [], []
    importance, made = np.zeros(bands), 0
    total, count = np.zeros((1, classes)), np.array([size])
    for part in blocks(size):
        total[0] += np.bincount(rows[1][part], rows[2][part], classes)

    def may_split(total: np.ndarray, count: np.ndarray, level: int) -> np.ndarray:
        return (count >= 2 * plan.least_rows) & (total.max(1) < total.sum(1)) & (level < plan.depth)

    for level in range(plan.depth + 1):
        m, whole = len(count), total.sum(1)
        gain, feature, cut = np.full(m, 1e-12), np.full(m, -1, np.int16), np.zeros(m, np.uint8)
        asked = np.flatnonzero(may_split(total, count, level))
        new_totals, new_counts, kept = [np.zeros((0, classes))], [np.zeros(0, np.intp)], 0
        if len(asked):
            last = count[asked].cumsum()
            ends = np.unique(np.append(np.searchsorted(last, np.arange(NODE_ROWS, last[-1], NODE_ROWS)) + 1, len(asked)))
            for a, b in zip([0, *ends[:-1]], ends):
                of, start, stop = asked[a:b], last[a] - count[asked[a]], last[b - 1]
                mine = tuple(part[start:stop] for part in rows)
                tried = np.argpartition(draw.random((b - a, bands)), min(tries, bands - 1), axis=1)[:, :tries]
                gain[of], feature[of], cut[of] = _best_cuts(*mine, count[of], total[of], tried, plan.least_rows)
                children_of = _children(mine, count[of], feature[of], cut[of], total[of], partial(may_split, level=level + 1), spare, kept)
                new_totals.append(children_of[0])
                new_counts.append(children_of[1])
                kept = children_of[2]
        split = np.flatnonzero(feature >= 0)
        np.add.at(importance, feature[split], gain[split])
        child = made + np.arange(m)
        child[split] = made + m + 2 * np.arange(len(split))
        features.append(np.maximum(feature, 0))
        cuts.append(np.where(feature >= 0, cut, 255).astype(np.uint8))
        children.append(child.astype(np.int32))
        value = np.where((feature < 0)[:, None], total / np.maximum(whole, 1e-300)[:, None], 0)
        values.append(value.astype(np.float32))
        made += m
        if not len(split):
            break
        total, count = np.concatenate(new_totals), np.concatenate(new_counts)
        rows, spare = spare, rows
    return Tree(
        np.concatenate(features).astype(np.int16), np.concatenate(cuts), np.concatenate(children),
        np.concatenate(values), importance / max(importance.sum(), 1e-300),
    )


def _children(
    rows: tuple[np.ndarray, ...], count: np.ndarray, feature: np.ndarray, cut: np.ndarray, total: np.ndarray,
    goes_on: Callable[[np.ndarray, np.ndarray], np.ndarray], spare: tuple[np.ndarray, ...], made: int,
) -> tuple[np.ndarray, np.ndarray, int]:
    """Weights by class and numbers of rows of the children of some nodes, whose ``rows`` follow one another.

    Rows of children that go on are put into ``spare`` from row ``made`` on, ordered by child; then comes the
    row after them.
    """
    codes, label, weight = rows
    classes, m = total.shape[1], 2 * int((feature >= 0).sum())
    flat, edges, parts = codes.ravel(), np.append(0, count.cumsum()), list(blocks(len(codes)))
    first_child = np.where(feature >= 0, 2 * (feature >= 0).cumsum() - 2, -2)  # below 0: the node stays whole

    def child(part: slice) -> np.ndarray:
        at = np.repeat(np.arange(len(count)), np.diff(edges.clip(part.start, part.stop)))
        first_code = np.arange(part.start, part.stop) * codes.shape[1]
        return first_child.take(at) + (flat.take(first_code + feature.take(at)) > cut.take(at))

    child_total, child_count = np.zeros(m * classes), np.zeros(m, np.intp)
    for part in parts:
        to = child(part)
        rest = np.flatnonzero(to >= 0)
        to, of_class = to.take(rest), label[part].take(rest)
        child_total += np.bincount(to * classes + of_class, weight[part].take(rest), m * classes)
        child_count += np.bincount(to, minlength=m)
    child_total = child_total.reshape(m, classes)
    wanted = goes_on(child_total, child_count)
    kept = np.where(wanted, child_count, 0)
    free, after = made + kept.cumsum() - kept, made + int(kept.sum())
    for part in parts if after > made else ():
        if len(parts) > 1:
            to = child(part)
            rest = np.flatnonzero(to >= 0)
            to = to.take(rest)
        here = np.where(wanted, np.bincount(to, minlength=m), 0)
        going = wanted.take(to)
        order = rest[going].take(_by_node(to[going], here))
        place = slice(made, after)
        if len(parts) > 1:  # the rows of a child are not all in this part
            place = np.repeat(free - here.cumsum() + here, here) + np.arange(len(order))
        for old, new in zip(rows, spare):
            new[place] = old[part].take(order, axis=0)
        free += here
    return child_total, child_count, after


def paired(columns: np.ndarray) -> np.ndarray:
    """Two bands in one number: bands 2i and 2i + 1 as its low and high byte."""
    out = row_array((-(-len(columns) // 2), columns.shape[1]), np.uint16)
    for part in blocks(columns.shape[1]):
        high = columns[1::2, part].astype(np.uint16) << 8
        out[:, part] = columns[::2, part]
        out[: len(high), part] |= high
    return out


def on_grid(values: np.ndarray, out: np.ndarray | None = None) -> np.ndarray:
    """``values`` rounded so that sums of any of them are exact, in any order: to 2^-52 of the sum of all."""
    whole = float(sum(np.abs(values[part]).sum() for part in blocks(len(values))))
    if not whole:
        return values
    scale = 2.0 ** (52 - int(np.ceil(np.log2(whole))))
    out = row_array(values.shape, float) if out is None else out
    for part in blocks(len(values)):
        out[part] = np.rint(values[part] * scale) / scale
    return out


def grow_boosted_tree(
    columns: np.ndarray, rows: np.ndarray, slope: np.ndarray, bend: np.ndarray, plan: Boosting,
    pairs: np.ndarray | None = None,
) -> tuple[Tree, np.ndarray]:
    """One tree on gradients ``slope`` and their derivatives ``bend``, and the leaf of each of ``rows``.

    ``columns`` are the codes, bands by rows; ``pairs`` the same by ``paired``, where many rows are counted
    faster.  The leaf that gains most is split next.  Of two new leaves, the smaller is counted and the other
    is what is left of their parent's counts; leaves that are not split any more are not counted.
    """
    bands = len(columns)

    def counts(of: np.ndarray) -> np.ndarray:
        out = np.zeros((3, bands, 256))
        for part in blocks(len(of)):
            some = of[part]
            g, h = slope.take(some), bend.take(some)
            if pairs is not None and len(of) >= PAIRED_ROWS:
                for b, pair in enumerate(pairs):
                    code = pair.take(some).astype(np.intp)
                    for k, w in enumerate((g, h, None)):
                        both = np.bincount(code, w, 65536).reshape(256, 256)
                        out[k, 2 * b] += both.sum(0)
                        if 2 * b + 1 < bands:
                            out[k, 2 * b + 1] += both.sum(1)
                continue
            for b in range(bands):
                code = columns[b].take(some).astype(np.intp)
                out[0, b] += np.bincount(code, g, 256)
                out[1, b] += np.bincount(code, h, 256)
                out[2, b] += np.bincount(code, minlength=256)
        return out

    def best(table: np.ndarray) -> tuple[float, int, int]:
        left = table.cumsum(2)
        all_ = left[:, :, -1:]
        right = all_ - left
        fits = (np.minimum(left[2], right[2]) >= plan.least_rows) & (np.minimum(left[1], right[1]) >= 1e-3)
        with np.errstate(divide="ignore", invalid="ignore"):
            gain = left[0] ** 2 / left[1] + right[0] ** 2 / right[1] - all_[0] ** 2 / all_[1]
        gain = np.where(fits, gain, -1.0)
        at = int(gain.argmax())
        return float(gain.flat[at]), at // 256, at % 256

    nodes: list[list] = [[0, 255, 0, 0.0]]  # band, cut, child, value
    importance = np.zeros(bands)
    order, spare = row_array(rows.shape, np.intp), row_array(rows.shape, np.intp)
    order[:] = rows
    parts, waiting = {0: order}, []

    def parted(of: np.ndarray, band: int, cut: int) -> tuple[np.ndarray, np.ndarray]:
        """The rows ``of`` a node, put in place to those up to the cut and those over it."""
        low = high = 0
        for part in blocks(len(of)):
            some = of[part]
            over = columns[band].take(some) > cut
            under, above = some[~over], some[over]
            of[low : low + len(under)], spare[high : high + len(above)] = under, above
            low, high = low + len(under), high + len(above)
        of[low:] = spare[:high]
        return of[:low], of[low:]

    def may_split(node: int, depth: int) -> bool:
        return depth < plan.depth and len(parts[node]) >= 2 * plan.least_rows and len(parts) < plan.leaves

    def propose(node: int, table: np.ndarray, depth: int) -> None:
        if may_split(node, depth):
            gain, band, cut = best(table)
            if gain > 1e-12:
                heapq.heappush(waiting, (-gain, node, band, cut, depth, table))

    if may_split(0, 0):
        propose(0, counts(rows), 0)
    while waiting and len(parts) < plan.leaves:
        gain, node, band, cut, depth, table = heapq.heappop(waiting)
        child = len(nodes)
        nodes[node][:3] = band, cut, child
        nodes += [[0, 255, child, 0.0], [0, 255, child + 1, 0.0]]
        importance[band] -= gain
        parts[child], parts[child + 1] = parted(parts.pop(node), band, cut)
        if not (may_split(child, depth + 1) or may_split(child + 1, depth + 1)):
            continue
        small = child + int(len(parts[child + 1]) < len(parts[child]))
        counted = counts(parts[small])
        for new in (child, child + 1):
            propose(new, counted if new == small else table - counted, depth + 1)
    leaf = row_array(columns.shape[1:], np.int32)
    for node, of in parts.items():
        fall = rise = 0.0
        for part in blocks(len(of)):
            fall, rise = fall + slope.take(of[part]).sum(), rise + bend.take(of[part]).sum()
            leaf[of[part]] = node
        nodes[node][3] = -plan.rate * fall / max(rise, 1e-12)
    feature, cuts, child, value = zip(*nodes)
    return (
        Tree(np.array(feature, np.int16), np.array(cuts, np.uint8), np.array(child, np.int32),
             np.array(value, np.float32), importance),
        leaf,
    )


def prior(counts: Sequence[int]) -> list[float]:
    """Votes before any tree: the same for all classes, as they weigh the same, but none for a class without rows."""
    return [0.0 if n else -1e9 for n in counts]


def boost(
    codes: np.ndarray, label: np.ndarray, weight: np.ndarray, classes: int, plan: Boosting,
    mine: Sequence[int], together: Callable[[dict[int, Tree]], dict[int, Tree]],
) -> list[dict[int, Tree]]:
    """The rounds of boosting: in each, one tree for each class on the gradients of the softmax.

    This task grows the classes ``mine``; ``together`` exchanges them for the trees of all classes.
    """
    n = len(codes)
    columns = codes.T
    if not columns.flags.c_contiguous:
        columns = row_array(codes.T.shape, np.uint8)
        for part in blocks(n):
            columns[:, part] = codes[part].T
    pairs = paired(columns) if n >= PAIRED_ROWS else None
    held, rows, learned = row_array((n,), bool), row_array((n,), np.intp), 0
    draw, held_weight = np.random.default_rng(plan.seed), 0.0
    for part in blocks(n):
        held[part] = draw.random(part.stop - part.start) < 0.1 if n > plan.stop_above else False
        held_weight += weight[part][held[part]].sum()
        some = part.start + np.flatnonzero(~held[part])
        rows[learned : (learned := learned + len(some))] = some
    rows = rows[:learned]
    raw = row_array((classes, n), float)
    raw[:] = np.array(prior(_class_counts(label, classes)))[:, None]
    share, slope, bend = {k: row_array((n,), float) for k in mine}, row_array((n,), float), row_array((n,), float)
    rounds: list[dict[int, Tree]] = []
    least, since = np.inf, 0
    for _ in range(plan.rounds):
        loss = 0.0
        for block in blocks(n, BLOCK_ROWS):
            part = np.exp(raw[:, block] - raw[:, block].max(0))
            part /= part.sum(0)
            for k in mine:
                share[k][block] = part[k]
            apart = np.flatnonzero(held[block])
            hits = part[label[block].take(apart), apart]
            loss -= (np.log(np.maximum(hits, 1e-300)) * weight[block].take(apart)).sum()
        if held_weight:
            loss /= held_weight
            since = 0 if loss < least - 1e-7 else since + 1
            least = min(least, loss)
            if since >= plan.patience:
                break
        grown = {}
        for k in mine:
            for part in blocks(n):
                p = share[k][part]
                slope[part] = (p - (label[part] == k)) * weight[part]
                bend[part] = p * (1 - p) * weight[part]
            grown[k], _ = grow_boosted_tree(columns, rows, on_grid(slope, slope), on_grid(bend, bend), plan, pairs)
        trees = together(grown)
        for k, tree in trees.items():
            leaf = tree.leaves_by_columns(columns)
            for part in blocks(n):
                raw[k, part] += tree.value[leaf[part]]
        rounds.append(trees)
    return rounds


# tables -------------------------------------------------------------------------------------------
def band_edges(rows: DataFrame, features: Sequence[str]) -> list[list[float]]:
    """At most 254 different quantiles of each band, in one pass."""
    shares = [k / BINS for k in range(1, BINS)]
    found = rows.agg(*[F.percentile_approx(f, shares, 10_000).alias(f"q{i}") for i, f in enumerate(features)]).first()
    return [sorted(set(found[i] or [])) for i in range(len(features))]


def coded(values: list[np.ndarray], edges: list[np.ndarray]) -> np.ndarray:
    """Bytes of rows by bands: how many edges are below each value."""
    out = np.empty((len(values[0]), len(values)), np.uint8)
    for b, (column, cuts) in enumerate(zip(values, edges)):
        out[:, b] = np.searchsorted(cuts, column, side="left")
    return out


def packed_rows(
    rows: DataFrame, features: Sequence[str], label: str, keys: Sequence[str], edges: list[list[float]]
) -> tuple[DataFrame, list[int]]:
    """The stored codes and labels of all labelled rows, many in a row, and where the rows of each part begin and end.

    They are in the order of key hash, codes (from the last band on) and label: ``part`` says in which part of
    that order they are, ``first`` how many rows of the part come before.
    """
    place = F.xxhash64(*[F.col(k) for k in keys]) if keys else F.lit(0).cast("long")
    wanted = rows.select(*features, F.col(label).cast("int").alias("label"), place.alias("place")).dropna()
    cuts = [np.array(e) for e in edges]

    def code(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            codes = coded([batch.column(i).to_numpy(zero_copy_only=False) for i in range(len(cuts))], cuts)
            turned = [row.tobytes() for row in codes[:, ::-1]]
            yield pa.RecordBatch.from_arrays(
                [batch.column("place"), pa.array(turned, pa.binary()), batch.column("label")], ["place", "codes", "label"]
            )

    def pack(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, first = TaskContext.get().partitionId(), 0
        for batch in batches:
            for at in range(0, batch.num_rows, PACKED_ROWS):
                some = batch.slice(at, PACKED_ROWS)
                codes = np.frombuffer(b"".join(some.column("codes").to_pylist()), np.uint8).reshape(-1, len(cuts))[:, ::-1]
                labels = some.column("label").to_numpy().astype(np.int32)
                row = {"part": part, "first": first, "size": len(labels), "codes": codes.tobytes(), "labels": labels.tobytes()}
                yield pa.RecordBatch.from_pylist([row], schema)
                first += len(labels)

    schema = pa.schema([("part", pa.int32()), ("first", pa.int64()), ("size", pa.int32()), ("codes", pa.binary()), ("labels", pa.binary())])
    order = ["place", "codes", "label"]
    sorted_ = wanted.mapInArrow(code, "place BIGINT, codes BINARY, label INT").repartitionByRange(*order).sortWithinPartitions(*order)
    packed = cut_lineage(sorted_.mapInArrow(pack, "part INT, first BIGINT, size INT, codes BINARY, labels BINARY"), "binned")
    sizes = dict(packed.groupBy("part").agg(F.sum("size")).collect())
    return packed, [0, *np.cumsum([sizes.get(k, 0) for k in range(max(sizes, default=-1) + 1)]).tolist()]


def _unpacked(
    batches: Iterable[pa.RecordBatch], bands: int, ends: list[int], by_columns: bool
) -> tuple[int, np.ndarray, np.ndarray]:
    """This task's number, and the codes (laid out by bands if ``by_columns``) and labels in their order."""
    n, task, filled = ends[-1], -1, 0
    for batch in batches:
        for i in range(batch.num_rows):
            if task < 0:
                task = batch.column("task")[i].as_py()
                codes = row_array((bands, n), np.uint8).T if by_columns else row_array((n, bands), np.uint8)
                labels = row_array((n,), np.int32)
            first = ends[batch.column("part")[i].as_py()] + batch.column("first")[i].as_py()
            some = np.frombuffer(batch.column("labels")[i].as_buffer(), np.int32)
            to = slice(first, first + len(some))
            codes[to] = np.frombuffer(batch.column("codes")[i].as_buffer(), np.uint8).reshape(-1, bands)
            labels[to] = some
            filled += len(some)
    if task < 0:
        return task, np.empty((0, bands), np.uint8), np.empty(0, np.int32)
    if filled != n:
        raise ValueError(f"{filled} of {n} labelled rows arrived")
    return task, codes, labels


def _class_counts(label: np.ndarray, classes: int) -> np.ndarray:
    """Rows of each class."""
    return sum((np.bincount(label[part], minlength=classes) for part in blocks(len(label))), np.zeros(classes, np.intp))


def balanced(label: np.ndarray, classes: int) -> np.ndarray:
    """Weights that give every class the same total."""
    counts, weight = _class_counts(label, classes), row_array(label.shape, float)
    for part in blocks(len(label)):
        weight[part] = len(label) / ((counts > 0).sum() * np.maximum(counts, 1)[label[part]])
    return weight


def _row(number: int, k: int, tree: Tree) -> dict:
    return {"tree": number, "class": k} | {name: part.tobytes() for name, part in asdict(tree).items()}


def _tree(row) -> Tree:
    return Tree(
        np.frombuffer(row["feature"], np.int16), np.frombuffer(row["cut"], np.uint8),
        np.frombuffer(row["child"], np.int32), np.frombuffer(row["value"], np.float32),
        np.frombuffer(row["importance"], np.float64),
    )


def grow(packed: DataFrame, ends: list[int], plan: Forest | Boosting, bands: int, classes: int) -> DataFrame:
    """The stored trees of an ensemble."""
    spark = packed.sparkSession
    slots = spark.sparkContext.defaultParallelism
    forest = isinstance(plan, Forest)
    tasks = min(plan.trees, slots) if forest else 1 if ends[-1] <= ALONE_ROWS else min(classes, slots)

    def batch(rows: list[dict]) -> pa.RecordBatch:
        kinds = [pa.int32(), pa.int32()] + [pa.binary()] * 5
        names = [f.split(" ")[0] for f in TREES.split(", ")]
        return pa.RecordBatch.from_pylist(rows, pa.schema(list(zip(names, kinds))))

    def forest_trees(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        task, codes, label = _unpacked(batches, bands, ends, False)
        if task < 0:
            return
        weight = balanced(label, classes)
        for number in range(task, plan.trees, tasks):
            draw = np.random.default_rng([plan.seed, number])
            yield batch([_row(number, -1, grow_forest_tree(codes, label, weight, classes, plan, draw))])

    def boosted_trees(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        task, codes, label = _unpacked(batches, bands, ends, True)
        if task < 0:
            return

        def together(grown: dict[int, Tree]) -> dict[int, Tree]:
            if tasks == 1:
                return grown
            said = json.dumps([{k: v.hex() if isinstance(v, bytes) else v for k, v in _row(0, c, t).items()} for c, t in grown.items()])
            every = [row for part in BarrierTaskContext.get().allGather(said) for row in json.loads(part)]
            return {r["class"]: _tree({k: bytes.fromhex(v) if isinstance(v, str) else v for k, v in r.items()}) for r in every}

        mine = range(task, classes, tasks)
        rounds = boost(codes, label, balanced(label, classes), classes, plan, mine, together)
        for number, trees in enumerate(rounds):
            rows = [_row(number, k, tree) for k, tree in sorted(trees.items()) if k in mine]
            if rows:
                yield batch(rows)

    copies = packed.select("*", F.explode(F.sequence(F.lit(0), F.lit(tasks - 1))).alias("task"))
    dealt = copies.repartitionById(tasks, "task")
    grown = dealt.mapInArrow(forest_trees if forest else boosted_trees, TREES, barrier=not forest and tasks > 1)
    return cut_lineage(grown, "trees")


# models -------------------------------------------------------------------------------------------
class TreeModel:
    """A fitted ensemble: the edges of the bands and a stored table of trees."""

    def __init__(self, trees: DataFrame, about: dict):
        self.trees, self.about = trees, about

    @property
    def features(self) -> list[str]:
        return self.about["features"]

    def _part(self, part: int, parts: int) -> list[tuple[int, Tree]]:
        """Class and nodes of every ``parts``-th tree, in order."""
        rows = self.trees.where(F.col("tree") % parts == part).drop("importance").collect()
        rows.sort(key=lambda r: (r["tree"], r["class"]))
        return [(r["class"], _tree(r.asDict() | {"importance": b""})) for r in rows]

    def transform(self, data: DataFrame, prediction: str = "prediction") -> DataFrame:
        """``data`` with the class (a double) of every row; null where a band is null.

        Rows are scored in batches as they are scanned; nothing is shuffled.
        """
        spark, about = data.sparkSession, self.about
        classes, depth, forest = about["classes"], about["depth"], about["kind"] == "forest"
        edges = [np.array(e) for e in about["edges"]]
        names = [c for c in data.columns if c != prediction]
        at = [names.index(f) for f in about["features"]]
        source, schema = data.select(*names), data.select(*names).schema
        held = [F.octet_length(c).cast("long") for c in ("feature", "cut", "child", "value")]
        parts = max(1, -(-(self.trees.agg(F.sum(sum(held, F.lit(0)))).first()[0] or 0) // MODEL_BYTES))

        def scored(sums: str | None, last: bool, sent) -> Callable:
            def rows(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
                for batch in batches:
                    values = [batch.column(i).to_numpy(zero_copy_only=False).astype(np.float64) for i in at]
                    codes = coded(values, edges)
                    known = ~np.isnan(np.stack(values, 1)).any(1) if values else np.ones(batch.num_rows, bool)
                    votes = np.tile(np.array(about["prior"]), (len(codes), 1))
                    if sums:
                        votes = np.array(batch.column(sums).to_pylist(), float).reshape(len(codes), classes)
                    for k, tree in sent.value:
                        leaf = tree.leaves(codes, depth)
                        if forest:
                            votes += tree.value.reshape(-1, classes)[leaf]
                        else:
                            votes[:, k] += tree.value[leaf]
                    kept = [batch.column(c) for c in names]
                    if last:
                        best = pa.array(votes.argmax(1).astype(float), mask=~known)
                        yield pa.RecordBatch.from_arrays([*kept, best], [*names, prediction])
                    else:
                        yield pa.RecordBatch.from_arrays([*kept, pa.array(votes.tolist(), pa.list_(pa.float64()))], [*names, "votes_"])

            return rows

        for i in range(parts):
            last = i + 1 == parts
            sent = spark.sparkContext.broadcast(self._part(i, parts))
            kind = StructField(prediction, DoubleType()) if last else StructType.fromDDL("votes_ ARRAY<DOUBLE>")["votes_"]
            source = source.mapInArrow(scored("votes_" if i else None, last, sent), StructType([*schema, kind]))
            if not last:
                source = cut_lineage(source, "votes")
        return source

    def importances(self) -> dict[str, float]:
        """The share of each band in the gain of the cuts; of a forest, the mean share of the trees."""
        rows = self.trees.select("importance").collect()
        total = sum((np.frombuffer(r[0], np.float64) for r in rows), np.zeros(len(self.features)))
        return dict(zip(self.features, (total / max(total.sum(), 1e-300)).tolist(), strict=True))

    def save(self, path: str) -> None:
        self.trees.write.mode("overwrite").parquet(f"{path}/trees")
        about = self.trees.sparkSession.createDataFrame([(json.dumps(self.about),)], "about STRING")
        about.coalesce(1).write.mode("overwrite").parquet(f"{path}/about")

    @staticmethod
    def load(spark: SparkSession, path: str) -> TreeModel:
        about = spark.read.schema("about STRING").parquet(f"{path}/about").first()[0]
        return TreeModel(spark.read.schema(TREES).parquet(f"{path}/trees"), json.loads(about))


def fit(
    rows: DataFrame,
    plan: Forest | Boosting,
    features: Sequence[str],
    label: str,
    keys: Sequence[str],
) -> TreeModel:
    """Fit an ensemble on all ``rows`` (stored), classes weighted equally.

    Only rows with a null band or label are left out.  Trees follow from the rows, their ``keys`` and the seed
    alone, not from partitions or the number of tasks.
    """
    edges = band_edges(rows, features)
    packed, ends = packed_rows(rows, features, label, keys, edges)
    counts = {int(k): c for k, c in rows.where(F.col(label).isNotNull()).groupBy(label).count().collect()}
    classes = max(counts, default=-1) + 1
    trees = grow(packed, ends, plan, len(features), max(1, classes))
    discard(packed)
    forest = isinstance(plan, Forest)
    about = {
        "kind": "forest" if forest else "boosting",
        "features": list(features),
        "edges": edges,
        "classes": max(1, classes),
        "depth": plan.depth + 1,
        "prior": prior([counts.get(k, 0) for k in range(max(1, classes))]),
    }
    return TreeModel(trees, about)
