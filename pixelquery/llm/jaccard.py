"""Near duplicates: a Jaccard join on word n-grams by chosen paths."""

from __future__ import annotations

import math
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pixelquery.llm.components import roots, stars
from pixelquery.llm.exchange import flat
from pixelquery.llm.substring import window_hashes
from pixelquery.llm.text import fresh, keyed, whole, word_hashes
from pixelquery.session import cut_lineage, discard

#: Minimum hashes of a set, one byte of each kept; a path splits on one of them at a time.
COORDINATES = 64
#: Buckets up to this size are compared in full; larger ones are split again.
BUCKET = 256
#: Sketches at least this alike are put into one cluster for the exact comparison; at a similarity of 0.8
#: a sketch shows less with a probability under one in a million.
ALIKE = 0.55
#: In a bucket that is too large to compare all its sets, those nearly like its leader needn't be split
#: further: whatever is similar enough to one of them is still somewhat like the leader, because Jaccard
#: distances add up, and so joins its cluster.
SETTLED, LINKED = 0.75, 0.35
#: Sets of one cluster that are compared with one another in one task.
BLOCK = 256
_FACTOR = 0xC2B2AE3D27D4EB4F
_GOLDEN = np.uint64(0x9E3779B97F4A7C15)


def _mix(x: np.ndarray) -> np.ndarray:
    with np.errstate(over="ignore"):
        x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
        x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
        return x ^ (x >> np.uint64(31))


def shingle_sets(words: np.ndarray, starts: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
    """The different n-gram hashes of each document, in one array, and where each document starts.

    A text with fewer than ``n`` words, but one at least, has all of them as its only n-gram.
    """
    grams = window_hashes(words, n, _FACTOR)
    sets = []
    for a, b in zip(starts, starts[1:]):
        if b - a >= n:
            sets.append(np.unique(grams[a : b - n + 1]))
        elif b > a:
            with np.errstate(over="ignore"):
                sets.append(window_hashes(words[a:b], int(b - a), _FACTOR) + np.uint64(b - a))
        else:
            sets.append(np.empty(0, np.uint64))
    at = np.concatenate([[0], np.cumsum([len(s) for s in sets])]).astype(np.int64)
    return (np.concatenate(sets) if sets else np.empty(0, np.uint64)), at


def sketches(values: np.ndarray, at: np.ndarray) -> np.ndarray:
    """Minimum hashes of sets that aren't empty: one row of ``COORDINATES`` for each."""
    out = np.empty((len(at) - 1, COORDINATES), np.uint32)
    with np.errstate(over="ignore"):
        mixed = _mix(values)
        for k in range(COORDINATES):
            hashed = (mixed * (_mix(np.array([k], np.uint64))[0] | np.uint64(1)) + _GOLDEN * np.uint64(k)) >> np.uint64(32)
            out[:, k] = np.minimum.reduceat(hashed.astype(np.uint32), at[:-1])
    return out


def runs_for(recall: float, similarity: float, depth: int = 2) -> int:
    """How often the join is repeated: at ``depth`` splits, a pair stays together with similarity**depth."""
    return math.ceil(math.log(1 - recall) / math.log(1 - similarity**depth))


def _measured(docs: DataFrame, doc_id: str, text: str, uid: str | None, n: int) -> DataFrame:
    """Store ``uid, doc_id, text_hash, set_a, set_b, sketch`` of every row; the last three null without words."""

    def rows(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for from_ in range(0, batch.num_rows, 1000):
                part = batch.slice(from_, 1000)
                words, starts = flat(pa.chunked_array([part.column("hashes")]))
                values, at = shingle_sets(words, starts, n)
                full = np.flatnonzero(np.diff(at) > 0)
                a = b = marks = [None] * part.num_rows
                if len(full):
                    inner = np.append(at[full], len(values))
                    with np.errstate(over="ignore"):
                        first = np.add.reduceat(_mix(values), inner[:-1])
                        second = np.add.reduceat(_mix(values ^ _GOLDEN), inner[:-1])
                    sketch = sketches(values, inner).astype(np.uint8)
                    a, b, marks = ([None] * part.num_rows for _ in range(3))
                    for i, x, y, s in zip(full, first.view(np.int64), second.view(np.int64), sketch):
                        a[i], b[i], marks[i] = int(x), int(y), s.tobytes()
                yield pa.RecordBatch.from_arrays(
                    [*(part.column(c) for c in ("uid", "doc_id", "text_hash")), pa.array(a, pa.int64()),
                     pa.array(b, pa.int64()), pa.array(marks, pa.binary())],
                    ["uid", "doc_id", "text_hash", "set_a", "set_b", "sketch"],
                )

    source = docs.select(
        (F.col(uid) if uid else F.monotonically_increasing_id()).alias("uid"),
        F.col(doc_id).cast("long").alias("doc_id"),
        F.xxhash64(whole(text)).alias("text_hash"),
        word_hashes(text).alias("hashes"),
    )
    fields = "uid BIGINT, doc_id BIGINT, text_hash BIGINT, set_a BIGINT, set_b BIGINT, sketch BINARY"
    return cut_lineage(source.mapInArrow(rows, fields), "sketches")


def _matrix(column: pa.Array) -> np.ndarray:
    return np.frombuffer(b"".join(column.to_pylist()), np.uint8).reshape(-1, COORDINATES)


def _branches(path: np.ndarray, sketch: np.ndarray) -> list[tuple[np.ndarray, np.ndarray]]:
    """Rows and new paths: every bucket splits on one coordinate of its choice, one in four on two."""
    rows = np.arange(len(path))
    with np.errstate(over="ignore"):
        draw = _mix(path * _GOLDEN)
        out = []
        for turn, some in ((0, rows), (1, rows[(draw >> np.uint64(40)) % np.uint64(4) == 0])):
            k = ((draw[some] >> np.uint64(8 * turn)) % np.uint64(COORDINATES)).astype(np.int64)
            value = sketch[some, k].astype(np.uint64) | (k.astype(np.uint64) << np.uint64(8))
            out.append((some, _mix(path[some] + _mix(value + np.uint64(turn * 65536 + 1)))))
    return out


def _path_rows(path: np.ndarray, rep: np.ndarray, sketch: np.ndarray) -> pa.RecordBatch:
    parts = _branches(path, sketch)
    at = np.concatenate([rows for rows, _ in parts])
    new = np.concatenate([p for _, p in parts])
    marks = [sketch[i].tobytes() for i in at]
    return pa.RecordBatch.from_arrays(
        [pa.array(new.view(np.int64)), pa.array(rep[at]), pa.array(marks, pa.binary())], ["path", "rep", "sketch"]
    )


_PATHS = "path BIGINT, rep BIGINT, sketch BINARY"
_EDGES = "a BIGINT, b BIGINT"


def first_paths(reps: DataFrame, runs: int) -> DataFrame:
    """The first two splits of every run, so that no bucket starts with all sets."""

    def rows(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            sketch, rep = _matrix(batch.column("sketch")), batch.column("rep").to_numpy()
            for run in range(runs):
                root = np.full(len(rep), _mix(np.array([run + 1], np.uint64))[0])
                once = _path_rows(root, rep, sketch)
                path = once.column("path").to_numpy().view(np.uint64)
                yield _path_rows(path, once.column("rep").to_numpy(), _matrix(once.column("sketch")))

    return reps.mapInArrow(rows, _PATHS)


def _alike(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    return (a == b).mean(1)


def leader_edges(path: np.ndarray, rep: np.ndarray, sketch: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Edges that join all sets of a bucket whose sketches are alike; rows are ordered by path.

    In each round the first set of every bucket is compared with all that follow it, and goes.  The
    edges are contracted to one per set, as only clusters matter here.
    """
    out_a, out_b = [np.empty(0, np.int64)], [np.empty(0, np.int64)]
    while len(path) > 1:
        new = np.append(True, path[1:] != path[:-1])
        head = np.flatnonzero(new)[np.cumsum(new) - 1]
        linked = ~new & (_alike(sketch, sketch[head]) >= ALIKE)
        out_a.append(rep[linked])
        out_b.append(rep[head[linked]])
        path, rep, sketch = path[~new], rep[~new], sketch[~new]
    return stars(np.concatenate(out_a), np.concatenate(out_b))


def bucket_edges(buckets: DataFrame) -> DataFrame:
    """Edges of all small buckets; tasks read whole buckets, in the order of their paths."""

    def rows(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []

        def done(last: bool) -> Iterator[pa.RecordBatch]:
            path, rep, sketch = (np.concatenate(x) for x in zip(*held))
            end = len(path) if last else int(np.argmax(path == path[-1]))
            held[:] = [] if last else [(path[end:], rep[end:], sketch[end:])]
            a, b = leader_edges(path[:end], rep[:end], sketch[:end])
            yield pa.RecordBatch.from_arrays([pa.array(a), pa.array(b)], ["a", "b"])

        for batch in batches:
            if batch.num_rows:
                held.append(
                    (batch.column("path").to_numpy(), batch.column("rep").to_numpy(), _matrix(batch.column("sketch")))
                )
                yield from done(False)
        if held:
            yield from done(True)

    return buckets.repartition("path").sortWithinPartitions("path", "rep").mapInArrow(rows, _EDGES)


def candidate_edges(reps: DataFrame, runs: int) -> tuple[DataFrame, list[DataFrame]]:
    """Edges between sets that may be similar enough, by repeated chosen-path splits of their sketches.

    Also the stored tables that the edges are read from, to discard once the edges are stored.
    """

    def settle(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            path = batch.column("path").to_numpy().view(np.uint64)
            rep, leader = batch.column("rep").to_numpy(), batch.column("leader").to_numpy()
            sketch = _matrix(batch.column("sketch"))
            alike = _alike(sketch, _matrix(batch.column("leads")))
            linked = (alike >= LINKED) & (rep != leader)
            none = pa.nulls(int(linked.sum()))
            yield pa.RecordBatch.from_arrays(
                [none.cast(pa.int64()), pa.array(rep[linked]), none.cast(pa.binary()), pa.array(leader[linked])],
                ["path", "rep", "sketch", "leader"],
            )
            left = (alike < SETTLED) & (rep != leader)
            again = _path_rows(path[left], rep[left], sketch[left])
            yield pa.RecordBatch.from_arrays(
                [*again.columns, pa.nulls(again.num_rows, pa.int64())], ["path", "rep", "sketch", "leader"]
            )

    edges, paths, used = None, first_paths(reps, runs), []
    lead = reps.select(F.col("rep").alias("leader"), F.col("sketch").alias("leads"))
    while True:
        sizes = paths.groupBy("path").agg(F.count("*").alias("n"), F.min("rep").alias("leader")).where("n > 1")
        shared = cut_lineage(paths.join(sizes, "path"), "buckets")
        used.append(shared)
        small = bucket_edges(shared.where(F.col("n") <= BUCKET).select("path", "rep", "sketch"))
        edges = small if edges is None else edges.union(small)
        large = shared.where(F.col("n") > BUCKET)
        if large.isEmpty():
            return edges, used
        split = large.join(lead, "leader").select("path", "rep", "sketch", "leader", "leads")
        split = cut_lineage(split.mapInArrow(settle, _PATHS + ", leader BIGINT"), "split")
        used.append(split)
        edges = edges.union(split.where("leader IS NOT NULL").select(F.col("rep").alias("a"), F.col("leader").alias("b")))
        paths = split.where("leader IS NULL").select("path", "rep", "sketch")


def overlaps(values: np.ndarray, owner: np.ndarray, n: int) -> np.ndarray:
    """Sizes of all pairwise intersections of ``n`` sets, from n-grams that two sets or more hold."""
    _, number, counts = np.unique(values, return_inverse=True, return_counts=True)
    held = counts[number] > 1
    column = (np.cumsum(counts > 1) - 1)[number[held]]
    row, total = owner[held], np.zeros((n, n), np.float32)
    order = np.argsort(column, kind="stable")
    row, column = row[order], column[order]
    step = max(1, 4_000_000 // max(1, n))
    for first in range(0, int(column[-1]) + 1 if len(column) else 0, step):
        a, b = np.searchsorted(column, [first, first + step])
        x = np.zeros((n, step), np.float32)
        x[row[a:b], column[a:b] - first] = 1
        total += x @ x.T
    return total.astype(np.int64)


def verified(members: DataFrame, docs: DataFrame, doc_id: str, text: str, n: int, similarity: tuple[int, int]) -> DataFrame:
    """``rep, n_links, root``: exact links of every set inside its cluster of candidates.

    ``members`` has ``rep, copies, doc_id, text_hash, cluster``.  A cluster of more than ``BLOCK`` sets is
    dealt into blocks by hash, and each pair of blocks is compared once, so no task holds more than two
    blocks.  A task counts the links of each set and gives one edge per set, to the smallest set of its
    part; pairs are never listed.
    """
    up, down = similarity
    sizes = members.groupBy("cluster").agg(F.count("*").alias("size"))
    blocks = F.ceil(F.col("size") / BLOCK).cast("int")
    placed = members.join(sizes, "cluster").withColumn("blocks", blocks)
    placed = placed.withColumn("block", F.pmod(F.xxhash64("rep"), F.col("blocks")).cast("int"))
    source = docs.select(
        F.col(doc_id).cast("long").alias("_doc"), F.xxhash64(whole(text)).alias("_hash"), whole(text).alias("text")
    )
    same = F.col("doc_id").eqNullSafe(F.col("_doc")) & (F.col("text_hash") == F.col("_hash"))
    # merged whatever the sizes, so that a large corpus behaves as a small one does
    rows = placed.hint("merge").join(source, same).select("rep", "copies", "cluster", "blocks", "block", "text")
    weight = members.join(sizes, "cluster").agg(F.count("*")).first()[0] or 0
    tasks = max(1, weight // 1000)
    other = F.explode(F.sequence(F.lit(0), F.col("blocks") - 1))
    rows = rows.withColumn("other", other).select(
        F.when(F.col("blocks") == 1, F.pmod(F.xxhash64("cluster"), F.lit(tasks))).otherwise(F.col("cluster")).alias("task"),
        (F.col("blocks") > 1).alias("wide"),
        F.least("block", "other").alias("low"),
        F.greatest("block", "other").alias("high"),
        "cluster", "block", "rep", "copies", "text",
    ).repartition("task", "wide", "low", "high")
    rows = rows.withColumn("hashes", word_hashes("text")).drop("text")

    def links(table):
        order = np.argsort(table.column("cluster").to_numpy(), kind="stable")
        table = table.take(pa.array(order))
        cluster, rep, copies, block = (table.column(c).to_numpy() for c in ("cluster", "rep", "copies", "block"))
        low, high = table.column("low")[0].as_py(), table.column("high")[0].as_py()
        column = table.column("hashes")
        out: list[list[np.ndarray]] = [[], [], []]
        ends = np.flatnonzero(np.append(cluster[1:] != cluster[:-1], True)) + 1
        for a, b in zip(np.append(0, ends[:-1]), ends):
            _, first = np.unique(rep[a:b], return_index=True)  # repeated rows bring their text twice
            which = a + first
            words, starts = flat(pa.chunked_array([column.take(pa.array(which)).combine_chunks()]))
            values, at = shingle_sets(words, starts, n)
            size, m = np.diff(at), len(which)
            shared = overlaps(values, np.repeat(np.arange(m), size), m)
            near = shared * (up + down) >= up * (size[:, None] + size[None, :])
            np.fill_diagonal(near, False)
            if low != high:
                near &= block[which][:, None] != block[which][None, :]
            root = np.arange(m)
            while True:  # each set takes the smallest label of those it is linked to
                least = np.minimum(root, np.where(near, root[None, :], m).min(1))
                if (least == root).all():
                    break
                root = least
            for held, x in zip(out, (rep[which], near @ copies[which], rep[which][root])):
                held.append(x)
        names = ["rep", "n_links", "root"]
        return pa.table({k: pa.array(np.concatenate(x), pa.int64()) for k, x in zip(names, out)})

    found = rows.groupBy("task", "wide", "low", "high").applyInArrow(links, "rep BIGINT, n_links BIGINT, root BIGINT")
    return cut_lineage(found, "links")


def near_duplicates(
    docs: DataFrame,
    doc_id: str = "doc_id",
    text: str = "text",
    uid: str | None = None,
    words_each: int = 5,
    similarity: tuple[int, int] = (4, 5),
    recall: float = 0.9999,
) -> DataFrame:
    """One row per row of ``docs``: ``uid, doc_id, class_id, n_links, kept``.

    Rows are linked when the Jaccard similarity of their sets of ``words_each`` consecutive words is
    ``similarity`` (a fraction) or more.  A class is what links join; ``class_id`` is its smallest id,
    ``n_links`` the number of other rows that the row is linked to.  The row with the smallest id of a
    class stays (a null id is larger than any other; of repeated rows with that id, one stays).

    1. Rows with equal sets are one set with its number of copies.
    2. Chosen paths: in each run, sets split on minimum hashes of shared n-grams; buckets of up to
       ``BUCKET`` sets are compared by sketch, larger ones are split again.  Runs are repeated until a
       pair at the threshold is found with probability ``recall``.
    3. What looks alike makes clusters, inside which all sets are compared exactly.

    Texts with one to four words have all their words as one n-gram, texts without words (also null
    ones) are linked to nothing.  Other columns are ignored, whatever their names.  An empty table gives
    an empty result.
    """
    up, down = similarity
    rows = _measured(docs, doc_id, text, uid, words_each)
    first = F.min(F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "uid", "text_hash", "sketch")).alias("f")
    sets = rows.where("set_a IS NOT NULL").groupBy("set_a", "set_b").agg(first, F.count("*").alias("copies"))
    sets = cut_lineage(
        sets.select("set_a", "set_b", "copies", F.col("f.uid").alias("rep"), "f.none", "f.doc_id", "f.text_hash", "f.sketch"),
        "sets",
    )
    edges, used = candidate_edges(sets.select("rep", "sketch"), runs_for(recall, up / down))
    clusters = roots(edges).select(F.col("node").alias("rep"), F.col("root").alias("cluster"))
    discard(*used)  # their edges are in the components now
    members = cut_lineage(sets.select("rep", "copies", "doc_id", "text_hash").join(clusters, "rep"), "members")
    links = verified(members, docs, doc_id, text, words_each, similarity)
    discard(members)
    counts = links.groupBy("rep").agg(F.sum("n_links").alias("others"))
    classes = roots(links.select(F.col("rep").alias("a"), F.col("root").alias("b")))
    classes = classes.select(F.col("node").alias("rep"), F.col("root").alias("class"))
    linked = sets.join(counts, "rep", "left").join(classes, "rep", "left").select(
        "set_a", "set_b", "none", "doc_id", "rep",
        F.coalesce("class", "rep").alias("class"),
        (F.coalesce("others", F.lit(0)) + F.col("copies") - 1).alias("n_links"),
    )
    linked = cut_lineage(linked, "classes")
    discard(sets, links)
    stays = F.min(F.struct("none", "doc_id", "rep")).alias("s")
    heads = linked.groupBy("class").agg(stays).select("class", F.col("s.doc_id").alias("head"), F.col("s.rep").alias("stays"))
    of_set = linked.join(heads, "class").select("set_a", "set_b", "head", "stays", "n_links")
    return rows.join(of_set, ["set_a", "set_b"], "left").select(
        "uid",
        "doc_id",
        F.when(F.col("stays").isNull(), F.col("doc_id")).otherwise(F.col("head")).alias("class_id"),
        F.coalesce("n_links", F.lit(0)).alias("n_links"),
        F.coalesce(F.col("uid") == F.col("stays"), F.lit(True)).alias("kept"),
    )


def drop_near_duplicates(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """One row of each class of ``docs``, with all its columns (see ``near_duplicates``)."""
    uid = fresh(docs, "uid")
    stored = keyed(docs, *docs.columns, uid=uid, label="documents")
    stays = near_duplicates(stored, doc_id, text, uid).where("kept").select(F.col("uid").alias(uid))
    return stored.join(stays, uid, "left_semi").select(*docs.columns)
