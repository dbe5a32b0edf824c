"""How the sources of a language differ, over the terms that iceberg prefix refinement keeps."""

from __future__ import annotations

from array import array
from collections import defaultdict
from collections.abc import Iterable, Iterator
from itertools import count

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from pixelquery.llm.text import whole
from pixelquery.session import cut_lineage, discard

#: Bytes of texts: A-Z in lower case, other ASCII bytes but letters to spaces; bytes of other characters stay.
FOLD = bytes(b + 32 if 65 <= b <= 90 else b if 97 <= b <= 122 or b > 127 else 32 for b in range(256))
#: Words and different words that a scanning task holds before it hands their counts on.
WORDS, DIFFERENT = 1 << 22, 1 << 19
#: Rows that are refined together, at least; a block ends where a term ends.
BLOCK = 200_000
#: Prefixes are extended up to so many bytes; longer terms are then judged whole.
LEVELS = 64
#: Cells of two sources that a task compares at once.
CELLS = 1 << 20
SCALE = 1_000_000_000
PARTIAL = "lang STRING, term BINARY, docs BIGINT, seen BINARY, counts BINARY"
COUNTED = "lang STRING, term STRING, gid BIGINT, n BIGINT, total BIGINT, first BOOLEAN"


# counting -----------------------------------------------------------------------------------------
def _bytes(values: np.ndarray, cuts: np.ndarray) -> pa.Array:
    """The rows of ``values`` between cuts, as bytes."""
    offsets = (cuts * (values[:1].nbytes or 8)).astype(np.int32)
    return pa.Array.from_buffers(pa.binary(), len(cuts) - 1, [None, pa.py_buffer(offsets), pa.py_buffer(values)])


def _numbers(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """All numbers in a column of bytes, and how many each row has."""
    offsets = np.frombuffer(column.buffers()[1], np.int32)[column.offset : column.offset + len(column) + 1]
    data = column.buffers()[2]
    total = (int(offsets[-1]) - int(offsets[0])) // 8
    values = np.frombuffer(data, np.int64, total, int(offsets[0])) if total else np.empty(0, np.int64)
    return values, np.diff(offsets) // 8


def partial_counts(docs: DataFrame, least: int) -> DataFrame:
    """The stored counts of each scanning task, one row for a language and term.

    ``docs`` has ``lang, gid`` (the number of language and source) and ``body`` (bytes), none null.  A row
    has the number of documents, ``least`` of them by number (``seen``), and pairs of gid and occurrences
    (``counts``), as 64-bit numbers.
    """

    def table(words: list[bytes], codes: array, sizes: list, langs: list, gids: list, last: int) -> Iterator:
        lang_names, lang = np.unique(np.array(langs, object), return_inverse=True)
        group_ids, group = np.unique(np.array(gids, np.int64), return_inverse=True)
        doc = np.repeat(np.arange(len(sizes)), sizes)
        keys, n = np.unique(doc * len(words) + np.array(codes, np.int64), return_counts=True)
        doc, code = np.divmod(keys, max(1, len(words)))
        entry = lang[doc] * len(words) + code
        pair = entry * len(group_ids) + group[doc]
        order = np.argsort(pair, kind="stable")
        doc, n, entry, pair = doc[order], n[order], entry[order], pair[order]
        starts = np.flatnonzero(np.concatenate([[True], entry[1:] != entry[:-1]]))
        pair_starts = np.flatnonzero(np.concatenate([[True], pair[1:] != pair[:-1]]))
        docs_of = np.diff(np.append(starts, len(entry)))
        shown = np.minimum(docs_of, least)
        cuts = np.concatenate([[0], np.cumsum(shown)])
        place = np.repeat(starts - cuts[:-1], shown) + np.arange(cuts[-1])
        seen = last - len(sizes) + 1 + doc[place]
        counts = np.stack([group_ids[pair[pair_starts] % len(group_ids)], np.add.reduceat(n, pair_starts)], 1)
        of = entry[starts]
        columns = [
            pa.array(lang_names.tolist(), pa.string()).take(pa.array(of // len(words))),
            pa.array(words, pa.binary()).take(pa.array(of % len(words))),
            pa.array(docs_of),
            _bytes(seen, cuts),
            _bytes(counts, np.searchsorted(pair_starts, np.append(starts, len(entry)))),
        ]
        whole_batch = pa.RecordBatch.from_arrays(columns, ["lang", "term", "docs", "seen", "counts"])
        for at in range(0, len(of), 50_000):
            yield whole_batch.slice(at, 50_000)

    def rows(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words, codes, sizes, langs, gids = defaultdict(count().__next__), array("i"), [], [], []
        number = TaskContext.get().partitionId() << 40
        for batch in batches:
            keys = zip(batch.column("lang").to_pylist(), batch.column("gid").to_pylist())
            for (lang, gid), body in zip(keys, batch.column("body")):
                number += 1
                found = body.as_py().translate(FOLD).split()
                codes.extend(map(words.__getitem__, found))
                sizes.append(len(found))
                langs.append(lang)
                gids.append(gid)
                if len(codes) >= WORDS or len(words) >= DIFFERENT:
                    yield from table(list(words), codes, sizes, langs, gids, number)
                    words, codes, sizes, langs, gids = defaultdict(count().__next__), array("i"), [], [], []
        if codes:
            yield from table(list(words), codes, sizes, langs, gids, number)

    return cut_lineage(docs.mapInArrow(rows, PARTIAL), "terms")


# refinement ---------------------------------------------------------------------------------------
def common(terms: np.ndarray, width: int) -> np.ndarray:
    """Bytes that each of the sorted terms shares with the one before, ``width`` at most; 0 for the first."""
    letters = np.frombuffer(terms.tobytes(), np.uint8).reshape(len(terms), -1)[:, :width]
    differ = letters[1:] != letters[:-1]
    shared = np.where(differ.any(1), differ.argmax(1), width)
    return np.concatenate([[0], shared])


def refine(
    terms: list[bytes], new: np.ndarray, docs: np.ndarray, owner: np.ndarray, seen: np.ndarray, least: int
) -> np.ndarray:
    """Places of the terms that are in ``least`` documents, found by extending their prefixes.

    ``terms`` are sorted and different within a language, which starts where ``new`` is set; ``docs`` are
    their numbers of documents, and document ``seen[k]`` has the term ``owner[k]``, for ``least`` documents
    of a term or all.  Level by level, the surviving terms are grouped by one byte more, and all terms of
    a prefix go when fewer than ``least`` different documents have it.  The first and the last prefix of a
    level may go on in another block, so they always stay.  Complete terms are judged by their own number.
    """
    lengths = np.fromiter(map(len, terms), np.int64, len(terms))
    width = int(min(LEVELS, lengths.max(initial=1)))
    shared = common(np.array([t[:width] for t in terms], f"S{width}"), width)
    shared[new] = -1
    alive = np.arange(len(terms))
    different, seen = np.unique(seen, return_inverse=True)
    for level in range(1, width + 1):
        prefix = np.cumsum(shared < level)
        frequent = np.zeros(prefix[-1] + 1 if len(prefix) else 1, bool)
        frequent[prefix[docs[alive] >= least]] = True
        if len(prefix):
            frequent[[prefix[0], prefix[-1]]] = True
        unsure = ~frequent[prefix]
        at = np.full(len(terms), -1)
        at[alive[unsure]] = prefix[unsure]
        found = at[owner]
        asked = found >= 0
        pairs = np.unique(found[asked] * max(1, len(different)) + seen[asked])
        frequent |= np.bincount(pairs // max(1, len(different)), minlength=len(frequent)) >= least
        stays = frequent[prefix] | (lengths[alive] < level)
        if not stays.all():
            kept = np.flatnonzero(stays)
            if not len(kept):
                return kept
            # what two survivors share is the least that any two neighbours between them share
            shared = np.minimum.reduceat(shared[: kept[-1] + 1], np.concatenate([[0], kept[:-1] + 1]))
            alive = alive[kept]
        if not (lengths[alive] > level).any():
            break
    return alive[docs[alive] >= least]


def kept_terms(partial: DataFrame, least: int) -> DataFrame:
    """The stored ``lang, term, gid, n, total, first`` of all kept terms.

    ``n`` is the term's occurrences in the group, ``total`` in the language; ``first`` marks one row of
    each term.  Terms are range-sorted, so a prefix is a run of rows, whatever share of all rows has it;
    what a task holds is one block and the rows of one term, which are as many as scanning tasks have it.
    """

    def block(tables: list[pa.RecordBatch]) -> pa.RecordBatch | None:
        rows = pa.Table.from_batches(tables).combine_chunks().to_batches()[0]
        lang, term, docs = rows.column("lang"), rows.column("term"), rows.column("docs").to_numpy()

        def changes(column) -> np.ndarray:
            differ = pc.not_equal(column[1:], column[:-1]).to_numpy(zero_copy_only=False)
            return np.concatenate([[True], differ])

        new_lang = changes(lang)
        new_term = changes(term) | new_lang
        starts = np.flatnonzero(new_term)
        entry = np.cumsum(new_term) - 1
        seen, of = _numbers(rows.column("seen"))
        alive = refine(
            term.take(pa.array(starts)).to_pylist(), new_lang[starts], np.add.reduceat(docs, starts),
            np.repeat(entry, of), seen, least,
        )
        if not len(alive):
            return None
        counts, of = _numbers(rows.column("counts"))
        counts, owner = counts.reshape(-1, 2), np.repeat(entry, of // 2)
        stays = np.zeros(len(starts), bool)
        stays[alive] = True
        counts, owner = counts[stays[owner]], owner[stays[owner]]
        gids, group = np.unique(counts[:, 0], return_inverse=True)
        pair = owner * len(gids) + group
        order = np.argsort(pair, kind="stable")
        pair, n = pair[order], counts[order, 1]
        heads = np.flatnonzero(np.concatenate([[True], pair[1:] != pair[:-1]]))
        n, pair = np.add.reduceat(n, heads), pair[heads]
        owner = pair // len(gids)
        first = np.concatenate([[True], owner[1:] != owner[:-1]])
        total = np.add.reduceat(n, np.flatnonzero(first))[np.cumsum(first) - 1]
        place = pa.array(starts[owner])
        return pa.RecordBatch.from_arrays(
            [lang.take(place), term.take(place).cast(pa.string()), pa.array(gids[pair % len(gids)]), pa.array(n),
             pa.array(total), pa.array(first)], ["lang", "term", "gid", "n", "total", "first"],
        )

    def rows(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []
        size = 0
        for batch in batches:
            if not batch.num_rows:
                continue
            held.append(batch)
            size += batch.num_rows
            if size < BLOCK:
                continue
            # the last term may go on in the next batch
            last = (batch.column("lang")[-1].as_py(), batch.column("term")[-1].as_py())
            same = pc.and_(pc.equal(batch.column("lang"), last[0]), pc.equal(batch.column("term"), last[1]))
            cut = len(batch) - int(pc.sum(same).as_py())
            if not cut:
                continue
            found = block([*held[:-1], batch.slice(0, cut)])
            held, size = [batch.slice(cut)], len(batch) - cut
            if found is not None:
                yield found
        if held and (found := block(held)) is not None:
            yield found

    spread = partial.repartitionByRange("lang", "term").sortWithinPartitions("lang", "term")
    return cut_lineage(spread.mapInArrow(rows, COUNTED), "kept")


# comparison ---------------------------------------------------------------------------------------
def share(n: str, of: str) -> Column:
    """``1 + floor(SCALE * (n + 1) / (of + terms))``, exact also where a long would not hold the product."""
    return F.expr(
        f"1 + CASE WHEN {n} < 9000000000 THEN ({SCALE}L * ({n} + 1)) div ({of} + terms) "
        f"ELSE (CAST({SCALE} AS DECIMAL(10,0)) * CAST({n} + 1 AS DECIMAL(19,0))) "
        f"div CAST({of} + terms AS DECIMAL(19,0)) END"
    )


def distance(p: str, q: str) -> Column:
    """``floor((p - q)^2 / q)``; shares are at most ``SCALE + 1``, so squares fit a long."""
    return F.expr(f"(({p} - {q}) * ({p} - {q})) div {q}")


def cells(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """What the terms that two sources share add to their distance, beside what each adds alone.

    For sources a and b with shares p and q of a term, and z and y of a term they lack, this is
    f(p, q) - f(p, y) - f(z, q) + f(z, y).  Only sources that have a term are paired, in matrices of
    ``CELLS`` cells, and each matrix is added up by pairs of sources before it is handed on.
    """

    def f(p: np.ndarray, q: np.ndarray) -> np.ndarray:
        return (p - q) ** 2 // q

    for batch in batches:
        column = batch.column(0)
        offsets, flat = column.offsets.to_numpy(), column.flatten()
        first = int(offsets[0])
        ids, p, z = (flat.field(name).to_numpy() for name in ("gid", "p", "z"))
        names, local = np.unique(ids, return_inverse=True)
        sizes = np.diff(offsets)
        for size in np.unique(sizes[sizes > 1]).tolist():
            rows = np.flatnonzero(sizes == size)
            side = max(1, min(size, CELLS // size))
            many = max(1, CELLS // (size * side))
            for start in range(0, len(rows), many):
                at = offsets[rows[start : start + many]][:, None] - first + np.arange(size)
                for lo in range(0, size, side):
                    part = at[:, lo : lo + side]
                    pa_, za, pb, zb = p[part][:, :, None], z[part][:, :, None], p[at][:, None, :], z[at][:, None, :]
                    add = (f(pa_, pb) - f(pa_, zb) - f(za, pb) + f(za, zb)).ravel()
                    key = (local[part][:, :, None] * len(names) + local[at][:, None, :]).ravel()
                    order = np.argsort(key, kind="stable")
                    key, add = key[order], add[order]
                    heads = np.flatnonzero(np.concatenate([[True], key[1:] != key[:-1]]))
                    pairs = key[heads]
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(names[pairs // len(names)]), pa.array(names[pairs % len(names)]),
                         pa.array(np.add.reduceat(add, heads))], ["a", "b", "value"],
                    )


def audit(
    docs: DataFrame,
    text: str = "text",
    lang: str = "lang",
    source: str = "source",
    least: int = 3,
    top: int = 200,
) -> DataFrame:
    """``lang, source, part, item, value, rank``: distances of sources and the terms that set them apart.

    Terms are runs of ASCII letters and other non-ASCII characters, A-Z in lower case; a language keeps
    the terms in ``least`` of its documents, repeated rows counting each.  Part ``pair`` gives each other
    source of the language with its distance from the source, added up over all kept terms; part ``term``
    the ``top`` terms that the source has more often than the language, in share.  Equal values are ranked
    by the bytes of the item.  Null texts, languages and sources are empty; other columns are ignored; a
    language without kept terms has distances of 0; an empty table gives no rows.

    Absent terms are not stored: all zeros of a source have one share, so a pair's distance is a base for
    zeros on both sides, one sum for each side's own terms (by different shares), and a correction for
    terms that both have.
    """
    rows = docs.select(
        whole(F.col(lang).cast("string")).alias("lang"),
        whole(F.col(source).cast("string")).alias("source"),
        whole(text).cast("binary").alias("body"),
    )
    named = rows.select("lang", "source").distinct()
    named = cut_lineage(named.withColumn("gid", F.monotonically_increasing_id()), "sources")
    partial = partial_counts(rows.join(named, ["lang", "source"]).select("lang", "gid", "body"), least)
    counted = kept_terms(partial, least)
    discard(partial)
    langs = counted.groupBy("lang").agg(F.count_if("first").alias("terms"), F.sum("n").alias("of_lang"))
    sizes = counted.groupBy("gid").agg(F.sum("n").alias("of"))
    groups = named.join(sizes, "gid", "left").join(langs, "lang", "left").fillna(0, ["of", "terms", "of_lang"])
    zero = F.when(F.col("terms") > 0, F.expr(f"1 + {SCALE}L div (of + terms)"))
    groups = cut_lineage(groups.withColumn("z", zero), "groups")
    discard(named)

    shares = counted.join(groups.drop("lang"), "gid").select(
        "lang", "source", "term", "gid", "z", share("n", "of").alias("p"), share("total", "of_lang").alias("q")
    )
    order = Window.partitionBy("lang", "source").orderBy(F.desc("value"), "item")
    more = shares.where("p > q").select("lang", "source", F.col("term").alias("item"), distance("p", "q").alias("value"))
    more = more.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= top)

    a = groups.select("lang", "terms", F.col("gid").alias("a"), F.col("z").alias("az"))
    b = groups.select("lang", F.col("gid").alias("b"), F.col("z").alias("bz"))
    both = a.join(b, "lang").where("a <> b").select("a", "b", F.coalesce(F.col("terms") * distance("az", "bz"), F.lit(0)))
    alone = shares.groupBy("lang", "gid", "z", "p").agg(F.count("*").alias("m"))
    alone = alone.join(b, "lang").where("gid <> b")
    parts = F.array(
        F.struct(F.col("gid").alias("a"), F.col("b"), (F.col("m") * (distance("p", "bz") - distance("z", "bz"))).alias("value")),
        F.struct(F.col("b").alias("a"), F.col("gid").alias("b"), (F.col("m") * (distance("bz", "p") - distance("bz", "z"))).alias("value")),
    )
    alone = alone.select(F.inline(parts))
    held = shares.groupBy("lang", "term").agg(F.collect_list(F.struct("gid", "p", "z")).alias("held"))
    shared = held.where(F.size("held") > 1).select("held").mapInArrow(cells, "a BIGINT, b BIGINT, value BIGINT")
    summed = both.union(alone).union(shared.where("a <> b")).toDF("a", "b", "value")
    summed = summed.groupBy("a", "b").agg(F.sum("value").alias("value"))
    one = groups.select("lang", "source", F.col("gid").alias("a"))
    other = groups.select(F.col("source").alias("item"), F.col("gid").alias("b"))
    pairs = summed.join(one, "a").join(other, "b").select("lang", "source", "item", "value")
    pairs = pairs.withColumn("rank", F.row_number().over(order))
    columns = ["lang", "source", "part", "item", "value", F.col("rank").cast("int").alias("rank")]
    return (
        pairs.withColumn("part", F.lit("pair")).select(*columns)
        .unionByName(more.withColumn("part", F.lit("term")).select(*columns))
    )
