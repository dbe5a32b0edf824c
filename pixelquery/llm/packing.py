"""Best-fit packing of tokenised documents into sequences of a fixed length."""

from __future__ import annotations

import zlib
from collections.abc import Iterable, Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pixelquery.llm.ranks import ranked
from pixelquery.llm.tokens import encode
from pixelquery.session import cut_lineage

PIECES = "doc_id BIGINT, piece INT, start BIGINT, length BIGINT, ids_crc32 BIGINT"
RANK_BITS = 44


def cut_points(length: int, capacity: int) -> list[int]:
    """Where the pieces of a document start: all are full but the first."""
    first = (length - 1) % capacity + 1
    return [0, *range(first, length, capacity)]


def tokenised_pieces(docs: DataFrame, doc_id: str, text: str, capacity: int, end: int) -> DataFrame:
    """The stored pieces of all documents, each document's ids followed by ``end``."""

    def rows(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out: list[tuple] = []
            for key, value in zip(batch.column(0).to_pylist(), batch.column(1)):
                ids = np.append(encode(value.as_py()), np.uint32(end)).astype("<u4")
                starts = cut_points(len(ids), capacity)
                for piece, (a, b) in enumerate(zip(starts, [*starts[1:], len(ids)])):
                    out.append((key, piece, a, b - a, zlib.crc32(ids[a:b].tobytes())))
            names = ["doc_id", "piece", "start", "length", "ids_crc32"]
            kinds = [pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64()]
            columns = list(zip(*out)) if out else [()] * 5
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)], names)

    source = docs.select(F.col(doc_id).cast("long"), F.col(text))
    return cut_lineage(source.mapInArrow(rows, PIECES), "pieces")


def best_fit(counts: np.ndarray, capacity: int) -> pd.DataFrame:
    """Where the pieces of each size go: ``size, rank, sequence, offset``, one row per run of ranks.

    ``counts[s]`` pieces have size ``s``.  Sizes fall from the capacity to 1.  In each step the waiting
    pieces of one size meet the smallest gap that holds them (the successor of the size among the open
    gaps): the piece of rank r takes the r-th sequence with that gap, as many as there are of both; what
    is left of each gap is filed anew, and the step is repeated until no piece of the size waits.  New
    sequences are opened only when no gap is large enough.  This is best fit decreasing, done in bulk.

    Sequences with equal gaps are kept as runs of consecutive numbers.  A step splits one run at most, so
    the table depends on the capacity and the different sizes, not on the number of documents.
    """
    gaps: list[list[tuple[int, int]]] = [[] for _ in range(capacity + 1)]
    held = np.zeros(capacity + 1, np.int64)
    opened, plan = 0, []
    for size in range(capacity, 0, -1):
        rank, waiting = 0, int(counts[size]) if size < len(counts) else 0
        while waiting:
            larger = np.flatnonzero(held[size:])
            if not len(larger):
                new = -(-waiting // (capacity // size))
                gaps[capacity].append((opened, new))
                held[capacity] += new
                opened += new
                continue
            gap = size + int(larger[0])
            first, n = gaps[gap].pop()
            took = min(n, waiting)
            if took < n:
                gaps[gap].append((first + took, n - took))
            held[gap] -= took
            plan.append((size, rank, first, capacity - gap))
            if gap > size:
                gaps[gap - size].append((first, took))
                held[gap - size] += took
            rank, waiting = rank + took, waiting - took
    return pd.DataFrame(plan, columns=["size", "rank", "sequence", "offset"], dtype=np.int64)


def packed(pieces: DataFrame, capacity: int) -> DataFrame:
    """``pieces`` (a stored table with ``length`` and an order) with ``sequence_id`` and ``offset``.

    Pieces are range-sorted by size, which ranks them within their size, whatever share of all pieces
    has it.  The driver sees one count per size and makes the table of runs (see ``best_fit``); each
    task places its pieces by looking up size and rank.
    """
    sized = ranked(pieces, ["length"], ["doc_id", "piece", "start"], "rank")
    counts = np.zeros(capacity + 1, np.int64)
    for length, n in pieces.groupBy("length").count().collect():
        counts[length] = n
    plan = best_fit(counts, capacity).sort_values(["size", "rank"])
    runs = pieces.sparkSession.sparkContext.broadcast(
        ((plan["size"].to_numpy() << RANK_BITS) | plan["rank"].to_numpy(), plan["rank"].to_numpy(),
         plan["sequence"].to_numpy(), plan["offset"].to_numpy())
    )

    fields = pieces.columns

    def place(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        keys, ranks, sequences, offsets = runs.value
        for batch in batches:  # only lengths and ranks become numbers here, so ids and nulls stay as they are
            rank, length = (batch.column(c).to_numpy() for c in ("rank", "length"))
            at = np.searchsorted(keys, (length << RANK_BITS) | rank, side="right") - 1
            more = [pa.array(sequences[at] + rank - ranks[at]), pa.array(offsets[at])]
            yield pa.RecordBatch.from_arrays(
                [*(batch.column(c) for c in fields), *more], [*fields, "sequence_id", "offset"]
            )

    return sized.mapInArrow(place, PIECES + ", sequence_id BIGINT, offset BIGINT")


def pack_documents(
    docs: DataFrame, doc_id: str = "doc_id", text: str = "text", capacity: int = 2048, end: int = 0
) -> DataFrame:
    """``doc_id, piece, start, length, ids_crc32, sequence_id, offset`` of every piece of every document.

    A null or empty text is its end id alone.  Longer documents than ``capacity`` tokens are cut into
    full pieces, the first of which may be shorter; others stay whole.  Rows are packed as they come:
    repeated rows and null ids are pieces of their own.  Other columns are ignored.  An empty table
    gives no rows.  Texts are tokenised once, one at a time, and the pieces stored.
    """
    return packed(tokenised_pieces(docs, doc_id, text, capacity, end), capacity)
