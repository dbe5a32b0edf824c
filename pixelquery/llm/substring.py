"""Repeated passages removed by difference-cover anchors."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pixelquery.llm.exchange import (
    ASK,
    ASK_SCHEMA,
    answers_of,
    asked,
    borders,
    dealt,
    flat,
    with_hashes,
)

#: A difference cover: each difference modulo the period is one of two members of the cover.
PERIOD, COVER = 21, (0, 1, 4, 14, 16)
_FACTORS = (0x9E3779B97F4A7C15, 0xD1B54A32D192ED03)
RESULT = "doc_id BIGINT, n_words BIGINT, n_removed BIGINT, kept_text STRING"


def window_hashes(words: np.ndarray, length: int, factor: int) -> np.ndarray:
    """Hash of the ``length`` words from each place on: a polynomial of the word hashes modulo 2**64."""
    n = len(words)
    if n < length:
        return np.empty(0, np.uint64)
    inverse = pow(factor, -1, 2**64)
    with np.errstate(over="ignore"):
        up = np.multiply.accumulate(np.full(n, factor, np.uint64))
        down = np.multiply.accumulate(np.full(n - length + 1, inverse, np.uint64))
        sums = np.concatenate([np.zeros(1, np.uint64), np.cumsum(words * up, dtype=np.uint64)])
        mixed = (sums[length:] - sums[:-length]) * down
        return (mixed ^ (mixed >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9)


def places(starts: np.ndarray, length: int) -> np.ndarray:
    """Whether a window of ``length`` words fits into its document, for each word place but the last."""
    n = int(starts[-1])
    fits = np.zeros(max(0, n - length + 1), bool)
    left = np.repeat(starts[1:], np.diff(starts)) - np.arange(n)
    fits[:] = left[: len(fits)] >= length
    return fits


def anchors(words: np.ndarray, starts: np.ndarray, window: int) -> tuple[np.ndarray, np.ndarray]:
    """Places and hashes of the anchors: short windows at the cover's places of each document.

    Two equal windows of ``window`` words have, at one of ``PERIOD`` shifts, places that are both in the
    cover; the anchor there lies inside both windows.
    """
    length = window - PERIOD + 1
    at = np.flatnonzero(places(starts, length))
    inside = at - np.repeat(starts[:-1], np.diff(starts))[at]
    at = at[np.isin(inside % PERIOD, COVER)]
    return at, window_hashes(words, length, _FACTORS[0])[at]


def candidates(words: np.ndarray, starts: np.ndarray, window: int, shared: np.ndarray) -> tuple[np.ndarray, ...]:
    """Places and both hashes of the whole windows that hold a shared anchor: anchors extended."""
    fits = places(starts, window)
    slack = PERIOD - 1
    marks = np.zeros(len(words) + 1, np.int64)
    np.add.at(marks, np.maximum(shared - slack, 0), 1)
    np.add.at(marks, shared + 1, -1)
    at = np.flatnonzero(fits & (np.cumsum(marks)[: len(fits)] > 0))
    first, second = (window_hashes(words, window, f)[at] for f in _FACTORS)
    return at, first, second


def _sorted_set(first: np.ndarray, second: np.ndarray | None = None):
    """Different keys in order, twice or once in the group (2 or 1), and each place's key number."""
    order = np.argsort(first, kind="stable") if second is None else np.lexsort((second, first))
    a = first[order]
    new = np.ones(len(a), bool)
    new[1:] = a[1:] != a[:-1]
    if second is not None:
        b = second[order]
        new[1:] |= b[1:] != b[:-1]
    number = np.empty(len(a), np.int64)
    number[order] = np.cumsum(new) - 1
    counts = np.minimum(np.bincount(number), 2).astype(np.uint8) if len(a) else np.empty(0, np.uint8)
    return a[new], (None if second is None else b[new]), counts, number


def _verdicts(table: pa.Table, kind: int, keys: np.ndarray, n_buckets: int) -> np.ndarray:
    """For each key of a group, whether it occurs anywhere else."""
    mine = table.filter(pc.equal(table.column("kind"), kind))
    sizes = [n for n in np.diff(borders(keys, n_buckets)) if n]
    bits = answers_of(mine, "keys", "u1")
    parts = [np.unpackbits(b, count=int(n)) for b, n in zip(bits, sizes)]
    return np.concatenate(parts).astype(bool) if parts else np.zeros(0, bool)


def remove_repeats(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", window: int = 35) -> DataFrame:
    """``doc_id, n_words, n_removed, kept_text`` of every row of ``docs``.

    A word goes if a window of ``window`` consecutive words of its document that covers it starts at
    another place too, in this or any other row.  Windows are judged on the whole input.  The kept
    words are joined by one space.

    1. Each group of documents sends the hashes of its anchors; buckets answer which occur elsewhere.
    2. Whole windows around shared anchors are hashed to 128 bits, and buckets answer in the same way.
       That is the exact question, so it settles windows that only look alike at the anchor.
    3. Words under shared windows are removed where the text is.

    A null or empty text has no words; texts shorter than a window are kept; repeated rows remove each
    other's windows, as all places count; null ids and other columns don't matter.  ``window`` must be
    ``PERIOD`` or more.  An empty table gives no rows.
    """
    if window < PERIOD:
        raise ValueError(f"window must be at least {PERIOD}")
    groups, n_groups, n_buckets = dealt(docs, doc_id, text)
    groups = groups.withColumn("doc_id", groups["doc_id"].cast("long"))
    hashed = with_hashes(groups, "text").select("g", "doc_id", "hashes")

    def anchor_keys(key, table):
        words, starts = flat(table.column("hashes"))
        keys, _, counts, _ = _sorted_set(anchors(words, starts, window)[1])
        return asked(key[0].as_py(), keys, n_buckets, counts)

    def shared_places(table: pa.Table, told: pa.Table):
        words, starts = flat(table.column("hashes"))
        at, values = anchors(words, starts, window)
        keys, _, _, number = _sorted_set(values)
        verdict = _verdicts(told, 1, keys, n_buckets)
        return words, starts, at[verdict[number]] if len(at) else at

    def window_keys(key, table, told):
        words, starts, shared = shared_places(table, told)
        _, first, second = candidates(words, starts, window, shared)
        a, b, counts, _ = _sorted_set(first, second)
        return asked(key[0].as_py(), a, n_buckets, b, counts)

    def answer(halves: int):
        def told(table):
            keys = table.column("keys").to_pylist()
            parts = [np.frombuffer(k, np.uint64).reshape(halves, -1) for k in keys]
            weights = np.concatenate([np.frombuffer(w, np.uint8) for w in table.column("weights").to_pylist()])
            joined = np.concatenate(parts, axis=1)
            _, _, _, number = _sorted_set(joined[0], joined[1] if halves == 2 else None)
            elsewhere = (np.bincount(number, weights) >= 2)[number]
            ends = np.cumsum([p.shape[1] for p in parts])
            bits = [np.packbits(x).tobytes() for x in np.split(elsewhere, ends[:-1])]
            return pa.table(
                [table.column("g"), table.column("bucket"), pa.array(bits, pa.binary()),
                 pa.array([b""] * len(bits), pa.binary())], schema=ASK_SCHEMA,
            )

        return told

    def kept_words(table, told):
        words, starts, shared = shared_places(table, told)
        at, first, second = candidates(words, starts, window, shared)
        keys, _, _, number = _sorted_set(first, second)
        verdict = _verdicts(told, 2, keys, n_buckets)
        repeated = at[verdict[number]] if len(at) else at
        marks = np.zeros(len(words) + 1, np.int64)
        np.add.at(marks, repeated, 1)
        np.add.at(marks, repeated + window, -1)
        keep = np.cumsum(marks)[:-1] == 0
        texts, removed = [], []
        for value, a, b in zip(table.column("text"), starts, starts[1:]):
            listed = value.as_buffer().to_pybytes().split()
            stays = keep[a:b]
            removed.append(int(b - a - stays.sum()))
            if removed[-1]:
                listed = [listed[i] for i in np.flatnonzero(stays)]
            texts.append(b" ".join(listed))
        return pa.table(
            {
                "doc_id": table.column("doc_id"),
                "n_words": pa.array(np.diff(starts), pa.int64()),
                "n_removed": pa.array(removed, pa.int64()),
                "kept_text": pa.array(texts, pa.binary()).cast(pa.string()),
            }
        )

    def tagged(told: DataFrame, kind: int) -> DataFrame:
        return told.withColumn("kind", F.lit(kind)).repartition(n_groups, "g")

    shared_anchors = tagged(
        hashed.groupBy("g").applyInArrow(anchor_keys, ASK).repartition(n_buckets, "bucket")
        .groupBy("bucket").applyInArrow(answer(1), ASK), 1,
    )
    shared_windows = tagged(
        hashed.groupBy("g").cogroup(shared_anchors.groupBy("g")).applyInArrow(window_keys, ASK)
        .repartition(n_buckets, "bucket").groupBy("bucket").applyInArrow(answer(2), ASK), 2,
    )
    told = shared_anchors.unionByName(shared_windows)
    whole_rows = with_hashes(groups, "text")
    return whole_rows.groupBy("g").cogroup(told.groupBy("g")).applyInArrow(kept_words, RESULT)
