"""Facts about hashed keys, asked by groups of documents and answered by buckets of keys.

Documents are dealt into groups of a few megabytes.  A group reduces its keys to a sorted set, so a key
that a third of all documents have is sent once per group.  Buckets are equal ranges of the hash space;
each learns the keys of all groups that fall into its range and answers each group in the order asked.
Only hashes travel, eight or sixteen bytes for each key of a group, and answers travel back as arrays.
A group asks a bucket with one row at most, and never with more rows than it has keys.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pixelquery.llm.text import whole, word_hashes

GROUP_BYTES = 8 << 20
#: Groups whose keys one bucket holds on average, whatever the number of both.
BUCKET_SHARE = 4
ASK = "g INT, bucket INT, keys BINARY, weights BINARY"
ASK_SCHEMA = pa.schema(
    [("g", pa.int32()), ("bucket", pa.int32()), ("keys", pa.binary()), ("weights", pa.binary())]
)


def dealt(docs: DataFrame, doc_id: str, text: str) -> tuple[DataFrame, int, int]:
    """``g, doc_id, text`` of every row, moved once to its group; the numbers of groups and of buckets.

    All passes read this one exchange.  The group follows from id and text alone, so a task that runs
    again has the same groups.
    """
    rows = docs.select(F.col(doc_id).alias("doc_id"), whole(text).alias("text"))
    size = rows.agg(F.sum(F.octet_length("text").cast("long"))).first()[0] or 0
    n = max(1, math.ceil(size / GROUP_BYTES))
    group = F.pmod(F.xxhash64("doc_id", "text"), F.lit(n)).cast("int")
    return rows.select(group.alias("g"), "doc_id", "text").repartition(n, "g"), n, max(1, math.ceil(n / BUCKET_SHARE))


def with_hashes(groups: DataFrame, text) -> DataFrame:
    """Add the word hashes behind the exchange, so that texts move instead."""
    return groups.withColumn("hashes", word_hashes(text))


def flat(column: pa.ChunkedArray) -> tuple[np.ndarray, np.ndarray]:
    """All word hashes of a group in one array, and where each document starts (and the last ends)."""
    parts = [chunk for chunk in column.chunks if len(chunk)]
    if not parts:
        return np.empty(0, np.uint64), np.zeros(1, np.int64)
    lengths = np.concatenate([np.diff(p.offsets.to_numpy()) for p in parts]).astype(np.int64)
    values = np.concatenate([p.flatten().to_numpy(zero_copy_only=False) for p in parts])
    return values.view(np.uint64), np.concatenate([[0], np.cumsum(lengths)])


def _starts(n_buckets: int) -> np.ndarray:
    width = math.ceil(2**64 / n_buckets)
    return np.array([width * b for b in range(1, n_buckets)], np.uint64)


def bucket_of(keys: np.ndarray, n_buckets: int) -> np.ndarray:
    return np.searchsorted(_starts(n_buckets), keys, side="right").astype(np.int32)


def borders(keys: np.ndarray, n_buckets: int) -> np.ndarray:
    """Places in sorted keys where each bucket's range starts, and the end."""
    return np.concatenate([[0], np.searchsorted(keys, _starts(n_buckets)), [len(keys)]])


def asked(g: int, keys: np.ndarray, n_buckets: int, *more: np.ndarray) -> pa.Table:
    """Rows of ``ASK``: sorted keys by bucket; ``more`` are arrays beside the keys, weights last.

    With one array more, it is the weights; with two, the first is the second half of each key.
    """
    at = borders(keys, n_buckets)
    held = np.flatnonzero(np.diff(at))
    halves = [keys, *more[:-1]]
    body = [b"".join(h[at[b] : at[b + 1]].tobytes() for h in halves) for b in held]
    weights = [more[-1][at[b] : at[b + 1]].tobytes() for b in held]
    return pa.table(
        [pa.array([g] * len(held), pa.int32()), pa.array(held, pa.int32()), pa.array(body, pa.binary()),
         pa.array(weights, pa.binary())], schema=ASK_SCHEMA,
    )


def answers_of(table: pa.Table, column: str, dtype: str) -> list[np.ndarray]:
    """The arrays of one column of a group's answers, by bucket, which is the order of the keys."""
    order = np.argsort(table.column("bucket").to_numpy())
    values = table.column(column).to_pylist()
    return [np.frombuffer(values[i], dtype) for i in order]
