"""Language-model score: the probability of a text over all its segmentations into vocabulary pieces."""

from __future__ import annotations

import math
from collections.abc import Iterable, Iterator
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import public_tokenizers
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pixelquery.llm.exchange import ASK, answers_of, asked, bucket_of, dealt, flat, with_hashes
from pixelquery.llm.text import remainder, whole, words
from pixelquery.session import cut_lineage

VOCABULARY = "piece_bpe_32k.model"
WORD_START = "▁"
SMOOTHING = 0.1
_FACTOR = 0x9E3779B97F4A7C15
RESULT = "doc_id BIGINT, n_tokens BIGINT, n_known BIGINT, base_score DOUBLE, score DOUBLE"


def lowered(text: Column) -> Column:
    """A-Z in lower case; all other characters as they are."""
    return F.translate(text, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


@lru_cache(1)
def processor():
    import sentencepiece

    return sentencepiece.SentencePieceProcessor(model_file=public_tokenizers.path(VOCABULARY))


def _powers(n: int) -> np.ndarray:
    return np.array([pow(_FACTOR, i, 2**64) for i in range(n)], np.uint64)


def _mix(x: np.ndarray) -> np.ndarray:
    with np.errstate(over="ignore"):
        x = (x ^ (x >> np.uint64(31))) * np.uint64(0xBF58476D1CE4E5B9)
        return (x ^ (x >> np.uint64(29))) * np.uint64(0x94D049BB133111EB)


def _code_points(texts: list[str]) -> np.ndarray:
    """Equally long texts as a matrix of code points."""
    return np.frombuffer("".join(texts).encode("utf-32-le", "surrogatepass"), "<u4").reshape(len(texts), -1)


@dataclass
class Lattice:
    """Pieces by hash with their natural log probabilities, and the spelling of any other character."""

    hashes: np.ndarray
    log_p: np.ndarray
    longest: int
    singles: dict[int, float]
    byte_log_p: np.ndarray

    @staticmethod
    def of(probabilities: np.ndarray) -> Lattice:
        """From one probability for each id of the vocabulary."""
        sp = processor()
        pieces, values, spelled = [], [], np.full(256, -np.inf)
        for i in range(sp.get_piece_size()):
            if sp.is_byte(i):
                spelled[int(sp.id_to_piece(i)[3:5], 16)] = math.log(probabilities[i])
            elif not (sp.is_control(i) or sp.is_unknown(i) or sp.is_unused(i)):
                pieces.append(sp.id_to_piece(i))
                values.append(math.log(probabilities[i]))
        sums = [np.uint64(0)] * len(pieces)
        by_length: dict[int, list[int]] = {}
        for i, piece in enumerate(pieces):
            by_length.setdefault(len(piece), []).append(i)
        up = _powers(max(by_length))
        for n, which in by_length.items():
            chars = _mix(_code_points([pieces[i] for i in which]).astype(np.uint64))
            with np.errstate(over="ignore"):
                for i, value in zip(which, (chars * up[:n]).sum(1, dtype=np.uint64)):
                    sums[i] = value
        order = np.argsort(np.array(sums, np.uint64))
        singles = {ord(pieces[i]): values[i] for i in by_length.get(1, [])}
        return Lattice(np.array(sums, np.uint64)[order], np.array(values)[order], max(by_length), singles, spelled)

    def spelling(self, code: int) -> float:
        """Log probability of a character that is no piece: of its UTF-8 bytes."""
        return float(sum(self.byte_log_p[b] for b in chr(code).encode("utf-8", "surrogatepass")))

    def log_probability(self, listed: list[str]) -> np.ndarray:
        """Natural log of the summed probability of all segmentations, for each word.

        Forward recursion over the characters, for all words of a length at once: what ends at a
        character is the sum, over the pieces that end there, of the piece times what ends where it
        starts.
        """
        out = np.empty(len(listed))
        lengths = np.array([len(w) + 1 for w in listed], np.int64)
        for n in np.unique(lengths):
            which = np.flatnonzero(lengths == n)
            for part in np.array_split(which, -(-len(which) * int(n) // 2_000_000)):
                out[part] = self._forward([WORD_START + listed[i] for i in part], int(n))
        return out

    def _forward(self, texts: list[str], n: int) -> np.ndarray:
        codes = _code_points(texts)
        mixed = _mix(codes.astype(np.uint64))
        ends = np.full((n + 1, len(texts)), -np.inf)
        ends[0] = 0.0
        for j in range(1, n + 1):
            column = codes[:, j - 1]
            found, back = np.unique(column, return_inverse=True)
            spelled = np.array([-np.inf if int(c) in self.singles else self.spelling(int(c)) for c in found])
            total = ends[j - 1] + spelled[back]
            value = np.zeros(len(texts), np.uint64)
            for i in range(j - 1, max(-1, j - 1 - self.longest), -1):
                with np.errstate(over="ignore"):
                    value = value * np.uint64(_FACTOR) + mixed[:, i]
                at = np.minimum(np.searchsorted(self.hashes, value), len(self.hashes) - 1)
                piece = np.where(self.hashes[at] == value, self.log_p[at], -np.inf)
                if np.isfinite(piece).any():
                    total = np.logaddexp(total, ends[i] + piece)
            ends[j] = total
        return ends[n]


def word_counts(docs: DataFrame, text: Column, training: Column) -> DataFrame:
    """The stored table of all different words with ``n``, their number in training documents.

    Counted in the tasks first, so a word that every document has is one row for each task.
    """
    rows = docs.select(training.cast("long").alias("training"), F.explode(words(text)).alias("word"))
    return cut_lineage(rows.groupBy("word").agg(F.sum("training").alias("n")), "words")


def piece_counts(counts: DataFrame) -> np.ndarray:
    """How often each piece of the vocabulary stands in the training words, as the vocabulary cuts them."""

    def pieces(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(processor().get_piece_size(), np.int64)
        for batch in batches:
            ids = processor().encode(batch.column("word").to_pylist(), num_threads=1)
            lengths = np.array([len(x) for x in ids], np.int64)
            joined = np.fromiter((i for x in ids for i in x), np.int64, int(lengths.sum()))
            weights = np.repeat(batch.column("n").to_numpy(), lengths)
            np.add.at(total, joined, weights)
        held = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(held, pa.int32()), pa.array(total[held])], ["piece", "n"])

    rows = counts.where("n > 0").mapInArrow(pieces, "piece INT, n BIGINT").groupBy("piece").agg(F.sum("n").alias("n"))
    total = np.zeros(processor().get_piece_size(), np.float64)
    for piece, n in rows.collect():
        total[piece] = n
    return total


def score(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", folds: int = 10) -> DataFrame:
    """``doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score`` of every row.

    Texts are scored whole, A-Z in lower case: words, then one end token.  Documents that aren't held
    out (whose id's crc32 leaves 0 modulo ``folds``) train the model.

    ``base_score`` is the log10 probability under smoothed word frequencies.  ``score`` is the log10
    probability under a unigram model over the pieces of a public vocabulary: piece probabilities come
    from the training words as the vocabulary cuts them (with add-0.1 smoothing, the end token counted
    as a piece), and a word's probability is the sum over all segmentations, each the product of its
    pieces.  Pieces don't span words, so a text's probability is the product of its words' and the
    end's.  A character that is no piece is spelled by its bytes.

    The lattice is run once for each different word.  Documents, in groups, then ask for the counts and
    scores of their different words by hash; the text itself moves once.  Null texts are empty: their
    only token is the end.  A null id is in training.  Repeated rows stay and count as often as they
    stand; other columns don't matter.  An empty table gives no rows; with no training document all
    probabilities come from smoothing.
    """
    out = F.coalesce(remainder(doc_id, folds) == 0, F.lit(False))
    low = lowered(whole(text))
    counts = word_counts(docs, low, ~out)
    ends = docs.agg(F.sum((~out).cast("long"))).first()[0] or 0
    known = counts.where("n > 0").agg(F.count("*"), F.sum("n")).first()
    train_tokens = (known[1] or 0) + ends
    kinds = known[0] + (ends > 0)
    scale = train_tokens + SMOOTHING * (kinds + 1)
    per_piece = piece_counts(counts)
    all_pieces = per_piece.sum() + ends + SMOOTHING * (len(per_piece) + 1)
    spark = docs.sparkSession
    model = spark.sparkContext.broadcast(Lattice.of((per_piece + SMOOTHING) / all_pieces))
    end_base = math.log10((ends + SMOOTHING) / scale)
    end_score = math.log10((ends + SMOOTHING) / all_pieces)

    groups, n_groups, n_buckets = dealt(docs, doc_id, text)
    hashed = with_hashes(groups.select("g", F.col("doc_id").cast("long"), lowered(F.col("text")).alias("text")), "text")
    hashed = hashed.drop("text")

    def lattice_scores(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                value = model.value.log_probability(batch.column("word").to_pylist()) / math.log(10)
                bucket = bucket_of(batch.column("hash").to_numpy().view(np.uint64), n_buckets)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(bucket), batch.column("hash"), batch.column("n"), pa.array(value)],
                    ["bucket", "hash", "n", "value"],
                )

    hashes = counts.select("word", F.xxhash64("word").alias("hash"), F.col("n").cast("long"))
    valued = hashes.mapInArrow(lattice_scores, "bucket INT, hash BIGINT, n BIGINT, value DOUBLE")

    def word_keys(key, table):
        keys = np.unique(flat(table.column("hashes"))[0])
        return asked(key[0].as_py(), keys, n_buckets, np.empty(0, np.uint8))

    def answer(table, facts):
        hashes = facts.column("hash").to_numpy().view(np.uint64)
        order = np.argsort(hashes)
        hashes = hashes[order]
        n, value = facts.column("n").to_numpy()[order], facts.column("value").to_numpy()[order]
        told = [np.searchsorted(hashes, np.frombuffer(k, np.uint64)) for k in table.column("keys").to_pylist()]
        return pa.table(
            {
                "g": table.column("g"),
                "bucket": table.column("bucket"),
                "keys": pa.array([n[at].tobytes() for at in told], pa.binary()),
                "weights": pa.array([value[at].tobytes() for at in told], pa.binary()),
            }
        )

    def totals(table, told):
        listed, starts = flat(table.column("hashes"))
        keys = np.unique(listed)
        n = np.concatenate([np.empty(0, np.int64), *answers_of(told, "keys", np.int64)])
        value = np.concatenate([np.empty(0), *answers_of(told, "weights", np.float64)])
        at = np.searchsorted(keys, listed)
        base = np.log10((n + SMOOTHING) / scale)

        def sums(x: np.ndarray) -> np.ndarray:
            padded = np.append(x[at], 0.0)
            return np.where(np.diff(starts) > 0, np.add.reduceat(padded, starts[:-1]), 0.0)

        return pa.table(
            {
                "doc_id": table.column("doc_id"),
                "n_tokens": pa.array(np.diff(starts) + 1, pa.int64()),
                "n_known": pa.array(sums(n > 0).astype(np.int64) + int(ends > 0), pa.int64()),
                "base_score": pa.array(sums(base) + end_base),
                "score": pa.array(sums(value) + end_score),
            }
        )

    asks = hashed.groupBy("g").applyInArrow(word_keys, ASK).repartition(n_buckets, "bucket")
    facts = valued.repartition(n_buckets, "bucket")
    told = asks.groupBy("bucket").cogroup(facts.groupBy("bucket")).applyInArrow(answer, ASK)
    told = told.repartition(n_groups, "g")
    scores = hashed.groupBy("g").cogroup(told.groupBy("g")).applyInArrow(totals, RESULT)
    return scores.select(
        "doc_id",
        F.coalesce(remainder("doc_id", folds) == 0, F.lit(False)).alias("held_out"),
        "n_tokens",
        "n_known",
        F.lit(train_tokens).cast("long").alias("train_tokens"),
        "base_score",
        "score",
    )
