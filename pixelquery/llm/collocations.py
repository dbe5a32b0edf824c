"""Phrases of a language that occur together, counted by dynamic itemset counting over shards.

Texts are coded once into blocks of some million words, dealt over shards.  Each step scans the next shard,
round after round.  A step counts words, and at once all longer phrases that are active: both subphrases
(without the last and without the first word) had reached the threshold when an earlier step ended.  An
active phrase is counted for one full cycle of shards, wherever it starts, so its count is exact when the
cycle closes.  A phrase of k words is complete after k cycles at most, often sooner.

Counts are kept by buckets of phrases.  In each step a block asks a bucket once, with all its phrases and
their counts there; the bucket adds the counts up and answers with the numbers of those phrases that had
reached the threshold.  Phrases longer than a word are known by the numbers of their two subphrases, so no
two are taken for one; words are known by 128-bit hashes.
"""

from __future__ import annotations

from array import array
from collections import defaultdict
from collections.abc import Callable, Iterable, Iterator
from functools import reduce
from itertools import count

import numpy as np
import pyarrow as pa
import xxhash
import zstandard
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from pixelquery.llm.text import whole
from pixelquery.session import cut_lineage, discard

#: A-Z in lower case, ends of pieces to line feeds, tabs to spaces.
FOLD = bytes(
    b + 32 if 65 <= b <= 90 else 10 if b in b".,;:!?\n\x0b\x0c\r" else 32 if b == 9 else b for b in range(256)
)
#: Words of a block, each some 100 bytes of a worker while pairs are counted; a piece is never cut, so a block
#: may be longer by one piece.
BLOCK_WORDS = 1 << 20
#: Words that a scanning task holds in open blocks of all languages.
OPEN_WORDS = 3 << 19
#: Blocks whose phrases one bucket holds on average, whatever the number of both; of phrases of three words and
#: more, which are far fewer, it holds ``SPARSE`` times as many.
BUCKET_SHARE, SPARSE = 8, 8
#: Blocks that one task brings together with their answers, one after the other.
PLACE_SHARE = 4
ROW = (
    "kind STRING, g BIGINT, at INT, bucket INT, lang STRING, words BINARY, codes BINARY, first BINARY, second BINARY, "
    "n BINARY, since BINARY, ids BINARY, steps BINARY"
)
_FIELDS = pa.schema(
    [("kind", pa.string()), ("g", pa.int64()), ("at", pa.int32()), ("bucket", pa.int32()), ("lang", pa.string())]
    + [(c, pa.binary()) for c in ("words", "codes", "first", "second", "n", "since", "ids", "steps")]
)


def pack(values: np.ndarray) -> bytes:
    """The bytes of an array, those of equal place in the numbers side by side, compressed."""
    return zstandard.compress(np.ascontiguousarray(values).view(np.uint8).reshape(-1, values.itemsize).T.tobytes(), 1)


def unpack(body: bytes, kind: type) -> np.ndarray:
    flat = np.frombuffer(zstandard.decompress(body), np.uint8)
    return np.ascontiguousarray(flat.reshape(np.dtype(kind).itemsize, -1).T).view(kind).ravel()


def pack_words(words: Iterable[bytes]) -> bytes:
    """Words, none of which has a line feed or is empty."""
    return zstandard.compress(b"\n".join(words), 1)


def unpack_words(body: bytes) -> list[bytes]:
    return zstandard.decompress(body).split()


def _batch(rows: list[dict]) -> pa.RecordBatch:
    return pa.RecordBatch.from_pylist(rows, _FIELDS)


# blocks -------------------------------------------------------------------------------------------
def blocks(docs: DataFrame, shards: int) -> DataFrame:
    """The stored blocks of ``docs`` (``lang, body``, none null): ``shard`` and the columns of ``ROW``.

    ``codes`` has a number for each word in order, its place in ``words`` from 1, and 0 after each piece.
    ``n`` is empty here; the words of a block are the codes above 0.
    """

    def rows(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        open_: dict[str, tuple[defaultdict, array]] = {}
        number, held = TaskContext.get().partitionId() << 24, 0

        def closed(lang: str) -> pa.RecordBatch:
            nonlocal number, held
            words, codes = open_.pop(lang)
            held -= len(codes)
            number += 1
            row = {"kind": "block", "g": number, "lang": lang, "words": pack_words(words)}
            return _batch([row | {"codes": pack(np.array(codes, np.int32))}])

        for batch in batches:
            for lang, body in zip(batch.column("lang").to_pylist(), batch.column("body")):
                for piece in body.as_py().translate(FOLD).split(b"\n"):
                    found = piece.split()
                    if not found:
                        continue
                    if lang not in open_:
                        open_[lang] = defaultdict(count(1).__next__), array("i")
                    words, codes = open_[lang]
                    codes.extend(map(words.__getitem__, found))
                    codes.append(0)
                    held += len(found) + 1
                    if len(codes) >= BLOCK_WORDS:
                        yield closed(lang)
                    while held >= OPEN_WORDS:
                        yield closed(max(open_, key=lambda name: len(open_[name][1])))
        for lang in list(open_):
            yield closed(lang)

    coded = docs.mapInArrow(rows, ROW)
    shard = F.pmod(F.shiftright("g", 24) + F.col("g") % (1 << 24), F.lit(shards)).cast("int")
    return cut_lineage(coded.withColumn("shard", shard), "blocks")


def words_of(stored: DataFrame) -> DataFrame:
    """``lang, n``: the words of each language."""

    def rows(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            n = [int(np.count_nonzero(unpack(c, np.int32))) for c in batch.column("codes").to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column("lang"), pa.array(n, pa.int64())], ["lang", "n"])

    counts = stored.select("lang", "codes").mapInArrow(rows, "lang STRING, n BIGINT")
    return counts.groupBy("lang").agg(F.sum("n").alias("n"))


# one exchange -------------------------------------------------------------------------------------
def candidates(block: dict, level: int) -> tuple[np.ndarray, ...]:
    """Different phrases of ``level`` words in a block whose subphrases are known there.

    Both keys, the step since which they count, the number of each, and where they start (with the place
    of the phrase among the different ones).
    """
    codes = unpack(block["codes"], np.int32)
    if level == 1:
        digest, seed = xxhash.xxh128_digest, xxhash.xxh64_intdigest(block["lang"])
        digests = b"".join([digest(word, seed) for word in unpack_words(block["words"])])
        keys = np.ascontiguousarray(np.frombuffer(digests, np.int64).reshape(-1, 2).T)
        where = np.flatnonzero(codes)
        numbers = np.bincount(codes, minlength=len(keys[0]) + 1)[1:]
        return keys[0], keys[1], np.zeros(len(keys[0]), np.int32), numbers, where, codes[where] - 1
    ids, steps = unpack(block["ids"], np.int64), unpack(block["steps"], np.int32)
    left, right = codes[:-1], codes[1:]
    where = np.flatnonzero((left > 0) & (right > 0))
    pairs = left[where].astype(np.int64) << 32 | right[where]
    pairs, inverse, numbers = np.unique(pairs, return_inverse=True, return_counts=True)
    a, b = (pairs >> 32) - 1, (pairs & 0xFFFFFFFF) - 1
    since = np.maximum(steps[a], steps[b]) + 1
    return ids[a], ids[b], since.astype(np.int32), numbers, where, inverse


def mixed(first: np.ndarray, second: np.ndarray) -> np.ndarray:
    """64 bits of both keys."""
    both = first.view(np.uint64) * np.uint64(0x9E3779B97F4A7C15) ^ second.view(np.uint64) * np.uint64(0xC2B2AE3D27D4EB4F)
    return (both ^ both >> np.uint64(29)) * np.uint64(0xBF58476D1CE4E5B9)


def bucketed(first: np.ndarray, second: np.ndarray, n_buckets: int) -> tuple[np.ndarray, np.ndarray]:
    """The bucket of each phrase, and the order of phrases by bucket, else as they are."""
    bucket = (mixed(first, second) >> np.uint64(32)) * np.uint64(n_buckets) >> np.uint64(32)
    bucket = bucket.astype(np.uint16 if n_buckets <= 1 << 16 else np.int32)
    return bucket, np.argsort(bucket, kind="stable")


def grouped(first: np.ndarray, second: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """An order that brings equal phrases together, and where a new one starts in it."""
    both = mixed(first, second)
    order = np.argsort(both)
    f, s, both = first[order], second[order], both[order]
    head = np.ones(len(order), bool)
    head[1:] = (f[1:] != f[:-1]) | (s[1:] != s[:-1])
    if (head[1:] & (both[1:] == both[:-1])).any():  # different phrases with the same 64 bits
        order = np.lexsort((second, first))
        f, s = first[order], second[order]
        head[1:] = (f[1:] != f[:-1]) | (s[1:] != s[:-1])
    return order, head


def asking(level: int, step: int, shards: int, n_buckets: int, last: bool) -> Callable:
    """A block's phrases by bucket (``at``), with their counts if they are active; of the ``last`` level only those."""

    def rows(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for block in batch.to_pylist():
                first, second, since, numbers, *_ = candidates(block, level)
                active = (since <= step) & (step < since + shards)
                numbers = np.where(active, numbers, 0)
                if last:
                    first, second, since, numbers = (x[active] for x in (first, second, since, numbers))
                bucket, order = bucketed(first, second, n_buckets)
                cuts = np.searchsorted(bucket[order], np.arange(n_buckets + 1))
                out = []
                for b in np.flatnonzero(np.diff(cuts)).tolist():
                    of = order[cuts[b] : cuts[b + 1]]
                    row = {"kind": "ask", "g": block["g"], "at": b, "first": pack(first[of]), "second": pack(second[of])}
                    out.append(row | {"n": pack(numbers[of].astype(np.int64)), "since": pack(since[of])})
                if out:
                    yield _batch(out)

    return rows


def counting(level: int, step: int, shards: int, least: int) -> Callable:
    """A bucket's phrases after a step, and its answers to the blocks from before the step.

    The one partition that this reads is one bucket.  ``g`` of the new state says how many phrases have
    reached ``least`` in this step.  Phrases whose cycle has closed below ``least`` are forgotten.
    """

    def rows(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        asks, state = [], None
        for batch in batches:
            for row in batch.to_pylist():
                if row["kind"] == "ask":
                    asks.append(row)
                else:
                    state = row
        if not asks and state is None:
            return
        at = asks[0]["at"] if asks else state["at"]
        known = [state] if state else []
        held = len(unpack(state["ids"], np.int64)) if state else 0
        first, second, numbers = (
            np.concatenate([unpack(row[c], np.int64) for row in known + asks]) for c in ("first", "second", "n")
        )
        since = np.concatenate([unpack(row["since"], np.int32) for row in known + asks])
        sizes = [len(unpack(row["first"], np.int64)) for row in asks]
        order, head = grouped(first, second)
        key = np.empty(len(order), np.int64)
        key[order] = np.cumsum(head) - 1
        starts = np.flatnonzero(head)
        total = np.add.reduceat(numbers[order], starts) if len(starts) else numbers[:0]
        first, second, since = (x[order[starts]] for x in (first, second, since))
        ids, steps = np.zeros(len(starts), np.int64), np.zeros(len(starts), np.int32)
        if state:
            ids[key[:held]], steps[key[:held]] = unpack(state["ids"], np.int64), unpack(state["steps"], np.int32)
        out, asked = [], key[held:]
        names = np.zeros(len(asked), np.uint8)  # of each word, the first block that asks gives the name
        if level == 1:
            names[np.unique(asked, return_index=True)[1]] = 1
        cuts = np.cumsum(sizes)[:-1]
        for row, part, name in zip(asks, np.split(asked, cuts), np.split(names, cuts)):
            answer = {"kind": "answer", "g": row["g"], "bucket": at, "first": pack(name)}
            out.append(answer | {"ids": pack(ids[part]), "steps": pack(steps[part])})
        new = np.flatnonzero((total >= least) & (ids == 0))
        ids[new] = (np.int64(at + 1) << 36) + np.count_nonzero(ids) + 1 + np.arange(len(new))
        steps[new] = step
        stays = (total > 0) & ((ids > 0) | (since + shards - 1 > step))
        kept = {"first": first, "second": second, "n": total, "since": since, "ids": ids, "steps": steps}
        row = {"kind": "state", "g": len(new), "at": at} | {c: pack(v[stays]) for c, v in kept.items()}
        yield _batch([*out, row])

    return rows


def advancing(level: int, n_buckets: int) -> Callable:
    """Blocks with the places of known phrases of ``level`` words in place of shorter ones.

    The one partition that this reads is a few blocks with their answers, still packed.  Of words, the names
    that this block gives stay with it.
    """

    def rows(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        answers, held = defaultdict(list), []
        for batch in batches:
            for row in batch.to_pylist():
                if row["kind"] == "answer":
                    answers[row["g"]].append(row)
                else:
                    held.append(row)
        while held:
            row = held.pop()
            mine = sorted(answers.pop(row["g"], []), key=lambda a: a["bucket"])
            if mine:
                yield from advanced(row, mine)

    def advanced(row: dict, mine: list[dict]) -> Iterator[pa.RecordBatch]:
        first, second, _, _, where, inverse = candidates(row, level)
        _, order = bucketed(first, second, n_buckets)
        ids, steps = np.empty(len(order), np.int64), np.empty(len(order), np.int32)
        ids[order] = np.concatenate([unpack(a["ids"], np.int64) for a in mine])
        steps[order] = np.concatenate([unpack(a["steps"], np.int32) for a in mine])
        known = ids > 0
        if not known.any():
            return
        code = (np.cumsum(known) * known).astype(np.int32)
        codes = np.zeros(int(where[-1]) + 1, np.int32)
        codes[where] = code[inverse]
        out = {"kind": "block", "g": row["g"], "at": row["at"], "lang": row["lang"], "codes": pack(codes)}
        out |= {"ids": pack(ids[known]), "steps": pack(steps[known])}
        if level == 1:
            names = np.zeros(len(order), bool)
            names[order] = np.concatenate([unpack(a["first"], np.uint8) for a in mine]) > 0
            names = np.flatnonzero(names & known)
            words = unpack_words(row["words"])
            out |= {"words": pack_words([words[i] for i in names.tolist()]), "first": pack(ids[names])}
        yield _batch([out])

    return rows


# the scans ----------------------------------------------------------------------------------------
def scans(stored: DataFrame, least: int, longest: int, shards: int) -> tuple[list[DataFrame], DataFrame | None]:
    """The buckets' states of each length when all counts are complete, and the blocks of known words.

    In cycle c (from 0) all phrases of c words are complete, so a block's places of these are final: they
    replace the block, and shorter phrases are not looked up again.
    """
    fields = [f.strip().split(" ", 1)[0] for f in ROW.split(", ")]
    sizes = dict(stored.groupBy("shard").count().collect())  # one row for each shard
    dense = max(1, -(-sum(sizes.values()) // BUCKET_SHARE))
    n_places = [max(1, -(-sizes.get(s, 0) // PLACE_SHARE)) for s in range(shards)]
    places = [F.pmod(F.xxhash64("g"), F.lit(n)).cast("int") for n in n_places]
    entering = [
        stored.where(F.col("shard") == s).withColumn("at", places[s]).select(*fields) for s in range(shards)
    ]
    states: list[DataFrame | None] = [None] * longest
    kept: list[DataFrame | None] = [None] * longest  # the tables that hold the states
    known, latest, named = [0] * longest, -1, []
    for step in range(longest * shards):
        cycle, shard = divmod(step, shards)
        rows, passing = entering[shard], []
        for level in range(max(1, cycle), longest + 1):
            k = level - 1
            n_buckets = dense if level < 3 else -(-dense // SPARSE)
            asks = rows.mapInArrow(asking(level, step, shards, n_buckets, level == longest), ROW)
            meet = asks if states[k] is None else asks.unionByName(states[k])
            exchanged = cut_lineage(
                meet.repartitionById(n_buckets, "at").mapInArrow(counting(level, step, shards, least), ROW), "phrases"
            )
            before, old = known[k], kept[k]
            states[k], kept[k] = exchanged.where("kind = 'state'"), exchanged
            new = states[k].agg(F.sum("g")).first()[0] or 0
            known[k] += new
            if new and level < longest:
                latest = step
            if level == longest or not before:
                discard(*([old] if old else []))
                break
            met = rows.unionByName(exchanged.where("kind = 'answer'").withColumn("at", places[shard]))
            rows = cut_lineage(
                met.repartitionById(n_places[shard], "at").mapInArrow(advancing(level, n_buckets), ROW),
                "places",
            )
            discard(*([old] if old else []))
            if level == cycle:
                if level == 1:
                    named.append(rows)
                elif level > 2:  # of the places of words, the names are read at the end
                    discard(entering[shard])
                entering[shard] = rows
            else:
                passing.append(rows)
        discard(*passing)
        if step + 1 >= shards and step >= latest + shards:
            break
    return states, named


def _complete(state: DataFrame) -> DataFrame:
    """``id, first, second, f`` of the phrases that have reached the threshold."""

    def rows(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                columns = [unpack(row[c], np.int64) for c in ("ids", "first", "second", "n")]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(c[columns[0] > 0]) for c in columns], ["id", "first", "second", "f"]
                )

    return state.select("ids", "first", "second", "n").mapInArrow(rows, "id BIGINT, first BIGINT, second BIGINT, f BIGINT")


def _named(tables: list[DataFrame]) -> DataFrame:
    """``id, lang, phrase`` of the known words, each named by one block of each shard that has it."""

    def rows(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                ids = pa.array(unpack(row["first"], np.int64))
                words = pa.array(unpack_words(row["words"]), pa.binary()).cast(pa.string())
                lang = pa.array([row["lang"]] * len(words), pa.string())
                yield pa.RecordBatch.from_arrays([ids, lang, words], ["id", "lang", "phrase"])

    every = reduce(DataFrame.union, [t.select("first", "lang", "words") for t in tables])
    named = every.mapInArrow(rows, "id BIGINT, lang STRING, phrase STRING")
    return named.groupBy("id").agg(F.first("lang").alias("lang"), F.first("phrase").alias("phrase"))


def frequent_phrases(docs: DataFrame, least: int, longest: int, shards: int) -> tuple[DataFrame, DataFrame] | None:
    """The stored ``k, id, lang, phrase, f, first, second`` of all phrases found ``least`` times, and ``lang, n``.

    ``first`` and ``second`` are the ids of the phrase without its last and without its first word.  None
    if no word is found that often.
    """
    stored = blocks(docs, shards)
    states, named = scans(stored, least, longest, shards)
    totals = cut_lineage(words_of(stored), "totals")
    discard(stored)
    if not named:
        discard(*[s for s in states if s is not None])
        return None
    level = _complete(states[0]).join(_named(named), "id").withColumn("last", F.col("phrase"))
    level = cut_lineage(level.select("id", "lang", "phrase", "last", "f", "first", "second"), "level")
    levels = [level]
    for state in states[1:]:
        if state is None:
            break
        starts = levels[-1].select(F.col("id").alias("first"), "lang", "phrase")
        ends = levels[-1].select(F.col("id").alias("second"), "last")
        level = _complete(state).join(starts, "first").join(ends, "second")
        level = level.withColumn("phrase", F.concat_ws(" ", "phrase", "last"))
        levels.append(cut_lineage(level.select("id", "lang", "phrase", "last", "f", "first", "second"), "level"))
    tables = [t.select(F.lit(k + 1).alias("k"), "*").drop("last") for k, t in enumerate(levels)]
    phrases = cut_lineage(reduce(DataFrame.union, tables), "phrases")
    discard(*levels, *named, *[s for s in states if s is not None])
    return phrases, totals


def collocations(
    docs: DataFrame,
    text: str = "text",
    lang: str = "lang",
    least: int = 100,
    longest: int = 5,
    top: int = 2000,
    shards: int = 2,
) -> DataFrame:
    """``lang, rank, phrase, a, l, r, n, score``: the phrases of each language that stick together most.

    Texts are split at ``.,;:!?`` and line ends into pieces, these at spaces and tabs into words, A-Z in
    lower case.  A candidate has 2 to ``longest`` words and is found ``a`` >= ``least`` times, overlaps
    included.  Cut in two, with ``l`` and ``r`` for the parts and ``n`` words in the language, its score is
    ``floor(1000 a n / (l r))``, of the cut with the lowest score, of equal ones the first.  Candidates
    inside a longer one that is found as often are left out.  Equal scores are ranked by ``a``, then by the
    bytes of the phrase.

    A null language is ``und``, a null text is empty; repeated rows count each; other columns are ignored;
    an empty table gives no rows.
    """
    rows = docs.select(
        F.coalesce(F.col(lang).cast("string"), F.lit("und")).alias("lang"), whole(text).cast("binary").alias("body")
    )
    found = frequent_phrases(rows, least, longest, shards)
    fields = "lang STRING, rank BIGINT, phrase STRING, a BIGINT, l BIGINT, r BIGINT, n BIGINT, score BIGINT"
    if found is None:
        return docs.sparkSession.createDataFrame([], fields)
    phrases, totals = found
    # a candidate within a longer one found as often is within one that is longer by one word
    longer = phrases.select((F.col("k") - 1).alias("k"), F.col("f").alias("a"), F.inline(F.array(
        F.struct(F.col("first").alias("id")), F.struct(F.col("second").alias("id")))))
    covered = longer.where("k > 1").groupBy("k", "id").agg(F.max("a").alias("most"))
    longs = phrases.where("k > 1").join(covered, ["k", "id"], "left")
    longs = longs.where("most IS NULL OR 100 * most < 100 * f").select("k", "lang", "phrase", F.col("f").alias("a"))
    words = F.split("phrase", " ")
    cuts = longs.select("*", F.explode(F.expr("sequence(1, k - 1)")).alias("cut")).select(
        "*",
        F.array_join(F.slice(words, F.lit(1), F.col("cut")), " ").alias("left"),
        F.array_join(F.slice(words, F.col("cut") + 1, F.col("k")), " ").alias("right"),
    )
    lefts = phrases.select("lang", F.col("phrase").alias("left"), F.col("f").alias("l"))
    rights = phrases.select("lang", F.col("phrase").alias("right"), F.col("f").alias("r"))
    scored = cuts.join(lefts, ["lang", "left"]).join(rights, ["lang", "right"]).join(totals, "lang")
    exact = F.expr(
        "(CAST(1000 AS DECIMAL(4,0)) * CAST(a AS DECIMAL(16,0)) * CAST(n AS DECIMAL(18,0))) "
        "div (CAST(l AS DECIMAL(18,0)) * CAST(r AS DECIMAL(18,0)))"
    )
    lowest = F.min(F.struct(exact.alias("score"), "cut", "l", "r")).alias("low")
    best = scored.groupBy("lang", "phrase", "a", "n").agg(lowest).select("lang", "phrase", "a", "n", "low.*")
    order = Window.partitionBy("lang").orderBy(F.desc("score"), F.desc("a"), "phrase")
    ranked = best.withColumn("rank", F.row_number().over(order).cast("long")).where(F.col("rank") <= top)
    return ranked.select("lang", "rank", "phrase", "a", "l", "r", "n", "score")
