"""Token totals by source, language and tokenizer, maintained by signed deltas."""

from __future__ import annotations

import uuid
from collections.abc import Iterable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pixelquery.llm.text import n_words, whole
from pixelquery.llm.tokens import encode
from pixelquery.session import cut_lineage

KEYS = ("source", "lang", "tokenizer")
WORDS, BPE = "words-1", "byte_bpe_50k"


def signed(changes: DataFrame) -> DataFrame:
    """Changes to one row per key with ``documents`` and ``tokens`` to add.

    ``changes`` has the keys, ``kind`` and the counts ``old_tokens`` and ``new_tokens``.  An insert adds a
    document and its new count, a delete takes a document and its old count away, a revision adds the
    difference of the counts; any other or a null kind adds nothing.  A null count is 0; null keys are
    keys of their own.
    """
    old, new = (F.coalesce(F.col(c), F.lit(0)).cast("long") for c in ("old_tokens", "new_tokens"))
    kind = F.col("kind")
    documents = F.when(kind == "insert", 1).when(kind == "delete", -1).otherwise(0)
    tokens = F.when(kind == "insert", new).when(kind == "delete", -old).when(kind == "revise", new - old)
    return changes.groupBy(*KEYS).agg(
        F.sum(documents.cast("long")).alias("documents"),
        F.sum(F.coalesce(tokens, F.lit(0))).alias("tokens"),
    )


def committed(spark: SparkSession, root: str) -> DataFrame:
    """``batch, attempt`` of every committed batch under ``root``."""
    return spark.read.schema("batch STRING, attempt STRING").parquet(f"{root}/commits/*")


def commit(changes: DataFrame, root: str, batch: str) -> bool:
    """Add a batch to the rollup under ``root``; whether it was added now.

    A batch that is committed stays as it is, whatever is delivered under its name again.  Each attempt
    writes its sums to a folder of its own, then a marker that names the attempt, in one file.  Sums count
    only through a marker, so an attempt that dies at any point changes no total, and the batch can be
    delivered again.  Two attempts at once may both write sums, but the folder of the marker is made by one
    of them only.  Sums are made in the tasks before they are shuffled, so a source with most of the rows
    is one row for each task; many keys are added up and written in many tasks.
    """
    spark = changes.sparkSession
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(f"{root}/commits/{batch}")
    files = path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    done = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path, "_SUCCESS")
    if files.exists(done):
        return False
    attempt = uuid.uuid4().hex
    signed(changes).write.parquet(f"{root}/deltas/attempt={attempt}")
    if files.exists(done):  # another attempt came first
        return False
    marker = spark.range(1).select(F.lit(batch).alias("batch"), F.lit(attempt).alias("attempt"))
    # a folder without _SUCCESS is of an attempt that died while it wrote the marker
    marker.coalesce(1).write.mode("overwrite").parquet(f"{root}/commits/{batch}")
    return True


def totals(spark: SparkSession, root: str) -> DataFrame:
    """``source, lang, tokenizer, documents, tokens`` over all committed batches; empty keys are left out."""
    fields = "source STRING, lang STRING, tokenizer STRING, documents BIGINT, tokens BIGINT, attempt STRING"
    deltas = spark.read.schema(fields).option("basePath", f"{root}/deltas").parquet(f"{root}/deltas")
    counted = deltas.join(committed(spark, root), "attempt", "left_semi").groupBy(*KEYS)
    sums = counted.agg(F.sum("documents").alias("documents"), F.sum("tokens").alias("tokens"))
    return sums.where("documents <> 0 OR tokens <> 0")


def counted(docs: DataFrame, text: str = "text", source: str = "source", lang: str = "lang") -> DataFrame:
    """The stored table ``source, lang, n_chars, n_words, n_ids`` of every document; a null text counts 0."""

    def rows(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            n = pa.array([len(encode(value.as_py())) for value in batch.column("text")], pa.int64())
            yield pa.RecordBatch.from_arrays(
                [*(batch.column(c) for c in ("source", "lang", "n_chars", "n_words")), n],
                ["source", "lang", "n_chars", "n_words", "n_ids"],
            )

    columns = docs.select(
        F.col(source).cast("string").alias("source"),
        F.col(lang).cast("string").alias("lang"),
        F.length(whole(text)).cast("long").alias("n_chars"),
        n_words(text).alias("n_words"),
        F.col(text).alias("text"),
    )
    fields = "source STRING, lang STRING, n_chars BIGINT, n_words BIGINT, n_ids BIGINT"
    return cut_lineage(columns.mapInArrow(rows, fields), "counted")


def maintain(docs: DataFrame, root: str, restore: bool = False) -> DataFrame:
    """Totals of a corpus after its history of batches (see the steps below), kept under ``root``.

    1. ``load`` inserts every document with its words, and with a quarter of its characters as a
       provisional number of subword tokens;
    2. ``recount`` revises every provisional number to the count of the subword vocabulary;
    3. ``withdraw`` deletes the documents without any word;
    4. with ``restore``, ``return`` inserts them again with their counts, so that the totals are those of
       all documents, also of sources that have no words;
    5. ``load`` is delivered once more and changes nothing.

    Null texts, sources and languages are allowed, rows may repeat, other columns are ignored, and an
    empty table gives no totals.
    """
    counts = counted(docs)
    none = F.lit(None).cast("long")
    guess = F.floor(F.col("n_chars") / 4)

    def changes(kind: str, tokenizer: str, old, new, rows: DataFrame = counts) -> DataFrame:
        return rows.select(
            "source", "lang", F.lit(tokenizer).alias("tokenizer"), F.lit(kind).alias("kind"),
            old.alias("old_tokens"), new.alias("new_tokens"),
        )

    load = changes("insert", WORDS, none, F.col("n_words")).union(changes("insert", BPE, none, guess))
    commit(load, root, "load")
    commit(changes("revise", BPE, guess, F.col("n_ids")), root, "recount")
    empty = counts.where("n_words = 0")
    gone = changes("delete", WORDS, F.col("n_words"), none, empty)
    commit(gone.union(changes("delete", BPE, F.col("n_ids"), none, empty)), root, "withdraw")
    if restore:
        back = changes("insert", WORDS, none, F.col("n_words"), empty)
        commit(back.union(changes("insert", BPE, none, F.col("n_ids"), empty)), root, "return")
    commit(load, root, "load")
    return totals(docs.sparkSession, root)
