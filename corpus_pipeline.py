"""A training corpus in five stages, each one operator over all that the stage before kept.

Every stage takes the session, the documents that the stage before kept, and the folder of the tables.
All but the last return the columns of ``documents``; ``run`` stores each stage's rows before the next.

Null texts are empty texts.  The classifier scores them like any other, so they stay or go by their score.
Null ids are kept, and of copies they go first; repeated rows are copies of each other, of which one stays.
The mix takes nothing from texts without words, and packing makes one piece of each text that is left, however
short.  Empty tables give no rows at any stage.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from pixelquery.llm import exact_dedup, jaccard, mixing, packing, quality
from pixelquery.session import cut_lineage, discard

CAPACITY = 2048


def quality_classifier(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier, trained on ``labels``, scores 0.7 or more."""
    return quality.accepted(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"), least=0.7)


def exact_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of equal texts, the one with the smallest id."""
    return exact_dedup.drop_duplicates(docs)


def near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each class of near duplicates, the document with the smallest id."""
    return jaccard.drop_near_duplicates(docs)


def mixing_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Each document as often as the mix of sources takes it."""
    return mixing.mixed_documents(docs)


def packed_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of all documents and their places in training sequences."""
    return packing.pack_documents(docs, capacity=CAPACITY)


STAGES = [
    ("quality classifier", quality_classifier),
    ("exact dedup", exact_copies),
    ("n-gram Jaccard join", near_copies),
    ("mixing sources to target weights", mixing_sources),
    ("best-fit packing", packed_sequences),
]

#: SQL can express neither the classifier nor the tokenizer. tests/llm compares the two dedup stages with brute
#: force on their own input; of the others it checks columns and counts, and tests their operators apart.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, stored = spark.read.parquet(f"{sf_dir}/documents.parquet"), []
    for _, stage in STAGES[:-1]:
        docs = cut_lineage(stage(spark, docs, sf_dir), "pipeline")
        discard(*stored)
        stored = [docs]
    return STAGES[-1][1](spark, docs, sf_dir)
