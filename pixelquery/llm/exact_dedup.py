"""Exact duplicates by content-defined chunk recipes."""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from pixelquery.llm.text import SPACE, fresh, keyed, whole
from pixelquery.session import cut_lineage

# A chunk ends behind the first space, 256 characters or more from its start, that follows two printable
# ASCII characters whose codes leave 1 modulo 4; without such a space it ends after 4,096 characters.
_ENDS = "[" + "".join(re.escape(chr(c)) for c in range(33, 127) if c % 4 == 1) + "]"
CHUNK = rf"(?s).{{256,4096}}?{_ENDS}{{2}} |.{{1,4096}}"


def normalised(text: Column | str) -> Column:
    return F.regexp_replace(whole(text), SPACE, " ")


def chunks(text: Column) -> Column:
    """Cut a text where its own content says so; joined together the chunks are the text."""
    return F.regexp_extract_all(text, F.lit(CHUNK), F.lit(0))


def colliding_chunks(docs: DataFrame, text: str) -> DataFrame:
    """Verify chunk hashes: ``hash, chunk, place`` of every chunk that shares its hash with another.

    Equal chunks collapse in the task that cuts them and once more per hash and chunk, so each different
    chunk moves once for each task that has it, whatever the number of its copies.
    """
    cut = docs.select(F.explode(chunks(normalised(text))).alias("chunk"))
    known = cut.select(F.xxhash64("chunk").alias("hash"), "chunk").distinct()
    shared = known.groupBy("hash").agg(F.count("*").alias("n")).where("n > 1").select("hash")
    place = F.row_number().over(W.partitionBy("hash").orderBy("chunk"))
    return known.join(shared, "hash", "left_semi").withColumn("place", place)


def recipes(docs: DataFrame, text: str, uid: str) -> DataFrame:
    """``docs`` with ``recipe``: the ordered identifiers of its chunks, equal for equal texts only.

    An identifier is the chunk's 64-bit hash.  The dictionary of different chunks shows which hashes
    stand for more than one chunk; a text that holds such a chunk gets the chunk's place among them
    appended at its position, so that unequal texts never share a recipe.
    """
    collisions = cut_lineage(colliding_chunks(docs, text), "collisions")
    plain = docs.withColumn("recipe", F.transform(chunks(normalised(text)), lambda c: F.xxhash64(c)))
    if collisions.isEmpty():
        return plain
    at = docs.select(uid, F.posexplode(chunks(normalised(text))).alias("at", "chunk"))
    at = at.withColumn("hash", F.xxhash64("chunk")).join(collisions, ["hash", "chunk"])
    marks = at.groupBy(uid).agg(F.sort_array(F.collect_list(F.struct("at", "place"))).alias("marks"))
    flat = F.flatten(
        F.transform("marks", lambda m: F.array(m["at"].cast("long"), m["place"].cast("long")))
    )
    joined = plain.join(marks, uid, "left")
    return joined.withColumn(
        "recipe", F.when(F.col("marks").isNull(), F.col("recipe")).otherwise(F.concat("recipe", flat))
    ).drop("marks")


def exact_duplicates(
    docs: DataFrame, doc_id: str = "doc_id", text: str = "text", uid: str | None = None
) -> DataFrame:
    """One row per row of ``docs``: ``uid, doc_id, keep_id, group_size, kept, text_sha256``.

    Texts are equal when they are after each run of white space became one space; a null text counts as
    empty, and all empty texts are one group.  The row with the smallest id stays (a null id is larger
    than any other); of repeated rows with that id, one stays.  ``docs`` is read
    twice; ``uid`` names its column of row numbers, else the rows are numbered as they are scanned.
    Other columns are ignored, whatever their names.  An empty table gives an empty result.

    Whole texts are never shuffled: only different chunks are, to verify the identifiers, and the
    recipes, eight bytes for each chunk.  Groups are counted before they are shuffled.
    """
    number = F.col(uid) if uid else F.monotonically_increasing_id()
    docs = docs.select(number.alias("uid"), F.col(doc_id).alias("doc_id"), F.col(text).alias("text"))
    made = recipes(docs, "text", "uid")
    rows = keyed_rows(made)
    first = F.min(F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "uid")).alias("first")
    groups = rows.groupBy("recipe").agg(first, F.count("*").alias("group_size"))
    return rows.join(groups, "recipe").select(
        "uid",
        "doc_id",
        F.col("first.doc_id").alias("keep_id"),
        "group_size",
        (F.col("uid") == F.col("first.uid")).alias("kept"),
        "text_sha256",
    )


def keyed_rows(made: DataFrame) -> DataFrame:
    sha = F.sha2(normalised("text").cast("binary"), 256).alias("text_sha256")
    return cut_lineage(made.select("uid", "doc_id", "recipe", sha), "recipes")


def drop_duplicates(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """The rows of ``docs`` that stay, with all their columns (see ``exact_duplicates``)."""
    uid = fresh(docs, "uid")
    stored = keyed(docs, *docs.columns, uid=uid, label="documents")
    stays = exact_duplicates(stored, doc_id, text, uid).where("kept").select(F.col("uid").alias(uid))
    return stored.join(stays, uid, "left_semi").select(*docs.columns)
