"""Words, row keys and stored row tables shared by the operators of this part."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pixelquery.session import cut_lineage

#: Separators of words: space and the five ASCII controls from tab to carriage return.
SPACE = r"[\x20\x09-\x0D]+"
WORD = r"[^\x20\x09-\x0D]+"


def whole(text: Column | str) -> Column:
    """The text, a null one as the empty text."""
    return F.coalesce(F.col(text) if isinstance(text, str) else text, F.lit(""))


def words(text: Column | str) -> Column:
    """All words of a text in order, unchanged; none for a null text."""
    return F.array_remove(F.split(whole(text), SPACE), "")


def word_hashes(text: Column | str) -> Column:
    """64-bit hashes of all words in order."""
    return F.transform(words(text), lambda w: F.xxhash64(w))


def n_words(text: Column | str) -> Column:
    return F.size(words(text)).cast("long")


def fresh(df: DataFrame, name: str) -> str:
    """``name``, underlined until no column of ``df`` has it (names ignore case, as Spark does)."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name = "_" + name
    return name


def keyed(docs: DataFrame, *columns: Column, uid: str = "uid", label: str = "keyed") -> DataFrame:
    """Store ``columns`` of every row with a row number ``uid`` and go on from the stored table.

    Ids may be null or repeated, so rows are told apart by this number alone.  Storing fixes it: a task
    that runs again after a lost executor reads the number instead of drawing another.
    """
    return cut_lineage(docs.select(*columns, F.monotonically_increasing_id().alias(uid)), label)


def remainder(doc_id: Column | str, divisor: int) -> Column:
    """crc32 of the id as text, modulo ``divisor``; null for a null id."""
    column = F.col(doc_id) if isinstance(doc_id, str) else doc_id
    return F.crc32(column.cast("string").cast("binary")) % divisor
