"""Sources mixed to target weights by systematic sampling."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from pixelquery.llm.ranks import ranked
from pixelquery.llm.text import fresh, keyed, n_words
from pixelquery.session import cut_lineage

WEIGHTS = (5, 2, 1)


def targets(sources: DataFrame, share: float, cap: float) -> DataFrame:
    """``source, source_size, weight`` to ``source, source_size, target``.

    ``share`` times all sizes is divided by weight; no target exceeds ``cap`` times its source, and the
    excess goes to the others by weight.  In the order of cap per weight, a source is full when the
    level that the sources from it on would share reaches its cap; the first that isn't sets the level.
    The table has one row per source, so its running sums stand in one small task.
    """
    order = W.orderBy(F.col("most") / F.col("weight"), F.col("source"))
    before = order.rowsBetween(W.unboundedPreceding, -1)
    rest = order.rowsBetween(W.currentRow, W.unboundedFollowing)
    every = order.rowsBetween(W.unboundedPreceding, W.unboundedFollowing)
    caps = sources.withColumn("most", F.lit(cap) * F.col("source_size"))
    level = (
        F.lit(share) * F.sum("source_size").over(every) - F.coalesce(F.sum("most").over(before), F.lit(0.0))
    ) / F.sum("weight").over(rest)
    levels = caps.withColumn("level", level)
    open_ = F.col("most") > F.col("level") * F.col("weight")
    shared = F.max(F.when(F.col("open"), F.struct(-F.col("most") / F.col("weight"), "level"))).over(every)
    levels = levels.withColumn("open", open_).withColumn("shared", shared["level"])
    target = F.when(F.col("open"), F.least("most", F.col("shared") * F.col("weight"))).otherwise(F.col("most"))
    return levels.select("source", "source_size", target.cast("double").alias("target"))


def weighted_sources(sizes: DataFrame, weights: tuple[int, ...]) -> DataFrame:
    """Total size and weight of each source: weights repeat over the sources by code point, null last."""
    totals = sizes.groupBy("source").agg(F.sum("size").alias("source_size"))
    place = F.row_number().over(W.orderBy(F.col("source").asc_nulls_last())) - 1
    pattern = F.array(*[F.lit(float(w)) for w in weights])
    return totals.withColumn("weight", F.element_at(pattern, (place % len(weights) + 1).cast("int")))


def unit_offset(source: Column, seed: int) -> Column:
    """A number in [0, 1) for a source, the same in every run."""
    digits = F.substring(F.md5(F.concat(F.coalesce(source, F.lit("")), F.lit(f":{seed}")).cast("binary")), 1, 8)
    return F.conv(digits, 16, 10).cast("double") / F.lit(2.0**32)


def mix(
    rows: DataFrame,
    weights: tuple[int, ...] = WEIGHTS,
    share: float = 1.5,
    cap: int = 2,
    seed: int = 7,
) -> DataFrame:
    """``uid, doc_id, source, size`` to the same and ``source_size, target, copies, taken``.

    Every document of a source expects ``target / source_size`` copies.  Within a source, documents are
    ordered by size, then by a seeded digest of the id; expected copies are summed along that order from
    one offset per source, and a copy is made at each integer that the sum crosses.  Neighbours have
    near sizes, so the words taken stay within about one document of the target.  No document gets more
    than ``cap`` copies.  The order is total but for repeated rows, so reruns agree.

    A null source is a source of its own, a null id digests as empty, documents without words and
    sources without any get copies by the same rule but take nothing.  An empty table gives no rows.
    No source is gathered: ranks come from a range sort, and all the sums are rank times the rate.
    ``rows`` must be a stored table, as it is read more than once.
    """
    aims = targets(weighted_sources(rows, weights), share, cap)
    digest = F.md5(F.concat(F.coalesce(F.col("doc_id").cast("string"), F.lit("")), F.lit(f":{seed}")).cast("binary"))
    placed = ranked(rows.withColumn("_draw", digest), ["source"], ["size", "_draw", "doc_id"]).drop("_draw")
    aims = cut_lineage(aims, "targets").withColumnRenamed("source", "_source")
    joined = placed.join(aims, F.col("source").eqNullSafe(F.col("_source"))).drop("_source")
    rate = F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(F.lit(0.0))
    offset = unit_offset(F.col("source"), seed)
    copies = F.floor((F.col("rank") + 1) * rate + offset) - F.floor(F.col("rank") * rate + offset)
    return joined.withColumn("copies", F.least(copies, F.lit(cap)).cast("long")).withColumn(
        "taken", F.col("copies") * F.col("size")
    ).drop("rank")


def measured(docs: DataFrame, doc_id: str, text: str, source: str) -> DataFrame:
    """The stored table of ids, sources and word counts that ``mix`` takes."""
    return keyed(
        docs, F.col(doc_id).alias("doc_id"), F.col(source).alias("source"), n_words(text).alias("size"), label="sizes"
    )


def mixed_documents(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", source: str = "source") -> DataFrame:
    """The mixed corpus: the rows of ``docs``, each as often as the mix takes it."""
    uid = fresh(docs, "uid")
    times = fresh(docs, "copies")
    stored = keyed(docs, *docs.columns, uid=uid, label="documents")
    sizes = cut_lineage(
        stored.select(F.col(uid).alias("uid"), F.col(doc_id).alias("doc_id"), F.col(source).alias("source"), n_words(text).alias("size")),
        "sizes",
    )
    takes = mix(sizes).where("copies > 0").select(F.col("uid").alias(uid), F.col("copies").alias(times))
    return (
        stored.join(takes, uid)
        .withColumn(times, F.explode(F.sequence(F.lit(1).cast("long"), times)))
        .select(*docs.columns)
    )
