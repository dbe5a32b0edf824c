"""Quality rules: base counts, then the divergence from language references."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from pixelquery.llm.text import WORD, whole, words
from pixelquery.session import cut_lineage

#: Classes of the character histogram; what none of them holds is a last class.
CLASSES = (r"\p{Ll}", r"\p{Lu}", r"\p{Nd}", r"\s", r"[.,;:?'\"()-]", r"[!#*$%&|<>@/\\=+~^_{}\[\]]")
SYMBOLS = "#*$%&|<>"
WINDOW = 8


def bound(df: DataFrame, **columns: Column) -> DataFrame:
    """Add columns that later steps read as values.

    Higher-order functions evaluate an expression anew at each use; a generator of one row keeps the
    optimizer from merging the steps.
    """
    made = df.select("*", *[c.alias(f"_{n}") for n, c in columns.items()])
    values = F.struct(*[F.col(f"_{n}").alias(n) for n in columns])
    return made.select(*df.columns, F.inline(F.array(values)))


def class_counts(text: Column) -> Column:
    """Code points of a text by class, the rest last; each class is counted as it is taken away."""
    left, counts = text, []
    for pattern in CLASSES:
        rest = F.regexp_replace(left, pattern + "+", "")
        counts.append((F.length(left) - F.length(rest)).cast("double"))
        left = rest
    return F.array(*counts, F.length(left).cast("double"))


def base_counts(docs: DataFrame) -> DataFrame:
    """Add ``n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words`` to rows with ``body, words``.

    A word is repeated when one of its windows of eight words occurs twice or more in the text.  Windows
    are compared by 64-bit hashes within one text: sorted with their positions, equal neighbours are
    repeats, and each repeated position covers eight words less what the next one covers again.
    """
    body, listed, n = F.col("body"), F.col("words"), F.size("words")
    lines = F.filter(F.split(body, "\n"), lambda x: x.rlike(WORD))
    df = docs.select(
        "*",
        n.cast("long").alias("n_words"),
        F.length(F.array_join(listed, "")).cast("long").alias("word_chars"),
        (F.length(body) - F.length(F.translate(body, SYMBOLS, ""))).cast("long").alias("n_symbols"),
    )
    df = bound(df, lines=lines, hashes=F.transform(listed, lambda w: F.xxhash64(w)))
    df = df.withColumn("n_dup_lines", (F.size("lines") - F.size(F.array_distinct("lines"))).cast("long"))
    none = F.array().cast("array<bigint>")
    starts = F.sequence(F.lit(1), n - (WINDOW - 1))
    hashed = F.transform(starts, lambda i: F.xxhash64(F.slice("hashes", i, WINDOW)))
    df = bound(df, windows=F.when(n >= WINDOW, hashed).otherwise(none))
    repeats = F.size(F.array_distinct("windows")) < F.size("windows")
    located = F.sort_array(F.transform("windows", lambda h, i: F.struct(h.alias("h"), i.alias("i"))))
    df = bound(df, located=F.when(repeats, located))

    def repeated(x: Column, k: Column) -> Column:
        same = [F.coalesce(F.get("located", k + d)["h"] == x["h"], F.lit(False)) for d in (-1, 1)]
        return same[0] | same[1]

    at = F.sort_array(F.transform(F.filter("located", repeated), lambda x: x["i"]))
    df = bound(df, at=F.coalesce(at, F.array().cast("array<int>")))
    following = F.concat(F.slice("at", 2, F.greatest(F.size("at"), F.lit(1))), F.array(F.lit(2**31 - 1)))
    covers = F.zip_with("at", following, lambda a, b: F.least(F.lit(WINDOW).cast("long"), b.cast("long") - a))
    total = F.aggregate(covers, F.lit(0).cast("long"), lambda a, b: a + F.coalesce(b, F.lit(0).cast("long")))
    covered = F.when(F.size("at") > 0, total).otherwise(F.lit(0).cast("long"))
    return df.withColumn("n_repeat_words", covered).drop("lines", "hashes", "windows", "located", "at")


def references(docs: DataFrame, text: str, lang: str, common: int, least_words: int) -> DataFrame:
    """One row per language: ``language, q_classes, common, q_words`` over all its documents.

    Counts are made in each task before they are shuffled.  Each task ranks its own words, so that a
    language's commonest are chosen from few candidates of each task.  A language with fewer than
    ``least_words`` words has no reference.
    """
    rows = docs.select(F.coalesce(F.col(lang).cast("string"), F.lit("")).alias("language"), whole(text).alias("body"))
    sums = [F.sum(F.col("c")[i]).alias(f"c{i}") for i in range(len(CLASSES) + 1)]
    classes = bound(rows, c=class_counts(F.col("body"))).groupBy("language").agg(*sums)
    total = sum((F.col(f"c{i}") for i in range(len(CLASSES) + 1)), F.lit(0.0))
    shares = F.array(*[F.col(f"c{i}") / F.greatest(total, F.lit(1.0)) for i in range(len(CLASSES) + 1)])
    counts = rows.select("language", F.explode(words("body")).alias("word")).groupBy("language", "word").count()
    counts = cut_lineage(counts, "word-counts")
    totals = counts.groupBy("language").agg(F.sum("count").alias("n")).where(F.col("n") >= least_words)
    order = W.partitionBy("language").orderBy(F.desc("count"), "word")
    top = counts.withColumn("place", F.row_number().over(order)).where(F.col("place") <= common)
    lists = top.groupBy("language").agg(F.sort_array(F.collect_list(F.struct("place", "word", "count"))).alias("top"))
    shared = F.transform("top", lambda t: t["count"] / F.col("n"))
    rest = F.lit(1.0) - F.aggregate(shared, F.lit(0.0), lambda a, b: a + b)
    words_of = totals.join(lists, "language").select(
        "language", F.col("top.word").alias("common"), F.concat(shared, F.array(rest)).alias("q_words")
    )
    return cut_lineage(
        classes.select("language", shares.alias("q_classes")).join(words_of, "language"), "references"
    )


def js_distance(p: str, q: str) -> Column:
    """Square root of the Jensen-Shannon divergence (base 2) of two histograms of shares."""

    def part(a: Column, b: Column) -> Column:
        return F.when(a > 0, a * F.log2(a / ((a + b) / 2))).otherwise(F.lit(0.0))

    parts = F.zip_with(p, q, lambda a, b: part(a, b) + part(b, a))
    return F.sqrt(F.greatest(F.aggregate(parts, F.lit(0.0), lambda a, b: a + b) / 2, F.lit(0.0)))


def rules(
    docs: DataFrame,
    doc_id: str = "doc_id",
    text: str = "text",
    lang: str = "lang",
    common: int = 24,
    most_class_distance: float = 0.3,
    most_word_distance: float = 0.4,
    least_chars: int = 200,
    least_words: int = 50,
    least_reference: int = 1000,
) -> DataFrame:
    """One row per row of ``docs``: ``doc_id``, the base counts, ``base_failed``, both distances, ``kept``.

    A document fails the base with fewer than 20 words or with more than 30 of 100 words in repeated
    windows.  Another is kept unless its character classes or its common words are too far from all
    text of its language.  Histograms of short texts vary by chance, so each distance counts from
    ``least_chars`` characters or ``least_words`` words on and is null below.  It is null too for a
    language without a reference; documents without a language have one together.

    A null text has no words and fails; repeated rows and null ids stay rows of their own; other columns
    are ignored.  Every row is judged from its own text and its language's reference, so no row is
    shuffled unless the references, one row per language, are too many to be sent to all tasks.
    """
    known = references(docs, text, lang, common, least_reference)
    rows = docs.select(
        F.col(doc_id).alias("doc_id"),
        F.coalesce(F.col(lang).cast("string"), F.lit("")).alias("language"),
        whole(text).alias("body"),
    )
    rows = base_counts(bound(rows, words=words("body")))
    rows = rows.withColumn(
        "base_failed", (F.col("n_words") < 20) | (100 * F.col("n_repeat_words") > 30 * F.col("n_words"))
    )
    rows = rows.join(known, "language", "left")
    long_ = (F.col("n") >= least_chars) & F.col("common").isNotNull() & ~F.col("base_failed")
    worded = (F.col("n_words") >= least_words) & F.col("common").isNotNull() & ~F.col("base_failed")
    rows = bound(
        rows,
        classes=class_counts(F.col("body")),
        hits=F.when(worded, F.filter("words", lambda w: F.array_contains(F.col("common"), w))),
        n=F.length("body"),
    ).drop("body", "words")
    counted = F.transform("common", lambda c: F.size(F.filter("hits", lambda w: w == c)) / F.col("n_words"))
    other = F.array((F.col("n_words") - F.size("hits")) / F.col("n_words"))
    rows = bound(
        rows,
        p_classes=F.when(long_, F.transform("classes", lambda c: c / F.col("n"))),
        p_words=F.when(F.col("hits").isNotNull(), F.concat(counted, other)),
    )
    rows = bound(
        rows,
        class_distance=js_distance("p_classes", "q_classes"),
        word_distance=js_distance("p_words", "q_words"),
    )
    near = ~F.coalesce(F.col("class_distance") > most_class_distance, F.lit(False)) & ~F.coalesce(
        F.col("word_distance") > most_word_distance, F.lit(False)
    )
    return rows.select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed",
        (~F.col("base_failed") & near).alias("kept"), "class_distance", "word_distance",
    )
