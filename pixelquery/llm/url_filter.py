"""Allow and block rules on host suffixes and path prefixes, matched by digest."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

PREFIX_DIGITS = 8


def host_of(url: Column) -> Column:
    """From the first ``://`` up to ``/``, ``?``, ``#`` or the end, A-Z in lower case; else empty."""
    return F.translate(
        F.regexp_extract(F.coalesce(url, F.lit("")), r"(?s)^.*?://([^/?#]*)", 1),
        "ABCDEFGHIJKLMNOPQRSTUVWXYZ",
        "abcdefghijklmnopqrstuvwxyz",
    )


def path_of(url: Column) -> Column:
    """What follows the host, up to ``?``, ``#`` or the end."""
    return F.regexp_extract(F.coalesce(url, F.lit("")), r"(?s)^.*?://[^/?#]*([^?#]*)", 1)


def digest(expression: Column) -> Column:
    return F.sha2(expression.cast("binary"), 256)


def labels_of(host: Column) -> Column:
    """How many labels a host has."""
    return F.length(host) - F.length(F.replace(host, F.lit("."), F.lit(""))) + 1


def expressions(host: Column, path: Column, labels: list[int], lengths: list[int]) -> Column:
    """Every host suffix and path prefix that is as long as a rule's: in labels, and in characters."""
    held = F.filter(F.array(*map(F.lit, labels)), lambda n: n <= labels_of(host))
    suffixes = F.transform(held, lambda n: F.call_function("substring_index", host, F.lit("."), -n))
    short = F.filter(F.array(*map(F.lit, lengths)), lambda n: n <= F.length(path))
    prefixes = F.transform(short, lambda n: F.substring(path, F.lit(1), n))
    return F.flatten(
        F.transform(suffixes, lambda s: F.transform(prefixes, lambda p: F.struct(s.alias("h"), p.alias("p"))))
    )


def judge(pages: DataFrame, rules: DataFrame, url: str = "url", default: str = "allow") -> DataFrame:
    """``pages`` with its columns and ``url_host, url_path, url_rule, url_verdict`` (which replace any
    columns of these names).

    ``rules`` has ``host, path, verdict``.  A rule fits its host and all subdomains if the path starts
    with the rule's; the longest (host and path together, then the longer host) wins; of equal rules,
    block wins.  Without a fitting rule the verdict is ``default``.  A null url, or one without ``://``,
    has an empty host and path, which no rule with a host fits.  Repeated rows stay repeated; columns of
    ``pages`` may have any other names.  Empty tables are allowed on both sides.  The driver sees the
    different lengths of rule paths and numbers of labels of rule hosts; hosts of urls may be of any length.

    Each different url is expanded once; expressions meet rules by the first digits of their SHA-256
    digests, full digests confirm, and one row per matched url goes back to the pages.
    """
    known = rules.select("host", "path", "verdict").where("host IS NOT NULL AND path IS NOT NULL")
    lengths = sorted(row[0] for row in known.select(F.length("path")).distinct().collect()) or [0]
    labels = sorted(row[0] for row in known.select(labels_of(F.col("host"))).distinct().collect()) or [0]
    known = known.withColumn("full", digest(F.concat_ws("\n", "host", "path")))
    known = known.withColumn("short", F.substring("full", 1, PREFIX_DIGITS))

    urls = pages.select(F.col(url).alias("u")).where("u IS NOT NULL").distinct()
    parts = urls.select("u", host_of(F.col("u")).alias("h"), path_of(F.col("u")).alias("p"))
    expanded = parts.where("h <> ''").select(
        "u", F.inline(expressions(F.col("h"), F.col("p"), labels, lengths))
    )
    hashed = expanded.select("u", digest(F.concat_ws("\n", "h", "p")).alias("d"))
    near = hashed.withColumn("s", F.substring("d", 1, PREFIX_DIGITS)).join(known, F.col("s") == F.col("short"))
    sure = near.where(F.col("d") == F.col("full"))
    length = F.length("host") + F.length("path")
    best = F.max(F.struct(length.alias("n"), F.length("host").alias("m"), "verdict", "host", "path")).alias("best")
    found = sure.groupBy("u").agg(best)
    kept = [c for c in pages.columns if c.lower() not in ("url_host", "url_path", "url_rule", "url_verdict")]
    rule = found["best"]
    return pages.join(found, pages[url] == found["u"], "left").select(
        *[pages[c] for c in kept],
        host_of(pages[url]).alias("url_host"),
        path_of(pages[url]).alias("url_path"),
        F.concat(rule["host"], rule["path"]).alias("url_rule"),
        F.coalesce(rule["verdict"], F.lit(default)).alias("url_verdict"),
    )
