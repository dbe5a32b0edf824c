"""The operators of this part as named queries over the whole test tables, with SQL where it can say the same."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pixelquery.llm import (
    collocations,
    divergence,
    exact_dedup,
    jaccard,
    lattice,
    mixing,
    packing,
    pii,
    quality,
    rollup,
    source_audit,
    substring,
    url_filter,
)
from pixelquery.session import scratch_path


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


#: Fixed rules of the query: host, path, verdict.
URL_RULES = [
    ("org", "/", "allow"),
    ("example.org", "/es/", "block"),
    ("example.org", "/en/1", "block"),
    ("com", "/fr/", "allow"),
    ("com", "/de/", "block"),
]


def op1_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    model = quality.train(docs, table(spark, sf_dir, "labels"))
    return quality.scored(docs.select("doc_id", "text"), model).select(
        "doc_id",
        quality.is_held_out("doc_id").alias("held_out"),
        "score",
        (F.col("score") >= 0.7).cast("int").alias("predicted"),
    )


def op2_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    kept = substring.remove_repeats(table(spark, sf_dir, "documents"), window=35)
    digest = F.sha2(F.col("kept_text").cast("binary"), 256)
    return kept.select("doc_id", "n_words", "n_removed", digest.alias("kept_sha256"))


def op9_lattice_score(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lattice.score(table(spark, sf_dir, "documents"), folds=10)


def op4_ngram_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard.near_duplicates(table(spark, sf_dir, "documents")).drop("uid")


def op5_divergence_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return divergence.rules(table(spark, sf_dir, "documents"))


def op3_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack_documents(table(spark, sf_dir, "documents"), capacity=2048)


def op8_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rollup.maintain(table(spark, sf_dir, "documents"), scratch_path(spark, "rollup"), restore=True)


def op6_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_dedup.exact_duplicates(table(spark, sf_dir, "documents")).drop("uid")


def op7_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    mixed = mixing.mix(mixing.measured(docs, "doc_id", "text", "source"))
    return mixed.select("doc_id", "size", "source_size", "target", "taken")


def op10_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    rules = spark.createDataFrame(URL_RULES, "host STRING, path STRING, verdict STRING")
    return url_filter.judge(table(spark, sf_dir, "pages"), rules).select(
        "page_id",
        F.col("url_host").alias("host"),
        F.col("url_path").alias("path"),
        F.col("url_rule").alias("rule"),
        F.col("url_verdict").alias("verdict"),
    )


def op11_source_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    return source_audit.audit(table(spark, sf_dir, "documents"), least=3, top=200)


def op12_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = pii.with_spans(table(spark, sf_dir, "documents").select("doc_id", "text"))
    base = F.filter("spans", lambda s: s["base"])

    def number(kind: str):
        return F.size(F.filter("spans", lambda s: s["base"] & (s["kind"] == kind))).cast("long").alias(f"n_{kind}")

    return found.select(
        "doc_id",
        *[number(kind) for kind, *_ in pii.BASE],
        F.sha2(pii.listed(base).cast("binary"), 256).alias("base_sha256"),
        pii.listed(F.col("spans")).alias("spans"),
    )


def op13_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return collocations.collocations(table(spark, sf_dir, "documents"), least=100, longest=5, top=2000)


EXACT_DEDUP_SQL = r"""
WITH t AS (
  SELECT doc_id, regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]+', ' ', 'g') AS body FROM documents)
SELECT doc_id, min(doc_id) OVER same AS keep_id, count(*) OVER same AS group_size,
       row_number() OVER (PARTITION BY body ORDER BY doc_id NULLS LAST) = 1 AS kept,
       sha256(body) AS text_sha256
FROM t WINDOW same AS (PARTITION BY body)
"""

MIXING_SQL = r"""
WITH sized AS (
  SELECT doc_id, source, len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')) AS size,
         md5(coalesce(CAST(doc_id AS VARCHAR), '') || ':7') AS draw FROM documents),
totals AS (
  SELECT source, CAST(sum(size) AS DOUBLE) AS source_size,
         CASE (row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 WHEN 0 THEN 5.0 WHEN 1 THEN 2.0 ELSE 1.0 END
           AS weight
  FROM sized GROUP BY source),
levels AS (
  SELECT *, 2 * source_size AS most,
         (1.5 * sum(source_size) OVER () - coalesce(sum(2 * source_size) OVER (
            ORDER BY 2 * source_size / CAST(weight AS DOUBLE), source NULLS FIRST
            ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0))
         / sum(CAST(weight AS DOUBLE)) OVER (ORDER BY 2 * source_size / CAST(weight AS DOUBLE), source NULLS FIRST
            ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS level
  FROM totals),
shared AS (SELECT max(level) AS level FROM levels WHERE most > level * weight),
aims AS (
  SELECT source, source_size,
         CAST(CASE WHEN most > levels.level * weight THEN least(most, shared.level * weight) ELSE most END AS DOUBLE)
           AS target,
         CAST(('0x' || substr(md5(coalesce(source, '') || ':7'), 1, 8)) AS BIGINT) / 4294967296.0 AS start
  FROM levels, shared),
placed AS (
  SELECT doc_id, size, s.source, row_number() OVER (PARTITION BY s.source ORDER BY size, draw, doc_id) - 1 AS place
  FROM sized s)
SELECT doc_id, size, CAST(source_size AS BIGINT) AS source_size, target,
       CASE WHEN source_size > 0 THEN CAST(size * least(2,
         floor((place + 1) * (target / source_size) + CAST(start AS DOUBLE))
         - floor(place * (target / source_size) + CAST(start AS DOUBLE))) AS BIGINT) ELSE 0 END AS taken
FROM placed p JOIN aims a ON p.source IS NOT DISTINCT FROM a.source
"""

URL_FILTER_SQL = r"""
WITH parts AS (
  SELECT page_id, url,
         translate(regexp_extract(coalesce(url, ''), '(?s)^.*?://([^/?#]*)', 1),
                   'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
         regexp_extract(coalesce(url, ''), '(?s)^.*?://[^/?#]*([^?#]*)', 1) AS path
  FROM pages),
rules(rule_host, rule_path, verdict) AS (
  VALUES ('org', '/', 'allow'), ('example.org', '/es/', 'block'), ('example.org', '/en/1', 'block'),
         ('com', '/fr/', 'allow'), ('com', '/de/', 'block')),
named AS (
  SELECT p.*, (SELECT max({'n': length(rule_host || rule_path), 'm': length(rule_host), 'v': r.verdict,
                           'r': rule_host || rule_path})
     FROM rules r WHERE (p.host = rule_host OR ends_with(p.host, '.' || rule_host))
       AND starts_with(p.path, rule_path)) AS best
  FROM parts p)
SELECT page_id, host, path, best['r'] AS rule, coalesce(best['v'], 'allow') AS verdict FROM named
"""

SOURCE_AUDIT_SQL = r"""
WITH d AS (
  SELECT coalesce(lang, '') AS lang, coalesce(source, '') AS source, row_number() OVER () AS uid,
         regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                            '[^\x00-\x40\x5B-\x60\x7B-\x7F]+') AS terms FROM documents),
t AS (SELECT lang, source, uid, unnest(terms) AS term FROM d),
kept AS (SELECT lang, term, count(*) AS total FROM t GROUP BY ALL HAVING count(DISTINCT uid) >= 3),
l AS (SELECT lang, count(*) AS v, sum(total) AS n FROM kept GROUP BY lang),
c AS (SELECT lang, source, term, count(*) AS cnt FROM t SEMI JOIN kept USING (lang, term) GROUP BY ALL),
g AS (SELECT lang, source, coalesce(sum(cnt), 0) AS n
      FROM (SELECT DISTINCT lang, source FROM d) LEFT JOIN c USING (lang, source) GROUP BY ALL),
dense AS MATERIALIZED (
  SELECT g.lang, g.source, term, coalesce(cnt, 0) AS cnt,
         1 + (CAST(1000000000 AS HUGEINT) * (coalesce(cnt, 0) + 1)) // CAST(g.n + l.v AS HUGEINT) AS p,
         1 + (CAST(1000000000 AS HUGEINT) * (total + 1)) // CAST(l.n + l.v AS HUGEINT) AS q
  FROM g JOIN l USING (lang) JOIN kept USING (lang) LEFT JOIN c USING (lang, source, term)),
sums AS (
  SELECT a.lang, a.source, b.source AS item, sum(((a.p - b.p) * (a.p - b.p)) // b.p) AS value
  FROM dense a JOIN dense b ON a.lang = b.lang AND a.term = b.term AND a.source <> b.source GROUP BY ALL),
pairs AS (
  SELECT a.lang, a.source, b.source AS item, coalesce(value, 0) AS value
  FROM g a JOIN g b ON a.lang = b.lang AND a.source <> b.source
  LEFT JOIN sums s ON s.lang = a.lang AND s.source = a.source AND s.item = b.source),
rows_ AS (
  SELECT lang, source, 'pair' AS part, item, value FROM pairs
  UNION ALL SELECT lang, source, 'term', term, ((p - q) * (p - q)) // q FROM dense WHERE cnt > 0 AND p > q)
SELECT lang, source, part, item, CAST(value AS BIGINT) AS value, CAST(rank AS INTEGER) AS rank
FROM (SELECT *, row_number() OVER (PARTITION BY lang, source, part ORDER BY value DESC, item) AS rank FROM rows_)
WHERE part = 'pair' OR rank <= 200
"""

COLLOCATIONS_SQL = r"""
WITH p AS (
  SELECT coalesce(lang, 'und') AS lang, unnest(regexp_split_to_array(
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[.,;:!?\x0A-\x0D]')) AS piece FROM documents),
w AS (SELECT lang, regexp_extract_all(piece, '[^\x20\x09]+') AS ws FROM p),
n AS (SELECT lang, sum(len(ws)) AS n FROM w GROUP BY lang),
grams AS (
  SELECT lang, k, unnest([array_to_string(ws[i:i + k - 1], ' ') FOR i IN range(1, len(ws) - k + 2)]) AS phrase
  FROM w, (VALUES (1), (2), (3), (4), (5)) AS lengths(k)),
f AS MATERIALIZED (SELECT lang, k, phrase, count(*) AS f FROM grams GROUP BY ALL HAVING count(*) >= 100),
cand AS (SELECT lang, k, phrase, string_split(phrase, ' ') AS ws, f AS a FROM f WHERE k > 1),
inside AS (
  SELECT lang, array_to_string(ws[i:i + m - 1], ' ') AS phrase, max(a) AS most
  FROM cand, range(1, 6) AS starts(i), range(2, 5) AS lengths(m) WHERE m < k AND i + m - 1 <= k GROUP BY ALL),
kept AS (
  SELECT c.* FROM cand c LEFT JOIN inside i USING (lang, phrase) WHERE most IS NULL OR 100 * most < 100 * c.a),
cuts AS (SELECT *, unnest(range(1, k)) AS cut FROM kept),
scored AS (
  SELECT c.lang, c.phrase, c.a, cut, x.f AS l, y.f AS r, n.n,
         (CAST(1000 AS HUGEINT) * c.a * n.n) // (CAST(x.f AS HUGEINT) * y.f) AS score
  FROM cuts c JOIN f x ON x.lang = c.lang AND x.phrase = array_to_string(c.ws[1:cut], ' ')
  JOIN f y ON y.lang = c.lang AND y.phrase = array_to_string(c.ws[cut + 1:c.k], ' ') JOIN n ON n.lang = c.lang),
best AS (
  SELECT * FROM scored QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, cut) = 1)
SELECT lang, rank, phrase, a, l, r, CAST(n AS BIGINT) AS n, CAST(score AS BIGINT) AS score
FROM (SELECT *, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank FROM best)
WHERE rank <= 2000
"""

QUERIES = {
    "op1_quality_classifier": op1_quality_classifier,
    "op2_substring_dedup": op2_substring_dedup,
    "op3_best_fit_packing": op3_best_fit_packing,
    "op4_ngram_jaccard_join": op4_ngram_jaccard_join,
    "op5_divergence_rules": op5_divergence_rules,
    "op6_exact_dedup": op6_exact_dedup,
    "op7_mixing": op7_mixing,
    "op8_token_counts": op8_token_counts,
    "op9_lattice_score": op9_lattice_score,
    "op10_url_filter": op10_url_filter,
    "op11_source_audit": op11_source_audit,
    "op12_pii": op12_pii,
    "op13_collocations": op13_collocations,
}

ORACLES = {
    "op6_exact_dedup": EXACT_DEDUP_SQL,
    "op7_mixing": MIXING_SQL,
    "op10_url_filter": URL_FILTER_SQL,
    "op11_source_audit": SOURCE_AUDIT_SQL,
    "op13_collocations": COLLOCATIONS_SQL,
}
