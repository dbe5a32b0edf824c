"""The derived pixel grid as SQL, and output rounding shared by queries and oracles."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# one order is one pixel, see pixelquery.fixtures; y_pred NULL is nodata
GRID_CTE = """
li AS (
  SELECT l_orderkey AS k, COUNT(*) AS n,
         CAST(SUM(CAST(floor(l_quantity) AS BIGINT)) AS BIGINT) AS q,
         CAST(SUM(CAST(floor(l_extendedprice) AS BIGINT)) AS BIGINT) AS p
  FROM lineitem GROUP BY l_orderkey),
px AS (
  SELECT o.o_orderkey AS k,
         CAST(floor(o.o_orderkey / 100.0) AS INT) AS r, CAST(o.o_orderkey % 100 AS INT) AS c,
         CASE WHEN li.q % 97 = 0 THEN 0 ELSE 200 + (li.q * 7) % 1800 END AS d02,
         300 + (li.q * 11 + li.n * 131) % 2200 AS d03,
         250 + li.p % 2800 AS d04,
         CASE WHEN li.p % 89 = 0 THEN 0 ELSE 400 + (li.p * 3 + li.q) % 4600 END AS d08,
         500 + (li.p * 5 + li.n) % 3900 AS d11,
         450 + (li.p * 7 + li.q * 13) % 3100 AS d12,
         CASE WHEN o.o_custkey % 50 = 0 THEN NULL ELSE cu.c_acctbal * 0.05 + 300 END AS z,
         CASE WHEN o.o_orderkey % 11 = 0 THEN 5
              ELSE CAST(substring(o.o_orderpriority, 1, 1) AS INT) - 1 END AS y_true
  FROM orders o LEFT JOIN li ON o.o_orderkey = li.k
  LEFT JOIN customer cu ON o.o_custkey = cu.c_custkey),
grid AS (
  SELECT *, CAST(399960 + (c + 0.5) * 350 AS DOUBLE) AS x,
         CAST(3729900 - (r + 0.5) * 350 AS DOUBLE) AS y,
         CASE WHEN d02 IS NULL OR d02 = 0 OR d08 = 0 THEN NULL
              WHEN k % 9 = 0 THEN (y_true + 1) % 6 ELSE y_true END AS y_pred,
         CAST(nullif(d02, 0) AS DOUBLE) / 10000 AS b02,
         CAST(nullif(d03, 0) AS DOUBLE) / 10000 AS b03,
         CAST(nullif(d04, 0) AS DOUBLE) / 10000 AS b04,
         CAST(nullif(d08, 0) AS DOUBLE) / 10000 AS b08,
         CAST(nullif(d11, 0) AS DOUBLE) / 10000 AS b11,
         CAST(nullif(d12, 0) AS DOUBLE) / 10000 AS b12
  FROM px),
size AS (SELECT max(r) + 1 AS h, max(c) + 1 AS w FROM grid)
"""


def safe(num: str, den: str) -> str:
    return f"CASE WHEN abs({den}) > 1e-6 THEN ({num}) / ({den}) ELSE 0 END"


# index formulas over reflectance columns b02..b12
INDEX_SQL = {
    "NDVI": safe("b08 - b04", "b08 + b04"),
    "NDBI": safe("b11 - b08", "b11 + b08"),
    "NDWI": safe("b03 - b08", "b03 + b08"),
    "SAVI": safe("1.5 * (b08 - b04)", "b08 + b04 + 0.5"),
    "BSI": safe("(b11 + b04) - (b08 + b02)", "(b11 + b04) + (b08 + b02)"),
    "EVI": safe("2.5 * (b08 - b04)", "b08 + 6.0 * b04 - 7.5 * b02 + 1.0"),
    "MNDWI": safe("b03 - b11", "b03 + b11"),
    "UI": safe("b12 - b08", "b12 + b08"),
    "NBI": "CASE WHEN b08 > 1e-6 THEN b04 * b11 / b08 ELSE 0 END",
    "RedGreen": safe("b04", "b03"),
    "SR": safe("b08", "b04"),
    "SWIRRatio": safe("b11", "b08"),
}

INDEX_CTE = (
    "idx AS (SELECT *, "
    + ", ".join(f"CAST({sql} AS DOUBLE) AS {name}" for name, sql in INDEX_SQL.items())
    + " FROM grid)"
)


def _nudge(digits: int) -> float:
    """Engines round exact ties (x.5 of the last digit) differently; this moves them off the tie."""
    return 3.0 / 10 ** (digits + 4)


def r(expression: str, digits: int = 6) -> str:
    """SQL rounding that matches ``rounded``."""
    return f"round(CAST({expression} AS DOUBLE) + CAST({_nudge(digits)!r} AS DOUBLE), {digits}) + 0.0"


def rounded(df: DataFrame, *columns: str, digits: int = 6) -> DataFrame:
    """Round for comparison; adding 0.0 turns -0.0 into 0.0."""
    return df.withColumns(
        {c: F.round(F.col(c) + F.lit(_nudge(digits)), digits) + F.lit(0.0) for c in columns}
    )


def with_grid(body: str, *ctes: str) -> str:
    return "WITH " + ", ".join((GRID_CTE.strip(), *ctes)) + "\n" + body


def with_grid_recursive(body: str, *ctes: str) -> str:
    return "WITH RECURSIVE " + ", ".join((GRID_CTE.strip(), *ctes)) + "\n" + body
