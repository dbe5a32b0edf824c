"""Map projection and training areas as SQL, for the oracles."""

from __future__ import annotations

import math

_f = 1 / 298.257223563
_n = _f / (2 - _f)
_A = 6378137.0 / (1 + _n) * (1 + _n**2 / 4 + _n**4 / 64) * 0.9996
_c = 2 * math.sqrt(_n) / (1 + _n)
_a = [
    _n / 2 - 2 * _n**2 / 3 + 5 * _n**3 / 16,
    13 * _n**2 / 48 - 3 * _n**3 / 5,
    61 * _n**3 / 240,
]
_b = [_n / 2 - 2 * _n**2 / 3 + 37 * _n**3 / 96, _n**2 / 48 + _n**3 / 15, 17 * _n**3 / 480]
_d = [2 * _n - 2 * _n**2 / 3 - 2 * _n**3, 7 * _n**2 / 3 - 8 * _n**3 / 5, 56 * _n**3 / 15]


def _num(v: float) -> str:
    """A DOUBLE literal (plain decimals would be DECIMAL)."""
    return f"CAST({v!r} AS DOUBLE)" if v >= 0 else f"(-CAST({-v!r} AS DOUBLE))"


def forward(source: str, lon: str, lat: str, name: str) -> list[str]:
    """CTEs that add ``east`` and ``north`` (UTM 12N) to ``source``."""
    s = f"sin(radians({lat}))"
    terms = list(enumerate(_a, 1))
    east = " + ".join(f"{_num(a)} * cos({2 * j} * xi) * sinh({2 * j} * eta)" for j, a in terms)
    north = " + ".join(f"{_num(a)} * sin({2 * j} * xi) * cosh({2 * j} * eta)" for j, a in terms)
    return [
        f"{name}_1 AS (SELECT *, sinh(atanh({s}) - {_num(_c)} * atanh({_num(_c)} * {s})) AS t_, "
        f"radians({lon} + 111) AS lam_ FROM {source})",
        f"{name}_2 AS (SELECT *, atan2(t_, cos(lam_)) AS xi, "
        f"atanh(sin(lam_) / sqrt(1 + t_ * t_)) AS eta FROM {name}_1)",
        f"{name} AS (SELECT *, 500000 + {_num(_A)} * (eta + {east}) AS east, "
        f"{_num(_A)} * (xi + {north}) AS north FROM {name}_2)",
    ]


def inverse(source: str, x: str, y: str, name: str) -> list[str]:
    """CTEs that add ``lon`` and ``lat`` to ``source``."""
    terms = list(enumerate(_b, 1))
    xi = " - ".join(f"{_num(b)} * sin({2 * j} * xi0) * cosh({2 * j} * eta0)" for j, b in terms)
    eta = " - ".join(f"{_num(b)} * cos({2 * j} * xi0) * sinh({2 * j} * eta0)" for j, b in terms)
    phi = " + ".join(f"{_num(d)} * sin({2 * j} * chi)" for j, d in enumerate(_d, 1))
    return [
        f"{name}_1 AS (SELECT *, {y} / {_num(_A)} AS xi0, ({x} - 500000) / {_num(_A)} AS eta0 "
        f"FROM {source})",
        f"{name}_2 AS (SELECT *, xi0 - {xi} AS xi1, eta0 - {eta} AS eta1 FROM {name}_1)",
        f"{name}_3 AS (SELECT *, asin(sin(xi1) / cosh(eta1)) AS chi FROM {name}_2)",
        f"{name} AS (SELECT *, degrees(chi + {phi}) AS lat, "
        f"degrees(atan2(sinh(eta1), cos(xi1))) - 111 AS lon FROM {name}_3)",
    ]


# one area per customer, see pixelquery.fixtures
AREAS_CTE = """
areas AS (
  SELECT c_custkey AS area_id, c_name AS desc_,
         CASE c_mktsegment WHEN 'AUTOMOBILE' THEN 'Urban' WHEN 'BUILDING' THEN 'Vegetation'
              WHEN 'FURNITURE' THEN 'Agricultural' WHEN 'HOUSEHOLD' THEN 'Bare_Soil'
              ELSE 'Industrial' END AS class_,
         CASE c_mktsegment WHEN 'AUTOMOBILE' THEN 1 WHEN 'BUILDING' THEN 2
              WHEN 'FURNITURE' THEN 3 WHEN 'HOUSEHOLD' THEN 4 ELSE 5 END AS cid,
         CAST(-112.10 AS DOUBLE) + CAST(c_custkey * 37 % 430 AS DOUBLE) / 1000 AS lon,
         CAST(33.73 AS DOUBLE) - CAST(c_custkey * 53 % 520 AS DOUBLE) / 1000 AS lat,
         CAST(0.004 AS DOUBLE) + CAST(c_nationkey % 5 AS DOUBLE) / 1000 AS dlon,
         CAST(0.003 AS DOUBLE) + CAST(c_nationkey % 4 AS DOUBLE) / 1000 AS dlat
  FROM customer)"""


def rings(source: str, key: str) -> list[str]:
    """CTEs ``edges`` (one row per ring edge, UTM) and ``ext`` (bounding box) of lon/lat boxes."""
    return [
        f"ring AS (SELECT {key}, i, lon + sx * dlon AS plon, lat + sy * dlat AS plat FROM {source}, "
        "(VALUES (1, 1, -1), (2, 1, 1), (3, -1, 1), (4, -1, -1), (5, 1, -1)) AS k(i, sx, sy))",
        *forward("ring", "plon", "plat", "ringxy"),
        f"edges AS (SELECT a.{key}, a.east AS x1, a.north AS y1, b.east AS x2, b.north AS y2 "
        f"FROM ringxy a JOIN ringxy b ON a.{key} = b.{key} AND b.i = a.i + 1)",
        f"ext AS (SELECT {key}, min(east) AS xmin, max(east) AS xmax, min(north) AS ymin, "
        f"max(north) AS ymax FROM ringxy GROUP BY {key})",
    ]


def inside(pixels: str, key: str) -> str:
    """CTE ``hits``: (pixel, polygon) pairs by the even-odd rule on the pixel centre."""
    return (
        f"hits AS (SELECT p.r, p.c, e.{key} FROM {pixels} p JOIN ext b ON p.x BETWEEN xmin AND "
        f"xmax AND p.y BETWEEN ymin AND ymax JOIN edges e ON e.{key} = b.{key} "
        f"GROUP BY p.r, p.c, e.{key} HAVING count(*) FILTER ((y1 > p.y) <> (y2 > p.y) AND "
        "p.x < CASE WHEN y2 <> y1 THEN (x2 - x1) * (p.y - y1) / (y2 - y1) + x1 END) % 2 = 1)"
    )
