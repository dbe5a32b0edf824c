"""WGS84 <-> UTM by the Krüger series in n, to third order (PRJ26), and box helpers (PRJ30).

The series is written once over a namespace of elementary functions: ``pyspark.sql.functions`` gives
Column expressions, ``math`` gives floats for driver-side constants, ``numpy`` arrays inside tasks.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import Column
from pyspark.sql import functions as F

SEMI_MAJOR = 6378137.0
FLATTENING = 1 / 298.257223563
SCALE = 0.9996
FALSE_EASTING = 500000.0

_n = FLATTENING / (2 - FLATTENING)
_RADIUS = SEMI_MAJOR / (1 + _n) * (1 + _n**2 / 4 + _n**4 / 64)
_C = 2 * math.sqrt(_n) / (1 + _n)
_ALPHA = (
    _n / 2 - 2 * _n**2 / 3 + 5 * _n**3 / 16,
    13 * _n**2 / 48 - 3 * _n**3 / 5,
    61 * _n**3 / 240,
)
_BETA = (
    _n / 2 - 2 * _n**2 / 3 + 37 * _n**3 / 96,
    _n**2 / 48 + _n**3 / 15,
    17 * _n**3 / 480,
)
_DELTA = (
    2 * _n - 2 * _n**2 / 3 - 2 * _n**3,
    7 * _n**2 / 3 - 8 * _n**3 / 5,
    56 * _n**3 / 15,
)


def central_meridian(zone: int) -> float:
    return zone * 6 - 183.0


# Both directions are split where an intermediate pair is used several times, so that rings can be
# mapped stage by stage with each pair evaluated once per vertex.
def _forward_angles(fn, lon, lat, zone):
    s = fn.sin(fn.radians(lat))
    lam = fn.radians(lon - central_meridian(zone))
    return fn.sinh(fn.atanh(s) - fn.atanh(s * _C) * _C), lam


def _forward_sphere(fn, t, lam):
    return fn.atan2(t, fn.cos(lam)), fn.atanh(fn.sin(lam) / fn.sqrt(t * t + 1.0))


def _forward_series(fn, xi, eta):
    east, north = eta, xi
    for j, a in enumerate(_ALPHA, 1):
        east = east + fn.cos(xi * (2.0 * j)) * fn.sinh(eta * (2.0 * j)) * a
        north = north + fn.sin(xi * (2.0 * j)) * fn.cosh(eta * (2.0 * j)) * a
    return east * (SCALE * _RADIUS) + FALSE_EASTING, north * (SCALE * _RADIUS)


def _forward(fn, lon, lat, zone):
    return _forward_series(fn, *_forward_sphere(fn, *_forward_angles(fn, lon, lat, zone)))


def _inverse_series(fn, x, y):
    xi = y / (SCALE * _RADIUS)
    eta = (x - FALSE_EASTING) / (SCALE * _RADIUS)
    xi1, eta1 = xi, eta
    for j, b in enumerate(_BETA, 1):
        xi1 = xi1 - fn.sin(xi * (2.0 * j)) * fn.cosh(eta * (2.0 * j)) * b
        eta1 = eta1 - fn.cos(xi * (2.0 * j)) * fn.sinh(eta * (2.0 * j)) * b
    return xi1, eta1


def _inverse_sphere(fn, xi1, eta1):
    return fn.asin(fn.sin(xi1) / fn.cosh(eta1)), fn.atan2(fn.sinh(eta1), fn.cos(xi1))


def _inverse_angles(fn, chi, lam, zone):
    phi = chi
    for j, d in enumerate(_DELTA, 1):
        phi = phi + fn.sin(chi * (2.0 * j)) * d
    return fn.degrees(lam) + central_meridian(zone), fn.degrees(phi)


def _inverse(fn, x, y, zone):
    return _inverse_angles(fn, *_inverse_sphere(fn, *_inverse_series(fn, x, y)), zone)


def lonlat_to_utm(lon: Column, lat: Column, zone: int = 12) -> tuple[Column, Column]:
    """Easting and northing (northern hemisphere) of WGS84 degrees."""
    return _forward(F, lon, lat, zone)


def utm_to_lonlat(x: Column, y: Column, zone: int = 12) -> tuple[Column, Column]:
    return _inverse(F, x, y, zone)


def lonlat_to_utm_point(lon: float, lat: float, zone: int = 12) -> tuple[float, float]:
    return _forward(math, lon, lat, zone)


def utm_to_lonlat_point(x: float, y: float, zone: int = 12) -> tuple[float, float]:
    return _inverse(math, x, y, zone)


def point(x: Column, y: Column) -> Column:
    return F.struct(x.alias("x"), y.alias("y"))


def project_ring(ring: Column, zone: int = 12) -> Column:
    """Lon/lat ring to UTM, vertex by vertex."""
    stages = (
        lambda x, y: _forward_angles(F, x, y, zone),
        lambda x, y: _forward_sphere(F, x, y),
        lambda x, y: _forward_series(F, x, y),
    )
    for stage in stages:
        ring = _map_points(ring, stage)
    return ring


def unproject_ring(ring: Column, zone: int = 12) -> Column:
    stages = (
        lambda x, y: _inverse_series(F, x, y),
        lambda x, y: _inverse_sphere(F, x, y),
        lambda x, y: _inverse_angles(F, x, y, zone),
    )
    for stage in stages:
        ring = _map_points(ring, stage)
    return ring


def _map_points(ring: Column, pair) -> Column:
    return F.transform(ring, lambda p: point(*pair(p["x"], p["y"])))


def box_ring(west: Column, south: Column, east: Column, north: Column) -> Column:
    """Closed ring of a box, counter-clockwise from the south-east corner."""
    return F.array(
        point(east, south),
        point(east, north),
        point(west, north),
        point(west, south),
        point(east, south),
    )


# ground length of one degree of latitude used for the approximate box size
METRES_PER_DEGREE = 111320.0


def box_width_m(dlon: Column, lat: Column) -> Column:
    return F.bround(dlon * 2.0 * METRES_PER_DEGREE * F.cos(F.radians(lat)), 0)


def box_height_m(dlat: Column) -> Column:
    return F.bround(dlat * 2.0 * METRES_PER_DEGREE, 0)


def projected_bounds(west: Column, south: Column, east: Column, north: Column, zone: int = 12, between: int = 21) -> Column:
    """``left, bottom, right, top`` in UTM of a lon/lat box, with ``between`` more points on each side.

    The sides of a box are curves on the map, so corners alone would cut off what bulges out.  All points
    are projected, a batch of boxes at once; a side without one of its coordinates counts for nothing.
    """
    steps = np.arange(between + 2) / (between + 1.0)

    def bounds(west: pa.Array, south: pa.Array, east: pa.Array, north: pa.Array) -> pa.Array:
        known = [v.is_valid().to_numpy(zero_copy_only=False) for v in (west, south, east, north)]
        w, s, e, n = (v.to_numpy(zero_copy_only=False)[:, None] for v in (west, south, east, north))
        lon, lat = w + (e - w) * steps, s + (n - s) * steps
        least = np.full((2, len(w)), np.nan)
        most = np.full((2, len(w)), -np.inf)
        any_ = np.zeros(len(w), bool)
        with np.errstate(all="ignore"):
            for needs, *side in (((0, 1, 2), lon, s), ((1, 2, 3), e, lat), ((0, 2, 3), lon, n), ((0, 1, 3), w, lat)):
                whole = np.logical_and.reduce([known[i] for i in needs])
                any_ |= whole
                for axis, value in enumerate(_forward(np, *side, zone)):
                    # what is not a number is the greatest, as in SQL
                    least[axis] = np.fmin(least[axis], np.where(whole, np.fmin.reduce(value, axis=1), np.nan))
                    most[axis] = np.maximum(most[axis], np.where(whole, value.max(axis=1), -np.inf))
        ends = [pa.array(end, mask=~any_, from_pandas=False) for end in (*least, *most)]
        return pa.StructArray.from_arrays(ends, ["left", "bottom", "right", "top"])

    # not repeated by the optimizer for each field that is read
    bounds = F.arrow_udf(bounds, "left DOUBLE, bottom DOUBLE, right DOUBLE, top DOUBLE").asNondeterministic()
    return bounds(*[c.cast("double") for c in (west, south, east, north)])
