"""Terrain attributes from surface derivatives (PRJ17-20)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def slope_degrees(zx: Column, zy: Column) -> Column:
    return F.degrees(F.atan(F.sqrt(zx * zx + zy * zy)))


def aspect(zx: Column, zy: Column) -> Column:
    """Azimuth from north in radians; rows grow southwards, so ``zy`` points south."""
    return F.atan2(-zx, zy)


def _where_sloped(zx: Column, zy: Column, value) -> Column:
    """``value(p)`` with ``p`` the squared gradient, 0.0 on flat ground."""
    p = zx * zx + zy * zy
    return F.when(p > 1e-8, value(p)).otherwise(F.lit(0.0))


def plan_curvature(zx: Column, zy: Column, zxx: Column, zxy: Column, zyy: Column) -> Column:
    bend = zxx * zy * zy - zxy * zx * zy * 2.0 + zyy * zx * zx
    return _where_sloped(zx, zy, lambda p: -bend / (p * F.sqrt(p + 1.0)))


def profile_curvature(zx: Column, zy: Column, zxx: Column, zxy: Column, zyy: Column) -> Column:
    bend = zxx * zx * zx + zxy * zx * zy * 2.0 + zyy * zy * zy
    return _where_sloped(zx, zy, lambda p: -bend / (p * F.pow(p + 1.0, F.lit(1.5))))
