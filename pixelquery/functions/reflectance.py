"""Nodata handling and the twelve spectral indices (PRJ1-15, PRJ27, PRJ31)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from pixelquery.schema import EVI_RANGE


def mask_nodata(dn: Column) -> Column:
    """Digital number 0 is nodata."""
    return F.nullif(dn, F.lit(0))


def reflectance(dn: Column) -> Column:
    """Surface reflectance of a digital number; nodata stays NULL."""
    return mask_nodata(dn) / F.lit(10000.0)


def safe_divide(num: Column, den: Column) -> Column:
    """``num / den`` where ``|den| > 1e-6``, else 0.0.

    A NULL denominator gives 0.0, a NULL numerator over a valid denominator stays NULL.
    """
    return F.when(F.abs(den) > 1e-6, num / den).otherwise(F.lit(0.0))


def normalized_difference(a: Column, b: Column) -> Column:
    return safe_divide(a - b, a + b)


def spectral_indices(
    blue: Column, green: Column, red: Column, nir: Column, swir1: Column, swir2: Column
) -> dict[str, Column]:
    """Index and ratio columns by output name, in stack order."""
    bare, cover = swir1 + red, nir + blue
    return {
        "NDVI": normalized_difference(nir, red),
        "NDBI": normalized_difference(swir1, nir),
        "NDWI": normalized_difference(green, nir),
        "SAVI": safe_divide((nir - red) * 1.5, nir + red + 0.5),
        "BSI": normalized_difference(bare, cover),
        "EVI": safe_divide((nir - red) * 2.5, nir + red * 6.0 - blue * 7.5 + 1.0),
        "MNDWI": normalized_difference(green, swir1),
        "UI": normalized_difference(swir2, nir),
        # signed test on purpose: a negative NIR also gives 0.0
        "NBI": F.when(nir > 1e-6, red * swir1 / nir).otherwise(F.lit(0.0)),
        "RedGreen": safe_divide(red, green),
        "SR": safe_divide(nir, red),
        "SWIRRatio": safe_divide(swir1, nir),
    }


def clamp(value: Column, low: float, high: float) -> Column:
    """Limit to ``[low, high]``; NULL stays NULL (``greatest``/``least`` alone would skip it)."""
    return F.when(
        value.isNotNull(), F.greatest(F.lit(float(low)), F.least(F.lit(float(high)), value))
    )


def clip_evi(evi: Column) -> Column:
    return clamp(evi, *EVI_RANGE)


def zero_filled(value: Column) -> Column:
    """Nodata becomes 0.0, as texture windows need."""
    return F.coalesce(value, F.lit(0.0))
