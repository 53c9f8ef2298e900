"""Column functions on the bands of one date."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

#: The no-data value at the edge, and the sum below which an index is zero.
NO_DATA, LEAST_SUM, ATMOSPHERE = -10000.0, 1e-5, 0.05


def band(bands: Column, n: int) -> Column:
    """Band n, counted from 1."""
    return F.element_at(bands, n)


def normalised_index(a: Column, b: Column, eps: float = 0.0) -> Column:
    """(a - b) / (a + b), 0 where the sum nearly vanishes; eps corrects for the atmosphere."""
    return F.when(F.abs(a + b) < LEAST_SUM, F.lit(0.0)).otherwise((a - b - eps) / (a + b + eps) if eps else (a - b) / (a + b))


def brightness(bands: Column) -> Column:
    return F.sqrt(F.aggregate(bands, F.lit(0.0), lambda t, v: t + v * v))


def missing(bands: Column) -> Column:
    """Whether any band of the date is the no-data value, within 0.1."""
    return F.exists(bands, lambda v: F.abs(v - NO_DATA) < 0.1)


def date_features(bands: Column, red: int, nir: int, swir: int | None = None, factor: float = 1000.0) -> Column:
    """Struct of ndvi, ndwi, brightness; all no-data where a band is. Without swir ndwi is null."""
    gone = missing(bands)
    edge = lambda c: F.when(gone, F.lit(NO_DATA)).otherwise(c)
    ndwi = edge(normalised_index(band(bands, swir), band(bands, nir)) * factor) if swir else F.lit(None).cast("double")
    return F.struct(
        edge(normalised_index(band(bands, nir), band(bands, red)) * factor).alias("ndvi"), ndwi.alias("ndwi"), edge(brightness(bands)).alias("brightness")
    )


def relative_reflectance(bands: Column, reference: int) -> Column:
    """Every band as an index against the reference band, which stays as it is."""
    ref = band(bands, reference)
    return F.transform(bands, lambda v, i: F.when(i == reference - 1, v).otherwise(normalised_index(v, ref)))


def decibels(v: Column, low: float = -25.0, high: float = 3.0, top: int = 65535) -> Column:
    """Linear backscatter as clipped decibels scaled to an integer range."""
    db = F.least(F.greatest(10 * F.log10(v), F.lit(low)), F.lit(high))
    return F.floor((db - low) / (high - low) * top).cast("int")
