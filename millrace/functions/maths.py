"""Numeric expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed value: sphere radius in km used for distances; 6371 is the usual mean.
RADIUS_KM = 6391.0

def haversine_km(lat1: Column, lon1: Column, lat2: Column, lon2: Column, radius: float = RADIUS_KM) -> Column:
    half = lambda a, b: F.pow(F.sin(F.radians(b - a) / 2), 2)
    h = half(lat1, lat2) + F.cos(F.radians(lat1)) * F.cos(F.radians(lat2)) * half(lon1, lon2)
    return F.lit(2 * radius) * F.asin(F.sqrt(F.least(h, F.lit(1.0))))


def heat_index(temp: Column, humidity: Column) -> Column:
    """Felt temperature from 80 degrees and 40 % humidity on; the temperature below that."""
    t, h = temp, humidity
    # Factors of the public regression for the heat index.
    constant, by_t, by_h, by_th = -42.379, 2.04901523, 10.14333127, -0.22475541
    by_tt, by_hh, by_tth, by_thh, by_tthh = -6.83783e-3, -5.481717e-2, 1.22874e-3, 8.5282e-4, -1.99e-6
    linear = by_t * t + by_h * h + by_th * t * h
    square = by_tt * t * t + by_hh * h * h
    mixed = by_tth * t * t * h + by_thh * t * h * h + by_tthh * t * t * h * h
    total = constant + linear + square + mixed
    return F.when((temp >= 80) & (humidity >= 40), total).otherwise(temp)


def share(part: Column, whole: Column) -> Column:
    """``part / whole``, null where ``whole`` is 0."""
    return part / F.nullif(whole.cast("double"), F.lit(0.0))


def percent(part: Column, whole: Column, digits: int = 2) -> Column:
    return F.round(F.lit(100.0) * part / F.nullif(whole.cast("double"), F.lit(0.0)), digits)


def smoothed_ratio(a: Column, b: Column, eps: float = 1e-6) -> Column:
    """``(a + eps) / (b + eps)``, 1 where the lower part is not positive."""
    low = b + F.lit(eps)
    return F.when(low > 0, (a + F.lit(eps)) / low).otherwise(F.lit(1.0))


def number_or_zero(col: Column) -> Column:
    """Null and NaN as 0."""
    return F.coalesce(F.nanvl(col.cast("double"), F.lit(0.0)), F.lit(0.0))


def first_of(*values: Column | float | str) -> Column:
    """First non-null value of a fallback chain; plain numbers count as doubles."""
    return F.coalesce(*[v if isinstance(v, Column) else F.lit(v) for v in values])
