"""Distance expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed value: the sphere radius the fares were modelled with.
EARTH_RADIUS_KM = 6367


def haversine_km(lon1: Column, lat1: Column, lon2: Column, lat2: Column) -> Column:
    """Great-circle distance in kilometres between points in decimal degrees.

    Null when a coordinate is null, NaN or infinite. Rounding can lift the chord of antipodal
    points just above 1, outside asin, hence ``least``; that skips nulls, hence the guard.
    Each costly term stands in the expression once, so that no plan evaluates it twice.
    """
    two = F.lit(2.0)
    cosines = F.cos(F.radians(lat1)) * F.cos(F.radians(lat2))
    chord = F.pow(F.sin((F.radians(lat2) - F.radians(lat1)) / 2), two) + (
        cosines * F.pow(F.sin((F.radians(lon2) - F.radians(lon1)) / 2), two)
    )
    finite = (lon1 + lat1 + lon2 + lat2) * 0.0 == 0.0
    return F.when(finite, EARTH_RADIUS_KM * 2 * F.asin(F.sqrt(F.least(F.lit(1.0), chord))))
