"""Great-circle distance."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

EARTH_RADIUS_KM = 6371


def _half_chord(lat1: Column, lon1: Column, lat2: Column, lon2: Column) -> Column:
    dlat = (F.radians(lat2) - F.radians(lat1)) / 2
    dlon = (F.radians(lon2) - F.radians(lon1)) / 2
    chord = F.pow(F.sin(dlat), 2) + F.cos(F.radians(lat1)) * F.cos(F.radians(lat2)) * F.pow(F.sin(dlon), 2)
    # Rounding can lift antipodal points just above 1, where asin is NaN. Not least(), which would turn
    # a missing coordinate into the largest distance.
    return F.when(chord > 1, F.lit(1.0)).otherwise(chord)


def haversine_km(lat1: Column, lon1: Column, lat2: Column, lon2: Column) -> Column:
    return 2 * EARTH_RADIUS_KM * F.asin(F.sqrt(_half_chord(lat1, lon1, lat2, lon2)))


def haversine_km_atan2(lat1: Column, lon1: Column, lat2: Column, lon2: Column) -> Column:
    """Same distance, better conditioned for points far apart."""
    a = _half_chord(lat1, lon1, lat2, lon2)
    return 2 * EARTH_RADIUS_KM * F.atan2(F.sqrt(a), F.sqrt(1 - a))
