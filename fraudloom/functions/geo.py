"""Distances."""
from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

EARTH_RADIUS_KM = 6371.0  # fixed value


def haversine_km(lat1: Column, lon1: Column, lat2: Column, lon2: Column) -> Column:
    """Great-circle distance in kilometres; null when a coordinate is missing."""
    half_dlat = F.radians(lat2 - lat1) / 2
    half_dlon = F.radians(lon2 - lon1) / 2
    chord = F.pow(F.sin(half_dlat), 2) + F.cos(F.radians(lat1)) * F.cos(F.radians(lat2)) * F.pow(
        F.sin(half_dlon), 2
    )
    # Not least(): it skips nulls, and a missing point must stay null.
    return F.asin(F.sqrt(F.when(chord > 1.0, 1.0).otherwise(chord))) * (2 * EARTH_RADIUS_KM)
