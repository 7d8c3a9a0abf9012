"""Geometry on latitude and longitude in degrees, as Columns and as numpy."""

from __future__ import annotations

import numpy as np
from pyspark.sql import Column, functions as F

#: Fixed value: metres of the sphere's radius.
EARTH_M = 6_371_000.0


def haversine_m(lat1: Column, lon1: Column, lat2: Column, lon2: Column) -> Column:
    """Great-circle distance in metres; null if any argument is null."""
    half = lambda a, b: F.pow(F.sin(F.radians(b - a) / 2), 2)
    a = half(lat1, lat2) + F.cos(F.radians(lat1)) * F.cos(F.radians(lat2)) * half(lon1, lon2)
    return 2 * EARTH_M * F.atan2(F.sqrt(a), F.sqrt(F.greatest(1 - a, F.lit(0.0))))


def haversine_np(lat1, lon1, lat2, lon2) -> np.ndarray:
    lat1, lon1, lat2, lon2 = map(np.radians, (lat1, lon1, lat2, lon2))
    a = np.sin((lat2 - lat1) / 2) ** 2 + np.cos(lat1) * np.cos(lat2) * np.sin((lon2 - lon1) / 2) ** 2
    return 2 * EARTH_M * np.arctan2(np.sqrt(a), np.sqrt(np.maximum(1 - a, 0)))


def planar_offset(lat: Column, lon: Column, north_m: float, east_m: float) -> tuple[Column, Column]:
    """(lat, lon) moved by metres, at 111,320 m to a degree."""
    return lat + north_m / 111_320.0, lon + east_m / (F.cos(F.radians(lat)) * 111_320.0)


def finite(x: Column) -> Column:
    return x.isNotNull() & ~F.isnan(x) & (F.abs(x) != float("inf"))
