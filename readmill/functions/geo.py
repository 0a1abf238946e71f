"""Great-circle geometry."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed value: mean Earth radius in km.
EARTH_RADIUS_KM = 6371.0088


def _half_chord_squared(lat1: Column, lon1: Column, lat2: Column, lon2: Column) -> Column:
    dphi = F.radians(lat2 - lat1) / 2
    dlam = F.radians(lon2 - lon1) / 2
    return F.pow(F.sin(dphi), F.lit(2.0)) + F.cos(F.radians(lat1)) * F.cos(
        F.radians(lat2)
    ) * F.pow(F.sin(dlam), F.lit(2.0))


def great_circle_km(lat1: Column, lon1: Column, lat2: Column, lon2: Column) -> Column:
    """Haversine distance in km."""
    h = _half_chord_squared(lat1, lon1, lat2, lon2)
    return F.lit(EARTH_RADIUS_KM * 2) * F.atan2(
        F.sqrt(h), F.sqrt(F.greatest(1 - h, F.lit(0.0)))
    )


def unit_vector(lat: Column, lon: Column) -> tuple[Column, Column, Column]:
    """Position on the unit sphere: no seams at the poles or the date line."""
    phi, lam = F.radians(lat), F.radians(lon)
    return F.cos(phi) * F.cos(lam), F.cos(phi) * F.sin(lam), F.sin(phi)
