"""Geographic helpers from built-in math expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

EARTH_RADIUS_KM = 6371.0088


def haversine_km(lat1: Column, lon1: Column, lat2: Column, lon2: Column) -> Column:
    dlat = F.radians(lat2 - lat1)
    dlon = F.radians(lon2 - lon1)
    a = (F.pow(F.sin(dlat / 2), 2)
         + F.cos(F.radians(lat1)) * F.cos(F.radians(lat2)) * F.pow(F.sin(dlon / 2), 2))
    return F.lit(2 * EARTH_RADIUS_KM) * F.asin(F.sqrt(a))


def sphere_xyz(lat: Column, lon: Column) -> list[Column]:
    """The place on the unit sphere: no seam at the date line, no shrinking at the poles."""
    la, lo = F.radians(lat), F.radians(lon)
    return [F.cos(la) * F.cos(lo), F.cos(la) * F.sin(lo), F.sin(la)]


def grid_cell(value: Column, cell_deg: float) -> Column:
    """Integer cell index of a coordinate on a fixed-degree grid."""
    return F.floor(value / F.lit(cell_deg)).cast("bigint")
