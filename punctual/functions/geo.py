"""Planar distance and the proximity grid."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def planar_distance_m(lat1, lon1, lat2, lon2, m_lat: float, m_lon: float) -> Column:
    """sqrt((dlat*m_lat)^2 + (dlon*m_lon)^2): metres on a local flat map."""
    dy = (lat1 - lat2) * F.lit(m_lat)
    dx = (lon1 - lon2) * F.lit(m_lon)
    return F.sqrt(F.pow(dy, 2) + F.pow(dx, 2))


def grid_cell(coord: Column, metres_per_deg: float, cell_m: float) -> Column:
    """Index of a square grid cell of ``cell_m`` metres along one axis."""
    return F.floor(coord * F.lit(metres_per_deg / cell_m)).cast("long")
