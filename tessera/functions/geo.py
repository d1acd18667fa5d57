"""Great-circle distance as a column expression (stays in codegen; the
centre of a cluster is passed as literals, so every round of an iterative
job uses its own current centre)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed value: the Earth radius used by the distance rule, in km.
EARTH_RADIUS_KM = 6378.1


def _col(x: Column | float | str) -> Column:
    if isinstance(x, Column):
        return x
    if isinstance(x, str):
        return F.col(x)
    return F.lit(float(x))


def haversine_km(lat1, lon1, lat2, lon2) -> Column:
    """Distance in km between (lat1, lon1) and (lat2, lon2), in degrees:
    a = sin^2(dphi/2) + cos(phi1) cos(phi2) sin^2(dlambda/2),
    d = 2 R atan2(sqrt(a), sqrt(1 - a))."""
    lat1, lon1, lat2, lon2 = (_col(v) for v in (lat1, lon1, lat2, lon2))
    phi1, phi2 = F.radians(lat1), F.radians(lat2)
    half_dphi = F.radians(lat2 - lat1) / 2
    half_dlambda = F.radians(lon2 - lon1) / 2
    a = F.pow(F.sin(half_dphi), 2) + F.cos(phi1) * F.cos(phi2) * F.pow(F.sin(half_dlambda), 2)
    return F.lit(2 * EARTH_RADIUS_KM) * F.atan2(F.sqrt(a), F.sqrt(F.lit(1.0) - a))
