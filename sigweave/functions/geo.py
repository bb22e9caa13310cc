"""Great-circle distance."""

from __future__ import annotations

from math import pi

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed value: equatorial radius used by the distance rule.
EARTH_RADIUS_KM = 6378.137


def great_circle_km(lat1: Column, lon1: Column, lat2: Column, lon2: Column) -> Column:
    """Haversine distance in km between two points in degrees."""
    phi1, phi2 = F.radians(lat1), F.radians(lat2)
    half_dphi = (phi1 - phi2) / 2
    half_dlambda = (F.radians(lon1) - F.radians(lon2)) / 2
    h = F.pow(F.sin(half_dphi), F.lit(2.0)) + F.cos(phi1) * F.cos(phi2) * F.pow(
        F.sin(half_dlambda), F.lit(2.0)
    )
    # Rounding may push h a hair above 1 for opposite points, where asin is not a number.
    return F.nanvl(F.asin(F.sqrt(h)), F.lit(pi / 2)) * (2 * EARTH_RADIUS_KM)


def whole_km(km: Column) -> Column:
    """The distance rule reports full kilometres: rounded to 0.1 m, then cut."""
    return F.floor(F.floor(km * 10000 + 0.5) / 10000).cast("double")
