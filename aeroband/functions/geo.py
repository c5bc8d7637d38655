"""Distances between points given as latitude and longitude columns in degrees."""

from pyspark.sql import Column
from pyspark.sql import functions as F

from aeroband.schemas import EARTH_RADIUS_KM


def degree_distance_sq(lat_a: Column, lon_a: Column, lat_b: Column, lon_b: Column) -> Column:
    """Squared straight-line distance on degrees: enough to rank points of a small area, and no root needed."""
    return F.pow(lat_a - lat_b, F.lit(2)) + F.pow(lon_a - lon_b, F.lit(2))


def great_circle_km(lat_a: Column, lon_a: Column, lat_b: Column, lon_b: Column) -> Column:
    """Great-circle distance by the spherical law of cosines.

    Rounding can push the cosine of two equal points just above 1, where acos is NaN and the point would drop
    out of every radius; it is therefore clamped to [-1, 1]. A cosine that is NaN itself stays NaN.
    """
    phi_a, phi_b = F.radians(lat_a), F.radians(lat_b)
    cosine = F.cos(phi_a) * F.cos(phi_b) * F.cos(F.radians(lon_b) - F.radians(lon_a)) + F.sin(phi_a) * F.sin(phi_b)
    # Not least/greatest: those skip nulls, and an unknown position must keep an unknown distance.
    clamped = (
        F.when(F.isnan(cosine), cosine)
        .when(cosine > F.lit(1.0), F.lit(1.0))
        .when(cosine < F.lit(-1.0), F.lit(-1.0))
        .otherwise(cosine)
    )
    return F.lit(float(EARTH_RADIUS_KM)) * F.acos(clamped)
