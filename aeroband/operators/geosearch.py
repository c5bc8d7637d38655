"""Searches around a given point."""

import math

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from aeroband.functions.geo import degree_distance_sq, great_circle_km
from aeroband.schemas import EARTH_RADIUS_KM


def with_distance(df: DataFrame, lat: float, lon: float, lat_col="station_lat", lon_col="station_lon") -> DataFrame:
    """``df`` with the great-circle distance of each row from the point, as ``distance_km``."""
    here = F.lit(float(lat)), F.lit(float(lon))
    return df.withColumn("distance_km", great_circle_km(*here, F.col(lat_col), F.col(lon_col)))


def within_radius(
    df: DataFrame, lat: float, lon: float, radius_km: float, lat_col="station_lat", lon_col="station_lon"
) -> DataFrame:
    """Rows at most ``radius_km`` from the point, with ``distance_km``.

    A row cannot be nearer than its difference in latitude, so rows outside that strip are dropped by a plain range
    on the stored column, which reaches the Parquet scan and skips row groups. The strip is a little wide.
    """
    reach = math.degrees(radius_km / EARTH_RADIUS_KM) + 1e-6
    strip = df.filter(F.col(lat_col).between(float(lat) - reach, float(lat) + reach))
    return with_distance(strip, lat, lon, lat_col, lon_col).filter(F.col("distance_km") <= F.lit(float(radius_km)))


def nearest_row(
    df: DataFrame, lat: float, lon: float, lat_col="station_lat", lon_col="station_lon", tie="station_id"
) -> DataFrame:
    """The one row closest to the point by distance on degrees, ties by ``tie``; rows without position are out.

    An aggregate, so each task reduces its rows to one before anything is sent. ``order`` is a struct: its
    comparison decides by distance, then by the tie-break, then by the rest of the row.
    """
    distance = degree_distance_sq(F.col(lat_col), F.col(lon_col), F.lit(float(lat)), F.lit(float(lon)))
    placed = df.filter(F.col(lat_col).isNotNull() & F.col(lon_col).isNotNull())
    best = placed.agg(F.min(F.struct(distance.alias("distance"), F.col(tie).alias("tie"), F.struct("*").alias("row"))).alias("best"))
    return best.filter(F.col("best").isNotNull()).select("best.row.*")
