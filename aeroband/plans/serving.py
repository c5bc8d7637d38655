"""Queries on the marts. All are lazy unless they say otherwise; an empty result is an empty DataFrame."""

from datetime import date

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from aeroband.operators.geosearch import within_radius
from aeroband.operators.reshape import select_available

# Columns of the station overview.
OVERVIEW = [
    "station_label", "mean_belaqi", "mean_pm25", "mean_pm10", "mean_no2", "days_with_data", "pct_days_poor",
]


def stations(summary: DataFrame, min_belaqi: int | None = None) -> DataFrame:
    """All stations, worst mean index first, or those of at least ``min_belaqi`` (1 to 10)."""
    if min_belaqi is not None:
        if not 1 <= min_belaqi <= 10:
            raise ValueError("min_belaqi must be between 1 and 10")
        summary = summary.filter(F.col("mean_belaqi") >= F.lit(min_belaqi))
    return summary.orderBy(F.desc_nulls_last("mean_belaqi"), "station_id")


def station_daily(daily: DataFrame, station_id: str, start: date | None = None, end: date | None = None) -> DataFrame:
    """The days of one station, newest first, both ends of the range included."""
    days = daily.filter(F.col("station_id") == F.lit(station_id))
    if start is not None:
        days = days.filter(F.col("measurement_date") >= F.lit(start))
    if end is not None:
        days = days.filter(F.col("measurement_date") <= F.lit(end))
    return days.orderBy(F.desc_nulls_last("measurement_date"), "station_label", "station_lat", "station_lon")


def nearby(summary: DataFrame, lat: float, lon: float, radius_km: float = 10, limit: int = 10) -> DataFrame:
    """The ``limit`` (1 to 50) nearest stations within the radius, nearest first, with ``distance_km``."""
    if not 1 <= limit <= 50:
        raise ValueError("limit must be between 1 and 50")
    found = within_radius(summary, lat, lon, radius_km)
    return found.orderBy(F.asc_nulls_last("distance_km"), "station_id").limit(limit)


def station_options(summary: DataFrame) -> DataFrame:
    """Distinct (station_id, station_label) pairs."""
    return summary.select("station_id", "station_label").dropDuplicates()


def id_for_label(summary: DataFrame, label: str) -> DataFrame:
    """The station id of a label, as one row; the least id if stations share the label."""
    chosen = station_options(summary).filter(F.col("station_label") == F.lit(label))
    return chosen.select("station_id").orderBy("station_id").limit(1)


def mean_index_range(summary: DataFrame, low: float = 1.0, high: float = 10.0) -> DataFrame:
    """Stations whose mean index lies in the closed range."""
    return summary.filter(F.col("mean_belaqi").between(low, high))


def selected_count(selected: DataFrame) -> DataFrame:
    return selected.agg(F.count(F.lit(1)).alias("stations"))


def overview(summary: DataFrame) -> DataFrame:
    """The overview table: those of its columns that exist, worst mean index first."""
    return select_available(summary, OVERVIEW).orderBy(F.desc_nulls_last("mean_belaqi"), "station_label")


def date_range(daily: DataFrame) -> DataFrame:
    """First and last date of the data, null if there is none."""
    return daily.agg(F.min("measurement_date").alias("earliest_data"), F.max("measurement_date").alias("latest_data"))


def health(read_daily) -> dict:
    """Status, and the last date of the data. Runs the query: a mart that cannot be read is the "unhealthy"
    answer, not an error. ``read_daily`` returns the daily mart."""
    try:
        latest = date_range(read_daily()).first()["latest_data"]
    except Exception as problem:  # whatever the reason
        return {"status": "unhealthy", "error": str(problem)}
    return {"status": "healthy", "latest_data": latest}
