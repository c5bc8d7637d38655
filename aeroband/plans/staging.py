"""Staging models: raw rows to clean, deduplicated, typed rows."""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from aeroband.functions.labels import standardise
from aeroband.operators.clean import filter_valid
from aeroband.operators.latest import dedupe_latest
from aeroband.schemas import LABEL_RULES, READINGS_SOURCE, WEATHER_VARIABLES


def valid_readings(raw: DataFrame) -> DataFrame:
    """Raw readings with a plausible value and a known position."""
    return filter_valid(raw, "value", low=0, high=1000, required=["latitude", "longitude"])


def latest_readings(raw: DataFrame) -> DataFrame:
    """The newest ingest of each reading. A reading is identified by its *raw* label: two raw labels of one
    standard pollutant are two readings here, and are told apart by the next model."""
    return dedupe_latest(
        raw,
        ["station_id", "pollutant", "timestamp"],
        newest="ingested_at",
        tie_breaks=["value", "latitude", "longitude", "station_label", "unit"],
    )


def staged_readings(raw: DataFrame, rules=LABEL_RULES, source=READINGS_SOURCE, keep_raw_label=False) -> DataFrame:
    """Clean readings. Invalid ones go first, so that an invalid newest reading does not hide a valid older one.

    ``keep_raw_label`` adds the column ``raw_label``, which the next model needs for a total order.
    """
    latest = latest_readings(valid_readings(raw)).withColumn("_lowered", F.lower("pollutant"))
    return latest.select(
        "station_id",
        "station_label",
        "latitude",
        "longitude",
        standardise("pollutant", rules, lowered="_lowered").alias("pollutant"),
        F.col("timestamp").alias("measured_at"),
        F.col("value").alias("measurement_value"),
        "unit",
        "ingested_at",
        F.lit(source).alias("data_source"),
        *([F.col("pollutant").alias("raw_label")] if keep_raw_label else []),
    )


def staged_weather(raw: DataFrame) -> DataFrame:
    """The newest ingest of each location's hour, with its date and hour of day."""
    timed = raw.filter(F.col("timestamp").isNotNull())
    latest = dedupe_latest(
        timed,
        ["location_name", "timestamp"],
        newest="ingested_at",
        tie_breaks=["latitude", "longitude", *WEATHER_VARIABLES],
    )
    return latest.select(
        "location_name",
        "latitude",
        "longitude",
        F.col("timestamp").alias("measured_at"),
        F.col("timestamp").cast("date").alias("measured_date"),
        F.hour("timestamp").alias("measured_hour"),
        *WEATHER_VARIABLES,
        "ingested_at",
    )
