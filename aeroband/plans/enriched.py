"""Readings with the weather around them."""

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from aeroband.functions.labels import standardise
from aeroband.functions.times import hour_number
from aeroband.operators.joins import fits_broadcast, join_on_bucket
from aeroband.operators.latest import first_per_key
from aeroband.operators.nearest import NearestLimits, nearest_match, right_shape
from aeroband.plans.staging import staged_readings, staged_weather
from aeroband.schemas import LABEL_RULES, WEATHER_VARIABLES


def hour_joined(readings: DataFrame, weather: DataFrame) -> DataFrame:
    """Every reading with the weather of its hour: the number of weather rows and their mean temperature.

    The right side is one row per hour before it is joined, so readings are not multiplied by the locations.
    Readings without a time, or in an hour without weather, keep 0 and null.
    """
    hourly = (
        weather.groupBy(hour_number(F.col("measured_at")).alias("_hour"))
        .agg(F.count(F.lit(1)).alias("weather_rows"), F.avg("temperature_2m").alias("hour_temperature"))
        .filter(F.col("_hour").isNotNull())
    )
    keyed = readings.withColumn("_hour", hour_number(F.col("measured_at")))
    joined = join_on_bucket(keyed, hourly, ["_hour"], small=fits_broadcast(hourly))
    return joined.drop("_hour").withColumn("weather_rows", F.coalesce("weather_rows", F.lit(0).cast("long")))


def colliding_names(labels: DataFrame, name: Column) -> DataFrame:
    """The standard names (``pollutant``) that several raw labels have. ``labels`` holds raw labels as ``raw_label``,
    repeats allowed; their number, not that of the readings, is what is gathered."""
    distinct = labels.select("raw_label").distinct()
    return distinct.groupBy(name.alias("pollutant")).count().filter("count > 1").select("pollutant")


def readings_with_weather(
    readings: DataFrame, weather: DataFrame, limits=NearestLimits(), colliding: DataFrame | None = None
) -> DataFrame:
    """One row per station, standard pollutant and time, with the nearest weather available in that hour.

    ``readings`` must carry ``raw_label``. Readings that share the key (two raw labels of one pollutant) collapse
    to the one nearest to its weather, then the newest, then the first by raw label. Only the names in ``colliding``
    (``pollutant``; found here if not given) are shuffled for that: of others the staging model has left one row per key.
    """
    if colliding is None:
        pairs = readings.select("pollutant", "raw_label").distinct()
        colliding = pairs.groupBy("pollutant").count().filter("count > 1").select("pollutant")

    right = weather.select(
        hour_number(F.col("measured_at")).alias("_hour"),
        "latitude",
        "longitude",
        "measured_at",
        F.col("location_name").alias("weather_station"),
        *WEATHER_VARIABLES,
    )
    shape = right_shape(right, "_hour", limits.per_chunk)

    def matched(rows):
        return nearest_match(
            rows.withColumn("_hour", hour_number(F.col("measured_at"))),
            right,
            bucket="_hour",
            left_xy=("latitude", "longitude"),
            right_xy=("latitude", "longitude"),
            carry=["weather_station", *WEATHER_VARIABLES],
            ties=["weather_station", "measured_at"],
            limits=limits,
            shape=shape,
        )

    alone = matched(readings.join(colliding, "pollutant", "left_anti"))
    key = ["station_id", "pollutant", "measured_at"]
    # Keys hold a few rows at most here, so a group limit before the exchange would sort in vain;
    # partitioning first leaves only the one behind it.
    collapsed = first_per_key(
        matched(readings.join(colliding, "pollutant", "left_semi")).repartition(*key),
        key,
        [F.asc_nulls_last("distance_sq"), F.desc_nulls_last("ingested_at"), F.asc_nulls_last("raw_label")],
    )
    return alone.unionByName(collapsed).select(
        "station_id",
        "station_label",
        F.col("latitude").alias("station_lat"),
        F.col("longitude").alias("station_lon"),
        "pollutant",
        "measured_at",
        "measurement_value",
        "unit",
        "data_source",
        "weather_station",
        *WEATHER_VARIABLES,
    )


def enriched(raw_readings: DataFrame, raw_weather: DataFrame, rules=LABEL_RULES, limits=NearestLimits()) -> DataFrame:
    """The enriched model from raw tables. Which names collide is read off the raw labels, one narrow column."""
    return readings_with_weather(
        staged_readings(raw_readings, rules, keep_raw_label=True),
        staged_weather(raw_weather),
        limits,
        colliding_names(raw_readings.select(F.col("pollutant").alias("raw_label")), standardise("raw_label", rules)),
    )
