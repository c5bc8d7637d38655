"""Readings and weather derived from the given tables, in Spark and as SQL.

``events`` plays the sensor network: a user is a station, an event is a reading. The derivation plants null, negative
and too large values, unknown longitudes, several readings per key, hours with missing or no weather, and days with
only Black Carbon.
"""

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from aeroband.schemas import WEATHER_POINTS


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def readings(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "events").selectExpr(
        "cast(user_id as string) as station_id",
        "concat('Station ', cast(user_id as string)) as station_label",
        "49.5D + ((user_id * 37) % 200) / 100D as latitude",
        "case when user_id % 75 <> 74 then 2.5D + ((user_id * 53) % 400) / 100D end as longitude",
        """case event_type when 'view' then 'Particulate Matter < 10 µm' when 'click' then 'Particulate Matter < 2.5 µm'
          when 'purchase' then 'Nitrogen dioxide' when 'signup' then 'Ozone' else 'Black Carbon' end as pollutant""",
        "cast(date_trunc('hour', ts) as timestamp_ntz) as timestamp",
        """case when event_id % 97 = 0 then null when event_id % 89 = 0 then -value
          when event_id % 101 = 0 then value + 1000D else value end as value""",
        "'µg/m³' as unit",
        "cast(ts as timestamp_ntz) as ingested_at",
    )


def weather(spark: SparkSession, sf_dir: str) -> DataFrame:
    points = ", ".join(
        f"named_struct('i', {i}, 'name', '{name}', 'lat', {lat}D, 'lon', {lon}D)"
        for i, (name, lat, lon) in enumerate(WEATHER_POINTS)
    )
    hours = table(spark, sf_dir, "events").selectExpr("cast(date_trunc('hour', ts) as timestamp_ntz) as hr").distinct()
    network = hours.selectExpr("hr", "day(hr) * 24 + hour(hr) as n", f"inline(array({points}))")
    return network.filter("(n + i) % 5 <> 0 and n % 50 <> 0").selectExpr(
        "name as location_name",
        "lat as latitude",
        "lon as longitude",
        "hr as timestamp",
        "((n * 7 + i * 3) % 250) / 10D as temperature_2m",
        "cast(40 + (n * 5 + i) % 60 as double) as relative_humidity_2m",
        "((n * 11 + i * 5) % 150) / 10D as wind_speed_10m",
        "cast((n * 13 + i * 45) % 360 as double) as wind_direction_10m",
        "((n + i) % 4) / 4D as precipitation",
        "1000D + (n + i) % 40 as pressure_msl",
        "cast((n * 3 + i * 7) % 101 as double) as cloud_cover",
        "cast(100 + (n * 17 + i * 29) % 1900 as double) as boundary_layer_height",
        "hr as ingested_at",
    )


def again(df: DataFrame, value: str) -> DataFrame:
    """``df`` and a later ingest of a third of its hours, with changed values."""
    later = df.filter(F.hour("timestamp") % 3 == 0).withColumns(
        {value: F.col(value) + F.lit(1.0), "ingested_at": F.col("ingested_at") + F.expr("interval 1 day")}
    )
    return df.unionByName(later)


POINT_ROWS = ", ".join(f"({i}, '{name}', {lat}e0, {lon}e0)" for i, (name, lat, lon) in enumerate(WEATHER_POINTS))

READINGS_SQL = """
select cast(user_id as varchar) as station_id, concat('Station ', cast(user_id as varchar)) as station_label,
  49.5e0 + ((user_id * 37) % 200) / 1e2 as latitude,
  case when user_id % 75 <> 74 then 2.5e0 + ((user_id * 53) % 400) / 1e2 end as longitude,
  case event_type when 'view' then 'Particulate Matter < 10 µm' when 'click' then 'Particulate Matter < 2.5 µm'
    when 'purchase' then 'Nitrogen dioxide' when 'signup' then 'Ozone' else 'Black Carbon' end as pollutant,
  date_trunc('hour', ts) as "timestamp",
  case when event_id % 97 = 0 then null when event_id % 89 = 0 then -value
    when event_id % 101 = 0 then value + 1e3 else value end as value,
  'µg/m³' as unit, ts as ingested_at
from events"""

WEATHER_SQL = f"""
select p.name as location_name, p.lat as latitude, p.lon as longitude, h.hr as "timestamp",
  ((h.n * 7 + p.i * 3) % 250) / 1e1 as temperature_2m,
  cast(40 + (h.n * 5 + p.i) % 60 as double) as relative_humidity_2m,
  ((h.n * 11 + p.i * 5) % 150) / 1e1 as wind_speed_10m,
  cast((h.n * 13 + p.i * 45) % 360 as double) as wind_direction_10m,
  ((h.n + p.i) % 4) / 4e0 as precipitation, 1e3 + (h.n + p.i) % 40 as pressure_msl,
  cast((h.n * 3 + p.i * 7) % 101 as double) as cloud_cover,
  cast(100 + (h.n * 17 + p.i * 29) % 1900 as double) as boundary_layer_height, h.hr as ingested_at
from (select hr, day(hr) * 24 + hour(hr) as n from (select distinct date_trunc('hour', ts) as hr from events)) h
cross join (values {POINT_ROWS}) p(i, name, lat, lon)
where (h.n + p.i) % 5 <> 0 and h.n % 50 <> 0"""


def again_sql(name: str, value: str) -> str:
    return f"""
select * from {name} union all
select * replace ({value} + 1 as {value}, ingested_at + interval 1 day as ingested_at)
from {name} where hour("timestamp") % 3 = 0"""
