"""Small hand-made frames."""

from datetime import datetime

from aeroband.schemas import READINGS, WEATHER, WEATHER_VARIABLES

NOON = datetime(2024, 1, 10, 12)


def reading(**changes):
    row = {
        "station_id": "s1", "station_label": "One", "latitude": 50.0, "longitude": 4.0, "pollutant": "Ozone",
        "timestamp": NOON, "value": 10.0, "unit": "µg/m³", "ingested_at": datetime(2024, 1, 11, 6),
    }
    assert not set(changes) - set(row)
    return tuple({**row, **changes}.values())


def observation(**changes):
    row = {
        "location_name": "Here", "latitude": 50.0, "longitude": 4.0, "timestamp": NOON,
        **{name: 1.0 for name in WEATHER_VARIABLES}, "ingested_at": datetime(2024, 1, 11, 6),
    }
    assert not set(changes) - set(row)
    return tuple({**row, **changes}.values())


def readings(spark, *rows):
    return spark.createDataFrame(list(rows), READINGS)


def weather(spark, *rows):
    return spark.createDataFrame(list(rows), WEATHER)
