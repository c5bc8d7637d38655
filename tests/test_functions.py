import math
from datetime import datetime

import pytest
from pyspark.sql import functions as F

from aeroband.functions import bands, geo, labels, numbers, times
from aeroband.schemas import BAND_BOUNDS, BAND_COLOURS, READINGS, SERIES_LABELS, WEATHER_POINTS


def column(spark, values, kind, expression):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], f"i int, v {kind}")
    return [row[1] for row in df.select("i", expression).orderBy("i").collect()]


@pytest.mark.parametrize("pollutant", BAND_BOUNDS)
def test_band_edges(spark, pollutant):
    uppers = BAND_BOUNDS[pollutant]
    values = [0.0, None, 1e9, float("nan")]
    expected = [1, None, 10, 10]
    for band, upper in enumerate(uppers, 1):
        values += [float(upper), math.nextafter(upper, math.inf), math.nextafter(upper, 0)]
        expected += [band, band + 1, band]
    assert column(spark, values, "double", bands.band_index("v", uppers)) == expected


def test_worst_of_counts_null_as_zero(spark):
    df = spark.createDataFrame([(1, 7, None), (None, None, None), (3, 2, 10)], "a int, b int, c int")
    assert [r[0] for r in df.select(bands.worst_of("a", "b", "c")).collect()] == [7, 0, 10]


def test_index_labels(spark):
    words = column(spark, [*range(12), None], "int", bands.index_label("v"))
    assert words == [
        "Unknown", "Very Good", "Very Good", "Good", "Good", "Moderate", "Moderate", "Poor", "Poor", "Very Poor",
        "Horrible", "Unknown", "Unknown",
    ]


def test_band_colours_truncate_and_clamp(spark):
    values = [None, 0.0, float("nan"), 0.9, 1.99, 2.0, 9.99, 10.0, 12.5, -3.0]
    expected = [BAND_COLOURS[i] for i in (1, 1, 1, 1, 1, 2, 9, 10, 10, 1)]
    assert column(spark, values, "double", bands.band_colour("v")) == expected


def test_standard_labels(spark):
    raw = {
        "Particulate Matter < 10 µm": "PM10", "Particulate Matter < 2.5 µm": "PM2.5", "Nitrogen dioxide": "NO2",
        "Ozone": "O3", "Black Carbon": "BC", "PM2.5": "PM2.5", "pm10": "PM10", "SO2 (air)": "SO2", "co": "CO",
        "Cloud cover": "CLOUD COVER", " Benzene ": "BENZENE", None: None, "": "",
        # Known to the services, not to the rules.
        "Sulphur dioxide": "SULPHUR DIOXIDE", "Carbon monoxide": "CARBON MONOXIDE",
        # The first matching rule wins.
        "PM10 and NO2": "PM10", "it's o3": "O3",
    }
    assert column(spark, list(raw), "string", labels.standardise("v")) == list(raw.values())


def test_standard_labels_take_other_rules(spark):
    rules = [("FISH", ["%it's%", "%cod%"], ["%war%"])]
    names = column(spark, ["COD", "cold war cod", "it's"], "string", labels.standardise("v", rules, default="'?'"))
    assert names == ["FISH", "?", "FISH"]
    assert column(spark, ["a "], "string", labels.standardise("v", rules=[])) == ["A"]


def test_great_circle_of_equal_points_is_zero_at_every_latitude(spark):
    df = spark.range(0, 4000).select((F.col("id") / 50 - 40).alias("lat"), F.lit(4.7).alias("lon"))
    here = geo.great_circle_km(F.col("lat"), F.col("lon"), F.col("lat"), F.col("lon"))
    # acos is steep near 1: rounding of the cosine is worth up to about 10 cm.
    assert df.filter(F.isnan(here) | here.isNull() | (here > 0.001)).count() == 0


def test_great_circle_against_known_distance_and_unknown_positions(spark):
    df = spark.createDataFrame(
        [(50.85, 4.35, 51.22, 4.40), (None, 4.0, 50.0, 4.0), (float("nan"), 4.0, 50.0, 4.0), (0.0, 0.0, 0.0, 180.0)],
        "a double, b double, c double, d double",
    )
    km = [r[0] for r in df.select(geo.great_circle_km(*map(F.col, "abcd"))).collect()]
    assert km[0] == pytest.approx(41.29, abs=0.01)
    assert km[1] is None and math.isnan(km[2])
    assert km[3] == pytest.approx(6371 * math.pi)


@pytest.mark.parametrize("zone", ["UTC", "Europe/Brussels", "America/St_Johns"])
def test_times_do_not_depend_on_the_session_zone(spark, zone):
    spark.conf.set("spark.sql.session.timeZone", zone)
    try:
        check_times(spark)
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")


def check_times(spark):
    # 2024-03-31 02:30 does not exist on Brussels clocks.
    gap = datetime(2024, 3, 31, 2, 30)
    assert column(spark, [gap], "timestamp_ntz", times.hour_start(F.col("v"))) == [datetime(2024, 3, 31, 2)]
    moments = [datetime(2024, 1, 31, 5, 59, 59, 999999), datetime(1969, 12, 31, 23, 30), None]
    assert column(spark, moments, "timestamp_ntz", times.hour_number(F.col("v"))) == [
        (datetime(2024, 1, 31, 5) - datetime(1970, 1, 1)).days * 24 + 5, -1, None,
    ]
    assert column(spark, moments, "timestamp_ntz", times.hour_start(F.col("v"))) == [
        datetime(2024, 1, 31, 5), datetime(1969, 12, 31, 23), None,
    ]
    assert column(spark, [(datetime(2024, 1, 31, 5) - datetime(1970, 1, 1)).days * 86_400_000 + 5 * 3_600_000 + 123, None], "long", times.from_epoch_ms(F.col("v"))) == [
        datetime(2024, 1, 31, 5, 0, 0, 123000), None,
    ]
    assert column(spark, ["2024-01-31T05:00"], "string", times.from_iso(F.col("v"))) == [datetime(2024, 1, 31, 5)]


def test_numbers(spark):
    values = [1.5, None, float("nan"), float("inf"), float("-inf")]
    assert column(spark, values, "double", numbers.finite_or_null(F.col("v"))) == [1.5, None, None, None, None]
    assert column(spark, [0, 3, None], "long", numbers.safe_percent(F.lit(1), F.col("v"))) == [None, 33.3, None]


def test_fixed_values():
    assert {"station_id", "pollutant", "value", "timestamp"} <= set(READINGS.names)
    assert {"Brussels", "Antwerp", "Ghent", "Liege"} <= {name for name, _, _ in WEATHER_POINTS}
    assert all(49.5 <= lat <= 51.5 and 2.5 <= lon <= 6.5 for _, lat, lon in WEATHER_POINTS)
    assert len(SERIES_LABELS) == 7


def test_times_that_cannot_be_read_are_null(spark):
    texts = ["2024-01-31T05:00:07", "2024-01-31 05:00:07.25", "2024-01-31", "yesterday", "2024-13-01T00:00", "2024", None]
    assert column(spark, texts, "string", times.from_iso(F.col("v"))) == [
        datetime(2024, 1, 31, 5, 0, 7), datetime(2024, 1, 31, 5, 0, 7, 250_000), datetime(2024, 1, 31), None, None, None, None,
    ]
    assert column(spark, [1_706_677_200_000_000_000, 0], "long", times.from_epoch_ms(F.col("v"))) == [None, datetime(1970, 1, 1)]


def test_zoned_moments_are_taken_in_utc():
    from datetime import timedelta, timezone

    zoned = datetime(2024, 1, 1, 12, tzinfo=timezone(timedelta(hours=2)))
    assert times.utc(zoned) == datetime(2024, 1, 1, 10) and times.utc(datetime(2024, 1, 1)) == datetime(2024, 1, 1)
