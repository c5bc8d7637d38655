import math
import random
from datetime import date, datetime, timedelta

import pytest
from pyspark.sql import functions as F

from aeroband.operators.aggregates import where, with_totals
from aeroband.plans import enriched as enrichment
from aeroband.plans import marts
from tests.frames import NOON, observation, reading, readings, weather


def daily(spark, rows, observations=()):
    air = weather(spark, *observations)
    return marts.daily_index(enrichment.enriched(readings(spark, *rows), air))


def test_pivot_index_and_worst(spark):
    rows = [
        reading(pollutant="Ozone", value=20.0), reading(pollutant="Ozone", value=22.0, timestamp=NOON + timedelta(hours=1)),
        reading(pollutant="PM2.5", value=75.5), reading(pollutant="Black Carbon", value=500.0),
    ]
    row = daily(spark, rows).first().asDict()
    assert (row["avg_o3"], row["avg_pm25"], row["avg_pm10"]) == (21.0, 75.5, None)
    assert (row["belaqi_o3"], row["belaqi_pm25"], row["belaqi_pm10"], row["belaqi_no2"]) == (2, 10, None, None)
    assert (row["belaqi_overall"], row["belaqi_label"], row["measurement_count"]) == (10, "Horrible", 4)
    assert row["measurement_date"] == date(2024, 1, 10) and row["data_source"] == "irceline"


def test_day_without_indexed_pollutant_is_unknown(spark):
    row = daily(spark, [reading(pollutant="Black Carbon")]).first()
    assert (row["belaqi_overall"], row["belaqi_label"]) == (0, "Unknown")


def test_weather_is_weighted_by_readings(spark):
    rows = [reading(pollutant=p) for p in ("Ozone", "PM10", "PM2.5")] + [reading(timestamp=NOON + timedelta(hours=1))]
    air = [
        observation(temperature_2m=10.0, precipitation=1.0),
        observation(timestamp=NOON + timedelta(hours=1), temperature_2m=2.0, precipitation=0.5),
    ]
    row = daily(spark, rows, air).first()
    assert (row["avg_temperature"], row["total_precipitation"]) == (8.0, 3.5)
    dry = daily(spark, rows).first()
    assert (dry["avg_temperature"], dry["total_precipitation"], dry["measurement_count"]) == (None, None, 4)


def test_noise_of_summation_does_not_decide_a_band(spark):
    # 0.1 + 0.2 is a little over 0.3; a mean of exactly 5 must be band 1.
    values = [4.7, 5.0, 5.3, 4.9, 5.1, 4.8, 5.2, 5.0, 0.1 + 0.2, 9.7]
    rows = [reading(pollutant="PM2.5", value=v, timestamp=NOON + timedelta(minutes=i)) for i, v in enumerate(values)]
    row = daily(spark, rows).first()
    assert (row["avg_pm25"], row["belaqi_pm25"]) == (5.0, 1)


def test_summary(spark):
    def day(n, value, pollutant="PM2.5"):
        at = datetime(2024, 1, n, 12)
        return reading(timestamp=at, value=value, pollutant=pollutant)

    rows = [day(1, 4.04), day(2, 70.0), day(3, 50.0), day(4, 9.0, "Black Carbon")]
    row = marts.station_summary(daily(spark, rows)).first().asDict()
    assert (row["first_measurement"], row["last_measurement"], row["days_with_data"]) == (
        date(2024, 1, 1), date(2024, 1, 4), 4,
    )
    assert (row["mean_pm25"], row["max_pm25"], row["mean_no2"]) == (41.3, 70.0, None)
    # Indices 1, 9, 7, 0: the unknown day counts as a good one.
    assert (row["mean_belaqi"], row["worst_belaqi"]) == (4.3, 9)
    assert (row["days_poor_or_worse"], row["days_good_or_better"], row["pct_days_poor"]) == (2, 2, 50.0)
    assert row["total_measurements"] == 4 and row["mean_temperature"] is None
    assert len(row) == 25


def test_moved_station_has_two_rows(spark):
    rows = [reading(), reading(latitude=50.1, timestamp=NOON + timedelta(days=1))]
    assert marts.station_summary(daily(spark, rows)).count() == 2


def test_output_types(spark):
    frame = daily(spark, [reading()])
    assert len(frame.columns) == 22
    kinds = dict(frame.dtypes)
    assert {kinds[c] for c in frame.columns if c.startswith("avg_")} == {"double"}
    assert {kinds[c] for c in frame.columns if c.startswith("belaqi_")} == {"int", "string"}
    assert kinds["measurement_date"] == "date" and kinds["measurement_count"] == "bigint"
    kinds = dict(marts.station_summary(frame).dtypes)
    assert {kinds[c] for c in ("days_with_data", "total_measurements", "days_poor_or_worse")} == {"bigint"}
    assert kinds["worst_belaqi"] == "int" and kinds["pct_days_poor"] == "double"


def test_mean_where_is_null_without_rows(spark):
    from aeroband.operators.aggregates import mean_where

    df = spark.createDataFrame([("a", 1.0), ("a", 2.0), ("b", None)], "k string, v double")
    means = df.agg(*[mean_where(F.col("k") == k, F.col("v")).alias(k) for k in "abc"]).first()
    assert tuple(means) == (pytest.approx(1.5), None, None)


def sums(df):
    found = with_totals(df.groupBy("k"), {"total": "v"}, {"mean": "v", "part": where("k = 1", "v")}, F.count("*").alias("n"))
    return [repr(tuple(r)) for r in found.orderBy("k").collect()]


def test_sums_have_equal_bits_however_rows_are_spread(spark):
    rng = random.Random(4)
    values = [rng.choice([1.0, -1.0]) * rng.random() * 10 ** rng.randint(-12, 9) for _ in range(4000)] + [None, 0.1, -0.0]
    df = spark.createDataFrame([(i % 3, v) for i, v in enumerate(values)], "k int, v double")
    found = {tuple(sums(df.repartition(n, "v"))) for n in (1, 7, 40)} | {tuple(sums(df.orderBy(F.desc("v"))))}
    assert len(found) == 1
    for row in with_totals(df.groupBy("k"), {"t": "v"}, {"m": "v"}).collect():
        own = [v for i, v in enumerate(values) if i % 3 == row["k"] and v is not None]
        assert row["t"] == pytest.approx(math.fsum(own), rel=1e-15) and row["m"] == pytest.approx(math.fsum(own) / len(own), rel=1e-15)


def test_sums_of_special_values(spark):
    def total(*values):
        return with_totals(spark.createDataFrame([(v,) for v in values], "v double").groupBy(), {"t": "v"}, {}).first()[0]

    assert total() is None and total(None) is None and total(0.1) == 0.1 and total(-0.1, 0.1) == 0.0
    assert total(-2.5, 1.25) == -1.25 and total(1e12, 0.5) == 1e12 + 0.5 and total(float("inf"), 1.0) == float("inf")
    assert math.isnan(total(float("nan"), 1.0)) and total(2.0**31, -(2.0**31), 3.0) == 3.0


def test_summary_from_months_is_that_from_days(spark):
    rng = random.Random(8)
    rows = [
        reading(station_id=str(rng.randrange(4)), pollutant=rng.choice(["PM2.5", "PM10", "Ozone", "Black Carbon"]),
                timestamp=datetime(2024, 1, 1) + timedelta(days=rng.randrange(120)), value=rng.random() * 99)
        for _ in range(500)
    ] + [reading(timestamp=None)]
    days = daily(spark, rows, [observation(timestamp=datetime(2024, 2, n, 0), temperature_2m=n / 7) for n in range(1, 20)])
    merged = marts.summary_of_months(marts.station_months(days).repartition(5))
    whole = marts.station_summary(days)
    assert merged.dtypes == whole.dtypes
    assert sorted(map(repr, merged.collect())) == sorted(map(repr, whole.collect()))
