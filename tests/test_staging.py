from datetime import datetime, timedelta

from pyspark.sql import functions as F

from aeroband.functions.labels import standardise
from aeroband.operators import clean
from aeroband.operators.latest import dedupe_latest
from aeroband.plans import staging
from aeroband.plans.enriched import colliding_names
from aeroband.schemas import POLLUTANTS
from tests.frames import NOON, observation, reading, readings, weather

LATER = datetime(2024, 1, 12, 6)


def values(df):
    return sorted(r["measurement_value"] for r in df.collect())


def test_only_plausible_placed_readings_stay(spark):
    kept = [0.0, 999.999]
    dropped = [None, -0.1, 1000.0, float("nan"), float("inf")]
    rows = [reading(station_id=str(i), value=v) for i, v in enumerate(kept + dropped)]
    rows += [reading(station_id="a", latitude=None), reading(station_id="b", longitude=None)]
    assert values(staging.staged_readings(readings(spark, *rows))) == kept


def test_newest_ingest_wins(spark):
    df = readings(spark, reading(value=1.0), reading(value=2.0, ingested_at=LATER), reading(value=3.0, ingested_at=None))
    assert values(staging.staged_readings(df)) == [2.0]


def test_invalid_newest_reading_does_not_hide_the_older(spark):
    df = readings(spark, reading(value=1.0), reading(value=-5.0, ingested_at=LATER))
    assert values(staging.staged_readings(df)) == [1.0]


def test_two_raw_labels_of_one_pollutant_both_pass(spark):
    df = readings(spark, reading(pollutant="PM2.5"), reading(pollutant="Particulate Matter < 2.5 µm", ingested_at=LATER))
    staged = staging.staged_readings(df)
    assert [r["pollutant"] for r in staged.collect()] == ["PM2.5", "PM2.5"]
    labels = lambda *rows: readings(spark, *rows).select(F.col("pollutant").alias("raw_label"))
    names = lambda df: [r[0] for r in colliding_names(df, standardise("raw_label")).collect()]
    assert names(df.select(F.col("pollutant").alias("raw_label"))) == ["PM2.5"]
    assert names(labels(reading(), reading(), reading(pollutant=None), reading(pollutant="pm10"))) == []


def test_reading_without_time_passes(spark):
    staged = staging.staged_readings(readings(spark, reading(timestamp=None), reading(timestamp=None, ingested_at=LATER)))
    assert [r["measured_at"] for r in staged.collect()] == [None]


def test_output_columns(spark):
    staged = staging.staged_readings(readings(spark, reading()))
    assert staged.dtypes == [
        ("station_id", "string"), ("station_label", "string"), ("latitude", "double"), ("longitude", "double"),
        ("pollutant", "string"), ("measured_at", "timestamp_ntz"), ("measurement_value", "double"), ("unit", "string"),
        ("ingested_at", "timestamp_ntz"), ("data_source", "string"),
    ]
    names = dict(staging.staged_weather(weather(spark, observation())).dtypes)
    assert len(names) == 15 and names["measured_date"] == "date" and names["measured_hour"] == "int"


def test_weather_keeps_newest_and_drops_untimed(spark):
    staged = staging.staged_weather(weather(
        spark,
        observation(temperature_2m=1.0), observation(temperature_2m=2.0, ingested_at=LATER),
        observation(location_name="There", temperature_2m=3.0), observation(timestamp=None),
    ))
    assert sorted((r["location_name"], r["temperature_2m"], r["measured_hour"]) for r in staged.collect()) == [
        ("Here", 2.0, 12), ("There", 3.0, 12),
    ]


def test_a_key_with_a_third_of_all_rows_is_reduced_before_the_exchange(spark, plan_of):
    df = spark.range(30_000).select(
        F.when(F.col("id") % 3 == 0, 0).otherwise(F.col("id")).alias("k"), F.col("id").alias("v")
    )
    latest = dedupe_latest(df, ["k"], "v")
    assert latest.count() == 20_001 - (0 if latest.filter("k = 0").count() else 1)
    assert latest.filter("k = 0").first()["v"] == 29_997
    tree = plan_of(latest).split("\n\n")[0]
    assert tree.index("Exchange") < tree.rindex("WindowGroupLimit")


def test_label_allow_list(spark):
    df = readings(spark, *[
        reading(pollutant=p) for p in ("Particulate Matter < 10 µm", "Ozone", "ozone", "Black Carbon", None)
    ])
    keep = lambda names: sorted(r["pollutant"] for r in clean.filter_labels(df, "pollutant", names).collect())
    assert keep(["O3", "unheard of"]) == ["Ozone"]
    assert keep([]) == [] and keep(["unheard of"]) == []
    assert keep(None) == ["Ozone", "Particulate Matter < 10 µm"]
    assert keep(POLLUTANTS) == ["Black Carbon", "Ozone", "Particulate Matter < 10 µm"]


def test_lookback_includes_both_ends(spark):
    offsets = [timedelta(0), timedelta(hours=-3), timedelta(hours=-3, microseconds=-1), timedelta(microseconds=1)]
    df = readings(spark, *[reading(timestamp=NOON + o) for o in offsets])
    assert clean.filter_lookback(df, "timestamp", NOON, 3).count() == 2


def test_lookback_days_are_whole(spark):
    times = [datetime(2024, 1, 8, 23, 59), datetime(2024, 1, 9), datetime(2024, 1, 10, 23), datetime(2024, 1, 11)]
    df = weather(spark, *[observation(timestamp=t) for t in times])
    assert clean.filter_lookback_days(df, "timestamp", NOON, 1).count() == 2
    assert [clean.lookback_days(h) for h in (1, 24, 47, 48, 168)] == [1, 1, 1, 2, 7]


def test_null_non_finite_covers_all_reals(spark):
    df = spark.createDataFrame([(1, float("nan"), float("inf"), "x")], "a int, b double, c float, d string")
    assert tuple(clean.null_non_finite(df).first()) == (1, None, None, "x")
