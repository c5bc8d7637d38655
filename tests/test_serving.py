from datetime import date

import pytest
from pyspark.sql import functions as F

from aeroband.operators import geosearch, reshape
from aeroband.plans import serving

STATIONS = [
    # An equal point whose cosine rounds to just above 1.
    ("13", "Here", 50.31, 5.390000000000001, 4.0, 10),
    ("14", "Twin", 50.31, 5.390000000000001, 7.5, 9),
    ("2", "North", 50.36, 5.390000000000001, None, 8),
    ("3", "Nowhere", None, 5.39, 2.0, 7),
    ("4", "North", 51.31, 5.39, 1.0, 6),
]


@pytest.fixture
def summary(spark):
    return spark.createDataFrame(
        STATIONS,
        "station_id string, station_label string, station_lat double, station_lon double, mean_belaqi double, "
        "days_with_data int",
    )


def ids(df):
    return [r["station_id"] for r in df.collect()]


def test_stations(summary):
    assert ids(serving.stations(summary)) == ["14", "13", "3", "4", "2"]
    assert ids(serving.stations(summary, 4)) == ["14", "13"]
    for bad in (0, 11):
        with pytest.raises(ValueError):
            serving.stations(summary, bad)


def test_station_daily(spark):
    days = spark.createDataFrame(
        [("a", f"2024-01-0{d}") for d in range(1, 6)] + [("b' or '1'='1", "2024-01-01")], "station_id string, d string"
    ).select(
        "station_id", F.col("d").cast("date").alias("measurement_date"),
        *[F.lit(None).alias(c) for c in ("station_label", "station_lat", "station_lon")],
    )
    day = lambda *args: [r["measurement_date"].day for r in serving.station_daily(days, *args).collect()]
    assert day("a") == [5, 4, 3, 2, 1]
    assert day("a", date(2024, 1, 2), date(2024, 1, 4)) == [4, 3, 2]
    assert day("a", None, date(2024, 1, 1)) == [1]
    assert day("b' or '1'='1") == [1] and day("nobody") == []


def test_nearby_finds_a_station_at_the_point_itself(summary):
    found = serving.nearby(summary, 50.31, 5.390000000000001, radius_km=10)
    assert ids(found) == ["13", "14", "2"]
    assert found.first()["distance_km"] < 0.001
    assert ids(serving.nearby(summary, 50.31, 5.390000000000001, radius_km=10, limit=1)) == ["13"]
    assert ids(serving.nearby(summary, 50.31, 5.39, radius_km=200)) == ["13", "14", "2", "4"]
    for bad in (0, 51):
        with pytest.raises(ValueError):
            serving.nearby(summary, 50.0, 5.0, limit=bad)


def test_radius_filter_equals_the_plain_distance_filter(spark):
    grid = spark.range(0, 8000).select(
        F.col("id").alias("station_id"),
        (F.col("id") % 89 * 2.03 - 89).alias("station_lat"), (F.col("id") / 89 * 4 - 180).alias("station_lon"),
    )
    for lat, lon, radius in [(50.0, 4.0, 900.0), (88.0, 0.0, 1500.0), (-60.0, 179.0, 700.0), (0.0, 0.0, 0.0)]:
        plain = geosearch.with_distance(grid, lat, lon).filter(F.col("distance_km") <= radius)
        strip = geosearch.within_radius(grid, lat, lon, radius)
        assert sorted(ids(plain)) == sorted(ids(strip))


def test_radius_filter_reaches_the_scan(spark, summary, tmp_path, plan_of):
    summary.write.parquet(str(tmp_path / "s"))
    stored = spark.read.parquet(str(tmp_path / "s"))
    plan = plan_of(serving.nearby(stored, 50.0, 5.0).select("station_id"))
    assert "GreaterThanOrEqual(station_lat" in plan and "TakeOrderedAndProject" in plan
    assert "station_label" not in plan[plan.index("ReadSchema"):].split("\n")[0]


def test_nearest_row(summary):
    assert ids(geosearch.nearest_row(summary, 50.3, 5.4)) == ["13"]
    assert ids(geosearch.nearest_row(summary, 52.0, 5.4)) == ["4"]
    assert ids(geosearch.nearest_row(summary.filter("station_lat is null"), 52.0, 5.4)) == []


def test_labels(summary):
    assert ids(serving.id_for_label(summary, "North")) == ["2"]
    assert ids(serving.id_for_label(summary, "South")) == []
    assert serving.station_options(summary.union(summary)).count() == 5


def test_mean_index_range(summary):
    chosen = serving.mean_index_range(summary, 2.0, 4.0)
    assert sorted(ids(chosen)) == ["13", "3"]
    assert serving.selected_count(chosen).first()["stations"] == 2
    assert serving.mean_index_range(summary).count() == 4


def test_overview_takes_the_columns_there_are(summary):
    assert serving.overview(summary).columns == ["station_label", "mean_belaqi", "days_with_data"]


def test_health(spark):
    days = spark.sql("select date'2024-01-02' as measurement_date union all select date'2024-01-05'")
    assert serving.health(lambda: days) == {"status": "healthy", "latest_data": date(2024, 1, 5)}
    assert serving.health(lambda: days.limit(0)) == {"status": "healthy", "latest_data": None}
    missing = serving.health(lambda: spark.read.parquet("/no/such/folder"))
    assert missing["status"] == "unhealthy" and "/no/such/folder" in missing["error"]
    first = serving.date_range(days).first()
    assert (first["earliest_data"], first["latest_data"]) == (date(2024, 1, 2), date(2024, 1, 5))


def test_pairs_and_series(spark):
    df = spark.createDataFrame([(1, 1.0, None, None), (2, None, 5.0, None), (3, 2.0, 6.0, None)], "i int, a double, b double, c double")
    assert [tuple(r) for r in reshape.pairs(df, "a", "b").collect()] == [(2.0, 6.0)]
    assert reshape.non_empty_columns(df, ["c", "b", "absent", "a"]) == ["b", "a"]
    assert reshape.non_empty_columns(df, ["absent"]) == []
    series = reshape.to_series(df, ["i"], {"A": "a", "B₂": "b", "C": "c"})
    assert sorted(map(tuple, series.collect()), key=str) == sorted(
        [(1, "A", 1.0), (1, "B₂", None), (2, "A", None), (2, "B₂", 5.0), (3, "A", 2.0), (3, "B₂", 6.0)], key=str
    )
    assert reshape.to_series(df, ["i"], {"C": "c"}).count() == 0
    # A series name may hold a dot.
    assert {r["series"] for r in reshape.to_series(df, ["i"], {"PM2.5": "a"}).collect()} == {"PM2.5"}
