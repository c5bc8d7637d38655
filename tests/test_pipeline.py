import os
import uuid
from datetime import date, datetime, timedelta

import pytest

from aeroband.operators.quality import QualityError
from aeroband.plans import pipeline, serving
from aeroband.schemas import WEATHER
from aeroband.sources import raw, snapshot
from aeroband.streaming.refresh import refresh_new_batches
from tests.frames import observation, reading, readings, weather

START = datetime(2024, 1, 10)
POLLUTANTS = ["Ozone", "Particulate Matter < 2.5 µm", "Nitrogen dioxide"]


@pytest.fixture
def layout(spark, tmp_path):
    run = uuid.uuid4().hex
    made = pipeline.Layout(
        str(tmp_path / "readings"), str(tmp_path / "weather"), str(tmp_path / "published"), f"i_{run}", f"m_{run}", f"s_{run}"
    )
    yield made
    for database in (made.intermediate, made.marts, made.state):
        spark.sql(f"drop database if exists {database} cascade")


def batch(spark, day, ingested, add=0.0, pollutants=POLLUTANTS):
    """Three stations, six hours of one day."""
    at = START + timedelta(days=day)
    return readings(spark, *[
        reading(
            station_id=str(s), station_label=f"S{s}", latitude=50.0 + s / 10, longitude=4.0 + s / 10, pollutant=p,
            timestamp=at + timedelta(hours=h), value=7.0 * s + 3 * h + i + add, ingested_at=ingested,
        )
        for s in range(3) for h in range(6) for i, p in enumerate(pollutants)
    ])


def air(spark, day, ingested, add=0.0):
    at = START + timedelta(days=day)
    return weather(spark, *[
        observation(location_name=n, latitude=50.0 + i / 5, timestamp=at + timedelta(hours=h), temperature_2m=h + i + add,
                    ingested_at=ingested)
        for i, n in enumerate(["A", "B"]) for h in range(6)
    ])


def land(spark, layout, day, ingested, add=0.0):
    raw.append_raw(batch(spark, day, ingested, add), layout.readings)
    raw.append_raw(air(spark, day, ingested, add), layout.weather)


def contents(spark, names):
    return {n.split(".")[1]: sorted(map(str, spark.table(n).collect())) for n in names}


def tables_of(layout):
    return [layout.enriched_table, layout.daily_table, layout.summary_table]


def test_full_run_publishes(spark, layout):
    land(spark, layout, 0, START + timedelta(days=1))
    published = pipeline.run_pipeline(spark, layout)
    assert published == sorted(tables_of(layout))
    summary = snapshot.read_snapshot(spark, layout.published, layout.summary_table)
    assert summary.count() == 3
    stored = contents(spark, tables_of(layout))
    assert len(stored["int_air_quality_weather"]) == 54 and len(stored["mart_daily_aqi"]) == 3


def test_failing_check_blocks_publication_and_names_all_failures(spark, layout):
    land(spark, layout, 0, START + timedelta(days=1))
    pipeline.run_pipeline(spark, layout)
    # Unknown labels and days without an index, outside the network's box.
    stray = reading(station_id="x", latitude=40.0, pollutant="Sulphur dioxide", timestamp=START)
    raw.append_raw(readings(spark, stray), layout.readings)
    with pytest.raises(QualityError) as refusal:
        pipeline.run_pipeline(spark, layout)
    assert [(t, c) for t, c, _, _ in refusal.value.failures] == [
        ("staged_readings columns", "accepted_values"), ("daily_index", "between"), ("station_summary", "between"),
    ]
    assert snapshot.read_snapshot(spark, layout.published, layout.summary_table).count() == 3
    assert snapshot.current_version(spark, layout.published).endswith("v00000001")


def test_refresh_of_touched_dates_equals_full_rebuild(spark, layout):
    for day in range(3):
        land(spark, layout, day, START + timedelta(days=day + 1))
    pipeline.run_pipeline(spark, layout)
    old = contents(spark, tables_of(layout))
    # A correction of an old day, a new day, and weather alone for a third one.
    later = START + timedelta(days=9)
    raw.append_raw(batch(spark, 0, later, add=20.0), layout.readings)
    land(spark, layout, 25, later)  # of the next month
    raw.append_raw(air(spark, 2, later, add=5.0), layout.weather)
    pipeline.refresh_dates(spark, layout, since=later.date())
    names = [*tables_of(layout), layout.counts_table, layout.keys_table, layout.months_table]
    refreshed = contents(spark, names)
    reports = sorted(map(str, pipeline.stored_reports(spark, layout).collect()))
    pipeline.run_pipeline(spark, layout)
    assert refreshed == contents(spark, names)
    assert reports == sorted(map(str, pipeline.stored_reports(spark, layout).collect()))
    assert all(refreshed[name] != old[name] for name in old)


def test_refresh_refuses_new_readings_without_time(spark, layout):
    land(spark, layout, 0, START + timedelta(days=1))
    pipeline.run_pipeline(spark, layout)
    later = START + timedelta(days=9)
    raw.append_raw(readings(spark, reading(timestamp=None, ingested_at=later)), layout.readings)
    with pytest.raises(QualityError) as refusal:
        pipeline.refresh_dates(spark, layout, since=later.date())
    assert [(t, c, n) for t, _, c, n in refusal.value.failures] == [
        ("readings_with_weather columns", "measured_at", 1), ("daily_index columns", "measurement_date", 1),
        ("daily_index", "measurement_date", 1),
    ]


def test_refresh_without_new_rows_publishes_the_same(spark, layout):
    land(spark, layout, 0, START + timedelta(days=1))
    pipeline.run_pipeline(spark, layout)
    old = contents(spark, tables_of(layout))
    pipeline.refresh_dates(spark, layout, since=date(2030, 1, 1))
    assert contents(spark, tables_of(layout)) == old


def test_files_drive_the_refresh(spark, layout, tmp_path):
    land(spark, layout, 0, START + timedelta(days=1))
    pipeline.run_pipeline(spark, layout)
    checkpoint = str(tmp_path / "progress")
    assert refresh_new_batches(spark, layout, checkpoint) == 1
    assert refresh_new_batches(spark, layout, checkpoint) == 0
    land(spark, layout, 1, START + timedelta(days=2), add=30.0)
    assert refresh_new_batches(spark, layout, checkpoint) == 1
    refreshed = contents(spark, tables_of(layout))
    assert len(refreshed["mart_daily_aqi"]) == 6
    pipeline.run_pipeline(spark, layout)
    assert refreshed == contents(spark, tables_of(layout))


def test_new_weather_alone_refreshes_its_dates(spark, layout, tmp_path):
    land(spark, layout, 0, START + timedelta(days=1))
    land(spark, layout, 1, START + timedelta(days=2))
    checkpoint = str(tmp_path / "progress")
    pipeline.run_pipeline(spark, layout)
    assert refresh_new_batches(spark, layout, checkpoint) == 1
    # A correction of the first day's weather, ingested before the readings that come next.
    at = START + timedelta(hours=3)
    corrected = weather(spark, observation(timestamp=at, temperature_2m=25.5, ingested_at=START + timedelta(days=3)))
    raw.append_raw(corrected, layout.weather)
    before = contents(spark, tables_of(layout))
    assert refresh_new_batches(spark, layout, checkpoint) == 1
    raw.append_raw(batch(spark, 2, START + timedelta(days=5)), layout.readings)
    assert refresh_new_batches(spark, layout, checkpoint) == 1
    refreshed = contents(spark, tables_of(layout))
    assert refreshed != before
    pipeline.run_pipeline(spark, layout)
    assert refreshed == contents(spark, tables_of(layout))


def test_empty_raw_tables_fail_the_row_count(spark, layout):
    raw.append_raw(batch(spark, 0, START).limit(0), layout.readings)
    raw.append_raw(raw.empty(spark, WEATHER), layout.weather)
    with pytest.raises(QualityError) as refusal:
        pipeline.run_pipeline(spark, layout)
    assert {(t, c) for t, c, _, _ in refusal.value.failures} == {
        ("daily_index", "row_count"), ("station_summary", "row_count"),
    }


def files_by_day(layout, table):
    root = f"{layout.published}/tables/{table.replace('.', '/')}"
    return {version: sorted(n for n in os.listdir(f"{root}/{version}") if "=" in n) for version in sorted(os.listdir(root))}


def test_a_refresh_of_one_day_publishes_and_checks_that_day_only(spark, layout, plan_of, monkeypatch):
    for day in range(4):
        land(spark, layout, day, START + timedelta(days=day + 1))
    pipeline.run_pipeline(spark, layout)
    before = snapshot.read_snapshot(spark, layout.published, layout.daily_table)
    later = START + timedelta(days=9)
    raw.append_raw(batch(spark, 2, later, add=20.0), layout.readings)
    checked = {}
    state_of = pipeline.suite_state
    monkeypatch.setattr(pipeline, "suite_state", lambda df, checks, part: checked.update({len(checked): df}) or state_of(df, checks, part))
    pipeline.refresh_dates(spark, layout, since=later.date())
    for table, column in ((layout.enriched_table, "measured_date"), (layout.daily_table, "measurement_date")):
        assert files_by_day(layout, table)["_version=v00000002"] == [f"{column}=2024-01-12"]
        published = snapshot.read_snapshot(spark, layout.published, table)
        assert sorted(map(str, published.collect())) == sorted(map(str, spark.table(table).select(published.columns).collect()))
    assert before.count() == 12  # the version before is whole still
    # Each model itself is checked, on the day's rows; the summary is one whole.
    assert [df.count() for df in checked.values()] == [54, 12, 54, 3, 3]
    assert "raw_label" in checked[0].columns and "temperature_2m" in checked[1].columns
    daily = snapshot.read_snapshot(spark, layout.published, layout.daily_table)
    plan = plan_of(serving.station_daily(daily, "1", date(2024, 1, 12), date(2024, 1, 12)))
    assert "PartitionFilters: [isnotnull(measurement_date" in plan and "EqualTo(station_id,1)" in plan


def test_a_day_that_was_refused_stays_refused_until_it_is_mended(spark, layout):
    """The state of a bad day is kept: a refresh of another day does not let it pass."""
    land(spark, layout, 0, START + timedelta(days=1))
    pipeline.run_pipeline(spark, layout)
    for day, number in ((5, 3), (6, 4)):
        later = START + timedelta(days=day)
        raw.append_raw(batch(spark, number, later, pollutants=["Black Carbon"] if day == 5 else POLLUTANTS), layout.readings)
        with pytest.raises(QualityError) as refusal:
            pipeline.refresh_dates(spark, layout, since=later.date())
        assert ("daily_index", "between", "belaqi_overall", 3) in refusal.value.failures
    mended = START + timedelta(days=8)
    raw.append_raw(batch(spark, 3, mended), layout.readings)
    pipeline.refresh_dates(spark, layout, since=mended.date())
    # All that was refused meanwhile is published now.
    published = snapshot.read_snapshot(spark, layout.published, layout.daily_table)
    assert sorted(map(str, published.collect())) == sorted(map(str, spark.table(layout.daily_table).select(published.columns).collect()))
