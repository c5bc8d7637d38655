import json
import os
from datetime import date, datetime

import pytest
from pyspark.sql import functions as F

from aeroband.schemas import READINGS, SERIES_DOC, WEATHER, WEATHER_DOC
from aeroband.session import scratch_folder, written_once
from aeroband.sources import landed, raw, snapshot, tables
from tests.frames import observation, reading, readings, weather

RUN = datetime(2024, 2, 1, 6, 17)


# Landed documents

SERIES = {
    "id": "77", "uom": "mg/m³",
    "station": {"properties": {"id": 1063, "label": "Town"}, "geometry": {"coordinates": [4.5, 50.5, "NaN"]}},
    "parameters": {"phenomenon": {"label": "Ozone"}},
    "values": [{"timestamp": 1706677200123, "value": 12.5}, {"timestamp": 1706680800000, "value": None}],
}


def docs(spark, *texts):
    return spark.createDataFrame([(t if isinstance(t, str) else json.dumps(t),) for t in texts], "body string")


def series(spark, *texts):
    good, rejected = landed.parse_docs(docs(spark, *texts), "body", SERIES_DOC)
    return landed.explode_series(good, RUN).collect(), rejected.collect()


def test_series_document(spark):
    rows, rejected = series(spark, SERIES)
    assert not rejected
    assert [tuple(r) for r in rows] == [
        ("1063", "Town", 50.5, 4.5, "Ozone", datetime(2024, 1, 31, 5, 0, 0, 123000), 12.5, "mg/m³", RUN),
        ("1063", "Town", 50.5, 4.5, "Ozone", datetime(2024, 1, 31, 6), None, "mg/m³", RUN),
    ]


def test_series_defaults(spark):
    one = [{"timestamp": 0, "value": 1}]
    rows, rejected = series(spark, {"values": one}, {"uom": None, "station": {"geometry": {"coordinates": []}}, "values": one})
    assert not rejected
    for row in rows:
        assert tuple(row)[:5] == ("", "", None, None, "") and row["unit"] == "µg/m³" and row["value"] == 1.0


def test_series_without_values_and_broken_series(spark):
    rows, rejected = series(spark, {"id": "1"}, {**SERIES, "values": []}, '{"id": "2", "values": [', "nonsense", SERIES)
    assert len(rows) == 2
    assert [r["body"] for r in rejected] == ['{"id": "2", "values": [', "nonsense"]


def test_null_document_is_rejected_not_lost(spark):
    df = spark.createDataFrame([(None,), ("{}",)], "body string")
    good, rejected = landed.parse_docs(df, "body", SERIES_DOC)
    assert (good.count(), rejected.count()) == (1, 1)


def test_weather_document(spark):
    hourly = {
        "time": ["2024-01-31T00:00", "2024-01-31T01:00", "2024-01-31T02:00"],
        "temperature_2m": [1.5, None, 3.5, 99.0], "precipitation": [0.1], "pressure_msl": [],
    }
    landed_docs = docs(spark, {"hourly": hourly}, {}, {"hourly": {"time": []}}, "{").select(
        "body", F.lit("Here").alias("location_name"), F.lit(50.0).alias("latitude"), F.lit(4.0).alias("longitude")
    )
    good, rejected = landed.parse_docs(landed_docs, "body", WEATHER_DOC)
    found = landed.explode_weather(good, RUN)
    assert found.dtypes == [(f.name, f.dataType.simpleString()) for f in WEATHER.fields]
    rows = found.orderBy("timestamp").collect()
    assert [(r["timestamp"].hour, r["temperature_2m"], r["precipitation"], r["pressure_msl"], r["cloud_cover"]) for r in rows] == [
        (0, 1.5, 0.1, None, None), (1, None, None, None, None), (2, 3.5, None, None, None),
    ]
    assert rejected.count() == 1


# Raw tables


def test_append_never_overwrites_and_empty_batches_are_fine(spark, tmp_path):
    path = str(tmp_path / "readings")
    raw.append_raw(raw.empty(spark, READINGS), path)
    assert raw.read_raw(spark, path, READINGS).count() == 0
    first, second = readings(spark, reading()), readings(spark, reading(), reading(ingested_at=datetime(2024, 1, 20)))
    raw.append_raw(first, path)
    raw.append_raw(second, path)
    raw.append_raw(raw.empty(spark, READINGS), path)
    stored = raw.read_raw(spark, path, READINGS)
    assert stored.schema == READINGS and stored.count() == 3
    assert raw.read_raw(spark, path, READINGS, since=date(2024, 1, 20)).count() == 1
    assert sorted(n for n in os.listdir(path) if n.startswith(raw.PARTITION)) == [
        "ingest_date=2024-01-11", "ingest_date=2024-01-20",
    ]
    assert raw.union_raw(first, second, first).count() == 4


def test_raw_scan_prunes_partitions_columns_and_pushes_filters(spark, tmp_path, plan_of):
    path = str(tmp_path / "readings")
    raw.append_raw(readings(spark, reading()), path)
    from aeroband.plans.staging import valid_readings

    plan = plan_of(valid_readings(raw.read_raw(spark, path, READINGS, date(2024, 1, 1))).select("station_id", "value"))
    assert "PartitionFilters: [isnotnull(ingest_date" in plan
    assert "LessThan(value,1000.0)" in plan and "IsNotNull(latitude)" in plan
    assert "station_label" not in plan[plan.index("ReadSchema"):].split("\n")[0]


def test_weather_table(spark, tmp_path):
    path = str(tmp_path / "weather")
    raw.append_raw(weather(spark, observation()), path)
    assert raw.read_raw(spark, path, WEATHER).collect() == weather(spark, observation()).collect()


# Catalog and snapshots


@pytest.fixture
def database(spark, request):
    name = f"db_{abs(hash(request.node.name)) % 10**8}"
    spark.sql(f"create database {name}")
    yield name
    spark.sql(f"drop database {name} cascade")


def one_row(spark, index=3):
    return spark.createDataFrame([(1, index)], "station_id int, belaqi int")


def test_snapshot_copies_tables_but_not_views(spark, database, tmp_path):
    tables.materialise(one_row(spark), f"{database}.mart")
    tables.materialise(one_row(spark), f"{database}.a_second")
    tables.materialise(one_row(spark), "stg_view", "view")
    spark.sql(f"create view {database}.stored_view as select * from {database}.mart")
    assert tables.base_tables(spark, [database]) == [f"{database}.a_second", f"{database}.mart"]
    dest = str(tmp_path / "out")
    assert snapshot.publish_snapshot(spark, [database], dest) == [f"{database}.a_second", f"{database}.mart"]
    assert [tuple(r) for r in snapshot.read_snapshot(spark, dest, f"{database}.mart").collect()] == [(1, 3)]
    assert sorted(os.listdir(f"{dest}/tables/{database}")) == ["a_second", "mart"]


def test_snapshot_is_replaced_and_left_overs_go(spark, database, tmp_path):
    dest = str(tmp_path / "out")
    os.makedirs(f"{dest}/v00000000/half")
    for index in (3, 5, 7):
        tables.materialise(one_row(spark, index), f"{database}.mart")
        snapshot.publish_snapshot(spark, [database], dest)
    assert snapshot.read_snapshot(spark, dest, f"{database}.mart").first()["belaqi"] == 7
    # The one before stays for readers still on it.
    assert sorted(os.listdir(dest)) == ["tables", "v00000002", "v00000003"]
    snapshot.publish_snapshot(spark, [database], dest, keep=1)
    assert sorted(os.listdir(dest)) == ["tables", "v00000004"]
    assert os.listdir(f"{dest}/tables/{database}/mart") == ["_version=v00000004"]
    with pytest.raises(ValueError, match="kept"):
        snapshot.publish_snapshot(spark, [database], dest, keep=0)


def test_source_stays_writable(spark, database, tmp_path):
    tables.materialise(one_row(spark), f"{database}.mart")
    snapshot.publish_snapshot(spark, [database], str(tmp_path / "out"))
    tables.materialise(one_row(spark, 9), f"{database}.mart")
    assert spark.table(f"{database}.mart").first()["belaqi"] == 9
    assert snapshot.read_snapshot(spark, str(tmp_path / "out"), f"{database}.mart").first()["belaqi"] == 3


def test_missing_source_raises(spark, tmp_path):
    with pytest.raises(FileNotFoundError):
        snapshot.publish_snapshot(spark, ["no_such_database"], str(tmp_path / "out"))


def test_empty_source_raises_and_leaves_nothing(spark, database, tmp_path):
    spark.sql(f"create view {database}.only_a_view as select 1 as x")
    with pytest.raises(RuntimeError):
        snapshot.publish_snapshot(spark, [database], str(tmp_path / "out"))
    assert os.listdir(tmp_path) == []


def test_failure_half_way_leaves_the_old_version(spark, database, tmp_path, monkeypatch):
    dest = str(tmp_path / "out")
    tables.materialise(one_row(spark), f"{database}.mart")
    snapshot.publish_snapshot(spark, [database], dest)
    tables.materialise(one_row(spark, 7), f"{database}.mart")
    mark = snapshot.Folder.mark

    def full(folder, name):
        if name.endswith("_PUBLISHED"):
            raise OSError("disk full")
        mark(folder, name)

    monkeypatch.setattr(snapshot.Folder, "mark", full)
    with pytest.raises(OSError):
        snapshot.publish_snapshot(spark, [database], dest)
    assert sorted(os.listdir(dest)) == ["tables", "v00000001"]
    assert os.listdir(f"{dest}/tables/{database}/mart") == ["_version=v00000001"]
    assert snapshot.read_snapshot(spark, dest, f"{database}.mart").first()["belaqi"] == 3


def test_read_published_falls_back(spark, database, tmp_path):
    old, live = str(tmp_path / "old"), str(tmp_path / "live")
    tables.materialise(one_row(spark), f"{database}.mart")
    snapshot.publish_snapshot(spark, [database], old)
    df, is_live = snapshot.read_published(spark, live, old, f"{database}.mart")
    assert (df.first()["belaqi"], is_live) == (3, False)
    tables.materialise(one_row(spark, 7), f"{database}.mart")
    snapshot.publish_snapshot(spark, [database], live)
    df, is_live = snapshot.read_published(spark, live, old, f"{database}.mart")
    assert (df.first()["belaqi"], is_live) == (7, True)
    with pytest.raises(FileNotFoundError):
        snapshot.read_published(spark, str(tmp_path / "a"), str(tmp_path / "b"), f"{database}.mart")


def days_of(spark, *rows):
    return spark.createDataFrame(list(rows), "station_id string, v int, d date")


def folders(dest, table):
    root = f"{dest}/tables/{table.replace('.', '/')}"
    return {version: sorted(os.listdir(f"{root}/{version}")) for version in sorted(os.listdir(root))}


ONE, TWO, THREE = (date(2024, 1, n) for n in (1, 2, 3))


def test_a_version_writes_the_changed_partitions_only(spark, database, tmp_path, plan_of):
    dest, name = str(tmp_path / "out"), f"{database}.days"
    tables.materialise(days_of(spark, ("a", 1, ONE), ("b", 2, TWO), ("a", 3, None)), name, partition_by=["d"])
    tables.materialise(one_row(spark), f"{database}.other")
    snapshot.publish_snapshot(spark, [database], dest, sort_by={name: ["station_id"]})
    before = snapshot.read_snapshot(spark, dest, name)
    tables.replace_partitions(days_of(spark, ("a", 20, TWO), ("c", 4, THREE), ("a", 30, None)), name, ["d"])
    snapshot.publish_snapshot(spark, [database], dest, changed={name: [TWO, THREE, None]})
    found = snapshot.read_snapshot(spark, dest, name)
    assert found.columns == ["station_id", "v", "d"]
    assert sorted(map(str, found.collect())) == sorted(map(str, spark.table(name).collect()))
    written = {v: [f for f in own if f.startswith("d=")] for v, own in folders(dest, name).items()}
    null = "d=__HIVE_DEFAULT_PARTITION__"
    assert written == {
        "_version=v00000001": ["d=2024-01-01", "d=2024-01-02", null], "_version=v00000002": ["d=2024-01-02", "d=2024-01-03", null],
    }
    assert list(folders(dest, f"{database}.other")) == ["_version=v00000001"]
    # A reader still on the version before sees it unchanged.
    assert sorted(r["v"] for r in before.collect()) == [1, 2, 3]
    plan = plan_of(found.filter(F.col("d") >= F.lit(TWO)))
    assert "PartitionFilters: [isnotnull(d" in plan
    # What only the outdated version used goes, the rest stays.
    snapshot.publish_snapshot(spark, [database], dest, keep=1, changed={})
    assert [f for f in folders(dest, name)["_version=v00000001"] if "=" in f] == ["d=2024-01-01"]
    assert sorted(r["v"] for r in snapshot.read_snapshot(spark, dest, name).collect()) == [1, 4, 20, 30]


def test_a_partition_that_vanished_is_no_longer_published(spark, database, tmp_path):
    dest, name = str(tmp_path / "out"), f"{database}.days"
    tables.materialise(days_of(spark, ("a", 1, ONE), ("b", 2, TWO)), name, partition_by=["d"])
    snapshot.publish_snapshot(spark, [database], dest)
    tables.materialise(days_of(spark, ("a", 1, ONE)), name, partition_by=["d"])
    snapshot.publish_snapshot(spark, [database], dest, changed={name: [TWO]})
    assert [r["v"] for r in snapshot.read_snapshot(spark, dest, name).collect()] == [1]
    # All partitions gone: typed and empty.
    tables.materialise(days_of(spark), name, partition_by=["d"])
    snapshot.publish_snapshot(spark, [database], dest, changed={name: [ONE]})
    found = snapshot.read_snapshot(spark, dest, name)
    assert not found.collect() and found.dtypes == [("station_id", "string"), ("v", "int"), ("d", "date")]


def test_a_changed_schema_is_written_anew(spark, database, tmp_path):
    dest, name = str(tmp_path / "out"), f"{database}.days"
    tables.materialise(days_of(spark, ("a", 1, ONE), ("b", 2, TWO)), name, partition_by=["d"])
    snapshot.publish_snapshot(spark, [database], dest)
    tables.materialise(days_of(spark, ("a", 1, ONE), ("b", 2, TWO)).selectExpr("v", "'x' as w", "d"), name, partition_by=["d"])
    snapshot.publish_snapshot(spark, [database], dest, changed={name: [TWO]})
    assert sorted(r["v"] for r in snapshot.read_snapshot(spark, dest, name).filter("w = 'x'").collect()) == [1, 2]


def test_publishers_do_not_disturb_each_other(spark, database, tmp_path, monkeypatch):
    dest = str(tmp_path / "out")
    tables.materialise(one_row(spark, 1), f"{database}.mart")
    snapshot.publish_snapshot(spark, [database], dest)
    # Another one is at work on the next version, and a third died long ago.
    for version in ("v00000002", "v00000003"):
        os.makedirs(f"{dest}/{version}")
        open(f"{dest}/{version}/_CLAIMED", "w").close()
        os.makedirs(f"{dest}/tables/{database}/mart/_version={version}")
    os.utime(f"{dest}/v00000002/_CLAIMED", (0, 0))
    snapshot.publish_snapshot(spark, [database], dest)
    assert sorted(os.listdir(dest)) == ["tables", "v00000001", "v00000003", "v00000004"]
    assert "_version=v00000003" in folders(dest, f"{database}.mart")
    # One that is overtaken while it writes gives up.
    write_text = snapshot.Folder.write_text

    def overtaken(folder, name, text):
        write_text(folder, name, text)
        if name.startswith("v00000005"):
            open(f"{dest}/v00000003/_PUBLISHED", "w").close()

    monkeypatch.setattr(snapshot.Folder, "write_text", overtaken)
    with pytest.raises(snapshot.PublicationConflict):
        snapshot.publish_snapshot(spark, [database], dest)
    assert "v00000005" not in os.listdir(dest)


def test_an_empty_partitioned_batch_keeps_its_schema(spark, tmp_path):
    path = str(tmp_path / "readings")
    raw.append_raw(raw.empty(spark, READINGS), path)
    assert raw.read_raw(spark, path).schema == READINGS and not raw.read_raw(spark, path).collect()
    raw.append_raw(readings(spark, reading()), path)
    assert raw.read_raw(spark, path).collect() == readings(spark, reading()).collect()


def test_two_writers_in_one_session(spark, database):
    """One replaces partitions while another overwrites a whole table: neither changes how the other writes."""
    from concurrent.futures import ThreadPoolExecutor

    for name in ("one", "two"):
        tables.materialise(days_of(spark, ("a", 1, ONE), ("b", 2, TWO)), f"{database}.{name}", partition_by=["d"])
    with ThreadPoolExecutor(2) as pool:
        for n in range(3):
            changed = pool.submit(tables.replace_partitions, days_of(spark, ("b", 20 + n, TWO)), f"{database}.one", ["d"])
            whole = pool.submit(tables.materialise, days_of(spark, ("c", n, THREE)), f"{database}.two", "table", ["d"])
            changed.result(), whole.result()
            assert sorted(r["v"] for r in spark.table(f"{database}.one").collect()) == [1, 20 + n]
            assert [r["v"] for r in spark.table(f"{database}.two").collect()] == [n]


def test_partitions_are_replaced_one_by_one(spark, database):
    days = spark.createDataFrame([("2024-01-01", 1), ("2024-01-02", 2)], "d string, v int").withColumn("d", F.col("d").cast("date"))
    tables.materialise(days, f"{database}.days", partition_by=["d"])
    changed = days.filter("v = 2").withColumn("v", F.lit(20))
    before = spark.conf.get("spark.sql.sources.partitionOverwriteMode")
    tables.replace_partitions(changed, f"{database}.days", ["d"])
    assert sorted(r["v"] for r in spark.table(f"{database}.days").collect()) == [1, 20]
    assert spark.conf.get("spark.sql.sources.partitionOverwriteMode") == before
    # A full rebuild also removes what is no longer there.
    tables.materialise(days.filter("v = 1"), f"{database}.days", partition_by=["d"])
    assert [r["v"] for r in spark.table(f"{database}.days").collect()] == [1]
    with pytest.raises(ValueError):
        tables.materialise(days, f"{database}.days", kind="index")


def test_scratch_folder_is_the_shared_one(spark):
    assert scratch_folder(spark).startswith(spark.conf.get("spark.checkpoint.dir"))
    assert written_once(spark.range(3)).count() == 3
