"""The registered queries: each runs over whole tables and returns a DataFrame, and has a twin in ``sql.py``."""

from datetime import date, datetime
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from aeroband.functions.bands import band_colour, band_index, index_label, worst_of
from aeroband.functions.labels import standardise
from aeroband.operators import clean, geosearch, reshape
from aeroband.operators.aggregates import mean_where, row_count
from aeroband.operators.latest import dedupe_latest
from aeroband.operators.nearest import NearestLimits
from aeroband.operators.quality import QualityError, run_suite
from aeroband.plans import checks, marts, pipeline, serving, staging
from aeroband.plans import enriched as enrichment
from aeroband.schemas import BAND_BOUNDS, DEFAULT_POLLUTANTS, READINGS, READINGS_SOURCE, SERIES_COLUMNS, SERIES_DOC, WEATHER, WEATHER_DOC
from aeroband.schemas import WEATHER_VARIABLES
from aeroband.session import scratch_folder, written_once
from aeroband.sources import landed as landed_docs
from aeroband.sources import raw, snapshot, tables
from aeroband.sources.files import Folder
from aeroband.streaming.refresh import refresh_new_batches
from checks.inputs import again, readings, table, weather

# Parameters of the queries, shared with their SQL twins.
LOOKBACK_END = datetime(2024, 1, 15, 12, 0, 0)
LOOKBACK_HOURS = 30
STATION = "7"
STATION_FIRST, STATION_LAST = date(2024, 1, 5), date(2024, 1, 25)
POINT = (50.85, 4.35)
EXACT_POINT = (50.31, 5.390000000000001)
MIN_INDEX = 4
INDEX_RANGE = (2.5, 6.0)
RUN_TIME = datetime(2024, 2, 1, 6, 17, 0)
CROWDED_HOUR = datetime(2024, 1, 9, 7, 0, 0)

DAILY_REALS = [
    "avg_pm25", "avg_pm10", "avg_no2", "avg_o3",
    "avg_temperature", "avg_humidity", "avg_wind_speed", "avg_boundary_layer", "total_precipitation",
]


def rounded(df: DataFrame, columns: list[str], digits: int = 6) -> DataFrame:
    return df.withColumns({c: F.round(c, digits) for c in columns})


def enriched(spark, sf_dir):
    return enrichment.enriched(readings(spark, sf_dir), weather(spark, sf_dir))


def daily(spark, sf_dir):
    return marts.daily_index(enriched(spark, sf_dir))


def summary(spark, sf_dir):
    return marts.station_summary(daily(spark, sf_dir))


# Staging


def valid_readings(spark, sf_dir):
    valid = staging.valid_readings(readings(spark, sf_dir))
    return valid.select(
        "station_id", "station_label", "latitude", "longitude", "pollutant",
        F.col("timestamp").alias("measured_at"), F.col("value").alias("measurement_value"),
        F.lit(READINGS_SOURCE).alias("data_source"),
    )


def standard_labels(spark, sf_dir):
    labels = readings(spark, sf_dir).select("pollutant").unionByName(
        table(spark, sf_dir, "part").select(F.col("p_type").alias("pollutant"))
    )
    # Counted per raw label first: the rules then run once per label.
    return labels.groupBy(F.col("pollutant").alias("raw_label")).agg(row_count("n")).select(
        "raw_label", standardise("raw_label").alias("pollutant"), "n"
    )


def dedupe_latest_readings(spark, sf_dir):
    return staging.staged_readings(again(readings(spark, sf_dir), "value"))


def dedupe_latest_weather(spark, sf_dir):
    return staging.staged_weather(again(weather(spark, sf_dir), "temperature_2m"))


def dedupe_latest_orders(spark, sf_dir):
    return dedupe_latest(table(spark, sf_dir, "orders"), ["o_custkey"], "o_orderdate", ["o_orderkey"])


def label_allow_list(spark, sf_dir):
    chosen = clean.filter_labels(readings(spark, sf_dir), "pollutant", ["PM2.5", "NO2", "BC", "no such pollutant"])
    return chosen.groupBy("station_id", "pollutant").agg(row_count("n"))


def label_allow_list_default(spark, sf_dir):
    return clean.filter_labels(readings(spark, sf_dir), "pollutant").groupBy("pollutant").agg(row_count("n"))


def lookback_window(spark, sf_dir):
    events = table(spark, sf_dir, "events").withColumn("ts", F.col("ts").cast("timestamp_ntz"))
    recent = clean.filter_lookback(events, "ts", LOOKBACK_END, LOOKBACK_HOURS)
    return recent.select("event_id", "ts", "user_id", "value")


def lookback_days(spark, sf_dir):
    days = clean.lookback_days(LOOKBACK_HOURS)
    recent = clean.filter_lookback_days(weather(spark, sf_dir), "timestamp", LOOKBACK_END, days)
    return recent.select("location_name", "timestamp", "temperature_2m")


# Joins


def hour_join(spark, sf_dir):
    joined = enrichment.hour_joined(
        staging.staged_readings(readings(spark, sf_dir)), staging.staged_weather(weather(spark, sf_dir))
    )
    return rounded(
        joined.select("station_id", "pollutant", "measured_at", "weather_rows", "hour_temperature"), ["hour_temperature"]
    )


def nearest_weather(spark, sf_dir):
    return enriched(spark, sf_dir)


def nearest_weather_shuffled(spark, sf_dir):
    """The same, as if the weather were too large to broadcast."""
    return enrichment.enriched(
        readings(spark, sf_dir), weather(spark, sf_dir), limits=NearestLimits(broadcast_bytes=0)
    )


def nearest_weather_grid(spark, sf_dir):
    """The same, as if an hour held too many locations for a list."""
    return enrichment.enriched(
        readings(spark, sf_dir), weather(spark, sf_dir), limits=NearestLimits(per_chunk=2)
    )


def crowded_weather(spark, sf_dir):
    """The weather, with a location for each supplier in one hour, and one far off all others in every hour."""
    air = weather(spark, sf_dir)
    values = [v for v in WEATHER_VARIABLES if v != "temperature_2m"]
    crowd = table(spark, sf_dir, "supplier").selectExpr(
        "concat('Supplier ', s_suppkey) as location_name", "49.5D + (s_suppkey * 37 % 1999) / 1000D as latitude",
        "2.5D + (s_suppkey * 53 % 3989) / 1000D as longitude", f"timestamp_ntz'{CROWDED_HOUR}' as timestamp",
        "cast(s_suppkey as double) as temperature_2m", *[f"0D as {v}" for v in values],
        f"timestamp_ntz'{CROWDED_HOUR}' as ingested_at",
    )
    far = air.select("timestamp").distinct().selectExpr(
        "'Far' as location_name", "-89D as latitude", "179D as longitude", "timestamp",
        *[f"-1D as {v}" for v in WEATHER_VARIABLES], "timestamp as ingested_at",
    )
    return air.unionByName(crowd).unionByName(far)


def nearest_weather_crowded(spark, sf_dir):
    """One hour with very many locations, and an outlier."""
    return enrichment.enriched(readings(spark, sf_dir), crowded_weather(spark, sf_dir))


def colliding(df):
    """``df``, and some of its readings once more under another label of the same pollutant, moved a little."""
    moved = df.filter(F.hour("timestamp") % 4 == 0).withColumns(
        {
            "pollutant": F.concat(standardise("pollutant"), F.lit(" mobile no2 o3 pm10")),
            "latitude": F.col("latitude") + F.lit(0.25),
            "value": F.col("value") + F.lit(1.0),
        }
    )
    return df.unionByName(moved)


def nearest_weather_collapsed(spark, sf_dir):
    """Several raw labels of one pollutant: the reading nearest to its weather wins."""
    return enrichment.enriched(colliding(readings(spark, sf_dir)), weather(spark, sf_dir))


# Marts


def daily_index(spark, sf_dir):
    return rounded(daily(spark, sf_dir), DAILY_REALS)


def station_summary(spark, sf_dir):
    return summary(spark, sf_dir)


def band_index_lineitem(spark, sf_dir):
    banded = table(spark, sf_dir, "lineitem").select(
        band_index("l_quantity", BAND_BOUNDS["PM2.5"]).alias("band_quantity"),
        band_index("(l_extendedprice / 1000D)", BAND_BOUNDS["PM10"]).alias("band_price"),
    )
    overall = banded.withColumn("band_overall", worst_of("band_quantity", "band_price"))
    counted = overall.groupBy("band_quantity", "band_price", "band_overall").agg(row_count("n"))
    return counted.withColumn("label", index_label("band_overall"))


def conditional_pivot(spark, sf_dir):
    flag, quantity = F.col("l_returnflag"), F.col("l_quantity")
    pivoted = table(spark, sf_dir, "lineitem").groupBy(
        "l_suppkey", F.year("l_shipdate").alias("ship_year"), F.month("l_shipdate").alias("ship_month")
    ).agg(
        *[mean_where(flag == F.lit(f), quantity).alias(f"mean_quantity_{f.lower()}") for f in ("A", "N", "R")],
        row_count("n"),
    )
    return rounded(pivoted, ["mean_quantity_a", "mean_quantity_n", "mean_quantity_r"])


# Serving


def stations_min_index(spark, sf_dir):
    return serving.stations(summary(spark, sf_dir), MIN_INDEX)


def station_daily_range(spark, sf_dir):
    days = serving.station_daily(daily(spark, sf_dir), STATION, STATION_FIRST, STATION_LAST)
    return rounded(days, DAILY_REALS)


def in_order(df):
    """With the place of each row in the answer, which is small enough for one task."""
    return df.coalesce(1).withColumn("place", F.monotonically_increasing_id())


def stations_in_order(spark, sf_dir):
    return in_order(serving.stations(summary(spark, sf_dir))).select("place", "station_id", "mean_belaqi")


def station_daily_in_order(spark, sf_dir):
    days = in_order(serving.station_daily(daily(spark, sf_dir), STATION, STATION_FIRST))
    return days.select("place", "measurement_date", "belaqi_overall")


def overview_in_order(spark, sf_dir):
    return in_order(serving.overview(summary(spark, sf_dir))).select("place", "station_label", "mean_belaqi")


def station_daily_all(spark, sf_dir):
    return rounded(serving.station_daily(daily(spark, sf_dir), STATION), DAILY_REALS)


def nearby(spark, sf_dir):
    found = serving.nearby(summary(spark, sf_dir), *POINT, radius_km=60, limit=25)
    return rounded(found.select("station_id", "station_label", "distance_km"), ["distance_km"], 2)


def nearby_exact_point(spark, sf_dir):
    found = serving.nearby(summary(spark, sf_dir), *EXACT_POINT, radius_km=0.5, limit=50)
    return rounded(found.select("station_id", "station_label", "distance_km"), ["distance_km"], 2)


def distance_to_point(spark, sf_dir):
    far = geosearch.with_distance(summary(spark, sf_dir), *POINT)
    return rounded(far.select("station_id", "station_lat", "station_lon", "distance_km"), ["distance_km"], 2)


def nearest_station_to_point(spark, sf_dir):
    closest = geosearch.nearest_row(serving.mean_index_range(summary(spark, sf_dir)), *POINT)
    return closest.select("station_id", "station_label", "station_lat", "station_lon", "mean_belaqi")


def label_to_id(spark, sf_dir):
    return serving.id_for_label(summary(spark, sf_dir), f"Station {STATION}")


def station_options(spark, sf_dir):
    return serving.station_options(summary(spark, sf_dir))


def mean_index_range(spark, sf_dir):
    return serving.mean_index_range(summary(spark, sf_dir), *INDEX_RANGE).select("station_id", "mean_belaqi")


def selected_count(spark, sf_dir):
    return serving.selected_count(serving.mean_index_range(summary(spark, sf_dir), *INDEX_RANGE))


def overview(spark, sf_dir):
    return serving.overview(summary(spark, sf_dir))


def band_colours(spark, sf_dir):
    return summary(spark, sf_dir).select("station_id", "mean_belaqi", band_colour("mean_belaqi").alias("colour"))


def pollutant_series_long(spark, sf_dir):
    series = reshape.to_series(daily(spark, sf_dir), ["station_id", "station_lat", "measurement_date"], SERIES_COLUMNS)
    return rounded(series, ["value"])


def wind_vs_index_pairs(spark, sf_dir):
    return rounded(reshape.pairs(daily(spark, sf_dir), "avg_wind_speed", "belaqi_overall"), ["avg_wind_speed"])


def boundary_vs_pm25_pairs(spark, sf_dir):
    found = reshape.pairs(daily(spark, sf_dir), "avg_boundary_layer", "avg_pm25")
    return rounded(found, ["avg_boundary_layer", "avg_pm25"])


def latest_date(spark, sf_dir):
    return serving.date_range(daily(spark, sf_dir))


def null_non_finite(spark, sf_dir):
    odd = table(spark, sf_dir, "events").selectExpr(
        "event_id",
        """case when event_id % 7 = 0 then double('NaN') when event_id % 11 = 0 then double('Infinity')
          when event_id % 13 = 0 then double('-Infinity') else value end as value""",
    )
    return clean.null_non_finite(odd)


# Landed documents


# Milliseconds of a zone-less ts, whatever the session zone.
EPOCH_MS = """unix_date(cast(ts as date)) * 86400000L + hour(ts) * 3600000 + minute(ts) * 60000
  + cast(floor(extract(second from ts) * 1000) as bigint)"""


def series_docs(spark, sf_dir):
    """Events as JSON documents, one per station, pollutant and block of event ids, so at most 4096 values each.
    Some lack the unit, some the position, and some are cut off."""
    packed = table(spark, sf_dir, "events").groupBy(
        "user_id", "event_type", F.expr("event_id div 4096").alias("block")
    ).agg(F.expr(f"collect_list(named_struct('timestamp', {EPOCH_MS}, 'value', value))").alias("vs"))
    return packed.selectExpr(
        """to_json(named_struct(
          'id', concat_ws('-', user_id, event_type, block),
          'uom', case when user_id % 9 <> 4 then 'mg/m³' end,
          'station', named_struct(
            'properties', named_struct('id', string(user_id), 'label', concat('Station ', user_id)),
            'geometry', case when user_id % 7 <> 5
              then named_struct('coordinates', array(user_id / 100D, user_id / 50D)) end),
          'parameters', named_struct('phenomenon', named_struct('label', event_type)),
          'values', vs)) as whole""",
        "(user_id + block) % 10 = 3 as cut",
    ).selectExpr("case when cut then left(whole, length(whole) - 3) else whole end as body")


def series_json_explode(spark, sf_dir):
    good, _ = landed_docs.parse_docs(series_docs(spark, sf_dir), "body", SERIES_DOC, landed_docs.readable_series)
    return landed_docs.explode_series(good, RUN_TIME)


def series_json_rejected(spark, sf_dir):
    good, rejected = landed_docs.parse_docs(series_docs(spark, sf_dir), "body", SERIES_DOC, landed_docs.readable_series)
    counted = [
        df.agg(row_count("documents")).select(F.lit(kind).alias("kind"), "documents")
        for kind, df in (("good", good), ("rejected", rejected))
    ]
    return counted[0].unionByName(counted[1])


def weather_docs(spark, sf_dir):
    """Weather as JSON documents, one per location and day, so at most 24 hours each. The precipitation array is one
    short, and odd days lack the cloud cover."""
    days = weather(spark, sf_dir).groupBy(
        "location_name", "latitude", "longitude", F.col("timestamp").cast("date").alias("day")
    ).agg(F.array_sort(F.collect_list(F.struct("timestamp", *WEATHER_VARIABLES))).alias("hours"))
    arrays = {v: f"hours.{v}" for v in WEATHER_VARIABLES}
    arrays["precipitation"] = "slice(hours.precipitation, 1, size(hours) - 1)"
    arrays["cloud_cover"] = "case when day(day) % 2 = 0 then hours.cloud_cover end"
    fields = ", ".join(f"'{name}', {array}" for name, array in arrays.items())
    return days.selectExpr(
        "location_name", "latitude", "longitude",
        f"""to_json(named_struct('hourly', named_struct(
          'time', transform(hours.timestamp, t -> date_format(t, "yyyy-MM-dd'T'HH:mm")), {fields}))) as body""",
    )


def weather_json_explode(spark, sf_dir):
    good, _ = landed_docs.parse_docs(weather_docs(spark, sf_dir), "body", WEATHER_DOC, landed_docs.readable_weather)
    return landed_docs.explode_weather(good, RUN_TIME)


def weather_json_rejected(spark, sf_dir):
    """Documents with a time that cannot be read, and ones cut off, are set aside; the others' hours are taken."""
    docs = weather_docs(spark, sf_dir).withColumn("n", F.dayofmonth(F.expr("try_cast(substr(get_json_object(body, '$.hourly.time[0]'), 1, 10) as date)")))
    spoilt = docs.withColumn("body", F.expr(r"""case
      when n % 7 = 3 then regexp_replace(body, '"time":\\["[^"]*"', '"time":["soon"')
      when n % 7 = 5 then left(body, length(body) - 2) else body end"""))
    good, rejected = landed_docs.parse_docs(spoilt, "body", WEATHER_DOC, landed_docs.readable_weather)
    hours = landed_docs.explode_weather(good, RUN_TIME).groupBy("location_name").agg(row_count("hours"))
    return rejected.groupBy("location_name").agg(row_count("rejected")).join(hours, "location_name", "full")


def series_json_bad_times(spark, sf_dir):
    """Series documents with an epoch beyond all dates in otherwise good JSON are set aside."""
    docs = series_docs(spark, sf_dir).withColumn("id", F.get_json_object("body", "$.id")).withColumn(
        "odd", F.expr("(cast(split_part(id, '-', 1) as int) + cast(split_part(id, '-', 3) as int)) % 10 = 6")
    )
    spoilt = docs.withColumn("body", F.expr(
        r"""case when odd then regexp_replace(body, '"timestamp":([0-9]+)', '"timestamp":$1000000') else body end"""
    ))
    good, rejected = landed_docs.parse_docs(spoilt, "body", SERIES_DOC, landed_docs.readable_series)
    readings_kept = landed_docs.explode_series(good, RUN_TIME).agg(row_count("n")).select(F.lit("readings").alias("kind"), "n")
    kinds = [df.agg(row_count("n")).select(F.lit(kind).alias("kind"), "n") for kind, df in (("good", good), ("rejected", rejected))]
    return reduce(DataFrame.unionByName, [*kinds, readings_kept])


def parallel_arrays_flatten(spark, sf_dir):
    """Events as arrays, at most 1024 per user and block of event ids; one array is short, one is long, one missing."""
    packed = table(spark, sf_dir, "events").groupBy("user_id", F.expr("event_id div 1024").alias("block")).agg(
        F.array_sort(F.collect_list(F.struct("event_id", "value", "event_type"))).alias("e")
    )
    return landed_docs.flatten_parallel_arrays(
        packed,
        index=F.col("e.event_id"),
        arrays={
            "value": F.expr("slice(e.value, 1, size(e) - 1)"),
            "event_type": F.expr("concat(e.event_type, array('surplus'))"),
            "missing": F.lit(None).cast("array<double>"),
        },
        keep=["user_id"],
        index_name="event_id",
    )


# Tables and snapshots


def typed_empty_roundtrip(spark, sf_dir):
    """A batch without rows, then one with: the empty one is no obstacle and adds nothing."""
    path = f"{scratch_folder(spark)}/readings"
    raw.append_raw(raw.empty(spark, READINGS), path)
    raw.append_raw(readings(spark, sf_dir), path)
    return raw.read_raw(spark, path, READINGS)


def union_raw_batches(spark, sf_dir):
    """Two batches of the same rows, appended one after the other, next to a union of DataFrames."""
    rows = readings(spark, sf_dir)
    path = f"{scratch_folder(spark)}/readings"
    raw.append_raw(rows, path)
    raw.append_raw(again(rows, "value"), path)
    united = raw.union_raw(raw.read_raw(spark, path, READINGS), rows)
    return united.groupBy("station_id", "pollutant").agg(
        row_count("n"), F.min("ingested_at").alias("first_ingest"), F.max("ingested_at").alias("last_ingest")
    )


def new_layout(spark):
    """Folders and databases of their own for one run."""
    folder = scratch_folder(spark)
    run = folder.rstrip("/").split("/")[-1].replace("-", "_").lower()
    layout = pipeline.Layout(
        readings=f"{folder}/readings", weather=f"{folder}/weather", published=f"{folder}/published",
        intermediate=f"intermediate_{run}", marts=f"marts_{run}", state=f"state_{run}",
    )
    for database in (layout.intermediate, layout.marts, layout.state):
        spark.sql(f"create database {database} location '{folder}/{database}'")
    return layout


def snapshot_roundtrip(spark, sf_dir):
    """The daily mart, materialised, published, and read back from the published folder."""
    layout = new_layout(spark)
    tables.materialise(daily(spark, sf_dir), layout.daily_table, partition_by=["measurement_date"])
    tables.materialise(marts.station_summary(spark.table(layout.daily_table)), layout.summary_table)
    snapshot.publish_snapshot(spark, [layout.marts], layout.published)
    stored, is_live = snapshot.read_published(spark, layout.published, f"{layout.published}/old", layout.daily_table)
    return rounded(stored, DAILY_REALS).withColumn("is_live", F.lit(is_live))


def landed(spark, sf_dir, pollutants):
    """The readings of the series that a run asked for."""
    return clean.filter_labels(readings(spark, sf_dir), "pollutant", pollutants)


def published_summary(spark, sf_dir):
    """The whole refresh of the default pollutants: land, rebuild, check, publish; then the published summary."""
    layout = new_layout(spark)
    raw.append_raw(landed(spark, sf_dir, DEFAULT_POLLUTANTS), layout.readings)
    raw.append_raw(weather(spark, sf_dir), layout.weather)
    pipeline.run_pipeline(spark, layout)
    return snapshot.read_snapshot(spark, layout.published, layout.summary_table)


def refused_publication(spark, sf_dir):
    """The same with all readings, some days of which have no index: what the refusal names, and nothing published."""
    layout = new_layout(spark)
    raw.append_raw(readings(spark, sf_dir), layout.readings)
    raw.append_raw(weather(spark, sf_dir), layout.weather)
    failures = []
    try:
        pipeline.run_pipeline(spark, layout)
    except QualityError as refusal:
        failures = refusal.failures
    is_published = Folder(spark, layout.published).exists()
    schema = "table_name string, check_name string, column_name string, violations long"
    return spark.createDataFrame(failures, schema).withColumn("is_published", F.lit(is_published))


def landed_first(spark, sf_dir, layout):
    """A full refresh of the default pollutants, and corrections of some hours that have come in since."""
    first = landed(spark, sf_dir, DEFAULT_POLLUTANTS)
    raw.append_raw(first, layout.readings)
    raw.append_raw(weather(spark, sf_dir), layout.weather)
    pipeline.run_pipeline(spark, layout)
    return again(first, "value").filter(F.col("ingested_at") >= F.lit("2024-01-25").cast("timestamp_ntz"))


def refreshed_daily(spark, sf_dir):
    """A full refresh, then corrections of some hours, then the refresh of the dates they touch."""
    layout = new_layout(spark)
    raw.append_raw(landed_first(spark, sf_dir, layout), layout.readings)
    pipeline.refresh_dates(spark, layout, since=date(2024, 1, 25))
    return rounded(snapshot.read_snapshot(spark, layout.published, layout.daily_table), DAILY_REALS)


def streamed_daily(spark, sf_dir):
    """The same, the refresh being driven by the files that landed."""
    layout = new_layout(spark)
    corrected, progress = landed_first(spark, sf_dir, layout), f"{scratch_folder(spark)}/progress"
    raw.append_raw(corrected, layout.readings)
    refresh_new_batches(spark, layout, progress)
    return rounded(snapshot.read_snapshot(spark, layout.published, layout.daily_table), DAILY_REALS)


def refreshed_summary(spark, sf_dir):
    """The published summary after such a refresh, which merges the months' statistics."""
    layout = new_layout(spark)
    raw.append_raw(landed_first(spark, sf_dir, layout), layout.readings)
    pipeline.refresh_dates(spark, layout, since=date(2024, 1, 25))
    return snapshot.read_snapshot(spark, layout.published, layout.summary_table)


# Checks


def quality_report(spark, sf_dir):
    """The checks of every model; those that several suites or models read are written once."""
    models = {
        "staged_readings": staging.staged_readings(readings(spark, sf_dir), keep_raw_label=True),
        "staged_weather": staging.staged_weather(weather(spark, sf_dir)),
    }
    models = {name: written_once(df) for name, df in models.items()}
    models["readings_with_weather"] = written_once(enrichment.readings_with_weather(*models.values()))
    models["daily_index"] = written_once(marts.daily_index(models["readings_with_weather"]))
    models["station_summary"] = written_once(marts.station_summary(models["daily_index"]))
    return named_reports(pipeline.check_reports(models))


def named_reports(reports):
    named = [
        report.select(F.lit(table).alias("table_name"), F.col("check").alias("check_name"),
                      F.col("column").alias("column_name"), "violations", "passed")
        for table, report in reports.items()
    ]
    return reduce(DataFrame.unionByName, named)


def quality_report_orders(spark, sf_dir):
    """The same checks on other tables."""
    from aeroband.operators.quality import accepted_values, between, not_null, row_count as rows, unique

    return run_suite(
        table(spark, sf_dir, "orders"),
        [
            rows(at_least=1), not_null("o_custkey"), unique("o_custkey"), unique("o_orderkey"),
            accepted_values("o_orderstatus", ["O", "F"]), between("o_totalprice", 1000, 400000),
        ],
    ).select(F.col("check").alias("check_name"), F.col("column").alias("column_name"), "violations", "passed")


QUERIES = {
    f.__name__: f
    for f in [
        valid_readings, standard_labels, dedupe_latest_readings, dedupe_latest_weather, dedupe_latest_orders,
        label_allow_list, label_allow_list_default, lookback_window, lookback_days,
        hour_join, nearest_weather, nearest_weather_shuffled, nearest_weather_grid, nearest_weather_collapsed,
        nearest_weather_crowded,
        daily_index, station_summary, band_index_lineitem, conditional_pivot,
        stations_min_index, station_daily_range, station_daily_all, stations_in_order,
        station_daily_in_order, overview_in_order, nearby, nearby_exact_point, distance_to_point,
        nearest_station_to_point, label_to_id, station_options, mean_index_range, selected_count, overview,
        band_colours, pollutant_series_long, wind_vs_index_pairs, boundary_vs_pm25_pairs, latest_date,
        null_non_finite, series_json_explode, series_json_rejected, series_json_bad_times,
        weather_json_explode, weather_json_rejected, parallel_arrays_flatten,
        typed_empty_roundtrip, union_raw_batches, snapshot_roundtrip, published_summary, refused_publication,
        refreshed_daily, refreshed_summary, streamed_daily,
        quality_report, quality_report_orders,
    ]
}
