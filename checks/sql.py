"""DuckDB twins of the registered queries, over the whole tables."""

from checks import registered as q
from checks.inputs import again_sql
from checks.models_sql import (
    BOUNDS, WEATHER_COLUMNS, WEATHER_LIST, band_sql, label_sql, rounded, staged_readings_sql, staged_weather_sql, standard_sql,
    with_parts,
)

# Fixed values, written out here too.
SERIES_LABELS = {
    "PM10": "Particulate Matter < 10", "PM2.5": "Particulate Matter < 2.5", "NO2": "Nitrogen dioxide", "O3": "Ozone",
    "BC": "Black Carbon",
}
DEFAULT_POLLUTANTS = ["PM10", "PM2.5", "NO2", "O3"]
SERIES_COLUMNS = {"PM2.5": "avg_pm25", "PM10": "avg_pm10", "NO₂": "avg_no2", "O₃": "avg_o3"}
COLOURS = "#50C878 #7CCD7C #FFD700 #FFC125 #FF8C00 #FF6347 #DC143C #B22222 #8B0000 #4B0000".split()

STAGED_COLUMNS = (
    "station_id, station_label, latitude, longitude, pollutant, measured_at, measurement_value, unit, ingested_at, "
    "data_source"
)


def labelled(names):
    return " or ".join(f"contains(pollutant, '{SERIES_LABELS[n]}')" for n in names)


def daily(select):
    return with_parts("daily", select)


def summary(select):
    return with_parts("summary", select)


def great_circle(lat, lon):
    cosine = (
        f"cos(radians({lat}e0)) * cos(radians(station_lat)) * cos(radians(station_lon) - radians({lon}e0)) "
        f"+ sin(radians({lat}e0)) * sin(radians(station_lat))"
    )
    return f"6371 * acos(least(1e0, greatest(-1e0, {cosine})))"


def near(point, radius, limit):
    return summary(f"""
select station_id, station_label, round(km, 2) as distance_km
from (select *, {great_circle(*point)} as km from summary)
where km <= {radius} order by km, station_id limit {limit}""")


INDEX_LOW, INDEX_HIGH = q.INDEX_RANGE
LANDED = labelled(DEFAULT_POLLUTANTS)
CORRECTED = f"""
select * from r where {LANDED} union all
select * from (select * from ({again_sql('r', 'value')}) where {LANDED}) where ingested_at >= timestamp '2024-01-25'"""

SERIES = f"""
select cast(user_id as varchar) as station_id, concat('Station ', user_id) as station_label,
  case when user_id % 7 <> 5 then user_id / 50e0 end as latitude,
  case when user_id % 7 <> 5 then user_id / 100e0 end as longitude,
  event_type as pollutant, date_trunc('milliseconds', ts) as "timestamp", value,
  case when user_id % 9 <> 4 then 'mg/m³' else 'µg/m³' end as unit, timestamp '{q.RUN_TIME}' as ingested_at
from events where (user_id + event_id // 4096) % 10 <> 3"""


def check_sql(table, check, column, violations):
    return f"select '{table}' as table_name, '{check}' as check_name, '{column}' as column_name, {violations} as violations"


def counted(source, condition):
    return f"(select count(*) filter (where {condition}) from {source})"


def repeated(source, column):
    return f"(select count(*) from (select {column} from {source} where {column} is not null group by 1 having count(*) > 1))"


NOT_NULLS = [
    ("staged_readings", "staged", ["station_id", "pollutant", "measurement_value"]),
    ("staged_weather", "staged_weather", ["location_name", "measured_at"]),
    ("readings_with_weather", "enriched", ["station_id", "measured_at"]),
    ("daily_index", "daily", ["station_id", "measurement_date", "belaqi_overall"]),
    ("station_summary", "summary", ["station_id"]),
]
STANDARD = "('PM2.5', 'PM10', 'NO2', 'O3', 'SO2', 'CO', 'BC')"
REPORT = [
    check_sql(f"{table} columns", "not_null", column, counted(source, f"{column} is null"))
    for table, source, columns in NOT_NULLS for column in columns
] + [
    check_sql("staged_readings columns", "accepted_values", "pollutant", counted("staged", f"pollutant not in {STANDARD}")),
    check_sql("station_summary columns", "unique", "station_id", repeated("summary", "station_id")),
    check_sql("daily_index", "row_count", "", "(select cast(count(*) < 1 as bigint) from daily)"),
    check_sql("daily_index", "not_null", "station_id", counted("daily", "station_id is null")),
    check_sql("daily_index", "not_null", "measurement_date", counted("daily", "measurement_date is null")),
    check_sql("daily_index", "not_null", "belaqi_overall", counted("daily", "belaqi_overall is null")),
    check_sql("daily_index", "between", "belaqi_overall", counted("daily", "belaqi_overall not between 1 and 10")),
    check_sql("station_summary", "row_count", "", "(select cast(count(*) < 1 as bigint) from summary)"),
    check_sql("station_summary", "unique", "station_id", repeated("summary", "station_id")),
    check_sql("station_summary", "between", "station_lat", counted("summary", "station_lat not between 49.5e0 and 51.6e0")),
    check_sql("station_summary", "between", "station_lon", counted("summary", "station_lon not between 2.3e0 and 6.5e0")),
]
ORDERS_REPORT = [
    ("row_count", "", "(select cast(count(*) < 1 as bigint) from orders)"),
    ("not_null", "o_custkey", counted("orders", "o_custkey is null")),
    ("unique", "o_custkey", repeated("orders", "o_custkey")),
    ("unique", "o_orderkey", repeated("orders", "o_orderkey")),
    ("accepted_values", "o_orderstatus", counted("orders", "o_orderstatus not in ('O', 'F')")),
    ("between", "o_totalprice", counted("orders", "o_totalprice not between 1000 and 400000")),
]

BAND = "least(10, greatest(1, coalesce(cast(trunc(mean_belaqi) as integer), 1)))"

ORACLE = {
    "valid_readings": with_parts("r", """
select station_id, station_label, latitude, longitude, pollutant, "timestamp" as measured_at,
  value as measurement_value, 'irceline' as data_source
from r where value >= 0 and value < 1000 and latitude is not null and longitude is not null"""),
    "standard_labels": with_parts("r", f"""
select pollutant as raw_label, {standard_sql('pollutant')} as pollutant, count(*) as n
from (select pollutant from r union all select p_type from part) group by all"""),
    "dedupe_latest_readings": with_parts(
        "staged", f"select {STAGED_COLUMNS} from staged",
        {"twice": again_sql("r", "value"), "staged": staged_readings_sql("twice")}),
    "dedupe_latest_weather": with_parts(
        "staged_weather", "select * from staged_weather",
        {"twice": again_sql("w", "temperature_2m"), "staged_weather": staged_weather_sql("twice")}),
    "dedupe_latest_orders": """
select o_orderkey, o_custkey, o_orderstatus, o_totalprice, o_orderdate, o_orderpriority from orders
qualify row_number() over (partition by o_custkey order by o_orderdate desc nulls last, o_orderkey) = 1""",
    "label_allow_list": with_parts("r", f"""
select station_id, pollutant, count(*) as n from r where {labelled(['PM2.5', 'NO2', 'BC'])} group by all"""),
    "label_allow_list_default": with_parts("r", f"select pollutant, count(*) as n from r where {LANDED} group by all"),
    "lookback_window": f"""
select event_id, ts, user_id, value from events
where ts between timestamp '{q.LOOKBACK_END}' - interval {q.LOOKBACK_HOURS} hour and timestamp '{q.LOOKBACK_END}'""",
    "lookback_days": with_parts("w", f"""
select location_name, "timestamp", temperature_2m from w
where cast("timestamp" as date) between date '{q.LOOKBACK_END:%Y-%m-%d}' - 1 and date '{q.LOOKBACK_END:%Y-%m-%d}'"""),
    "hour_join": with_parts("staged_weather", """
select a.station_id, a.pollutant, a.measured_at, count(w.location_name) as weather_rows,
  round(avg(w.temperature_2m), 6) as hour_temperature
from staged a left join staged_weather w on date_trunc('hour', a.measured_at) = date_trunc('hour', w.measured_at)
group by a.station_id, a.raw_label, a.pollutant, a.measured_at"""),
    "nearest_weather": with_parts("enriched", "select * from enriched"),
    "nearest_weather_shuffled": with_parts("enriched", "select * from enriched"),
    "nearest_weather_grid": with_parts("enriched", "select * from enriched"),
    "nearest_weather_crowded": with_parts("enriched", "select * from enriched", {
        "crowded": f"""
select * from w union all
select concat('Supplier ', s_suppkey), 49.5e0 + (s_suppkey * 37 % 1999) / 1e3, 2.5e0 + (s_suppkey * 53 % 3989) / 1e3,
  timestamp '{q.CROWDED_HOUR}', cast(s_suppkey as double), {', '.join(['0e0'] * 7)}, timestamp '{q.CROWDED_HOUR}' from supplier
union all
select 'Far', -89e0, 179e0, hr, {', '.join(['-1e0'] * 8)}, hr from (select distinct "timestamp" as hr from w)""",
        "staged_weather": staged_weather_sql("crowded")}),
    "nearest_weather_collapsed": with_parts("enriched", "select * from enriched", {
        "moved": f"""
select * from r union all
select * replace (concat({standard_sql('pollutant')}, ' mobile no2 o3 pm10') as pollutant, latitude + 0.25e0 as latitude,
  value + 1 as value)
from r where hour("timestamp") % 4 = 0""",
        "staged": staged_readings_sql("moved")}),
    "daily_index": daily(f"select {rounded(q.DAILY_REALS)} from daily"),
    "station_summary": summary("select * from summary"),
    "band_index_lineitem": f"""
select *, {label_sql('band_overall')} as label
from (select *, greatest(band_quantity, band_price) as band_overall, count(*) as n
      from (select {band_sql('l_quantity', BOUNDS['pm25'])} as band_quantity,
              {band_sql('l_extendedprice / 1000', BOUNDS['pm10'])} as band_price from lineitem)
      group by all)""",
    "conditional_pivot": """
select l_suppkey, cast(year(l_shipdate) as integer) as ship_year, cast(month(l_shipdate) as integer) as ship_month,
  round(avg(l_quantity) filter (where l_returnflag = 'A'), 6) as mean_quantity_a,
  round(avg(l_quantity) filter (where l_returnflag = 'N'), 6) as mean_quantity_n,
  round(avg(l_quantity) filter (where l_returnflag = 'R'), 6) as mean_quantity_r, count(*) as n
from lineitem group by all""",
    "stations_min_index": summary(f"select * from summary where mean_belaqi >= {q.MIN_INDEX}"),
    "station_daily_range": daily(f"""
select {rounded(q.DAILY_REALS)} from daily where station_id = '{q.STATION}'
  and measurement_date between date '{q.STATION_FIRST}' and date '{q.STATION_LAST}'"""),
    "station_daily_all": daily(f"select {rounded(q.DAILY_REALS)} from daily where station_id = '{q.STATION}'"),
    "nearby": near(q.POINT, 60, 25),
    "nearby_exact_point": near(q.EXACT_POINT, 0.5, 50),
    "distance_to_point": summary(f"""
select station_id, station_lat, station_lon, round({great_circle(*q.POINT)}, 2) as distance_km from summary"""),
    "nearest_station_to_point": summary(f"""
select station_id, station_label, station_lat, station_lon, mean_belaqi from summary
where mean_belaqi between 1 and 10
order by (station_lat - {q.POINT[0]}e0) ** 2 + (station_lon - {q.POINT[1]}e0) ** 2, station_id limit 1"""),
    "label_to_id": summary(f"""
select station_id from summary where station_label = 'Station {q.STATION}' order by station_id limit 1"""),
    "station_options": summary("select distinct station_id, station_label from summary"),
    "mean_index_range": summary(f"""
select station_id, mean_belaqi from summary where mean_belaqi between {INDEX_LOW} and {INDEX_HIGH}"""),
    "selected_count": summary(f"""
select count(*) as stations from summary where mean_belaqi between {INDEX_LOW} and {INDEX_HIGH}"""),
    "overview": summary("""
select station_label, mean_belaqi, mean_pm25, mean_pm10, mean_no2, days_with_data, pct_days_poor from summary"""),
    "band_colours": summary(f"""
select station_id, mean_belaqi, case {BAND} {' '.join(f"when {i} then '{c}'" for i, c in enumerate(COLOURS, 1))}
  else '#808080' end as colour from summary"""),
    "pollutant_series_long": daily("\nunion all\n".join(
        f"select station_id, station_lat, measurement_date, '{label}' as series, round({column}, 6) as value from daily "
        f"where exists (select 1 from daily where {column} is not null)"
        for label, column in SERIES_COLUMNS.items())),
    "wind_vs_index_pairs": daily("""
select round(avg_wind_speed, 6) as avg_wind_speed, belaqi_overall from daily
where avg_wind_speed is not null and belaqi_overall is not null"""),
    "boundary_vs_pm25_pairs": daily("""
select round(avg_boundary_layer, 6) as avg_boundary_layer, round(avg_pm25, 6) as avg_pm25 from daily
where avg_boundary_layer is not null and avg_pm25 is not null"""),
    "latest_date": daily("""
select min(measurement_date) as earliest_data, max(measurement_date) as latest_data from daily"""),
    "null_non_finite": """
select event_id, case when event_id % 7 <> 0 and event_id % 11 <> 0 and event_id % 13 <> 0 then value end as value
from events""",
    "series_json_explode": SERIES,
    "series_json_rejected": """
select case when (user_id + block) % 10 = 3 then 'rejected' else 'good' end as kind, count(*) as documents
from (select distinct user_id, event_type, event_id // 4096 as block from events) group by all""",
    "series_json_bad_times": """
with blocks as (select user_id, event_type, event_id // 4096 as block, count(*) as n, (user_id + event_id // 4096) % 10 in (3, 6) as bad
  from events group by all)
select 'good' as kind, count(*) filter (where not bad) as n from blocks union all
select 'rejected', count(*) filter (where bad) from blocks union all
select 'readings', cast(coalesce(sum(n) filter (where not bad), 0) as bigint) from blocks""",
    "weather_json_explode": with_parts("w", f"""
select location_name, latitude, longitude, "timestamp", {WEATHER_LIST}, timestamp '{q.RUN_TIME}' as ingested_at
from (select * replace (
        case when row_number() over (partition by location_name, cast("timestamp" as date) order by "timestamp")
          < count(*) over (partition by location_name, cast("timestamp" as date)) then precipitation end as precipitation,
        case when day("timestamp") % 2 = 0 then cloud_cover end as cloud_cover)
      from w)"""),
    "weather_json_rejected": with_parts("w", """
select location_name, nullif(count(distinct case when day("timestamp") % 7 in (3, 5) then cast("timestamp" as date) end), 0)
    as rejected, nullif(count(*) filter (where day("timestamp") % 7 not in (3, 5)), 0) as hours
from w group by all"""),
    "parallel_arrays_flatten": """
select user_id, event_id,
  case when row_number() over (partition by user_id, event_id // 1024 order by event_id)
    < count(*) over (partition by user_id, event_id // 1024) then value end as value,
  event_type, cast(null as double) as missing
from events""",
    "typed_empty_roundtrip": with_parts("r", "select * from r"),
    "union_raw_batches": with_parts("r", f"""
select station_id, pollutant, count(*) as n, min(ingested_at) as first_ingest, max(ingested_at) as last_ingest
from (select * from r union all select * from ({again_sql('r', 'value')}) union all select * from r) group by all"""),
    "snapshot_roundtrip": daily(f"select {rounded(q.DAILY_REALS)}, true as is_live from daily"),
    "published_summary": with_parts("summary", "select * from summary", {
        "batch": f"select * from r where {LANDED}", "staged": staged_readings_sql("batch")}),
    "refreshed_daily": with_parts("daily", f"select {rounded(q.DAILY_REALS)} from daily", {
        "batches": CORRECTED, "staged": staged_readings_sql("batches")}),
    "refreshed_summary": with_parts("summary", "select * from summary", {
        "batches": CORRECTED, "staged": staged_readings_sql("batches")}),
    "streamed_daily": with_parts("daily", f"select {rounded(q.DAILY_REALS)} from daily", {
        "batches": CORRECTED, "staged": staged_readings_sql("batches")}),
    "refused_publication": summary(
        "select *, false as is_published from (" + "\nunion all\n".join(REPORT) + ") where violations > 0"),
    "stations_in_order": summary("""
select row_number() over (order by mean_belaqi desc nulls last, station_id) - 1 as place, station_id, mean_belaqi from summary"""),
    "station_daily_in_order": daily(f"""
select row_number() over (order by measurement_date desc nulls last, station_label, station_lat, station_lon) - 1 as place,
  measurement_date, belaqi_overall from daily where station_id = '{q.STATION}' and measurement_date >= date '{q.STATION_FIRST}'"""),
    "overview_in_order": summary("""
select row_number() over (order by mean_belaqi desc nulls last, station_label) - 1 as place, station_label, mean_belaqi from summary"""),
    "quality_report": summary(
        "select *, violations = 0 as passed from (" + "\nunion all\n".join(REPORT) + ")"),
    "quality_report_orders": "select *, violations = 0 as passed from (" + "\nunion all\n".join(
        f"select '{check}' as check_name, '{column}' as column_name, {violations} as violations"
        for check, column, violations in ORDERS_REPORT) + ")",
}
