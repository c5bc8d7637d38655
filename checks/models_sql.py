"""The models as DuckDB SQL over the derived inputs, as common table expressions."""

from checks.inputs import READINGS_SQL, WEATHER_SQL

# Fixed values, written out here too and not taken from the library, so that a wrong one there shows.
WEATHER_LIST = (
    "temperature_2m, relative_humidity_2m, wind_speed_10m, wind_direction_10m, precipitation, pressure_msl, cloud_cover, "
    "boundary_layer_height"
)
WEATHER_COLUMNS = WEATHER_LIST.split(", ")
BOUNDS = {
    "pm25": (5, 10, 15, 25, 35, 45, 55, 65, 75),
    "pm10": (10, 20, 30, 40, 50, 60, 70, 80, 100),
    "no2": (10, 20, 30, 50, 70, 100, 150, 200, 400),
    "o3": (20, 40, 60, 80, 100, 140, 180, 240, 380),
}
NAMES = {"pm25": "PM2.5", "pm10": "PM10", "no2": "NO2", "o3": "O3"}


def standard_sql(label: str) -> str:
    low = f"lower({label})"
    return f"""case
  when {low} like '%particulate%2.5%' or {low} like '%pm2%' then 'PM2.5'
  when {low} like '%particulate%10%' or {low} like '%pm10%' then 'PM10'
  when {low} like '%no2%' or {low} like '%nitrogen dioxide%' then 'NO2'
  when {low} like '%o3%' or {low} like '%ozone%' then 'O3'
  when {low} like '%so2%' then 'SO2'
  when {low} like '%co%' and {low} not like '%cover%' then 'CO'
  when {low} like '%bc%' or {low} like '%black carbon%' then 'BC'
  else upper(trim({label})) end"""


def band_sql(value: str, bounds) -> str:
    arms = " ".join(f"when {value} <= {float(u)}e0 then {i}" for i, u in enumerate(bounds, 1))
    return f"cast(case when {value} is null then null {arms} else {len(bounds) + 1} end as integer)"


def label_sql(index: str) -> str:
    return f"""case when {index} in (1, 2) then 'Very Good' when {index} in (3, 4) then 'Good'
  when {index} in (5, 6) then 'Moderate' when {index} in (7, 8) then 'Poor' when {index} = 9 then 'Very Poor'
  when {index} = 10 then 'Horrible' else 'Unknown' end"""


def sum_sql(value: str, where: str = "") -> str:
    """The sum to 60 bits behind the point, whatever the order of the rows: whole parts and fractions apart, as integers."""
    rows = f" filter (where {where})" if where else ""
    unit = 1 << 60
    fractions = f"sum(trunc(({value} - trunc({value})) * {unit}e0)::hugeint){rows}"
    rest = f"((({fractions}) % {unit} + {unit}) % {unit})"
    return f"((sum(trunc({value})::hugeint){rows} + ({fractions} - {rest}) // {unit})::double + {rest}::double / {unit}e0)"


def mean_sql(value: str, where: str = "") -> str:
    rows = f" filter (where {where})" if where else ""
    return f"({sum_sql(value, where)} / nullif(count({value}){rows}, 0))"


def staged_readings_sql(source: str) -> str:
    return f"""
select station_id, station_label, latitude, longitude, {standard_sql('pollutant')} as pollutant,
  "timestamp" as measured_at, value as measurement_value, unit, ingested_at, 'irceline' as data_source,
  pollutant as raw_label
from (select *, row_number() over (partition by station_id, pollutant, "timestamp"
        order by ingested_at desc nulls last, value, latitude, longitude, station_label, unit) as place
      from {source}
      where value >= 0 and value < 1000 and latitude is not null and longitude is not null)
where place = 1"""


def staged_weather_sql(source: str) -> str:
    return f"""
select location_name, latitude, longitude, "timestamp" as measured_at, cast("timestamp" as date) as measured_date,
  cast(extract(hour from "timestamp") as integer) as measured_hour, {WEATHER_LIST}, ingested_at
from (select *, row_number() over (partition by location_name, "timestamp" order by ingested_at desc nulls last) as place
      from {source} where "timestamp" is not null)
where place = 1"""


ENRICHED_SQL = f"""
select station_id, station_label, station_lat, station_lon, pollutant, measured_at, measurement_value, unit, data_source,
  weather_station, {WEATHER_LIST}
from (select a.station_id, a.station_label, a.latitude as station_lat, a.longitude as station_lon, a.pollutant,
        a.measured_at, a.measurement_value, a.unit, a.data_source, w.location_name as weather_station,
        {', '.join('w.' + v for v in WEATHER_COLUMNS)},
        row_number() over (partition by a.station_id, a.pollutant, a.measured_at
          order by (a.latitude - w.latitude) ** 2 + (a.longitude - w.longitude) ** 2 nulls last,
            a.ingested_at desc nulls last, a.raw_label nulls last, w.location_name nulls last, w.measured_at) as place
      from staged a left join staged_weather w
        on date_trunc('hour', a.measured_at) = date_trunc('hour', w.measured_at))
where place = 1"""

_MEANS = ", ".join(f"{mean_sql('measurement_value', f"pollutant = '{name}'")} as avg_{s}" for s, name in NAMES.items())
_INDICES = ", ".join(f"{band_sql(f'avg_{s}', bounds)} as belaqi_{s}" for s, bounds in BOUNDS.items())
_WORST = f"greatest({', '.join(f'coalesce(belaqi_{s}, 0)' for s in NAMES)})"

DAILY_SQL = f"""
select station_id, station_label, station_lat, station_lon, data_source, measurement_date,
  {', '.join(f'avg_{s}' for s in NAMES)}, {', '.join(f'belaqi_{s}' for s in NAMES)},
  belaqi_overall, {label_sql('belaqi_overall')} as belaqi_label,
  avg_temperature, avg_humidity, avg_wind_speed, avg_boundary_layer, total_precipitation, measurement_count
from (select *, {_WORST} as belaqi_overall
      from (select *, {_INDICES}
            from (select station_id, station_label, station_lat, station_lon, data_source,
                    cast(measured_at as date) as measurement_date, {_MEANS},
                    {mean_sql('temperature_2m')} as avg_temperature, {mean_sql('relative_humidity_2m')} as avg_humidity,
                    {mean_sql('wind_speed_10m')} as avg_wind_speed, {mean_sql('boundary_layer_height')} as avg_boundary_layer,
                    {sum_sql('precipitation')} as total_precipitation, count(*) as measurement_count
                  from enriched group by all)))"""

_STATS = ", ".join(
    [f"round({mean_sql(f'avg_{s}')}, 1) as mean_{s}" for s in NAMES]
    + [f"round(max(avg_{s}), 1) as max_{s}" for s in NAMES]
)

SUMMARY_SQL = f"""
select *, round(100.0e0 * days_poor_or_worse / nullif(days_with_data, 0), 1) as pct_days_poor
from (select station_id, station_label, station_lat, station_lon, data_source,
        min(measurement_date) as first_measurement, max(measurement_date) as last_measurement,
        count(distinct measurement_date) as days_with_data, {_STATS},
        round({mean_sql('belaqi_overall')}, 1) as mean_belaqi, max(belaqi_overall) as worst_belaqi,
        count(*) filter (where belaqi_overall >= 7) as days_poor_or_worse,
        count(*) filter (where belaqi_overall <= 4) as days_good_or_better,
        round({mean_sql('avg_temperature')}, 1) as mean_temperature, round({mean_sql('avg_wind_speed')}, 1) as mean_wind_speed,
        round({mean_sql('avg_boundary_layer')}, 0) as mean_boundary_layer,
        cast(sum(measurement_count) as bigint) as total_measurements
      from daily group by station_id, station_label, station_lat, station_lon, data_source)"""

PARTS = {
    "r": READINGS_SQL,
    "w": WEATHER_SQL,
    "staged": staged_readings_sql("r"),
    "staged_weather": staged_weather_sql("w"),
    "enriched": ENRICHED_SQL,
    "daily": DAILY_SQL,
    "summary": SUMMARY_SQL,
}


def with_parts(up_to: str, select: str, extra: dict[str, str] | None = None) -> str:
    """``select`` over the derived inputs and the models up to the one named. ``extra`` parts stand between the
    inputs and the models, or replace a part of the same name."""
    names = list(PARTS)
    parts = {name: PARTS[name] for name in names[: names.index(up_to) + 1]}
    inputs = {name: parts.pop(name) for name in ("r", "w") if name in parts}
    parts = {**inputs, **{name: sql for name, sql in (extra or {}).items() if name not in parts}, **parts}
    parts.update(extra or {})
    ctes = ",\n".join(f"{name} as ({sql})" for name, sql in parts.items())
    return f"with {ctes}\n{select}"


def rounded(columns: list[str], digits: int = 6) -> str:
    """``*`` with those columns rounded, as sums of doubles differ in their last digits between plans."""
    return "* replace (" + ", ".join(f"round({c}, {digits}) as {c}" for c in columns) + ")"
