"""The two marts: the daily index per station, and its summary per station."""

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from aeroband.functions import sql_text
from aeroband.functions.bands import band_index, index_label, worst_of
from aeroband.functions.numbers import rounded_sql, safe_percent
from aeroband.operators.aggregates import mean_of, merged_state, row_count, sum_state, where, with_totals
from aeroband.schemas import BAND_BOUNDS, INDEXED, STATION_KEYS

SUFFIXES = list(INDEXED.values())


def daily_means(enriched: DataFrame) -> DataFrame:
    """Per station and day: the mean of each indexed pollutant, the weather means, and the number of readings.

    Weather stands beside every reading, so its means are weighted by the readings of each hour, and the
    precipitation total counts an hour once per reading. Kept so on purpose.
    """
    groups = enriched.groupBy(*STATION_KEYS, F.col("measured_at").cast("date").alias("measurement_date"))
    means = {f"avg_{s}": where(f"pollutant = {sql_text(name)}", "measurement_value") for name, s in INDEXED.items()}
    means |= {
        "avg_temperature": "temperature_2m", "avg_humidity": "relative_humidity_2m", "avg_wind_speed": "wind_speed_10m",
        "avg_boundary_layer": "boundary_layer_height",
    }
    return with_totals(groups, {"total_precipitation": "precipitation"}, means, row_count("measurement_count"))


def daily_index(enriched: DataFrame) -> DataFrame:
    """Daily means with the index of each pollutant, the worst of them, and its word.

    A day with none of the indexed pollutants gets index 0, "Unknown"; the quality gate then refuses it.
    """
    indexed = daily_means(enriched).withColumns(
        {f"belaqi_{s}": band_index(f"avg_{s}", BAND_BOUNDS[name]) for name, s in INDEXED.items()}
    )
    overall = indexed.withColumn("belaqi_overall", worst_of(*[f"belaqi_{s}" for s in SUFFIXES]))
    return overall.select(
        *STATION_KEYS,
        "measurement_date",
        *[f"avg_{s}" for s in SUFFIXES],
        *[f"belaqi_{s}" for s in SUFFIXES],
        "belaqi_overall",
        index_label("belaqi_overall").alias("belaqi_label"),
        "avg_temperature",
        "avg_humidity",
        "avg_wind_speed",
        "avg_boundary_layer",
        "total_precipitation",
        "measurement_count",
    )


# Columns of the daily mart whose mean the summary shows: its name there, and the decimals.
MEANS = {
    **{f"avg_{s}": (f"mean_{s}", 1) for s in SUFFIXES}, "belaqi_overall": ("mean_belaqi", 1),
    "avg_temperature": ("mean_temperature", 1), "avg_wind_speed": ("mean_wind_speed", 1),
    "avg_boundary_layer": ("mean_boundary_layer", 0),
}
MONTH = "month"


def _statistics() -> dict[str, tuple[str, str]]:
    """Per statistic its aggregate over days, and the function that merges partial ones.

    A station has one row per day, so counting the non-null dates counts distinct days without the extra shuffle of a
    distinct count. Unknown days (index 0) count as good ones.
    """
    return {
        "first_measurement": ("min(measurement_date)", "min"),
        "last_measurement": ("max(measurement_date)", "max"),
        "days_with_data": ("count(measurement_date)", "sum"),
        **{f"max_{s}": (f"max(avg_{s})", "max") for s in SUFFIXES},
        "worst_belaqi": ("max(belaqi_overall)", "max"),
        "days_poor_or_worse": ("count_if(belaqi_overall >= 7)", "sum"),
        "days_good_or_better": ("count_if(belaqi_overall <= 4)", "sum"),
        "total_measurements": ("sum(measurement_count)", "sum"),
    }


def _partial() -> list[Column]:
    """The statistics of days, sums among them as states that merge."""
    return [F.expr(partial).alias(name) for name, (partial, _) in _statistics().items()] + [
        sum_state(column).alias(f"sum_{column}") for column in MEANS
    ]


def station_months(daily: DataFrame) -> DataFrame:
    """Partial statistics per station and month (its first day; null for days without a date), which
    ``summary_of_months`` merges: a change of some days needs the days of their months only."""
    month = F.trunc("measurement_date", "month").alias(MONTH)
    return daily.groupBy(*STATION_KEYS, month).agg(*_partial())


def summary_of_months(months: DataFrame) -> DataFrame:
    """The summary of all stations from their months; the same, to the last bit, as from their days."""
    merged = [F.expr(f"{merge}({name})").alias(name) for name, (_, merge) in _statistics().items()]
    sums = [merged_state(f"sum_{column}").alias(f"sum_{column}") for column in MEANS]
    return _presented(months.groupBy(*STATION_KEYS).agg(*merged, *sums))


def station_summary(daily: DataFrame) -> DataFrame:
    """Statistics of each station over all its days.

    A station whose label or position changed has several rows, which the uniqueness check reports.
    """
    return _presented(daily.groupBy(*STATION_KEYS).agg(*_partial()))


def _presented(summary: DataFrame) -> DataFrame:
    means = {
        name: f"{rounded_sql(mean_of(f'sum_{column}'), digits)} as {name}" for column, (name, digits) in MEANS.items()
    }
    return summary.selectExpr(
        *STATION_KEYS, "first_measurement", "last_measurement", "days_with_data",
        *[means[f"mean_{s}"] for s in SUFFIXES], *[f"{rounded_sql(f'max_{s}', 1)} as max_{s}" for s in SUFFIXES],
        means["mean_belaqi"], "worst_belaqi", "days_poor_or_worse", "days_good_or_better",
        *[means[name] for name in ("mean_temperature", "mean_wind_speed", "mean_boundary_layer")], "total_measurements",
    ).withColumn("pct_days_poor", safe_percent(F.col("days_poor_or_worse"), F.col("days_with_data")))
