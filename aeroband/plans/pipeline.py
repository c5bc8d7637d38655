"""The whole refresh: raw tables to published marts, in full or for the dates that new data touches.

Besides the models, two kinds of state are kept: what the checks counted on each date, and each station's statistics per
month. A refresh counts and adds up the touched dates and months, and takes all else from the state.
"""

from dataclasses import dataclass
from datetime import date, timedelta
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from aeroband.operators.quality import Check, gate, merged_reports, run_suite, suite_state
from aeroband.plans.checks import MART_CHECKS, MODEL_CHECKS
from aeroband.plans.enriched import readings_with_weather
from aeroband.plans.marts import MONTH, daily_index, station_months, summary_of_months
from aeroband.plans.staging import staged_readings, staged_weather
from aeroband.schemas import READINGS, WEATHER
from aeroband.session import written_once
from aeroband.sources.raw import read_raw
from aeroband.sources.snapshot import publish_snapshot
from aeroband.sources.tables import materialise, on_partitions, replace_partitions


@dataclass(frozen=True)
class Layout:
    """Where a deployment keeps its tables. All paths are on storage that every executor sees."""

    readings: str
    weather: str
    published: str
    intermediate: str = "main_intermediate"
    marts: str = "main_marts"
    state: str = "main_state"

    @property
    def enriched_table(self):
        return f"{self.intermediate}.int_air_quality_weather"

    @property
    def daily_table(self):
        return f"{self.marts}.mart_daily_aqi"

    @property
    def summary_table(self):
        return f"{self.marts}.mart_station_summary"

    @property
    def counts_table(self):
        return f"{self.state}.check_counts"

    @property
    def keys_table(self):
        return f"{self.state}.check_keys"

    @property
    def months_table(self):
        return f"{self.state}.station_months"

    @property
    def unpublished_table(self):
        return f"{self.state}.unpublished"


# The date that each model's rows belong to; the summary is one whole.
PARTS = {
    "staged_readings": "cast(measured_at as date)",
    "staged_weather": "measured_date",
    "readings_with_weather": "measured_date",
    "daily_index": "measurement_date",
    "station_summary": "cast(null as date)",
}


def model_checks(model: str) -> list[Check]:
    return MODEL_CHECKS[model]() + (MART_CHECKS[model]() if model in MART_CHECKS else [])


def run_pipeline(spark: SparkSession, layout: Layout, publish: bool = True) -> list[str]:
    """Rebuild every model from all raw rows, check them, and publish the tables if every check passes.

    Returns the published tables. Raises QualityError, with nothing published, if a check fails.
    """
    _note_unpublished(spark, layout, None)
    raw_readings = read_raw(spark, layout.readings, READINGS)
    raw_weather = read_raw(spark, layout.weather, WEATHER)
    # Written down: the checks and the next model read the staged rows, which then are staged once.
    readings = written_once(staged_readings(raw_readings, keep_raw_label=True))
    weather = written_once(staged_weather(raw_weather))
    enriched = materialise(
        with_date(readings_with_weather(readings, weather)), layout.enriched_table, partition_by=["measured_date"]
    )
    daily = materialise(daily_index(enriched), layout.daily_table, partition_by=["measurement_date"])
    months = materialise(station_months(daily), layout.months_table, partition_by=[MONTH])
    summary = materialise(summary_of_months(months), layout.summary_table)
    _keep_state(spark, layout, {
        "staged_readings": readings, "staged_weather": weather, "readings_with_weather": enriched, "daily_index": daily,
        "station_summary": summary,
    })
    gate(stored_reports(spark, layout))
    return _publish(spark, layout) if publish else []


def _publish(spark, layout):
    """Publish what changed since the last time, runs that were refused included."""
    dates = _unpublished(spark, layout)
    # Lookups of a station read a few row groups of each day.
    clustered = {layout.enriched_table: ["station_id"], layout.daily_table: ["station_id"], layout.summary_table: ["station_id"]}
    changed = {layout.enriched_table: dates, layout.daily_table: dates, layout.summary_table: None} if dates else {}
    published = publish_snapshot(
        spark, [layout.intermediate, layout.marts], layout.published, changed=None if dates is None else changed,
        sort_by=clustered,
    )
    if dates != []:
        _note_unpublished(spark, layout, [])
    return published


def _note_unpublished(spark, layout, dates: list[date | None] | None) -> None:
    """Remember the dates that the models have anew but no published version has; None: any of them."""
    rows = [(day, False) for day in dates] if dates is not None else [(None, True)]
    materialise(spark.createDataFrame(rows, "day date, everything boolean"), layout.unpublished_table)


def _unpublished(spark, layout) -> list[date | None] | None:
    if not spark.catalog.tableExists(layout.unpublished_table):
        return None
    rows = spark.table(layout.unpublished_table).collect()
    return None if any(row["everything"] for row in rows) else [row["day"] for row in rows]


def with_date(enriched: DataFrame) -> DataFrame:
    """The stored form of the enriched model: its date is the partition column."""
    return enriched.withColumn("measured_date", F.col("measured_at").cast("date"))


def check_reports(models: dict[str, DataFrame]) -> dict[str, DataFrame]:
    """The report of every model: the column checks, then those of the marts."""
    reports = {f"{name} columns": run_suite(models[name], checks()) for name, checks in MODEL_CHECKS.items()}
    return reports | {name: run_suite(models[name], checks()) for name, checks in MART_CHECKS.items()}


def _keep_state(spark, layout, models: dict[str, DataFrame], dates: list[date | None] | None = None) -> None:
    """Replace the state of the checks for the rows given: those of ``dates``, or all.

    The state has a row per model, date and check (and per station for the summary's uniqueness), so rewriting it costs
    little however large the models are.
    """
    kinds = ([], [])
    for name, df in models.items():
        for kind, state in zip(kinds, suite_state(df, model_checks(name), F.expr(PARTS[name]))):
            kind.append(state.select(F.lit(name).alias("model"), *state.columns))
    for table, states in zip((layout.counts_table, layout.keys_table), kinds):
        state = reduce(DataFrame.unionByName, states)
        if dates is not None:
            old = spark.table(table)
            replaced = (F.col("model") == "station_summary") | on_dates_condition("part", dates)
            state = state.unionByName(old.filter(~replaced))
        materialise(written_once(state), table)


def on_dates_condition(column: str, dates: list[date | None]):
    """Whether a date, or null, is one of the given ones; never null itself."""
    value = F.col(column)
    known = F.coalesce(value.isin([d for d in dates if d is not None]), F.lit(False))
    return known | value.isNull() if None in dates else known


def stored_reports(spark: SparkSession, layout: Layout) -> DataFrame:
    """The reports of all models from the state of their checks, one row per check; ``table`` names the suite."""
    suites = {f"{name} columns": (name, 0, checks()) for name, checks in MODEL_CHECKS.items()}
    suites |= {name: (name, len(MODEL_CHECKS[name]()), checks()) for name, checks in MART_CHECKS.items()}
    return merged_reports(spark.table(layout.counts_table), spark.table(layout.keys_table), suites)


def touched_dates(new_readings: DataFrame, new_weather: DataFrame) -> DataFrame:
    """Distinct dates that new raw rows fall on, null for rows without a time: the only dates whose results can
    change, as readings meet weather of their own hour and the daily mart groups by date."""
    return date_of(new_readings).union(date_of(new_weather)).distinct()


def date_of(raw: DataFrame) -> DataFrame:
    """The date of every row, as ``touched``."""
    return raw.select(F.col("timestamp").cast("date").alias("touched"))


def on_dates(raw: DataFrame, dates: list[date | None]) -> DataFrame:
    """Raw rows of the given dates. They are a range on the stored column too, so the scan skips other row groups."""
    ts, known = F.col("timestamp"), [d for d in dates if d is not None]
    near = ts.isNull() if None in dates else F.lit(False)
    if known:
        after = (max(known) + timedelta(days=1)).isoformat()
        first = min(known).isoformat()
        within = (ts >= F.lit(first).cast("timestamp_ntz")) & (ts < F.lit(after).cast("timestamp_ntz"))
        near = near | (within & ts.cast("date").isin(known))
    return raw.filter(near)


def refresh_dates(spark: SparkSession, layout: Layout, since: date, publish: bool = True) -> list[str]:
    """Like ``run_pipeline`` after the raw rows ingested on or after ``since`` were added, recomputing only the
    dates those rows touch and replacing just their partitions.
    """
    dates = touched_dates(
        read_raw(spark, layout.readings, READINGS, since), read_raw(spark, layout.weather, WEATHER, since)
    )
    return refresh_touched(spark, layout, dates, publish)


def refresh_touched(spark: SparkSession, layout: Layout, dates: DataFrame, publish: bool = True) -> list[str]:
    """Recompute the given dates (``touched``) and replace just their partitions, of the models, the state, and what is
    published. The dates come to the driver as a list: there are as many as days of data at most.

    They are recomputed from all raw rows of those dates, old and new, so the result is that of a full rebuild.
    """
    touched = [row["touched"] for row in dates.distinct().collect()]
    if touched:
        waiting = _unpublished(spark, layout)
        if waiting is not None:
            _note_unpublished(spark, layout, list({*waiting, *touched}))
        readings = written_once(staged_readings(on_dates(read_raw(spark, layout.readings, READINGS), touched), keep_raw_label=True))
        weather = written_once(staged_weather(on_dates(read_raw(spark, layout.weather, WEATHER), touched)))
        replace_partitions(with_date(readings_with_weather(readings, weather)), layout.enriched_table, ["measured_date"])
        enriched = on_partitions(spark.table(layout.enriched_table), "measured_date", touched)
        replace_partitions(daily_index(enriched), layout.daily_table, ["measurement_date"])
        daily = spark.table(layout.daily_table)
        months = {day and day.replace(day=1) for day in touched}
        replace_partitions(station_months(_of_months(daily, months)), layout.months_table, [MONTH])
        summary = materialise(summary_of_months(spark.table(layout.months_table)), layout.summary_table)
        _keep_state(spark, layout, {
            "staged_readings": readings, "staged_weather": weather, "readings_with_weather": enriched,
            "daily_index": on_partitions(daily, "measurement_date", touched), "station_summary": summary,
        }, touched)
    gate(stored_reports(spark, layout))
    return _publish(spark, layout) if publish else []


def _of_months(daily: DataFrame, months: set[date | None]) -> DataFrame:
    """The days of whole months, by their partitions alone."""
    day, wanted = F.col("measurement_date"), F.lit(False)
    for month in sorted(m for m in months if m is not None):
        after = (month + timedelta(days=31)).replace(day=1)
        wanted = wanted | ((day >= F.lit(month)) & (day < F.lit(after)))
    return daily.filter(wanted | day.isNull() if None in months else wanted)
