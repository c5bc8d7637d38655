"""Landed documents, as the services send them, to raw rows.

A document that cannot be parsed is set aside with the others kept, as a failing series or location does not stop
a refresh. Fetching is not part of this package: documents are read from where they were landed, one per row.
"""

from collections.abc import Callable
from datetime import datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from aeroband.functions.times import from_epoch_ms, from_iso, is_epoch_ms, utc
from aeroband.schemas import DEFAULT_UNIT, READINGS, WEATHER, WEATHER_VARIABLES

_CORRUPT = "_corrupt_record"


def readable_series(doc: Column) -> Column:
    """Whether all times of a series document are epoch milliseconds; absent ones do not matter."""
    return ~F.coalesce(F.exists(doc["values"]["timestamp"], lambda ms: ~is_epoch_ms(ms)), F.lit(False))


def readable_weather(doc: Column) -> Column:
    """Whether all times of a weather document can be read; absent ones do not matter."""
    bad = F.exists(doc["hourly"]["time"], lambda text: text.isNotNull() & from_iso(text).isNull())
    return ~F.coalesce(bad, F.lit(False))


def parse_docs(
    df: DataFrame, text: str, schema: T.StructType, readable: Callable[[Column], Column] | None = None
) -> tuple[DataFrame, DataFrame]:
    """The rows of ``df`` with the JSON of column ``text`` parsed into column ``doc``, and the rows rejected: those
    that are not such JSON, and those whose document is not ``readable``, so that one bad time does not stop a batch."""
    parsed = df.withColumn(
        "_parsed",
        F.from_json(
            F.col(text),
            T.StructType([*schema.fields, T.StructField(_CORRUPT, T.StringType())]),
            {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": _CORRUPT},
        ),
    )
    broken = F.col("_parsed").isNull() | F.col("_parsed")[_CORRUPT].isNotNull()
    if readable is not None:
        broken = broken | ~readable(F.col("_parsed"))
    doc = F.struct(*[F.col("_parsed")[name].alias(name) for name in schema.names])
    return parsed.filter(~broken).withColumn("doc", doc).drop("_parsed"), parsed.filter(broken).drop("_parsed")


def flatten_series_meta(docs: DataFrame, doc: str = "doc") -> DataFrame:
    """Station, position, label and unit of each series document, next to the columns of ``docs``.

    Absent texts become empty, an absent unit the default one, absent coordinates null. JSON null and absence
    are the same here.
    """
    station, place = f"{doc}.station.properties", f"{doc}.station.geometry.coordinates"
    return docs.withColumns(
        {
            "series_id": F.col(f"{doc}.id"),
            "station_id": _or_empty(F.col(f"{station}.id")),
            "station_label": _or_empty(F.col(f"{station}.label")),
            # Coordinates come as [longitude, latitude].
            "latitude": F.get(F.col(place), F.lit(1)),
            "longitude": F.get(F.col(place), F.lit(0)),
            "pollutant": _or_empty(F.col(f"{doc}.parameters.phenomenon.label")),
            "unit": F.coalesce(F.col(f"{doc}.uom"), F.lit(DEFAULT_UNIT)),
        }
    )


def explode_series(docs: DataFrame, ingested_at: datetime | Column, doc: str = "doc") -> DataFrame:
    """One raw reading per value of each series document; a series without values gives none."""
    values = flatten_series_meta(docs, doc).withColumn("_entry", F.explode(F.col(f"{doc}.values")))
    return values.select(
        "station_id",
        "station_label",
        "latitude",
        "longitude",
        "pollutant",
        from_epoch_ms(F.col("_entry.timestamp")).alias("timestamp"),
        F.col("_entry.value").alias("value"),
        "unit",
        run_time(ingested_at).alias("ingested_at"),
    ).select(*READINGS.names)


def flatten_parallel_arrays(
    docs: DataFrame, index: Column, arrays: dict[str, Column], keep: list[str], index_name: str
) -> DataFrame:
    """One row per element of the ``index`` array, with the element at the same place of each other array.

    Arrays that are shorter or missing give nulls there; elements beyond the index array are ignored. ``keep``
    names columns of ``docs`` to repeat.
    """
    placed = docs.select(*keep, F.struct(*[a.alias(n) for n, a in arrays.items()]).alias("_arrays"), F.posexplode(index))
    return placed.select(
        *keep,
        F.col("col").alias(index_name),
        *[F.get(F.col(f"_arrays.`{name}`"), F.col("pos")).alias(name) for name in arrays],
    )


def explode_weather(docs: DataFrame, ingested_at: datetime | Column, doc: str = "doc") -> DataFrame:
    """One raw weather row per hour of each document; ``docs`` names the location and its position."""
    hourly = flatten_parallel_arrays(
        docs,
        index=F.col(f"{doc}.hourly.time"),
        arrays={name: F.col(f"{doc}.hourly.{name}") for name in WEATHER_VARIABLES},
        keep=["location_name", "latitude", "longitude"],
        index_name="_time",
    )
    return hourly.withColumns(
        {"timestamp": from_iso(F.col("_time")), "ingested_at": run_time(ingested_at)}
    ).select(*WEATHER.names)


def run_time(moment: datetime | Column) -> Column:
    """The one ingest time of a run, as a zone-less timestamp."""
    if isinstance(moment, Column):
        return moment
    return F.lit(utc(moment).isoformat(sep=" ")).cast("timestamp_ntz")


def _or_empty(text: Column) -> Column:
    return F.coalesce(text, F.lit(""))
