"""Row filters and projections of the staging layer."""

from datetime import datetime, timedelta

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from aeroband.functions.labels import contains_any
from aeroband.functions.numbers import finite_or_null
from aeroband.functions.times import utc
from aeroband.schemas import DEFAULT_POLLUTANTS, SERIES_LABELS


def filter_labels(df: DataFrame, label: str, names=None, texts_by_name=SERIES_LABELS) -> DataFrame:
    """Rows whose label contains the text of one of the named pollutants.

    Unknown names are ignored; no names at all keep nothing; ``None`` stands for the default four.
    """
    wanted = DEFAULT_POLLUTANTS if names is None else names
    return df.filter(contains_any(F.col(label), [texts_by_name[n] for n in wanted if n in texts_by_name]))


def filter_lookback(df: DataFrame, ts: str, end: datetime, hours: int) -> DataFrame:
    """Rows of the ``hours`` before ``end``, both ends included. ``end`` is given, so that a re-run of the same
    refresh selects the same rows."""
    return df.filter(F.col(ts).between(_instant(end - timedelta(hours=hours)), _instant(end)))


def filter_lookback_days(df: DataFrame, ts: str, end: datetime, days: int) -> DataFrame:
    """Rows of whole days, from ``days`` days before the date of ``end`` up to and including that date."""
    end = utc(end)
    first = datetime(end.year, end.month, end.day) - timedelta(days=days)
    after = datetime(end.year, end.month, end.day) + timedelta(days=1)
    # Compared on the timestamp itself: a cast to date would keep the filter from the Parquet scan.
    return df.filter((F.col(ts) >= _instant(first)) & (F.col(ts) < _instant(after)))


def lookback_days(hours: int) -> int:
    """Days of weather that go with a lookback of that many hours of readings."""
    return max(1, hours // 24)


def filter_valid(df: DataFrame, value: str, low=0, high=1000, required=()) -> DataFrame:
    """Rows with low <= value < high and the ``required`` columns present. Null and NaN values go too."""
    keep = F.col(value).isNotNull() & (F.col(value) >= F.lit(float(low))) & (F.col(value) < F.lit(float(high)))
    for column in required:
        keep = keep & F.col(column).isNotNull()
    return df.filter(keep)


def null_non_finite(df: DataFrame) -> DataFrame:
    """All double and float columns with NaN and the infinities replaced by null."""
    reals = [name for name, kind in df.dtypes if kind in ("double", "float")]
    return df.withColumns({name: finite_or_null(F.col(name)) for name in reals})


def _instant(moment: datetime):
    return F.lit(utc(moment).isoformat(sep=" ")).cast("timestamp_ntz")
