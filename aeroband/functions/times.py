"""Zone-less timestamps. None of these passes through a zoned timestamp, so the session time zone does not matter."""

from datetime import datetime, timezone

from pyspark.sql import Column
from pyspark.sql import functions as F


def hour_number(ts: Column) -> Column:
    """Whole hours since 1970-01-01, as a long: a compact join key for "the same hour"."""
    return F.unix_date(ts.cast("date")).cast("long") * F.lit(24) + F.hour(ts)


def hour_start(ts: Column) -> Column:
    """The timestamp cut to the hour. (``date_trunc`` would return a zoned timestamp.)"""
    zero = F.lit(0)
    return F.make_timestamp_ntz(F.year(ts), F.month(ts), F.day(ts), F.hour(ts), zero, zero)


def from_epoch_ms(ms: Column) -> Column:
    """Milliseconds since 1970-01-01 UTC as a UTC timestamp, whatever zone the machine or the session is in."""
    seconds = (F.when(is_epoch_ms(ms), ms).cast("decimal(18,3)") / F.lit(1000)).cast("decimal(18,6)")
    return F.lit("1970-01-01").cast("timestamp_ntz") + F.make_dt_interval(secs=seconds)


def is_epoch_ms(ms: Column) -> Column:
    """Whether the milliseconds fall in the years 1 to 9999; others, such as nanoseconds, give a null timestamp."""
    return ms.between(-62_135_596_800_000, 253_402_300_799_999)


def from_iso(text: Column) -> Column:
    """``2024-01-31``, ``2024-01-31T05:00``, the same with seconds and up to six decimals, or with a space in the
    middle, as a timestamp; any other text gives null."""
    form = r"^\d{4}-\d{2}-\d{2}([T ]\d{2}:\d{2}(:\d{2}(\.\d{1,6})?)?)?$"
    return F.when(text.rlike(form), text.try_cast("timestamp_ntz"))


def utc(moment: datetime) -> datetime:
    """A zoned moment in UTC, without the zone; one without zone is UTC by convention."""
    return moment.astimezone(timezone.utc).replace(tzinfo=None) if moment.tzinfo else moment
