"""Time arithmetic on zone-less timestamps.

Nothing here passes through an instant, so results do not depend on the
session time zone, and bounds are literals that reach the Parquet scan.
"""

from __future__ import annotations

from datetime import datetime, timedelta

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

NTZ = "timestamp_ntz"
EPOCH = "1970-01-01 00:00:00"


def moment(value: datetime | str) -> Column:
    """A zone-less timestamp literal."""
    text = value if isinstance(value, str) else value.isoformat(sep=" ")
    return F.lit(text).cast(NTZ)


def as_datetime(value: datetime | str) -> datetime:
    return value if isinstance(value, datetime) else datetime.fromisoformat(value)


def hour_of(ts: Column | str) -> Column:
    """Start of the hour."""
    ts = F.col(ts) if isinstance(ts, str) else ts
    return F.timestamp_add("HOUR", F.hour(ts), F.to_date(ts).cast(NTZ))


def day_start(ts: Column | str) -> Column:
    """Start of the day, as a timestamp."""
    return F.to_date(ts).cast(NTZ)


def day_of(ts: Column | str) -> Column:
    """The calendar day, as a date."""
    return F.to_date(ts)


def bucket(ts: Column | str, width: str) -> Column:
    """Start of the ``width`` wide bucket, e.g. ``"15 minutes"``."""
    return F.window(ts, width).getField("start")


def year_of(ts: Column | str) -> Column:
    return F.year(ts)


def micros_between(later: Column, earlier: Column) -> Column:
    """Microseconds between two timestamps, exactly."""
    seconds = (later - earlier).cast(T.DayTimeIntervalType(T.DayTimeIntervalType.SECOND))
    return (seconds.cast("decimal(24,6)") * 1_000_000).cast("bigint")


def epoch_days(later: Column, earlier: Column) -> Column:
    """Time between two timestamps in days, with fractions."""
    return micros_between(later, earlier) / F.lit(1e6) / F.lit(86400)


def to_instant(ts: Column) -> Column:
    """A zone-less timestamp as the instant it names in UTC."""
    return F.timestamp_micros(micros_between(ts, moment(EPOCH)))


def from_instant(instant: Column) -> Column:
    """The zone-less timestamp an instant reads as in UTC."""
    return F.timestamp_add("MICROSECOND", F.unix_micros(instant), moment(EPOCH))


def hour_floor(value: datetime) -> datetime:
    return value.replace(minute=0, second=0, microsecond=0)


def hour_ceil(value: datetime) -> datetime:
    floor = hour_floor(value)
    return floor if floor == value else floor + timedelta(hours=1)
