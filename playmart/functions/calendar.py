"""Epoch and calendar expressions on zone-less timestamps.

Everything stays TIMESTAMP_NTZ, so results do not move with the session time zone.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from playmart.functions.casts import to_long

# Weekday names padded to nine characters, Sunday first.
WEEKDAY_NAMES = (
    "Sunday   ",
    "Monday   ",
    "Tuesday  ",
    "Wednesday",
    "Thursday ",
    "Friday   ",
    "Saturday ",
)
EPOCH = "TIMESTAMP_NTZ '1970-01-01 00:00:00'"
HOUR_MILLIS = 3_600_000
# Years 1 to 2147: beyond, a timestamp or its packed key would overflow.
FIRST_MILLIS, LAST_MILLIS = -62_135_596_800_000, 5_617_123_199_999


def epoch_millis(c: str | Column) -> Column:
    """Epoch milliseconds from text or number; NULL where no timestamp can hold them."""
    millis = to_long(c)
    return F.when(millis.between(FIRST_MILLIS, LAST_MILLIS), millis)


def epoch_millis_to_timestamp(c: str | Column) -> Column:
    """Epoch milliseconds (text or number) as a timestamp, milliseconds kept; NULL out of range."""
    return F.timestamp_add("MILLISECOND", epoch_millis(c), F.expr(EPOCH))


def truncate_to_hour(ts: str | Column) -> Column:
    no_seconds = F.lit(0).cast("decimal(16,6)")
    return F.make_timestamp_ntz(
        F.year(ts), F.month(ts), F.dayofmonth(ts), F.hour(ts), F.lit(0), no_seconds
    )


def time_key(ts: str | Column) -> Column:
    """Year, month, day and hour packed as the digits YYYYMMDDHH."""
    days = F.year(ts).cast("bigint") * 1_000_000 + F.month(ts) * 10_000 + F.dayofmonth(ts) * 100
    return (days + F.hour(ts)).try_cast("int")


def day_of_week(ts: str | Column) -> Column:
    """0 for Sunday up to 6 for Saturday."""
    return F.dayofweek(ts) - 1


def day_name(ts: str | Column) -> Column:
    """English weekday name, blank-padded to nine characters."""
    names = F.array(*[F.lit(n) for n in WEEKDAY_NAMES])
    return F.get(names, day_of_week(ts))


def is_weekend(ts: str | Column) -> Column:
    return day_of_week(ts).isin(0, 6)
