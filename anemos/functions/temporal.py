"""Time expressions. Times are UTC without a zone; the session zone is UTC."""

from __future__ import annotations

import math

from pyspark.sql import Column
from pyspark.sql import functions as F

HOUR_MICROS = 3_600_000_000


def col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def micros(t) -> Column:
    return F.unix_micros(col(t).cast("timestamp"))


def seconds(t) -> Column:
    return micros(t) / F.lit(1e6)


def from_micros(m: Column) -> Column:
    return F.timestamp_micros(m.cast("bigint")).cast("timestamp_ntz")


def local_time(t, zone: str) -> Column:
    return F.convert_timezone(F.lit("UTC"), F.lit(zone), col(t).cast("timestamp_ntz"))


def hour_fraction(t) -> Column:
    c = col(t)
    whole_seconds = F.second(c)
    return F.hour(c) + F.minute(c) / F.lit(60.0) + whole_seconds / F.lit(3600.0)


def _angle(part: Column, whole) -> Column:
    """Angle of a part of a turn, multiplied before it is divided: mirrored angles are near ties, which another order rounds apart."""
    return F.lit(2.0 * math.pi) * part / whole


def hour_of_day_sin(t) -> Column:
    return F.sin(_angle(hour_fraction(t), F.lit(24.0)))


def hour_of_day_cos(t) -> Column:
    return F.cos(_angle(hour_fraction(t), F.lit(24.0)))


def _year_angle(t) -> Column:
    c = col(t)
    year_days = F.dayofyear(F.make_date(F.year(c), F.lit(12), F.lit(31)))
    return _angle(F.dayofyear(c) - 1, year_days.cast("double"))


def day_of_year_sin(t) -> Column:
    return F.sin(_year_angle(t))


def day_of_year_cos(t) -> Column:
    return F.cos(_year_angle(t))


def round_to_hour(t) -> Column:
    """Nearest full hour; a half hour goes to the even hour."""
    hours = F.bround(micros(t) / F.lit(float(HOUR_MICROS)), 0).cast("bigint")
    return from_micros(hours * HOUR_MICROS)


def floor_to_hour(t) -> Column:
    return F.date_trunc("hour", col(t)).cast("timestamp_ntz")


def epoch_seconds(text) -> Column:
    """ISO text to epoch seconds; no zone means UTC, unreadable text is null."""
    return F.unix_micros(F.try_to_timestamp(col(text))) / F.lit(1e6)


def age_seconds(text, now: Column) -> Column:
    """Seconds from ISO text to ``now``, never negative; null where unreadable."""
    age = seconds(now) - epoch_seconds(text)
    return F.when(age < 0, 0.0).otherwise(age)
