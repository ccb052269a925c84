"""Time expressions. All inputs are TIMESTAMP_NTZ; nothing here depends on the session zone.

Some built-ins (``timestamp_diff``, ``date_format``) read a TIMESTAMP_NTZ through the
session zone, which moves wall-clock times that fall in a daylight-saving gap.
Differences are therefore taken as NTZ - NTZ (an interval computed without a
zone) and labels are assembled from zone-free parts.
"""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import Column
from pyspark.sql import functions as F

from ..schema import DISPLAY_MISSING, DISPLAY_ZONE, DISPLAY_ZONE_ABBREV

MICROS_PER_HOUR = 3_600_000_000.0


def _epoch() -> Column:
    return F.lit("1970-01-01 00:00:00").cast("timestamp_ntz")


def _col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def micros_between(start, end) -> Column:
    """Signed microseconds from ``start`` to ``end`` (bigint, exact, zone-free)."""
    return F.call_function("div", (_col(end) - _col(start)).cast("interval second"), F.expr("interval '0.000001' second"))


def epoch_micros(ts) -> Column:
    """Microseconds from 1970-01-01 00:00 to the wall-clock ``ts`` (zone-free)."""
    return micros_between(_epoch(), ts)


def hours_between(start, end) -> Column:
    """Signed fractional hours, NULL when either side is NULL."""
    return micros_between(start, end).cast("double") / F.lit(MICROS_PER_HOUR)


def day_start(ts) -> Column:
    """Midnight of the same wall-clock day, as TIMESTAMP_NTZ."""
    return F.to_date(_col(ts)).cast("timestamp_ntz")


def month_start(ts) -> Column:
    """First instant of the wall-clock month, as TIMESTAMP_NTZ."""
    return F.trunc(F.to_date(_col(ts)), "month").cast("timestamp_ntz")


def as_ntz(value) -> Column:
    """A Python date/datetime (or column) as a TIMESTAMP_NTZ column."""
    if isinstance(value, Column):
        return value.cast("timestamp_ntz")
    if isinstance(value, _dt.datetime):
        # via text: a naive datetime literal would pass through the process/session zone
        return F.lit(value.replace(tzinfo=None).isoformat(sep=" ")).cast("timestamp_ntz")
    if isinstance(value, _dt.date):
        return F.lit(value.isoformat() + " 00:00:00").cast("timestamp_ntz")
    return F.lit(value).cast("timestamp_ntz")


def days_before(as_of, days: int) -> Column:
    """``as_of - days`` (inclusive lower bound of a trailing window)."""
    return as_ntz(as_of) - F.make_dt_interval(days=F.lit(int(days)))


def months_before_month_start(as_of, months: int) -> Column:
    """First day of ``as_of``'s month, minus ``months`` months."""
    start = F.trunc(F.to_date(as_ntz(as_of)), "month")
    return F.add_months(start, -int(months)).cast("timestamp_ntz")


def zone_offset_hours(ts, zone: str = DISPLAY_ZONE) -> Column:
    """UTC offset (whole hours) that ``zone`` has at wall-clock ``ts``.

    The wall clock is moved into a TIMESTAMP without going through the session
    zone (epoch micros of the wall clock), then rebased from ``zone`` to UTC.
    """
    wall_us = epoch_micros(ts)
    as_utc_wall = F.timestamp_micros(wall_us)
    instant = F.to_utc_timestamp(as_utc_wall, zone)
    shift = F.unix_micros(instant) - wall_us
    return (-(shift / F.lit(MICROS_PER_HOUR))).cast("int")


def display_local(ts, zone: str = DISPLAY_ZONE) -> Column:
    """``YYYY-MM-DD hh:mm AM EST`` for a naive local timestamp; NULL -> 'Unavailable'.

    A wall-clock time in the repeated autumn hour has two readings; the earlier
    (daylight-saving) one is used, as Python's default ``fold=0`` does.
    """
    c = _col(ts)
    off = zone_offset_hours(c, zone)
    abbrev = F.lit(None).cast("string")
    for hours, name in DISPLAY_ZONE_ABBREV.items():
        abbrev = F.when(off == hours, F.lit(name)).otherwise(abbrev)
    hour = F.hour(c)
    clock = F.format_string("%s %02d:%02d %s", F.to_date(c).cast("string"), (hour + 11) % 12 + 1,
                            F.minute(c), F.when(hour < 12, F.lit("AM")).otherwise(F.lit("PM")))
    label = F.concat_ws(" ", clock, abbrev)
    return F.when(c.isNull(), F.lit(DISPLAY_MISSING)).otherwise(label)


def to_timestamp_lenient(c) -> Column:
    """Unparseable -> NULL (never raises under ANSI mode)."""
    return _col(c).try_cast("timestamp_ntz")
