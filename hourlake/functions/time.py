"""Time expressions on zone-less UTC timestamps (the session time zone is UTC)."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import Column, functions as F

# Fixed value: stands for "still valid" in half-open intervals.
FAR_FUTURE = datetime(9999, 12, 31)

# ISO-8601 date, optional time, optional offset.
_ISO = r"^\d{4}-\d{2}-\d{2}(?:[Tt ][\d:.]+(?:[Zz]|[+-][\d:]+)?)?$"


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def ntz(value: datetime) -> Column:
    """A naive datetime as a TIMESTAMP_NTZ literal."""
    if value.tzinfo is not None:
        raise ValueError("expected a naive UTC datetime")
    return F.lit(value.isoformat(sep=" ")).cast("timestamp_ntz")


def iso_to_utc(c: Column | str) -> Column:
    """ISO-8601 text to zone-less UTC: an offset is applied, no offset means UTC.

    Goes through an instant on purpose: casting straight to a zone-less timestamp would silently drop
    the offset. Text that is not a timestamp gives NULL.
    """
    text = _col(c)
    return F.when(text.rlike(_ISO), text.try_cast("timestamp")).cast("timestamp_ntz")


def micros(c: Column | str) -> Column:
    return F.unix_micros(_col(c).cast("timestamp"))


def seconds(c: Column | str) -> Column:
    return F.unix_seconds(_col(c).cast("timestamp"))


def elapsed_seconds(start: Column | str, end: Column | str) -> Column:
    """Number of whole-second boundaries between two timestamps."""
    return seconds(end) - seconds(start)


def elapsed_hours(start: Column | str, end: Column | str) -> Column:
    return elapsed_seconds(start, end) / F.lit(3600.0)


def event_date(c: Column | str) -> Column:
    return F.to_date(_col(c))


def event_hour(c: Column | str) -> Column:
    return F.hour(_col(c)).cast("bigint")


def hours_before(end: Column | str, hours: Column | str) -> Column:
    """``end`` minus a fractional number of hours, to the microsecond."""
    return _col(end) - _col(hours) * F.expr("INTERVAL '1' HOUR")
