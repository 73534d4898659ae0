"""Instants: when something happened, and from when it could be known."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

#: Epoch numbers outside these bounds are no plausible instants and become null.
_BOUNDS = {"s": 9 * 10**12, "ms": 9 * 10**15}


def local_midnight(day: Column, zone: str, days_after: int = 0) -> Column:
    """The UTC instant of a zone's midnight of ``day``, or of as many days after it."""
    return F.to_utc_timestamp(F.date_add(day, days_after).cast("timestamp"), zone)


def within_local_day(instant: Column, day: Column, zone: str = "UTC") -> Column:
    """Whether ``instant`` falls into the zone's ``day``: half open, null if either is."""
    return (instant >= local_midnight(day, zone)) & (instant < local_midnight(day, zone, 1))


def from_epoch(number: Column, unit: str) -> Column:
    """An instant from a number of s, ms or us since the epoch; null where it isn't plausible."""
    number = number.try_cast("bigint")
    make = {"s": F.timestamp_seconds, "ms": F.timestamp_millis, "us": F.timestamp_micros}[unit]
    bound = _BOUNDS.get(unit)
    return make(number) if bound is None else make(F.when(F.abs(number) <= bound, number))


def from_rfc3339(text: Column) -> Column:
    """An instant from text; fractions beyond microseconds are cut off, other text is null."""
    return F.regexp_replace(text, r"(\.\d{6})\d+", "$1").try_cast("timestamp")


def duration_class(start: Column, end: Column) -> Column:
    """instant without a start, quarter for 80 to 100 days, annual for 350 to 380, both ends counted; else null."""
    days = F.datediff(end, start) + 1
    return F.when(start.isNull(), "instant").when(days.between(80, 100), "quarter").when(days.between(350, 380), "annual")


def session_end(day: Column, zone: str = "UTC") -> Column:
    """When a session day is over."""
    return local_midnight(day, zone, 1)


def latest(*instants: Column) -> Column:
    """Knowable when all inputs are: the greatest, nulls aside."""
    return F.greatest(*instants)
