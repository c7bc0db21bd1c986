"""Epoch milliseconds, wall-clock time and hour of day.

No result depends on the session time zone: the wall clock is a zone-less timestamp.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

UTC = "UTC"
UNITS = ("ms", "s", "timestamp", "timestamp_ntz")
MILLIS_PER_HOUR = 3_600_000
MILLIS_PER_DAY = 24 * MILLIS_PER_HOUR

_EPOCH = "1970-01-01 00:00:00"


def whole_number(col: Column) -> Column:
    """A 64-bit integer; a fraction is cut off, and text that is no number gives null."""
    return F.coalesce(col.try_cast("bigint"), col.try_cast("double").try_cast("bigint"))


def epoch_millis(col: Column, unit: str = "ms", utc_session: bool = False) -> Column:
    """Epoch milliseconds (rounded down) from a column in ``unit``; a zone-less timestamp is read as UTC.

    ``utc_session`` says that the session zone is UTC, where the wall clock converts at no cost.
    """
    if unit == "ms":
        return whole_number(col)
    if unit == "s":
        # Exact for numbers with a fraction, too.
        return F.floor(col.try_cast("decimal(20,6)") * 1000).cast("bigint")
    if unit == "timestamp":
        return F.unix_millis(col.try_cast("timestamp"))
    if unit == "timestamp_ntz":
        col = col.try_cast("timestamp_ntz")
        if utc_session:
            return F.unix_millis(col.cast("timestamp"))
        days = F.unix_date(col.cast("date")).cast("bigint")
        minutes = F.hour(col) * 60 + F.minute(col)
        millis = F.floor(F.extract(F.lit("SECOND"), col) * 1000)
        return (days * MILLIS_PER_DAY + minutes * 60_000 + millis).cast("bigint")
    raise ValueError(f"unknown time unit {unit!r}; expected one of {', '.join(UNITS)}")


def event_time(millis: Column, zone: str = UTC) -> Column:
    """The wall clock in ``zone`` at the given epoch milliseconds."""
    utc = F.timestamp_add("MILLISECOND", millis, F.lit(_EPOCH).cast("timestamp_ntz"))
    return utc if zone == UTC else F.convert_timezone(F.lit(UTC), F.lit(zone), utc)


def hour_of_day(millis: Column, zone: str = UTC) -> Column:
    """Hour 0-23 on the wall clock in ``zone``; in UTC it is plain arithmetic."""
    if zone == UTC:
        return F.floor(F.pmod(millis, F.lit(MILLIS_PER_DAY)) / MILLIS_PER_HOUR).cast("int")
    return F.hour(event_time(millis, zone))
