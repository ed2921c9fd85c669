"""Time conversions that do not depend on the session time zone."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Milliseconds of 0001-01-01 and 9999-12-31 23:59:59.999, the range of a timestamp.
MIN_MILLIS = -62135596800000
MAX_MILLIS = 253402300799999


def millis_to_utc(millis: Column) -> Column:
    """Epoch milliseconds to the UTC wall clock (``timestamp_ntz``); null outside years 1-9999."""
    epoch = F.lit("1970-01-01 00:00:00").cast("timestamp_ntz")
    return F.when(millis.between(MIN_MILLIS, MAX_MILLIS), F.timestamp_add("MILLISECOND", millis, epoch))


def utc_to_millis(wall_clock: Column) -> Column:
    """The UTC wall clock (``timestamp_ntz``) to epoch milliseconds."""
    epoch = F.lit("1970-01-01 00:00:00").cast("timestamp_ntz")
    return F.timestamp_diff("MILLISECOND", epoch, wall_clock)


def millis_to_text(millis: Column, zone: str) -> Column:
    """Epoch milliseconds to ``yyyy-MM-dd HH:mm:ss`` text in a time zone.

    In a UTC session the shifted instant is formatted as it is, which is faster.
    In another zone that would fail where its clocks jump, so the text is taken
    from the wall clock.  The session zone is a constant of the plan, so the
    optimizer keeps one of the two only.
    """
    inside = millis.between(MIN_MILLIS, MAX_MILLIS)
    shifted = F.from_utc_timestamp(F.timestamp_millis(millis), zone)
    fast = F.date_format(shifted, "yyyy-MM-dd HH:mm:ss")
    local = F.convert_timezone(F.lit("UTC"), F.lit(zone), millis_to_utc(millis))
    exact = F.substring(local.cast("string"), 1, 19)
    in_utc = F.current_timezone().isin("UTC", "Etc/UTC", "GMT", "Z")
    return F.when(in_utc, F.when(inside, fast)).otherwise(exact)


def now_text() -> Column:
    """The current time as ``yyyy-MM-dd HH:mm:ss`` text."""
    return F.date_format(F.current_timestamp(), "yyyy-MM-dd HH:mm:ss")
