"""Column expressions for trip times.  All stay inside whole-stage codegen."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

# Fixed value: the time format of trip files, with padded or unpadded parts.
TRIP_TIME_PATTERN = r"^\d{4}-\d{1,2}-\d{1,2} \d{1,2}:\d{1,2}:\d{1,2}\z"


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def strip_fraction(c: Column | str) -> Column:
    """Text up to the first dot: ``10:00:03.123`` becomes ``10:00:03``."""
    return F.substring_index(_col(c), ".", 1)


def strict_time(c: Column | str) -> Column:
    """Parse the fixed trip format; anything else becomes null instead of failing.

    The pattern admits only that format, and a cast then reads it.  The cast is about twice as
    fast as parsing with a format and needs no session zone.
    """
    text = _col(c)
    return F.when(text.rlike(TRIP_TIME_PATTERN), text.try_cast("timestamp_ntz"))


def lenient_time(c: Column | str) -> Column:
    """Parse any ISO-like text, null when it cannot be read; timestamps pass through."""
    return F.try_to_timestamp(_col(c).cast("string")).cast("timestamp_ntz")


def floor_hour(c: Column | str) -> Column:
    """Start of the clock hour, in whole seconds: half the cost of truncating by unit."""
    seconds = F.unix_seconds(to_utc(c))
    return drop_zone(F.timestamp_seconds(seconds - F.pmod(seconds, F.lit(3600))))


def floor_hours(c: Column | str, hours: int) -> Column:
    """Start of the midnight-aligned bin of ``hours`` hours (``hours`` divides a day)."""
    c = _col(c)
    whole = F.floor(F.hour(c) / F.lit(hours)) * F.lit(hours)
    return (F.date_trunc("day", c) + F.make_interval(hours=whole.cast("int"))).cast("timestamp_ntz")


def monday_weekday(c: Column | str) -> Column:
    """Day of the week with Monday = 0."""
    return F.weekday(_col(c))


def to_utc(c: Column | str) -> Column:
    """Attach the UTC zone to a zoneless time (the session zone is UTC)."""
    return _col(c).cast("timestamp")


def drop_zone(c: Column | str) -> Column:
    return _col(c).cast("timestamp_ntz")
