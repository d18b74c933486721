"""Timestamp text and trip durations over wall-clock timestamps.

Build these inside `session.utc`: the casts below read the session zone, and only under
UTC do they follow the wall clock on days when a zone changes its offset.
"""

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed value: text form of a timestamp; a fraction of a second is cut off.
TEXT_FORMAT = "yyyy-MM-dd HH:mm:ss"

SECONDS_PER_HOUR = 3600.0
MICROS_PER_SECOND = 1_000_000.0


def timestamp_text(at: Column) -> Column:
    return F.date_format(at, TEXT_FORMAT)


def hours_by_second(start: Column, end: Column) -> Column:
    """Hours between the whole seconds of two timestamps."""
    return (_epoch_seconds(end) - _epoch_seconds(start)) / F.lit(SECONDS_PER_HOUR)


def hours_by_fraction(start: Column, end: Column) -> Column:
    """Hours between two timestamps, microseconds included.

    Seconds first, hours second: two roundings, in the order a frame library takes them.
    """
    micros = F.unix_micros(end.cast("timestamp")) - F.unix_micros(start.cast("timestamp"))
    return micros / F.lit(MICROS_PER_SECOND) / F.lit(SECONDS_PER_HOUR)


def _epoch_seconds(at: Column) -> Column:
    return at.cast("timestamp").cast("long")
