"""The current time as a zone-free UTC timestamp."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def utc_now() -> Column:
    return F.convert_timezone(None, F.lit("UTC"), F.localtimestamp())


def utc_instant(wall: Column) -> Column:
    """A zone-free UTC time as the instant it names, whatever the session zone.

    Watermarks need instants.
    """
    return F.concat(wall.cast("string"), F.lit("Z")).cast("timestamp")


def utc_wall(instant: Column) -> Column:
    """The instant as a zone-free UTC time."""
    epoch = F.lit("1970-01-01 00:00:00").cast("timestamp_ntz")
    return F.timestamp_add("MICROSECOND", F.unix_micros(instant), epoch)
