"""Time as numbers, for timestamps without a time zone as well as with one."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def micros(at: Column) -> Column:
    """Microseconds since 1970, read off the clock: no time zone comes in."""
    since = at.cast("timestamp_ntz") - F.lit("1970-01-01 00:00:00").cast("timestamp_ntz")
    return (since.cast("decimal(24,6)") * 1_000_000).cast("bigint")


def after(at: Column, seconds: Column) -> Column:
    """``at`` moved by seconds, exact to a microsecond."""
    return at + F.make_dt_interval(F.lit(0), F.lit(0), F.lit(0), seconds.cast("decimal(18,6)"))
