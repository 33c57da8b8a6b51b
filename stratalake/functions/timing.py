"""Time columns that mean the same in every session time zone."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def utc_instant(wall_clock: str | Column) -> Column:
    """The instant at which UTC clocks show ``wall_clock`` (a zoneless timestamp).

    Event-time operators need instants; a plain cast would read the wall clock
    in the session's zone.
    """
    column = F.col(wall_clock) if isinstance(wall_clock, str) else wall_clock
    return F.concat(column.cast("string"), F.lit("Z")).cast("timestamp")


def utc_wall_clock(instant: str | Column) -> Column:
    """What UTC clocks show at ``instant``, as a zoneless timestamp."""
    column = F.col(instant) if isinstance(instant, str) else instant
    seconds = (F.unix_micros(column) / F.lit(1_000_000)).cast("decimal(18,6)")
    since_epoch = F.make_dt_interval(F.lit(0), F.lit(0), F.lit(0), seconds)
    return F.lit("1970-01-01 00:00:00").cast("timestamp_ntz") + since_epoch


def stamp_arrival(df: DataFrame, column: str = "eventTime") -> DataFrame:
    """Set ``column`` to the time the row is processed, replacing any earlier stamp."""
    return df.withColumn(column, F.current_timestamp())
