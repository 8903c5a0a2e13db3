"""The change-tracking table: which source table was loaded when."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.times import ZONE, as_wall, drop_fraction, instant, plus_seconds, wall, zone_wall


def tracking_scan(
    events: DataFrame,
    source_table: Column,
    event_time: str,
    watermark: datetime | str,
    asof: datetime | str,
    *keep: str,
    date_partition: str | None = None,
    zone: str = ZONE,
) -> DataFrame:
    """Events after ``watermark`` up to and including ``asof``, to the whole second.

    The bounds are put on the stored column itself: cutting a time to seconds and
    comparing it is the same as comparing the stored time with bounds one second later,
    and only the latter reaches the scan. ``date_partition`` names a column the table is
    partitioned by that holds the date of the event; it prunes folders. Stored instants
    (TIMESTAMP) are shown, and the bounds read, as the wall clock of ``zone``.
    """
    stored = F.col(event_time)
    instants = isinstance(events.schema[event_time].dataType, T.TimestampType)
    if instants and not isinstance(watermark, Column) and not isinstance(asof, Column):
        compared, low, high = stored, instant(watermark, zone), instant(asof, zone)
    else:
        compared = zone_wall(stored, zone) if instants else stored
        low, high = as_wall(watermark), as_wall(asof)
    found = events.filter((compared >= plus_seconds(low, 1)) & (compared < plus_seconds(high, 1)))
    if date_partition:
        found = found.filter(
            F.col(date_partition).between(
                wall(watermark).cast("date"), wall(asof).cast("date")
            )
        )
    return found.select(
        source_table.alias("source_table"),
        drop_fraction(event_wall(events, event_time, zone)).alias("event_time"),
        *keep,
    )


def event_wall(events: DataFrame, event_time: str, zone: str = ZONE) -> Column:
    """A stored event time as wall clock: an instant in ``zone``, anything else as it stands."""
    stored = F.col(event_time)
    if isinstance(events.schema[event_time].dataType, T.TimestampType):
        return zone_wall(stored, zone)
    return stored.cast("timestamp_ntz")


def late_events(events: DataFrame, watermark: datetime | str, arrival: str) -> DataFrame:
    """Events that arrive after the watermark has passed their time: never scanned."""
    mark = as_wall(watermark)
    return events.filter((F.col("event_time") <= mark) & (F.col(arrival) > mark))


def distinct_events(events: DataFrame, offset: str) -> DataFrame:
    """One row per table and time, however often the event was delivered.

    Copies are combined before the shuffle, so an event with many copies is one row in
    each task.
    """
    return events.groupBy("source_table", "event_time").agg(F.min(offset).alias(offset))
