"""Events that are delivered again or late, by streaming state in event time.

The refresh cycle needs neither (it combines the events of a table, and its watermark passes
them); this is for streams whose events themselves are wanted, once each. Spark keeps the keys
of events until the watermark has passed them by the delay, and drops what is older than the
watermark, which it counts.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame

# What tells one event from another where it has no number of its own.
KEY = ("source_table", "event_time")


def once_each(events: DataFrame, delay: str, key: Sequence[str] = KEY, event_time: str = "event_time") -> DataFrame:
    """The events of a stream without those delivered again within ``delay`` (such as ``2 hours``)
    and without those later than it."""
    return events.withWatermark(event_time, delay).dropDuplicatesWithinWatermark(list(key))


def late_rows(run) -> int:
    """How many rows a finished or running query has dropped for being late."""
    return sum(int(o.numRowsDroppedByWatermark) for p in run.recentProgress for o in p.stateOperators)
