"""Staleness of an event and the priority it earns."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import Column
from pyspark.sql import functions as F

from .times import as_wall, wall_seconds

# Seconds left until the maximum staleness (exclusive lower bound) and
# the level reached. The first line that holds counts; below all of them it is 25.
LADDER = (
    (60, 1), (45, 2), (30, 3), (15, 4), (10, 5), (5, 6), (3, 7),
    (2, 8), (1, 9), (0, 10), (-5, 15), (-10, 20),
)
OVERDUE = 25


def staleness(event_time: Column, asof: Column | datetime | str) -> Column:
    """Seconds from the event to ``asof``."""
    return wall_seconds(as_wall(asof)) - wall_seconds(event_time)


def ladder(stale: Column, min_staleness: Column, max_staleness: Column) -> Column:
    left = max_staleness - stale
    level = F.when(stale < min_staleness, F.lit(0))
    for bound, value in LADDER:
        level = level.when(left > bound, F.lit(value))
    return level.otherwise(F.lit(OVERDUE))


def score(
    event_time: Column,
    asof: Column | datetime | str,
    priority: Column,
    min_staleness: Column,
    max_staleness: Column,
) -> Column:
    """Ladder level times the priority of the table; 0 means not yet to be claimed."""
    level = ladder(staleness(event_time, asof), min_staleness, max_staleness)
    return (level * priority).cast("int")
