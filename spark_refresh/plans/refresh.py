"""One refresh cycle: new events and the age of waiting tables change the queue."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.priority import score
from ..operators.enrich import or_missing
from ..schemas import QUEUE, QUEUED


def events_per_table(events: DataFrame) -> DataFrame:
    """What a cycle needs to know of a table's events: first, last and number.

    Fixed-width aggregates, hashed and combined in each task: the shuffle carries one row
    per table and task, whatever share of the events one table holds.
    """
    return events.groupBy("source_table").agg(
        F.min("event_time").alias("first_event"),
        F.max("event_time").alias("last_event"),
        F.count(F.lit(1)).alias("n"),
    )


def refresh_cycle(
    events: DataFrame,
    metadata: DataFrame,
    queue: DataFrame,
    asof: datetime | str,
    catalog: str,
) -> DataFrame:
    """The queue after one cycle at ``asof``.

    Equal to enriching every event, giving all waiting and new rows a new priority and
    putting them into the queue one by one, waiting rows first and then by event time.
    A waiting row is put in again with its latest known event, so that this alone never
    moves the watermark back; its age counts from the first one.
    """
    attrs = metadata.select(
        "source_table", F.struct(*(c for c in metadata.columns if c != "source_table")).alias("attrs")
    )
    waiting = queue.join(attrs, "source_table", "left").withColumnRenamed("attrs", "own")
    arriving = events_per_table(events).join(attrs, "source_table")
    both = waiting.join(arriving, "source_table", "full_outer")

    is_new, is_queued = F.col("status").isNull(), F.col("status") == QUEUED
    got = F.col("n").isNotNull()
    updated = F.when(is_new, F.col("n") > 1).otherwise(is_queued & got)

    # Exactly one score per row: of the last event where it updates the row, else of the
    # event the row stands for.
    rated = both.withColumns({
        "updated": updated,
        "rated_event": F.when(updated, F.col("last_event")).otherwise(
            F.coalesce("event_time", "first_event")
        ),
        "rules": F.coalesce("own", "attrs"),
    })
    earned = score(
        F.col("rated_event"), asof,
        F.col("rules.priority"), F.col("rules.min_staleness"), F.col("rules.max_staleness"),
    )
    values = {
        "target_table": F.when(
            is_new, F.concat_ws(".", F.lit(catalog), F.col("attrs.target_table"))
        ).otherwise(F.col("target_table")),
        "event_time": F.coalesce("event_time", "first_event"),
        "strategy": F.coalesce("strategy", "attrs.strategy"),
        "lock_rows": F.coalesce("lock_rows", F.lit(True)),
        "status": F.coalesce("status", F.lit(QUEUED)),
        "priority": F.when(is_new | is_queued, or_missing(earned, F.col("rules").isNotNull()))
        .otherwise(F.col("priority")),
        "event_time_latest": F.when(F.col("updated"), F.col("last_event"))
        .when(is_queued, F.coalesce("event_time_latest", "event_time"))
        .otherwise(F.col("event_time_latest")),
    }
    return rated.select(*(values.get(n, F.col(n)).alias(n) for n in QUEUE.names))
