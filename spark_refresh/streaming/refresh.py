"""Continuous refresh: each micro-batch of tracking events is one cycle.

The state (:class:`~spark_refresh.plans.state.RefreshState`) gets a new queue once per
micro-batch. The number of the batch and the latest event time are written with it, so a
batch that is delivered again after a failure changes nothing, and no cycle reads history.
Events are combined per table before they are shuffled; no Python worker holds the events of
a table. Copies are begun by :class:`~spark_refresh.plans.workers.Workers`, beside the cycles.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping
from datetime import datetime

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.times import as_wall, drop_fraction, local_now
from ..operators.enrich import unmatched
from ..operators.queue import ignored_events
from ..plans.refresh import refresh_cycle
from ..plans.state import RefreshState
from ..sources.scratch import written
from ..sources.tracking import event_wall, tracking_scan

# Fixed value: seconds between two looks at the tracking table.
CADENCE = "120 seconds"

BATCH = "stream_batch"
PLANNED = "planned"


def recover(state: RefreshState, reset: bool = False) -> None:
    """Before a run: empty the state if asked to, else put running rows back in the queue."""
    if reset or not state.exists:
        state.reset()
    else:
        state.recover()


def tracking_stream(
    spark: SparkSession,
    path: str,
    schema: T.StructType,
    source_table: Column,
    event_time: str,
    max_files: int | None = None,
    heartbeat: bool = False,
) -> DataFrame:
    """Tracking events from files as they arrive.

    With ``heartbeat`` every trigger is a cycle, also without new files: waiting tables
    grow older and more urgent. An event delivered again needs no care here: within a
    batch its copies are combined in each task, after it the watermark has passed it.
    """
    reader = spark.readStream.schema(schema)
    if max_files:
        reader = reader.option("maxFilesPerTrigger", max_files)
    raw = reader.parquet(path)
    events = raw.select(
        source_table.alias("source_table"),
        drop_fraction(event_wall(raw, event_time)).alias("event_time"),
    )
    if heartbeat:
        none = [F.lit(None).cast(t).alias(n) for n, t in events.dtypes]
        ticks = spark.readStream.format("rate").option("numPartitions", 1).load()
        events = events.unionByName(ticks.select(*none))
    return events


def known_until(state: RefreshState, start: datetime | str | None = None) -> datetime | str | None:
    """The watermark: the latest event the state knows of, else ``start``."""
    mark = state.latest_event()
    return start if mark is None else mark


def passed_over(
    events: DataFrame, metadata: DataFrame, queue: DataFrame, mark: datetime | str | None
) -> dict[str, DataFrame]:
    """What a cycle leaves out of its events, for an audit: ``late`` ones, those of tables
    without metadata (``unmatched``), and per running table the ``ignored`` ones."""
    late = events.limit(0) if mark is None else events.filter(F.col("event_time") <= as_wall(mark))
    new = events if mark is None else events.filter(F.col("event_time") > as_wall(mark))
    names = metadata.select("source_table")
    return {
        "late": late,
        "unmatched": unmatched(new, metadata),
        "ignored": ignored_events(queue, new).join(names, "source_table", "left_semi"),
    }


def apply_events(
    events: DataFrame,
    metadata: DataFrame,
    state: RefreshState,
    asof: datetime | str,
    catalog: str,
    start: datetime | str | None = None,
    note: Mapping | None = None,
    audit_folder: str | None = None,
) -> None:
    """One cycle on the committed state. Events at or before the watermark are late and
    never read. With ``audit_folder`` what is left out is written there, again under the
    same names if the cycle is repeated; the events are then stored, as they are read more
    than once."""
    events = events.filter(F.col("source_table").isNotNull())
    if audit_folder:
        events = written(events, "events")
    with state.lock:
        queue, mark = state.queue(), known_until(state, start)
        if audit_folder:
            for name, df in passed_over(events, metadata, queue, mark).items():
                df.write.mode("overwrite").parquet(f"{audit_folder}/{name}")
        if mark is not None:
            events = events.filter(F.col("event_time") > as_wall(mark))
        state.put_queue(refresh_cycle(events, metadata, queue, asof, catalog), note)


def poll(
    tracking: DataFrame,
    source_table: Column,
    event_time: str,
    metadata: DataFrame,
    state: RefreshState,
    asof: datetime | str,
    catalog: str,
    start: datetime | str,
    batch_id: int | None = None,
    date_partition: str | None = None,
) -> None:
    """One cycle over a tracking table that is read as a whole, such as one over JDBC.

    Only what happened between the watermark and ``asof`` is read: both bounds go to the
    source, and to its folders by day where ``date_partition`` names such a column. The
    bounds of a batch are written down before it is read: delivered again, it reads the same
    rows, whatever has arrived since.
    """
    note = None
    with state.lock:
        low = known_until(state, start)
        if batch_id is not None:
            planned = state.note().get(PLANNED)
            if not planned or planned["batch"] != batch_id:
                planned = {"batch": batch_id, "low": str(low), "high": str(asof)}
                state.put_note({PLANNED: planned})
            low, asof = planned["low"], planned["high"]
            note = {BATCH: batch_id, PLANNED: planned}
        found = tracking_scan(tracking, source_table, event_time, low, asof, date_partition=date_partition)
        state.put_queue(refresh_cycle(found, metadata, state.queue(), asof, catalog), note)


def start_refresh(
    events: DataFrame,
    metadata: Callable[[], DataFrame],
    state: RefreshState,
    checkpoint: str,
    catalog: str,
    start: datetime | str | None = None,
    asof: Callable[[], datetime | str] = local_now,
    available_now: bool = False,
    cadence: str = CADENCE,
    audit_folder: str | None = None,
):
    """Start the query. ``metadata`` is read anew for each batch."""

    def cycle(batch: DataFrame, batch_id: int) -> None:
        audit = f"{audit_folder}/batch={batch_id}" if audit_folder else None
        apply_events(batch, metadata(), state, asof(), catalog, start, {BATCH: batch_id}, audit)

    return _started(events, _once_per_batch(state, cycle), checkpoint, available_now, cadence)


def start_polling(
    spark: SparkSession,
    tracking: Callable[[], DataFrame],
    source_table: Column,
    event_time: str,
    metadata: Callable[[], DataFrame],
    state: RefreshState,
    checkpoint: str,
    catalog: str,
    start: datetime | str,
    asof: Callable[[], datetime | str] = local_now,
    cadence: str = CADENCE,
    date_partition: str | None = None,
):
    """The same for a tracking table that cannot be streamed: a clock starts the cycles,
    and each reads what is new in the table."""

    def cycle(_: DataFrame, batch_id: int) -> None:
        poll(tracking(), source_table, event_time, metadata(), state, asof(), catalog, start, batch_id, date_partition)

    clock = spark.readStream.format("rate").option("numPartitions", 1).load()
    return _started(clock, _once_per_batch(state, cycle), checkpoint, False, cadence)


def _once_per_batch(state: RefreshState, cycle: Callable[[DataFrame, int], None]) -> Callable[[DataFrame, int], None]:
    def on_batch(batch: DataFrame, batch_id: int) -> None:
        if state.note().get(BATCH, -1) < batch_id:
            cycle(batch, batch_id)

    return on_batch


def _started(df: DataFrame, on_batch, checkpoint: str, available_now: bool, cadence: str):
    trigger = {"availableNow": True} if available_now else {"processingTime": cadence}
    writer = df.writeStream.foreachBatch(on_batch).option("checkpointLocation", checkpoint)
    return writer.trigger(**trigger).start()
