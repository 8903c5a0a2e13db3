"""The keyed work queue and its history.

A queue row is absent, queued (Q) or running (R); a history row is RUNNING, SUCCESS or
FAILED. Running rows are few; what has finished is only ever added to, and an event that was
processed again is shown as it went last. Claims and finishes give the rows that change, not
the whole state; :class:`spark_refresh.plans.state.RefreshState` keeps them.

The queue has one row per table, the history one per table and event time, so joins by
these keys meet at most one row on either side and no key can be hot. Incoming rows can
repeat a key at will; they are combined per key before they are shuffled.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from datetime import datetime
from functools import reduce
from typing import NamedTuple

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.times import as_wall
from ..schemas import (
    DEFAULT_SLOTS, HISTORY, QUEUE, QUEUED, RUNNING, RUNNING_ROW,
)
from ..sources.scratch import written

PAIR = ["source_table", "event_time"]

# Up to this rank Spark limits the rows of a window in each task.
RANKS = "spark.sql.optimizer.windowGroupLimitThreshold"


class Claim(NamedTuple):
    """Rows taken, the queue rows that change by it, and the history rows that begin."""

    claimed: DataFrame
    changed: DataFrame
    started: DataFrame


class Finish(NamedTuple):
    """Tables that leave the queue, and the history rows of what has finished."""

    gone: DataFrame
    finished: DataFrame


def with_changes(queue: DataFrame, changed: DataFrame | None = None, gone: DataFrame | None = None) -> DataFrame:
    """The queue with some rows changed and some gone, by table."""
    if gone is not None:
        queue = queue.join(gone.select("source_table"), "source_table", "left_anti")
    if changed is None:
        return queue.select(*QUEUE.names)
    kept = queue.join(changed.select("source_table"), "source_table", "left_anti")
    return kept.select(*QUEUE.names).unionByName(changed.select(*QUEUE.names))


def current_history(running: DataFrame, finished: DataFrame) -> DataFrame:
    """All history: running rows, and of each other event how it went last."""
    last = Window.partitionBy(*PAIR).orderBy(F.desc("finish_time"), F.desc("trigger_time"), "status")
    once = finished.withColumn("_nth", F.row_number().over(last)).where("_nth = 1")
    others = once.join(running.select(*PAIR), PAIR, "left_anti")
    return others.select(*HISTORY.names).unionByName(running.select(*HISTORY.names))


def in_queue(queue: DataFrame) -> DataFrame:
    return queue.filter(F.col("status") == QUEUED)


def queue_length(queue: DataFrame) -> DataFrame:
    return in_queue(queue).agg(F.count(F.lit(1)).alias("queued"))


def last_load_time(queue: DataFrame, history: DataFrame) -> DataFrame:
    """The latest event the state knows of, NULL if it is empty."""
    in_q = queue.agg(F.max(F.coalesce("event_time_latest", "event_time")).alias("et"))
    in_h = history.agg(F.max("event_time").alias("et"))
    return in_q.unionByName(in_h).agg(F.max("et").alias("last_load_time"))


def watermark(queue: DataFrame, history: DataFrame, start: datetime | str) -> DataFrame:
    """Where the next scan starts: the latest known event, else the configured time."""
    return last_load_time(queue, history).select(
        F.coalesce("last_load_time", as_wall(start)).alias("watermark")
    )


# -- upsert


def combine_incoming(incoming: DataFrame, order: Sequence[str]) -> DataFrame:
    """Per table the first and the last incoming row in the given order, and how many
    there are. The first is what an insert takes, the last what an update takes.

    In two phases: the bounds of the first column of the order are fixed-width aggregates,
    hashed in each task; only the rows at the bounds are then put in order.
    """
    key, at = F.col(order[0]), "source_table"
    bounds = incoming.groupBy(at).agg(
        F.min(key).alias("_low"), F.max(key).alias("_high"), F.max(key.isNull()).alias("_unset"),
        F.count(F.lit(1)).alias("n"), F.max(F.col("status") != QUEUED).alias("wrong"),
    )
    at_low = F.when(F.col("_unset"), key.isNull()).otherwise(key == F.col("_low"))
    at_high = key.eqNullSafe(F.col("_high"))
    ends = incoming.join(bounds, at)
    row = F.struct(*(c for c in QUEUE.names if c != at)).alias("first")

    def best(rows: DataFrame, *sequence: Column) -> DataFrame:
        return rows.withColumn("_nth", F.row_number().over(Window.partitionBy(at).orderBy(*sequence))).where("_nth = 1")

    first = best(ends.where(at_low), *(F.asc_nulls_first(c) for c in order)).select(at, row, "n", "wrong")
    last = best(ends.where(at_high), *(F.desc_nulls_last(c) for c in order))
    return first.join(last.select(at, F.struct("priority", "event_time").alias("last")), at)


def upsert(queue: DataFrame, incoming: DataFrame, order: Sequence[str]) -> DataFrame:
    """The queue after the incoming rows were put in, one after the other.

    A new table is inserted. A queued one takes the priority of the last incoming row and
    its time as the latest event. A running one is left as it is.
    """
    merged = queue.join(combine_incoming(incoming, order), "source_table", "full_outer")
    stop = F.raise_error(F.lit("incoming rows must be queued")).cast("boolean")
    merged = merged.filter(F.when(F.coalesce("wrong", F.lit(False)), stop).otherwise(True))
    is_new, is_queued = F.col("status").isNull(), F.col("status") == QUEUED
    got, repeated = F.col("n").isNotNull(), F.col("n") > 1

    def value(name: str) -> Column:
        kept = F.when(is_new, F.col(f"first.{name}")).otherwise(F.col(name))
        if name == "priority":
            return F.when((is_new & repeated) | (is_queued & got), F.col("last.priority")).otherwise(kept)
        if name == "event_time_latest":
            return F.when((is_new & repeated) | (is_queued & got), F.col("last.event_time")).otherwise(kept)
        return kept

    names = [n for n in QUEUE.names if n != "source_table"]
    return merged.select("source_table", *(value(n).alias(n) for n in names))


def ignored_events(queue: DataFrame, incoming: DataFrame) -> DataFrame:
    """Per running table the incoming rows an upsert passes over: their number and time
    span. A watermark that moves past them loses them."""
    running = queue.filter(F.col("status") == RUNNING_ROW).select("source_table")
    per_table = incoming.groupBy("source_table").agg(
        F.count(F.lit(1)).alias("ignored"),
        F.min("event_time").alias("first_event"),
        F.max("event_time").alias("last_event"),
    )
    return per_table.join(running, "source_table", "left_semi")


# -- claim


def claimable(queue: DataFrame, positive_only: bool = True) -> DataFrame:
    ready = in_queue(queue)
    return ready.filter(F.col("priority") > 0) if positive_only else ready


def top_rows(
    ready: DataFrame, slots: Mapping[str, int], order: Sequence[Column], rank: str = "claim_rank"
) -> DataFrame:
    """The best rows of each strategy, as many as it has free slots.

    Each task keeps only that many rows of a strategy before the shuffle, whatever share of
    the queue the strategy holds: by the limited rank of a window for few slots, by an
    ordered limit per strategy where slots are more than Spark limits ranks for.
    """
    free = {s: k for s, k in slots.items() if k > 0}
    if not free:
        return ready.limit(0).withColumn(rank, F.lit(0))
    window = Window.partitionBy("strategy").orderBy(*order)
    ranked = F.row_number().over(window)
    if max(free.values()) > int(ready.sparkSession.conf.get(RANKS)):
        best = [ready.filter(F.col("strategy") == s).orderBy(*order).limit(k) for s, k in free.items()]
        return reduce(DataFrame.unionByName, best).withColumn(rank, ranked)
    limit = reduce(
        lambda chain, item: chain.when(F.col("strategy") == item[0], F.lit(item[1])),
        list(free.items())[1:],
        F.when(F.col("strategy") == next(iter(free)), F.lit(next(iter(free.values())))),
    )
    return (
        ready.filter(F.col("strategy").isin(*free))
        .withColumn(rank, ranked)
        .filter(F.col(rank) <= max(free.values()))
        .filter(F.col(rank) <= limit)
    )


def claim_rows(
    queue: DataFrame, slots: Mapping[str, int] | None = None, gate: Column | None = None
) -> DataFrame:
    """Rows to be taken now, highest priority first; ties go to the older event.

    ``gate`` holds back rows it is not true for, for example in the first minutes of an hour
    (:func:`~spark_refresh.functions.times.claims_open`).
    """
    ready = claimable(queue) if gate is None else claimable(queue).filter(gate)
    order = [F.desc("priority"), F.asc("event_time"), F.asc("source_table")]
    return top_rows(ready, DEFAULT_SLOTS if slots is None else slots, order).drop("claim_rank")


def running_rows(claimed: DataFrame) -> DataFrame:
    """The history rows of running queue rows."""
    fixed = {"status": F.lit(RUNNING)}
    return claimed.select(*(
        fixed.get(f.name, F.col(f.name) if f.name in claimed.columns else F.lit(None)).cast(f.dataType).alias(f.name)
        for f in HISTORY.fields
    ))


def claim(
    queue: DataFrame, running: DataFrame, asof: datetime | str, slots: Mapping[str, int] | None = None,
    gate: Column | None = None,
) -> Claim:
    """Take rows: what changes in the queue, and the history rows that begin.

    An event that runs already (``running``) begins no second row. The rows taken are stored
    first: they are few, and all results must agree on them.
    """
    claimed = written(claim_rows(queue, slots, gate), "claimed")
    changed = claimed.withColumns({"status": F.lit(RUNNING_ROW), "trigger_time": as_wall(asof)}).select(*QUEUE.names)
    started = running_rows(changed).join(running.select(*PAIR), PAIR, "left_anti").select(*HISTORY.names)
    return Claim(claimed, changed, started)


# -- requeue and finish


def requeue(queue: DataFrame) -> DataFrame:
    """After a crash: the running rows, queued again. Their history rows are dropped."""
    return queue.filter(F.col("status") == RUNNING_ROW).withColumn("status", F.lit(QUEUED)).select(*QUEUE.names)


def one_per_event(outcomes: DataFrame) -> DataFrame:
    """One outcome of each event, the one that ended last: a load that was reported twice is one load."""
    values = [c for c in outcomes.columns if c not in PAIR]
    first = [c for c in ("finish_time", "status") if c in values]
    row = F.struct(*first, *(c for c in values if c not in first))
    return outcomes.groupBy(*PAIR).agg(F.max(row).alias("row")).select(*PAIR, *(F.col(f"row.{c}").alias(c) for c in values))


def finish(queue: DataFrame, running: DataFrame, outcomes: DataFrame) -> Finish:
    """Running rows that are done leave the queue; their history gets the outcome.

    ``outcomes`` has the pair, ``status``, ``finish_time``, ``duration_min``,
    ``num_records`` and ``error``.
    """
    known = one_per_event(outcomes)
    gone = queue.filter(F.col("status") == RUNNING_ROW).join(known.select(*PAIR), PAIR, "left_semi").select("source_table")
    facts = ["status", "finish_time", "duration_min", "num_records", "error"]
    old = running.select(*(c for c in HISTORY.names if c not in facts))
    finished = old.join(known.select(*PAIR, *facts), PAIR).select(
        *(F.col(f.name).cast(f.dataType).alias(f.name) for f in HISTORY.fields))
    return Finish(gone, finished)
