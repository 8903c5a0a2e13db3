"""The queue of a batch: a manifest worked off from its first line to its last."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..schemas import BATCH_QUEUE, DEFAULT_SLOTS, QUEUED, RUNNING_ROW
from ..sources.lines import ranked_from_end
from .keys import require_unique
from .queue import in_queue, top_rows


def enqueue(manifest: DataFrame, order: str = "line_no", check: bool = True) -> DataFrame:
    """Batch queue of a manifest: the first line has the highest priority, the last 0.

    ``order`` is a unique whole number per line. A source that occurs twice stops it.
    """
    if check:
        require_unique(manifest, "source")
    return ranked_from_end(manifest, order, "priority").select(
        F.col("source").alias("source_table"),
        F.col("target").alias("target_table"),
        "strategy",
        "lock_rows",
        F.lit(QUEUED).alias("status"),
        "priority",
    )


def claim_rows(queue: DataFrame, slots: Mapping[str, int] | None = None) -> DataFrame:
    """Rows to be taken now. Priority 0 counts here: it is the last line."""
    order = [F.desc("priority"), F.asc("source_table")]
    return top_rows(in_queue(queue), DEFAULT_SLOTS if slots is None else slots, order).drop("claim_rank")


def mark_running(queue: DataFrame, claimed: DataFrame) -> DataFrame:
    """The whole queue with the claimed rows running; its size decides how it is joined."""
    taken = claimed.select("source_table", F.lit(True).alias("taken"))
    status = F.when(F.col("taken").isNotNull(), F.lit(RUNNING_ROW)).otherwise(F.col("status"))
    return (
        queue.join(taken, "source_table", "left")
        .withColumn("status", status)
        .select(*BATCH_QUEUE.names)
    )


def dequeue(queue: DataFrame, finished: DataFrame) -> DataFrame:
    """Running rows of finished tables leave the queue."""
    done = finished.select("source_table", F.lit(True).alias("done"))
    is_gone = F.col("done").isNotNull() & (F.col("status") == RUNNING_ROW)
    return queue.join(done, "source_table", "left").filter(~is_gone).select(*BATCH_QUEUE.names)


def progress(queue: DataFrame, manifest: DataFrame) -> DataFrame:
    """``picked_up`` and ``queued`` of ``total`` tables, from the queue and the manifest."""
    waiting = in_queue(queue).agg(F.count(F.lit(1)).alias("queued"))
    lines = manifest.agg(F.count(F.lit(1)).alias("total"))
    both = waiting.withColumn("total", F.lit(0)).unionByName(lines.withColumn("queued", F.lit(0)))
    sums = both.agg(F.sum("queued").alias("queued"), F.sum("total").alias("total"))
    return sums.select((F.col("total") - F.col("queued")).alias("picked_up"), "queued", "total")
