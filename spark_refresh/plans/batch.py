"""Reloading many tables at once: a batch queue worked off from its first line to its last.

The queue of a batch is state as the other one is: claims are driven by free slots, a claim
or a finish adds the rows that change. The driver holds the tables in flight, not the manifest.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from datetime import datetime
from threading import RLock

from pyspark.sql import Column, DataFrame, Row, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..operators import batch as queue_rules
from ..schemas import BATCH_QUEUE, DEFAULT_SLOTS, RUN, RUNNING_ROW
from ..sources.scratch import fresh_folder
from ..sources.versions import Versions
from .report import append_report
from .state import GONE, PARTS, latest_rows
from .workers import Load, Workers

REPORT_ROWS = 500




class BatchState:
    """The queue of a batch below a folder."""

    def __init__(self, spark: SparkSession, folder: str):
        self.spark, self.lock = spark, RLock()
        self.table = Versions(spark, folder, T.StructType([*BATCH_QUEUE.fields, T.StructField(GONE, T.BooleanType())]))

    def put_queue(self, queue: DataFrame) -> None:
        with self.lock:
            self.table.replace(queue.withColumn(GONE, F.lit(False)))

    def queue(self) -> DataFrame:
        return latest_rows(self.table, BATCH_QUEUE.names)

    def progress(self, manifest: DataFrame) -> Row:
        """How many tables were picked up, wait, and are there in all."""
        return queue_rules.progress(self.queue(), manifest).first()

    def advance(
        self, done: Sequence[Row], slots: Mapping[str, int], asof: datetime | str, gate: Column | None = None,
    ) -> list[Row]:
        """Take what is done out of the queue and claim lines for free slots, in one change."""
        with self.lock:
            taken = queue_rules.claim_rows(self.queue(), slots).collect() if any(k > 0 for k in slots.values()) else []
            names = [*BATCH_QUEUE.names, GONE]
            rows = [r.asDict() | {"status": RUNNING_ROW, GONE: False} for r in taken]
            rows += [dict.fromkeys(names) | {"source_table": r["table"], GONE: True} for r in done]
            if rows:
                changed = self.spark.createDataFrame([tuple(r[n] for n in names) for r in rows], self.table.schema)
                self.table.add(changed.coalesce(1))
                if len(self.table.marks()) > PARTS:
                    self.put_queue(self.queue())
            return taken


class BatchWorkers(Workers):
    """Workers whose finished copies are runs to report, some hundred at a time."""

    def __init__(self, state: BatchState, load: Load, slots: Mapping[str, int], report_folder: str, run_folder: str):
        super().__init__(state, load, slots)
        self.report_folder, self.run_folder, self.runs = report_folder, run_folder, []

    def _record(self, row: Row, run: dict) -> Row:
        done = Row(**{n: run[n] for n in RUN.names})
        self.runs.append(done)
        if len(self.runs) >= REPORT_ROWS:
            self.flush()
        return done

    def flush(self) -> None:
        if self.runs:
            runs = self.state.spark.createDataFrame([tuple(r) for r in self.runs], RUN).coalesce(1)
            runs.write.mode("append").parquet(self.run_folder)
            append_report(runs, self.report_folder)
            self.runs = []


def batch_reload(
    spark: SparkSession,
    queue: DataFrame,
    load: Callable[[Row], int],
    report_folder: str,
    run_folder: str,
    slots: Mapping[str, int] | None = None,
    state: BatchState | None = None,
) -> DataFrame:
    """Copy every table of a batch queue; the runs as a DataFrame.

    ``load`` copies the table of a queue row and gives its number of rows; if it fails the
    others go on. A strategy with 0 slots is switched off: its rows stay queued. Runs are
    added to the report and to ``run_folder`` as they finish. ``state`` keeps the queue, for
    a look at the progress from beside.
    """
    state = state or BatchState(spark, fresh_folder(spark, "batch-queue"))
    state.put_queue(queue)
    workers = BatchWorkers(state, load, DEFAULT_SLOTS if slots is None else slots, report_folder, run_folder)
    try:
        workers.drain()
    finally:  # what has finished is reported, also if the queue cannot be read on
        workers.stop()
        workers.flush()
    return spark.read.schema(RUN).parquet(run_folder)
