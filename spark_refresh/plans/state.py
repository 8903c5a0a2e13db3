"""What a refresh remembers: the queue, what runs, what has finished, and how far it has read.

The queue is one table (:class:`~spark_refresh.sources.versions.Versions`): each cycle writes
all of it, as it rates every waiting row anew; a claim or a finish adds only the rows that
change. What runs is what the queue shows as running. What has finished is appended to a
Parquet table partitioned by the month, written before the queue is: after a crash between the
two the load is done again, and the history shows how an event went last. The latest event
time is kept as a maximum that each cycle merges its own into, so no cycle reads history.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from datetime import datetime
from threading import RLock

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, Row, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..operators.queue import claim_rows, current_history, last_load_time, requeue, running_rows
from ..schemas import HISTORY, QUEUE, RUNNING_ROW
from ..sources.versions import Versions

GONE = "gone"
MARK = "watermark"
PARTS = 24  # changes on top of a whole queue before it is written anew
MONTH = "finish_month"


def latest_rows(table: Versions, names: Sequence[str], key: str = "source_table") -> DataFrame:
    """The rows of the first part, but for keys that changed since, and what these are now.

    Only the changes are put in order; the first part is not shuffled for as long as they are
    few enough for Spark to broadcast.
    """
    rows = table.read("_change")
    whole = rows.where("_change = 0")
    if len(table.marks()) <= 1:
        return whole.select(*names)
    changes = rows.where("_change > 0")
    last = changes.groupBy(key).agg(F.max("_change").alias("_change"))
    now = changes.join(last, [key, "_change"], "left_semi").where(~F.coalesce(F.col(GONE), F.lit(False)))
    return whole.join(last.select(key), key, "left_anti").select(*names).unionByName(now.select(*names))


class RefreshState:
    """The state below a folder. ``lock`` is held by whoever changes it: a cycle, or workers."""

    def __init__(self, spark: SparkSession, folder: str):
        self.spark, self.folder, self.lock = spark, folder.rstrip("/"), RLock()
        self.table = Versions(spark, f"{self.folder}/queue", T.StructType([*QUEUE.fields, T.StructField(GONE, T.BooleanType())]))

    # -- reading

    def queue(self) -> DataFrame:
        return latest_rows(self.table, QUEUE.names)

    def running(self) -> DataFrame:
        return running_rows(self.queue().where(F.col("status") == RUNNING_ROW))

    def finished(self) -> DataFrame:
        """All that was ever appended; :func:`current_history` shows each event once."""
        try:
            return self.spark.read.schema(HISTORY).parquet(f"{self.folder}/finished").select(*HISTORY.names)
        except AnalysisException as error:
            if error.getCondition() != "PATH_NOT_FOUND":
                raise
            return self.spark.createDataFrame([], HISTORY)

    def history(self) -> DataFrame:
        return current_history(self.running(), self.finished())

    @property
    def exists(self) -> bool:
        return self.table.exists

    def note(self) -> dict:
        return self.table.note()

    def latest_event(self) -> datetime | None:
        """The latest event time any cycle has put into the queue."""
        text = self.note().get(MARK)
        return datetime.fromisoformat(text) if text else None

    # -- writing

    def put_queue(self, queue: DataFrame, note: Mapping | None = None) -> None:
        """Write a whole queue; the latest event is measured on the way and merged."""
        given = (self.note() if note is None else dict(note)) | {MARK: self.note().get(MARK)}

        def merged(found: dict) -> dict:
            marks = [m for m in (given[MARK], found["latest"] and found["latest"].isoformat(sep=" ")) if m]
            return {k: v for k, v in given.items() if k != MARK} | ({MARK: max(marks)} if marks else {})

        latest = F.max(F.coalesce("event_time_latest", "event_time"))
        with self.lock:
            self.table.replace(queue.withColumn(GONE, F.lit(False)), merged, measured={"latest": latest})

    def change(self, changed: DataFrame) -> None:
        """Add rows of the queue that change; with ``gone`` set they leave it."""
        if GONE not in changed.columns:
            changed = changed.withColumn(GONE, F.lit(False))
        with self.lock:
            self.table.add(changed.select(*QUEUE.names, GONE))
            if len(self.table.marks()) > PARTS:
                self.table.replace(self.queue().withColumn(GONE, F.lit(False)))

    def put_note(self, note: Mapping) -> None:
        with self.lock:
            self.table.add(None, self.note() | dict(note))

    def add_finished(self, rows: DataFrame, many: bool = True) -> None:
        """Append history rows; many are brought together by month first, so that files are few."""
        month = F.date_format("finish_time", "yyyy-MM").alias(MONTH)
        named = rows.select(*HISTORY.names, month)
        (named.repartition(MONTH) if many else named).write.mode("append").partitionBy(MONTH).parquet(f"{self.folder}/finished")

    def advance(
        self, done: Sequence[Row], slots: Mapping[str, int], asof: datetime | str, gate: Column | None = None,
    ) -> list[Row]:
        """Record what is done and claim rows for free slots, in one change of the queue.

        ``done`` has a history row for each finished load; it and the claimed rows, at most
        the number of slots, are all that the driver holds.
        """
        spark = self.spark
        with self.lock:
            if done:
                self.add_finished(spark.createDataFrame([tuple(r) for r in done], HISTORY).coalesce(1), many=False)
            taken = claim_rows(self.queue(), slots, gate).collect() if any(k > 0 for k in slots.values()) else []
            now = datetime.fromisoformat(asof) if isinstance(asof, str) else asof
            moved = [r.asDict() | {"status": RUNNING_ROW, "trigger_time": now, GONE: False} for r in taken]
            left = [dict.fromkeys(QUEUE.names) | {"source_table": r["source_table"], GONE: True} for r in done]
            rows = [tuple(r[n] for n in (*QUEUE.names, GONE)) for r in moved + left]
            if rows:
                self.change(spark.createDataFrame(rows, self.table.schema).coalesce(1))
            return [Row(**{n: r[n] for n in QUEUE.names}) for r in moved]

    def reset(self) -> None:
        """Empty the state."""
        with self.lock:
            self.table.reset()
            empty = self.spark.createDataFrame([], HISTORY).withColumn(MONTH, F.lit(None).cast("string"))
            empty.write.mode("overwrite").partitionBy(MONTH).parquet(f"{self.folder}/finished")

    def recover(self) -> None:
        """Before a run: put running rows back in the queue, and find the latest event from
        the state as a whole, once."""
        with self.lock:
            back = requeue(self.queue())
            if not back.isEmpty():
                self.change(back)
            mark = last_load_time(self.queue(), self.history()).first()[0]
            self.put_note({MARK: None if mark is None else mark.isoformat(sep=" ")})
