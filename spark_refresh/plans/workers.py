"""Working off the queue: a copy begins whenever a slot is free.

Claims are driven by free slots, not by cycles: what is allowed to run less what runs. The
copies are independent Spark jobs, submitted from one driver thread per slot; cycles go on
meanwhile on the same state. The driver holds the rows in flight only.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Callable, Mapping
from concurrent.futures import FIRST_COMPLETED, Future, ThreadPoolExecutor, wait
from datetime import datetime
from threading import Event

from pyspark import InheritableThread
from pyspark.sql import Column, Row, SparkSession
from pyspark.sql import functions as F

from ..functions.times import ZONE, claims_open, local_now, wall_of_epoch
from ..operators.queue import in_queue
from ..schemas import DEFAULT_SLOTS, HISTORY
from .state import RefreshState
from .transfer import outcome

# Fixed value: seconds between two looks at an idle queue.
IDLE = 60.0

# Seconds to wait for further copies when one is done, so that one change records several.
GATHER = 0.5

Load = Callable[[Row], int]


def _in_pool(spark: SparkSession, strategy: str, task: Callable[[], dict]) -> dict:
    """Run a copy in the scheduler pool of its strategy (FAIR mode shares the executors)."""
    spark.sparkContext.setLocalProperty("spark.scheduler.pool", strategy)
    return task()


class Workers:
    """Copies the tables of a queue, as many of a strategy at a time as it has slots.

    ``load`` copies the table of a queue row and gives its number of rows; one that fails is
    recorded and the others go on. ``hold`` makes claims wait in the first minutes of an
    hour, ``avoid`` in a window of hours such as ``6-18``.
    """

    def __init__(
        self, state: RefreshState, load: Load, slots: Mapping[str, int] | None = None,
        asof: Callable[[], datetime | str] = local_now, hold: bool = False, avoid: str = "",
        zone: str = ZONE, idle: float = IDLE,
    ):
        self.state, self.load, self.asof, self.zone, self.idle = state, load, asof, zone, idle
        self.slots = {s: k for s, k in (DEFAULT_SLOTS if slots is None else slots).items() if k > 0}
        self.hold, self.avoid = hold, avoid
        self.pool = ThreadPoolExecutor(max(1, sum(self.slots.values())), thread_name_prefix="copy")
        self.running: dict[Future, Row] = {}
        self._stop, self._thread = Event(), None
        self.failure: BaseException | None = None

    def gate(self, now: datetime | str) -> Column | None:
        return claims_open(F.lit(str(now)).cast("timestamp_ntz"), self.hold, self.avoid) if self.hold or self.avoid else None

    def _record(self, row: Row, run: dict) -> Row:
        """The history row of a finished copy."""
        facts = {
            "status": run["status"], "finish_time": wall_of_epoch(run["end"], self.zone),
            "duration_min": round((run["end"] - run["start"]) / 60, 2), "num_records": run["num_records"], "error": run["error"],
        }
        known = row.asDict() | facts
        return Row(**{n: known[n] for n in HISTORY.names})

    def step(self, patience: float | None = None) -> bool:
        """Record copies that are done and begin others. False if nothing runs after it."""
        if self.running:
            ended, others = wait(self.running, timeout=patience, return_when=FIRST_COMPLETED)
            if ended and others:
                wait(others, timeout=GATHER)
        done = {f: row for f, row in self.running.items() if f.done()}
        busy = Counter(row["strategy"] for f, row in self.running.items() if f not in done)
        free = {s: k - busy[s] for s, k in self.slots.items()}
        now = self.asof()
        claimed = self.state.advance(
            [self._record(row, f.result()) for f, row in done.items()], {} if self._stop.is_set() else free, now, self.gate(now))
        for f in done:
            del self.running[f]
        spark = self.state.spark
        for row in claimed:
            run = lambda row=row: outcome(row["source_table"], row["strategy"], lambda: self.load(row))
            self.running[self.pool.submit(_in_pool, spark, row["strategy"], run)] = row
        return bool(self.running)

    def drain(self) -> int:
        """Work until nothing runs and nothing can be claimed; the number of rows that wait.

        Rows left have a strategy without slots, a priority of 0, or are held back.
        """
        while self.step():
            pass
        return in_queue(self.state.queue()).count()

    # -- beside the cycles

    def start(self) -> Workers:
        """Work in a thread until :meth:`stop`; an idle queue is looked at again and again."""

        def loop() -> None:
            try:
                while not self._stop.is_set():
                    if not self.step(self.idle):
                        self._stop.wait(self.idle)
            except BaseException as failure:  # noqa: BLE001 - handed to whoever stops the workers
                self.failure = failure

        self._thread = InheritableThread(target=loop, session=self.state.spark)
        self._thread.start()
        return self

    def stop(self) -> None:
        """Claim no more, let what runs end, and record it."""
        self._stop.set()
        if self._thread:
            self._thread.join()
        while self.running:
            self.step()
        self.pool.shutdown()
        if self.failure:
            raise self.failure
