from __future__ import annotations

import time
from collections import Counter
from datetime import timedelta
from threading import Lock

import pytest
from helpers import DAY, by_key, frame, queue_row, queue_frame, history_frame, history_row
from pyspark.sql import functions as F

from spark_refresh.operators import queue
from spark_refresh.plans.refresh import refresh_cycle
from spark_refresh.plans.state import MARK, PARTS, RefreshState
from spark_refresh.plans.workers import Workers
from spark_refresh.schemas import METADATA, TRACKER
from spark_refresh.sources.scratch import fresh_folder
from spark_refresh.streaming import refresh as stream

ASOF = DAY + timedelta(days=2)
NAMES = [f"s.t{i}" for i in range(6)]


@pytest.fixture
def metadata(spark):
    rows = [
        {"source_table": n, "target_table": n, "strategy": "TPT" if i % 2 else "WriteNOS", "disabled": False,
         "priority": 1 + i, "min_staleness": 0, "max_staleness": 86400}
        for i, n in enumerate(NAMES)
    ]
    return frame(spark, METADATA, rows)


def write_events(spark, folder, batch: int):
    """Twenty events per file, later files with later times; some tables are unknown."""
    rows = [
        {"source_table": f"s.t{(batch + 3 * i) % 7}", "event_time": DAY + timedelta(seconds=100 * batch + i)}
        for i in range(20)
    ]
    frame(spark, TRACKER, rows).coalesce(1).write.mode("append").parquet(folder)
    time.sleep(0.05)


def start(spark, folder, metadata, state, checkpoint, **more):
    events = stream.tracking_stream(
        spark, folder, TRACKER, F.col("source_table"), "event_time", max_files=1
    )
    run = stream.start_refresh(
        events, lambda: metadata, state, checkpoint, "lake", asof=lambda: ASOF, available_now=True, **more
    )
    run.awaitTermination()
    return run


def new_state(spark):
    state = RefreshState(spark, fresh_folder(spark, "state"))
    stream.recover(state)
    return state


def rows(df):
    return sorted(df.collect(), key=repr)


def test_stream_equals_cycles_in_the_same_order(spark, metadata):
    folder, want = fresh_folder(spark, "events"), queue_frame(spark)
    for batch in range(3):
        write_events(spark, folder, batch)
        low, high = DAY + timedelta(seconds=100 * batch - 1), DAY + timedelta(seconds=100 * batch + 50)
        events = spark.read.parquet(folder).filter(F.col("event_time").between(low, high))
        want = spark.createDataFrame(refresh_cycle(events, metadata, want, ASOF, "lake").collect(), want.schema)
    state = new_state(spark)
    start(spark, folder, metadata, state, fresh_folder(spark, "checkpoint"))
    assert rows(state.queue()) == rows(want)
    assert state.note() == {stream.BATCH: 2, MARK: str(DAY + timedelta(seconds=219))}


def test_restart_goes_on_where_it_stopped(spark, metadata):
    one, two = fresh_folder(spark, "events"), fresh_folder(spark, "events")
    split, checkpoint = new_state(spark), fresh_folder(spark, "checkpoint")
    for batch in range(4):
        write_events(spark, one, batch)
        if batch in (1, 3):
            start(spark, one, metadata, split, checkpoint)
    for batch in range(4):
        write_events(spark, two, batch)
    whole = new_state(spark)
    start(spark, two, metadata, whole, fresh_folder(spark, "checkpoint"))
    assert rows(split.queue()) == rows(whole.queue())


def test_batch_delivered_again_changes_nothing(spark, metadata):
    folder, state = fresh_folder(spark, "events"), new_state(spark)
    write_events(spark, folder, 0)
    start(spark, folder, metadata, state, fresh_folder(spark, "checkpoint"))
    before, version = rows(state.queue()), state.table.version
    start(spark, folder, metadata, state, fresh_folder(spark, "lost-checkpoint"))
    assert rows(state.queue()) == before and state.table.version == version


def test_late_events_are_not_read(spark, metadata):
    state = new_state(spark)
    now = frame(spark, TRACKER, [{"source_table": NAMES[0], "event_time": DAY}])
    stream.apply_events(now, metadata, state, ASOF, "lake")
    late = frame(spark, TRACKER, [{"source_table": NAMES[1], "event_time": DAY}, {"source_table": NAMES[2], "event_time": DAY + timedelta(seconds=1)}])
    stream.apply_events(late, metadata, state, ASOF, "lake")
    assert sorted(by_key(state.queue())) == [NAMES[0], NAMES[2]]


def test_configured_start(spark, metadata):
    state = new_state(spark)
    both = frame(spark, TRACKER, [{"source_table": NAMES[0], "event_time": DAY}, {"source_table": NAMES[1], "event_time": ASOF}])
    stream.apply_events(both, metadata, state, ASOF, "lake", start="2025-01-01 00:00:00")
    assert list(by_key(state.queue())) == [NAMES[1]]


def test_event_delivered_again_makes_no_second_row(spark, metadata):
    folder, state = fresh_folder(spark, "events"), new_state(spark)
    for copies in (5, 2):
        again = frame(spark, TRACKER, [{"source_table": NAMES[0], "event_time": DAY}] * copies)
        again.coalesce(1).write.mode("append").parquet(folder)
        time.sleep(0.05)
    start(spark, folder, metadata, state, fresh_folder(spark, "checkpoint"))
    assert state.note() == {stream.BATCH: 1, MARK: str(DAY)}
    assert [(r.source_table, r.event_time, r.event_time_latest) for r in state.queue().collect()] == [(NAMES[0], DAY, DAY)]


def test_waiting_tables_grow_older_without_events(spark, metadata):
    folder, state, clock = fresh_folder(spark, "events"), new_state(spark), [DAY]
    frame(spark, TRACKER, [{"source_table": NAMES[0], "event_time": DAY}]).coalesce(1).write.parquet(folder)

    def later():
        clock[0] += timedelta(hours=12)
        return clock[0]

    events = stream.tracking_stream(spark, folder, TRACKER, F.col("source_table"), "event_time", heartbeat=True)
    run = stream.start_refresh(
        events, lambda: metadata, state, fresh_folder(spark, "checkpoint"), "lake", asof=later, cadence="1 second"
    )
    try:
        limit = time.time() + 60
        while time.time() < limit and (state.note().get(stream.BATCH, -1) < 3):
            time.sleep(0.5)
    finally:
        run.stop()
    row = by_key(state.queue())[NAMES[0]]
    assert (row.priority, row.event_time, row.event_time_latest) == (25, DAY, DAY)


def test_what_is_left_out_is_written_down(spark, metadata):
    folder, state, audit = fresh_folder(spark, "events"), new_state(spark), fresh_folder(spark, "audit")
    state.put_queue(queue_frame(spark, queue_row(NAMES[0], status="R")))
    rows = [(NAMES[0], 5), (NAMES[0], 6), (NAMES[1], -5), (NAMES[2], 7), ("s.none", 8), ("s.none", 0)]
    frame(spark, TRACKER, [{"source_table": n, "event_time": DAY + timedelta(seconds=s)} for n, s in rows]).coalesce(1).write.parquet(folder)
    start(spark, folder, metadata, state, fresh_folder(spark, "checkpoint"), audit_folder=audit)

    def read(name):
        return sorted(tuple(r)[:2] for r in spark.read.parquet(f"{audit}/batch=0/{name}").collect())

    assert read("late") == [("s.none", DAY), (NAMES[1], DAY - timedelta(seconds=5))]
    assert read("unmatched") == [("s.none", DAY + timedelta(seconds=8))]
    assert read("ignored") == [(NAMES[0], 2)]
    assert sorted(by_key(state.queue())) == [NAMES[0], NAMES[2]]


def test_polling_a_table_reads_each_event_once(spark, metadata):
    """Two polls of a growing table end in the state of two cycles; the second reads only
    what is new, and nothing after its own time."""
    state, at = new_state(spark), lambda s: DAY + timedelta(seconds=s)
    first = [{"source_table": NAMES[0], "event_time": at(10)}, {"source_table": NAMES[1], "event_time": at(500)}]
    more = first + [{"source_table": NAMES[0], "event_time": at(90)}, {"source_table": NAMES[2], "event_time": at(10)}]
    for rows, asof in ((first, at(100)), (more, at(200)), (more, at(200))):
        stream.poll(frame(spark, TRACKER, rows), F.col("source_table"), "event_time", metadata, state, asof, "lake", DAY)
    got = by_key(state.queue())
    assert list(got) == [NAMES[0]]
    assert (got[NAMES[0]].event_time, got[NAMES[0]].event_time_latest) == (at(10), at(90))
    assert stream.known_until(state) == at(90)


def test_polling_by_the_clock(spark, metadata):
    state, table = new_state(spark), frame(spark, TRACKER, [{"source_table": NAMES[0], "event_time": DAY + timedelta(seconds=1)}])
    run = stream.start_polling(
        spark, lambda: table, F.col("source_table"), "event_time", lambda: metadata, state, fresh_folder(spark, "checkpoint"),
        "lake", DAY, asof=lambda: ASOF, cadence="1 second",
    )
    try:
        limit = time.time() + 60
        while time.time() < limit and state.note().get(stream.BATCH, -1) < 2:
            time.sleep(0.5)
    finally:
        run.stop()
    assert list(by_key(state.queue())) == [NAMES[0]]


def test_workers_empty_the_queue(spark, metadata):
    """Slots are filled again as they come free, whatever the number of rows; a strategy
    without slots waits, and the workers say how many rows do."""
    folder, state, lock, active, most, order = fresh_folder(spark, "events"), new_state(spark), Lock(), Counter(), Counter(), []
    for batch in range(2):
        write_events(spark, folder, batch)
    start(spark, folder, metadata, state, fresh_folder(spark, "checkpoint"))

    def load(row):
        with lock:
            active[row.strategy] += 1
            most[row.strategy] = max(most[row.strategy], active[row.strategy])
            order.append(row.source_table)
        time.sleep(0.2)
        with lock:
            active[row.strategy] -= 1
        if row.source_table == NAMES[3]:
            raise RuntimeError("gone")
        return 7

    assert state.running().count() == 0
    first = Workers(state, load, {"TPT": 1, "WriteNOS": 0}, asof=lambda: ASOF)
    assert first.drain() == 3
    first.stop()
    second = Workers(state, load, {"TPT": 1, "WriteNOS": 2}, asof=lambda: ASOF)
    assert second.drain() == 0
    second.stop()
    assert most == {"TPT": 1, "WriteNOS": 2} and sorted(order) == NAMES
    assert order[:3] == [NAMES[5], NAMES[3], NAMES[1]]  # by priority
    got = {r.source_table: (r.status, r.num_records, r.error, r.trigger_time) for r in state.history().collect()}
    assert got.pop(NAMES[3]) == ("FAILED", 0, "gone", ASOF)
    assert set(got.values()) == {("SUCCESS", 7, "", ASOF)} and len(got) == 5
    assert state.queue().count() == 0


def test_workers_beside_the_cycles(spark, metadata):
    folder, state, loaded = fresh_folder(spark, "events"), new_state(spark), []
    workers = Workers(state, lambda row: loaded.append(row.source_table) or 1, asof=lambda: ASOF, idle=0.2).start()
    try:
        for batch in range(2):
            write_events(spark, folder, batch)
        start(spark, folder, metadata, state, fresh_folder(spark, "checkpoint"))
        limit = time.time() + 60
        while time.time() < limit and (state.queue().count() or workers.running):
            time.sleep(0.2)
    finally:
        workers.stop()
    assert state.queue().count() == 0 and set(loaded) == set(NAMES)
    assert state.history().where("status = 'SUCCESS'").count() == state.history().count() == len(set((r.source_table, r.event_time) for r in state.history().collect()))


def test_held_claims_begin_later(spark, metadata):
    state, at = new_state(spark), ["2025-01-03 10:01:00"]
    stream.apply_events(frame(spark, TRACKER, [{"source_table": NAMES[0], "event_time": DAY}]), metadata, state, ASOF, "lake")
    workers = Workers(state, lambda row: 1, asof=lambda: at[0], hold=True)
    assert workers.drain() == 1
    at[0] = "2025-01-03 10:03:00"
    assert workers.drain() == 0
    workers.stop()


def test_claims_and_finishes_write_only_what_changes(spark, metadata):
    state = new_state(spark)
    state.put_queue(queue_frame(spark, *(queue_row(f"s.q{i}", priority=i + 1) for i in range(200))))
    (row,) = state.advance([], {"TPT": 1}, ASOF)
    assert row.source_table == "s.q199" and state.table.marks()[-1].rows == 1
    assert [r.source_table for r in state.running().collect()] == ["s.q199"]
    done = history_frame(spark, history_row("s.q199", "SUCCESS", finish_time=ASOF)).first()
    claimed = state.advance([done], {"TPT": 2}, ASOF)
    assert [r.source_table for r in claimed] == ["s.q198", "s.q197"] and state.table.marks()[-1].rows == 3
    assert state.queue().count() == 199 and state.history().count() == 3
    for _ in range(PARTS):  # many changes are merged into a whole queue
        state.change(state.queue().where("source_table = 's.q1'").withColumn("priority", F.col("priority") + 1))
    assert len(state.table.marks()) < PARTS and by_key(state.queue())["s.q1"].priority == 2 + PARTS
    assert state.queue().count() == 199


def test_driver_lost_while_loading(spark, metadata):
    folder, state = fresh_folder(spark, "events"), new_state(spark)
    write_events(spark, folder, 0)
    start(spark, folder, metadata, state, fresh_folder(spark, "checkpoint"))
    state.advance([], {"TPT": 8}, ASOF)
    after = RefreshState(spark, state.folder)  # another driver
    assert after.running().count() == 3 and after.history().count() == 3
    stream.recover(after)
    assert after.running().count() == 0 and after.history().count() == 0 and after.queue().count() == 6
    assert after.latest_event() == state.latest_event()


def test_outcome_is_kept_if_the_queue_was_not_written(spark):
    """Lost between both writes: the load is done again and counts once."""
    state = new_state(spark)
    state.put_queue(queue_frame(spark, queue_row("a")))
    state.advance([], {"TPT": 1}, ASOF)
    state.add_finished(history_frame(spark, history_row("a", "SUCCESS", finish_time=ASOF, trigger_time=ASOF)))
    after = RefreshState(spark, state.folder)
    stream.recover(after)
    workers = Workers(after, lambda row: 2, asof=lambda: ASOF)
    workers.drain()
    workers.stop()
    assert [(r.status, r.num_records) for r in after.history().collect()] == [("SUCCESS", 2)]


def test_a_batch_of_polls_is_read_again_with_its_bounds(spark, metadata):
    state, at = new_state(spark), lambda s: DAY + timedelta(seconds=s)
    table = frame(spark, TRACKER, [{"source_table": NAMES[i], "event_time": at(10 * i)} for i in range(4)])
    again = RefreshState(spark, fresh_folder(spark, "state"))
    for one, times in ((state, 1), (again, 2)):
        stream.recover(one)
        one.put_note({stream.PLANNED: {"batch": 3, "low": str(DAY), "high": str(at(15))}} if times == 2 else {})
        stream.poll(table, F.col("source_table"), "event_time", metadata, one, at(15) if times == 1 else at(35), "lake", DAY, batch_id=3)
    assert rows(state.queue()) == rows(again.queue()) and list(by_key(state.queue())) == [NAMES[1]]


def test_polls_read_only_the_folders_of_their_days(spark, metadata, tmp_path):
    from spark_refresh.sources.tracking import tracking_scan

    events = frame(spark, TRACKER, [{"source_table": NAMES[0], "event_time": DAY + timedelta(days=d)} for d in range(9)])
    events.withColumn("day", F.to_date("event_time")).write.partitionBy("day").parquet(str(tmp_path / "t"))
    stored, state = spark.read.parquet(str(tmp_path / "t")), new_state(spark)
    stream.poll(stored, F.col("source_table"), "event_time", metadata, state, DAY + timedelta(days=3), "lake", DAY + timedelta(days=1), 0, "day")
    assert by_key(state.queue())[NAMES[0]].event_time_latest == DAY + timedelta(days=3)
    found = tracking_scan(stored, F.col("source_table"), "event_time", state.latest_event(), "2025-01-05 12:00:00", date_partition="day")
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(day" in plan and "2025-01-04" in plan and found.count() == 1


def test_recover_empties_on_request(spark):
    state = RefreshState(spark, fresh_folder(spark, "state"))
    state.put_queue(queue_frame(spark, queue_row("a")))
    state.add_finished(history_frame(spark, history_row("b", "SUCCESS", finish_time=ASOF)))
    stream.recover(state)
    assert state.queue().count() == 1
    stream.recover(state, reset=True)
    assert state.queue().count() == state.history().count() == 0
    assert queue.last_load_time(state.queue(), state.history()).first()[0] is None and state.latest_event() is None
    never_made = RefreshState(spark, fresh_folder(spark, "state"))
    assert queue.queue_length(never_made.queue()).first()[0] == 0


def test_deliveries_are_written_by_many_tasks(spark, small, tmp_path, monkeypatch):
    from checks import states

    spark.read.parquet(f"{small}/events.parquet").repartition(6).write.parquet(str(tmp_path / "events.parquet"))
    folder = str(tmp_path / "deliveries")
    monkeypatch.setattr(states, "fresh_folder", lambda *_: folder)
    spark.conf.set("spark.sql.files.maxPartitionBytes", "4096")
    try:
        got = sorted(map(tuple, states.stream_distinct(spark, str(tmp_path)).collect()))
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
    monkeypatch.undo()
    assert got == sorted(map(tuple, states.stream_distinct(spark, small).collect()))
    assert len(list((tmp_path / "deliveries" / "events").glob("*.parquet"))) > 3 * states.DELIVERIES
