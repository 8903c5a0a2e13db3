"""The refresh cycle against the rules applied one event at a time."""

from __future__ import annotations

from datetime import timedelta

import pytest
from helpers import DAY, by_key, frame, history_frame, queue_frame, queue_row
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from spark_refresh.operators import enrich, queue
from spark_refresh.plans.refresh import refresh_cycle
from spark_refresh.schemas import METADATA, TRACKER

ASOF = DAY + timedelta(minutes=2)


def metadata(spark, *names, **changed):
    base = {"strategy": "TPT", "disabled": False, "priority": 2, "min_staleness": 30, "max_staleness": 90} | changed
    return frame(spark, METADATA, [{"source_table": n, "target_table": f"t.{n}", **base} for n in names])


def events(spark, *rows):
    return frame(spark, TRACKER, [{"source_table": n, "event_time": DAY + timedelta(seconds=s)} for n, s in rows])


def level(stale: int) -> int:
    if stale < 30:
        return 0
    left = 90 - stale
    for bound, value in ((60, 1), (45, 2), (30, 3), (15, 4), (10, 5), (5, 6), (3, 7), (2, 8), (1, 9), (0, 10), (-5, 15), (-10, 20)):
        if left > bound:
            return value
    return 25


def step(state: dict, new: list[tuple[str, int]], known: set[str], asof: int) -> dict:
    """One cycle, row by row. Waiting rows come first, each with its latest known event."""
    rows = [(n, e if late is None else late, level(asof - e) * 2) for n, (e, late, s, _) in state.items() if s == "Q"]
    rows += [(n, e, level(asof - e) * 2) for n, e in sorted(new, key=lambda r: r[1]) if n in known]
    for name, event, priority in rows:
        if name not in state:
            state[name] = (event, None, "Q", priority)
        elif state[name][2] == "Q":
            state[name] = (state[name][0], event, "Q", priority)
    return state


EVENTS = st.lists(st.tuples(st.sampled_from("ABCX"), st.integers(0, 110)), max_size=10)


@settings(max_examples=7, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(first=EVENTS, second=EVENTS, running=st.sets(st.sampled_from("ABC")))
def test_cycles_equal_the_rules(spark, first, second, running):
    known, attrs = set("ABC"), metadata(spark, *"ABC")
    state = step({}, first, known, 120)
    q = refresh_cycle(events(spark, *first), attrs, queue_frame(spark), ASOF, "lake")
    from pyspark.sql import functions as F
    q = q.withColumn("status", F.when(F.col("source_table").isin("", *running), "R").otherwise(F.col("status")))
    state = {n: (e, l, "R" if n in running else s, p) for n, (e, l, s, p) in state.items()}
    later = [(n, 200 + s) for n, s in second]
    state = step(state, later, known, 400)
    q = refresh_cycle(events(spark, *later), attrs, q, DAY + timedelta(seconds=400), "lake")

    def moment(s):
        return None if s is None else DAY + timedelta(seconds=s)

    got = {r.source_table: (r.event_time, r.event_time_latest, r.status, r.priority) for r in q.collect()}
    assert got == {n: (moment(e), moment(l), s, p) for n, (e, l, s, p) in state.items()}


def test_row_of_a_new_event(spark):
    row = by_key(refresh_cycle(events(spark, ("A", 40)), metadata(spark, "A"), queue_frame(spark), ASOF, "lake"))["A"]
    assert (row.target_table, row.strategy, row.lock_rows, row.status, row.trigger_time) == ("lake.t.A", "TPT", True, "Q", None)
    assert (row.priority, row.event_time_latest) == (2 * level(80), None)


def test_queued_table_needs_metadata(spark):
    q = queue_frame(spark, queue_row("A"))
    with pytest.raises(Exception, match="no metadata for queued table A"):
        refresh_cycle(events(spark), metadata(spark, "B"), q, ASOF, "lake").collect()
    running = queue_frame(spark, queue_row("A", status="R"))
    assert refresh_cycle(events(spark), metadata(spark, "B"), running, ASOF, "lake").count() == 1
    with pytest.raises(Exception, match="no metadata for queued table A"):
        enrich.reprioritise(q, metadata(spark, "B"), ASOF).collect()


def test_cycle_without_events_keeps_the_watermark(spark):
    attrs, none = metadata(spark, "A", "B"), events(spark)
    q = refresh_cycle(events(spark, ("A", 0), ("A", 50), ("B", 10)), attrs, queue_frame(spark), ASOF, "lake")
    marks = []
    for _ in range(3):
        marks.append(queue.last_load_time(q, history_frame(spark)).first()[0])
        q = refresh_cycle(none, attrs, q, ASOF, "lake")
    assert marks == [DAY + timedelta(seconds=50)] * 3


def test_newer_event_sets_the_priority_until_the_next_cycle(spark):
    attrs = metadata(spark, "A")
    q = refresh_cycle(events(spark, ("A", 0)), attrs, queue_frame(spark), ASOF, "lake")
    assert by_key(q)["A"].priority == 50
    q = refresh_cycle(events(spark, ("A", 119)), attrs, q, ASOF, "lake")
    assert by_key(q)["A"].priority == 0
    q = refresh_cycle(events(spark), attrs, q, ASOF, "lake")
    assert by_key(q)["A"].priority == 50


def test_disabled_tables_are_refreshed_too(spark):
    attrs = metadata(spark, "A", disabled=True)
    assert refresh_cycle(events(spark, ("A", 0)), attrs, queue_frame(spark), ASOF, "lake").count() == 1
