from __future__ import annotations

from datetime import timedelta

import pytest
from helpers import DAY, by_key, frame, history_frame, history_row, queue_frame, queue_row, t
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from spark_refresh.operators import batch, keys, queue
from spark_refresh.schemas import BATCH_QUEUE, QUEUE

ORDER = ("event_time", "lock_rows", "target_table")
ASOF = t("2025-02-01")


# -- transitions


def test_claim_takes_the_most_urgent_of_a_strategy_with_slots(spark):
    q = queue_frame(
        spark,
        queue_row("fin.ledger", strategy="TPT", priority=900),
        queue_row("fin.rates", strategy="WriteNOS", priority=30, time=t("2024-11-05 10:00:00")),
        queue_row("fin.books", strategy="WriteNOS", priority=31, time=t("2024-11-06 11:30:00"), lock_rows=False),
    )
    claim = queue.claim(q, history_frame(spark), ASOF, {"WriteNOS": 1})
    (row,) = claim.claimed.collect()
    assert (row.source_table, row.lock_rows, row.event_time) == ("fin.books", False, t("2024-11-06 11:30:00"))
    assert claim.changed.count() == 1
    after = by_key(queue.with_changes(q, claim.changed))
    assert {n: r.status for n, r in after.items()} == {"fin.ledger": "Q", "fin.rates": "Q", "fin.books": "R"}
    assert after["fin.books"].trigger_time == ASOF
    (started,) = claim.started.collect()
    assert (started.source_table, started.status, started.trigger_time) == ("fin.books", "RUNNING", ASOF)


def test_upsert_of_a_known_and_a_new_table(spark):
    q = queue_frame(spark, queue_row("hr.shift", priority=44))
    later = t("2025-01-09 07:00:00")
    new = queue_frame(spark, queue_row("hr.shift", priority=17), queue_row("hr.leave", priority=3, time=later))
    after = by_key(queue.upsert(q, new, ORDER))
    assert (after["hr.shift"].priority, after["hr.shift"].event_time_latest) == (17, DAY)
    assert (after["hr.leave"].priority, after["hr.leave"].event_time, after["hr.leave"].event_time_latest) == (3, later, None)


@pytest.mark.parametrize("column", ["priority", "strategy", "event_time", None])
def test_upsert_stops_at_rows_that_are_not_queued(spark, column):
    after = queue.upsert(queue_frame(spark), queue_frame(spark, queue_row("hr.shift", status="R")), ORDER)
    with pytest.raises(Exception, match="must be queued"):
        after.select(column).collect() if column else after.count()


def test_only_queued_rows_wait(spark):
    q = queue_frame(spark, *(queue_row(f"w{i}", status="QRFQQ"[i]) for i in range(5)))
    assert sorted(by_key(queue.in_queue(q))) == ["w0", "w3", "w4"]
    assert queue.queue_length(q).first()[0] == 3


def finished(spark, *rows):
    schema = "source_table string, event_time timestamp_ntz, status string, finish_time timestamp_ntz, " \
             "duration_min double, num_records long, error string"
    return spark.createDataFrame(list(rows), schema)


def test_finish_closes_running_rows_only(spark):
    older, end = t("2024-10-10 04:00:00"), t("2025-01-01 01:15:00")
    q = queue_frame(spark, queue_row("hr.shift", status="R"), queue_row("hr.leave"))
    running, done = history_frame(spark, history_row("hr.shift")), history_frame(spark, history_row("hr.shift", status="FAILED", time=older))
    outcomes = [("hr.shift", DAY, "SUCCESS", end, 75.0, 41_207, ""), ("hr.leave", DAY, "SUCCESS", end, 9.0, 8, "")]
    after = queue.finish(q, running, finished(spark, *outcomes, *outcomes))
    assert list(by_key(queue.with_changes(q, gone=after.gone))) == ["hr.leave"]
    history = queue.current_history(running.limit(0), done.unionByName(after.finished))
    rows = {r.event_time: r for r in history.collect()}
    assert set(rows) == {DAY, older} and rows[older].status == "FAILED"
    assert rows[DAY].status == "SUCCESS" and rows[DAY].finish_time == end
    assert (rows[DAY].duration_min, rows[DAY].num_records) == (75.0, 41_207)


def test_history_shows_how_an_event_went_last(spark):
    late = t("2025-01-03")
    done = history_frame(
        spark, history_row("a", "FAILED", finish_time=ASOF, trigger_time=DAY), history_row("a", "SUCCESS", finish_time=ASOF, trigger_time=late),
        history_row("b", "SUCCESS", finish_time=ASOF), history_row("c", "FAILED"),
    )
    rows = queue.current_history(history_frame(spark, history_row("b")), done).collect()
    assert sorted((r.source_table, r.status) for r in rows) == [("a", "SUCCESS"), ("b", "RUNNING"), ("c", "FAILED")]


def test_watermark_follows_the_latest_event(spark):
    one = queue_frame(spark, queue_row("hr.shift", time=t("2024-12-24 06:00:00")), queue_row("fin.books", time=t("2024-12-26 19:20:00")))
    two = queue_frame(spark, queue_row("hr.shift", time=t("2024-12-31 22:10:05")))
    q = queue.upsert(queue.upsert(queue_frame(spark), one, ORDER), two, ORDER)
    assert queue.last_load_time(q, history_frame(spark)).first()[0] == t("2024-12-31 22:10:05")


def test_watermark_of_empty_state(spark):
    empty = queue_frame(spark), history_frame(spark)
    assert queue.last_load_time(*empty).first()[0] is None
    assert queue.watermark(*empty, "2025-01-01 00:00:00").first()[0] == DAY


# -- further rules


def test_running_table_ignores_events(spark):
    q = queue_frame(spark, queue_row("A", status="R", priority=3))
    new = queue_frame(spark, queue_row("A", priority=9, time=ASOF), queue_row("A", priority=8, time=DAY))
    after = by_key(queue.upsert(q, new, ORDER))["A"]
    assert (after.priority, after.event_time_latest, after.status) == (3, None, "R")
    assert queue.ignored_events(q, new).collect() == [("A", 2, DAY, ASOF)]


def test_several_rows_of_a_new_table(spark):
    new = queue_frame(
        spark, queue_row("A", priority=7, time=ASOF, strategy="WriteNOS"), queue_row("A", priority=5, time=DAY),
    )
    row = by_key(queue.upsert(queue_frame(spark), new, ORDER))["A"]
    assert (row.event_time, row.strategy, row.priority, row.event_time_latest) == (DAY, "TPT", 7, ASOF)


def test_incoming_rows_must_be_queued(spark):
    with pytest.raises(Exception, match="must be queued"):
        queue.upsert(queue_frame(spark), queue_frame(spark, queue_row("A", status="R")), ORDER).collect()


def test_claim_of_processed_events(spark):
    names = ("new", "running", "good", "bad")
    q = queue_frame(spark, *(queue_row(n) for n in names))
    old = t("2024-01-01")
    h = history_frame(
        spark, history_row("running", trigger_time=old), history_row("good", "SUCCESS", finish_time=old, error=""),
        history_row("bad", "FAILED", num_records=5), history_row("bad", "FAILED", time=old), history_row("other", "SUCCESS"),
    )
    running, done = h.where("status = 'RUNNING'"), h.where("status <> 'RUNNING'")
    started = queue.claim(q, running, ASOF, {"TPT": 10}).started
    after = queue.current_history(running.unionByName(started), done).collect()
    assert len(after) == 6
    rows = {(r.source_table, r.event_time): r for r in after}
    assert rows["running", DAY].trigger_time == old
    for name in ("new", "good", "bad"):
        row = rows[name, DAY]
        assert (row.status, row.trigger_time, row.finish_time, row.num_records, row.error) == ("RUNNING", ASOF, None, None, None)
    assert rows["bad", old].status == "FAILED" and rows["other", DAY].status == "SUCCESS"


def test_priority_zero_is_not_claimed(spark):
    q = queue_frame(spark, queue_row("A", priority=0), queue_row("B", priority=1))
    assert list(by_key(queue.claim_rows(q))) == ["B"]


def test_ties_go_to_the_older_event(spark):
    q = queue_frame(spark, queue_row("A", time=ASOF), queue_row("C"), queue_row("B"))
    assert [r.source_table for r in queue.claim_rows(q, {"TPT": 1}).collect()] == ["B"]


def test_strategy_switched_off(spark):
    q = queue_frame(spark, queue_row("A"), queue_row("B", strategy="WriteNOS"))
    assert list(by_key(queue.claim_rows(q, {"TPT": 0, "WriteNOS": 2}))) == ["B"]
    assert queue.claim_rows(q, {"TPT": 0}).count() == 0


def test_requeue(spark):
    q = queue_frame(spark, queue_row("A", status="R", trigger_time=ASOF), queue_row("B"))
    back = queue.requeue(q)
    assert list(by_key(back)) == ["A"]
    rows = by_key(queue.with_changes(q, back))
    assert {n: r.status for n, r in rows.items()} == {"A": "Q", "B": "Q"} and rows["A"].trigger_time == ASOF


def test_latest_event_of_a_state_without_the_row_that_absorbed_it(spark):
    """Found from queue and history alone, the mark falls when a row with absorbed events ends."""
    q, running = queue_frame(spark, queue_row("A", status="R", event_time_latest=ASOF)), history_frame(spark, history_row("A"))
    assert queue.last_load_time(q, running).first()[0] == ASOF
    after = queue.finish(q, running, finished(spark, ("A", DAY, "SUCCESS", ASOF, 1.0, 1, "")))
    assert queue.last_load_time(queue.with_changes(q, gone=after.gone), after.finished).first()[0] == DAY


def test_claims_wait_where_a_gate_says_so(spark):
    from spark_refresh.functions.times import claims_open

    q = queue_frame(spark, queue_row("A"), queue_row("B"))
    for at, hold, avoid, n in (
        ("2025-01-01 10:02:59", True, "", 0), ("2025-01-01 10:03:00", True, "", 2), ("2025-01-01 10:00:00", False, "", 2),
        ("2025-01-01 10:30:00", True, "9-11", 0), ("2025-01-01 11:30:00", True, "9-11", 2),
    ):
        assert queue.claim_rows(q, gate=claims_open(F.lit(at).cast("timestamp_ntz"), hold, avoid)).count() == n


def test_duplicate_keys(spark):
    q = queue_frame(spark, queue_row("A"), queue_row("A", time=ASOF), queue_row("B"))
    assert keys.duplicate_keys(q, "source_table").collect() == [("A", 2)]
    assert keys.duplicate_keys(q, "source_table", "event_time").collect() == []
    with pytest.raises(ValueError, match="duplicate"):
        keys.require_unique(q, "source_table")


# -- batch queue


def manifest(spark, *names, strategy="TPT"):
    rows = [(n, f"lake.{n}", strategy, True, i) for i, n in enumerate(names)]
    return spark.createDataFrame(rows, "source string, target string, strategy string, lock_rows boolean, line_no long")


def test_first_line_first(spark):
    q = batch.enqueue(manifest(spark, "s.a", "s.b", "s.c"))
    assert {r.source_table: r.priority for r in q.collect()} == {"s.a": 2, "s.b": 1, "s.c": 0}
    claimed = batch.claim_rows(q, {"TPT": 2})
    assert sorted(by_key(claimed)) == ["s.a", "s.b"]
    running = batch.mark_running(q, claimed)
    assert batch.progress(running, manifest(spark, "s.a", "s.b", "s.c")).first() == (2, 1, 3)
    left = batch.dequeue(running, frame(spark, BATCH_QUEUE, [{"source_table": "s.a"}, {"source_table": "s.c"}]))
    assert {r.source_table: r.status for r in left.collect()} == {"s.b": "R", "s.c": "Q"}


def test_last_line_is_claimed_too(spark):
    q = batch.enqueue(manifest(spark, "s.a"))
    assert q.first().priority == 0 and batch.claim_rows(q).count() == 1


def test_duplicate_source_stops_the_batch(spark):
    with pytest.raises(ValueError, match="s.a"):
        batch.enqueue(manifest(spark, "s.a", "s.b", "s.a"))


# -- properties

ROWS = st.lists(
    st.tuples(st.sampled_from("ABCD"), st.integers(0, 5), st.integers(0, 30)), min_size=1, max_size=12,
    unique_by=lambda r: r[2],
)


def one_by_one(state: dict, rows: list[tuple]) -> dict:
    """The rule, applied row by row."""
    for name, priority, day in sorted(rows, key=lambda r: r[2]):
        time = DAY + timedelta(days=day)
        if name not in state:
            state[name] = [time, priority, None, "Q"]
        elif state[name][3] == "Q":
            state[name][1:3] = [priority, time]
    return state


def as_frame(spark, rows):
    return queue_frame(spark, *(queue_row(n, priority=p, time=DAY + timedelta(days=d)) for n, p, d in rows))


@settings(max_examples=7, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(old=ROWS, new=ROWS, running=st.sets(st.sampled_from("ABCD")))
def test_upsert_equals_one_row_after_the_other(spark, old, new, running):
    state = one_by_one({}, old)
    q = queue.upsert(queue_frame(spark), as_frame(spark, old), ORDER).withColumn(
        "status", F.when(F.col("source_table").isin(*running, ""), "R").otherwise(F.col("status"))
    )
    for name in running & set(state):
        state[name][3] = "R"
    want = one_by_one(state, new)
    once = queue.upsert(q, as_frame(spark, new), ORDER)
    got = {r.source_table: [r.event_time, r.priority, r.event_time_latest, r.status] for r in once.collect()}
    assert got == want
    twice = queue.upsert(once, as_frame(spark, new), ORDER)
    thrice = queue.upsert(twice, as_frame(spark, new), ORDER)
    assert sorted(twice.collect()) == sorted(thrice.collect())


@settings(max_examples=6, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(rows=ROWS, slots=st.integers(0, 3))
def test_claim_takes_the_best(spark, rows, slots):
    best = {name: (-p, d, name) for name, p, d in rows if p > 0}
    q = as_frame(spark, [(n, -p, d) for p, d, n in best.values()]) if best else queue_frame(spark)
    got = {r.source_table for r in queue.claim_rows(q, {"TPT": slots}).collect()}
    assert got == {n for *_, n in sorted(best.values())[:slots]}
