"""The plans Spark makes: what is pushed, shuffled, combined and broadcast."""

from __future__ import annotations

import re

import pytest
from checks import fixtures as fx
from conftest import SMALL
from helpers import history_frame, queue_frame, queue_row
from pyspark.sql import functions as F

from spark_refresh.operators import enrich, queue
from spark_refresh.plans.refresh import refresh_cycle
from spark_refresh.sources.scratch import written


def plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def test_scan_gets_bounds_and_columns(spark):
    df = fx.recent(spark, SMALL)
    text = df._jdf.queryExecution().explainString(spark._jvm.org.apache.spark.sql.execution.ExplainMode.fromString("formatted"))
    assert re.search(r"PushedFilters: \[.*GreaterThanOrEqual\(ts,2024-01-20T00:00:01\), LessThan\(ts,2024-01-25T00:00:01\)", text)
    assert "ReadSchema: struct<event_id:bigint,ts:timestamp_ntz,user_id:bigint,event_type:string>" in text


def test_partition_folders_are_pruned(spark, tmp_path):
    from spark_refresh.sources.tracking import tracking_scan

    events = fx.table(spark, SMALL, "events").withColumn("day", F.col("ts").cast("date"))
    events.write.partitionBy("day").parquet(str(tmp_path / "events"))
    stored = spark.read.parquet(str(tmp_path / "events"))
    df = tracking_scan(stored, fx.source_table(), "ts", fx.WATERMARK, fx.ASOF, "event_id", date_partition="day")
    assert re.search(r"PartitionFilters: \[.*day.*2024-01-20.*2024-01-25", plan(df))
    assert sorted(df.collect()) == sorted(fx.recent(spark, SMALL).collect())


def test_metadata_is_broadcast_only_below_the_threshold(spark):
    events, attrs = fx.recent(spark, SMALL), fx.metadata(spark, SMALL)
    assert "BroadcastHashJoin" in plan(enrich.enqueue_rows(events, attrs, "lake"))
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "100b")
    try:
        large = plan(enrich.enqueue_rows(events, attrs, "lake"))
        assert "BroadcastHashJoin" not in large and "SortMergeJoin" in large
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


@pytest.mark.parametrize("join", ["enqueue", "unmatched", "reprioritise"])
def test_table_with_most_events_is_split(spark, join):
    """Without a broadcast, a table that holds most rows is spread over several tasks."""
    hot = F.when(F.col("id") % 10 < 7, F.lit("s.hot")).otherwise(F.concat(F.lit("s.t"), (F.col("id") % 1000).cast("string")))
    base = spark.range(200_000).select(hot.alias("source_table"), F.lit("2025-01-01").cast("timestamp_ntz").alias("event_time"), F.sha2(F.col("id").cast("string"), 512).alias("payload"))
    events = written(base, "events")
    names = spark.range(1000).select(F.concat(F.lit("s.t"), F.col("id").cast("string")).alias("source_table")).union(
        spark.createDataFrame([("s.hot",)] if join != "unmatched" else [("s.other",)], "source_table string"))
    attrs = written(names.select(
        "source_table", F.col("source_table").alias("target_table"), F.lit("TPT").alias("strategy"), F.lit(False).alias("disabled"),
        F.lit(1).alias("priority"), F.lit(0).alias("min_staleness"), F.lit(1).alias("max_staleness"),
    ), "metadata")
    changed = {
        "spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "64KB",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "64KB",
    }
    for key, value in changed.items():
        spark.conf.set(key, value)
    try:
        if join == "enqueue":
            df, rows = enrich.enqueue_rows(events, attrs, "lake", "payload"), 200_000
        elif join == "unmatched":
            df, rows = enrich.unmatched(events, attrs), 140_000
        else:
            df, rows = enrich.reprioritise(events.withColumn("priority", F.lit(0)), attrs, "2025-01-02"), 200_000
        assert len(df.collect()) == rows
        assert "skew=true" in plan(df)
    finally:
        for key in changed:
            spark.conf.unset(key)


def test_only_what_cannot_be_split_is_spread(spark, tmp_path):
    from spark_refresh.plans.transfer import spread

    cores = spark.sparkContext.defaultParallelism
    one_file = spark.read.parquet(f"{SMALL}/lineitem.parquet")
    spark.range(1000, numPartitions=2 * cores).write.parquet(str(tmp_path / "many"))
    spark.range(1000, numPartitions=2).write.parquet(str(tmp_path / "two"))
    spark.range(1000).select(F.col("id").cast("string")).coalesce(1).write.option("compression", "gzip").text(str(tmp_path / "packed"))
    spark.range(1000, numPartitions=cores).select(F.col("id").cast("string")).write.option("compression", "gzip").text(str(tmp_path / "several"))
    for df, unsplit, shuffled in (
        (spark.range(1000, numPartitions=1), True, True), (spark.range(1000, numPartitions=cores), None, False),
        (one_file, None, False), (spark.read.text(str(tmp_path / "several")), None, False), (spark.read.parquet(str(tmp_path / "many")), None, False), (spark.read.parquet(str(tmp_path / "two")), None, False),
        (spark.read.text(str(tmp_path / "packed")), None, True), (spark.read.text(str(tmp_path / "packed")), False, False),
    ):
        assert ("RoundRobin" in plan(spread(df, unsplit))) is shuffled
        assert spread(df, unsplit).count() == df.count()


def test_events_are_combined_before_the_shuffle(spark):
    empty = queue_frame(spark)
    text = plan(refresh_cycle(fx.recent(spark, SMALL), fx.metadata(spark, SMALL), empty, fx.ASOF, "lake"))
    assert "partial_min(event_time" in text and "SortAggregate" not in text
    shuffled = text[: text.index("partial_min")]
    assert shuffled.rindex("HashAggregate") > shuffled.rindex("Exchange hashpartitioning(source_table")


def test_one_task_keeps_only_the_slots_of_a_strategy(spark):
    q = written(fx.queue(spark, SMALL), "queue")
    text = plan(queue.claim_rows(q))
    partial = re.search(r"WindowGroupLimit \[strategy#\d+\], .*, 8, Partial", text)
    assert partial and text.index("Final") < text.index("Exchange") < partial.start()


def test_claim_gives_what_changes_without_moving_the_queue(spark):
    q, running = written(fx.queue(spark, SMALL), "queue"), written(fx.history(spark, SMALL).where("status = 'RUNNING'"), "running")
    claim = queue.claim(q, running, fx.ASOF)
    assert claim.changed.count() <= 10 and claim.started.count() <= 10
    assert "Exchange hashpartitioning" not in plan(claim.changed) + plan(claim.started)


def test_many_slots_are_filled_by_ordered_limits(spark):
    """Above the number Spark limits ranks for, tasks still keep no more rows than slots."""
    q = written(fx.queue(spark, SMALL), "queue")
    claimed = queue.claim_rows(q, {"TPT": 5000, "WriteNOS": 3})
    assert "TakeOrderedAndProject(limit=5000" in plan(claimed) and "TakeOrderedAndProject(limit=3" in plan(claimed)
    few = queue.claim_rows(q, {"TPT": 900, "WriteNOS": 3})
    assert sorted(few.collect()) == sorted(r for r in claimed.collect() if r in set(few.collect())) and claimed.count() >= few.count()
    assert claimed.filter("strategy = 'WriteNOS'").count() == 3


def test_no_cycle_reads_history(spark, tmp_path):
    from spark_refresh.plans.state import RefreshState
    from spark_refresh.streaming import refresh as stream

    state = RefreshState(spark, str(tmp_path))
    stream.recover(state)
    state.finished = state.history = None  # would fail if it was looked at
    for low, high in ((fx.WATERMARK, fx.ASOF), (fx.ASOF, fx.LADDER_ASOF)):
        events = fx.tracker(spark, SMALL).where(F.col("event_time").between(F.lit(low).cast("timestamp_ntz"), F.lit(high).cast("timestamp_ntz")))
        stream.apply_events(events, fx.metadata(spark, SMALL), state, high, "lake")
        latest = state.queue().agg(F.max(F.coalesce("event_time_latest", "event_time"))).first()[0]
        assert state.latest_event() == latest


def test_key_with_most_incoming_rows(spark):
    """One table holds two thirds of the incoming rows; the result is that of the rule."""
    n = 60_000
    name = F.when(F.col("id") % 3 < 2, F.lit("hot")).otherwise(F.concat(F.lit("t"), (F.col("id") % 997).cast("string")))
    incoming = spark.range(n).select(
        name.alias("source_table"), F.lit("x").alias("target_table"),
        (F.lit("2025-01-01").cast("timestamp_ntz") + F.expr("make_dt_interval(0,0,0,id)")).alias("event_time"),
        F.lit(None).cast("timestamp_ntz").alias("trigger_time"), F.lit("TPT").alias("strategy"), F.lit(True).alias("lock_rows"),
        F.lit("Q").alias("status"), (F.col("id") % 100).cast("int").alias("priority"), F.lit(None).cast("timestamp_ntz").alias("event_time_latest"),
    )
    after = queue.upsert(queue_frame(spark, queue_row("hot", priority=1)), incoming, ["event_time"])
    assert "SortAggregate" not in plan(after) and "partial_max(event_time" in plan(after)
    rows = {r.source_table: r for r in after.collect()}
    last = max(i for i in range(n) if i % 3 < 2)
    assert rows["hot"].priority == last % 100 and len(rows) == 1 + len({i % 997 for i in range(n) if i % 3 == 2})
    assert history_frame(spark).count() == 0
