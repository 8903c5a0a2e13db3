"""Queries over the queue, its history, the batch queue and whole cycles."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from spark_refresh.functions.times import wall
from spark_refresh.operators import batch, keys, queue
from spark_refresh.plans import transfer
from spark_refresh.plans.refresh import refresh_cycle as cycle
from spark_refresh.plans.state import RefreshState
from spark_refresh.plans.workers import Workers
from spark_refresh.schemas import DEFAULT_SLOTS, QUEUE
from spark_refresh.sources.scratch import fresh_folder, written
from spark_refresh.sources.tracking import tracking_scan
from spark_refresh.streaming import refresh as stream
from spark_refresh.streaming.distinct import late_rows as late_rows_of
from spark_refresh.streaming.distinct import once_each

from . import fixtures as fx
from .registry import query

STATE = f"{fx.QUEUE_SQL}, {fx.HISTORY_SQL}"


# -- single transitions


@query(f"WITH {fx.QUEUE_SQL} SELECT * FROM queue WHERE status = 'Q'")
def queue_in_queue(spark: SparkSession, folder: str) -> DataFrame:
    return queue.in_queue(fx.queue(spark, folder))


@query(f"WITH {fx.QUEUE_SQL} SELECT count(*) AS queued FROM queue WHERE status = 'Q'")
def queue_len(spark: SparkSession, folder: str) -> DataFrame:
    return queue.queue_length(fx.queue(spark, folder))


@query(f"""
WITH {STATE}, seen AS (
    SELECT max(coalesce(event_time_latest, event_time)) AS et FROM queue
    UNION ALL SELECT max(event_time) FROM history)
SELECT max(et) AS last_load_time FROM seen
""")
def last_load_time(spark: SparkSession, folder: str) -> DataFrame:
    return queue.last_load_time(fx.queue(spark, folder), fx.history(spark, folder))


@query(f"""
WITH {fx.QUEUE_SQL}, {fx.INCOMING}, combined AS (
    SELECT source_table, min(target_table) AS target_table, arg_min(event_time, seq) AS first_time,
           arg_min(strategy, seq) AS first_strategy, arg_min(priority, seq) AS first_priority,
           arg_max(event_time, seq) AS last_time, arg_max(priority, seq) AS last_priority, count(*) AS n
    FROM incoming GROUP BY source_table)
SELECT source_table, coalesce(q.target_table, i.target_table) AS target_table,
       coalesce(q.event_time, i.first_time) AS event_time, q.trigger_time,
       coalesce(q.strategy, i.first_strategy) AS strategy, coalesce(q.lock_rows, TRUE) AS lock_rows,
       coalesce(q.status, 'Q') AS status,
       CASE WHEN q.status = 'R' OR i.n IS NULL THEN q.priority
            WHEN q.status IS NULL AND i.n = 1 THEN i.first_priority ELSE i.last_priority END AS priority,
       CASE WHEN q.status = 'R' OR i.n IS NULL THEN q.event_time_latest
            WHEN q.status IS NULL AND i.n = 1 THEN NULL ELSE i.last_time END AS event_time_latest
FROM queue q FULL OUTER JOIN combined i USING (source_table)
""")
def queue_upsert(spark: SparkSession, folder: str) -> DataFrame:
    return queue.upsert(fx.queue(spark, folder), fx.incoming(spark, folder), fx.INCOMING_ORDER)


@query(f"""
WITH {fx.QUEUE_SQL}, {fx.INCOMING}
SELECT source_table, count(*) AS ignored, min(event_time) AS first_event, max(event_time) AS last_event
FROM incoming WHERE source_table IN (SELECT source_table FROM queue WHERE status = 'R')
GROUP BY source_table
""")
def queue_ignored(spark: SparkSession, folder: str) -> DataFrame:
    return queue.ignored_events(fx.queue(spark, folder), fx.incoming(spark, folder))


CLAIMED = """
ranked AS (
    SELECT *, row_number() OVER (PARTITION BY strategy ORDER BY priority DESC, event_time, source_table) AS rank
    FROM {queue} WHERE status = 'Q' AND priority > 0),
claimed AS (SELECT * FROM ranked WHERE rank <= {slots})"""

SLOTS_SQL = "CASE strategy WHEN 'TPT' THEN 8 ELSE 2 END"


@query(f"""
WITH {fx.QUEUE_SQL}, {CLAIMED.format(queue='queue', slots='3')}
SELECT source_table, target_table, event_time, strategy, lock_rows, priority FROM claimed
""")
def queue_claim(spark: SparkSession, folder: str) -> DataFrame:
    return queue.claim_rows(fx.queue(spark, folder), {"TPT": 3, "WriteNOS": 3}).select(
        "source_table", "target_table", "event_time", "strategy", "lock_rows", "priority"
    )


MANY = 500


@query(f"""
WITH {STATE}, {CLAIMED.format(queue='queue', slots=MANY)}
SELECT * REPLACE (coalesce(num_records, -1) AS num_records) FROM history h WHERE NOT (h.status <> 'RUNNING' AND EXISTS (
    SELECT 1 FROM claimed c WHERE c.source_table = h.source_table AND c.event_time = h.event_time))
UNION ALL BY NAME
SELECT source_table, target_table, 'RUNNING' AS status, event_time, TIMESTAMP '{fx.ASOF}' AS trigger_time,
       CAST(NULL AS TIMESTAMP) AS finish_time, CAST(NULL AS DOUBLE) AS duration_min, strategy, lock_rows, priority,
       CAST(NULL AS VARCHAR) AS error, -1 AS num_records
FROM claimed c WHERE NOT EXISTS (
    SELECT 1 FROM history h WHERE c.source_table = h.source_table AND c.event_time = h.event_time AND h.status = 'RUNNING')
""")
def claim_history(spark: SparkSession, folder: str) -> DataFrame:
    """History after a claim large enough to meet events that were processed before."""
    slots = {"TPT": MANY, "WriteNOS": MANY}
    running, done = history_parts(spark, folder)
    claim = queue.claim(fx.queue(spark, folder), running, fx.ASOF, slots)
    after = queue.current_history(running.unionByName(claim.started), done)
    return after.withColumn("num_records", F.coalesce("num_records", F.lit(-1).cast("bigint")))


def history_parts(spark: SparkSession, folder: str) -> tuple[DataFrame, DataFrame]:
    """History as it is kept: rows that run, and rows that have ended."""
    rows = fx.history(spark, folder)
    return rows.where("status = 'RUNNING'"), rows.where("status <> 'RUNNING'")


def tagged(rows: DataFrame, history: DataFrame, *names: str) -> DataFrame:
    frames = []
    for kind, df in (("queue", rows), ("history", history)):
        have = [F.col(n) if n in df.columns else F.lit(None).alias(n) for n in names]
        frames.append(df.select(F.lit(kind).alias("kind"), *have))
    return frames[0].unionByName(frames[1])


@query(f"""
WITH {STATE}
SELECT 'queue' AS kind, source_table, event_time, 'Q' AS status, trigger_time FROM queue
UNION ALL
SELECT 'history', source_table, event_time, status, trigger_time FROM history h WHERE NOT EXISTS (
    SELECT 1 FROM queue q WHERE q.status = 'R' AND q.source_table = h.source_table AND q.event_time = h.event_time)
""")
def queue_requeue(spark: SparkSession, folder: str) -> DataFrame:
    rows, (running, done) = fx.queue(spark, folder), history_parts(spark, folder)
    back = queue.requeue(rows)
    left = running.join(back.select(*queue.PAIR), queue.PAIR, "left_anti")
    return tagged(
        queue.with_changes(rows, back), queue.current_history(left, done), "source_table", "event_time", "status", "trigger_time"
    )


FINISHED = f"""
finished AS (
    SELECT source_table, event_time, CASE WHEN k % 10 = 1 THEN 'FAILED' ELSE 'SUCCESS' END AS status,
           TIMESTAMP '{fx.ASOF}' AS finish_time, CAST(k % 50 AS DOUBLE) AS duration_min,
           k % 1000 AS num_records, CASE WHEN k % 10 = 1 THEN 'lost' ELSE '' END AS error
    FROM (SELECT *, CAST(substring(source_table, 8) AS BIGINT) AS k FROM queue WHERE status = 'R')
    WHERE k % 2 = 1)"""


def finished_runs(running: DataFrame) -> DataFrame:
    k, bad = F.col("k"), F.col("k") % 10 == 1
    return (
        running.filter(F.col("status") == "R")
        .withColumn("k", F.substring_index("source_table", "O", -1).cast("bigint"))
        .filter(k % 2 == 1)
        .select(
            "source_table", "event_time",
            F.when(bad, F.lit("FAILED")).otherwise(F.lit("SUCCESS")).alias("status"),
            wall(fx.ASOF).alias("finish_time"),
            (k % 50).cast("double").alias("duration_min"),
            (k % 1000).alias("num_records"),
            F.when(bad, F.lit("lost")).otherwise(F.lit("")).alias("error"),
        )
    )


@query(f"""
WITH {STATE}, {FINISHED}
SELECT 'queue' AS kind, source_table, event_time, status, CAST(NULL AS TIMESTAMP) AS finish_time,
       CAST(NULL AS DOUBLE) AS duration_min, -1 AS num_records, CAST(NULL AS VARCHAR) AS error
FROM queue q WHERE NOT EXISTS (
    SELECT 1 FROM finished f WHERE f.source_table = q.source_table AND f.event_time = q.event_time)
UNION ALL
SELECT 'history', h.source_table, h.event_time, coalesce(f.status, h.status),
       coalesce(f.finish_time, h.finish_time), coalesce(f.duration_min, h.duration_min),
       coalesce(f.num_records, h.num_records, -1), coalesce(f.error, h.error)
FROM history h LEFT JOIN finished f ON f.source_table = h.source_table AND f.event_time = h.event_time
""")
def queue_dequeue(spark: SparkSession, folder: str) -> DataFrame:
    rows, (running, done) = fx.queue(spark, folder), history_parts(spark, folder)
    outcomes = finished_runs(rows)
    after = queue.finish(rows, running, outcomes.unionByName(outcomes))  # reported twice, counted once
    left = running.join(after.finished.select(*queue.PAIR), queue.PAIR, "left_anti")
    wide = tagged(
        queue.with_changes(rows, gone=after.gone), queue.current_history(left, done.unionByName(after.finished)),
        "source_table", "event_time", "status", "finish_time", "duration_min", "num_records", "error",
    )
    return wide.withColumn("num_records", F.coalesce("num_records", F.lit(-1).cast("bigint")))


@query(f"WITH {fx.INCOMING} SELECT source_table, count(*) AS n FROM incoming GROUP BY source_table HAVING count(*) > 1")
def pk_violations(spark: SparkSession, folder: str) -> DataFrame:
    return keys.duplicate_keys(fx.incoming(spark, folder), "source_table")


@query("""
SELECT 'queue' AS name, count(*) FILTER (o_orderstatus IN ('O', 'P')) AS rows_before, CAST(0 AS BIGINT) AS rows_after FROM orders
UNION ALL
SELECT 'history', count(*) FILTER (o_orderstatus = 'F' OR (o_orderstatus = 'P' AND o_orderkey % 3 <> 0)
    OR (o_orderstatus = 'O' AND o_orderkey % 11 = 0)), 0 FROM orders
""")
def queue_reset(spark: SparkSession, folder: str) -> DataFrame:
    state = RefreshState(spark, fresh_folder(spark, "state"))
    running, done = history_parts(spark, folder)
    state.put_queue(fx.queue(spark, folder))
    state.add_finished(done.unionByName(running))

    def sizes(before: int, after: int) -> list[DataFrame]:
        return [
            df.select(F.lit(n).alias("name"), F.lit(before).alias("before"), F.lit(after).alias("after"))
            for n, df in (("queue", state.queue()), ("history", state.finished()))
        ]

    held = reduce(DataFrame.unionByName, sizes(1, 0)).groupBy("name").agg(F.sum("before").alias("before")).transform(written, "held")
    stream.recover(state, reset=True)
    left = reduce(DataFrame.unionByName, sizes(0, 1)).groupBy("name").agg(F.sum("after").alias("after"))
    return held.join(left, "name", "left").select(
        "name", F.col("before").alias("rows_before"), F.coalesce("after", F.lit(0)).cast("bigint").alias("rows_after"))


# -- batch queue

BATCH_QUEUE = f"""{fx.MANIFEST}, batch_queue AS (
    SELECT source AS source_table, target AS target_table, strategy, lock_rows, 'Q' AS status,
           count(*) OVER () - row_number() OVER (ORDER BY line_no) AS priority
    FROM manifest)"""

BATCH_CLAIMED = f"""{BATCH_QUEUE}, batch_ranked AS (
    SELECT *, row_number() OVER (PARTITION BY strategy ORDER BY priority DESC) AS rank FROM batch_queue),
batch_claimed AS (SELECT * FROM batch_ranked WHERE rank <= {SLOTS_SQL})"""


def batch_rows(spark: SparkSession, folder: str) -> DataFrame:
    return written(batch.enqueue(fx.manifest(spark, folder), check=False), "batch-queue")


@query(f"WITH {BATCH_QUEUE} SELECT * FROM batch_queue")
def batch_enqueue(spark: SparkSession, folder: str) -> DataFrame:
    return batch.enqueue(fx.manifest(spark, folder))


@query(f"WITH {BATCH_CLAIMED} SELECT source_table, target_table, lock_rows FROM batch_claimed")
def batch_claim(spark: SparkSession, folder: str) -> DataFrame:
    return batch.claim_rows(batch_rows(spark, folder)).select("source_table", "target_table", "lock_rows")


@query(f"""
WITH {BATCH_CLAIMED}
SELECT source_table, CASE WHEN source_table IN (SELECT source_table FROM batch_claimed) THEN 'R' ELSE 'Q' END AS status,
       priority
FROM batch_queue
WHERE source_table NOT IN (SELECT source_table FROM batch_claimed WHERE strategy = 'TPT')
""")
def batch_dequeue(spark: SparkSession, folder: str) -> DataFrame:
    """One strategy has finished what it claimed, the other has not."""
    rows = batch_rows(spark, folder)
    claimed = written(batch.claim_rows(rows), "batch-claimed")
    left = batch.dequeue(batch.mark_running(rows, claimed), claimed.filter(F.col("strategy") == "TPT"))
    return left.select("source_table", "status", "priority")


@query(f"""
WITH {BATCH_CLAIMED}
SELECT (SELECT count(*) FROM batch_claimed) AS picked_up,
       (SELECT count(*) FROM manifest) - (SELECT count(*) FROM batch_claimed) AS queued,
       (SELECT count(*) FROM manifest) AS total
""")
def batch_progress(spark: SparkSession, folder: str) -> DataFrame:
    rows = batch_rows(spark, folder)
    running = batch.mark_running(rows, written(batch.claim_rows(rows), "batch-claimed"))
    return batch.progress(running, fx.manifest(spark, folder))


# -- whole cycles

REFRESHED = f"""
arriving AS (
    SELECT source_table, min(event_time) AS first_event, max(event_time) AS last_event, count(*) AS n
    FROM {{events}} GROUP BY source_table),
refreshed AS (
    SELECT source_table, 'lake.' || target_table AS target_table, first_event AS event_time,
           CAST(NULL AS TIMESTAMP) AS trigger_time, strategy, TRUE AS lock_rows, 'Q' AS status,
           {{score}} AS priority,
           CASE WHEN n > 1 THEN last_event END AS event_time_latest
    FROM arriving JOIN metadata USING (source_table))"""

CYCLE = (
    f"{fx.TRACKER}, {fx.RECENT}, {fx.METADATA}, "
    + REFRESHED.format(events="recent", score=fx.score_sql("last_event"))
)


def refresh_flow(spark: SparkSession, folder: str) -> DataFrame:
    """Scan, enrich, prioritise, put into an empty queue, claim: the flagship.

    As in the running system the new queue is stored before rows are claimed from it.
    """
    events = fx.table(spark, folder, "events")
    found = tracking_scan(events, fx.source_table(), "ts", fx.WATERMARK, fx.ASOF)
    empty = spark.createDataFrame([], QUEUE)
    after = written(cycle(found, fx.metadata(spark, folder), empty, fx.ASOF, fx.CATALOG), "queue")
    order = [F.desc("priority"), F.asc("event_time"), F.asc("source_table")]
    ranks = queue.top_rows(queue.claimable(after), DEFAULT_SLOTS, order).select("source_table", "claim_rank")
    return after.join(ranks, "source_table", "left").withColumn(
        "claim_rank", F.coalesce("claim_rank", F.lit(0))
    )


@query(f"""
WITH {CYCLE}, {CLAIMED.format(queue='refreshed', slots=SLOTS_SQL)}
SELECT r.*, CAST(coalesce(c.rank, 0) AS INTEGER) AS claim_rank
FROM refreshed r LEFT JOIN claimed c USING (source_table)
""")
def refresh_cycle(spark: SparkSession, folder: str) -> DataFrame:
    return refresh_flow(spark, folder)


SECOND = f"""
WITH {fx.TRACKER}, {fx.RECENT}, {fx.METADATA}, early AS (
    SELECT source_table, min(event_time) AS f1, max(event_time) AS l1, count(*) AS n1 FROM tracker
    WHERE event_time <= TIMESTAMP '{fx.WATERMARK}' AND source_table NOT LIKE '%.T2' GROUP BY source_table),
arriving AS (
    SELECT source_table, min(event_time) AS first_event, max(event_time) AS last_event, count(*) AS n FROM recent
    WHERE source_table NOT LIKE '%.T4' GROUP BY source_table),
joined AS (
    SELECT *, CASE WHEN f1 IS NULL THEN 'new' WHEN source_table LIKE '%.T5' THEN 'R' ELSE 'Q' END AS was,
           CASE WHEN n1 > 1 THEN l1 END AS latest
    FROM metadata LEFT JOIN early USING (source_table) LEFT JOIN arriving USING (source_table)
    WHERE f1 IS NOT NULL OR n IS NOT NULL)
SELECT source_table, 'lake.' || target_table AS target_table, coalesce(f1, first_event) AS event_time,
       CAST(NULL AS TIMESTAMP) AS trigger_time, strategy, TRUE AS lock_rows,
       CASE was WHEN 'R' THEN 'R' ELSE 'Q' END AS status,
       CASE WHEN was = 'R' THEN {fx.score_sql('l1', fx.WATERMARK)}
            WHEN n IS NOT NULL THEN {fx.score_sql('last_event')} ELSE {fx.score_sql('f1')} END AS priority,
       CASE WHEN was = 'R' THEN latest WHEN was = 'new' THEN CASE WHEN n > 1 THEN last_event END
            WHEN n IS NOT NULL THEN last_event ELSE coalesce(latest, f1) END AS event_time_latest
FROM joined
"""


@query(SECOND)
def refresh_waiting(spark: SparkSession, folder: str) -> DataFrame:
    """A second cycle, on a queue in which tables wait or run: some get new events, some
    get none, and some tables are new."""
    attrs, name = fx.metadata(spark, folder), F.col("source_table")
    early = fx.tracker(spark, folder).filter(
        (F.col("event_time") <= wall(fx.WATERMARK)) & ~name.like("%.T2")
    )
    first = cycle(early, attrs, spark.createDataFrame([], QUEUE), fx.WATERMARK, fx.CATALOG)
    running = F.when(name.like("%.T5"), F.lit("R")).otherwise(F.col("status"))
    state = written(first.withColumn("status", running), "queue")
    new = fx.recent(spark, folder).filter(~name.like("%.T4"))
    return cycle(new, attrs, state, fx.ASOF, fx.CATALOG)


ALL_EVENTS = (
    f"{fx.TRACKER}, {fx.METADATA}, "
    + REFRESHED.format(events="tracker", score=fx.score_sql("last_event", fx.LADDER_ASOF))
)


def split_events(spark: SparkSession, folder: str, files: int) -> str:
    """The events by time in several files, written one after the other."""
    events, target = fx.table(spark, folder, "events"), fresh_folder(spark, "event-files")
    low, high = (r.timestamp() for r in events.agg(F.min(F.col("ts").cast("timestamp")), F.max(F.col("ts").cast("timestamp"))).first())
    at = F.unix_seconds(F.col("ts").cast("timestamp"))
    number = F.least(F.floor((at - int(low)) * files / (int(high) - int(low) + 1)), F.lit(files - 1))
    for i in range(files):
        events.where(number == i).coalesce(1).write.mode("append").parquet(target)
    return target


def run_stream(spark: SparkSession, folder: str, files: int = 1) -> RefreshState:
    """All events through the streaming query, in as many batches; the state it leaves."""
    state = RefreshState(spark, fresh_folder(spark, "state"))
    stream.recover(state)
    schema = fx.table(spark, folder, "events").schema
    path = f"{folder}/events.parquet*" if files == 1 else split_events(spark, folder, files)
    events = stream.tracking_stream(spark, path, schema, fx.source_table(), "ts", max_files=1 if files > 1 else None)
    attrs = fx.metadata(spark, folder)
    run = stream.start_refresh(
        events, lambda: attrs, state, fresh_folder(spark, "stream"), fx.CATALOG,
        asof=lambda: fx.LADDER_ASOF, available_now=True,
    )
    run.awaitTermination()
    return state


@query(f"WITH {ALL_EVENTS} SELECT * FROM refreshed")
def stream_refresh(spark: SparkSession, folder: str) -> DataFrame:
    return run_stream(spark, folder).queue()


@query(f"""
WITH {ALL_EVENTS}
SELECT source_table, event_time, event_time_latest, priority, status FROM refreshed
""")
def stream_batches(spark: SparkSession, folder: str) -> DataFrame:
    """The same in three batches: waiting tables carry their first event over, and are put
    in again by those that follow."""
    state = run_stream(spark, folder, files=3)
    assert state.note()[stream.BATCH] == 2
    return state.queue().select("source_table", "event_time", "event_time_latest", "priority", "status")


@query(f"""
WITH {ALL_EVENTS}
SELECT CASE WHEN strategy = 'WriteNOS' THEN 'queue' ELSE 'history' END AS kind, source_table, event_time,
       CASE WHEN strategy = 'WriteNOS' THEN 'Q' ELSE 'SUCCESS' END AS status, priority,
       CASE WHEN strategy = 'WriteNOS' THEN -1 ELSE length(source_table) END AS num_records
FROM refreshed
""")
def stream_queue_state(spark: SparkSession, folder: str) -> DataFrame:
    """The streaming query, and workers that take all tables of one strategy from queued
    over running to done; the other strategy is switched off and waits."""
    state = run_stream(spark, folder)
    workers = Workers(state, lambda row: len(row["source_table"]), {"TPT": 8, "WriteNOS": 0}, asof=lambda: fx.LADDER_ASOF)
    workers.drain()
    workers.stop()
    both = tagged(state.queue(), state.history(), "source_table", "event_time", "status", "priority", "num_records")
    return both.withColumn("num_records", F.coalesce("num_records", F.lit(-1)).cast("bigint"))


@query(f"""
WITH {ALL_EVENTS}, sizes AS (
    SELECT source_table, count(*) AS n FROM tracker GROUP BY source_table)
SELECT source_table, event_time, CASE WHEN source_table LIKE '%.T3' THEN 'FAILED' ELSE 'SUCCESS' END AS status,
       CASE WHEN source_table LIKE '%.T3' THEN 0 ELSE n END AS num_records,
       CASE WHEN source_table LIKE '%.T3' THEN 'source is gone' ELSE '' END AS error,
       (SELECT count(*) FROM refreshed) AS loaded, 0 AS waiting
FROM refreshed JOIN sizes USING (source_table)
""")
def event_load(spark: SparkSession, folder: str) -> DataFrame:
    """From events to copied tables: queue, claims as slots come free, a copy of each table,
    history, until the queue is empty. The rows of a table are the events that name it, one
    folder per table."""
    base = fresh_folder(spark, "event-load")
    events = fx.table(spark, folder, "events").withColumn("source_table", fx.source_table())
    events.write.partitionBy("source_table").parquet(f"{base}/source")
    sources = spark.read.parquet(f"{base}/source")

    def load(row) -> int:
        name = row["source_table"]
        if name.endswith(".T3"):
            raise RuntimeError("source is gone")
        rows = sources.filter(F.col("source_table") == name).drop("source_table")
        target = transfer.target_folder(spark, f"{base}/{row['target_table']}", rows.schema)
        return transfer.copy_table(rows, target, f"{base}/stage/{name}")

    state = run_stream(spark, folder)
    workers = Workers(state, load, DEFAULT_SLOTS)
    waiting = workers.drain()
    workers.stop()
    history = state.history()
    return history.select(
        "source_table", "event_time", "status", "num_records", "error",
        F.lit(history.count()).cast("bigint").alias("loaded"), F.lit(waiting).alias("waiting"))


DELIVERIES = 4
EMPTY_BATCHES = "spark.sql.streaming.noDataMicroBatches.enabled"


@query(f"""
WITH bounds AS (SELECT CAST(floor(epoch(min(ts))) AS BIGINT) AS low, CAST(floor(epoch(max(ts))) AS BIGINT) AS high FROM events),
numbered AS (
    SELECT upper(event_type) || '.T' || CAST(user_id % 10 AS VARCHAR) AS source_table, event_id,
           least((CAST(floor(epoch(ts)) AS BIGINT) - low) * {DELIVERIES} // (high - low + 1), {DELIVERIES - 1}) = 0 AND event_id % 13 = 0 AS late
    FROM events, bounds)
SELECT source_table, count(*) FILTER (NOT late) AS n, (SELECT count(*) FROM numbered WHERE late) AS late_rows
FROM numbered GROUP BY source_table
""")
def stream_distinct(spark: SparkSession, folder: str) -> DataFrame:
    """Events in four deliveries: some come twice at once, some again in the next one, and some
    of the first only in the last, too late."""
    events, base = fx.table(spark, folder, "events"), fresh_folder(spark, "deliveries")
    at = F.unix_seconds(F.col("ts").cast("timestamp"))
    low, high = events.agg(F.min(at), F.max(at)).first()
    quarter = F.least(F.floor((at - low) * DELIVERIES / (high - low + 1)), F.lit(DELIVERIES - 1))
    number, held = F.col("event_id"), (quarter == 0) & (F.col("event_id") % 13 == 0)
    rows = events.select(fx.source_table().alias("source_table"), "event_id", F.col("ts").cast("timestamp").alias("event_time"), quarter.alias("quarter"), held.alias("held"))
    late = 0
    for i in range(DELIVERIES):
        own = rows.where((F.col("quarter") == i) & ~F.col("held"))
        again = rows.where((F.col("quarter") == i - 1) & ~F.col("held") & (number % 7 == 0))
        sent = own.unionByName(own.where(number % 10 == 0)).unionByName(again)
        if i == DELIVERIES - 1:
            sent = sent.unionByName(rows.where("held"))
        sent.drop("quarter", "held").write.mode("append").parquet(f"{base}/events")
        # a run takes all files of a delivery as one batch and goes on from the state of the run before
        source = spark.readStream.schema("source_table string, event_id bigint, event_time timestamp").parquet(f"{base}/events")
        kept = once_each(source, f"{int(0.2 * (high - low))} seconds", ["event_id"])
        before = spark.conf.get(EMPTY_BATCHES)
        spark.conf.set(EMPTY_BATCHES, "false")  # a run would end with one, which moves the watermark on before the next delivery
        try:
            run = kept.writeStream.format("parquet").option("path", f"{base}/kept").option("checkpointLocation", f"{base}/checkpoint").trigger(availableNow=True).start()
        finally:
            spark.conf.set(EMPTY_BATCHES, before)
        run.awaitTermination()
        late += late_rows_of(run)
    late = F.lit(late).cast("bigint").alias("late_rows")
    return spark.read.parquet(f"{base}/kept").groupBy("source_table").agg(F.count(F.lit(1)).alias("n")).select("source_table", "n", late)
