"""Control data derived from the given tables: as Spark frames and as SQL.

Everything grows with the tables it is derived from.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from spark_refresh.functions.times import drop_fraction, plus_seconds
from spark_refresh.schemas import HISTORY, QUEUE
from spark_refresh.sources.scratch import written
from spark_refresh.sources.tracking import tracking_scan

WATERMARK = "2024-01-20 00:00:00"
ASOF = "2024-01-25 00:00:00"
LADDER_ASOF = "2024-02-01 00:00:00"
CATALOG = "lake"


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


# -- tracking events


def source_table() -> Column:
    return F.concat(F.upper("event_type"), F.lit(".T"), (F.col("user_id") % 10).cast("string"))


TRACKER = """
tracker AS (
    SELECT upper(event_type) || '.T' || CAST(user_id % 10 AS VARCHAR) AS source_table,
           date_trunc('second', ts) AS event_time, event_id
    FROM events
)"""

RECENT = f"""
recent AS (
    SELECT * FROM tracker
    WHERE event_time > TIMESTAMP '{WATERMARK}' AND event_time <= TIMESTAMP '{ASOF}'
)"""


def tracker(spark: SparkSession, folder: str) -> DataFrame:
    return table(spark, folder, "events").select(
        source_table().alias("source_table"), drop_fraction(F.col("ts")).alias("event_time"), "event_id"
    )


def recent(spark: SparkSession, folder: str, since: str = WATERMARK) -> DataFrame:
    events = table(spark, folder, "events")
    return tracking_scan(events, source_table(), "ts", since, ASOF, "event_id")


# -- table metadata

METADATA = """
metadata AS (
    SELECT source_table,
           CASE WHEN t % 4 = 3 THEN source_table ELSE 'LAKE_' || source_table END AS target_table,
           CASE WHEN t % 4 = 0 THEN 'WriteNOS' ELSE 'TPT' END AS strategy,
           t = 7 AS disabled, CAST(1 + t % 3 AS INTEGER) AS priority,
           CAST(3600 * t AS INTEGER) AS min_staleness,
           CAST(86400 * (1 + t % 4) AS INTEGER) AS max_staleness
    FROM (SELECT DISTINCT upper(event_type) || '.T' || CAST(user_id % 10 AS VARCHAR) AS source_table,
                          user_id % 10 AS t FROM events)
    WHERE t < 8
)"""


def metadata_rows(spark: SparkSession, folder: str) -> DataFrame:
    t = F.col("t")
    names = (
        table(spark, folder, "events")
        .select("event_type", (F.col("user_id") % 10).alias("t"))
        .filter(t < 8)
        .distinct()
        .select(F.concat(F.upper("event_type"), F.lit(".T"), t.cast("string")).alias("source_table"), "t")
    )
    return names.select(
        "source_table",
        F.when(t % 4 == 3, F.col("source_table"))
        .otherwise(F.concat(F.lit("LAKE_"), "source_table")).alias("target_table"),
        F.when(t % 4 == 0, F.lit("WriteNOS")).otherwise(F.lit("TPT")).alias("strategy"),
        (t == 7).alias("disabled"),
        (1 + t % 3).cast("int").alias("priority"),
        (3600 * t).cast("int").alias("min_staleness"),
        (86400 * (1 + t % 4)).cast("int").alias("max_staleness"),
    )


def metadata(spark: SparkSession, folder: str) -> DataFrame:
    """Metadata as a stored table, as it is in use: its size is known when it is joined."""
    return written(metadata_rows(spark, folder), "metadata")


# -- ladder

LADDER = f"""
ladder AS (
    SELECT event_id, s AS staleness,
           CASE WHEN event_id % 13 = 0 THEN s + 1 ELSE 0 END AS min_staleness,
           s + event_id % 91 - 15 AS max_staleness
    FROM (SELECT event_id,
                 CAST(epoch(TIMESTAMP '{LADDER_ASOF}') - epoch(date_trunc('second', ts)) AS BIGINT) AS s
          FROM events)
)"""


# -- queue and history

QUEUE_SQL = """
queue AS (
    SELECT 'SALES.O' || CAST(o_orderkey AS VARCHAR) AS source_table,
           'lake.SALES.O' || CAST(o_orderkey AS VARCHAR) AS target_table,
           o_orderdate + to_seconds(o_orderkey % 86400) AS event_time,
           CASE WHEN o_orderstatus = 'P' THEN o_orderdate + to_seconds(o_orderkey % 86400 + 60) END AS trigger_time,
           CASE WHEN o_orderkey % 5 = 0 THEN 'WriteNOS' ELSE 'TPT' END AS strategy,
           o_orderkey % 2 = 0 AS lock_rows,
           CASE o_orderstatus WHEN 'O' THEN 'Q' ELSE 'R' END AS status,
           CAST(substring(o_orderpriority, 1, 1) AS INTEGER) - 1 AS priority,
           CASE WHEN o_orderkey % 7 = 0 THEN o_orderdate + to_seconds(o_orderkey % 86400 + 600) END AS event_time_latest
    FROM orders WHERE o_orderstatus IN ('O', 'P')
)"""

HISTORY_SQL = """
history AS (
    SELECT 'SALES.O' || CAST(o_orderkey AS VARCHAR) AS source_table,
           'lake.SALES.O' || CAST(o_orderkey AS VARCHAR) AS target_table,
           CASE WHEN o_orderstatus = 'P' THEN 'RUNNING'
                WHEN o_orderkey % 10 = 0 THEN 'FAILED' ELSE 'SUCCESS' END AS status,
           o_orderdate + to_seconds(o_orderkey % 86400) AS event_time,
           o_orderdate + to_seconds(o_orderkey % 86400 + 60) AS trigger_time,
           CASE WHEN o_orderstatus <> 'P' THEN o_orderdate + to_seconds(o_orderkey % 86400 + 60 * (o_orderkey % 90)) END AS finish_time,
           CASE WHEN o_orderstatus <> 'P' THEN CAST(o_orderkey % 90 AS DOUBLE) END AS duration_min,
           CASE WHEN o_orderkey % 5 = 0 THEN 'WriteNOS' ELSE 'TPT' END AS strategy,
           o_orderkey % 2 = 0 AS lock_rows,
           CAST(substring(o_orderpriority, 1, 1) AS INTEGER) - 1 AS priority,
           CASE WHEN o_orderstatus = 'P' THEN NULL
                WHEN o_orderkey % 10 = 0 THEN 'no space left for ''O' || CAST(o_orderkey AS VARCHAR) || '''' ELSE '' END AS error,
           CASE WHEN o_orderstatus <> 'P' THEN o_orderkey * 7 % 1000 END AS num_records
    FROM orders
    WHERE o_orderstatus = 'F' OR (o_orderstatus = 'P' AND o_orderkey % 3 <> 0)
       OR (o_orderstatus = 'O' AND o_orderkey % 11 = 0)
)"""


def at(seconds: Column) -> Column:
    return plus_seconds(F.col("o_orderdate"), seconds)


def _order_columns() -> dict[str, Column]:
    key = F.col("o_orderkey")
    text_key = key.cast("string")
    return {
        "source_table": F.concat(F.lit("SALES.O"), text_key),
        "target_table": F.concat(F.lit("lake.SALES.O"), text_key),
        "event_time": at(key % 86400),
        "strategy": F.when(key % 5 == 0, F.lit("WriteNOS")).otherwise(F.lit("TPT")),
        "lock_rows": key % 2 == 0,
        "priority": (F.substring("o_orderpriority", 1, 1).cast("int") - 1),
    }


def queue(spark: SparkSession, folder: str) -> DataFrame:
    key = F.col("o_orderkey")
    open_order = F.col("o_orderstatus") == "O"
    columns = _order_columns() | {
        "trigger_time": F.when(~open_order, at(key % 86400 + 60)),
        "status": F.when(open_order, F.lit("Q")).otherwise(F.lit("R")),
        "event_time_latest": F.when(key % 7 == 0, at(key % 86400 + 600)),
    }
    orders = table(spark, folder, "orders").filter(F.col("o_orderstatus").isin("O", "P"))
    return orders.select(*(columns[n].alias(n) for n in QUEUE.names))


def history(spark: SparkSession, folder: str) -> DataFrame:
    key, state = F.col("o_orderkey"), F.col("o_orderstatus")
    done, bad = state != "P", key % 10 == 0
    columns = _order_columns() | {
        "status": F.when(~done, F.lit("RUNNING")).when(bad, F.lit("FAILED")).otherwise(F.lit("SUCCESS")),
        "trigger_time": at(key % 86400 + 60),
        "finish_time": F.when(done, at(key % 86400 + 60 * (key % 90))),
        "duration_min": F.when(done, (key % 90).cast("double")),
        "error": F.when(~done, F.lit(None))
        .when(bad, F.concat(F.lit("no space left for 'O"), key.cast("string"), F.lit("'")))
        .otherwise(F.lit("")),
        "num_records": F.when(done, key * 7 % 1000),
    }
    orders = table(spark, folder, "orders").filter(
        (state == "F") | ((state == "P") & (key % 3 != 0)) | ((state == "O") & (key % 11 == 0))
    )
    return orders.select(*(columns[n].alias(n) for n in HISTORY.names))


# -- incoming rows, several per key

INCOMING_ORDER = (
    "event_time", "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_quantity",
    "l_extendedprice", "l_discount", "l_tax",
)

INCOMING = """
incoming AS (
    SELECT 'SALES.O' || CAST(l_orderkey AS VARCHAR) AS source_table,
           'lake.SALES.O' || CAST(l_orderkey AS VARCHAR) AS target_table,
           l_shipdate AS event_time,
           CASE WHEN l_suppkey % 5 = 0 THEN 'WriteNOS' ELSE 'TPT' END AS strategy,
           CAST(l_quantity AS INTEGER) % 26 AS priority,
           row_number() OVER (ORDER BY l_shipdate, l_orderkey, l_linenumber, l_partkey, l_suppkey,
                              l_quantity, l_extendedprice, l_discount, l_tax) AS seq
    FROM lineitem
)"""


def incoming(spark: SparkSession, folder: str) -> DataFrame:
    text_key = F.col("l_orderkey").cast("string")
    columns = {
        "source_table": F.concat(F.lit("SALES.O"), text_key),
        "target_table": F.concat(F.lit("lake.SALES.O"), text_key),
        "event_time": F.col("l_shipdate"),
        "trigger_time": F.lit(None).cast("timestamp_ntz"),
        "strategy": F.when(F.col("l_suppkey") % 5 == 0, F.lit("WriteNOS")).otherwise(F.lit("TPT")),
        "lock_rows": F.lit(True),
        "status": F.lit("Q"),
        "priority": F.col("l_quantity").cast("int") % 26,
        "event_time_latest": F.lit(None).cast("timestamp_ntz"),
    }
    return table(spark, folder, "lineitem").select(
        *(columns[n].alias(n) for n in QUEUE.names),
        *(c for c in INCOMING_ORDER if c != "event_time"),
    )


# -- batch manifest

MANIFEST = """
manifest AS (
    SELECT 'SALES.P' || CAST(p_partkey AS VARCHAR) AS source,
           'lake.SALES.P' || CAST(p_partkey AS VARCHAR) AS target,
           CASE WHEN p_partkey % 5 = 0 THEN 'WriteNOS' ELSE 'TPT' END AS strategy,
           p_partkey % 2 = 0 AS lock_rows, p_partkey AS line_no
    FROM part
)"""


def manifest(spark: SparkSession, folder: str) -> DataFrame:
    key = F.col("p_partkey")
    return table(spark, folder, "part").select(
        F.concat(F.lit("SALES.P"), key.cast("string")).alias("source"),
        F.concat(F.lit("lake.SALES.P"), key.cast("string")).alias("target"),
        F.when(key % 5 == 0, F.lit("WriteNOS")).otherwise(F.lit("TPT")).alias("strategy"),
        (key % 2 == 0).alias("lock_rows"),
        key.alias("line_no"),
    )


# -- pieces of SQL

def ladder_sql(staleness: str, low: str, high: str) -> str:
    left = f"({high} - ({staleness}))"
    return f"""CASE WHEN ({staleness}) < {low} THEN 0 WHEN {left} > 60 THEN 1 WHEN {left} > 45 THEN 2
        WHEN {left} > 30 THEN 3 WHEN {left} > 15 THEN 4 WHEN {left} > 10 THEN 5 WHEN {left} > 5 THEN 6
        WHEN {left} > 3 THEN 7 WHEN {left} > 2 THEN 8 WHEN {left} > 1 THEN 9 WHEN {left} > 0 THEN 10
        WHEN {left} > -5 THEN 15 WHEN {left} > -10 THEN 20 ELSE 25 END"""


def score_sql(event_time: str, asof: str = ASOF, alias: str = "") -> str:
    stale = f"CAST(epoch(TIMESTAMP '{asof}') - epoch({event_time}) AS BIGINT)"
    level = ladder_sql(stale, f"{alias}min_staleness", f"{alias}max_staleness")
    return f"CAST(({level}) * {alias}priority AS INTEGER)"

