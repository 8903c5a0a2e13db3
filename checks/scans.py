"""Queries over tracking events, metadata, control files and text checks."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from spark_refresh.functions import names, times
from spark_refresh.functions.priority import ladder, staleness
from spark_refresh.operators import enrich
from spark_refresh.operators.queue import watermark
from spark_refresh.sources import catalogue, control, tracking
from spark_refresh.sources.scratch import fresh_folder

from . import fixtures as fx
from .registry import query

METADATA_COLUMNS = ", ".join(control.METADATA_FIELDS)


# -- scans


@query(f"WITH {fx.TRACKER} , {fx.RECENT} SELECT source_table, event_time, event_id FROM recent")
def tracking_scan(spark: SparkSession, folder: str) -> DataFrame:
    return fx.recent(spark, folder)


@query(f"""
WITH {fx.TRACKER}, arriving AS (
    SELECT *, CASE WHEN event_id % 17 = 0 THEN event_time + INTERVAL 1 DAY ELSE event_time END AS arrival
    FROM tracker)
SELECT * FROM arriving
WHERE event_time <= TIMESTAMP '{fx.WATERMARK}' AND arrival > TIMESTAMP '{fx.WATERMARK}'
""")
def late_rows(spark: SparkSession, folder: str) -> DataFrame:
    late = F.when(F.col("event_id") % 17 == 0, times.plus_seconds(F.col("event_time"), 86400))
    arriving = fx.tracker(spark, folder).withColumn("arrival", F.coalesce(late, "event_time"))
    return tracking.late_events(arriving, fx.WATERMARK, "arrival")


@query(f"""
WITH {fx.QUEUE_SQL}, {fx.HISTORY_SQL}, seen AS (
    SELECT max(coalesce(event_time_latest, event_time)) AS et FROM queue
    UNION ALL SELECT max(event_time) FROM history)
SELECT coalesce(max(et), TIMESTAMP '{fx.WATERMARK}') AS watermark FROM seen
""")
def init_watermark(spark: SparkSession, folder: str) -> DataFrame:
    return watermark(fx.queue(spark, folder), fx.history(spark, folder), fx.WATERMARK)


@query(f"""
WITH {fx.TRACKER}
SELECT source_table, event_time, min(event_id) AS event_id FROM tracker GROUP BY ALL
""")
def dedup_events(spark: SparkSession, folder: str) -> DataFrame:
    return tracking.distinct_events(fx.tracker(spark, folder), "event_id")


# -- metadata


@query("""
SELECT 'SALES.P' || CAST(p_partkey AS VARCHAR) AS source_table,
       CASE WHEN p_partkey % 3 = 0 THEN 'SALES.P' ELSE 'LAKE.P' END || CAST(p_partkey AS VARCHAR) AS target_table,
       CASE WHEN p_partkey % 4 = 0 THEN 'WriteNOS' ELSE 'TPT' END AS strategy,
       p_partkey % 7 = 0 AS disabled,
       CAST(p_partkey % 9 + CASE WHEN p_partkey % 5 = 0 THEN 100 ELSE 0 END AS INTEGER) AS priority,
       CAST(CASE WHEN p_partkey % 6 = 0 THEN 0 ELSE p_size END AS INTEGER) AS min_staleness,
       CAST(p_size + 100 AS INTEGER) AS max_staleness
FROM part
""")
def metadata_scan(spark: SparkSession, folder: str) -> DataFrame:
    """Metadata file with blank fields and, for every fifth table, a second line."""
    key = F.col("p_partkey")
    text = key.cast("string")
    versions = F.when(key % 5 == 0, F.array(F.lit(0), F.lit(100))).otherwise(F.array(F.lit(0)))
    lines = (
        fx.table(spark, folder, "part")
        .select("p_partkey", "p_size", F.explode(versions).alias("extra"))
        .select(
            F.concat_ws(
                ",",
                F.concat(F.lit("SALES.P"), text),
                F.when(key % 3 == 0, F.lit("")).otherwise(F.concat(F.lit("LAKE.P"), text)),
                F.when(key % 4 == 0, F.lit("WriteNOS")).otherwise(F.lit("TPT")),
                F.when(key % 7 == 0, F.lit(" True")).otherwise(F.lit("false")),
                (key % 9 + F.col("extra")).cast("string"),
                F.when(key % 6 == 0, F.lit("")).otherwise(F.col("p_size").cast("string")),
                (F.col("p_size") + 100).cast("string"),
            ).alias("line")
        )
    )
    path = fresh_folder(spark, "metadata-file")
    lines.write.text(path)
    return control.read_metadata(spark, path)


@query(f"""
WITH {fx.METADATA}, given AS (
    SELECT *, right(source_table, 1) AS digit FROM metadata)
SELECT source_table,
       CASE WHEN digit IN ('1', '5') THEN source_table ELSE target_table END AS target_table,
       strategy, disabled, priority,
       CASE WHEN digit IN ('2', '4') THEN 0 ELSE min_staleness END AS min_staleness, max_staleness
FROM given
""")
def metadata_defaults(spark: SparkSession, folder: str) -> DataFrame:
    digit = F.right(F.col("source_table"), F.lit(1))
    given = fx.metadata_rows(spark, folder).withColumns({
        "target_table": F.when(~digit.isin("1", "5"), F.col("target_table")).otherwise(F.lit("")),
        "min_staleness": F.when(
            ~digit.isin("2", "4"), F.col("min_staleness").cast("string")
        ).otherwise(F.lit("")),
    })
    target, floor = control.with_defaults(
        F.col("source_table"), F.col("target_table"), F.col("min_staleness")
    )
    return given.withColumns({"target_table": target, "min_staleness": floor.cast("int")})


@query(f"""
WITH {fx.METADATA}
SELECT source_table, target_table, strategy, disabled,
       CAST(priority + CASE WHEN strategy = 'TPT' THEN 20 ELSE 0 END AS INTEGER) AS priority,
       min_staleness, max_staleness
FROM metadata
""")
def metadata_last_wins(spark: SparkSession, folder: str) -> DataFrame:
    """Three lines for each table of one strategy, one for the others."""
    lines = fx.metadata_rows(spark, folder).withColumn(
        "line_no",
        F.explode(F.when(F.col("strategy") == "TPT", F.sequence(F.lit(0), F.lit(2))).otherwise(F.array(F.lit(0)))),
    )
    changed = lines.withColumn("priority", (F.col("priority") + 10 * F.col("line_no")).cast("int"))
    return control.last_per_table(changed, F.col("line_no"))


SHORT_WINDOW = "2024-01-24 22:00:00"


@query(f"""
WITH {fx.TRACKER}, {fx.METADATA}, {fx.QUEUE_SQL}
SELECT {METADATA_COLUMNS} FROM metadata
WHERE source_table IN (SELECT source_table FROM queue UNION ALL
    SELECT source_table FROM tracker
    WHERE event_time > TIMESTAMP '{SHORT_WINDOW}' AND event_time <= TIMESTAMP '{fx.ASOF}')
""")
def metadata_semi(spark: SparkSession, folder: str) -> DataFrame:
    events = fx.recent(spark, folder, SHORT_WINDOW)
    return enrich.wanted_metadata(fx.metadata(spark, folder), fx.queue(spark, folder), events)


@query("""
SELECT 'B' || CAST(p_partkey % 10 AS VARCHAR) || '.P' || CAST(p_partkey AS VARCHAR) AS source_table,
       p_size AS priority, CAST(p_size * 60 AS INTEGER) AS max_staleness
FROM part
""")
def priority_map(spark: SparkSession, folder: str) -> DataFrame:
    """One JSON document per part; the reader takes both of its lists apart."""
    key = F.col("p_partkey")
    name = F.concat(F.lit("B"), (key % 10).cast("string"), F.lit(".P"), key.cast("string"))
    attrs = F.struct(
        F.col("p_size").cast("string").alias("priority"),
        (F.col("p_size") * 60).cast("string").alias("max_staleness"),
    )
    document = F.to_json(F.struct(F.array(F.create_map(name, attrs)).alias("tables")))
    path = fresh_folder(spark, "priority-map")
    fx.table(spark, folder, "part").select(document.alias("value")).write.text(path)
    return control.read_priority_map(spark, path, multi_line=False)


# -- joins of events and metadata

QUEUE_ROW = """source_table, 'lake.' || target_table AS target_table, event_time,
       CAST(NULL AS TIMESTAMP) AS trigger_time, strategy, TRUE AS lock_rows, 'Q' AS status, {priority} AS priority,
       CAST(NULL AS TIMESTAMP) AS event_time_latest"""


@query(f"""
WITH {fx.TRACKER}, {fx.RECENT}, {fx.METADATA}
SELECT {QUEUE_ROW.format(priority='priority')} FROM recent JOIN metadata USING (source_table)
""")
def enqueue_rows(spark: SparkSession, folder: str) -> DataFrame:
    return enrich.enqueue_rows(fx.recent(spark, folder), fx.metadata(spark, folder), fx.CATALOG)


@query(f"""
WITH {fx.TRACKER}, {fx.RECENT}, {fx.METADATA}
SELECT source_table, event_time, event_id FROM recent
WHERE source_table NOT IN (SELECT source_table FROM metadata)
""")
def unmatched_events(spark: SparkSession, folder: str) -> DataFrame:
    return enrich.unmatched(fx.recent(spark, folder), fx.metadata(spark, folder))


@query(f"""
WITH {fx.TRACKER}, {fx.QUEUE_SQL}
SELECT source_table FROM queue UNION SELECT source_table FROM tracker
""")
def table_name_union(spark: SparkSession, folder: str) -> DataFrame:
    return enrich.table_names(fx.queue(spark, folder), fx.tracker(spark, folder))


@query(f"""
WITH {fx.METADATA}
SELECT source_table, 'lake' AS target_catalog, split_part(target_table, '.', 1) AS target_schema,
       split_part(target_table, '.', 2) AS target_name, split_part(source_table, '.', 1) AS source_schema,
       split_part(source_table, '.', 2) AS source_name, 'lake.' || target_table AS target_table
FROM metadata
""")
def name_map(spark: SparkSession, folder: str) -> DataFrame:
    return enrich.name_map(fx.metadata_rows(spark, folder), fx.CATALOG)


@query(f"""
WITH {fx.METADATA}, objects AS (
    SELECT DISTINCT upper(event_type) AS "schema", 'T' || CAST(user_id % 10 AS VARCHAR) AS "table",
           CASE user_id % 4 WHEN 0 THEN 'TABLE' WHEN 1 THEN 'VIEW' WHEN 2 THEN 'QUERY' ELSE 'MACRO' END AS object_type
    FROM events)
SELECT "schema", "table", object_type FROM objects
WHERE object_type <> 'MACRO' AND "schema" || '.' || "table" IN (SELECT source_table FROM metadata)
""")
def allow_list(spark: SparkSession, folder: str) -> DataFrame:
    kind = F.col("user_id") % 4
    objects = (
        fx.table(spark, folder, "events")
        .select(
            F.upper("event_type").alias("schema"),
            F.concat(F.lit("T"), (F.col("user_id") % 10).cast("string")).alias("table"),
            F.when(kind == 0, F.lit("TABLE")).when(kind == 1, F.lit("VIEW"))
            .when(kind == 2, F.lit("QUERY")).otherwise(F.lit("MACRO")).alias("object_type"),
        )
        .distinct()
    )
    parts = names.name_parts(F.col("source_table"))
    allow = fx.metadata_rows(spark, folder).select(
        F.get(parts, F.lit(0)).alias("schema"), F.get(parts, F.lit(1)).alias("table")
    )
    return catalogue.allowed(objects, allow)


# -- priority


@query(f"""
WITH {fx.LADDER}
SELECT event_id, CAST({fx.ladder_sql('staleness', 'min_staleness', 'max_staleness')} AS INTEGER) AS priority
FROM ladder
""")
def priority_score(spark: SparkSession, folder: str) -> DataFrame:
    stale = staleness(F.col("ts"), fx.LADDER_ASOF)
    number = F.col("event_id")
    low = F.when(number % 13 == 0, stale + 1).otherwise(F.lit(0))
    return fx.table(spark, folder, "events").select(
        "event_id", ladder(stale, low, stale + number % 91 - 15).alias("priority")
    )


@query(f"""
WITH {fx.TRACKER}, {fx.RECENT}, {fx.METADATA}, seen AS (
    SELECT 0 AS seq_origin, source_table, min(event_time) AS event_time, min(event_id) AS seq_id
    FROM tracker WHERE event_time <= TIMESTAMP '{fx.WATERMARK}' GROUP BY source_table
    UNION ALL SELECT 1, source_table, event_time, event_id FROM recent)
SELECT {QUEUE_ROW.format(priority=fx.score_sql('event_time'))}, seq_origin, seq_id
FROM seen JOIN metadata USING (source_table)
""")
def reprioritise(spark: SparkSession, folder: str) -> DataFrame:
    """Waiting rows first, then new ones: the order they are put into the queue in."""
    attrs = fx.metadata(spark, folder)
    before = fx.tracker(spark, folder).filter(F.col("event_time") <= times.wall(fx.WATERMARK))
    first = before.groupBy("source_table").agg(
        F.min("event_time").alias("event_time"), F.min("event_id").alias("event_id")
    )
    seq = [F.lit(0).alias("seq_origin"), F.col("event_id").alias("seq_id")]
    waiting = enrich.enqueue_rows(first.select("*", *seq), attrs, fx.CATALOG, "seq_origin", "seq_id")
    seq[0] = F.lit(1).alias("seq_origin")
    new = enrich.enqueue_rows(
        fx.recent(spark, folder).select("*", *seq), attrs, fx.CATALOG, "seq_origin", "seq_id"
    )
    return enrich.reprioritise(waiting.unionByName(new), attrs, fx.ASOF)


# -- checks of text fields

ODD_NAME = """CASE o_orderkey % 7 WHEN 0 THEN 'X.Y.Z' WHEN 1 THEN 'NODOT' WHEN 2 THEN ''
    WHEN 3 THEN 'lake.s.o' || CAST(o_orderkey AS VARCHAR) ELSE 'SALES.O' || CAST(o_orderkey AS VARCHAR) END"""


@query(f"""
WITH named AS (SELECT o_orderkey, {ODD_NAME} AS name FROM orders)
SELECT o_orderkey, name = '' OR len(string_split(name, '.')) = 2 AS source_ok,
       len(string_split(name, '.')) = 3 AS target_ok, upper(name) AS upper_name
FROM named
""")
def validate_names(spark: SparkSession, folder: str) -> DataFrame:
    rest, key = F.col("o_orderkey") % 7, F.col("o_orderkey").cast("string")
    name = (
        F.when(rest == 0, F.lit("X.Y.Z")).when(rest == 1, F.lit("NODOT")).when(rest == 2, F.lit(""))
        .when(rest == 3, F.concat(F.lit("lake.s.o"), key)).otherwise(F.concat(F.lit("SALES.O"), key))
    )
    named = fx.table(spark, folder, "orders").select("o_orderkey", name.alias("name"))
    return named.select(
        "o_orderkey",
        names.is_source_name(F.col("name")).alias("source_ok"),
        names.is_target_name(F.col("name")).alias("target_ok"),
        F.upper("name").alias("upper_name"),
    )


@query("""
WITH given AS (
    SELECT o_orderkey, CASE o_orderkey % 4 WHEN 0 THEN 'TPT' WHEN 1 THEN 'WriteNOS' WHEN 2 THEN 'tpt' END AS strategy
    FROM orders)
SELECT o_orderkey, coalesce(strategy IN ('TPT', 'WriteNOS'), FALSE) AS ok,
       CASE strategy WHEN 'TPT' THEN 'TPT' WHEN 'WriteNOS' THEN 'TERADATA_WRITE_NOS' END AS method
FROM given
""")
def validate_strategy(spark: SparkSession, folder: str) -> DataFrame:
    rest = F.col("o_orderkey") % 4
    strategy = F.when(rest == 0, F.lit("TPT")).when(rest == 1, F.lit("WriteNOS")).when(rest == 2, F.lit("tpt"))
    return fx.table(spark, folder, "orders").select(
        "o_orderkey", names.is_strategy(strategy).alias("ok"), names.extraction_method(strategy).alias("method")
    )


@query("""
WITH given AS (
    SELECT o_orderkey, CASE o_orderkey % 6 WHEN 0 THEN 'true' WHEN 1 THEN ' True ' WHEN 2 THEN 'FALSE'
                            WHEN 3 THEN 'yes' WHEN 4 THEN '' END AS given FROM orders)
SELECT o_orderkey, coalesce(lower(trim(given)) IN ('true', 'false'), FALSE) AS ok,
       coalesce(lower(trim(given)) = 'true', FALSE) AS is_true
FROM given
""")
def validate_bool(spark: SparkSession, folder: str) -> DataFrame:
    rest = F.col("o_orderkey") % 6
    text = (
        F.when(rest == 0, F.lit("true")).when(rest == 1, F.lit(" True ")).when(rest == 2, F.lit("FALSE"))
        .when(rest == 3, F.lit("yes")).when(rest == 4, F.lit(""))
    )
    return fx.table(spark, folder, "orders").select(
        "o_orderkey", names.is_bool(text).alias("ok"),
        F.coalesce(names.parse_bool(text), F.lit(False)).alias("is_true"),
    )


@query("""
WITH given AS (
    SELECT o_orderkey, CASE o_orderkey % 6 WHEN 0 THEN strftime(o_orderdate, '%Y-%m-%d %H:%M:%S')
        WHEN 1 THEN strftime(o_orderdate, '%Y-%-m-%-d') || ' 4:5:6' WHEN 2 THEN strftime(o_orderdate, '%Y-%m-%d')
        WHEN 3 THEN strftime(o_orderdate, '%Y') || '-02-30 00:00:00' WHEN 4 THEN 'soon' END AS given
    FROM orders)
SELECT o_orderkey, try_strptime(given, '%Y-%m-%d %H:%M:%S') IS NOT NULL AS ok,
       try_strptime(given, '%Y-%m-%d %H:%M:%S') AS parsed
FROM given
""")
def validate_ts(spark: SparkSession, folder: str) -> DataFrame:
    rest, day = F.col("o_orderkey") % 6, F.col("o_orderdate")
    text = (
        F.when(rest == 0, times.format_text(day))
        .when(rest == 1, F.format_string("%d-%d-%d 4:5:6", F.year(day), F.month(day), F.day(day)))
        .when(rest == 2, F.substring(times.format_text(day), 1, 10))
        .when(rest == 3, F.concat(F.year(day).cast("string"), F.lit("-02-30 00:00:00")))
        .when(rest == 4, F.lit("soon"))
    )
    return fx.table(spark, folder, "orders").select(
        "o_orderkey", times.is_valid_text(text).alias("ok"), times.parse_text(text).alias("parsed")
    )


# -- times and names


@query(f"WITH {fx.TRACKER} SELECT event_id, hour(event_time) >= 6 AND hour(event_time) < 18 AS held FROM tracker")
def avoid_window(spark: SparkSession, folder: str) -> DataFrame:
    events = fx.table(spark, folder, "events")
    return events.select("event_id", times.avoid_window(F.col("ts"), "6-18").alias("held"))


@query(f"WITH {fx.TRACKER} SELECT event_id, minute(event_time) > 2 AS may_claim FROM tracker")
def minute_gate(spark: SparkSession, folder: str) -> DataFrame:
    events = fx.table(spark, folder, "events")
    return events.select("event_id", times.past_top_of_hour(F.col("ts")).alias("may_claim"))


@query(f"""
WITH {fx.TRACKER}
SELECT event_id, CAST(epoch(event_time) AS BIGINT) + 7 * 3600 AS epoch_seconds FROM tracker
""")
def ts_to_epoch(spark: SparkSession, folder: str) -> DataFrame:
    """Through the text form, as event times are stored."""
    text = times.format_text(F.col("event_time"))
    return fx.tracker(spark, folder).select("event_id", text.alias("text")).select(
        "event_id", times.to_epoch(times.require_text(F.col("text"))).alias("epoch_seconds")
    )


@query("""
SELECT event_id, TIMESTAMP '1970-01-01' + to_seconds(1700000000 + event_id * 37 - 7 * 3600) AS event_time
FROM events
""")
def epoch_to_ts(spark: SparkSession, folder: str) -> DataFrame:
    epoch = 1700000000 + F.col("event_id") * 37
    return fx.table(spark, folder, "events").select("event_id", times.from_epoch(epoch).alias("event_time"))


@query(f"""
WITH {fx.TRACKER}, iso AS (
    SELECT event_id, strftime(event_time, '%Y-%m-%dT%H:%M:%S') || '.000Z' AS iso_time FROM tracker)
SELECT event_id, replace(replace(iso_time, 'T', ' '), '.000Z', '') AS plain_time FROM iso
""")
def iso_normalise(spark: SparkSession, folder: str) -> DataFrame:
    text = F.replace(times.format_text(F.col("event_time")), F.lit(" "), F.lit("T"))
    iso = F.concat(text, F.lit(".000Z"))
    return fx.tracker(spark, folder).select("event_id", times.iso_normalise(iso).alias("plain_time"))


@query(f"""
WITH {fx.TRACKER}
SELECT event_id, split_part(source_table, '.', 1) AS first_part, split_part(source_table, '.', 2) AS last_part,
       'lake.' || source_table AS full_name, source_table AS short_name, lower(source_table) AS lower_name,
       left(source_table, 8) AS short_id
FROM tracker
""")
def name_parts(spark: SparkSession, folder: str) -> DataFrame:
    named = fx.tracker(spark, folder).withColumn(
        "full_name", names.dotted(F.lit(fx.CATALOG), F.lit(""), F.lit(None).cast("string"), F.col("source_table"))
    )
    return named.select(
        "event_id",
        F.get(names.name_parts(F.col("source_table")), F.lit(0)).alias("first_part"),
        names.last_part(F.col("source_table")).alias("last_part"),
        "full_name",
        names.without_catalog(F.col("full_name")).alias("short_name"),
        F.lower("source_table").alias("lower_name"),
        names.short_id(F.col("source_table")).alias("short_id"),
    )


# -- passed-through SQL

PASSTHROUGH = """
SELECT n_name, o_orderstatus, count(*) AS orders, count(DISTINCT c_custkey) AS customers
FROM {orders} JOIN {customer} ON o_custkey = c_custkey JOIN {nation} ON c_nationkey = n_nationkey
GROUP BY n_name, o_orderstatus"""


@query(PASSTHROUGH.format(orders="orders", customer="customer", nation="nation"))
def sql_passthrough(spark: SparkSession, folder: str) -> DataFrame:
    views = {n: fx.table(spark, folder, n) for n in ("orders", "customer", "nation")}
    return catalogue.run_sql(spark, PASSTHROUGH, views)


@query(f"WITH {fx.TRACKER} , {fx.RECENT} SELECT source_table, event_time, event_id FROM recent")
def tracking_scan_zoned(spark: SparkSession, folder: str) -> DataFrame:
    """Events stored as instants are shown on the clock of the tracking zone, whatever the session zone is."""
    events = fx.table(spark, folder, "events")
    stored = events.withColumn("ts", F.timestamp_seconds(times.to_epoch(F.col("ts"))))
    return tracking.tracking_scan(stored, fx.source_table(), "ts", fx.WATERMARK, fx.ASOF, "event_id")
