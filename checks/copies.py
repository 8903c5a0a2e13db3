"""Queries over table copies, run logs and reports."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from spark_refresh.functions import casts, logs, values
from spark_refresh.functions.times import ZONE, format_text, to_epoch, wall
from spark_refresh.operators import batch as batch_queue
from spark_refresh.plans import batch, report, transfer
from spark_refresh.schemas import HISTORY, INT, LONG, REAL, TEXT, struct
from spark_refresh.sources import catalogue, control, jdbc
from spark_refresh.sources import logs as log_reader
from spark_refresh.sources.scratch import fresh_folder, written
from spark_refresh.sources.versions import Versions

from . import fixtures as fx
from .registry import query

# -- what a copy works on

MONEY, QUANTITY, RATE = T.DecimalType(15, 2), T.DecimalType(12, 2), T.DecimalType(4, 2)

LINE_TARGET = struct(
    l_orderkey=LONG, l_partkey=LONG, l_suppkey=LONG, l_linenumber=INT, l_quantity=QUANTITY,
    l_extendedprice=MONEY, l_discount=RATE, l_tax=REAL, l_returnflag=TEXT, l_linestatus=TEXT,
    l_shipdate=T.DateType(),
)
LINE_LENGTHS = {"l_returnflag": 1, "l_linestatus": 1}
LINE_NUMBERS = {"l_quantity": (12, 2), "l_extendedprice": (-1, -1), "l_discount": (4, 2), "l_tax": (-1, -1)}

ORDER_TARGET = struct(
    o_orderkey=LONG, o_custkey=LONG, o_orderstatus=TEXT, o_totalprice=MONEY,
    o_orderdate=T.DateType(), o_orderpriority=TEXT,
)
ORDER_LENGTHS = {"o_orderstatus": 1, "o_orderpriority": 15}


def line_catalogue(lines: DataFrame) -> list[dict]:
    return catalogue.source_columns(lines.schema, LINE_LENGTHS, LINE_NUMBERS)


def order_catalogue(orders: DataFrame) -> list[dict]:
    return catalogue.source_columns(orders.schema, ORDER_LENGTHS, {"o_totalprice": (15, 2)})


def staged_lines(spark: SparkSession, folder: str) -> transfer.Stage:
    lines = fx.table(spark, folder, "lineitem")
    columns = casts.source_projection(line_catalogue(lines), LINE_TARGET, lines.schema)
    return transfer.export(lines, columns, fresh_folder(spark, "stage"))


def as_plain(df: DataFrame) -> DataFrame:
    """Decimals as doubles and dates as text, to be compared outside Spark."""
    plain = {}
    for f in df.schema.fields:
        if isinstance(f.dataType, T.DecimalType):
            plain[f.name] = F.col(f.name).cast("double")
        elif isinstance(f.dataType, T.DateType):
            plain[f.name] = F.col(f.name).cast("string")
    return df.withColumns(plain) if plain else df


# -- projections

STAGED_LINES = """
SELECT l_orderkey, l_partkey, l_suppkey, l_linenumber,
       CAST(CAST(l_quantity AS DECIMAL(12,2)) AS DOUBLE) AS l_quantity,
       CAST(CAST(l_extendedprice AS DECIMAL(15,2)) AS DOUBLE) AS l_extendedprice,
       CAST(CAST(l_discount AS DECIMAL(4,2)) AS DOUBLE) AS l_discount, l_tax,
       substring(l_returnflag, 1, 1) AS l_returnflag, substring(l_linestatus, 1, 1) AS l_linestatus,
       strftime(l_shipdate, '%Y-%m-%d %H:%M:%S.%f') AS l_shipdate
FROM lineitem"""


@query(STAGED_LINES)
def source_projection(spark: SparkSession, folder: str) -> DataFrame:
    lines = fx.table(spark, folder, "lineitem")
    columns = casts.source_projection(line_catalogue(lines), LINE_TARGET, lines.schema)
    return as_plain(lines.select(*columns))


@query("""
SELECT event_id, strftime(ts, '%Y-%m-%d %H:%M:%S.%f') AS full_text,
       strftime(ts, '%Y-%m-%d %H:%M:%S') AS seconds_text, strftime(ts, '%Y-%m-%d %H:%M') AS minutes_text
FROM events
""")
def proj_timestamp(spark: SparkSession, folder: str) -> DataFrame:
    ts, kind = F.col("ts"), T.TimestampNTZType()
    return fx.table(spark, folder, "events").select(
        "event_id",
        casts.time_text(ts, 26, kind).alias("full_text"),
        casts.time_text(ts, 19, kind).alias("seconds_text"),
        casts.time_text(ts, 16, kind).alias("minutes_text"),
    )


@query("SELECT o_orderkey, strftime(o_orderdate, '%Y-%m-%d') AS order_date FROM orders")
def proj_date(spark: SparkSession, folder: str) -> DataFrame:
    return fx.table(spark, folder, "orders").select(
        "o_orderkey", casts.date_text(F.col("o_orderdate")).alias("order_date")
    )


@query("SELECT p_partkey, substring(p_name, 1, 10) AS p_name, substring(p_type, 1, 5) AS p_type FROM part")
def proj_char(spark: SparkSession, folder: str) -> DataFrame:
    parts = fx.table(spark, folder, "part").select("p_partkey", "p_name", "p_type")
    entries = catalogue.source_columns(parts.schema, {"p_name": 10, "p_type": 5})
    return parts.select(*casts.source_projection(entries))


@query("""
SELECT l_orderkey, l_linenumber, CAST(CAST(l_extendedprice AS DECIMAL(15,2)) AS DOUBLE) AS l_extendedprice,
       CAST(CAST(l_quantity AS DECIMAL(12,0)) AS DOUBLE) AS l_quantity
FROM lineitem
""")
def proj_decimal(spark: SparkSession, folder: str) -> DataFrame:
    lines = fx.table(spark, folder, "lineitem").select(
        "l_orderkey", "l_linenumber", "l_extendedprice", "l_quantity"
    )
    entries = catalogue.source_columns(
        lines.schema, numbers={"l_extendedprice": (15, 2), "l_quantity": (12, 0)}
    )
    return as_plain(lines.select(*casts.source_projection(entries)))


@query("""
SELECT l_orderkey, l_linenumber, CAST(l_quantity AS INTEGER) AS l_quantity,
       CAST(CAST(l_extendedprice AS DECIMAL(15,2)) AS DOUBLE) AS l_extendedprice,
       l_discount, substring(CAST(l_tax AS VARCHAR), 1, 3) AS l_tax
FROM lineitem
""")
def proj_number_by_target(spark: SparkSession, folder: str) -> DataFrame:
    """Numbers without digits take the types of the target."""
    columns = ("l_quantity", "l_extendedprice", "l_discount", "l_tax")
    lines = fx.table(spark, folder, "lineitem").select("l_orderkey", "l_linenumber", *columns)
    entries = catalogue.source_columns(lines.schema, numbers=dict.fromkeys(columns, (-1, -1)))
    target = zip(columns, ("int", "decimal(15,2)", "double", "varchar(3)"))
    return as_plain(lines.select(*casts.source_projection(entries, target)))


# -- source side

SPLITS = 8


def range_split_sql() -> str:
    cases = " ".join(
        f"WHEN o_orderkey < lo + (hi - lo) * {i} // {SPLITS} THEN {i - 1}" for i in range(1, SPLITS)
    )
    return f"""
WITH bounds AS (SELECT min(o_orderkey) AS lo, max(o_orderkey) AS hi FROM orders),
split AS (SELECT o_orderkey, CASE {cases} ELSE {SPLITS - 1} END AS split_id FROM orders, bounds)
SELECT split_id, count(*) AS n, min(o_orderkey) AS min_key, max(o_orderkey) AS max_key FROM split GROUP BY split_id"""


def split_summary(orders: DataFrame, predicates: list[str]) -> DataFrame:
    return orders.groupBy(jdbc.split_id(predicates).alias("split_id")).agg(
        F.count(F.lit(1)).alias("n"), F.min("o_orderkey").alias("min_key"), F.max("o_orderkey").alias("max_key")
    )


@query(range_split_sql())
def split_range(spark: SparkSession, folder: str) -> DataFrame:
    orders = fx.table(spark, folder, "orders")
    low, high = orders.agg(F.min("o_orderkey"), F.max("o_orderkey")).first()
    return split_summary(orders, jdbc.range_predicates("o_orderkey", low, high, SPLITS))


@query("""
SELECT CAST(o_orderkey % 4 AS INTEGER) AS split_id, count(*) AS n, min(o_orderkey) AS min_key, max(o_orderkey) AS max_key
FROM orders GROUP BY ALL
""")
def split_modulo(spark: SparkSession, folder: str) -> DataFrame:
    orders = fx.table(spark, folder, "orders")
    return split_summary(orders, jdbc.modulo_predicates("o_orderkey", jdbc.MAX_CONNECTIONS))


@query("""
SELECT name, n, n AS met_once, TRUE AS even FROM (
    SELECT 'plain' AS name, count(*) AS n FROM lineitem UNION ALL SELECT 'hot', count(*) FROM lineitem)
""")
def split_quantile(spark: SparkSession, folder: str) -> DataFrame:
    """Splits of equal numbers of rows: of a key, and of one that is a single value in a
    third of the rows and missing in some. The largest has at most 1.2 times the mean."""
    lines = fx.table(spark, folder, "lineitem")
    key = F.col("l_orderkey")
    skewed = F.when(key % 11 != 0, F.when(key % 3 == 0, F.lit(7)).otherwise(key))
    frames = []
    for name, rows in (("plain", lines), ("hot", lines.withColumn("l_orderkey", skewed))):
        conditions = jdbc.quantile_predicates(rows, "l_orderkey", SPLITS, second="l_partkey")
        met = reduce(lambda a, b: a + b, (F.coalesce(F.expr(p), F.lit(False)).cast("int") for p in conditions))
        sizes = rows.groupBy(jdbc.split_id(conditions).alias("split")).agg(F.count(F.lit(1)).alias("n"), F.count_if(met == 1).alias("once"))
        frames.append(sizes.agg(
            F.lit(name).alias("name"), F.sum("n").alias("n"), F.sum("once").alias("met_once"),
            (F.max("n") <= 1.2 * F.sum("n") / SPLITS).alias("even"),
        ))
    return frames[0].unionByName(frames[1])


@query("SELECT count(*) AS row_count FROM lineitem")
def source_row_count(spark: SparkSession, folder: str) -> DataFrame:
    return catalogue.source_row_count(fx.table(spark, folder, "lineitem"))


# Per column: name, type code, length, format, digits in all and after the point.
COLUMN_ROWS = {
    "lineitem": "l_orderkey I8 0 - 0 0, l_partkey I8 0 - 0 0, l_suppkey I8 0 - 0 0, l_linenumber I 0 - 0 0, l_quantity N 0 - 12 2, "
                "l_extendedprice N 0 - -1 -1, l_discount N 0 - 4 2, l_tax N 0 - -1 -1, l_returnflag CF 1 X(1) 0 0, "
                "l_linestatus CF 1 X(1) 0 0, l_shipdate TS 26 - 0 0",
    "orders": "o_orderkey I8 0 - 0 0, o_custkey I8 0 - 0 0, o_orderstatus CF 1 X(1) 0 0, o_totalprice N 0 - 15 2, o_orderdate TS 26 - 0 0, "
              "o_orderpriority CF 15 X(15) 0 0",
}
COLUMN_FIELDS = {
    "column_name": "ColumnName", "column_type": "ColumnType", "column_length": "ColumnLength", "column_format": "ColumnFormat",
    "total_digits": "DecimalTotalDigits", "fraction_digits": "DecimalFractionalDigits",
}


def column_rows_sql() -> str:
    rows = []
    for table, columns in COLUMN_ROWS.items():
        for name, code, length, shape, total, fraction in (c.split() for c in columns.split(", ")):
            rows.append(f"('{table}', '{name}', '{code}', {length}, '{shape.replace('-', '')}', {total}, {fraction})")
    return f"""
SELECT *, CASE table_name WHEN 'orders' THEN (SELECT count(*) FROM orders) ELSE (SELECT count(*) FROM lineitem) END AS row_count
FROM (VALUES {', '.join(rows)}) AS v(table_name, {', '.join(COLUMN_FIELDS)})"""


@query(column_rows_sql())
def source_columns(spark: SparkSession, folder: str) -> DataFrame:
    """Catalogue rows of two tables with the number of rows of each."""
    frames = []
    for name, entries in (("lineitem", line_catalogue), ("orders", order_catalogue)):
        df = fx.table(spark, folder, name)
        rows = F.array(*(F.struct(*(F.lit(e[field]).alias(n) for n, field in COLUMN_FIELDS.items())) for e in entries(df)))
        frames.append(
            catalogue.source_row_count(df)
            .select(F.lit(name).alias("table_name"), "row_count", F.inline(rows))
        )
    return frames[0].unionByName(frames[1])


@query("""
SELECT 'o_orderkey' AS col_name, 'bigint' AS data_type, count(o_orderkey) AS filled FROM orders
UNION ALL SELECT 'o_totalprice', 'double', count(o_totalprice) FROM orders
UNION ALL SELECT 'o_orderdate', 'timestamp_ntz', count(o_orderdate) FROM orders
UNION ALL SELECT 'o_orderstatus', 'string', count(o_orderstatus) FROM orders
""")
def target_schema(spark: SparkSession, folder: str) -> DataFrame:
    """Description of a partitioned target, cut where its sections start, and how many
    values each of its columns holds."""
    path = fresh_folder(spark, "target")
    name = "target_" + path.rsplit("-", 1)[1]
    (
        fx.table(spark, folder, "orders")
        .select("o_orderkey", "o_totalprice", "o_orderdate", F.lit(1).alias(catalogue.VERSION_COLUMN), "o_orderstatus")
        .write.partitionBy("o_orderstatus").parquet(path)
    )
    spark.sql(
        f"CREATE TABLE {name} (o_orderkey BIGINT, o_totalprice DOUBLE, o_orderdate TIMESTAMP_NTZ, "
        f"{catalogue.VERSION_COLUMN} INT, o_orderstatus STRING) USING parquet "
        f"PARTITIONED BY (o_orderstatus) LOCATION '{path}'"
    )
    columns = catalogue.target_schema(spark, name)
    spark.sql(f"DROP TABLE {name}")
    rows = spark.read.parquet(path)
    counts = rows.agg(*(F.count(c).alias(c) for c, _ in columns))
    described = F.array(*(
        F.struct(F.lit(c).alias("col_name"), F.lit(t).alias("data_type"), F.col(c).alias("filled"))
        for c, t in columns
    ))
    return counts.select(F.inline(described))


@query("""
SELECT 'SALES.P' || CAST(p_partkey AS VARCHAR) AS source,
       'lake.' || CASE WHEN p_partkey % 3 = 0 THEN 'SALES.P' ELSE 'LAKE.P' END || CAST(p_partkey AS VARCHAR) AS target,
       CASE WHEN p_partkey % 4 = 0 THEN 'WriteNOS' ELSE 'TPT' END AS strategy,
       CASE p_partkey % 3 WHEN 0 THEN TRUE WHEN 1 THEN FALSE ELSE TRUE END AS lock_rows
FROM part
""")
def manifest_scan(spark: SparkSession, folder: str) -> DataFrame:
    key, text = F.col("p_partkey"), F.col("p_partkey").cast("string")
    line = F.concat_ws(
        ",",
        F.concat(F.lit("  SALES.P"), text),
        F.when(key % 3 == 0, F.lit("")).otherwise(F.concat(F.lit("LAKE.P"), text)),
        F.when(key % 4 == 0, F.lit("WriteNOS")).otherwise(F.lit("TPT")),
        F.when(key % 3 == 1, F.lit(" False ")).when(key % 3 == 2, F.lit("TRUE,not looked at")),
    )
    path = fresh_folder(spark, "manifest-file")
    fx.table(spark, folder, "part").select(line.alias("line")).write.text(path)
    return control.read_manifest(spark, path, fx.CATALOG).drop("line_no")


# -- staging and loading


@query("""
SELECT l_returnflag, count(*) AS n, CAST(sum(CAST(l_quantity AS DECIMAL(12,2))) AS DOUBLE) AS sum_quantity,
       CAST(sum(CAST(l_extendedprice AS DECIMAL(15,2))) AS DOUBLE) AS sum_price,
       strftime(min(l_shipdate), '%Y-%m-%d') AS first_day
FROM lineitem GROUP BY l_returnflag
""")
def stage_roundtrip(spark: SparkSession, folder: str) -> DataFrame:
    rows = transfer.staged(spark, staged_lines(spark, folder).folder)
    return rows.groupBy("l_returnflag").agg(
        F.count(F.lit(1)).alias("n"),
        F.sum("l_quantity").cast("double").alias("sum_quantity"),
        F.sum("l_extendedprice").cast("double").alias("sum_price"),
        F.substring(F.min("l_shipdate"), 1, 10).alias("first_day"),
    )


@query("SELECT count(*) AS num_records, count(*) AS counted_while_writing FROM lineitem")
def stage_file_counts(spark: SparkSession, folder: str) -> DataFrame:
    stage = staged_lines(spark, folder)
    counts = transfer.stage_file_counts(transfer.staged(spark, stage.folder))
    return transfer.exported_rows(counts).withColumn(
        "counted_while_writing", F.lit(stage.rows).cast("bigint")
    )


SMALL_FILES = 256 * 1024


@query(f"""
SELECT 'documents' AS name, count(*) AS n, TRUE AS several, TRUE AS bounded FROM documents
UNION ALL SELECT 'lineitem', count(*), TRUE, TRUE FROM lineitem
""")
def stage_file_sizes(spark: SparkSession, folder: str) -> DataFrame:
    """Long texts and short rows staged in files of the same uncompressed size: no file of
    more than twice the aim, or the longest text, and as few as that allows."""
    frames = []
    for name, long_text in (("documents", "text"), ("lineitem", None)):
        rows = fx.table(spark, folder, name)
        width = transfer.row_width(rows)
        stage = transfer.export(rows, [F.col(c) for c in rows.columns], fresh_folder(spark, "stage"), file_bytes=SMALL_FILES)
        found = transfer.staged(spark, stage.folder)
        size = F.octet_length(long_text) if long_text else F.lit(width)
        files = found.groupBy(F.col("_metadata.file_path")).agg(F.count(F.lit(1)).alias("n"), F.sum(size).alias("bytes"), F.max(size).alias("most"))
        frames.append(files.agg(
            F.lit(name).alias("name"), F.sum("n").alias("n"), (F.count(F.lit(1)) > 1).alias("several"),
            (F.max("bytes") <= 2 * SMALL_FILES + 32 * F.max("most")).alias("bounded"),
        ))
    return frames[0].unionByName(frames[1])


@query("""
SELECT l_orderkey, l_partkey, l_suppkey, l_linenumber,
       CAST(CAST(l_quantity AS DECIMAL(12,2)) AS DOUBLE) AS l_quantity,
       CAST(CAST(l_extendedprice AS DECIMAL(15,2)) AS DOUBLE) AS l_extendedprice,
       CAST(CAST(l_discount AS DECIMAL(4,2)) AS DOUBLE) AS l_discount, l_tax,
       l_returnflag, l_linestatus, strftime(l_shipdate, '%Y-%m-%d') AS l_shipdate
FROM lineitem
""")
def typed_load(spark: SparkSession, folder: str) -> DataFrame:
    rows = transfer.typed(transfer.staged(spark, staged_lines(spark, folder).folder), LINE_TARGET)
    target = transfer.target_folder(spark, fresh_folder(spark, "target"), LINE_TARGET)
    target.replace(rows)
    return as_plain(target.read())


LOOSE_TARGET = struct(l_orderkey=LONG, l_linenumber=INT, l_quantity=QUANTITY, l_shipdate=T.DateType())


@query("""
WITH given AS (
    SELECT l_orderkey, l_linenumber, l_orderkey % 13 = 0 OR l_partkey % 17 = 0 AS bad, l_quantity FROM lineitem)
SELECT CASE WHEN bad THEN 'quarantined' ELSE 'applied' END AS outcome, count(*) AS n, CAST(sum(l_orderkey) AS BIGINT) AS key_sum,
       coalesce(CAST(sum(CAST(l_quantity AS DECIMAL(12,2))) FILTER (NOT bad) AS DOUBLE), 0) AS quantity
FROM given GROUP BY bad
""")
def quarantine_split(spark: SparkSession, folder: str) -> DataFrame:
    """Staged text of which some is not a number or not a date."""
    quantity = F.when(F.col("l_orderkey") % 13 == 0, F.lit("n/a")).otherwise(F.col("l_quantity").cast("string"))
    day = F.when(F.col("l_partkey") % 17 == 0, F.lit("unknown")).otherwise(casts.date_text(F.col("l_shipdate")))
    staged = fx.table(spark, folder, "lineitem").select(
        "l_orderkey", "l_linenumber", quantity.alias("l_quantity"), day.alias("l_shipdate")
    )
    path = fresh_folder(spark, "quarantine")
    transfer.load_with_quarantine(staged, LOOSE_TARGET, path)

    good = transfer.applied_rows(spark, path, LOOSE_TARGET).select(
        F.lit("applied").alias("outcome"), "l_orderkey", F.col("l_quantity").alias("quantity")
    )
    kept = F.get_json_object("raw_row", "$.l_orderkey").cast("bigint").alias("l_orderkey")
    bad = transfer.quarantined_rows(spark, path).select(
        F.lit("quarantined").alias("outcome"), kept, F.lit(0).cast("decimal(12,2)").alias("quantity")
    )
    return good.unionByName(bad).groupBy("outcome").agg(
        F.count(F.lit(1)).alias("n"), F.sum("l_orderkey").alias("key_sum"),
        F.sum("quantity").cast("double").alias("quantity"),
    )


@query("""
WITH given AS (SELECT l_orderkey, l_orderkey % 13 = 0 OR l_partkey % 17 = 0 AS bad FROM lineitem)
SELECT CASE WHEN bad THEN 'kept aside' ELSE 'loaded' END AS outcome, count(*) AS n, CAST(sum(l_orderkey) AS BIGINT) AS key_sum,
       (SELECT count(*) FROM lineitem) AS exported
FROM given GROUP BY bad
""")
def copy_with_misfits(spark: SparkSession, folder: str) -> DataFrame:
    """A copy that loads what fits its target and keeps aside what does not."""
    quantity = F.when(F.col("l_orderkey") % 13 == 0, F.lit("n/a")).otherwise(F.col("l_quantity").cast("string"))
    day = F.when(F.col("l_partkey") % 17 == 0, F.lit("unknown")).otherwise(casts.date_text(F.col("l_shipdate")))
    source = fx.table(spark, folder, "lineitem").select("l_orderkey", "l_linenumber", quantity.alias("l_quantity"), day.alias("l_shipdate"))
    base = fresh_folder(spark, "misfits")
    target = transfer.target_folder(spark, f"{base}/target", LOOSE_TARGET)
    rows = transfer.copy_table(source, target, f"{base}/stage", misfits=f"{base}/misfits")
    kept = transfer.kept_misfits(spark, f"{base}/misfits").select(
        F.lit("kept aside").alias("outcome"), F.get_json_object("raw_row", "$.l_orderkey").cast("bigint").alias("l_orderkey"))
    both = target.read().select(F.lit("loaded").alias("outcome"), "l_orderkey").unionByName(kept)
    return both.groupBy("outcome").agg(
        F.count(F.lit(1)).alias("n"), F.sum("l_orderkey").alias("key_sum"), F.lit(rows).cast("bigint").alias("exported"))


def order_target(spark: SparkSession) -> Versions:
    return transfer.target_folder(spark, fresh_folder(spark, "target"), ORDER_TARGET)


@query("""
SELECT o_orderstatus, count(*) AS n, CAST(sum(CAST(o_totalprice AS DECIMAL(15,2))) AS DOUBLE) AS total,
       strftime(max(o_orderdate), '%Y-%m-%d') AS last_day, (SELECT count(*) FROM orders) AS exported
FROM orders GROUP BY o_orderstatus
""")
def full_refresh(spark: SparkSession, folder: str) -> DataFrame:
    """A target that holds an older, smaller copy is replaced as a whole."""
    orders, target = fx.table(spark, folder, "orders"), order_target(spark)
    old = orders.filter(F.col("o_orderstatus") == "F")
    target.add(old.select(*casts.target_casts(ORDER_TARGET)))
    rows = transfer.copy_table(
        orders, target, fresh_folder(spark, "stage"), catalogue=order_catalogue(orders)
    )
    return target.read().groupBy("o_orderstatus").agg(
        F.count(F.lit(1)).alias("n"),
        F.sum("o_totalprice").cast("double").alias("total"),
        F.max("o_orderdate").cast("string").alias("last_day"),
        F.lit(rows).cast("bigint").alias("exported"),
    )


@query("""
SELECT l_linenumber, count(*) * CASE WHEN l_linenumber <= 2 THEN 2 ELSE 1 END AS n,
       CAST(sum(CAST(l_extendedprice AS DECIMAL(15,2))) * CASE WHEN l_linenumber <= 2 THEN 2 ELSE 1 END AS DOUBLE) AS total
FROM lineitem GROUP BY l_linenumber
""")
def filtered_append(spark: SparkSession, folder: str) -> DataFrame:
    """A full copy, then the rows of a condition appended on top of it."""
    lines = fx.table(spark, folder, "lineitem")
    target = transfer.target_folder(spark, fresh_folder(spark, "target"), LINE_TARGET)
    for where in (None, "l_linenumber <= 2"):
        transfer.copy_table(
            lines, target, fresh_folder(spark, "stage"), where, catalogue=line_catalogue(lines)
        )
    return target.read().groupBy("l_linenumber").agg(
        F.count(F.lit(1)).alias("n"), F.sum("l_extendedprice").cast("double").alias("total")
    )


@query("""
SELECT 'orders' AS name, count(*) AS exported, count(*) AS inserted, TRUE AS ok FROM orders
UNION ALL SELECT 'open orders', count(*), count(*), TRUE FROM orders WHERE o_orderstatus = 'O'
""")
def count_validation(spark: SparkSession, folder: str) -> DataFrame:
    """Rows exported and rows the target gained, for a refresh and for an append."""
    orders, target, frames, before = fx.table(spark, folder, "orders"), order_target(spark), [], 0
    for name, where in (("orders", None), ("open orders", "o_orderstatus = 'O'")):
        rows = transfer.copy_table(
            orders, target, fresh_folder(spark, "stage"), where, catalogue=order_catalogue(orders)
        )
        inserted = F.count(F.lit(1)) - before
        frames.append(target.read().agg(
            F.lit(name).alias("name"), F.lit(rows).cast("bigint").alias("exported"),
            inserted.alias("inserted"), (inserted == rows).alias("ok"),
        ).transform(written, "counts"))
        before += rows
    return frames[0].unionByName(frames[1])


RELOADED = (
    "region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events", "documents",
    "embeddings", "pages", "benchmark", "labels", "conversations",
)


def batch_sql() -> str:
    rows = [
        f"SELECT 'SALES.{n.upper()}' AS \"table\", '{'WriteNOS' if i % 4 == 0 else 'TPT'}' AS strategy, "
        f"'SUCCESS' AS status, count(*) AS num_records FROM {n}"
        for i, n in enumerate(RELOADED)
    ]
    body = "\nUNION ALL ".join([*rows, "SELECT 'SALES.MISSING', 'TPT', 'FAILED', 0"])
    return f"SELECT *, {len(rows) + 1} AS picked_up, 0 AS queued, {len(rows) + 1} AS total FROM ({body})"


@query(batch_sql())
def batch_reload(spark: SparkSession, folder: str) -> DataFrame:
    """Copies a batch of the given tables, one of which does not exist."""
    lines = [
        (f"SALES.{n.upper()}", f"lake.SALES.{n.upper()}", "WriteNOS" if i % 4 == 0 else "TPT", True, i)
        for i, n in enumerate((*RELOADED, "missing"))
    ]
    lines[-1] = (*lines[-1][:2], "TPT", *lines[-1][3:])
    manifest = spark.createDataFrame(lines, "source string, target string, strategy string, lock_rows boolean, line_no long")
    base = fresh_folder(spark, "batch")

    def load(row) -> int:
        name = row["source_table"].split(".")[1].lower()
        source = fx.table(spark, folder, name)
        target = transfer.target_folder(spark, f"{base}/{row['target_table']}", source.schema)
        columns = [F.col(c) for c in source.columns]
        stage = transfer.export(source, columns, f"{base}/stage/{name}")
        rows = transfer.typed(transfer.staged(spark, stage.folder), source.schema)
        target.replace(rows, check=lambda inserted: transfer.check_counts(stage.rows, inserted))
        return stage.rows

    state = batch.BatchState(spark, f"{base}/queue")
    runs = batch.batch_reload(
        spark, batch_queue.enqueue(manifest), load, f"{base}/report", f"{base}/runs", state=state
    )
    picked, queued, total = state.progress(manifest)
    return runs.select(
        "table", "strategy", "status", "num_records", F.lit(picked).alias("picked_up"), F.lit(queued).alias("queued"), F.lit(total).alias("total"))


# -- history and reports

CUT = "1999-01-01 00:00:00"


@query(f"WITH {fx.HISTORY_SQL} SELECT * FROM history WHERE finish_time > TIMESTAMP '{CUT}'")
def history_since(spark: SparkSession, folder: str) -> DataFrame:
    return report.finished_since(fx.history(spark, folder), wall(CUT))


@query(f"WITH {fx.HISTORY_SQL} SELECT max(finish_time) AS max_finish_time FROM history")
def history_last_update(spark: SparkSession, folder: str) -> DataFrame:
    return report.last_update(fx.history(spark, folder))


@query(f"WITH {fx.HISTORY_SQL} SELECT * FROM history WHERE finish_time IS NOT NULL")
def history_append(spark: SparkSession, folder: str) -> DataFrame:
    """A first report up to a day, a second one for what has finished since, and a third
    one that finds nothing new."""
    rows = fx.history(spark, folder)
    target = transfer.target_folder(spark, fresh_folder(spark, "report"), HISTORY)
    report.append_history(rows.filter(F.col("finish_time") <= wall(CUT)), target)
    report.append_history(rows, target)
    report.append_history(rows, target)
    return target.read()


SHORT = "strftime({}, '%-m/%-d/%y %-I:%M %p')"


@query(f"""
WITH {fx.HISTORY_SQL}
SELECT source_table AS "TABLE", strategy AS "STRATEGY", status AS "STATUS",
       {SHORT.format('event_time')} AS "START", {SHORT.format('finish_time')} AS "END",
       printf('%.2f', round((epoch(finish_time) - epoch(event_time)) / 60, 2)) AS "DURATION_MINS",
       num_records AS "NUM_RECORDS", error AS "ERROR"
FROM history WHERE finish_time IS NOT NULL
""")
def run_report(spark: SparkSession, folder: str) -> DataFrame:
    runs = fx.history(spark, folder).filter(F.col("finish_time").isNotNull()).select(
        F.col("source_table").alias("table"), "strategy", "status",
        to_epoch(F.col("event_time"), ZONE).cast("double").alias("start"),
        to_epoch(F.col("finish_time"), ZONE).cast("double").alias("end"),
        "num_records", F.concat(F.lit(" "), "error", F.lit("\n")).alias("error"),
    )
    return report.run_report(runs)


@query(f"""
WITH {fx.HISTORY_SQL}
SELECT source_table AS "TABLE", strategy AS "STRATEGY", status AS "STATUS",
       {SHORT.format('event_time')} AS "START", {SHORT.format('finish_time')} AS "END",
       printf('%.2f', round((epoch(finish_time) - epoch(event_time)) / 60, 2)) AS "DURATION_MINS",
       num_records AS "NUM_RECORDS", CASE WHEN error = '' THEN '' ELSE error || ', "said" it; 2' END AS "ERROR"
FROM history WHERE finish_time IS NOT NULL
""")
def report_file(spark: SparkSession, folder: str) -> DataFrame:
    """The report as written to CSV files, in two goes, and read back."""
    runs = fx.history(spark, folder).filter(F.col("finish_time").isNotNull()).select(
        F.col("source_table").alias("table"), "strategy", "status",
        to_epoch(F.col("event_time"), ZONE).cast("double").alias("start"),
        to_epoch(F.col("finish_time"), ZONE).cast("double").alias("end"), "num_records",
        F.when(F.col("error") == "", F.lit("")).otherwise(F.concat("error", F.lit(', "said"\nit; 2\n'))).alias("error"),
    )
    path, early = fresh_folder(spark, "report-file"), F.col("start") < to_epoch(wall(CUT), ZONE)
    for part in (runs.where(early), runs.where(~early)):
        report.append_report(part, path)
    return report.read_report(spark, path)


VALUE_TEXT = """'(''' || source_table || ''', ''' || status || ''', ''' || strftime(event_time, '%Y-%m-%d %H:%M:%S')
    || ''', ''' || coalesce(strftime(finish_time, '%Y-%m-%d %H:%M:%S'), 'None') || ''', '''
    || coalesce(replace(error, '''', ''), 'None') || ''', ''' || coalesce(CAST(num_records AS VARCHAR), 'None') || ''')'"""


@query(f"""
WITH {fx.HISTORY_SQL}, rows AS (
    SELECT CAST(substring(source_table, 8) AS BIGINT) AS k, {VALUE_TEXT} AS txt FROM history)
SELECT statement, string_agg(txt, ', ' ORDER BY k) AS values_text
FROM (SELECT *, (row_number() OVER (ORDER BY k) - 1) // 500 AS statement FROM rows) GROUP BY statement
""")
def format_values(spark: SparkSession, folder: str) -> DataFrame:
    key = F.substring_index("source_table", "O", -1).cast("bigint")
    text = values.row_text(
        F.col("source_table"), F.col("status"), format_text(F.col("event_time")),
        format_text(F.col("finish_time")), F.col("error"), F.col("num_records").cast("string"),
    )
    rows = fx.history(spark, folder).select(key.alias("k"), text.alias("txt"))
    return values.statements(rows, "txt", "k", 500)


# -- logs

EXIT = logs.EXIT_TEXT

LOG_SQL = """
raw AS (
    SELECT doc_id, text || chr(10) || CASE doc_id % 5 WHEN 0 THEN 'ExtractorException, code 9' || chr(10) || '  Syntax error: entry ' || doc_id || chr(10)
                                         WHEN 1 THEN 'HiveSQLException: no table' || chr(10) WHEN 2 THEN 'Illegal Parquet type' || chr(10) ELSE '' END
        || CASE doc_id % 7 WHEN 0 THEN '' ELSE '`lake`.`t' || doc_id || '`    ' || (doc_id * 3) || '    ====   00:00:00    ' || chr(10) END
        || CASE doc_id % 4 WHEN 0 THEN 'replicant exited with error code: 1' || chr(10) || 'Resuming'
                           WHEN 3 THEN 'stopped' ELSE chr(10) || '  replicant exited with error code: 0' || chr(10) END AS log
    FROM documents),
lines AS (
    SELECT doc_id, string_split(CASE WHEN right(log, 1) = chr(10) THEN left(log, length(log) - 1) ELSE log END, chr(10)) AS all_lines
    FROM raw),
log_lines AS (
    SELECT doc_id, all_lines, [trim(x, chr(9) || chr(10) || chr(11) || chr(12) || chr(13) || ' ')
        FOR x IN (CASE WHEN len(all_lines) > 10 THEN all_lines[-10:] ELSE all_lines END)] AS tail
    FROM lines)"""


def document_logs(spark: SparkSession, folder: str) -> DataFrame:
    """The texts of documents, each followed by the last lines of a load log."""
    number = F.col("doc_id")
    text = number.cast("string")
    five, seven, four = number % 5, number % 7, number % 4
    errors = (
        F.when(five == 0, F.concat(F.lit("ExtractorException, code 9\n  Syntax error: entry "), text, F.lit("\n")))
        .when(five == 1, F.lit("HiveSQLException: no table\n")).when(five == 2, F.lit("Illegal Parquet type\n"))
        .otherwise(F.lit(""))
    )
    rows = F.when(seven == 0, F.lit("")).otherwise(
        F.concat(F.lit("`lake`.`t"), text, F.lit("`    "), (number * 3).cast("string"), F.lit("    ====   00:00:00    \n"))
    )
    end = (
        F.when(four == 0, F.lit(f"{EXIT}1\nResuming")).when(four == 3, F.lit("stopped"))
        .otherwise(F.lit(f"\n  {EXIT}0\n"))
    )
    log = F.concat("text", F.lit("\n"), errors, rows, end)
    return fx.table(spark, folder, "documents").select("doc_id", log.alias("log"))


@query(f"WITH {LOG_SQL} SELECT doc_id, array_to_string(tail, '|') AS tail FROM log_lines")
def log_tail(spark: SparkSession, folder: str) -> DataFrame:
    tail = logs.tail_lines(F.col("log"))
    return document_logs(spark, folder).select("doc_id", F.array_join(tail, "|").alias("tail"))


ROW_COUNT_SQL = f"""
CASE WHEN array_to_string(tail, '|') LIKE '%{EXIT}1%' OR array_to_string(tail, '|') LIKE '%{EXIT}2%' THEN 0
     WHEN len(hits) > 0 THEN CAST(regexp_extract(hits[len(hits)], '^[^ ]* +([0-9]+) +.*', 1) AS BIGINT)
     WHEN array_to_string(tail, '|') LIKE '%{EXIT}0%' THEN 0 ELSE -1 END"""


@query(f"""
WITH {LOG_SQL}, found AS (
    SELECT doc_id, tail, [x FOR x IN tail IF regexp_matches(x, '^[^ ]* +[0-9]+ +')] AS hits FROM log_lines)
SELECT doc_id, {ROW_COUNT_SQL} AS num_records FROM found
""")
def log_row_count(spark: SparkSession, folder: str) -> DataFrame:
    """Rows copied, or -1 for a log that cannot be read."""
    rows = F.coalesce(logs.row_count(F.col("tail")), F.lit(-1).cast("bigint"))
    tails = document_logs(spark, folder).select("doc_id", logs.tail_lines(F.col("log")).alias("tail"))
    return tails.select("doc_id", rows.alias("num_records"))


@query(f"""
WITH {LOG_SQL}, found AS (
    SELECT doc_id, [trim(x, chr(9) || chr(10) || chr(11) || chr(12) || chr(13) || ' ') FOR x IN all_lines
                    IF regexp_matches(x, '{'|'.join(logs.ERROR_PATTERNS)}')] AS hits FROM log_lines),
ordered AS (SELECT doc_id, hits, [x FOR x IN hits IF contains(x, 'Syntax error')] AS syntax FROM found)
SELECT doc_id, coalesce(syntax[1], hits[1], '') AS error, len(list_distinct(hits)) AS distinct_errors FROM ordered
""")
def log_errors(spark: SparkSession, folder: str) -> DataFrame:
    found = document_logs(spark, folder).select("doc_id", logs.error_lines(F.col("log")).alias("errors"))
    return found.select(
        "doc_id", logs.pick_error(F.col("errors")).alias("error"),
        F.size("errors").cast("bigint").alias("distinct_errors"),
    )


LOGS = 24


@query(f"""
WITH {LOG_SQL.replace('lines AS (', """joined AS (
    SELECT doc_id % 24 AS doc_id, string_agg(log, chr(10) ORDER BY raw.doc_id) || chr(10) AS log FROM raw GROUP BY doc_id % 24),
lines AS (""", 1).replace('FROM raw)', 'FROM joined)').replace('FROM raw GROUP BY', 'FROM raw GROUP BY')},
found AS (
    SELECT doc_id, tail, [x FOR x IN tail IF regexp_matches(x, '^[^ ]* +[0-9]+ +')] AS hits,
           [trim(x, chr(9) || chr(10) || chr(11) || chr(12) || chr(13) || ' ') FOR x IN all_lines
            IF regexp_matches(x, '{'|'.join(logs.ERROR_PATTERNS)}')] AS errors FROM log_lines),
counted AS (
    SELECT doc_id, tail, {ROW_COUNT_SQL} AS n, coalesce([x FOR x IN errors IF contains(x, 'Syntax error')][1], errors[1], '') AS found,
           doc_id % 2 = 0 AS exit_ok FROM found),
decided AS (
    SELECT *, CASE WHEN found <> '' AND (n > 0 OR contains(found, 'Syntax error')) THEN 'FAILED'
                   WHEN found <> '' OR exit_ok THEN 'SUCCESS' ELSE 'FAILED' END AS status FROM counted)
SELECT doc_id AS run, array_to_string(tail, '|') AS tail, greatest(n, 0) AS num_records, status,
       CASE WHEN status = 'SUCCESS' THEN '' WHEN found <> '' THEN found ELSE 'Unknown error' END AS error
FROM decided
""")
def log_files(spark: SparkSession, folder: str) -> DataFrame:
    """Logs in files of mixed length, one per run: their last lines, errors and outcomes."""
    path = fresh_folder(spark, "log-files")
    lines = document_logs(spark, folder).select((F.col("doc_id") % LOGS).alias("run"), "doc_id", "log")
    lines.repartition(LOGS, "run").sortWithinPartitions("run", "doc_id").select("run", "log").write.partitionBy("run").text(path)
    tails, errors = log_reader.read_log_tails(spark, path), log_reader.read_first_errors(spark, path)
    run = F.regexp_extract("file", r"run=([0-9]+)", 1).cast("bigint")
    runs = tails.select(run.alias("run"), F.col("file").alias("log_file"), F.col("file").alias("error_file"), (run % 2 == 0).alias("exit_ok"))
    found = log_reader.run_outcomes(runs, tails, errors)
    shown = tails.select(run.alias("run"), F.array_join("lines", "|").alias("tail"))
    return found.join(shown, "run").select("run", "tail", "num_records", "status", "error")


@query("""
WITH run AS (
    SELECT o_orderkey, CASE o_orderkey % 4 WHEN 0 THEN 'Extractor failed' WHEN 1 THEN 'Syntax error near ' || o_orderkey
                                         WHEN 2 THEN '' END AS error,
           o_orderkey % 3 AS rows, o_orderkey % 2 = 0 OR o_orderkey % 5 = 0 AS exit_ok FROM orders),
decided AS (
    SELECT *, CASE WHEN coalesce(error, '') <> '' AND (rows > 0 OR contains(error, 'Syntax error')) THEN 'FAILED'
                   WHEN coalesce(error, '') <> '' OR exit_ok THEN 'SUCCESS' ELSE 'FAILED' END AS status FROM run)
SELECT o_orderkey, status, CASE WHEN status = 'SUCCESS' THEN '' WHEN coalesce(error, '') <> '' THEN error
                                ELSE 'Unknown error' END AS message FROM decided
""")
def load_outcome(spark: SparkSession, folder: str) -> DataFrame:
    key = F.col("o_orderkey")
    error = (
        F.when(key % 4 == 0, F.lit("Extractor failed"))
        .when(key % 4 == 1, F.concat(F.lit("Syntax error near "), key.cast("string")))
        .when(key % 4 == 2, F.lit(""))
    )
    run = fx.table(spark, folder, "orders").select(
        "o_orderkey", error.alias("error"), (key % 3).alias("rows"),
        ((key % 2 == 0) | (key % 5 == 0)).alias("exit_ok"),
    )
    facts = (F.col("error"), F.col("rows"), F.col("exit_ok"))
    return run.select(
        "o_orderkey", logs.load_status(*facts).alias("status"), logs.load_message(*facts).alias("message")
    )


# -- copies that must lose nothing


@query("""
SELECT CAST(count(*) AS BIGINT) AS n, CAST(sum(length(text)) AS BIGINT) AS total, CAST(max(length(text)) AS BIGINT) AS longest,
       'SUCCESS' AS status
FROM documents
""")
def copy_long_text(spark: SparkSession, folder: str) -> DataFrame:
    """Text without a declared length is copied whole."""
    schema = struct(doc_id=LONG, text=TEXT)
    target = transfer.target_folder(spark, fresh_folder(spark, "target"), schema)
    run = transfer.reload_table(
        spark, "crawl.documents", "TPT", lambda: fx.table(spark, folder, "documents").select("doc_id", "text"), target
    )
    return target.read().agg(
        F.count(F.lit(1)).alias("n"),
        F.sum(F.length("text")).alias("total"),
        F.max(F.length("text")).cast("bigint").alias("longest"),
        F.lit(run["status"]).alias("status"),
    )


# Within the hour that the clocks of New York show twice in 2024, and around it.
TWICE = 1_730_606_400


@query(f"""
SELECT o_orderkey, CAST({TWICE} + o_orderkey % 14400 AS BIGINT) * 1000000 + o_custkey % 1000000 AS micros
FROM orders
""")
def copy_timestamps(spark: SparkSession, folder: str) -> DataFrame:
    """Instants come out of a copy as they went in, also where a clock shows them twice."""
    micros = (F.lit(TWICE) + F.col("o_orderkey") % 14_400).cast("bigint") * 1_000_000 + F.col("o_custkey") % 1_000_000
    orders = fx.table(spark, folder, "orders").select("o_orderkey", F.timestamp_micros(micros).alias("loaded"))
    target = transfer.target_folder(spark, fresh_folder(spark, "target"), struct(o_orderkey=LONG, loaded=T.TimestampType()))
    transfer.copy_table(orders, target, fresh_folder(spark, "stage"))
    return target.read().select("o_orderkey", F.unix_micros("loaded").alias("micros"))
