"""Events joined with the metadata of their tables.

No join here is hinted. Spark broadcasts metadata when its size is below
``spark.sql.autoBroadcastJoinThreshold`` and shuffles by table name when it is not; in
that case adaptive execution splits a table that holds a large share of the events.
"""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.names import dotted, name_parts
from ..functions.priority import score
from ..schemas import QUEUED


def table_names(*frames: DataFrame) -> DataFrame:
    """Distinct table names over all frames, made distinct in each frame first."""
    names = [f.select("source_table").distinct() for f in frames]
    union = names[0]
    for other in names[1:]:
        union = union.unionByName(other)
    return union.distinct()


def wanted_metadata(metadata: DataFrame, *frames: DataFrame) -> DataFrame:
    """Metadata of the tables that occur in the frames."""
    return metadata.join(table_names(*frames), "source_table", "left_semi")


def unmatched(events: DataFrame, metadata: DataFrame) -> DataFrame:
    """Events of tables without metadata, which change capture takes care of."""
    return events.join(metadata.select("source_table"), "source_table", "left_anti")


def queue_columns(catalog: str, priority: Column | None = None) -> list[Column]:
    """Queue row of an event joined with its metadata."""
    return [
        F.col("source_table"),
        F.concat_ws(".", F.lit(catalog), F.col("target_table")).alias("target_table"),
        F.col("event_time"),
        F.lit(None).cast("timestamp_ntz").alias("trigger_time"),
        F.col("strategy"),
        F.lit(True).alias("lock_rows"),
        F.lit(QUEUED).alias("status"),
        (F.col("priority") if priority is None else priority).alias("priority"),
        F.lit(None).cast("timestamp_ntz").alias("event_time_latest"),
    ]


def enqueue_rows(events: DataFrame, metadata: DataFrame, catalog: str, *keep: str) -> DataFrame:
    """One queue row per event; events without metadata are left out."""
    return events.join(metadata, "source_table").select(*queue_columns(catalog), *keep)


def or_missing(value: Column, present: Column) -> Column:
    """The value; a queued table without metadata stops the job."""
    message = F.concat(F.lit("no metadata for queued table "), F.col("source_table"))
    return F.when(present, value).otherwise(F.raise_error(message).cast("int"))


def reprioritise(rows: DataFrame, metadata: DataFrame, asof: datetime | str) -> DataFrame:
    """Queue rows with the priority their age earns at ``asof``."""
    attrs = metadata.select(
        "source_table",
        F.struct("priority", "min_staleness", "max_staleness").alias("attrs"),
    )
    earned = score(
        F.col("event_time"), asof,
        F.col("attrs.priority"), F.col("attrs.min_staleness"), F.col("attrs.max_staleness"),
    )
    return rows.join(attrs, "source_table", "left").withColumn(
        "priority", or_missing(earned, F.col("attrs").isNotNull())
    ).drop("attrs")


def name_map(metadata: DataFrame, catalog: str) -> DataFrame:
    """Where each source table goes, in parts and as one name."""
    source, target = name_parts(F.col("source_table")), name_parts(F.col("target_table"))
    return metadata.select(
        F.col("source_table"),
        F.lit(catalog).alias("target_catalog"),
        F.get(target, F.lit(0)).alias("target_schema"),
        F.get(target, F.lit(1)).alias("target_name"),
        F.get(source, F.lit(0)).alias("source_schema"),
        F.get(source, F.lit(1)).alias("source_name"),
        dotted(F.lit(catalog), F.col("target_table")).alias("target_table"),
    )
