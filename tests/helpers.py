"""Small frames for tests: rows given as dicts, the rest of a schema NULL."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from spark_refresh.schemas import HISTORY, QUEUE

DAY = datetime(2025, 1, 1)


def t(text: str) -> datetime:
    return datetime.fromisoformat(text)


def frame(spark: SparkSession, schema: T.StructType, rows: list[dict]) -> DataFrame:
    unknown = {k for r in rows for k in r} - set(schema.names)
    assert not unknown, unknown
    return spark.createDataFrame([tuple(r.get(n) for n in schema.names) for r in rows], schema)


def queue_row(name: str, status: str = "Q", priority: int = 1, strategy: str = "TPT", time: datetime = DAY, **more) -> dict:
    return {
        "source_table": name, "target_table": f"lake.{name}", "event_time": time, "strategy": strategy,
        "lock_rows": True, "status": status, "priority": priority, **more,
    }


def queue_frame(spark: SparkSession, *rows: dict) -> DataFrame:
    return frame(spark, QUEUE, list(rows))


def history_row(name: str, status: str = "RUNNING", time: datetime = DAY, **more) -> dict:
    return {
        "source_table": name, "target_table": f"lake.{name}", "status": status, "event_time": time,
        "strategy": "TPT", "lock_rows": True, "priority": 1, **more,
    }


def history_frame(spark: SparkSession, *rows: dict) -> DataFrame:
    return frame(spark, HISTORY, list(rows))


def by_key(df: DataFrame, key: str = "source_table") -> dict:
    return {r[key]: r for r in df.collect()}
