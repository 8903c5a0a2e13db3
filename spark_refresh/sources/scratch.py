"""Working folders on the storage all executors share."""

from __future__ import annotations

import tempfile
import uuid
from functools import cache

from pyspark.sql import DataFrame, SparkSession

SETTING = "spark.checkpoint.dir"


@cache
def _folder_of_this_machine(application: str) -> str:
    return tempfile.mkdtemp(prefix="spark-refresh-")


def shared_folder(spark: SparkSession) -> str:
    """The folder the cluster names for such data.

    Without that setting the session must run on one machine (tests), and a folder of that
    machine serves; on a cluster the setting is required.
    """
    named = spark.conf.get(SETTING, None) or spark.sparkContext.getConf().get(SETTING)
    if named:
        return named.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError(f"set {SETTING} to a folder all executors share")
    return _folder_of_this_machine(spark.sparkContext.applicationId)


def fresh_folder(spark: SparkSession, label: str) -> str:
    return f"{shared_folder(spark)}/spark_refresh/{label}-{uuid.uuid4().hex}"


def written(df: DataFrame, label: str) -> DataFrame:
    """The frame as a table on shared storage.

    Cuts the lineage so that lost executors cost no recomputation, is computed once
    however often it is read, and has a size Spark knows when it picks a join.
    """
    folder = fresh_folder(df.sparkSession, label)
    df.write.parquet(folder)
    return df.sparkSession.read.schema(df.schema).parquet(folder)
