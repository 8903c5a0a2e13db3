"""Run reports and the history appended to a target table."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.names import stripped
from ..functions.times import ZONE, from_epoch, minutes_between, short_text
from ..schemas import TEXT, struct
from ..sources.versions import Versions

# Columns of the run report.
REPORT_COLUMNS = (
    "TABLE", "STRATEGY", "STATUS", "START", "END", "DURATION_MINS", "NUM_RECORDS", "ERROR",
)


def local_short(epoch: Column, zone: str = ZONE) -> Column:
    return short_text(from_epoch(F.floor(epoch), zone))


def run_report(runs: DataFrame, zone: str = ZONE) -> DataFrame:
    """Runs as report lines: local times, minutes with two decimals, trimmed error."""
    start, end = F.col("start"), F.col("end")
    return runs.select(
        F.col("table").alias("TABLE"),
        F.col("strategy").alias("STRATEGY"),
        F.col("status").alias("STATUS"),
        local_short(start, zone).alias("START"),
        local_short(end, zone).alias("END"),
        minutes_between(start, end).cast("decimal(18,2)").cast("string").alias("DURATION_MINS"),
        F.col("num_records").alias("NUM_RECORDS"),
        stripped(F.col("error")).alias("ERROR"),
    )


def append_report(runs: DataFrame, folder: str, zone: str = ZONE) -> None:
    """Add report lines to a CSV folder; each file starts with the header.

    Texts are quoted, and line ends and quotes within them escaped, so that a line of any
    error reads back as it was written (:func:`read_report`).
    """
    lines = run_report(runs, zone).withColumn("ERROR", F.translate("ERROR", "\r\n", "  "))
    lines.write.mode("append").options(**CSV).csv(folder)


# How reports are written and read: an empty text is not a missing one.
CSV = {"header": True, "escape": '"', "nullValue": "NULL", "emptyValue": "", "ignoreLeadingWhiteSpace": False,
       "ignoreTrailingWhiteSpace": False}


def read_report(spark: SparkSession, folder: str) -> DataFrame:
    """All report lines, as text but for the number of rows."""
    lines = spark.read.schema(struct(**dict.fromkeys(REPORT_COLUMNS, TEXT))).options(**CSV, enforceSchema=False).csv(folder)
    return lines.withColumns({
        "NUM_RECORDS": F.col("NUM_RECORDS").cast("bigint"), "ERROR": F.coalesce("ERROR", F.lit("")),
    })


def finished_since(history: DataFrame, since) -> DataFrame:
    """Finished rows after a time; all finished rows if there is none yet."""
    done = history.filter(F.col("finish_time").isNotNull())
    return done if since is None else done.filter(F.col("finish_time") > since)


def last_update(target: DataFrame) -> DataFrame:
    return target.agg(F.max("finish_time").alias("max_finish_time"))


def append_history(history: DataFrame, target: Versions) -> None:
    """Append what has finished since the last report. Types and NULLs stay as they are."""
    mark = last_update(target.read()).first()[0]
    since = None if mark is None else F.lit(mark.isoformat(sep=" ")).cast("timestamp_ntz")
    target.add(finished_since(history, since))
