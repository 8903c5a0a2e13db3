"""Load logs in files, one file per load, read in blocks by many tasks.

Files without lines do not appear: join the runs with what is found here.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..functions.logs import (
    SYNTAX_ERROR, TAIL_LENGTH, is_error_line, load_message, load_status, row_count,
)
from ..functions.names import stripped
from .lines import place, read_lines


def read_log_tails(spark: SparkSession, path: str, count: int = TAIL_LENGTH) -> DataFrame:
    """``file`` and ``lines``, the last lines of each file without surrounding blanks.

    Each task keeps at most ``count`` lines of a file before the shuffle, however long
    the file is.
    """
    from_end = Window.partitionBy("file").orderBy(F.desc("block"), F.desc("row"))
    last = (
        read_lines(spark, path)
        .withColumn("back", F.row_number().over(from_end))
        .filter(F.col("back") <= count)
    )
    back_and_line = F.struct((-F.col("back")).alias("order"), stripped(F.col("line")).alias("line"))
    return (
        last.groupBy("file")
        .agg(F.sort_array(F.collect_list(back_and_line)).alias("tail"))
        .select("file", F.transform("tail", lambda t: t["line"]).alias("lines"))
    )


def read_first_errors(spark: SparkSession, path: str) -> DataFrame:
    """``file`` and ``error``, the error line to report of each file that has one.

    A syntax error comes before any other line, then the first in the file. Only error
    lines leave the scan, and each task keeps the best of a file.
    """
    errors = read_lines(spark, path).filter(is_error_line(F.col("line")))
    rank = F.struct(
        (~F.col("line").contains(SYNTAX_ERROR)).alias("other"), place().alias("place")
    )
    return errors.groupBy("file").agg(F.min_by(stripped(F.col("line")), rank).alias("error"))


def run_outcomes(runs: DataFrame, tails: DataFrame, errors: DataFrame) -> DataFrame:
    """``status``, ``num_records`` and ``error`` of runs, from their logs.

    ``runs`` has ``log_file``, ``error_file`` and ``exit_ok``. A failed run with an
    unreadable log counts as one without rows.
    """
    lines = tails.select(F.col("file").alias("log_file"), row_count(F.col("lines")).alias("counted"))
    found = errors.select(F.col("file").alias("error_file"), F.col("error").alias("found"))
    joined = runs.join(lines, "log_file", "left").join(found, "error_file", "left")
    facts = F.col("found"), F.coalesce("counted", F.lit(0)), F.col("exit_ok")
    return joined.select(
        *runs.columns,
        load_status(*facts).alias("status"),
        F.coalesce("counted", F.lit(0)).cast("bigint").alias("num_records"),
        load_message(*facts).alias("error"),
    )
