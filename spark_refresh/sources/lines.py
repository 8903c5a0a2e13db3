"""Text files as lines that know their place.

Large files are read in blocks by many tasks. The place of a line is its file, the block
and an id that grows within a block; it orders the lines of a file like the file does.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F


def read_lines(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.text(path).select(
        F.col("value").alias("line"),
        F.col("_metadata.file_path").alias("file"),
        F.col("_metadata.file_block_start").alias("block"),
        F.monotonically_increasing_id().alias("row"),
    )


def place() -> Column:
    """Comparable position of a line."""
    return F.struct("file", "block", "row")


def with_line_numbers(lines: DataFrame, number: str = "line_no") -> DataFrame:
    """Number the lines from 0 over all files, in file order.

    Lines are ranked within their block, which the read size bounds; only the line
    counts of the blocks are summed up in one place.
    """
    in_block = Window.partitionBy("file", "block").orderBy("row")
    before = Window.orderBy("file", "block").rowsBetween(Window.unboundedPreceding, -1)
    counts = lines.groupBy("file", "block").agg(F.count(F.lit(1)).alias("n"))
    starts = counts.select(
        "file", "block", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("start")
    )
    ranked = lines.withColumn("rank", F.row_number().over(in_block) - 1)
    return ranked.join(starts, ["file", "block"]).select(
        *(c for c in lines.columns), (F.col("start") + F.col("rank")).alias(number)
    )


def ranked_from_end(
    df: DataFrame, order: str, rank: str, width: int = 1_000_000
) -> DataFrame:
    """Rank rows by a unique whole number, 0 for the last one, without sorting them in
    one task.

    Rows are ranked within ranges of about ``width`` rows, however far apart their numbers
    are: the bounds are approximate quantiles. Only the row counts of the ranges are summed
    up in one place.
    """
    pieces = -(-df.count() // width)
    if pieces <= 1:  # no more than ``width`` rows
        last_first = Window.orderBy(F.desc(order))
        return df.withColumn(rank, (F.row_number().over(last_first) - 1).cast("bigint"))
    shares = [i / pieces for i in range(1, pieces)]
    bounds = df.agg(F.percentile_approx(order, shares, 100 * pieces)).first()[0]
    above = [F.col(order) > b for b in sorted(set(bounds))]
    piece = sum((a.cast("long") for a in above), F.lit(0).cast("long"))
    after = Window.orderBy(F.desc("piece")).rowsBetween(Window.unboundedPreceding, -1)
    starts = (
        df.groupBy(piece.alias("piece"))
        .agg(F.count(F.lit(1)).alias("n"))
        .select("piece", F.coalesce(F.sum("n").over(after), F.lit(0)).alias("start"))
    )
    within = Window.partitionBy("piece").orderBy(F.desc(order))
    ranked = df.withColumn("piece", piece).withColumn("within", F.row_number().over(within) - 1)
    return ranked.join(starts, "piece").select(
        *df.columns, (F.col("start") + F.col("within")).alias(rank)
    )
