"""Rows as quoted value text."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..sources.lines import ranked_from_end


def row_text(*texts: Column) -> Column:
    """``('a', 'b', '3')``. Quotes inside a value are left out, NULL is the word None; a
    row without any text is ``()``."""
    plain = (
        F.replace(F.coalesce(t, F.lit("None")), F.lit("'"), F.lit("")) for t in texts
    )
    joined = F.concat_ws("', '", *plain) if texts else F.lit("")
    return F.when(joined == "", F.lit("()")).otherwise(
        F.concat(F.lit("('"), joined, F.lit("')"))
    )


def values_text(df: DataFrame, text: str, group: str, order: str) -> DataFrame:
    """One value list per group, in order.

    The whole list of a large table is never built: ``group`` must split the rows into
    pieces of bounded size, such as a unique key divided by the rows per statement.
    """
    pairs = F.sort_array(F.collect_list(F.struct(F.col(order), F.col(text))))
    return df.groupBy(group).agg(
        F.array_join(F.transform(pairs, lambda p: p[text]), ", ").alias("values_text")
    )


def statements(df: DataFrame, text: str, order: str, rows: int) -> DataFrame:
    """Value lists of at most ``rows`` rows each, in the order of a unique whole number:
    ``statement`` (from 0) and ``values_text``. Rows are numbered within ranges, not in one
    task."""
    numbered = ranked_from_end(df.select(order, text), order, "_rank")
    last = df.count() - 1
    return values_text(numbered.withColumn("statement", F.floor((F.lit(last) - F.col("_rank")) / rows)), text, "statement", order)
