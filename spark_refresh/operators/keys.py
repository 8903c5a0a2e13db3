"""Checks of unique keys."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def duplicate_keys(df: DataFrame, *keys: str) -> DataFrame:
    """Keys that occur more than once, with their number of rows. Rows are counted
    before the shuffle, so a key with many copies is one row in each task."""
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias("n")).filter(F.col("n") > 1)


def require_unique(df: DataFrame, *keys: str) -> None:
    """Stop if a key occurs twice; says how many do and shows up to five of them."""
    twice = duplicate_keys(df, *keys)
    found = twice.limit(5).collect()
    if found:
        shown = ", ".join(str(tuple(row[k] for k in keys)) for row in found)
        raise ValueError(f"{twice.count()} duplicate {keys}: {shown}")
