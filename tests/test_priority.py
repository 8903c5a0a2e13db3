from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from spark_refresh.functions.priority import ladder, score, staleness
from spark_refresh.functions.times import wall

CASES = [
    (61, 1), (60, 2), (46, 2), (45, 3), (31, 3), (30, 4), (16, 4), (15, 5), (11, 5), (10, 6), (6, 6),
    (5, 7), (4, 7), (3, 8), (2, 9), (1, 10), (0, 15), (-4, 15), (-5, 20), (-9, 20), (-10, 25), (-99, 25),
]


def test_every_level_at_its_bounds(spark):
    df = spark.createDataFrame([(1000 + left, want) for left, want in CASES], "high int, want int")
    got = df.withColumn("got", ladder(F.lit(1000), F.lit(0), F.col("high")))
    assert got.filter("got <> want").collect() == []
    assert {want for _, want in CASES} == {1, 2, 3, 4, 5, 6, 7, 8, 9, 10, 15, 20, 25}


def test_not_stale_enough(spark):
    row = spark.range(1).select(
        ladder(F.lit(9), F.lit(10), F.lit(0)).alias("low"), ladder(F.lit(10), F.lit(10), F.lit(0)).alias("at")
    ).first()
    assert row == (0, 25)


@pytest.mark.parametrize("priority,want", [(1, 10), (3, 30), (0, 0)])
def test_score_is_a_product(spark, priority, want):
    event, asof = wall("2025-01-01 00:00:00"), "2025-01-01 00:00:59"
    row = spark.range(1).select(
        staleness(event, asof).alias("s"),
        score(event, asof, F.lit(priority), F.lit(0), F.lit(60)).alias("p"),
    ).first()
    assert row == (59, want)
