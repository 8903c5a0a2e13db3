from __future__ import annotations

from datetime import datetime

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from spark_refresh.functions import times


def value(spark, column):
    return spark.range(1).select(column.alias("v")).first()["v"]


def test_text_and_epoch_stand_for_each_other(spark):
    for text, epoch in (("2024-07-09 18:03:41", 1720573421), ("2023-11-30 23:59:59", 1701413999)):
        wall = times.parse_text(F.lit(text))
        assert value(spark, times.to_epoch(wall)) == epoch
        assert value(spark, times.format_text(times.from_epoch(F.lit(epoch)))) == text


def test_epoch_to_fields(spark):
    assert value(spark, times.from_epoch(F.lit(1720573421))) == datetime(2024, 7, 9, 18, 3, 41)


def test_epochs_differ_by_seconds(spark):
    before, after = (times.to_epoch(times.wall(x)) for x in ("2024-02-28 23:59:30", "2024-02-29 00:01:00"))
    assert value(spark, after - before) == 90 and value(spark, before < after)


@pytest.mark.parametrize("text", [None, "", "2024-07-09", "09.07.2024 18:03:41", "2025-02-30 00:00:00", "2024-07-09 25:00:00", "24-7-9 1:1:1", "2024-07-09 24:00:00", "2024-07-09 00:00:60", "2024-07-09T01:00:00",
    "2024-07-09 01:00:00Z", "2024-07-09 01:00", "12024-07-09 01:00:00", "2024-07-09 01:00:00.5", " 2024-07-09 01:00:00"])
def test_bad_text(spark, text):
    c = F.lit(text).cast("string")
    assert value(spark, times.is_valid_text(c)) is False
    with pytest.raises(Exception, match="not a yyyy-MM-dd"):
        value(spark, times.require_text(c))


@pytest.mark.parametrize("text", ["2025-3-1 4:5:6", "2025-03-01   04:05:06", "2025-03-01\t4:05:06"])
def test_unpadded_text(spark, text):
    assert value(spark, times.parse_text(F.lit(text))) == datetime(2025, 3, 1, 4, 5, 6)


def test_gap_of_the_session_zone(spark):
    before = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", "America/Los_Angeles")
    try:
        wall = times.parse_text(F.lit("2024-03-10 02:30:00"))
        assert value(spark, times.format_text(wall)) == "2024-03-10 02:30:00"
        assert value(spark, times.to_epoch(wall)) == 1710063000
    finally:
        spark.conf.set("spark.sql.session.timeZone", before)


@pytest.mark.parametrize("text,shown", [
    ("2024-07-09 04:26:00", "7/9/24 4:26 AM"), ("2025-12-01 00:05:59", "12/1/25 12:05 AM"),
    ("2005-07-04 12:00:00", "7/4/05 12:00 PM"), ("2024-07-09 23:59:00", "7/9/24 11:59 PM"),
])
def test_short_text(spark, text, shown):
    assert value(spark, times.short_text(times.wall(text))) == shown


def test_short_text_of_null(spark):
    assert value(spark, times.short_text(F.lit(None).cast("timestamp_ntz"))) is None


def test_fraction_is_dropped_downwards(spark):
    assert value(spark, times.drop_fraction(times.wall("1969-12-31 23:59:58.7"))) == datetime(1969, 12, 31, 23, 59, 58)


def test_iso(spark):
    assert value(spark, times.iso_normalise(F.lit("2025-01-01T00:00:00.000Z"))) == "2025-01-01 00:00:00"


def test_minutes(spark):
    assert value(spark, times.minutes_between(F.lit(0.0), F.lit(100.0))) == 1.67


@pytest.mark.parametrize("hour,held", [(5, False), (6, True), (17, True), (18, False)])
def test_avoid_window(spark, hour, held):
    assert value(spark, times.avoid_window(times.wall(f"2025-01-01 {hour:02d}:59:59"), "6-18")) is held
    assert value(spark, times.avoid_window(times.wall(f"2025-01-01 {hour:02d}:59:59"), "never")) is False


def test_avoid_window_must_not_cross_midnight():
    with pytest.raises(ValueError):
        times.avoid_window(None, "18-6")


@pytest.mark.parametrize("minute,passed", [(0, False), (2, False), (3, True)])
def test_top_of_hour(spark, minute, passed):
    assert value(spark, times.past_top_of_hour(times.wall(f"2025-01-01 01:{minute:02d}:59"))) is passed


@settings(max_examples=8, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.integers(-10**9, 4 * 10**9), min_size=1, max_size=50))
def test_epoch_round_trip(spark, seconds):
    df = spark.createDataFrame([(s,) for s in seconds], "s long")
    assert df.filter(times.to_epoch(times.from_epoch(F.col("s"))) != F.col("s")).count() == 0
