"""Every registered query gives the rows of its SQL."""

from __future__ import annotations

import pytest
from compare import difference, duck
from conftest import SMALL

import __spark_entry__ as entry_points
from checks.registry import QUERIES


@pytest.fixture(scope="module")
def con():
    return duck(SMALL)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_same_rows(spark, con, name):
    df = entry_points.queries()[name](spark, SMALL)
    assert difference(df, con, entry_points.oracle_sql()[name]) is None
    plan = df._jdf.queryExecution().executedPlan().toString()
    for python_or_cross in ("EvalPython", "MapInPandas", "FlatMapGroups", "CartesianProduct", "NestedLoopJoin"):
        assert python_or_cross not in plan


def test_entry_has_rows(spark):
    assert entry_points.entry(spark).count() > 0


@pytest.mark.parametrize("zone", ["America/Los_Angeles", "Asia/Kolkata", "America/New_York"])
@pytest.mark.parametrize("name", ["ts_to_epoch", "epoch_to_ts", "validate_ts", "run_report", "priority_score", "tracking_scan", "tracking_scan_zoned", "copy_timestamps"])
def test_session_zone_does_not_matter(spark, con, name, zone):
    before = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", zone)
    try:
        df = entry_points.queries()[name](spark, SMALL)
        assert difference(df, con, entry_points.oracle_sql()[name]) is None
    finally:
        spark.conf.set("spark.sql.session.timeZone", before)
