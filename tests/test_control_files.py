from __future__ import annotations

import json

import pytest
from pyspark.sql import functions as F

from spark_refresh.functions import names
from spark_refresh.sources import control, lines

GOOD = "s.a,t.a,TPT,false,1,10,20"


@pytest.fixture
def write(tmp_path):
    def to(text: str, name: str = "file.csv") -> str:
        (tmp_path / name).write_bytes(text.encode())
        return str(tmp_path / name)

    return to


@pytest.fixture
def small_blocks(spark):
    """Cut files into blocks of a few bytes, so that many tasks read one file."""
    changed = {"spark.sql.files.maxPartitionBytes": "64b", "spark.sql.files.openCostInBytes": "1b"}
    for key, value in changed.items():
        spark.conf.set(key, value)
    yield
    for key in changed:
        spark.conf.unset(key)


def test_metadata_line(spark, write):
    path = write(GOOD + "\ns.b,,WriteNOS, TRUE ,2,,30\n")
    rows = sorted(control.read_metadata(spark, path).collect())
    assert rows == [("s.a", "t.a", "TPT", False, 1, 10, 20), ("s.b", "s.b", "WriteNOS", True, 2, 0, 30)]
    assert control.read_metadata(spark, path, skip_disabled=True).count() == 1


@pytest.mark.parametrize("line", [
    "s.a,t.a,TPT,false,1,10", "s.a,t.a,TPT,false,1,10,20,30", "a,t.a,TPT,false,1,10,20", "s.a,t,TPT,false,1,10,20",
    "s.a,t.a,tpt,false,1,10,20", "s.a,t.a,TPT,no,1,10,20", "s.a,t.a,TPT,false,x,10,20", "s.a,t.a,TPT,false,1,10,", "s.a,t.a,TPT,false,1,y,20", "",
])
def test_bad_metadata_line_stops(spark, write, line):
    path = write(f"{GOOD}\n{line}\n")
    with pytest.raises(Exception):
        control.read_metadata(spark, path).collect()
    with pytest.raises(Exception):
        control.read_metadata(spark, path).filter(F.col("source_table") == "s.a").collect()


def test_bad_numbers_stop_without_ansi_casts_too(spark, write):
    spark.conf.set("spark.sql.ansi.enabled", "false")
    try:
        with pytest.raises(Exception, match="invalid number"):
            control.read_metadata(spark, write(GOOD + "\ns.b,,TPT,false,x,1,1\n")).collect()
    finally:
        spark.conf.unset("spark.sql.ansi.enabled")


def test_blank_source_is_a_missing_one(spark, write):
    rows = control.read_metadata(spark, write(",t.a,TPT,false,1,1,1\n")).collect()
    assert rows == [(None, "t.a", "TPT", False, 1, 1, 1)]


def test_last_line_wins_over_blocks(spark, write, small_blocks):
    text = "".join(f"s.t{i % 7},t.x,TPT,false,{i},1,1\n" for i in range(100))
    path = write(text)
    assert lines.read_lines(spark, path).rdd.getNumPartitions() > 10
    got = {r.source_table: r.priority for r in control.read_metadata(spark, path).collect()}
    assert got == {f"s.t{i % 7}": i for i in range(93, 100)}


def test_line_numbers_over_blocks_and_files(spark, write, small_blocks, tmp_path):
    for part in range(3):
        write("".join(f"{part}-{i}\n" for i in range(200)), f"part-{part}.txt")
    numbered = lines.with_line_numbers(lines.read_lines(spark, str(tmp_path)))
    got = [r.line for r in sorted(numbered.collect(), key=lambda r: r.line_no)]
    assert got == [f"{p}-{i}" for p in range(3) for i in range(200)]


def test_rank_from_the_end(spark):
    df = spark.createDataFrame([(i * i,) for i in range(50)], "n long")
    got = {r.n: r.place for r in lines.ranked_from_end(df, "n", "place", width=100).collect()}
    assert got == {i * i: 49 - i for i in range(50)}


def test_manifest(spark, write):
    path = write("  s.a,,TPT  \ns.b,t.b,WriteNOS,FALSE\ns.c,t.c,TPT, true ,more,fields\n")
    rows = sorted(control.read_manifest(spark, path, "lake", lock_rows_default=False).collect())
    assert rows == [
        ("s.a", "lake.s.a", "TPT", False, 0), ("s.b", "lake.t.b", "WriteNOS", False, 1), ("s.c", "lake.t.c", "TPT", True, 2)
    ]


@pytest.mark.parametrize("line", ["s.a,t.a", "a,t.a,TPT", ",t.a,TPT", "s.a,t,TPT", "s.a,,other", "s.a,,TPT,maybe", "s.a,,TPT,"])
def test_bad_manifest_line_stops(spark, write, line):
    with pytest.raises(Exception):
        control.read_manifest(spark, write(f"s.a,,TPT\n{line}\n"), "lake").collect()


def test_priority_map(spark, write):
    text = json.dumps({"tables": [
        {"crm.contact": {"priority": "40", "max_staleness": "1440"}},
        {"hr.shift": {"max_staleness": "7", "priority": "0"}, "hr.leave": {"priority": "12", "max_staleness": "90"}},
        {},
    ]})
    rows = sorted(control.read_priority_map(spark, write(text, "map.json")).collect())
    assert rows == [("crm.contact", 40, 1440), ("hr.leave", 12, 90), ("hr.shift", 0, 7)]


@pytest.mark.parametrize("text,want", [("true", True), (" FALSE\n", False), ("maybe", None), ("", None), (None, None)])
def test_flag_text(spark, text, want):
    c = F.lit(text).cast("string")
    row = spark.range(1).select(names.parse_bool(c).alias("v"), names.is_bool(c).alias("ok")).first()
    assert row == (want, want is not None)


def test_names(spark):
    c = F.lit("lake.finance.ledger_of_entries")
    row = spark.range(1).select(
        names.is_target_name(c).alias("a"), names.is_source_name(c).alias("b"), names.without_catalog(c).alias("c"),
        names.short_id(names.last_part(c)).alias("d"), names.dotted(F.lit(None).cast("string"), F.lit("s"), F.lit(""), F.lit("t")).alias("e"),
        names.extraction_method(F.lit("WriteNOS")).alias("f"), names.extraction_method(F.lit("x")).alias("g"),
    ).first()
    assert row == (True, False, "finance.ledger_of_entries", "ledger_o", "s.t", "TERADATA_WRITE_NOS", None)


def test_names_of_any_number_of_parts(spark):
    many = ".".join(f"p{i}" for i in range(2_500))
    rows = spark.createDataFrame([(many,), ("alone",), ("",), (None,)], "n string").select(names.without_catalog(F.col("n")).alias("v")).collect()
    assert [r.v for r in rows] == [many.split(".", 1)[1], "alone", "", None]


@pytest.mark.parametrize("column", ["source", "target", "strategy", "lock_rows", None])
def test_a_bad_manifest_line_stops_whatever_is_read(spark, write, column):
    manifest = control.read_manifest(spark, write("fin.ledger,,TPT\nledger,,TPT\n", "bad.csv"), "lake")
    with pytest.raises(Exception, match="2 namespaces"):
        manifest.select(column).collect() if column else manifest.count()
