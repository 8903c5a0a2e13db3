from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from spark_refresh.functions import logs, values
from spark_refresh.sources.logs import read_first_errors, read_log_tails, run_outcomes

# Own logs; fixed are only the shapes of the row line and of the exit line.
DONE = """
copy started, 8 workers
[################] finished

    table                 rows      bar          left
`lake`.`fin_books         41207     ========     00:00:00

replicant exited with error code: 0

"""
STOPPED = "loading settings\nno space for the spool\nreplicant exited with error code: 1\nsecond attempt\n"
EMPTY_COPY = "nothing was read\n    table   rows   bar\n\nreplicant exited with error code: 0"
JUNK = "    a line that says nothing\n    replicant exited somehow\n"
LONG_AGO = "`lake`.`hr_shift`   913   ==   00:00:00\n" + "later\n" * 10
TWELVE = "replicant exited with error code: 12\n`lake`.`hr_shift`   913   ==   00:00:00\n"
CASES = [(DONE, 41_207), (STOPPED, 0), (EMPTY_COPY, 0), (JUNK, None), (LONG_AGO, None), (TWELVE, 0), ("", None)]


def one(spark, column):
    return spark.range(1).select(column.alias("v")).first()["v"]


@pytest.mark.parametrize("text,want", CASES)
def test_row_count(spark, text, want):
    tail = logs.tail_lines(F.lit(text))
    assert one(spark, logs.row_count(tail)) == want
    if want is None:
        with pytest.raises(Exception, match="Issue parsing log file"):
            one(spark, logs.require_row_count(tail))
    else:
        assert one(spark, logs.require_row_count(tail)) == want


def test_last_row_line_counts(spark):
    text = "`a`.`b`   1   ==   0\n`a`.`c`   2   ==   0\nreplicant exited with error code: 0\n"
    assert one(spark, logs.row_count(logs.tail_lines(F.lit(text)))) == 2


@pytest.mark.parametrize("text,count", [("a\r\nb\r\n", 2), ("a\rb", 2), ("a\n\n", 2), ("a", 1), ("", 1)])
def test_line_breaks(spark, text, count):
    assert len(one(spark, logs.split_lines(F.lit(text)))) == count


@pytest.mark.parametrize("text,want", [
    ("  step 3\n  Syntax error: unknown column rate\n  caused by ExtractorException, code 9\n", "Syntax error: unknown column rate"),
    ("ExtractorException at start\n Syntax error (first) \nSyntax error (second)", "Syntax error (first)"),
    ("7: HiveSQLException\n3: ExtractorException\n", "7: HiveSQLException"), ("all is well\n", ""), ("", ""),
])
def test_error_to_report(spark, text, want):
    assert one(spark, logs.first_error(F.lit(text))) == want


@pytest.mark.parametrize("error,rows,ok,status,message", [
    ("disk is full", 55, False, "FAILED", "disk is full"), ("Syntax error: no such view", 0, False, "FAILED", "Syntax error: no such view"),
    ("Extractor gave up", 0, False, "SUCCESS", ""), ("", 0, False, "FAILED", "Unknown error"), ("", 3, True, "SUCCESS", ""),
    (None, 0, True, "SUCCESS", ""),
])
def test_outcome(spark, error, rows, ok, status, message):
    facts = F.lit(error).cast("string"), F.lit(rows), F.lit(ok)
    assert one(spark, logs.load_status(*facts)) == status
    assert one(spark, logs.load_message(*facts)) == message


def test_log_files_in_blocks(spark, tmp_path):
    """Files are cut into blocks; tails and errors are those of the whole file."""
    texts = {
        "done.log": "noise\n" * 400 + DONE, "stopped.log": STOPPED, "empty.log": "", "junk.log": JUNK,
        "error.log": "ExtractorException first\n" + "noise\n" * 300 + "  Syntax error late  \n" + "noise\n" * 50,
    }
    for name, text in texts.items():
        (tmp_path / name).write_text(text)
    spark.conf.set("spark.sql.files.maxPartitionBytes", "256b")
    spark.conf.set("spark.sql.files.openCostInBytes", "1b")
    try:
        tails = {r.file.rsplit("/", 1)[1]: r for r in read_log_tails(spark, str(tmp_path)).withColumn("n", logs.row_count(F.col("lines"))).collect()}
        errors = {r.file.rsplit("/", 1)[1]: r.error for r in read_first_errors(spark, str(tmp_path)).collect()}
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
        spark.conf.unset("spark.sql.files.openCostInBytes")
    assert set(tails) == set(texts) - {"empty.log"}
    for name, row in tails.items():
        assert row.lines == [line.strip() for line in texts[name].splitlines()[-10:]], name
    assert {n: r.n for n, r in tails.items()} == {"done.log": 41_207, "stopped.log": 0, "junk.log": None, "error.log": None}
    assert errors == {"error.log": "Syntax error late"}


def test_outcomes_of_runs(spark):
    runs = spark.createDataFrame(
        [("a.log", "a.err", True), ("b.log", "b.err", False), ("c.log", "c.err", False), ("d.log", "d.err", False)],
        "log_file string, error_file string, exit_ok boolean",
    )
    tails = spark.createDataFrame([("a.log", DONE.splitlines()[-10:]), ("b.log", STOPPED.splitlines()), ("c.log", JUNK.splitlines())], "file string, lines array<string>")
    errors = spark.createDataFrame([("b.err", "ExtractorException"), ("c.err", "Syntax error")], "file string, error string")
    got = {r.log_file: (r.status, r.num_records, r.error) for r in run_outcomes(runs, tails, errors).collect()}
    assert got == {
        "a.log": ("SUCCESS", 41_207, ""), "b.log": ("SUCCESS", 0, ""), "c.log": ("FAILED", 0, "Syntax error"),
        "d.log": ("FAILED", 0, "Unknown error"),
    }


def test_value_rows(spark):
    def text(*row):
        return one(spark, values.row_text(*(F.lit(x).cast("string") for x in row)))

    assert text("fin.books", 31, "late") == "('fin.books', '31', 'late')"
    assert text("hr") == "('hr')"
    assert text() == text("") == "()"
    assert text(None, "y") == "('None', 'y')"
    assert text("z", "it's 'quoted'") == "('z', 'its quoted')"


def test_value_list(spark):
    rows = spark.createDataFrame([(0, 9, "hr", "shift", 5), (0, 4, "fin", "books", 8)], "g int, k int, x string, y string, z int")
    df = rows.select("g", "k", values.row_text(F.col("x"), F.col("y"), F.col("z").cast("string")).alias("txt"))
    assert values.values_text(df, "txt", "g", "k").collect() == [(0, "('fin', 'books', '8'), ('hr', 'shift', '5')")]
