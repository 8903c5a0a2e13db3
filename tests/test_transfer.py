from __future__ import annotations

import pytest
from helpers import history_frame, history_row, t
from pyspark.sql import functions as F
from pyspark.sql import types as T

from spark_refresh.functions import casts
from spark_refresh.operators import batch as batch_queue
from spark_refresh.plans import batch, report, transfer
from spark_refresh.schemas import HISTORY, RUN, struct
from spark_refresh.sources import catalogue, jdbc
from spark_refresh.sources.scratch import SETTING, fresh_folder, shared_folder
from spark_refresh.sources.versions import Versions

TARGET = struct(id=T.LongType(), name=T.StringType(), price=T.DecimalType(10, 2), day=T.DateType())
ROWS = [(1, "abcdef", 1.005, "2025-01-01 10:00:00"), (2, "xy", 2.5, "2025-01-02 00:00:00"), (3, None, None, None)]


@pytest.fixture
def source(spark):
    df = spark.createDataFrame(ROWS, "id long, name string, price double, day string")
    return df.withColumn("day", F.col("day").cast("timestamp_ntz"))


@pytest.fixture
def entries(source):
    return catalogue.source_columns(source.schema, {"name": 4}, {"price": (10, 2)})


@pytest.fixture
def target(spark):
    return transfer.target_folder(spark, fresh_folder(spark, "target"), TARGET)


def entry(name, code, **more):
    base = dict(ColumnName=name, ColumnType=code, ColumnLength=0, ColumnFormat="", DecimalTotalDigits=0, DecimalFractionalDigits=0)
    return base | more


# -- type rules


def test_rules_per_code(spark):
    df = spark.sql("SELECT TIMESTAMP_NTZ'2025-01-02 03:04:05.6' ts, DATE'2025-01-02' da, 'abcdef' cf, 'abcdef' co, 12.345D d, 7.9D n, 5 i, INTERVAL '1' HOUR ti")
    rows = df.select(*casts.source_projection([
        entry("ts", "TS ", ColumnLength=21), entry("da", "DA"), entry("cf", "CF", ColumnFormat="X(3)"), entry("co", "CO", ColumnFormat="X(5)"),
        entry("d", "D", DecimalTotalDigits=5, DecimalFractionalDigits=2), entry("n", "N", DecimalTotalDigits=-128, DecimalFractionalDigits=-128),
        entry("i", "I"), entry("ti", "HM", ColumnLength=100),
    ], [("n", "int")], df.schema))
    row = rows.first().asDict()
    assert row.pop("ti").startswith("INTERVAL '01'")
    assert {k: str(v) for k, v in row.items()} == {
        "ts": "2025-01-02 03:04:05.6", "da": "2025-01-02", "cf": "abc", "co": "abcde", "d": "12.35", "n": "7", "i": "5"
    }
    assert rows.schema["d"].dataType == T.DecimalType(5, 2)


@pytest.mark.parametrize("kind,name", [
    ("decimal(12,3)", "DECIMAL(12,3)"), ("varchar(5)", "VARCHAR(5)"), ("char(2)", "CHAR(2)"), ("double", "DOUBLE PRECISION"), ("bigint", "BIGINT"),
])
def test_type_names(kind, name):
    assert casts.source_type_name(kind) == name


def test_unknown_types_stop():
    with pytest.raises(ValueError):
        casts.source_type_name("map<string,int>")
    with pytest.raises(KeyError):
        casts.source_projection([entry("n", "N", DecimalTotalDigits=-1)], [])
    with pytest.raises(ValueError):
        casts.declared_length("9(5)")


# -- copies


def test_full_refresh(source, entries, target, spark):
    for _ in range(2):
        assert transfer.copy_table(source, target, fresh_folder(spark, "stage"), catalogue=entries) == 3
    rows = sorted(target.read().collect())
    assert [(r.id, r.name, r.price and str(r.price), str(r.day)) for r in rows] == [
        (1, "abcd", "1.01", "2025-01-01"), (2, "xy", "2.50", "2025-01-02"), (3, None, None, "None")
    ]
    assert target.read().schema == TARGET


def test_append_keeps_duplicates(source, entries, target, spark):
    for where in (None, "id = 2", "id = 2"):
        transfer.copy_table(source, target, fresh_folder(spark, "stage"), where, catalogue=entries)
    assert {r.id: r["count"] for r in target.read().groupBy("id").count().collect()} == {1: 1, 2: 3, 3: 1}


def test_failed_load_leaves_the_old_rows(source, entries, target, spark):
    transfer.copy_table(source, target, fresh_folder(spark, "stage"), catalogue=entries)
    bad = source.withColumn("day", F.lit("not a day"))
    with pytest.raises(Exception):
        transfer.copy_table(bad, target, fresh_folder(spark, "stage"), catalogue=catalogue.source_columns(bad.schema, {}, {"price": (10, 2)}))
    assert target.read().count() == 3
    assert transfer.copy_table(source, target, fresh_folder(spark, "stage"), catalogue=entries) == 3


def test_rows_that_do_not_fit_are_kept_by_the_copy(spark):
    source = spark.createDataFrame([("1", "2025-01-01"), ("x", "2025-01-01"), ("2", "soon"), (None, None)], "n string, d string")
    target = transfer.target_folder(spark, fresh_folder(spark, "target"), struct(n=T.IntegerType(), d=T.DateType()))
    kept = fresh_folder(spark, "misfits")
    for where in (None, "n = 'x'"):
        rows = transfer.copy_table(source, target, fresh_folder(spark, "stage"), where, misfits=kept)
        assert rows == (1 if where else 4)
    assert sorted(str(r.n) for r in target.read().collect()) == ["1", "None"]
    assert sorted(r.raw_row for r in transfer.kept_misfits(spark, kept).collect()) == [
        '{"n":"2","d":"soon"}', '{"n":"x","d":"2025-01-01"}', '{"n":"x","d":"2025-01-01"}']
    clean = fresh_folder(spark, "misfits")
    transfer.copy_table(source.limit(1), target, fresh_folder(spark, "stage"), misfits=clean)
    with pytest.raises(Exception, match="PATH_NOT_FOUND"):
        transfer.kept_misfits(spark, clean)


def test_widths_are_measured(spark):
    rows = spark.createDataFrame([(1, "a" * 100, b"xx"), (2, "é" * 100, None)], "i int, t string, b binary")
    assert transfer.row_width(rows) == 4 + 150 + 1
    assert transfer.row_width(rows.limit(0)) == 4 and transfer.row_width(rows.select("i")) == 4
    assert transfer.records_per_file(155.0, 1550) == 10 and transfer.records_per_file(155.0, 1) == 1


def test_wrong_counts_stop():
    with pytest.raises(transfer.TransferError, match="Expected 3 rows inserted, but found 2"):
        transfer.check_counts(3, 2)


def test_reload_describes_the_run(source, target, spark):
    good = transfer.reload_table(spark, "s.a", "TPT", lambda: source, target)
    assert (good["table"], good["strategy"], good["status"], good["num_records"], good["error"]) == ("s.a", "TPT", "SUCCESS", 3, "")
    assert good["end"] >= good["start"]
    gone = transfer.reload_table(spark, "s.b", "TPT", lambda: spark.read.parquet("/nowhere"), target)
    assert gone["status"] == "FAILED" and "nowhere" in gone["error"] and gone["num_records"] == 0
    assert target.read().count() == 3


def test_truncate(source, entries, target, spark):
    transfer.copy_table(source, target, fresh_folder(spark, "stage"), catalogue=entries)
    transfer.truncate(target)
    assert target.read().count() == 0


def test_staged_file_size(source, spark):
    stage = transfer.export(source.repartition(1), [F.col("id")], fresh_folder(spark, "stage"), file_bytes=8)
    counts = transfer.stage_file_counts(transfer.staged(spark, stage.folder))
    assert sorted(r.record_count for r in counts.collect()) == [1, 1, 1]
    assert transfer.exported_rows(counts).first()[0] == stage.rows == 3


def test_catalog_table(spark, source, entries):
    name = "catalog_target"
    spark.sql(f"CREATE TABLE {name} (id BIGINT, name STRING, price DECIMAL(10,2), day DATE, {catalogue.VERSION_COLUMN} INT) USING parquet")
    try:
        assert catalogue.target_schema(spark, name) == [("id", "bigint"), ("name", "string"), ("price", "decimal(10,2)"), ("day", "date")]
        for where in (None, None, "id = 2"):
            transfer.copy_to_catalog(source, name, fresh_folder(spark, "stage"), where, catalogue=entries)
        assert spark.table(name).count() == 4
    finally:
        spark.sql(f"DROP TABLE {name}")


def test_description_is_cut_at_its_sections(spark):
    spark.sql("CREATE TABLE parts (a INT, b STRING) USING parquet PARTITIONED BY (b)")
    try:
        assert "# Partition Information" in [r[0] for r in spark.sql("DESCRIBE TABLE parts").collect()]
        assert catalogue.target_schema(spark, "parts") == [("a", "int"), ("b", "string")]
    finally:
        spark.sql("DROP TABLE parts")


def test_quarantine(spark):
    df = spark.createDataFrame([("1", "2025-01-01"), ("x", "2025-01-01"), ("2", "soon"), (None, None)], "n string, d string")
    target, path = struct(n=T.IntegerType(), d=T.DateType()), fresh_folder(spark, "quarantine")
    transfer.load_with_quarantine(df, target, path)
    good = transfer.applied_rows(spark, path, target)
    assert good.schema == target and {r.n for r in good.collect()} == {1, None}
    assert sorted(r.raw_row for r in transfer.quarantined_rows(spark, path).collect()) == ['{"n":"2","d":"soon"}', '{"n":"x","d":"2025-01-01"}']


# -- sources


@pytest.mark.parametrize("low,high,n", [(0, 100, 4), (5, 5, 3), (0, 2, 8), (-50, 50, 7)])
def test_splits_are_a_partition(spark, low, high, n):
    df = spark.range(-60, 120).selectExpr("id AS k").unionByName(spark.sql("SELECT CAST(NULL AS BIGINT) AS k"))
    for predicates in (jdbc.range_predicates("k", low, high, n), jdbc.modulo_predicates("k", n)):
        hits = sum((F.expr(p).cast("int") for p in predicates), F.lit(0))
        checks = [F.coalesce(F.expr(p), F.lit(False)).cast("int") for p in predicates]
        hits = checks[0]
        for c in checks[1:]:
            hits = hits + c
        assert df.filter(hits != 1).collect() == []


@pytest.mark.parametrize("n", [1, 3, 8])
@pytest.mark.parametrize("kind", ["bigint", "date", "timestamp_ntz"])
def test_quantile_splits_are_a_partition(spark, n, kind):
    """Of skewed values: half are one value, some are missing, the rest are far apart."""
    key = F.when(F.col("id") % 2 == 0, F.lit(5)).when(F.col("id") % 7 != 0, F.col("id") * F.col("id") % 9973)
    day = F.date_add(F.lit("2000-01-01"), key.cast("int"))
    df = spark.range(8000).select((key if kind == "bigint" else day.cast(kind)).alias("k"), F.when(F.col("id") % 3 > 0, F.floor(F.col("id") / 2)).alias("other"))
    for frame_ in (df, df.where("k IS NOT NULL"), df.where("k IS NULL"), df.limit(0)):
        predicates = jdbc.quantile_predicates(frame_, "k", n, second="other")
        hits = sum((F.coalesce(F.expr(p), F.lit(False)).cast("int") for p in predicates), F.lit(0))
        assert frame_.filter(hits != 1).count() == 0
    predicates = jdbc.quantile_predicates(df.where("other IS NOT NULL"), "k", n, second="other")
    sizes = [df.where("other IS NOT NULL").filter(p).count() for p in predicates]
    assert max(sizes) <= 1.25 * sum(sizes) / n


def test_jdbc_options():
    made = jdbc.jdbc_options("jdbc:x", {"user": "u"}, "SET X")
    assert made == {"url": "jdbc:x", "fetchsize": "10000", "user": "u", "sessionInitStatement": "SET X"}


def test_allow_list(spark):
    objects = spark.createDataFrame([("s", "a", "TABLE"), ("s", "b", "MACRO"), ("s", "c", "VIEW")], "schema string, table string, object_type string")
    allow = spark.createDataFrame([("s", "a"), ("s", "b")], "schema string, table string")
    assert [r.table for r in catalogue.allowed(objects, allow).collect()] == ["a"]


def test_sql_passthrough(spark):
    views = {"t": spark.range(3)}
    assert catalogue.run_sql(spark, "SELECT count(*) AS n FROM {t}", views).collect() == [(3,)]
    assert catalogue.run_sql(spark, "SET TIME ZONE 'UTC'").count() in (0, 1)


def test_working_folder_is_the_named_one(spark):
    assert fresh_folder(spark, "x").startswith(spark.conf.get(SETTING))
    assert shared_folder(spark) == spark.conf.get(SETTING)


def test_without_the_setting_only_one_machine_will_do():
    from types import SimpleNamespace as Part

    def session(master):
        context = Part(getConf=lambda: {}, master=master, applicationId="app")
        return Part(conf=Part(get=lambda key, default: default), sparkContext=context)

    assert shared_folder(session("local[8]")) == shared_folder(session("local[8]"))
    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        shared_folder(session("spark://somewhere"))


# -- versions


def versions(spark, rows=0):
    v = Versions(spark, fresh_folder(spark, "versions"), TARGET)
    return v, spark.createDataFrame([(i, "x", None, None) for i in range(rows or 1)], TARGET)


def test_what_was_found_short_does_not_count(spark):
    v, row = versions(spark)
    assert not v.exists and v.read().count() == 0 and v.note() == {}
    v.reset()

    def short(rows):
        raise transfer.TransferError(f"found {rows}")

    for write in (v.replace, v.add):
        with pytest.raises(transfer.TransferError, match="found 1"):
            write(row, check=short)
        assert v.read().count() == 0 and Versions(spark, v.folder, TARGET).read().count() == 0
    v.replace(row, {"batch": 7})
    v.add(row)
    other = Versions(spark, v.folder, TARGET)
    assert (other.read().count(), other.note(), other.version) == (2, {"batch": 7}, (1, 1))
    assert v.replace(row.limit(0), measured={"most": F.max("id")}) == {"rows": 0, "most": None}
    assert (v.read().count(), v.note()) == (0, {"batch": 7})


def test_parts_know_their_order(spark):
    v, row = versions(spark)
    v.replace(row)
    v.add(None, {"only": "a note"})
    v.add(row.withColumn("id", F.lit(5).cast("bigint")))
    assert sorted((r.id, r.part) for r in v.read("part").collect()) == [(0, 0), (5, 2)]
    assert v.note() == {"only": "a note"} and v.read().schema == TARGET


def test_partitions_are_used_again_and_readers_keep_theirs(spark):
    v, row = versions(spark)
    v.replace(row)
    v.add(row)
    held = v.read()
    for n in range(2):
        v.replace(row.union(row).union(row))
    assert held.count() == 2
    for n in range(7):
        v.replace(row)
    slots = {r[0] for r in spark.read.parquet(f"{v.folder}/data").select("_slot").distinct().collect()}
    assert slots == {0, 1, 2, 3} and v.read().count() == 1


def test_a_failed_append_leaves_no_rows(spark, source, entries, target, monkeypatch):
    transfer.copy_table(source, target, fresh_folder(spark, "stage"), catalogue=entries)

    def short(expected, inserted):
        raise transfer.TransferError("short")

    with monkeypatch.context() as patched:
        patched.setattr(transfer, "check_counts", short)
        with pytest.raises(transfer.TransferError):
            transfer.copy_table(source, target, fresh_folder(spark, "stage"), "id = 2", catalogue=entries)
    assert target.read().count() == 3
    transfer.copy_table(source, target, fresh_folder(spark, "stage"), "id = 2", catalogue=entries)
    assert target.read().count() == 4


def test_a_short_load_leaves_the_catalog_table(spark, source, entries, monkeypatch):
    name = "catalog_kept"
    spark.sql(f"CREATE TABLE {name} (id BIGINT, name STRING, price DECIMAL(10,2), day DATE) USING parquet")
    try:
        transfer.copy_to_catalog(source, name, fresh_folder(spark, "stage"), catalogue=entries)
        monkeypatch.setattr(transfer, "check_counts", lambda *_: (_ for _ in ()).throw(transfer.TransferError("short")))
        with pytest.raises(transfer.TransferError):
            transfer.copy_to_catalog(source.limit(1), name, fresh_folder(spark, "stage"), catalogue=entries)
        assert spark.table(name).count() == 3
    finally:
        spark.sql(f"DROP TABLE {name}")


@pytest.mark.parametrize("zone", ["America/New_York", "Asia/Kolkata"])
def test_instants_are_copied_in_any_session_zone(spark, zone):
    before = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", zone)
    try:
        rows = spark.createDataFrame([(1_730_613_600,), (1_730_610_000,), (0,), (None,)], "s long").select("s", F.timestamp_seconds("s").alias("at"))
        target = transfer.target_folder(spark, fresh_folder(spark, "target"), struct(s=T.LongType(), at=T.TimestampType()))
        assert transfer.reload_table(spark, "x.y", "TPT", lambda: rows, target)["status"] == "SUCCESS"
        got = target.read().select("s", F.unix_seconds("at").alias("t")).collect()
        assert len(got) == 4 and all(r.s == r.t for r in got)
    finally:
        spark.conf.set("spark.sql.session.timeZone", before)


# -- reports and batches


def test_report_line(spark):
    start = 1720582020.4
    runs = spark.createDataFrame([("s.a", "TPT", "FAILED", start, start + 100, 5, " bad\n")], RUN)
    assert report.run_report(runs).columns == list(report.REPORT_COLUMNS)
    assert report.run_report(runs).first() == ("s.a", "TPT", "FAILED", "7/9/24 8:27 PM", "7/9/24 8:28 PM", "1.67", 5, "bad")
    folder = fresh_folder(spark, "report")
    for _ in range(2):
        report.append_report(runs, folder)
    assert spark.read.option("header", True).csv(folder).count() == 2
    odd = spark.createDataFrame([('s."a", b', "TPT", "FAILED", start, start, 0, 'it said "no",\r\n  then, \\ left'), ("s.c", "TPT", "SUCCESS", start, start, 3, "")], RUN)
    report.append_report(odd, folder)
    back = {r.TABLE: (r.STATUS, r.NUM_RECORDS, r.ERROR) for r in report.read_report(spark, folder).collect()}
    assert back['s."a", b'] == ("FAILED", 0, 'it said "no",    then, \\ left') and back["s.c"] == ("SUCCESS", 3, "") and back["s.a"][2] == "bad"


def test_history_report(spark):
    target = transfer.target_folder(spark, fresh_folder(spark, "history"), HISTORY)
    early, late = t("2025-01-01 01:00:00"), t("2025-01-02 01:00:00")
    h = history_frame(spark, history_row("a", "SUCCESS", finish_time=early), history_row("b"))
    report.append_history(h, target)
    more = h.unionByName(history_frame(spark, history_row("c", "FAILED", finish_time=late, error="it's bad")))
    for _ in range(2):
        report.append_history(more, target)
    assert sorted((r.source_table, r.error, r.num_records) for r in target.read().collect()) == [("a", None, None), ("c", "it's bad", None)]


def test_batch_goes_on_after_a_failure(spark):
    rows = [(f"s.t{i}", f"lake.s.t{i}", "TPT" if i % 3 else "WriteNOS", True, i) for i in range(12)]
    manifest = spark.createDataFrame(rows, "source string, target string, strategy string, lock_rows boolean, line_no long")
    base, active, most, order = fresh_folder(spark, "batch"), {"TPT": 0, "WriteNOS": 0}, {"TPT": 0, "WriteNOS": 0}, []
    from threading import Lock
    lock = Lock()

    def load(row):
        with lock:
            active[row.strategy] += 1
            most[row.strategy] = max(most[row.strategy], active[row.strategy])
            order.append(row.source_table)
        try:
            if row.source_table == "s.t4":
                raise RuntimeError("table is gone")
            return spark.range(int(row.source_table[3:])).count()
        finally:
            with lock:
                active[row.strategy] -= 1

    state = batch.BatchState(spark, f"{base}/queue")
    runs = batch.batch_reload(spark, batch_queue.enqueue(manifest), load, f"{base}/report", f"{base}/runs", {"TPT": 3, "WriteNOS": 1}, state)
    assert state.progress(manifest) == (12, 0, 12)
    got = {r.table: (r.status, r.num_records, r.error) for r in runs.collect()}
    assert got.pop("s.t4") == ("FAILED", 0, "table is gone")
    assert got == {f"s.t{i}": ("SUCCESS", i, "") for i in range(12) if i != 4}
    assert most["TPT"] <= 3 and most["WriteNOS"] == 1
    assert [x for x in order if int(x[3:]) % 3 == 0] == ["s.t0", "s.t3", "s.t6", "s.t9"]
    assert spark.read.option("header", True).csv(f"{base}/report").count() == 12
    off = batch.batch_reload(spark, batch_queue.enqueue(manifest), load, f"{base}/report2", f"{base}/runs2", {"TPT": 2, "WriteNOS": 0})
    assert off.count() == 8
