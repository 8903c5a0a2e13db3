"""Copying a table: staged Parquet, typed load, row counts."""

from __future__ import annotations

import time
from collections.abc import Iterable, Mapping
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.casts import has_misfit, source_projection, target_casts, tried_casts
from ..schemas import FAILED, SUCCESS, struct
from ..sources.catalogue import source_columns, target_schema
from ..sources.scratch import fresh_folder
from ..sources.versions import Versions

# Fixed value: rows per file of rows that were applied.
APPLY_ROWS = 1_000_000

# Uncompressed bytes aimed at per staged file. The smaller cap of a source that writes
# its own objects (16 MB) can be asked for; for Spark it would make too many files.
STAGE_FILE_BYTES = 256 * 1024 * 1024


class TransferError(Exception):
    """A copy that failed, with the reason."""


WIDTH_ROWS = 1000


def row_width(rows: DataFrame, sample: int = WIDTH_ROWS) -> float:
    """Measured bytes per row, for file sizes only: the mean of the first rows, text and
    bytes by their length and other types by the size Spark keeps them in."""
    fixed, varying = 0, []
    for f in rows.schema.fields:
        if isinstance(f.dataType, (T.StringType, T.VarcharType, T.CharType, T.BinaryType)):
            varying.append(F.coalesce(F.octet_length(F.col(f"`{f.name}`")), F.lit(0)))
        elif isinstance(f.dataType, (T.ArrayType, T.MapType, T.StructType)):
            varying.append(F.coalesce(F.octet_length(F.to_json(F.struct(F.col(f"`{f.name}`")))), F.lit(0)))
        else:
            fixed += 4 if isinstance(f.dataType, (T.IntegerType, T.DateType, T.FloatType)) else 8
    if not varying:
        return float(max(fixed, 1))
    total = reduce(lambda x, y: x + y, (v.cast("bigint") for v in varying))
    mean = rows.limit(sample).agg(F.avg(total).alias("mean")).first()["mean"]
    return max(fixed + (mean or 0.0), 1.0)


def records_per_file(width: float, file_bytes: int = STAGE_FILE_BYTES) -> int:
    return max(1, int(file_bytes // width))


@dataclass(frozen=True)
class Stage:
    """Exported files, the number of rows in them, and how many of those make a file."""

    folder: str
    rows: int
    per_file: int


# Endings of files that their readers cannot split.
UNSPLITTABLE = (".gz", ".deflate", ".xz", ".zst", ".lz4", ".snappy")
COLUMNAR = (".parquet", ".orc", ".avro")


def spread(df: DataFrame, unsplit: bool | None = None) -> DataFrame:
    """The rows over all cores where their reader cannot split them.

    ``unsplit`` says so, as for one connection; else the names of the files tell: files that
    cannot be split, and fewer files than cores. Whatever can be split, or comes in many
    files, is left as it is: no shuffle, and nothing is run to find out. Rows are spread in
    partitions of the size that adaptive execution is set to.
    """
    if unsplit is None:
        files = df.inputFiles()
        unsplit = len(files) < df.sparkSession.sparkContext.defaultParallelism and any(
            f.endswith(UNSPLITTABLE) and not any(c in f for c in COLUMNAR) for f in files)
    return df.hint("rebalance") if unsplit else df


def export(
    source: DataFrame,
    columns: Iterable[Column],
    folder: str,
    where: str | None = None,
    file_bytes: int = STAGE_FILE_BYTES,
) -> Stage:
    """Write the projected source as Parquet. Rows are counted while they are written.

    The condition and the choice of columns reach the scan; the casts run after the rows
    were spread. A task writes its split, in files of about ``file_bytes`` by the width that
    the first rows of the table have.
    """
    columns = list(columns)
    per_file = records_per_file(row_width(source.select(*columns)), file_bytes)
    chosen = spread(source.where(F.expr(where)) if where else source).select(*columns)
    seen = Observation()
    (
        chosen.observe(seen, F.count(F.lit(1)).alias("rows"))
        .write.option("compression", "snappy")
        .option("maxRecordsPerFile", per_file)
        .parquet(folder)
    )
    return Stage(folder, seen.get["rows"], per_file)


def staged(spark: SparkSession, folder: str, schema: T.StructType | None = None) -> DataFrame:
    reader = spark.read.option("mergeSchema", "false")
    return (reader.schema(schema) if schema else reader).parquet(folder)


def stage_file_counts(df: DataFrame) -> DataFrame:
    """Rows per staged file."""
    return df.groupBy(F.col("_metadata.file_path").alias("file")).agg(
        F.count(F.lit(1)).alias("record_count")
    )


def exported_rows(file_counts: DataFrame) -> DataFrame:
    return file_counts.agg(F.sum("record_count").alias("num_records"))


def typed(df: DataFrame, target: T.StructType | Iterable[tuple[str, str]]) -> DataFrame:
    """Staged rows with the columns and types of the target."""
    return df.select(*target_casts(target, df.schema))


# Set while both kinds of rows are written: a writer for each, instead of a sort of all rows.
WRITERS = "spark.sql.maxConcurrentOutputFileWriters"


def load_with_quarantine(
    df: DataFrame, target: T.StructType | Iterable[tuple[str, str]], folder: str
) -> None:
    """Write rows with their target types; rows with a value that does not fit are kept
    aside as they came. One pass writes both, told apart by the ``quarantined`` folder."""
    misfit = has_misfit(target, df.schema)
    raw = F.when(misfit, F.to_json(F.struct(*df.columns)))
    conf = df.sparkSession.conf
    before = conf.get(WRITERS)
    conf.set(WRITERS, "2")
    try:
        (
            df.select(*tried_casts(target, df.schema), raw.alias("raw_row"), misfit.alias("quarantined"))
            .write.option("maxRecordsPerFile", APPLY_ROWS)
            .partitionBy("quarantined")
            .parquet(folder)
        )
    finally:
        conf.set(WRITERS, before)


def applied_rows(spark: SparkSession, folder: str, target: T.StructType) -> DataFrame:
    schema = T.StructType([*target.fields, T.StructField("quarantined", T.BooleanType())])
    return spark.read.schema(schema).parquet(folder).filter(~F.col("quarantined")).drop("quarantined")


def quarantined_rows(spark: SparkSession, folder: str) -> DataFrame:
    """The rows kept aside, as JSON text of their staged form."""
    schema = struct(raw_row=T.StringType(), quarantined=T.BooleanType())
    return spark.read.schema(schema).parquet(folder).filter("quarantined").select("raw_row")


def target_folder(spark: SparkSession, folder: str, schema: T.StructType) -> Versions:
    """A target table kept by version: a refresh replaces it only once it is complete."""
    return Versions(spark, folder, schema)


def check_counts(expected: int, inserted: int) -> None:
    if expected != inserted:
        raise TransferError(f"Expected {expected} rows inserted, but found {inserted} instead.")


def copy_table(
    source: DataFrame,
    target: Versions,
    stage_folder: str,
    where: str | None = None,
    validate_counts: bool = True,
    catalogue: Iterable[Mapping] | None = None,
    file_bytes: int = STAGE_FILE_BYTES,
    misfits: str | None = None,
) -> int:
    """Copy a table into a target folder; the number of rows exported.

    Without a condition the target is refreshed as a whole: the new version counts only
    after its rows were counted, as they are written, so a failed load leaves the old one.
    With a condition the rows are appended, without looking for rows already there.

    With ``misfits`` rows that have a value which does not fit are appended to that folder as
    they came (:func:`kept_misfits`), and the others are loaded. They are found in the same
    pass; only where there are any are the staged rows read a second time.
    """
    spark, schema = source.sparkSession, target.schema
    entries = list(source_columns(source.schema) if catalogue is None else catalogue)
    columns = source_projection(entries, schema, source.schema)
    stage = export(source, columns, stage_folder, where, file_bytes)
    rows, kept, seen = staged(spark, stage.folder), 0, Observation()
    if misfits is None:
        loaded = typed(rows, schema)
    else:
        misfit = has_misfit(schema, rows.schema)
        judged = rows.select(*tried_casts(schema, rows.schema), misfit.alias("_misfit"))
        loaded = judged.observe(seen, F.count_if(F.col("_misfit")).alias("kept")).where("NOT _misfit").drop("_misfit")

    def check(inserted: int) -> None:
        nonlocal kept
        kept = seen.get["kept"] if misfits is not None else 0
        if validate_counts:
            check_counts(stage.rows, inserted + kept)
        if kept:
            bad = rows.where(has_misfit(schema, rows.schema)).select(F.to_json(F.struct(*rows.columns)).alias("raw_row"))
            bad.write.mode("append").parquet(misfits)

    write = target.add if where else target.replace
    write(loaded, max_records=stage.per_file, check=check)
    return stage.rows


def kept_misfits(spark: SparkSession, folder: str) -> DataFrame:
    """The rows a copy has kept aside, as JSON text of their staged form (``raw_row``)."""
    return spark.read.schema(struct(raw_row=T.StringType())).parquet(folder)


def copy_to_catalog(
    source: DataFrame,
    table: str,
    stage_folder: str,
    where: str | None = None,
    validate_counts: bool = True,
    catalogue: Iterable[Mapping] | None = None,
) -> int:
    """Copy a table into a catalog table with the types its description gives."""
    spark = source.sparkSession
    types = target_schema(spark, table)
    entries = list(source_columns(source.schema) if catalogue is None else catalogue)
    stage = export(source, source_projection(entries, types, source.schema), stage_folder, where)
    rows = typed(staged(spark, stage.folder), types)
    if validate_counts:  # before the target is touched: counted from the footers of the staged files
        check_counts(stage.rows, staged(spark, stage.folder).count())
    named = spark.table(table).columns
    seen = Observation()
    rows = rows.select(*(F.col(n) if n in rows.columns else F.lit(None).alias(n) for n in named))
    rows.observe(seen, F.count(F.lit(1)).alias("rows")).write.insertInto(table, overwrite=not where)
    if validate_counts:
        check_counts(stage.rows, seen.get["rows"])
    spark.catalog.refreshTable(table)
    return stage.rows


def truncate(target: Versions) -> None:
    target.reset()


def outcome(table: str, strategy: str, run) -> dict:
    """Run one copy and describe how it went; a failure becomes a row, not an exception."""
    start, status, error, rows = time.time(), SUCCESS, "", 0
    try:
        rows = run()
    except Exception as failure:  # noqa: BLE001 - one table must not stop the others
        status, error = FAILED, str(failure) or repr(failure)
    return {
        "table": table, "strategy": strategy, "status": status,
        "start": start, "end": time.time(), "num_records": rows, "error": error,
    }


def reload_table(
    spark: SparkSession,
    name: str,
    strategy: str,
    source,
    target: Versions,
    where: str | None = None,
    stage_folder: str | None = None,
) -> dict:
    """Read, copy, check and describe one table. ``source`` is a function that gives its
    DataFrame, so that a table that cannot be read is a failed run as well."""
    folder = stage_folder or fresh_folder(spark, "stage")
    return outcome(name, strategy, lambda: copy_table(source(), target, folder, where))

