"""Control files: table metadata, batch manifests and the nested priority map.

A bad line stops the read: the error is part of the expression that parses the line.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.names import has_parts, is_bool, is_source_name, is_strategy, parse_bool, stripped
from .lines import place, read_lines, with_line_numbers

METADATA_FIELDS = (
    "source_table", "target_table", "strategy", "disabled",
    "priority", "min_staleness", "max_staleness",
)


def is_whole_number(c: Column) -> Column:
    return F.coalesce(c.rlike(r"^\s*[+-]?[0-9]+\s*$"), F.lit(False))


def metadata_problem(fields: Column) -> Column:
    """What is wrong with a metadata line, NULL if nothing is."""
    target, floor = F.get(fields, F.lit(1)), F.get(fields, F.lit(5))
    numbers = is_whole_number(F.get(fields, F.lit(4))) & is_whole_number(F.get(fields, F.lit(6)))
    return (
        F.when(F.size(fields) != len(METADATA_FIELDS), F.lit("should have 7 fields"))
        .when(~is_source_name(F.get(fields, F.lit(0))), F.lit("source must have 2 namespaces"))
        .when(~is_source_name(target), F.lit("target must have 2 namespaces"))
        .when(~is_strategy(F.get(fields, F.lit(2))), F.lit("invalid method"))
        .when(~is_bool(F.get(fields, F.lit(3))), F.lit("invalid disabled status"))
        .when(~numbers | ((floor != "") & ~is_whole_number(floor)), F.lit("invalid number"))
    )


def or_stop(value: Column, problem: Column, line: Column, kind: str) -> Column:
    """The value, unless there is a problem with its line."""
    message = F.concat(F.lit("line '"), line, F.lit("': "), problem)
    return F.when(problem.isNotNull(), F.raise_error(message).cast(kind)).otherwise(value)


def with_defaults(source: Column, target: Column, min_staleness: Column) -> tuple[Column, Column]:
    """Blank target is the source, blank minimum staleness is 0."""
    return (
        F.coalesce(F.nullif(target, F.lit("")), source),
        F.coalesce(F.nullif(min_staleness, F.lit("")), F.lit("0")),
    )


def parse_metadata(lines: DataFrame, *keep: str) -> DataFrame:
    """Typed metadata from lines; checks every line, also those no event asks for."""
    parts = lines.withColumn("fields", F.split("line", ","))
    fields = {n: F.get("fields", F.lit(i)) for i, n in enumerate(METADATA_FIELDS)}
    target, floor = with_defaults(
        fields["source_table"], fields["target_table"], fields["min_staleness"]
    )
    problem = metadata_problem(F.col("fields"))

    def checked(value: Column, kind: str) -> Column:
        return or_stop(value, problem, F.col("line"), kind)

    return parts.select(
        checked(F.nullif(fields["source_table"], F.lit("")), "string").alias("source_table"),
        F.nullif(target, F.lit("")).alias("target_table"),
        fields["strategy"].alias("strategy"),
        parse_bool(fields["disabled"]).alias("disabled"),
        stripped(fields["priority"]).cast("int").alias("priority"),
        stripped(floor).cast("int").alias("min_staleness"),
        stripped(fields["max_staleness"]).cast("int").alias("max_staleness"),
        *keep,
    )


def last_per_table(metadata: DataFrame, order: Column) -> DataFrame:
    """Of several lines for one table the last one counts."""
    others = [c for c in METADATA_FIELDS if c != "source_table"]
    return (
        metadata.groupBy("source_table")
        .agg(F.max_by(F.struct(*others), order).alias("last"))
        .select("source_table", *(F.col(f"last.{c}").alias(c) for c in others))
    )


def read_metadata(spark: SparkSession, path: str, skip_disabled: bool = False) -> DataFrame:
    """Metadata file, one row per table. Disabled tables are kept unless asked otherwise."""
    parsed = parse_metadata(read_lines(spark, path), "file", "block", "row")
    metadata = last_per_table(parsed, place())
    return metadata.filter(~F.col("disabled")) if skip_disabled else metadata


def manifest_problem(fields: Column) -> Column:
    source, target = F.get(fields, F.lit(0)), F.get(fields, F.lit(1))
    flag = F.get(fields, F.lit(3))
    return (
        F.when(F.size(fields) < 3, F.lit("should have source, target and method"))
        .when(~has_parts(source, 2), F.lit("source must have 2 namespaces"))
        .when((target != "") & ~has_parts(target, 2), F.lit("target must have 2 namespaces"))
        .when(~is_strategy(F.get(fields, F.lit(2))), F.lit("invalid method"))
        .when((F.size(fields) > 3) & ~is_bool(flag), F.lit("invalid lock rows"))
    )


def parse_manifest(
    lines: DataFrame, catalog: str, *keep: str, lock_rows_default: bool = True
) -> DataFrame:
    """Manifest lines ``source,target,method[,lock_rows...]``; only the first extra field
    is looked at."""
    parts = lines.withColumn("line", stripped(F.col("line"))).withColumn(
        "fields", F.split("line", ",")
    )
    # a filter, as the check must hold whatever columns are taken from the result
    parts = parts.filter(or_stop(F.lit(True), manifest_problem(F.col("fields")), F.col("line"), "boolean"))
    source = F.get("fields", F.lit(0))
    target = F.coalesce(F.nullif(F.get("fields", F.lit(1)), F.lit("")), source)
    return parts.select(
        source.alias("source"),
        F.concat_ws(".", F.lit(catalog), target).alias("target"),
        F.get("fields", F.lit(2)).alias("strategy"),
        F.coalesce(parse_bool(F.get("fields", F.lit(3))), F.lit(lock_rows_default)).alias("lock_rows"),
        *keep,
    )


def read_manifest(
    spark: SparkSession, path: str, catalog: str, lock_rows_default: bool = True
) -> DataFrame:
    """Manifest file with ``line_no`` counted from 0."""
    numbered = with_line_numbers(read_lines(spark, path))
    return parse_manifest(numbered, catalog, "line_no", lock_rows_default=lock_rows_default)


PRIORITY_MAP = (
    "tables array<map<string, struct<priority: string, max_staleness: string>>>"
)


def read_priority_map(spark: SparkSession, path: str, multi_line: bool = True) -> DataFrame:
    """Nested JSON ``{"tables": [{table: {"priority": "1", "max_staleness": "60"}}]}``.

    With ``multi_line=False`` each line is such a document and large files are split.
    """
    raw = spark.read.schema(PRIORITY_MAP).json(path, multiLine=multi_line, mode="FAILFAST")
    return (
        raw.select(F.explode("tables").alias("entry"))
        .select(F.explode("entry").alias("source_table", "attrs"))
        .select(
            "source_table",
            F.col("attrs.priority").cast("int").alias("priority"),
            F.col("attrs.max_staleness").cast("int").alias("max_staleness"),
        )
    )
