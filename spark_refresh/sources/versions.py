"""A table that is replaced or added to as a whole: Parquet, partitioned by version.

A version is a generation and its parts: replacing a table begins a generation, adding rows
writes a further part of it. Spark writes each part as a partition of its own; a row in the
table of marks, written after it, makes it count. Reading filters on the partitions that the
marks of the last generation name, so rows of a write that failed, or that was found short,
never show. Partitions are used again every ``KEPT`` generations, which removes old files and
leaves readers the ones they hold. There is one writer.
"""

from __future__ import annotations

import json
from collections.abc import Callable, Mapping
from typing import NamedTuple

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

KEPT = 4  # generations
MARK = T.StructType([
    T.StructField("generation", T.LongType()), T.StructField("part", T.LongType()),
    T.StructField("rows", T.LongType()), T.StructField("note", T.StringType()),
])
PARTITIONS = T.StructType([T.StructField("_slot", T.IntegerType()), T.StructField("_part", T.LongType())])


Note = Mapping | Callable[[dict], Mapping] | None


class Mark(NamedTuple):
    generation: int
    part: int
    rows: int
    note: str


class Versions:
    """A table below ``folder``."""

    def __init__(self, spark: SparkSession, folder: str, schema: T.StructType):
        self.spark, self.folder, self.schema = spark, folder.rstrip("/"), schema
        self._written: list[Mark] | None = None  # by this object: the one writer knows its marks

    # -- reading

    def marks(self) -> list[Mark]:
        """The parts of the last generation, in order."""
        if self._written is not None:
            return list(self._written)
        reader = self.spark.read.schema(MARK).option("ignoreMissingFiles", "true")
        try:
            rows = [Mark(*r) for r in reader.parquet(f"{self.folder}/marks").select(*MARK.names).collect()]
        except AnalysisException as error:
            if error.getCondition() != "PATH_NOT_FOUND":
                raise
            return []
        last = max((m.generation for m in rows), default=0)
        return sorted(m for m in rows if m.generation == last)

    @property
    def version(self) -> tuple[int, int] | None:
        marks = self.marks()
        return (marks[-1].generation, marks[-1].part) if marks else None

    @property
    def exists(self) -> bool:
        return self.version is not None

    def note(self) -> dict:
        """What was written down with the last version, for example the stream batch."""
        marks = self.marks()
        return json.loads(marks[-1].note) if marks else {}

    def read(self, part: str | None = None) -> DataFrame:
        """The rows that count; ``part`` names a column for the part each came with."""
        parts = [m for m in self.marks() if m.rows]
        columns = [*self.schema.names, *([F.col("_part").alias(part)] if part else [])]
        if not parts:
            empty = self.spark.createDataFrame([], self.schema)
            return empty.withColumn(part, F.lit(None).cast("bigint")) if part else empty
        stored = self.spark.read.schema(T.StructType([*self.schema.fields, *PARTITIONS.fields])).parquet(f"{self.folder}/data")
        last, numbers = parts[-1].part, [m.part for m in parts]
        counted = F.col("_part") <= last if numbers == list(range(last + 1)) else F.col("_part").isin(numbers)
        return stored.where((F.col("_slot") == parts[0].generation % KEPT) & counted).select(*columns)

    # -- writing

    def _write(
        self, df: DataFrame | None, before: list[Mark], generation: int, note: Note, max_records: int,
        check: Callable[[int], None] | None, measured: Mapping[str, Column] | None,
    ) -> dict:
        live = [m for m in before if m.generation == generation]
        part, found = len(live), {"rows": 0}
        place = f"_slot={generation % KEPT}/_part={part}"
        if df is not None:
            columns = (df[f.name].cast(f.dataType).alias(f.name) for f in self.schema.fields)
            seen = Observation()
            extra = (c.alias(n) for n, c in (measured or {}).items())
            rows = df.select(*columns).observe(seen, F.count(F.lit(1)).alias("rows"), *extra)
            rows.write.mode("overwrite").option("maxRecordsPerFile", max_records).parquet(f"{self.folder}/data/{place}")
            found = seen.get
        if check:
            check(found["rows"])
        if callable(note):
            note = note(found)
        text = json.dumps(dict(note)) if note is not None else before[-1].note if before else "{}"
        mark = Mark(generation, part, found["rows"], text)
        rows = self.spark.createDataFrame([tuple(mark)], MARK).coalesce(1)
        rows.write.mode("overwrite").parquet(f"{self.folder}/marks/{place}")
        self._written = [*live, mark]
        return found

    def replace(
        self, df: DataFrame | None, note: Note = None, max_records: int = 0,
        check: Callable[[int], None] | None = None, measured: Mapping[str, Column] | None = None,
    ) -> dict:
        """Let the rows be the table. ``check`` gets their number and can stop it by an
        exception; ``measured`` aggregates are taken while writing and returned, with the
        number of ``rows``. Without a note the last one stays."""
        before = self.marks()
        return self._write(df, before, before[-1].generation + 1 if before else 0, note, max_records, check, measured)

    def add(
        self, df: DataFrame | None, note: Note = None, max_records: int = 0,
        check: Callable[[int], None] | None = None, measured: Mapping[str, Column] | None = None,
    ) -> dict:
        """Add the rows, all or none of them; ``None`` changes the note only."""
        before = self.marks()
        return self._write(df, before, before[-1].generation if before else 0, note, max_records, check, measured)

    def reset(self) -> None:
        """Empty the table, creating it if it is not there yet."""
        self.replace(None, note={})
