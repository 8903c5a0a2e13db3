"""What a source or target table looks like, and SQL passed through to Spark."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

# The column the replicator adds to its targets and the kinds of source
# objects that can be copied.
VERSION_COLUMN = "REPLICATE_IO_METADATA_VERSION"
OBJECT_TYPES = ("TABLE", "VIEW", "QUERY")

# Type code of the source catalogue for each Spark type.
TYPE_CODE = {
    "timestamp": "TS", "timestamp_ntz": "TS", "date": "DA", "string": "CF",
    "decimal": "D", "double": "F", "float": "F", "bigint": "I8", "int": "I",
    "smallint": "I2", "tinyint": "I1", "boolean": "BO", "binary": "BV",
}

CATALOGUE = T.StructType([
    T.StructField("ColumnName", T.StringType()),
    T.StructField("ColumnType", T.StringType()),
    T.StructField("ColumnLength", T.IntegerType()),
    T.StructField("ColumnFormat", T.StringType()),
    T.StructField("DecimalTotalDigits", T.IntegerType()),
    T.StructField("DecimalFractionalDigits", T.IntegerType()),
])

TIMESTAMP_LENGTH = 26
UNBOUNDED = -1


def source_columns(
    schema: T.StructType,
    lengths: Mapping[str, int] | None = None,
    numbers: Mapping[str, tuple[int, int]] | None = None,
) -> list[dict]:
    """Catalogue rows of a table Spark reads.

    ``lengths`` declares character lengths; text without one is unbounded (length -1, no
    format) and copied as it is. ``numbers`` declares digits of number
    columns; (-1, -1) stands for a number without declared digits.
    """
    lengths, numbers = lengths or {}, numbers or {}
    rows = []
    for field in schema.fields:
        kind = field.dataType.simpleString().split("(")[0]
        code, length, shape, digits = TYPE_CODE.get(kind, "UT"), 0, "", (0, 0)
        if field.name in numbers:
            code, digits = "N", numbers[field.name]
        elif isinstance(field.dataType, T.DecimalType):
            digits = (field.dataType.precision, field.dataType.scale)
        elif code == "CF":
            length = lengths.get(field.name, UNBOUNDED)
            shape = f"X({length})" if length != UNBOUNDED else ""
        elif code == "TS":
            length = TIMESTAMP_LENGTH
        rows.append(dict(zip(CATALOGUE.names, (field.name, code, length, shape, *digits))))
    return rows


def source_row_count(df: DataFrame) -> DataFrame:
    return df.agg(F.count(F.lit(1)).cast("bigint").alias("row_count"))


def target_schema(spark: SparkSession, table: str) -> list[tuple[str, str]]:
    """Names and types of a catalog table, without the replicator's own column and
    without the partition and clustering sections at the end of its description."""
    rows = spark.sql(f"DESCRIBE TABLE {table}").select("col_name", "data_type").collect()
    found = []
    for name, kind in rows:
        if name.startswith("#"):
            break
        if name and name != VERSION_COLUMN:
            found.append((name, kind))
    return found


def allowed(catalogue: DataFrame, allow: DataFrame) -> DataFrame:
    """Objects of the catalogue that the allow list names by schema and table."""
    kinds = catalogue.filter(F.col("object_type").isin(*OBJECT_TYPES))
    return kinds.join(allow, ["schema", "table"], "left_semi")


def run_sql(spark: SparkSession, text: str, views: Mapping[str, DataFrame] | None = None) -> DataFrame:
    """SQL against the session; a statement without columns gives an empty frame."""
    return spark.sql(text, **(views or {}))
