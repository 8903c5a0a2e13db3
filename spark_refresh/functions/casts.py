"""Type rules of a table copy: source columns to their staged form, staged columns to
the types of the target."""

from __future__ import annotations

import re
from collections.abc import Iterable, Mapping

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .times import utc_wall

# Type codes of the source catalogue.
TIME_CODES = ("TS", "SZ", "MI", "DM", "HM", "HS", "AT", "TZ")
DATE_CODE = "DA"
CHARACTER_CODES = ("CF", "CO")
NUMBER_CODES = ("N", "D")

# Name in the source of each type name of the target.
SOURCE_TYPE_NAME = {
    "int": "INTEGER",
    "tinyint": "TINYINT",
    "smallint": "SMALLINT",
    "bigint": "BIGINT",
    "varchar": "VARCHAR",
    "double": "DOUBLE PRECISION",
    "float": "FLOAT",
    "boolean": "BOOLEAN",
    "date": "DATE",
    "timestamp": "TIMESTAMP",
    "binary": "BINARY",
}

ZONED_TEXT = r"(?i)(?:Z|UTC|GMT|[+-]\d{1,2}(?::?\d{2})?|[a-z]+/[a-z_/+-]+\d*)$"


def declared_length(column_format: str) -> int:
    """``X(20)`` to 20."""
    found = re.fullmatch(r"\s*X\((\d+)\)\s*", column_format)
    if not found:
        raise ValueError(f"not a character format: {column_format!r}")
    return int(found.group(1))


def text_of_length(c: Column, length: int) -> Column:
    """The first ``length`` characters; a varchar cast would not cut the text."""
    return F.substring(c.cast("string"), 1, length)


def time_text(c: Column, length: int, kind: T.DataType | None = None) -> Column:
    """Time, timestamp or interval as text of at most ``length`` characters.

    Timestamps are written with six decimals: NTZ values as they are, others as the wall
    clock of UTC, which has no hour twice. Neither depends on the session zone.
    """
    if isinstance(kind, (T.TimestampNTZType, T.TimestampType)):
        shown = (c if isinstance(kind, T.TimestampNTZType) else utc_wall(c)).cast("string")
        whole = F.substring(shown, 1, 19)
        text = F.concat(whole, F.lit("."), F.rpad(F.substring(shown, 21, 6), 6, "0"))
    else:
        text = c.cast("string")
    return F.substring(text, 1, length)


def date_text(c: Column) -> Column:
    return F.substring(c.cast("date").cast("string"), 1, 10)


def source_type_name(target_type: str) -> str:
    """How the source spells a target type; decimals and strings keep their digits."""
    name = target_type.strip().lower()
    if "decimal" in name or "char" in name and "(" in name:
        return name.upper()
    if name not in SOURCE_TYPE_NAME:
        raise ValueError(f"no source type for target type {target_type!r}")
    return SOURCE_TYPE_NAME[name]


def number_by_target(c: Column, target_type: str) -> Column:
    """A number without declared digits takes the type of the column it is copied to."""
    name = source_type_name(target_type)
    sized = re.fullmatch(r"(?:VAR)?CHAR\((\d+)\)", name)
    if sized:
        return text_of_length(c, int(sized.group(1)))
    spelling = {"DOUBLE PRECISION": "double", "VARCHAR": "string"}
    return c.cast(spelling.get(name, name.lower()))


def target_types(target: T.StructType | Iterable[tuple[str, str]]) -> dict[str, str]:
    if isinstance(target, T.StructType):
        return {f.name: f.dataType.simpleString() for f in target.fields}
    return dict(target)


def staged_column(
    entry: Mapping, target: Mapping[str, str], kind: T.DataType | None = None
) -> Column:
    """Staged form of one column of the source catalogue."""
    name, code = entry["ColumnName"], entry["ColumnType"].strip()
    c = F.col(f"`{name}`")
    if code in TIME_CODES:
        staged = time_text(c, int(entry["ColumnLength"]), kind)
    elif code == DATE_CODE:
        staged = date_text(c)
    elif code in CHARACTER_CODES:
        unbounded = not str(entry["ColumnFormat"] or "").strip() and int(entry["ColumnLength"]) < 0
        staged = c.cast("string") if unbounded else text_of_length(c, declared_length(entry["ColumnFormat"]))
    elif code in NUMBER_CODES:
        precision, scale = int(entry["DecimalTotalDigits"]), int(entry["DecimalFractionalDigits"])
        if precision >= 0 and scale >= 0:
            staged = c.cast(T.DecimalType(precision, scale))
        elif name in target:
            staged = number_by_target(c, target[name])
        else:
            raise KeyError(f"column {name} has no declared digits and is not in the target")
    else:
        staged = c
    return staged.alias(name)


def source_projection(
    catalogue: Iterable[Mapping],
    target: T.StructType | Iterable[tuple[str, str]] = (),
    schema: T.StructType | None = None,
) -> list[Column]:
    """The select list that brings a source table into its staged form."""
    types = target_types(target)
    kinds = {f.name: f.dataType for f in schema.fields} if schema else {}
    return [staged_column(e, types, kinds.get(e["ColumnName"])) for e in catalogue]


def _staged_value(name: str, target: str, staged: T.StructType | None) -> Column:
    """A staged column as it is cast: times staged as text, and NTZ times, are read in UTC
    where the target is an instant."""
    c = F.col(f"`{name}`")
    kind = staged[name].dataType if staged and name in staged.names else None
    if target.strip().lower() != "timestamp" or not isinstance(kind, (T.StringType, T.TimestampNTZType)):
        return c
    text = F.trim(c.cast("string"))
    whole = F.when(F.length(text) <= 10, F.concat(text, F.lit(" 00:00:00"))).otherwise(text)
    return F.when(text.rlike(ZONED_TEXT) & (F.length(text) > 10), text).otherwise(F.concat(whole, F.lit("Z")))


def target_casts(
    target: T.StructType | Iterable[tuple[str, str]], staged: T.StructType | None = None
) -> list[Column]:
    """The select list of a typed load: every target column, by name."""
    return [_staged_value(n, t, staged).cast(t).alias(n) for n, t in target_types(target).items()]


def tried_casts(
    target: T.StructType | Iterable[tuple[str, str]], staged: T.StructType | None = None
) -> list[Column]:
    """Like :func:`target_casts`, but NULL where a value does not fit the type."""
    return [_staged_value(n, t, staged).try_cast(t).alias(n) for n, t in target_types(target).items()]


def has_misfit(
    target: T.StructType | Iterable[tuple[str, str]], staged: T.StructType | None = None
) -> Column:
    """True where a value is lost by the cast to its target type."""
    found = F.lit(False)
    for n, t in target_types(target).items():
        c = _staged_value(n, t, staged)
        found = found | (c.isNotNull() & c.try_cast(t).isNull())
    return found
