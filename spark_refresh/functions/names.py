"""Dotted table names and the checks on text fields of the control files."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from ..schemas import STRATEGIES

# Name of the extraction method of each strategy.
EXTRACTION_METHOD = {"TPT": "TPT", "WriteNOS": "TERADATA_WRITE_NOS"}


# Fixed value: the characters that surround a field without belonging to it.
BLANKS = " \t\r\n\x0b\x0c"


def stripped(c: Column) -> Column:
    return F.btrim(c, F.lit(BLANKS))


def dotted(*parts: Column) -> Column:
    """Join with dots, leaving out NULL and empty parts."""
    return F.concat_ws(".", *(F.nullif(p, F.lit("")) for p in parts))


def name_parts(c: Column) -> Column:
    return F.split(c, r"\.")


def last_part(c: Column) -> Column:
    return F.substring_index(c, ".", -1)


def without_catalog(c: Column) -> Column:
    """``catalog.schema.table`` to ``schema.table``; a name without a dot stays as it is."""
    return F.substring(c, F.instr(c, ".") + 1, F.length(c))


def short_id(table: Column) -> Column:
    """The first eight characters, used to label staged copies."""
    return F.substring(table, 1, 8)


def has_parts(c: Column, count: int) -> Column:
    return F.coalesce(F.size(name_parts(c)) == count, F.lit(False))


def is_source_name(c: Column) -> Column:
    """Two parts; a blank name passes, it stands for a missing one."""
    return F.coalesce(c == "", F.lit(True)) | has_parts(c, 2)


def is_target_name(c: Column) -> Column:
    return has_parts(c, 3)


def is_strategy(c: Column) -> Column:
    return F.coalesce(c.isin(*STRATEGIES), F.lit(False))


def extraction_method(c: Column) -> Column:
    """Method name of a strategy, NULL for an unknown one."""
    first, *others = EXTRACTION_METHOD.items()
    method = F.when(c == first[0], F.lit(first[1]))
    for strategy, name in others:
        method = method.when(c == strategy, F.lit(name))
    return method


def parse_bool(c: Column) -> Column:
    """``true`` / ``false`` in any case and padding; NULL for anything else."""
    text = F.lower(stripped(c))
    return F.when(text == "true", F.lit(True)).when(text == "false", F.lit(False))


def is_bool(c: Column) -> Column:
    return parse_bool(c).isNotNull()
