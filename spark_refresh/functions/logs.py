"""Reading the outcome of a load from the lines of its log.

``lines`` is an array column. A whole log of a table column is split row by row; logs in
files come from :mod:`spark_refresh.sources.logs`, which never puts a file in one row.
"""

from __future__ import annotations

from functools import reduce
from operator import or_

from pyspark.sql import Column
from pyspark.sql import functions as F

from ..schemas import FAILED, SUCCESS
from .names import stripped

# How many lines of a log are looked at, and what is looked for.
TAIL_LENGTH = 10
EXIT_TEXT = "replicant exited with error code: "
ROW_LINE = r"^[^ ]* +([0-9]+) +.*"
SYNTAX_ERROR = "Syntax error"
ERROR_PATTERNS = (
    "Error running query",
    "HiveSQLException",
    "DeltaAnalysisException",
    "FAILED: Execution Error",
    "Failed to initialize pool",
    "ExtractorException",
    "Syntax error",
    "Illegal Parquet type",
    "DeltaInvariantViolationException",
)


def split_lines(text: Column) -> Column:
    """Lines of a text; a final line break does not open another line.

    Line breaks are brought to one form by literal replacement: splitting by a pattern
    with alternatives is some ten times slower.
    """
    plain = F.replace(F.replace(text, F.lit("\r\n"), F.lit("\n")), F.lit("\r"), F.lit("\n"))
    ended = F.when(plain.endswith("\n"), F.left(plain, F.length(plain) - 1)).otherwise(plain)
    return F.split(ended, "\n")


def last_of(lines: Column, count: int = TAIL_LENGTH) -> Column:
    return F.reverse(F.slice(F.reverse(lines), 1, count))


def tail_lines(text: Column, count: int = TAIL_LENGTH) -> Column:
    """The last lines of a text, each without surrounding blanks.

    The text is first cut to what follows the line feed before them, so that a long log
    is not split as a whole.
    """
    end = F.substring_index(text, "\n", -(count + 1))
    return F.transform(last_of(split_lines(end), count), stripped)


def exit_code_seen(lines: Column, code: int) -> Column:
    """True if a line holds the exit text of this code; 1 also matches 10 to 19."""
    return F.array_join(lines, "|").contains(f"{EXIT_TEXT}{code}")


def counted_rows(lines: Column) -> Column:
    """Row figure of the last line that has one, else NULL."""
    figures = F.filter(F.reverse(lines), lambda line: line.rlike(ROW_LINE))
    return F.regexp_extract(F.get(figures, F.lit(0)), ROW_LINE, 1).cast("bigint")


def row_count(lines: Column) -> Column:
    """Rows a load copied, from the tail of its log.

    0 after a failed exit, the figure of the last row line, 0 after a clean exit without
    one. A log with none of these cannot be read: the value is NULL.
    """
    none = F.lit(0).cast("bigint")
    failed = exit_code_seen(lines, 1) | exit_code_seen(lines, 2)
    return F.when(failed, none).otherwise(
        F.coalesce(counted_rows(lines), F.when(exit_code_seen(lines, 0), none))
    )


def require_row_count(lines: Column) -> Column:
    """Like :func:`row_count`, but an unreadable log stops the job."""
    shown = F.concat(F.lit("Issue parsing log file: "), F.array_join(lines, "\n"))
    return F.coalesce(row_count(lines), F.raise_error(shown).cast("bigint"))


def is_error_line(line: Column) -> Column:
    """True if one of the patterns occurs; all are plain text, which is searched faster."""
    return reduce(or_, (line.contains(pattern) for pattern in ERROR_PATTERNS))


def found_errors(text: Column) -> Column:
    """Error lines of a text in file order, without surrounding blanks. Texts without any
    are not split."""
    lines = F.filter(split_lines(text), is_error_line)
    return F.transform(
        F.when(is_error_line(text), lines).otherwise(F.array().cast("array<string>")), stripped
    )


def error_lines(text: Column) -> Column:
    return F.array_distinct(found_errors(text))


def pick_error(errors: Column) -> Column:
    """The error line to report: a syntax error before any other, '' if there is none."""
    ranked = F.transform(
        errors,
        lambda line, i: F.struct((~line.contains(SYNTAX_ERROR)).alias("other"), i.alias("place"), line.alias("line")),
    )
    return F.coalesce(F.array_min(ranked)["line"], F.lit(""))


def first_error(text: Column) -> Column:
    return pick_error(found_errors(text))


def load_status(error: Column, rows: Column, exit_ok: Column) -> Column:
    """Whether a load worked, from its error line, its row figure and its exit."""
    has_error = F.coalesce(error, F.lit("")) != ""
    return (
        F.when(has_error & (rows > 0), F.lit(FAILED))
        .when(has_error & error.contains(SYNTAX_ERROR), F.lit(FAILED))
        .when(has_error, F.lit(SUCCESS))
        .when(~exit_ok, F.lit(FAILED))
        .otherwise(F.lit(SUCCESS))
    )


def load_message(error: Column, rows: Column, exit_ok: Column) -> Column:
    """The error text kept with a failed load, '' for one that worked."""
    has_error = F.coalesce(error, F.lit("")) != ""
    failed = load_status(error, rows, exit_ok) == FAILED
    return F.when(~failed, F.lit("")).when(has_error, error).otherwise(F.lit("Unknown error"))
