"""Parallel reads of a source over JDBC, and the same splits for any DataFrame."""

from __future__ import annotations

from collections import Counter
from collections.abc import Mapping, Sequence
from datetime import date, datetime

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# Rows per fetch and connections to the source.
FETCH_SIZE = 10_000
MAX_CONNECTIONS = 4


def range_predicates(column: str, lower: int, upper: int, splits: int) -> list[str]:
    """``splits`` conditions that each value, and NULL, meets exactly one of.

    The bounds only place the cuts: the first and last split are open.
    """
    if splits < 1 or upper < lower:
        raise ValueError("need at least one split and lower <= upper")
    cuts = sorted({lower + (upper - lower) * i // splits for i in range(1, splits)})
    if not cuts:
        return ["1 = 1"]
    first = f"({column} < {cuts[0]} OR {column} IS NULL)"
    middle = [f"{column} >= {a} AND {column} < {b}" for a, b in zip(cuts, cuts[1:])]
    return [first, *middle, f"{column} >= {cuts[-1]}"]


def modulo_predicates(column: str, splits: int) -> list[str]:
    """``splits`` conditions on the remainder; negative values and NULL included."""
    if splits < 1:
        raise ValueError("need at least one split")
    rest = [f"ABS(MOD({column}, {splits})) = {i}" for i in range(splits)]
    return [f"({rest[0]} OR {column} IS NULL)", *rest[1:]]


CELLS = 16  # quantiles for each split


def quantile_predicates(df: DataFrame, column: str, splits: int, second: str | None = None) -> list[str]:
    """Conditions of about equal numbers of rows that each row meets exactly one of.

    Cuts are taken from approximate quantiles, ``CELLS`` for each split, of one aggregation.
    NULL has a split of its own where it occurs. A value that fills more than a split is cut
    by the remainder of ``second``, a whole number, where it is given; there are then more
    conditions than ``splits``, none of them larger.
    """
    if splits < 1:
        raise ValueError("need at least one split")
    cells = splits * CELLS
    found = df.agg(
        F.percentile_approx(column, [i / cells for i in range(1, cells)], 100 * cells).alias("cuts"),
        F.max(F.col(column).isNull()).alias("unset"),
    ).first()
    cuts, conditions, low, last, weight = found["cuts"] or [], [], None, None, 0

    def close(condition: str) -> None:
        conditions.append(f"{column} > {low} AND {condition}" if low is not None else condition)

    for value, times in sorted(Counter(cuts).items()):
        text = _literal(value)
        if times > CELLS:
            close(f"{column} < {text}")
            parts = -(-(times + 1) // CELLS) if second else 1
            rest = [f" AND ABS(MOD({second}, {parts})) = {i}" for i in range(parts)] if parts > 1 else [""]
            if parts > 1:
                rest[0] = f" AND (ABS(MOD({second}, {parts})) = 0 OR {second} IS NULL)"
            conditions += [f"{column} = {text}{r}" for r in rest]
            low, last, weight = text, None, 0
        elif weight + times > CELLS:
            close(f"{column} <= {last}")
            low, last, weight = last, text, times
        else:
            last, weight = text, weight + times
    close(f"{column} IS NOT NULL")
    return conditions + ([f"{column} IS NULL"] if found["unset"] or found["unset"] is None else [])


def _literal(value) -> str:
    if isinstance(value, datetime):
        return f"TIMESTAMP '{value.isoformat(sep=' ')}'"
    return f"DATE '{value.isoformat()}'" if isinstance(value, date) else str(value)


def split_id(predicates: Sequence[str]) -> Column:
    """Number of the split a row falls into."""
    number = F.when(F.expr(predicates[0]), F.lit(0))
    for i, predicate in enumerate(predicates[1:], start=1):
        number = number.when(F.expr(predicate), F.lit(i))
    return number


def jdbc_options(url: str, options: Mapping[str, str] | None = None, setup: str | None = None) -> dict:
    """Reader options; ``setup`` is a statement run when a connection opens, such as one
    that asks for reads without locks."""
    chosen = {"url": url, "fetchsize": str(FETCH_SIZE), **(options or {})}
    if setup:
        chosen["sessionInitStatement"] = setup
    return chosen


def read_query(
    spark: SparkSession, url: str, query: str, options: Mapping[str, str] | None = None
) -> DataFrame:
    """Any query of the source. It runs there; filters and columns on top are pushed."""
    return spark.read.format("jdbc").options(**jdbc_options(url, options)).option("query", query).load()


def read_table(
    spark: SparkSession,
    url: str,
    table: str,
    predicates: Sequence[str] = (),
    options: Mapping[str, str] | None = None,
    lock_rows: str | None = None,
) -> DataFrame:
    """A source table, one task per predicate."""
    chosen = jdbc_options(url, options, lock_rows)
    if not predicates:
        return spark.read.format("jdbc").options(**chosen).option("dbtable", table).load()
    url = chosen.pop("url")
    return spark.read.jdbc(url, table, predicates=list(predicates), properties=chosen)


def read_range(
    spark: SparkSession,
    url: str,
    table: str,
    column: str,
    lower: int,
    upper: int,
    splits: int = MAX_CONNECTIONS,
    options: Mapping[str, str] | None = None,
) -> DataFrame:
    """A source table in ranges of a number, date or timestamp column, by Spark's own split."""
    return (
        spark.read.format("jdbc")
        .options(**jdbc_options(url, options))
        .option("dbtable", table)
        .option("partitionColumn", column)
        .option("lowerBound", lower)
        .option("upperBound", upper)
        .option("numPartitions", splits)
        .load()
    )
