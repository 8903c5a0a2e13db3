"""Shards of near equal size by sampled splitters, with built-in functions only.

Records are ordered by (hash of the text, hash of the id, row number), so equal texts lie
together. A sample of keys, drawn in proportion to size, gives quantile boundaries; each record falls into a range by a
binary search in them. The exact size of each range and of what lies before it in its range
give each record its place in the whole order, and the shard is the share of all bytes at
that place. A group of equal texts stays whole while it is small against a shard; larger
groups are cut, as their range would be overfull.

Null texts have size 1, like empty ones, and checksum 0. Null ids are as any other id.
Repeated rows (equal text and id) are numbered in any order among themselves, which changes
no column. An empty table gives no rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import stored

KEPT_WHOLE = 0.002  # of a shard's bytes: a larger group of equal texts may be cut
PER_RANGE = 24  # sampled keys for each range
FEWEST, MOST = 256, 16384  # ranges
ROWS = 500_000  # in a range, about


def binary_search(keys: list, key: Column) -> Column:
    """How many of the sorted ``keys`` are at or below ``key``, by halving steps."""
    if not keys:
        return F.lit(0)
    steps = [1 << i for i in range(len(keys).bit_length() - 1, -1, -1)]
    sorted_keys = F.arrays_zip(*(longs([k[i] for k in keys]).alias(name) for i, name in enumerate("hdr")))

    def step(at: Column, width: Column) -> Column:
        inside = (at + width) <= len(keys)
        return F.when(inside & (F.get(sorted_keys, at + width - 1) <= key), at + width).otherwise(at)

    return F.reduce(F.array(*map(F.lit, steps)), F.lit(0), step)


def longs(values: list[int]) -> Column:
    """A constant array; Spark folds it once, as it does not fold parsed text."""
    return F.expr(f"array({', '.join(f'{v}L' if v > -(1 << 63) else 'bigint(-9223372036854775808)' for v in values)})")


LOWEST = -(1 << 63)


def splitters(sized: DataFrame, ranges: int, total: int) -> list[tuple[int, int, int]]:
    """Boundaries of about equal bytes from a size-weighted sample of bounded number.

    A hash that is drawn for several boundaries belongs to a group larger than a range: only
    such groups are cut, by id, and rows of one text and id by their numbers.
    """
    wanted = ranges * PER_RANGE
    share = F.col("size") * F.lit(wanted / max(total, 1))
    drawn = F.pmod(F.xxhash64("r", F.lit("draw")), F.lit(1 << 30)) / F.lit(1 << 30) < F.least(F.lit(1.0), share)
    weight = F.greatest(F.lit(1.0), share)
    sample = sorted(tuple(r) for r in sized.where(drawn).select("h", "d", "r", weight).collect())
    step, reached, chosen = sum(s[3] for s in sample) / ranges, 0.0, []
    for h, d, r, w in sample:
        if reached + w >= step * (len(chosen) + 1) and len(chosen) < ranges - 1:
            chosen.append((h, d, r))
        reached += w
    texts = {a[0] for a, b in zip(chosen, chosen[1:], strict=False) if a[0] == b[0]}
    rows = {a[:2] for a, b in zip(chosen, chosen[1:], strict=False) if a[:2] == b[:2]}
    return sorted({(h, d if h in texts else LOWEST, r if (h, d) in rows else LOWEST) for h, d, r in chosen})


def shard(df: DataFrame, doc_id: str = "doc_id", text: str = "text", shards: int = 8) -> DataFrame:
    """``doc_id``, ``size``, ``text_crc32``, ``law``, ``shard``, ``slot``, ``grown_shard`` of each record."""
    body = df[text].cast("string")
    raw = F.encode(F.coalesce(body, F.lit("")), "UTF-8")
    size = F.coalesce(F.octet_length(body), F.lit(0)).cast("long") + 1
    sized = stored(
        df.select(df[doc_id].alias("doc_id"), size.alias("size"), F.crc32(raw).alias("text_crc32"),
                  F.xxhash64(body).alias("h"), F.xxhash64(df[doc_id]).alias("d"), F.monotonically_increasing_id().alias("r")),
        "sized",
    )
    found = sized.agg(F.count("*").alias("n"), F.sum("size").alias("size")).first()
    rows, total = found["n"], found["size"] or 0
    ranges = max(FEWEST, min(MOST, rows // ROWS))
    chosen = splitters(sized, ranges, total)

    ranged = sized.withColumn("range", binary_search(chosen, F.struct("h", "d", "r")))
    within = Window.partitionBy("range").orderBy("h", "d", "r")
    so_far = within.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    group = Window.partitionBy("range", "h")
    placed = stored(
        ranged.select(
            "*", F.row_number().over(within).cast("long").alias("nth"), (F.sum("size").over(so_far) - F.col("size")).alias("at"),
        ).select("*", F.min("at").over(group).alias("group_at"), F.sum("size").over(group).alias("group_size")),
        "placed",
    )
    sums = {r["range"]: (r["n"], r["b"]) for r in placed.groupBy("range").agg(F.count("*").alias("n"), F.sum("size").alias("b")).collect()}
    rows_before, bytes_before, n, b = [], [], 0, 0
    for i in range(len(chosen) + 1):
        rows_before.append(n)
        bytes_before.append(b)
        n, b = n + sums.get(i, (0, 0))[0], b + sums.get(i, (0, 0))[1]

    often = sorted({h for h, d, _ in chosen if d != LOWEST})
    cut = (F.col("group_size") > F.lit(KEPT_WHOLE * total / shards)) | F.col("h").isin(often)
    start = F.when(cut, F.col("at")).otherwise(F.col("group_at")) + F.get(longs(bytes_before), F.col("range"))
    number = F.least(F.lit(shards - 1), F.floor(start * shards / F.lit(max(total, 1)))).cast("int")
    located = placed.withColumn("shard", number).withColumn("nth", F.col("nth") - 1 + F.get(longs(rows_before), F.col("range")))
    first = {r["shard"]: r["nth"] for r in located.groupBy("shard").agg(F.min("nth").alias("nth")).collect()}
    starts = longs([first.get(i, 0) for i in range(shards)])
    return located.select(
        "doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard",
        (F.col("nth") - F.get(starts, F.col("shard"))).alias("slot"), F.lit(None).cast(T.IntegerType()).alias("grown_shard"),
    )
