"""Document fingerprints: bottom-k sketches of shingle hashes, with built-in functions only.

A shingle is a run of ``SHINGLE`` words (letters and digits in lower case); a text of fewer
words is one shingle. The sketch of a text holds the ``SIZE`` smallest of its distinct shingle
hashes, in order. Sketches of parts merge into the sketch of the whole: the smallest of all.
Two sketches estimate the resemblance of their texts (the share of shingles both have among
those any has), how much of one is contained in the other, and the number of distinct
shingles; all three are exact while a text has fewer shingles than the sketch has places.

Null texts count as empty; texts without words have an empty sketch, which is like another
empty one (1) and unlike any other (0). An empty table gives no rows.

``edited`` compares each document with a text made of it and of the next one in descending
order of ids (after the last comes the first). Documents are stored with a row number and go
to ranges of (id, hash of the text, row number), found by binary search among the bounds of a
sample in proportion to size, so rows of one id are no hot group. Each meets its neighbour
within its range, where the largest row of the range before is a guest. Null ids come last,
equal ids in the order of their hashes, equal rows in any.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import stored, text_or_empty

SHINGLE = 5
SIZE = 128
FAN_IN = 64  # sketches merged in one group
BYTES = 24_000_000  # of text in a range, about, between the numbers of ranges below
FEWEST, MOST = 512, 16_384
PER_RANGE = 24  # sampled rows for each range
BREAK = r"[^\p{L}\p{N}]+"


def shingle_hashes(text: Column, words: int = SHINGLE) -> Column:
    """The hashes of a text's shingles, repeats included."""
    cut = F.filter(F.split(F.lower(text), BREAK), lambda w: w != "")

    def of(found: Column) -> Column:
        starts = F.sequence(F.lit(1), F.greatest(F.size(found) - words + 1, F.lit(1)))
        return F.when(F.size(found) > 0, F.transform(starts, lambda i: F.xxhash64(F.slice(found, i, words)))).otherwise(
            F.array().cast("array<bigint>"))

    # bound to a name of its own, so that the words are cut once
    return F.element_at(F.transform(F.array(cut), of), 1)


def sketch(text: Column, size: int = SIZE, words: int = SHINGLE) -> Column:
    """The bottom-k sketch of a text: its smallest distinct shingle hashes in order."""
    return smallest(shingle_hashes(text, words), size)


def smallest(hashes: Column, size: int = SIZE) -> Column:
    return F.slice(F.sort_array(F.array_distinct(hashes)), 1, size)


def merged(one: Column, other: Column, size: int = SIZE) -> Column:
    """The sketch of what two sketches stand for together."""
    return smallest(F.concat(one, other), size)


def merge_groups(df: DataFrame, keys: list[str], column: str = "sketch", size: int = SIZE) -> DataFrame:
    """``keys`` and the sketch of each group's sketches together (``sketch``).

    Groups of any size are merged in rounds of parts of about ``FAN_IN`` sketches.
    """
    rows = stored(df.select(*keys, F.col(column).alias("sketch"), F.monotonically_increasing_id().alias("_row")), "sketches")
    most = rows.groupBy(*keys).agg(F.count("*").alias("n")).agg(F.max("n")).first()[0] or 0
    while True:
        parts = -(-most // FAN_IN)
        part = F.pmod(F.xxhash64("_row"), F.lit(max(parts, 1))).alias("_part")
        together = rows.groupBy(*keys, part).agg(smallest(F.flatten(F.collect_list("sketch")), size).alias("sketch"))
        if parts <= 1:
            return together.select(*keys, "sketch")
        rows, most = stored(together.select(*keys, "sketch", F.col("_part").alias("_row")), "sketches"), parts


def resemblance(one: Column, other: Column, size: int = SIZE) -> Column:
    """Estimated share of the shingles of either text that both have, from their sketches."""
    both = smallest(F.concat(one, other), size)
    shared = F.size(F.array_intersect(F.array_intersect(both, one), other))
    empty = (F.size(one) == 0) & (F.size(other) == 0)
    return F.when(empty, 1.0).otherwise(shared / F.greatest(F.size(both), F.lit(1))).cast("double")


def distinct_count(one: Column, size: int = SIZE) -> Column:
    """Estimated number of distinct shingles."""
    # the hashes are spread over 2^64: the share of that up to the largest one kept
    reached = (F.element_at(one, -1).cast("double") + F.lit(9223372036854775808.0)) / F.lit(18446744073709551616.0)
    return F.when(F.size(one) < size, F.size(one).cast("double")).otherwise((size - 1) / reached)


def containment(one: Column, other: Column, size: int = SIZE) -> Column:
    """Estimated share of the first text's shingles that the second has too (1 for an empty first text)."""
    shared = resemblance(one, other, size) * distinct_count(merged(one, other, size), size)
    return F.when(F.size(one) == 0, 1.0).otherwise(F.least(F.lit(1.0), shared / distinct_count(one, size)))


def as_text(one: Column) -> Column:
    """A sketch as text: hexadecimal numbers in order."""
    return F.array_join(F.transform(one, lambda h: F.lower(F.hex(h))), " ")


def fingerprints(df: DataFrame, doc_id: str = "doc_id", text: str = "text", size: int = SIZE) -> DataFrame:
    """``doc_id``, ``n_chars``, ``sketch`` of each document."""
    body = text_or_empty(text)
    return df.select(df[doc_id].alias("doc_id"), F.char_length(body).cast("long").alias("n_chars"), sketch(body, size).alias("sketch"))


def bounds(rows: DataFrame, ranges: int, total: int) -> list[tuple]:
    """Keys (id, hash, row number) that cut the rows into ranges of about equal size, from a sample of bounded number."""
    share = F.col("size") * F.lit(ranges * PER_RANGE / max(total, 1))
    drawn = F.pmod(F.xxhash64("row", F.lit("draw")), F.lit(1 << 30)) / F.lit(1 << 30) < F.least(F.lit(1.0), share)
    sample = [tuple(r) for r in rows.where(drawn).select("doc_id", "hash", "row", F.greatest(F.lit(1.0), share)).collect()]
    sample.sort(key=lambda r: (r[0] is not None, *r[:3]) if r[0] is not None else (False, 0, *r[1:3]))
    step, reached, chosen = sum(r[3] for r in sample) / ranges, 0.0, []
    for *key, weight in sample:
        if reached + weight >= step * (len(chosen) + 1) and len(chosen) < ranges - 1:
            chosen.append(tuple(key))
        reached += weight
    return chosen


def range_of(keys: list[tuple], id_type: str) -> Column:
    """How many of the sorted keys are at or below that of the row, by halving steps."""
    if not keys:
        return F.lit(0)
    sorted_keys = F.array(*(
        F.struct(F.lit(d).cast(id_type).alias("doc_id"), F.lit(h).cast("long").alias("hash"), F.lit(r).cast("long").alias("row")) for d, h, r in keys))
    own = F.struct("doc_id", "hash", "row")

    def step(at: Column, width: Column) -> Column:
        inside = (at + width) <= len(keys)
        return F.when(inside & (F.get(sorted_keys, at + width - 1) <= own), at + width).otherwise(at)

    return F.reduce(F.array(*(F.lit(1 << i) for i in range(len(keys).bit_length() - 1, -1, -1))), F.lit(0), step)


def with_next(df: DataFrame, doc_id: str = "doc_id", text: str = "text", size: int = SIZE) -> DataFrame:
    """``doc_id``, ``text``, ``sketch`` and the ``next_text``, ``next_sketch`` of the next document in descending order of ids."""
    body = F.coalesce(df[text].cast("string"), F.lit(""))
    base = stored(
        df.select(df[doc_id].alias("doc_id"), F.monotonically_increasing_id().alias("row"), F.xxhash64(body).alias("hash"),
                  (F.octet_length(body) + 64).cast("long").alias("size"), body.alias("text")), "texts", "zstd")
    total = base.agg(F.sum("size").alias("size")).first()["size"] or 0
    keys = bounds(base, max(FEWEST, min(MOST, total // BYTES)), total)
    ranged = base.withColumn("range", range_of(keys, base.schema["doc_id"].dataType.simpleString()))
    largest = ranged.groupBy("range").agg(F.max(F.struct("doc_id", "hash", "row")).alias("key")).select("range", "key.row").collect()
    spark, lasts = df.sparkSession, sorted((r["range"], r["row"]) for r in largest)
    after = [(lasts[i - 1][1], lasts[i][0]) for i in range(len(lasts))]
    guests = F.broadcast(spark.createDataFrame(after, "guest bigint, guest_range int"))  # one for each range
    places = F.filter(F.array(F.struct(F.col("range"), F.lit(False).alias("visits")), F.struct(F.col("guest_range").alias("range"), F.lit(True).alias("visits"))),
                      lambda p: p["range"].isNotNull())
    met = ranged.join(guests, F.col("row") == F.col("guest"), "left").select("doc_id", "hash", "row", "text", F.explode(places).alias("place")).select(
        "doc_id", "hash", "row", "text", "place.range", "place.visits")
    order = Window.partitionBy("range").orderBy(F.desc("visits"), F.asc_nulls_first("doc_id"), "hash", "row")
    sketched = met.withColumn("next_text", F.lag("text").over(order)).withColumn("sketch", sketch(F.col("text"), size))
    paired = sketched.withColumn("next_sketch", F.lag("sketch").over(order)).where("NOT visits")
    return paired.select("doc_id", "text", "sketch", "next_text", "next_sketch")


def edited(df: DataFrame, doc_id: str = "doc_id", text: str = "text", size: int = SIZE) -> DataFrame:
    """``doc_id``, ``n_chars``, ``edited_sha256``, ``fingerprint``, ``edited_fingerprint``, ``near_edited``, ``near_next``."""
    paired = with_next(df, doc_id, text, size).withColumn("n_chars", F.char_length("text").cast("long"))
    half = F.floor(F.col("n_chars") / 2).cast("int")
    kept = F.left(F.col("text"), F.col("n_chars").cast("int") - half)
    changed = paired.withColumn("edited", F.concat(kept, F.left(F.col("next_text"), half)))
    both = changed.withColumn("edited_sketch", sketch(F.col("edited"), size))
    return both.select(
        "doc_id", "n_chars", F.sha2(F.encode("edited", "UTF-8"), 256).alias("edited_sha256"),
        as_text(F.col("sketch")).alias("fingerprint"), as_text(F.col("edited_sketch")).alias("edited_fingerprint"),
        resemblance(F.col("sketch"), F.col("edited_sketch"), size).alias("near_edited"),
        resemblance(F.col("sketch"), F.col("next_sketch"), size).alias("near_next"))
