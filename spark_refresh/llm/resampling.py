"""Importance resampling towards a target distribution, with text counted by distinct lines.

Words are runs of letters, digits and code points from U+0080, with A to Z in lower case;
features are runs of 1 to ``longest`` words, hashed into buckets. New lines separate words, so
a text is cut into its lines:

1. Equal lines become one row with the number of their occurrences. The buckets of a distinct
   line are found once; its counts times its occurrences are the corpus counts. Runs of words
   that cross a line's end (``longest`` above 1) are counted per document and added.
2. A bucket's gain compares target and corpus. Each distinct line gets the sum of its gains
   once; a document adds up its lines' sums and those of its crossing runs.
3. The draw orders documents by weight plus Gumbel noise from a keyed hash of the id, so the
   best ones are a sample without replacement in proportion to their weights.

Only tables of a number per bucket or score reach the driver. Lines that hold more than a thousandth of
all line rows (at most 1000 of them) are broadcast, so no line is a hot key; the others are
joined by shuffling. Ranks are made within equal scores, which are whole numbers.

Null texts have no features; texts without features weigh 0. A null id draws with the hash of
the empty id and comes last among ties. Repeated rows are documents of their own, each with a
rank of its own. An empty table gives no rows; an empty target has counts of 0.
"""

from __future__ import annotations

from collections.abc import Iterator

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import stored

BUCKETS = 10_000
SEED = 2024
PERCENT = 10
FEWEST_WORDS = 20
HOT_SHARE = 1000  # a line with more than this part of all line rows is hot
SALTS = 64  # parts of the rows of one id and score
REMEMBERED = 1_000_000  # buckets of features, in a Python worker

#: Bytes of words stay, A to Z become a to z, others separate.
WORD_BYTES = bytes(
    c if 48 <= c <= 57 or 97 <= c <= 122 or c >= 128 else c + 32 if 65 <= c <= 90 else 32 for c in range(256))


class Buckets(dict):
    """Buckets of features, each hashed once while it is remembered."""

    def __init__(self, number: int) -> None:
        self.number = number

    def __missing__(self, feature: bytes) -> int:
        import zlib

        if len(self) >= REMEMBERED:
            self.clear()
        bucket = self[feature] = zlib.crc32(feature) % self.number
        return bucket


def words_of(raw: bytes) -> list[bytes]:
    return raw.translate(WORD_BYTES).split()


def runs(words: list[bytes], longest: int) -> Iterator[bytes]:
    """All runs of 1 to ``longest`` words."""
    yield from words
    for length in range(2, longest + 1):
        for i in range(len(words) - length + 1):
            yield b" ".join(words[i : i + length])


def crossing_runs(lines: list[list[bytes]], longest: int) -> Iterator[bytes]:
    """The runs of the lines' words, put together, that lie in more than one line."""
    words = [w for line in lines for w in line]
    of = [i for i, line in enumerate(lines) for _ in line]
    for length in range(2, longest + 1):
        for i in range(len(words) - length + 1):
            if of[i] != of[i + length - 1]:
                yield b" ".join(words[i : i + length])


def _kind(buckets: int) -> str:
    return "<u2" if buckets <= 1 << 16 else "<u4"


def _cut(buckets: int, longest: int):
    """(h, g, n, line) to (h, g, n, words, buckets)."""

    def cut(batches: Iterator) -> Iterator:
        import numpy as np
        import pyarrow as pa

        known, kind = Buckets(buckets), _kind(buckets)
        for batch in batches:
            numbers, held = [], []
            for raw in batch.column(3).cast(pa.binary()).to_pylist():
                words = words_of(raw)
                numbers.append(len(words))
                held.append(np.fromiter(map(known.__getitem__, runs(words, longest)), kind).tobytes())
            yield pa.RecordBatch.from_arrays(
                [*batch.columns[:3], pa.array(numbers, pa.int64()), pa.array(held, pa.binary())], names=["h", "g", "n", "words", "buckets"])

    return cut


def _crossing(buckets: int, longest: int):
    """(row, text) to (row, buckets) of the runs that cross lines."""

    def cut(batches: Iterator) -> Iterator:
        import numpy as np
        import pyarrow as pa

        known, kind = Buckets(buckets), _kind(buckets)
        for batch in batches:
            held = [
                np.fromiter(map(known.__getitem__, crossing_runs([words_of(line) for line in raw.split(b"\n")], longest)), kind).tobytes()
                for raw in batch.column(1).cast(pa.binary()).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(held, pa.binary())], names=["row", "buckets"])

    return cut


def _counts(buckets: int):
    """(n, buckets) to (bucket, times) over all rows of a task: each row counts n times."""

    def count(batches: Iterator) -> Iterator:
        import numpy as np
        import pyarrow as pa

        total, kind = np.zeros(buckets, np.int64), _kind(buckets)
        for batch in batches:
            for n, raw in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                found, times = np.unique(np.frombuffer(raw, kind), return_counts=True)
                total[found] += n * times
        at = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(at), pa.array(total[at])], names=["bucket", "times"])

    return count


def _gained(buckets: int, gains: list[int]):
    """(..., buckets) to (..., features, gain): the number and the sum of gains of each row's features."""

    def gained(batches: Iterator) -> Iterator:
        import numpy as np
        import pyarrow as pa

        table, kind = np.array(gains, np.int64), _kind(buckets)
        for batch in batches:
            found = [np.frombuffer(raw, kind) for raw in batch.column(batch.num_columns - 1).to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [*batch.columns[:-1], pa.array([len(f) for f in found], pa.int64()), pa.array([int(table[f].sum()) for f in found], pa.int64())],
                names=[*batch.schema.names[:-1], "features", "gain"])

    return gained


def bucket_counts(lines: DataFrame, crossing: DataFrame | None, buckets: int) -> list[int]:
    """How often each bucket occurs, from lines (``n``, ``buckets``) and runs that cross them."""
    rows = lines.select("n", "buckets")
    if crossing is not None:
        rows = rows.unionByName(crossing.select(F.lit(1).cast("long").alias("n"), "buckets"))
    counted = rows.mapInArrow(_counts(buckets), "bucket bigint, times bigint").groupBy("bucket").agg(F.sum("times").alias("times"))
    out = [0] * buckets
    for r in counted.collect():
        out[r["bucket"]] = r["times"]
    return out


def line_table(texts: DataFrame, text: str, buckets: int, longest: int) -> DataFrame:
    """``h``, ``g`` (128 bits of hash), ``n`` (occurrences), ``words``, ``buckets`` of each distinct line."""
    lines = texts.select(F.explode(F.split(texts[text].cast("string"), "\n", -1)).alias("line")).where("line != ''")
    distinct = lines.groupBy("line").agg(F.count("*").alias("n"))
    keyed = distinct.select(*_key(F.col("line")), "n", "line")
    return stored(keyed.mapInArrow(_cut(buckets, longest), "h bigint, g bigint, n bigint, words bigint, buckets binary"), "lines")


def _key(line: Column) -> list[Column]:
    return [F.xxhash64(line).alias("h"), F.xxhash64(F.lit(1), line).alias("g")]


def crossing_table(texts: DataFrame, row: str, text: str, buckets: int, longest: int) -> DataFrame | None:
    """``row`` and ``buckets`` of the runs that cross lines; none where all runs are single words."""
    if longest < 2:
        return None
    several = texts.select(texts[row].alias("row"), texts[text].cast("string").alias("text")).where(F.instr("text", "\n") > 0)
    return stored(several.mapInArrow(_crossing(buckets, longest), "row bigint, buckets binary"), "crossing")


def gains_of(target: list[int], corpus: list[int]) -> list[int]:
    import math

    t_all, s_all, buckets = sum(target), sum(corpus), len(corpus)
    return [
        math.floor(1000 * math.log((t + 1) * (s_all + buckets) / ((s + 1) * (t_all + buckets))))
        for t, s in zip(target, corpus, strict=True)]


def noise(doc_id: Column, seed: int) -> Column:
    """Gumbel noise in thousandths, from the id alone."""
    named = F.concat(F.lit(f"{seed}:"), F.coalesce(doc_id.cast("string"), F.lit("")))
    h = F.conv(F.left(F.sha2(F.encode(named, "UTF-8"), 256), F.lit(8)), 16, 10).cast("long")
    return F.floor(-1000 * F.log(-F.log((h + F.lit(0.5)) / F.lit(4294967296.0))))


def weighed(
    df: DataFrame, target: DataFrame, doc_id: str = "doc_id", text: str = "text", target_text: str = "text",
    longest: int = 1, buckets: int = BUCKETS,
) -> DataFrame:
    """``row``, ``doc_id``, ``n_words``, ``n_features``, ``weight`` of each row of ``df``."""
    body = F.coalesce(df[text].cast("string"), F.lit(""))
    some = F.filter(F.split(body, "\n", -1), lambda x: x != "")
    keys = F.transform(some, lambda x: F.struct(*_key(x)))
    whole = df.select(F.monotonically_increasing_id().alias("row"), df[doc_id].alias("doc_id"), body.alias("text"), keys.alias("keys"))
    if longest > 1:  # the texts are read again by their row numbers
        whole = stored(whole, "texts")
    documents = stored(whole.select("row", "doc_id", "keys"), "documents") if longest < 2 else whole
    lines = line_table(df, text, buckets, longest)
    crossing = crossing_table(whole, "row", "text", buckets, longest) if longest > 1 else None
    corpus = bucket_counts(lines, crossing, buckets)
    numbered = target.select(F.monotonically_increasing_id().alias("row"), target[target_text].cast("string").alias("text"))
    wanted = stored(numbered, "target") if longest > 1 else numbered
    target_counts = bucket_counts(
        line_table(wanted, "text", buckets, longest), crossing_table(wanted, "row", "text", buckets, longest), buckets)
    gains = gains_of(target_counts, corpus)

    rated = stored(lines.mapInArrow(
        _gained(buckets, gains), "h bigint, g bigint, n bigint, words bigint, features bigint, gain bigint"), "rated")
    places = rated.agg(F.coalesce(F.sum("n"), F.lit(0)).alias("n")).first()["n"]
    hot = F.col("n") > F.lit(places // HOT_SHARE)
    refs = documents.select("row", F.explode("keys").alias("key")).select("row", "key.h", "key.g")
    few = F.broadcast(rated.where(hot).drop("n"))  # at most HOT_SHARE lines
    sums = ["words", "features", "gain"]
    parts = refs.join(few, ["h", "g"]).select("row", *sums).unionByName(
        refs.join(few, ["h", "g"], "left_anti").join(rated.where(~hot).drop("n"), ["h", "g"]).select("row", *sums))
    if crossing is not None:
        crossed = crossing.mapInArrow(_gained(buckets, gains), "row bigint, features bigint, gain bigint")
        parts = parts.unionByName(crossed.select("row", F.lit(0).cast("long").alias("words"), "features", "gain"))
    summed = parts.groupBy("row").agg(*(F.sum(c).alias(c) for c in sums))
    features = F.coalesce("features", F.lit(0))
    return documents.select("row", "doc_id").join(summed, "row", "left").select(
        "row", "doc_id", F.coalesce("words", F.lit(0)).alias("n_words"), features.alias("n_features"),
        F.when(features > 0, F.floor(F.col("gain") / features)).otherwise(0).cast("long").alias("weight"))


def resample(
    df: DataFrame, target: DataFrame, doc_id: str = "doc_id", text: str = "text", target_text: str = "text", longest: int = 1,
    buckets: int = BUCKETS, seed: int = SEED, percent: int = PERCENT, fewest_words: int = FEWEST_WORDS,
) -> DataFrame:
    """``doc_id``, ``n_features``, ``weight``, ``score``, ``rank`` (null if not drawn) of each row."""
    weights = weighed(df, target, doc_id, text, target_text, longest, buckets)
    scored = stored(weights.withColumn("score", F.col("weight") + noise(F.col("doc_id"), seed)), "scored")
    eligible = scored.where(F.col("n_words") >= fewest_words)
    drawn = eligible.count() * percent // 100
    # places before each score: whole numbers, whose range the logarithms bound
    places, starts = 0, []
    for r in sorted(eligible.groupBy("score").agg(F.count("*").alias("n")).collect(), reverse=True):
        if places < drawn:
            starts.append((r["score"], places))
        places += r["n"]
    starts = F.broadcast(scored.sparkSession.createDataFrame(starts, "score bigint, start bigint"))
    # the rows of one id and score are numbered in salted parts
    part = F.pmod(F.xxhash64("row"), F.lit(SALTS)).alias("part")
    rows = eligible.join(starts.select("score"), "score", "left_semi").select("row", "score", "doc_id", part)
    same = ["score", "doc_id", "part"]
    order = [F.asc_nulls_last("doc_id"), "part"]
    groups = rows.groupBy(*same).agg(F.count("*").alias("members"))
    earlier = Window.partitionBy("score").orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    groups = groups.join(starts, "score").select(*same, (F.col("start") + F.coalesce(F.sum("members").over(earlier), F.lit(0))).alias("before"))
    groups = groups.select(F.col("score").alias("s"), F.col("doc_id").alias("d"), F.col("part").alias("p"), "before")
    met = (F.col("score") == F.col("s")) & F.col("doc_id").eqNullSafe(F.col("d")) & (F.col("part") == F.col("p"))
    nth = F.row_number().over(Window.partitionBy(*same).orderBy("row"))
    ranked = rows.withColumn("nth", nth).join(groups, met).select("row", (F.col("before") + F.col("nth")).cast("long").alias("rank")).where(F.col("rank") <= drawn)
    return scored.join(ranked, "row", "left").select("doc_id", "n_features", "weight", "score", "rank")
