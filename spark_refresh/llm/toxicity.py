"""Toxicity by class-conditional Kneser-Ney models of characters.

Both classes back off to the same Kneser-Ney model, whose counts come from all documents; so
an expression that a class has not seen costs both the same, and what tells the classes apart
are the sequences they have seen. A sequence is up to ``ORDER`` characters that end at one
character of a word; it stays within the word, whose start and end count as characters.

1. Distinct words are counted, in all documents and per class. Sequences and their counts are
   derived from that table, whose rows are far fewer than the words of the texts.
2. Sums over contexts and joins of the orders, as Spark jobs, give each sequence that a class
   has seen the context of the logarithm of the ratio of both models; others have ratio 1.
3. A word's value is the sum of its sequences'. Every text gets the values of all its words:
   where the model has at most ``BROADCAST_SEQUENCES`` rows, they are sent to the tasks, which
   value each distinct word once; a larger model stays a table, which blocks of documents of
   about ``BLOCK`` characters join with the sequences of their words. Both give the same.
4. The score departs from a plain difference of log-likelihoods by length in one way: the
   median word's value (what the text's language and kind of prose give) is subtracted from
   each word's. The mean of what is left, and the mean of what lies beyond 1, become a
   probability by a logistic function fitted on at most ``FITTED`` labelled rows that its
   model has not seen.

Null and empty texts have no sequence: their score is that of a difference of 0. Rows with a
null id are scored and never learned from. Of several labels of one id the largest counts.
Without rows of both labels every score is the share of label 1 (0 without labels). Repeated
rows are scored alike; an empty table gives no rows.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import stored

ORDER = 6
BITS = 21  # of a code point; a sequence is two numbers of three code points
HALF = 3
SYMBOL = (1 << BITS) - 1
DISCOUNT = 0.75
BLOCK = 14_000_000  # characters of text that are scored together; a longer text is a block by itself
BROADCAST_SEQUENCES = 4_000_000  # of 12 bytes
FITTED = 20_000
BROADCAST_LABELS = 1_000_000  # rows, of 16 bytes; more labels are joined by shuffling
SHARED = 50.0  # counts by which the shared probability weighs in a class
GAP = 32  # what stands before the first and after the last character of a word
COUNTS = ("t0", "o0", "t1", "o1")  # toxic and ordinary, in the part to learn from and the part to fit on
GATHERED = 600_000  # words in a task before they go on
REMEMBERED = 600_000  # values of words, in a Python worker
WORD = re.compile(r"[^\W_]+")


def words_of(text: str | None) -> list[str]:
    return WORD.findall(text.lower()) if text else []


def sequences_of(words: list[str]):
    """(high, low, first): both halves of the sequence that ends at each character, and where each word starts."""
    import numpy as np

    codes = np.frombuffer((" ".join(words) + " ").encode("utf-32-le"), np.uint32).astype(np.int64)
    ends = np.flatnonzero(codes == GAP)
    first = np.concatenate((np.zeros(1, np.int64), ends[:-1] + 1))
    inside = np.arange(len(codes)) - np.repeat(first, ends + 1 - first)
    padded = np.concatenate((np.full(ORDER - 1, GAP, np.int64), codes))
    halves = []
    for half in range(ORDER // HALF):
        packed = np.zeros(len(codes), np.int64)
        for i in range(half * HALF, (half + 1) * HALF):
            packed = packed << BITS | np.where(inside >= ORDER - 1 - i, padded[i : i + len(codes)], GAP)
        halves.append(packed)
    return halves[0], halves[1], first


def key_of(high, low):
    """A 64-bit hash of each sequence."""
    import numpy as np

    with np.errstate(over="ignore"):
        x = high.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15) + low.astype(np.uint64)
        x = (x ^ x >> np.uint64(33)) * np.uint64(0xFF51AFD7ED558CCD)
        x = (x ^ x >> np.uint64(29)) * np.uint64(0xC4CEB9FE1A85EC53)
        x += low.astype(np.uint64) * np.uint64(0xD6E8FEB86659FD93)
        return (x ^ x >> np.uint64(32)).view(np.int64)


# -- counts


def count_words(labelled: DataFrame) -> DataFrame:
    """``word``, ``n`` and the four COUNTS from rows (text, kind): kind is a place in COUNTS, or null."""
    import pyarrow as pa

    none = len(COUNTS)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = [Counter() for _ in range(none + 1)]

        def ended():
            for kind, found in enumerate(held):
                if found:
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(list(found), pa.string()), pa.array([kind] * len(found), pa.int32()), pa.array(list(found.values()), pa.int64())],
                        names=["word", "kind", "n"])
                    found.clear()

        for batch in batches:
            for text, kind in zip(batch.column(0), batch.column(1).to_pylist(), strict=True):
                held[none if kind is None else kind].update(words_of(text.as_py()))
                if sum(map(len, held)) >= GATHERED:
                    yield from ended()
        yield from ended()

    partial = labelled.select("text", "kind").mapInArrow(count, "word string, kind int, n bigint")
    kinds = (F.sum(F.when(F.col("kind") == i, F.col("n")).otherwise(0)).alias(c) for i, c in enumerate(COUNTS))
    return partial.groupBy("word").agg(F.sum("n").alias("n"), *kinds)


def count_sequences(words: DataFrame) -> DataFrame:
    """``high``, ``low``, ``n`` and the four COUNTS of the sequences of counted words."""
    import pyarrow as pa

    columns = ["n", *COUNTS]

    def derive(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import numpy as np

        for batch in batches:
            if not batch.num_rows:
                continue
            high, low, first = sequences_of(batch.column(0).to_pylist())
            times = np.diff(np.append(first, len(high)))
            pair, at = np.unique(np.stack((high, low)), axis=1, return_inverse=True)
            sums = []
            for i in range(len(columns)):
                counts = np.repeat(batch.column(i + 1).to_numpy(), times)
                total = np.zeros(pair.shape[1], np.int64)
                np.add.at(total, at.ravel(), counts)
                sums.append(pa.array(total))
            yield pa.RecordBatch.from_arrays([pa.array(pair[0]), pa.array(pair[1]), *sums], names=["high", "low", *columns])

    schema = T.StructType([T.StructField(c, T.LongType()) for c in ("high", "low", *columns)])
    return words.select("word", *columns).mapInArrow(derive, schema).groupBy("high", "low").agg(*(F.sum(c).alias(c) for c in columns))


def _suffix(order: int) -> list[Column]:
    """The last symbols of a sequence, as its halves."""
    low = F.col("low") if order >= HALF else F.col("low").bitwiseAND(F.lit((1 << (BITS * order)) - 1))
    high = F.col("high").bitwiseAND(F.lit((1 << (BITS * (order - HALF))) - 1)) if order > HALF else F.lit(0).cast("long")
    return [high.alias("high"), low.alias("low")]


def _first_symbol(order: int) -> Column:
    half, at = ("high", order - HALF - 1) if order > HALF else ("low", order - 1)
    return F.shiftright(half, BITS * at).bitwiseAND(F.lit(SYMBOL))


def _context() -> list[Column]:
    return [F.col("high").alias("c_high"), F.shiftright("low", BITS).alias("c_low")]


def shared_probabilities(sequences: DataFrame) -> DataFrame:
    """``high``, ``low`` and ``shared``: Kneser-Ney probabilities of all documents.

    Lower orders count kinds of what stands before, or, where only the start of a word can,
    occurrences.
    """
    levels = [(ORDER, sequences.select("high", "low", "n"))]
    for order in range(ORDER - 1, 0, -1):
        # taken of sequences one symbol longer, whose first symbol goes
        cut = levels[-1][1].select(*_suffix(order), "n")
        counted = cut.groupBy("high", "low").agg(F.sum(F.when(_first_symbol(order) == GAP, F.col("n")).otherwise(1)).alias("n"))
        levels.append((order, counted))
    below = None
    for order, level in reversed(levels):
        if order == 1:  # at most as many rows as there are code points
            below = level.select("high", "low", (F.col("n") / F.sum("n").over(Window.partitionBy())).alias("below"))
            continue
        context = Window.partitionBy("c_high", "c_low")
        level = level.select("high", "low", "n", *_context()).select(
            "high", "low", "n", F.sum("n").over(context).alias("total"), F.count("*").over(context).alias("kinds"))
        s_high, s_low = (c.alias(f"s_{n}") for c, n in zip(_suffix(order - 1), ("high", "low"), strict=True))
        lower = below.select(F.col("high").alias("s_high"), F.col("low").alias("s_low"), "below")
        mixed = ((F.col("n") - DISCOUNT) + DISCOUNT * F.col("kinds") * F.col("below")) / F.col("total")
        below = level.select("*", s_high, s_low).join(lower, ["s_high", "s_low"]).select("high", "low", mixed.alias("below"))
    return below.withColumnRenamed("below", "shared")


def log_ratios(sequences: DataFrame, shared: DataFrame, toxic: Column, ordinary: Column) -> DataFrame:
    """``key`` and ``value``: the logarithm of the ratio of both models, of all sequences that it is not 0 of.

    A sequence that neither class has seen has the ratio of its context.
    """
    context = Window.partitionBy("c_high", "c_low")
    seen = sequences.select("high", "low", *_context(), toxic.alias("t"), ordinary.alias("o")).select(
        "*", *(F.sum(c).over(context).alias(f"{c}_total") for c in "to"),
        *(F.sum((F.col(c) > 0).cast("long")).over(context).alias(f"{c}_kinds") for c in "to"),
    ).where("t_total + o_total > 0")

    def weight(c: str) -> Column:
        return (DISCOUNT * F.col(f"{c}_kinds") + SHARED) / (F.col(f"{c}_total") + SHARED)

    def logp(c: str) -> Column:
        return F.log(F.greatest(F.col(c) - DISCOUNT, F.lit(0.0)) / (F.col(f"{c}_total") + SHARED) + weight(c) * F.col("shared"))

    unseen = F.log(weight("t")) - F.log(weight("o"))
    value = F.when(F.col("t") + F.col("o") > 0, logp("t") - logp("o")).otherwise(unseen).cast("float")

    def keyed(batches: Iterator) -> Iterator:
        import pyarrow as pa

        for batch in batches:
            key = key_of(batch.column(0).to_numpy(), batch.column(1).to_numpy())
            yield pa.RecordBatch.from_arrays([pa.array(key), batch.column(2)], names=["key", "value"])

    return seen.join(shared, ["high", "low"]).select("high", "low", value.alias("value")).mapInArrow(keyed, "key bigint, value float")


# -- scores


def measures(values) -> tuple[float, float]:
    """Of the values of a text's words: how far they lie above the median one, and how far beyond one unit above."""
    import numpy as np

    if not len(values):
        return 0.0, 0.0
    above = values - np.median(values)
    return float(above.mean()), float(np.maximum(above - 1, 0).mean())


def values_of(words: list[str], keys, values):
    """The value of each word, from sorted keys of sequences and their values."""
    import numpy as np

    high, low, first = sequences_of(words)
    wanted = key_of(high, low)
    if not len(keys):
        return np.zeros(len(words))
    at = np.minimum(np.searchsorted(keys, wanted), len(keys) - 1)
    return np.add.reduceat(np.where(keys[at] == wanted, values[at], 0.0).astype(float), first)


class Valued(dict):
    """Values of words, each found once while it is remembered."""

    def __init__(self, keys, values) -> None:
        self.keys_, self.values_ = keys, values

    def learn(self, texts: list[list[str]]) -> None:
        new = [w for w in set().union(*texts) if w not in self]
        if len(self) + len(new) > REMEMBERED:
            self.clear()
            new = list(set().union(*texts))
        if new:
            self.update(zip(new, values_of(new, self.keys_, self.values_).tolist(), strict=True))


def _with_sent_model(source: DataFrame, schema: T.StructType, ratios: DataFrame) -> DataFrame:
    """Rows, whose last column is the text, to rows with their measures; the model goes to every task."""
    import numpy as np

    table = ratios.toArrow()
    keys, values = table.column("key").to_numpy(), table.column("value").to_numpy()
    order = np.argsort(keys)
    model = source.sparkSession.sparkContext.broadcast((keys[order], values[order]))

    def rate(batches: Iterator) -> Iterator:
        import numpy as np
        import pyarrow as pa

        known = Valued(*model.value)
        for batch in batches:
            found = []
            for at in range(0, batch.num_rows, 256):
                texts = [words_of(t) for t in batch.column(batch.num_columns - 1).slice(at, 256).to_pylist()]
                known.learn(texts)
                found += [measures(np.fromiter(map(known.__getitem__, words), float, len(words))) for words in texts]
            columns = [pa.array([f[i] for f in found], pa.float64()) for i in range(2)]
            yield pa.RecordBatch.from_arrays([*batch.columns[:-1], *columns], names=schema.names)

    return source.mapInArrow(rate, schema)


def _stream(table) -> bytes:
    import pyarrow as pa

    sink = pa.BufferOutputStream()
    with pa.ipc.new_stream(sink, table.schema, options=pa.ipc.IpcWriteOptions(compression="zstd")) as out:
        out.write_table(table.combine_chunks())
    return sink.getvalue().to_pybytes()


def _blocked(batches: Iterator) -> Iterator:
    """Rows, whose last column is the text, to blocks of them: rows, numbers of their words, words and keys."""
    import numpy as np
    import pyarrow as pa
    from pyspark import TaskContext

    block, size = TaskContext.get().partitionId() << 32, 0
    rows, texts, number = [], [], {}

    def ended():
        words = list(number) or [""]
        high, low, _ = sequences_of(words)
        table = pa.Table.from_batches(rows).append_column("_words_", pa.array(texts, pa.list_(pa.int32())))
        out = pa.RecordBatch.from_arrays([
            pa.array([block]), pa.array([_stream(table)], pa.binary()), pa.array([_stream(pa.table({"word": words}))], pa.binary()),
            pa.array([np.unique(key_of(high, low))], pa.list_(pa.int64()))], names=["block", "rows", "words", "keys"])
        rows.clear()
        texts.clear()
        number.clear()
        return out

    for batch in batches:
        kept = batch.select(range(batch.num_columns - 1))
        done = 0
        for i, text in enumerate(batch.column(batch.num_columns - 1)):
            value = text.as_py() or ""
            if size and size + len(value) > BLOCK:
                if i > done:
                    rows.append(kept.slice(done, i - done))
                yield ended()
                block, size, done = block + 1, 0, i
            size += len(value) + 16
            # the order of words does not matter, so the numbers of a text are sorted and kept as steps
            own = np.sort(np.array([number.setdefault(w, len(number)) for w in words_of(value)], np.int32))
            texts.append(np.diff(own, prepend=0).astype(np.int32))
        if batch.num_rows > done:
            rows.append(kept.slice(done))
    if texts:
        yield ended()


def _with_joined_model(source: DataFrame, schema: T.StructType, ratios: DataFrame) -> DataFrame:
    """The same, with blocks of rows that join the model's rows of their words' sequences."""
    import pyarrow as pa

    blocks = stored(source.mapInArrow(_blocked, "block bigint, rows binary, words binary, keys array<bigint>"), "blocks")
    known = blocks.select(F.col("block").alias("of"), F.explode("keys").alias("key")).join(ratios, "key").select("of", "key", "value")

    def rate(blocks: pa.Table, known: pa.Table) -> pa.Table:
        import numpy as np

        rows, words = (pa.ipc.open_stream(blocks.column(c)[0].as_py()).read_all() for c in ("rows", "words"))
        keys, values = known.column("key").to_numpy(), known.column("value").to_numpy()
        order = np.argsort(keys)
        value = values_of(words.column(0).to_pylist(), keys[order], values[order])
        found = [measures(value[np.cumsum(steps.values.to_numpy())]) for steps in rows.column("_words_")]
        columns = [pa.array([f[i] for f in found], pa.float64()) for i in range(2)]
        return pa.Table.from_arrays([*rows.columns[:-1], *columns], names=schema.names)

    return blocks.select("block", "rows", "words").groupBy("block").cogroup(known.groupBy("of")).applyInArrow(rate, schema)


def with_measures(df: DataFrame, text: str, keep: list[str], ratios: DataFrame, most: int = BROADCAST_SEQUENCES) -> DataFrame:
    """``keep`` and the two measures ``mean`` and ``beyond`` of each row's whole text, by a stored model."""
    source = df.select(*keep, df[text].cast("string").alias("_text_"))
    schema = T.StructType([*source.schema.fields[:-1], T.StructField("mean", T.DoubleType()), T.StructField("beyond", T.DoubleType())])
    return (_with_sent_model if ratios.count() <= most else _with_joined_model)(source, schema, ratios)


def fit_logistic(rows: list[tuple[float, float, int]]) -> list[float]:
    """Weights of 1 and the two measures, by Newton steps."""
    import numpy as np

    x = np.array([(1.0, a, b) for a, b, _ in rows])
    y = np.array([label for _, _, label in rows], float)
    scale = np.maximum(x.std(axis=0), 1e-9)
    scale[0] = 1.0
    z, w, ridge = x / scale, np.zeros(3), 1e-2 * np.eye(3)
    for _ in range(100):
        p = 1 / (1 + np.exp(-np.clip(z @ w, -30, 30)))
        step = np.linalg.solve((z * (p * (1 - p))[:, None]).T @ z + ridge, z.T @ (y - p) - ridge @ w)
        w += np.clip(step, -2, 2)
        if np.abs(step).max() < 1e-8:
            break
    return [float(v) for v in w / scale]


def score(
    df: DataFrame, labels: DataFrame, doc_id: str = "doc_id", text: str = "text", label: str = "toxic",
    keep: tuple[str, ...] = (), threshold: float = 0.3, most: int = BROADCAST_SEQUENCES,
) -> DataFrame:
    """``doc_id``, ``held_out``, ``score``, ``predicted`` of each row, after the columns ``keep``."""
    remainder = F.coalesce(F.crc32(df[doc_id].cast("string").cast("binary")) % 4, F.lit(0))
    known = labels.where(F.col(label).isNotNull()).groupBy(F.col(doc_id).alias("_id")).agg(F.max(label).alias("_label"))
    known = known.where(F.col("_id").isNotNull() & (F.crc32(F.col("_id").cast("string").cast("binary")) % 4 != 2))
    if labels.count() <= BROADCAST_LABELS:
        known = F.broadcast(known)
    rows = df.select(df[doc_id].alias("_doc"), df[text].cast("string").alias("text"), remainder.alias("_remainder"))
    joined = rows.join(known, rows["_doc"] == F.col("_id"), "left")
    kind = F.when(F.col("_label").isNotNull(), (F.col("_remainder") == 3).cast("int") * 2 + F.when(F.col("_label") == 1, 0).otherwise(1))
    words = count_words(joined.select("text", kind.alias("kind")))
    sequences = stored(count_sequences(words), "sequences", "zstd")
    shared = stored(shared_probabilities(sequences), "shared", "zstd")

    part = stored(log_ratios(sequences, shared, F.col("t0"), F.col("o0")), "ratios")
    unseen = joined.where((F.col("_remainder") == 3) & F.col("_label").isNotNull())
    rated = with_measures(unseen.select("_doc", "_label", "text"), "text", ["_doc", "_label"], part, most)
    sample = rated.orderBy(F.xxhash64("_doc")).limit(FITTED).select("mean", "beyond", "_label").collect()
    weights = fit_logistic([(r["mean"], r["beyond"], int(r["_label"] == 1)) for r in sample]) if sample else [-30.0, 0.0, 0.0]

    whole = stored(log_ratios(sequences, shared, F.col("t0") + F.col("t1"), F.col("o0") + F.col("o1")), "ratios")
    extra = [c for c in keep if c != doc_id]
    source = df.select(*(df[c] for c in extra), df[doc_id].alias("doc_id"), (remainder == 2).alias("held_out"), df[text].cast("string").alias("_body_"))
    rated = with_measures(source, "_body_", [*extra, "doc_id", "held_out"], whole, most)
    logit = F.lit(weights[0]) + weights[1] * F.col("mean") + weights[2] * F.col("beyond")
    probability = 1 / (1 + F.exp(-logit))
    return rated.select(*extra, "doc_id", "held_out", probability.alias("score"), (probability >= threshold).cast("int").alias("predicted"))
