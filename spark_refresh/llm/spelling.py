"""Spelling variants of words: near words found through a reduced alphabet.

1. Words are counted over whole texts, one row per word and task before the shuffle.
2. Letters are hashed to a few symbols: a word of L letters becomes a reduced word, a number
   computed from its symbols. The number of symbols of a length is the smallest that makes at
   least ``SPREAD`` times as many reduced words as there are words of that length, so the words
   of a reduced word stay few, however large the vocabulary.
3. The one-edit neighbourhood of every reduced word is joined with the reduced vocabulary.
   Words of lengths L and L + 1 meet under the symbols of L. A pair of neighbours is the same
   from both sides, so each side makes a part: a replaced symbol by the higher one, a changed
   length by the longer word, equal reduced words by the join with themselves.
4. Pairs are verified on the words themselves: exactly one insertion, deletion or replacement.
5. A word's form is its most frequent near word, if that is frequent enough; roots follow the
   forms, whose counts grow at each step, by doubling.

Null texts have no words. A null id makes copying errors as the empty id does. Equal rows are
rows of their own and count. Ties go to the smallest word in code-point order. Words may be of
any length: neighbours are made from sums of hashes, not as texts. Empty tables give no rows.
"""

from __future__ import annotations

import re
import zlib
from collections import Counter
from collections.abc import Iterator

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import stored

FEWEST_LETTERS = 7
FEWEST_TIMES = 2
TIMES = 10  # a form is so many times as frequent
EVERY = 31  # one of so many words of a document loses a letter
SPREAD = 4  # reduced words for each word
SHORT = 40  # longer words have two symbols
WORDS_IN_TASK = 50_000  # whose neighbours are made together
GATHERED = 400_000  # words in a task before they go on
RUN = re.compile("[A-Za-zÀ-ÿ]+")
CAPITALS = {c: c + 32 for c in range(65, 91)}


def altered(words: Counter, doc_id: str, every: int) -> Iterator[tuple[str, int]]:
    """The document's words with their counts; every so manieth loses the letter its hash names."""
    begun = zlib.crc32(f"{doc_id}:".encode())
    for word, n in words.items():
        h = zlib.crc32(word.encode(), begun)
        if every and h % every == 0:
            at = h % len(word)
            word = word[:at] + word[at + 1 :]
        yield word, n


def word_counts(df: DataFrame, doc_id: str, text: str, every: int = EVERY, letters: int = FEWEST_LETTERS) -> DataFrame:
    """``word`` and ``n`` of the words with at least that many letters."""

    def count(batches: Iterator) -> Iterator:
        import pyarrow as pa

        held: Counter = Counter()

        def ended():
            out = pa.RecordBatch.from_arrays([pa.array(list(held), pa.string()), pa.array(list(held.values()), pa.int64())], names=["word", "n"])
            held.clear()
            return out

        for batch in batches:
            for name, body in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
                value = body.as_py() or ""
                found = Counter(RUN.findall(value.lower() if value.isascii() else value.translate(CAPITALS)))
                for word, n in altered(found, name or "", every):
                    if len(word) >= letters:
                        held[word] += n
                if len(held) >= GATHERED:
                    yield ended()
        if held:
            yield ended()

    rows = df.select(df[doc_id].cast("string").alias("doc"), df[text].cast("string").alias("text"))
    return rows.mapInArrow(count, "word string, n bigint").groupBy("word").agg(F.sum("n").alias("n"))


def symbols_by_length(lengths: dict[int, int]) -> dict[int, int]:
    """The number of symbols of each length up to SHORT."""
    out = {}
    for length in range(1, SHORT + 1):
        words, symbols = lengths.get(length, 0) + lengths.get(length + 1, 0), 2
        while symbols**length < SPREAD * words:
            symbols += 1
        out[length] = symbols
    return out


def _odd(seed: int) -> int:
    import random

    return random.Random(seed).getrandbits(64) | 1


FACTOR = _odd(12)
BACK = pow(FACTOR, -1, 1 << 64)


def _values(most: int):
    """A number for each symbol."""
    import numpy as np

    return np.array([_odd(1000 + s) for s in range(most)], np.uint64)


def _finished(sums, length: int, symbols: int):
    """Hashes of reduced words from their sums, the length and the number of symbols."""
    import numpy as np

    x = sums + np.uint64((length * 0x9E3779B97F4A7C15 + symbols * 0xD6E8FEB86659FD93) % (1 << 64))
    x = (x ^ x >> np.uint64(33)) * np.uint64(0xFF51AFD7ED558CCD)
    return (x ^ x >> np.uint64(29)).view(np.int64)


def _powers(n: int):
    import numpy as np

    powers = np.full(n + 1, FACTOR, np.uint64)
    powers[0] = 1
    return np.multiply.accumulate(powers)


def reduced(codes, symbols: int, values, powers):
    """(symbols of the letters, their terms, the sum): the reduced word is the sum of its terms."""
    import numpy as np

    letters = codes % symbols
    terms = values[letters] * powers[: len(codes)]
    return letters, terms, terms.sum(dtype=np.uint64)


def neighbours(codes, symbols: int, values, powers):
    """Hashes of the word itself reduced and with one symbol replaced by a higher one."""
    import numpy as np

    letters, _, total = reduced(codes, symbols, values, powers)
    parts = [np.array([total], np.uint64)]
    for other in range(1, symbols):
        at = np.flatnonzero(letters < other)
        parts.append(total + (values[other] - values[letters[at]]) * powers[at])
    return _finished(np.concatenate(parts), len(codes), symbols)


def shorter(codes, symbols: int, values, powers):
    """Hashes of the reduced word without one of its symbols, each once."""
    import numpy as np

    _, terms, total = reduced(codes, symbols, values, powers)
    before = np.concatenate((np.zeros(1, np.uint64), np.add.accumulate(terms)[:-1]))
    after = (total - before - terms) * np.uint64(BACK)
    return np.unique(_finished(before + after, len(codes) - 1, symbols))


def _generated(lengths: dict[int, int], own_only: bool):
    """(word) to (hash, word, same): its reduced word (``same``) and, unless ``own_only``, its neighbours."""
    by_length, rows = symbols_by_length(lengths), 200_000

    def generate(batches: Iterator) -> Iterator:
        import numpy as np
        import pyarrow as pa

        values, powers = _values(max(by_length.values()) + 1), _powers(64)

        def out(held):
            sizes = [len(h) for h, _, _ in held]
            return pa.RecordBatch.from_arrays([
                pa.array(np.concatenate([h for h, _, _ in held])),
                pa.array([w for _, w, _ in held], pa.string()).take(pa.array(np.repeat(np.arange(len(held)), sizes))),
                pa.array(np.repeat(np.array([k for _, _, k in held], bool), sizes))], names=["hash", "word", "same"])

        held, n = [], 0
        with np.errstate(over="ignore"):
            for batch in batches:
                for word in batch.column(0).to_pylist():
                    codes = np.frombuffer(word.encode("utf-32-le"), np.uint32).astype(np.int64)
                    if len(codes) >= len(powers):
                        powers = _powers(2 * len(codes))
                    own, less = by_length.get(len(codes), 2), by_length.get(len(codes) - 1, 2)
                    if own_only:
                        total = reduced(codes, own, values, powers)[2]
                        found = [(_finished(np.array([total], np.uint64), len(codes), own), True)]
                    else:
                        hashes = neighbours(codes, own, values, powers)
                        found = [(hashes[:1], True), (hashes[1:], False)]
                        if len(codes) > SHORT + 1 or lengths.get(len(codes) - 1):
                            found.append((shorter(codes, less, values, powers), False))
                    for hashes, same in found:
                        held.append((hashes, word, same))
                        n += len(hashes)
                    if n >= rows:
                        yield out(held)
                        held, n = [], 0
            if held:
                yield out(held)

    return generate


def near_pairs(words: DataFrame) -> DataFrame:
    """``a``, ``b``: each pair of words that differ by exactly one edit, once, from a stored ``word`` column."""
    counted = words.groupBy(F.char_length("word").alias("length")).agg(F.count("*").alias("n"))
    lengths = {r["length"]: r["n"] for r in counted.where(F.col("length") <= SHORT + 1).collect()}
    tasks = max(words.sparkSession.sparkContext.defaultParallelism, words.count() // WORDS_IN_TASK)
    spread, schema = words.select("word").repartition(tasks), "hash bigint, word string, same boolean"
    own = spread.mapInArrow(_generated(lengths, True), schema).select("hash", F.col("word").alias("b"))
    around = spread.mapInArrow(_generated(lengths, False), schema).withColumnRenamed("word", "a")
    met = around.join(own, "hash").where("NOT same OR a < b")
    return met.where(F.levenshtein("a", "b", 1) == 1).select("a", "b")


def forms(words: DataFrame, pairs: DataFrame, times: int = TIMES) -> DataFrame:
    """``word``, ``n``, ``n_near``, ``form``, ``form_n`` of each word."""
    both = pairs.unionByName(pairs.select(F.col("b").alias("a"), F.col("a").alias("b")))
    counted = both.join(words.select(F.col("word").alias("b"), F.col("n").alias("b_n")), "b")
    best = counted.groupBy("a").agg(F.count("*").alias("n_near"), F.min(F.struct((-F.col("b_n")).alias("less"), F.col("b").alias("near"))).alias("best"))
    joined = words.join(best, words["word"] == best["a"], "left")
    often = -F.col("best.less") >= times * F.col("n")
    return joined.select(
        "word", "n", F.coalesce("n_near", F.lit(0)).alias("n_near"),
        F.when(often, F.col("best.near")).alias("form"), F.when(often, -F.col("best.less")).alias("form_n"))


def rooted(formed: DataFrame) -> DataFrame:
    """The words with ``root``: the word at the end of the forms, found by doubling steps."""
    state = stored(formed.select("word", F.coalesce("form", "word").alias("root")), "roots")
    while True:  # a chain has at most as many steps as a count has digits
        further = state.select(F.col("word").alias("root"), F.col("root").alias("next"))
        moved = stored(state.join(further, "root").select("word", F.col("next").alias("root"), (F.col("next") != F.col("root")).alias("moved")), "roots")
        if moved.where("moved").isEmpty():
            return formed.join(state, "word")
        state = moved.select("word", "root")


def variants(
    df: DataFrame, doc_id: str = "doc_id", text: str = "text", every: int = EVERY, letters: int = FEWEST_LETTERS,
    fewest: int = FEWEST_TIMES, times: int = TIMES,
) -> DataFrame:
    """``word``, ``form``, ``root``, ``n``, ``n_near``, ``form_n`` of each word of the texts."""
    words = stored(word_counts(df, doc_id, text, every, letters).where(F.col("n") >= fewest), "words")
    formed = stored(forms(words, stored(near_pairs(words), "near"), times), "forms")
    return rooted(formed).select("word", "form", "root", "n", "n_near", "form_n")
