"""Removal of passages that an earlier document has, by automata of recurring phrases.

1. Each document gives the phrases of ``PHRASE`` words that a minimum over their hashes picks
   in every window; a window that recurs has its picked phrase recur with it. Copies of a
   whole text are one text here: all but the copy of the smallest id have every window before.
2. Phrases of two texts or more are recurring. Each part of the documents gets the recurring
   phrases its own documents have, compiles them into an Aho-Corasick automaton, and streams
   its documents through it: the places of every occurrence.
3. Only the windows around such places are compared: the smallest id of each of them, found
   by combining in each task first, decides; a window goes if that id is smaller than its own.

Windows are judged on the input. Null texts have no words. Null ids cannot be ordered: such
documents are kept whole and remove nothing. Rows with equal ids count as one document
for the order: neither removes from the other. Empty tables give no rows.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import stored

WINDOW = 50
PHRASE = 12
WORD = re.compile(r"[^\x20\x09-\x0D]+")
PART_BYTES = 8 << 20  # of text in a part, about


def _word_hashes(words: list[str], memory: dict[str, int]):
    import numpy as np
    import xxhash

    if len(memory) > 500_000:
        memory.clear()
    missing = [w for w in set(words) if w not in memory]
    if missing:
        digest = xxhash.xxh64_intdigest
        memory.update((w, digest(w) >> 1) for w in missing)
    return np.fromiter(map(memory.__getitem__, words), np.int64, len(words)).astype(np.uint64)


def _mixed(x):
    import numpy as np

    x = (x ^ x >> np.uint64(31)) * np.uint64(0x9E3779B97F4A7C15)
    x = (x ^ x >> np.uint64(29)) * np.uint64(0xBF58476D1CE4E5B9)
    return x ^ x >> np.uint64(32)


def _runs(hashes, size: int, base: int):
    """Hashes of all runs of ``size`` words, by prefix sums of a polynomial modulo 2^64."""
    import numpy as np

    n = len(hashes)
    if n < size:
        return np.zeros(0, np.uint64)
    with np.errstate(over="ignore"):
        b = np.uint64(base | 1)
        powers = np.ones(n + 1, np.uint64)
        np.multiply.accumulate(np.full(n, b, np.uint64), out=powers[1:])
        inverse = np.uint64(pow(int(b), -1, 1 << 64))
        back = np.ones(n + 1, np.uint64)
        np.multiply.accumulate(np.full(n, inverse, np.uint64), out=back[1:])
        sums = np.zeros(n + 1, np.uint64)
        np.add.accumulate(hashes * powers[:-1], out=sums[1:])
        return _mixed((sums[size:] - sums[:-size]) * back[: n - size + 1])


def picked(hashes):
    """Starts of the phrases with the smallest hash of each window."""
    import numpy as np

    phrases = _runs(hashes, PHRASE, 0x9E3779B97F4A7C15)
    width = WINDOW - PHRASE + 1
    if len(phrases) < width:
        return phrases, np.zeros(0, np.int64)
    least = phrases
    span = 1
    while span * 2 <= width:  # minima of doubled spans
        least = np.minimum(least[:-span], least[span:])
        span *= 2
    rest = width - span
    least = np.minimum(least[: len(least) - rest], least[rest:]) if rest else least
    chosen = np.unique(least)
    return phrases, np.flatnonzero(np.isin(phrases, chosen))


def windows(hashes):
    """Two hashes of each window."""
    return _runs(hashes, WINDOW, 0xD6E8FEB86659FD93), _runs(hashes, WINDOW, 0xA0761D6478BD642F)


def _identity(words: list[str]) -> tuple[str, int]:
    """The joined words and a hash that tells texts of equal words."""
    import xxhash

    joined = " ".join(words)
    return joined, xxhash.xxh3_64_intdigest(joined) - (1 << 63)


def _digest(words: str) -> str:
    return hashlib.sha256(words.encode()).hexdigest()


def _summarized(batches: Iterator) -> Iterator:
    """(doc_id, doc, text) to (doc_id, doc, h, g, n_words, sha256, phrases) of each row."""
    import numpy as np
    import pyarrow as pa
    import xxhash

    memory: dict[str, int] = {}
    for batch in batches:
        rows = []
        for value in batch.column(2):
            words = WORD.findall(value.as_py() or "")
            joined, h = _identity(words)
            found = []
            if len(words) >= WINDOW:
                phrases, places = picked(_word_hashes(words, memory))
                found = np.unique(phrases[places]).astype(np.int64)
            rows.append((h, xxhash.xxh64_intdigest(joined) - (1 << 63), len(words), _digest(joined), found))
        columns = list(zip(*rows, strict=True)) or [[]] * 5
        yield pa.RecordBatch.from_arrays(
            [batch.column(0), batch.column(1), *(pa.array(c, pa.int64()) for c in columns[:3]),
             pa.array(columns[3], pa.string()), pa.array(columns[4], pa.list_(pa.int64()))],
            names=["doc_id", "doc", "h", "g", "n_words", "sha256", "phrases"])


LOCATED = "h1 bigint, h2 int, doc bigint, h bigint, first int, text string"


def _located(left, right):
    """Texts of a part and its recurring phrases to the windows around occurrences; the text in the first row."""
    import ahocorasick
    import numpy as np
    import pyarrow as pa

    wanted = set(right.column("phrase").to_pylist())
    skipped = set(zip(right.column("doc").to_pylist(), right.column("h").to_pylist(), strict=True))
    schema = pa.schema([("h1", pa.int64()), ("h2", pa.int32()), ("doc", pa.int64()), ("h", pa.int64()), ("first", pa.int32()), ("text", pa.string())])
    memory: dict[str, int] = {}
    automaton = ahocorasick.Automaton()
    documents, seen = [], skipped  # copies, and rows that come again
    if wanted:
        for doc, value in zip(left.column("doc").to_pylist(), left.column("text"), strict=True):
            words = WORD.findall(value.as_py())
            if len(words) < WINDOW:
                continue
            joined, h = _identity(words)
            if (doc, h) in seen:
                continue
            seen.add((doc, h))
            hashes = _word_hashes(words, memory)
            documents.append((doc, h, joined, hashes, np.fromiter(map(len, words), np.int32, len(words))))
            phrases, places = picked(hashes)
            for place, phrase in zip(places.tolist(), phrases[places].astype(np.int64).tolist(), strict=True):
                if phrase in wanted:
                    automaton.add_word(" " + " ".join(words[place : place + PHRASE]) + " ", 1)
    if not len(automaton):
        return schema.empty_table()
    automaton.make_automaton()
    out = []
    for doc, h, joined, hashes, lengths in documents:
        ends = np.fromiter((end for end, _ in automaton.iter(f" {joined} ")), np.int64)
        if not len(ends):
            continue
        after = np.cumsum(lengths.astype(np.int64) + 1)  # place of the space after each word
        last = np.searchsorted(after, ends)
        room = len(hashes) - WINDOW + 1
        edges = np.zeros(room + 1, np.int64)
        np.add.at(edges, np.clip(last - WINDOW + 1, 0, room), 1)
        np.add.at(edges, np.clip(last - PHRASE + 2, 0, room), -1)
        starts = np.flatnonzero(np.cumsum(edges)[:-1] > 0)
        n = len(starts)
        if n:
            a, b = windows(hashes)
            out.append(pa.Table.from_arrays(
                [pa.array(a[starts].astype(np.int64)), pa.array((b[starts] >> np.uint64(33)).astype(np.int32)),
                 pa.array(np.full(n, doc, np.int64)), pa.array(np.full(n, h, np.int64)), pa.array(starts.astype(np.int32)),
                 pa.array([joined, *[None] * (n - 1)], pa.string())], schema=schema))
    return pa.concat_tables(out) if out else schema.empty_table()


def _cut(batches: Iterator) -> Iterator:
    """(doc, h, text, starts) to (doc, h, n_removed, sha256)."""
    import numpy as np
    import pyarrow as pa

    for batch in batches:
        removed, digests = [], []
        for text, starts in zip(batch.column(2), batch.column(3), strict=True):
            words, starts = text.as_py().split(" "), np.array(starts.as_py(), np.int64)
            edges = np.zeros(len(words) + 1, np.int64)
            np.add.at(edges, starts, 1)
            np.add.at(edges, starts + WINDOW, -1)
            gone = np.cumsum(edges)[:-1] > 0
            removed.append(int(gone.sum()))
            digests.append(_digest(" ".join([w for w, g in zip(words, gone.tolist(), strict=True) if not g])))
        yield pa.RecordBatch.from_arrays(
            [batch.column(0), batch.column(1), pa.array(removed, pa.int64()), pa.array(digests, pa.string())],
            names=["doc", "h", "n_removed", "sha256"])


def deduplicate(df: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """``doc_id``, ``n_words``, ``n_removed``, ``kept_sha256`` of each row.

    Texts are shuffled once, to the tasks that hold the automata of their part; the texts with
    candidate windows come out of there with them. All other shuffles carry numbers.
    """
    source = df.select(df[doc_id].alias("doc_id"), df[doc_id].cast("long").alias("doc"), df[text].cast("string").alias("text"))
    id_type = source.schema["doc_id"].dataType.simpleString()
    rows = stored(source.mapInArrow(
        _summarized, f"doc_id {id_type}, doc bigint, h bigint, g bigint, n_words bigint, sha256 string, phrases array<bigint>"), "summaries")
    ordered = rows.where(F.col("doc").isNotNull() & (F.col("n_words") >= WINDOW))
    copies = stored(ordered.groupBy("h", "g").agg(F.min("doc").alias("smallest"), F.max("doc").alias("largest")).where("smallest < largest").drop("largest"), "copies")
    flagged = rows.join(copies, ["h", "g"], "left").withColumn("copy", F.coalesce(F.col("smallest") < F.col("doc"), F.lit(False)))
    firsts = flagged.where(F.col("doc").isNotNull() & (F.col("n_words") >= WINDOW) & ~F.col("copy"))

    total = ordered.agg(F.sum("n_words")).first()[0] or 0
    parts = int(max(256, total * 6 // PART_BYTES))
    part = F.pmod(F.xxhash64("doc"), F.lit(parts)).cast("int")
    phrases = stored(firsts.select("doc", part.alias("part"), F.explode("phrases").alias("phrase")).groupBy("phrase", "part").agg(
        F.min("doc").alias("smallest"), F.max("doc").alias("largest")), "phrases")
    recurring = phrases.groupBy("phrase").agg(F.min("smallest").alias("smallest"), F.max("largest").alias("largest")).where("smallest < largest")
    needed = phrases.select("part", "phrase").join(recurring.select("phrase"), "phrase", "left_semi").unionByName(
        flagged.where("copy").select(part.alias("part"), "doc", "h"), allowMissingColumns=True)

    texts = source.where(F.col("doc").isNotNull() & (F.length("text") >= 2 * WINDOW - 1)).select(part.alias("part"), "doc", "text")
    located = stored(texts.groupBy("part").cogroup(needed.groupBy("part")).applyInArrow(_located, LOCATED), "located")
    earliest = stored(located.groupBy("h1", "h2").agg(F.min("doc").alias("smallest"), F.max("doc").alias("largest")).where("smallest < largest").drop("largest"), "earliest")
    starts = located.join(earliest, ["h1", "h2"]).where(F.col("smallest") < F.col("doc")).groupBy("doc", "h").agg(F.collect_list("first").alias("starts"))
    bodies = located.where(F.col("text").isNotNull()).select("doc", "h", "text")
    shortened = stored(bodies.join(starts, ["doc", "h"]).select("doc", "h", "text", "starts").mapInArrow(
        _cut, "doc bigint, h bigint, n_removed bigint, sha256 string"), "shortened")

    known = flagged.join(shortened.withColumnsRenamed({"sha256": "cut_sha256"}), ["doc", "h"], "left")
    whole = F.col("copy")
    return known.select(
        "doc_id", "n_words",
        F.when(whole, F.col("n_words")).otherwise(F.coalesce("n_removed", F.lit(0))).cast("long").alias("n_removed"),
        F.when(whole, F.lit(_digest(""))).otherwise(F.coalesce("cut_sha256", "sha256")).alias("kept_sha256"))
