"""Packing of tokenized documents into sequences by a linear grouping scheme.

Only numbers of pieces per length are packed on the driver: at most ``capacity`` lengths,
whatever the number of documents. Large lengths are rounded up to the largest of their group
(groups of equal cardinality), sequences are built from few group sizes by the best filled
configurations, the actual lengths take the places of the rounded ones, and small pieces go
where they fit best. A plan of best fit alone is made as well, and the one with fewer
sequences is taken. The plan is a list of runs: so many sequences of the same lengths. Each
piece finds its place by its rank among the pieces of its length.

Null texts count as empty; an empty document still has its end token. Repeated rows are
packed as often as they occur. An empty table gives no sequence.
"""

from __future__ import annotations

import bisect
import re
import unicodedata
import zlib
from collections.abc import Iterator
from functools import cache
from itertools import accumulate

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import stored, tokenizer_file

CAPACITY = 4096
END = 1
GROUPS = (48, 192, 512)  # of large lengths: a plan for each number
LARGE = 8  # lengths above a capacity's eighth are large
REMEMBERED = 600_000

# -- token ids

_PLAIN = [chr(c) for c in (9, 10, 13, *range(32, 127), *range(0xA1, 0x130))]
_LETTERS = "".join(c for c in _PLAIN if unicodedata.category(c)[0] == "L")
_NUMBERS = "".join(c for c in _PLAIN if unicodedata.category(c)[0] == "N")
#: Texts of these characters only are cut into words here; others go to the tokenizer whole.
PLAIN = re.compile(f"[{re.escape(''.join(_PLAIN))}]*")
UNIT = re.compile(f"[{_LETTERS}]+|'(?:s|t|re|ve|m|ll|d)|[{_NUMBERS}]|[^ \t\n\r{_LETTERS}{_NUMBERS}]+")


class WordTokenizer:
    """Ids of texts as bytes, little-endian unsigned 32-bit; ids of units are remembered."""

    def __init__(self, file: str) -> None:
        import numpy as np
        from tokenizers import Tokenizer

        self.np, self.tokenizer = np, Tokenizer.from_file(file)
        vocabulary = self.tokenizer.get_vocab()
        self.ends = np.zeros(max(vocabulary.values()) + 1, bool)
        self.ends[[i for token, i in vocabulary.items() if token.endswith("</w>")]] = True
        self.units: dict[str, bytes] = {}

    def whole(self, text: str) -> bytes:
        return self.np.array(self.tokenizer.encode(text, add_special_tokens=False).ids, "<u4").tobytes()

    def learn(self, units: list[str]) -> None:
        """Ids of units, read off one call: each ends with the only token that ends a word."""
        for at in range(0, len(units), 20_000):
            some = units[at : at + 20_000]
            ids = self.np.array(self.tokenizer.encode(" ".join(some), add_special_tokens=False).ids, "<u4")
            stops = (self.np.flatnonzero(self.ends[ids]) + 1) * 4
            if len(stops) == len(some):
                raw, stops = ids.tobytes(), stops.tolist()
                self.units.update(zip(some, map(raw.__getitem__, map(slice, [0, *stops[:-1]], stops)), strict=True))
            else:
                self.units.update((u, self.whole(u)) for u in some)

    def encode(self, texts: list[str]) -> Iterator[bytes]:
        units = self.units
        for at in range(0, len(texts), 256):
            some = texts[at : at + 256]
            cut = [UNIT.findall(t.lower()) if "<|" not in t and PLAIN.fullmatch(t) else None for t in some]
            used = set().union(*(c for c in cut if c))
            if len(units) + len(used) > REMEMBERED:
                units.clear()
            if new := used.difference(units):
                long = [u for u in new if len(u) > 400]
                units.update((u, self.whole(u)) for u in long)
                self.learn(sorted(new.difference(long)))
            for text, found in zip(some, cut, strict=True):
                yield self.whole(text) if found is None else b"".join(map(units.__getitem__, found))


@cache
def _tokenizer(file: str) -> WordTokenizer:
    return WordTokenizer(file)  # one in each Python worker, with what it remembers


def token_pieces(
    df: DataFrame, doc_id: str, text: str, capacity: int = CAPACITY, end: int = END,
    vocabulary: str = "word_bpe_49k.json", folder: str | None = None,
) -> DataFrame:
    """Each document's pieces: ``doc_id``, ``piece``, ``start``, ``length``, ``ids_crc32``."""
    import pyarrow as pa

    schema = T.StructType([
        T.StructField("doc_id", df.schema[doc_id].dataType), T.StructField("piece", T.IntegerType()),
        T.StructField("start", T.LongType()), T.StructField("length", T.LongType()), T.StructField("ids_crc32", T.LongType()),
    ])
    last = end.to_bytes(4, "little")

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokenizer = _tokenizer(tokenizer_file(vocabulary, folder))
        for batch in batches:
            rows, pieces, starts, lengths, sums = [], [], [], [], []
            texts = [v or "" for v in batch.column(1).to_pylist()]
            for row, ids in enumerate(tokenizer.encode(texts)):
                ids += last
                for piece, at in enumerate(range(0, len(ids), 4 * capacity)):
                    some = ids[at : at + 4 * capacity]
                    rows.append(row)
                    pieces.append(piece)
                    starts.append(at // 4)
                    lengths.append(len(some) // 4)
                    sums.append(zlib.crc32(some))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0).take(pa.array(rows, pa.int64())), pa.array(pieces, pa.int32()),
                 *(pa.array(x, pa.int64()) for x in (starts, lengths, sums))],
                names=schema.names,
            )

    return df.select(df[doc_id], df[text].cast("string")).mapInArrow(cut, schema)


# -- the plan


def _configuration(sizes: list[int], counts: list[int], capacity: int) -> list[int]:
    """How many of each size fill a sequence best that holds the largest: the fullest sum, of large sizes first."""
    capacity, counts = capacity - sizes[0], [counts[0] - 1, *counts[1:]]
    reach = 1  # bit s is set if the sum s can be made
    steps = []
    for size, count in zip(sizes, counts, strict=True):
        steps.append(reach)
        for _ in range(min(count, capacity // size)):
            reach |= reach << size
            reach &= (1 << (capacity + 1)) - 1
    total, chosen = reach.bit_length() - 1, [0] * len(sizes)
    for g in range(len(sizes) - 1, -1, -1):
        while not steps[g] >> total & 1:
            total -= sizes[g]
            chosen[g] += 1
    chosen[0] += 1
    return chosen


def linear_groups(counts: dict[int, int], groups: int) -> list[list[tuple[int, int]]]:
    """Lengths (largest first) with their counts, in groups of equal cardinality."""
    total = sum(counts.values())
    share, out, room = -(-total // groups), [[]], -(-total // groups)
    for length in sorted(counts, reverse=True):
        left = counts[length]
        while left:
            if not room:
                out.append([])
                room = share
            taken = min(left, room)
            out[-1].append((length, taken))
            left, room = left - taken, room - taken
    return [g for g in out if g]


def _take(group: list[list[int]], number: int) -> list[tuple[int, int]]:
    """Remove that many pieces from a group, largest first: (length, number)."""
    out = []
    while number:
        length, left = group[0]
        taken = min(left, number)
        out.append((length, taken))
        number -= taken
        group[0][1] -= taken
        if not group[0][1]:
            group.pop(0)
    return out


Runs = dict[tuple[int, ...], int]


def plan_runs(counts: dict[int, int], capacity: int = CAPACITY, groups: tuple[int, ...] = GROUPS) -> list[tuple[int, tuple[int, ...]]]:
    """Runs (number of sequences, lengths in each) that hold exactly the given pieces.

    The best of the plans by configurations of so many groups, or that of best fit alone if it needs fewer.
    """
    large = {n: c for n, c in counts.items() if c and n * LARGE > capacity}
    small = {n: c for n, c in counts.items() if c and n * LARGE <= capacity}
    plans = [_best_fit(_configured(large, capacity, n), small, capacity) for n in groups] + [_best_fit({}, large | small, capacity)]
    runs = min(plans, key=lambda r: sum(r.values()))
    return [(number, lengths) for lengths, number in sorted(runs.items(), reverse=True)]


def _configured(large: dict[int, int], capacity: int, groups: int) -> Runs:
    """Sequences of large pieces: the fullest configurations of group sizes, with actual lengths in their places."""
    runs: Runs = {}
    parts = [[list(x) for x in g] for g in linear_groups(large, groups)] if large else []
    while any(parts):
        parts = [g for g in parts if g]
        sizes, left = [g[0][0] for g in parts], [sum(c for _, c in g) for g in parts]
        chosen = _configuration(sizes, left, capacity)
        times = min(n // k for n, k in zip(left, chosen, strict=True) if k)
        slots = [_take(g, times) for g, k in zip(parts, chosen, strict=True) for _ in range(k)]
        cuts = sorted({at for s in slots for at in accumulate(n for _, n in s)})
        where = [0] * len(slots)
        ends = [list(accumulate(n for _, n in s)) for s in slots]
        before = 0
        for cut in cuts:
            for i, e in enumerate(ends):
                while e[where[i]] <= before:
                    where[i] += 1
            lengths = tuple(s[where[i]][0] for i, s in enumerate(slots))
            runs[lengths] = runs.get(lengths, 0) + cut - before
            before = cut
    return runs


def _best_fit(runs: Runs, pieces: dict[int, int], capacity: int) -> Runs:
    """The sequences with further pieces put in, longest first, each where the least room is left."""
    rooms: dict[int, list[tuple[int, ...]]] = {}
    for lengths in runs:
        rooms.setdefault(capacity - sum(lengths), []).append(lengths)
    order = sorted(rooms)

    def open_run(lengths: tuple[int, ...], room: int, number: int) -> None:
        if lengths not in runs:
            if room not in rooms:
                rooms[room] = []
                bisect.insort(order, room)
            rooms[room].append(lengths)
        runs[lengths] = runs.get(lengths, 0) + number

    for length in sorted(pieces, reverse=True):
        left = pieces[length]
        while left:
            at = bisect.bisect_left(order, length)
            if at == len(order):  # sequences of this length alone
                per = capacity // length
                full, rest = divmod(left, per)
                for number, k in ((full, per), (1 if rest else 0, rest)):
                    if number:
                        open_run((length,) * k, capacity - length * k, number)
                break
            room = order[at]
            lengths = rooms[room][-1]
            taken = min(left, runs[lengths])
            runs[lengths] -= taken
            if not runs[lengths]:
                del runs[lengths]
                rooms[room].pop()
                if not rooms[room]:
                    del rooms[room]
                    order.pop(at)
            open_run((*lengths, length), room - length, taken)
            left -= taken
    return runs


def places(runs: list[tuple[int, tuple[int, ...]]]) -> tuple[list[int], list[int], list[int], list[int]]:
    """For each length, in order of rank: length, first rank, first sequence and offset of an interval."""
    rows, sequence = [], 0
    for number, lengths in runs:
        offset = 0
        for length in lengths:
            rows.append((length, number, sequence, offset))
            offset += length
        sequence += number
    rows.sort(key=lambda r: r[0])
    ranks, seen = [], {}
    for length, number, _, _ in rows:
        ranks.append(seen.get(length, 0))
        seen[length] = ranks[-1] + number
    return [r[0] for r in rows], ranks, [r[2] for r in rows], [r[3] for r in rows]


def pack(pieces: DataFrame, row: str, capacity: int = CAPACITY, groups: tuple[int, ...] = GROUPS) -> DataFrame:
    """The pieces (``length``, a unique number ``row`` and others) with ``sequence_id`` and ``offset``.

    Read twice, so it should be a stored table. Ranks are made within salted parts of a
    length, with the numbers before each part added, so no task gets all pieces of a length,
    whatever their ids are. The column ``row`` is left out.
    """
    import pyarrow as pa

    spark = pieces.sparkSession
    salts = max(64, min(4096, pieces.count() // 50_000))
    salted = pieces.withColumn("_part", F.pmod(F.xxhash64(row), F.lit(salts)).cast("int"))
    parts = salted.groupBy("length", "_part").agg(F.count("*").alias("_n"))
    counts = {r["length"]: r["n"] for r in parts.groupBy("length").agg(F.sum("_n").alias("n")).collect()}
    before = Window.partitionBy("length").orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    first = parts.select("length", "_part", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_first"))
    within = Window.partitionBy("length", "_part").orderBy(row)
    ranked = salted.withColumn("_rank", F.row_number().over(within) - 1).join(first, ["length", "_part"])
    plan = spark.sparkContext.broadcast(places(plan_runs(counts, capacity, groups)))
    kept = [f for f in pieces.schema.fields if f.name != row]
    out = T.StructType([*kept, T.StructField("sequence_id", T.LongType()), T.StructField("offset", T.LongType())])

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import numpy as np

        lengths, ranks, sequences, offsets = (np.array(x, np.int64) for x in plan.value)
        keys = lengths << 48 | ranks
        for batch in batches:
            rank = batch.column(batch.num_columns - 1).to_numpy()
            at = np.searchsorted(keys, batch.column("length").to_numpy() << 48 | rank, side="right") - 1
            yield pa.RecordBatch.from_arrays(
                [*batch.columns[:-1], pa.array(sequences[at] + rank - ranks[at]), pa.array(offsets[at])], names=out.names)

    rank = (F.col("_rank") + F.col("_first")).cast("long").alias("_rank")
    return ranked.select(*(f.name for f in kept), rank).mapInArrow(place, out)


def packed_documents(df: DataFrame, doc_id: str = "doc_id", text: str = "text", capacity: int = CAPACITY, **tokenizer) -> DataFrame:
    """Tokenize every document once, store the pieces, and pack them."""
    pieces = token_pieces(df, doc_id, text, capacity, **tokenizer)
    return pack(stored(pieces.withColumn("_row", F.monotonically_increasing_id()), "pieces"), "_row", capacity)
