"""Token counts by byte-pair merging with a heap over a linked list of symbols.

The vocabulary is a SentencePiece BPE model. A text is cut where no piece can reach across
(before a white-space mark, at a line end); the tokens of each part are its symbols less the
merges done, so no identifiers are made. Counts of short parts are remembered per task.

Null and empty texts have no tokens. Rows are kept as they are, repeated ones too; an empty
table gives an empty result. The result has the columns ``keep`` and three new ones.
"""

from __future__ import annotations

import heapq
import re
from collections.abc import Iterator
from functools import cache

from pyspark.sql import DataFrame
from pyspark.sql import types as T

from .common import tokenizer_file

MARK = "▁"  # stands for a space in pieces
REMEMBERED = 800_000
SHORT = 48


def count_merged(symbols: str, rank: dict[str, int], width) -> int:
    """Tokens of one part: repeatedly merge the adjacent pair of the lowest rank, leftmost first.

    ``width`` gives the tokens of a symbol that is left unmerged.
    """
    n = len(symbols)
    if n == 1:
        return width(symbols)
    part = list(symbols)
    left, right = list(range(-1, n - 1)), list(range(1, n + 1))
    right[-1] = -1
    heap = []
    for i in range(n - 1):
        r = rank.get(symbols[i : i + 2])
        if r is not None:
            heap.append((r, i, 2))
    heapq.heapify(heap)
    merges = 0
    while heap:
        _, i, size = heapq.heappop(heap)
        j = right[i]
        if not part[i] or j < 0 or len(part[i]) + len(part[j]) != size:
            continue  # one of the two has been merged meanwhile
        part[i] += part[j]
        part[j] = ""
        merges += 1
        k = right[i] = right[j]
        if k >= 0:
            left[k] = i
            joined = part[i] + part[k]
            if (r := rank.get(joined)) is not None:
                heapq.heappush(heap, (r, i, len(joined)))
        h = left[i]
        if h >= 0:
            joined = part[h] + part[i]
            if (r := rank.get(joined)) is not None:
                heapq.heappush(heap, (r, h, len(joined)))
    return n - merges + sum(width(p) - 1 for p in part if len(p) == 1)


class PieceCounter(dict):
    """Counts tokens of texts; as a dict it remembers the counts of words between spaces."""

    def __init__(self, model_file: str) -> None:
        from sentencepiece import sentencepiece_model_pb2

        model = sentencepiece_model_pb2.ModelProto()
        with open(model_file, "rb") as file:
            model.ParseFromString(file.read())
        pieces = [p for p in model.pieces if p.type in (1, 4, 5)]
        rules, training = model.normalizer_spec, model.trainer_spec
        supported = (
            training.model_type == 2 and training.byte_fallback and rules.add_dummy_prefix and rules.escape_whitespaces
            and not rules.remove_extra_whitespaces and not rules.precompiled_charsmap
            and not training.treat_whitespace_as_suffix and all(p.type == 1 for p in pieces)
            and not any(MARK in p.piece.lstrip(MARK) or ("\n" in p.piece and len(p.piece) > 1) for p in pieces)
        )
        if not supported:
            raise ValueError("expected a BPE model with byte fallback whose pieces stay within words and lines")
        order = {s: i for i, s in enumerate(sorted({p.score for p in pieces}, reverse=True))}
        self.rank = {p.piece: order[p.score] for p in pieces}
        self.parts: dict[str, int] = {}

    def width(self, symbol: str) -> int:
        return 1 if symbol in self.rank else len(symbol.encode())

    def part(self, symbols: str) -> int:
        known = self.parts.get(symbols)
        if known is None:
            known = count_merged(symbols, self.rank, self.width)
            if len(symbols) <= SHORT:
                if len(self.parts) >= REMEMBERED // 4:
                    self.parts.clear()
                self.parts[symbols] = known
        return known

    def __missing__(self, word: str) -> int:
        known = count_merged(word if word[:1] == "\n" else MARK + word, self.rank, self.width)
        if len(word) <= SHORT:
            if len(self) >= REMEMBERED:
                self.clear()
            self[word] = known
        return known

    def tokens(self, text: str) -> int:
        if not text:
            return 0
        if text[0] == " " or "  " in text or MARK in text:
            marked = MARK + text.replace(" ", MARK)
            return sum(map(self.part, re.findall(f"{MARK}+[^{MARK}\n]*|\n[^{MARK}\n]*", marked)))
        return sum(map(self.__getitem__, text.replace("\n", " \n").split(" ")))


@cache
def _counter(file: str) -> PieceCounter:
    return PieceCounter(file)  # one in each Python worker, with what it remembers


def count_tokens(
    df: DataFrame, text: str = "text", keep: tuple[str, ...] = ("doc_id",), limit: int = 4096,
    model: str = "piece_bpe_32k.model", folder: str | None = None,
) -> DataFrame:
    """``keep`` and ``n_bytes``, ``n_tokens``, ``over_limit`` of each row's whole text."""
    import pyarrow as pa

    kept = df.select(*keep)
    schema = T.StructType([
        *kept.schema.fields, T.StructField("n_bytes", T.LongType()), T.StructField("n_tokens", T.LongType()),
        T.StructField("over_limit", T.BooleanType()),
    ])

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counter = _counter(tokenizer_file(model, folder))
        for batch in batches:
            sizes, tokens = [], []
            for value in batch.column(batch.num_columns - 1):
                whole = value.as_py() or ""
                sizes.append(len(whole.encode()))
                tokens.append(counter.tokens(whole))
            yield pa.RecordBatch.from_arrays(
                [*batch.columns[:-1], pa.array(sizes, pa.int64()), pa.array(tokens, pa.int64()),
                 pa.array([n > limit for n in tokens], pa.bool_())],
                names=schema.names,
            )

    return df.select(*keep, df[text].cast("string").alias("_text_")).mapInArrow(count, schema)
