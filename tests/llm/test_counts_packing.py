from __future__ import annotations

import bisect
import random
import zlib
from collections import Counter

import numpy as np
import pytest
import sentencepiece
from cases import awkward, frame, rows_of
from tokenizers import Tokenizer

from spark_refresh.llm import bpe_count, packing
from spark_refresh.llm.common import tokenizer_file


@pytest.fixture(scope="module")
def odd() -> list[str]:
    r = random.Random(3)
    return ["".join(r.choice(" \n\tab'’éÉß1½,.<|>▁日🙂ſK") for _ in range(r.randint(0, 40))) for _ in range(400)] + ["<s> x</s>", "<|endoftext|> a"]


def test_token_counts_are_the_library_s(spark, odd):
    rows = awkward() + [(100 + i, t) for i, t in enumerate(odd)]
    library = sentencepiece.SentencePieceProcessor(model_file=tokenizer_file("piece_bpe_32k.model"))
    got = Counter((r["doc_id"], r["n_bytes"], r["n_tokens"], r["over_limit"]) for r in rows_of(bpe_count.count_tokens(frame(spark, rows))))
    want = Counter()
    for doc, text in rows:
        n = len(library.encode(text or ""))
        want[doc, len((text or "").encode()), n, n > 4096] += 1
    assert got == want
    assert rows_of(bpe_count.count_tokens(frame(spark, []))) == []


def test_pieces_fill_sequences_without_gaps(spark, odd):
    rows = awkward() + [(100 + i, t) for i, t in enumerate(odd)]
    tokenizer = Tokenizer.from_file(tokenizer_file("word_bpe_49k.json"))
    want = Counter()
    for doc, text in rows:
        ids = [*tokenizer.encode(text or "", add_special_tokens=False).ids, 1]
        for piece, at in enumerate(range(0, len(ids), 4096)):
            some = ids[at : at + 4096]
            want[doc, piece, at, len(some), zlib.crc32(np.array(some, "<u4").tobytes())] += 1
    got = rows_of(packing.packed_documents(frame(spark, rows)))
    assert Counter((r["doc_id"], r["piece"], r["start"], r["length"], r["ids_crc32"]) for r in got) == want
    sequences: dict[int, list] = {}
    for r in got:
        sequences.setdefault(r["sequence_id"], []).append((r["offset"], r["length"]))
    for places in sequences.values():
        at = 0
        for offset, length in sorted(places):
            assert offset == at
            at += length
        assert at <= 4096
    assert rows_of(packing.packed_documents(frame(spark, []))) == []


@pytest.mark.parametrize("seed", range(6))
def test_plans_hold_exactly_the_pieces(seed):
    r = random.Random(seed)
    counts = {r.randint(1, 4096): r.randint(1, 10 ** r.randint(0, 6)) for _ in range(r.randint(1, 900))}
    runs = packing.plan_runs(counts)
    held: Counter = Counter()
    for number, lengths in runs:
        assert sum(lengths) <= 4096
        for n in lengths:
            held[n] += number
    assert held == counts


def test_plans_are_tight_where_small_pieces_are_many():
    counts = {n: 1000 for n in range(5, 1200, 7)}
    used = sum(n for n, _ in packing.plan_runs(counts))
    assert used <= 1.01 * sum(k * n for k, n in counts.items()) / 4096 + 1


def best_fit_decreasing(lengths: list[int], capacity: int) -> int:
    rooms: list[int] = []
    for n in sorted(lengths, reverse=True):
        at = bisect.bisect_left(rooms, n)
        left = (rooms.pop(at) if at < len(rooms) else capacity) - n
        bisect.insort(rooms, left)
    return len(rooms)


@pytest.mark.parametrize("draw", [
    lambda r: r.randint(1, 4096), lambda r: r.randint(1100, 2200), lambda r: min(4096, max(1, int(r.lognormvariate(6.5, 1.2)))),
    lambda r: r.randint(1366, 2048), lambda r: r.choice([700, 1399, 2005, 4096, 33]), lambda r: r.randint(1, 400),
])
def test_plans_never_need_more_than_best_fit_decreasing(draw):
    r = random.Random(9)
    lengths = [draw(r) for _ in range(6000)]
    used = sum(n for n, _ in packing.plan_runs(dict(Counter(lengths))))
    assert used <= best_fit_decreasing(lengths, 4096)
    bound = max(-(-sum(lengths) // 4096), sum(n > 2048 for n in lengths))
    if len({n for n in lengths if n < 400}) > 100:  # many small ones to fill the rest
        assert used <= 1.01 * bound


def test_pieces_of_one_id_are_not_one_group(spark):
    rows = [(7, "same words again")] * 3000 + [(None, None)] * 500
    got = rows_of(packing.packed_documents(frame(spark, rows)))
    assert len(got) == 3500 and len({(r["sequence_id"], r["offset"]) for r in got}) == 3500
