from __future__ import annotations

import hashlib
import math
import random
import re
import zlib
from collections import Counter

import pytest
import xxhash
from cases import awkward, frame, prose, rows_of

from spark_refresh.llm import fingerprints, resampling, spelling

LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
ROWS = awkward() + [(100 + i, "Équipe " * (i % 3) + prose(i % 37, 30 + i % 9) + "\n" + prose(5, 25) + "\n\nthe End\r\n") for i in range(80)] + [
    (50, prose(8, 30)), (50, prose(8, 30)), (None, prose(9, 30))]


def features(text: str | None, longest: int) -> tuple[int, list[str]]:
    words = re.findall("[^\x00-\x2f\x3a-\x60\x7b-\x7f]+", (text or "").translate(LOWER))
    return len(words), [" ".join(words[i : i + n]) for n in range(1, longest + 1) for i in range(len(words) - n + 1)]


def drawn_by_hand(rows, target, longest, buckets):
    def counted(texts):
        return Counter(zlib.crc32(f.encode()) % buckets for t in texts for f in features(t, longest)[1])

    s, t = counted(x for _, x in rows), counted(target)
    s_all, t_all = sum(s.values()), sum(t.values())
    gain = [math.floor(1000 * math.log((t[b] + 1) * (s_all + buckets) / ((s[b] + 1) * (t_all + buckets)))) for b in range(buckets)]
    out = []
    for d, text in rows:
        n, found = features(text, longest)
        weight = sum(gain[zlib.crc32(f.encode()) % buckets] for f in found) // len(found) if found else 0
        h = int(hashlib.sha256(f"2024:{'' if d is None else d}".encode()).hexdigest()[:8], 16)
        out.append((d, n, len(found), weight, weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296)))))
    eligible = sorted((x for x in out if x[1] >= 20), key=lambda x: (-x[4], x[0] is None, x[0] or 0))
    ranked = Counter((*x[:1], *x[2:], i + 1) for i, x in enumerate(eligible[: len(eligible) * 30 // 100]))
    everyone = Counter((*x[:1], *x[2:]) for x in out)
    return everyone, ranked


@pytest.mark.parametrize("longest", [1, 3])
def test_resampling_counts_whole_texts(spark, longest):
    target = [(1, prose(5, 25)), (2, None), (3, "the end\nof it\n" + prose(8, 8))]
    got = rows_of(resampling.resample(frame(spark, ROWS), frame(spark, target), longest=longest, buckets=500, percent=30))
    everyone, ranked = drawn_by_hand(ROWS, [t for _, t in target], longest, 500)
    assert Counter((r["doc_id"], r["n_features"], r["weight"], r["score"]) for r in got) == everyone
    assert Counter((r["doc_id"], r["n_features"], r["weight"], r["score"], r["rank"]) for r in got if r["rank"]) == ranked
    assert sorted(r["rank"] for r in got if r["rank"]) == list(range(1, sum(ranked.values()) + 1))


def test_resampling_of_empty_tables(spark):
    assert rows_of(resampling.resample(frame(spark, []), frame(spark, ROWS))) == []
    got = rows_of(resampling.resample(frame(spark, ROWS), frame(spark, [])))
    assert len(got) == len(ROWS)


def edits(a: str, b: str) -> int:
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        last, row[0] = row[0], i
        for j, y in enumerate(b, 1):
            last, row[j] = row[j], min(row[j] + 1, row[j - 1] + 1, last + (x != y))
    return row[-1]


def variants_by_hand(rows, every):
    counts = Counter()
    for d, text in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = run.translate(LOWER)
            h = zlib.crc32(f"{'' if d is None else d}:{run}".encode())
            counts[run[: h % len(run)] + run[h % len(run) + 1 :] if h % every == 0 else run] += 1
    counts = {w: n for w, n in counts.items() if len(w) >= 7 and n >= 2}
    near = {w: [v for v in counts if abs(len(v) - len(w)) < 2 and edits(w, v) == 1] for w in counts}
    form = {}
    for w, some in near.items():
        best = min(some, key=lambda v: (-counts[v], v), default=None)
        form[w] = best if best is not None and counts[best] >= 10 * counts[w] else None
    out = set()
    for w in counts:
        root = w
        while form[root] is not None:
            root = form[root]
        out.add((w, form[w], root, counts[w], len(near[w]), counts.get(form[w])))
    return out


def test_variants_equal_all_comparisons(spark):
    r = random.Random(4)
    base = ["equipement", "équipement", "straßenbahn", "municipal", "correlation", "x" * 60, "aaaaaaaa", "abababab"]
    words = []
    for w in base:
        for times in (400, 30, 3, 2):
            for _ in range(3):
                words += [w] * times
                i = r.randrange(len(w))
                w = r.choice([w[:i] + w[i + 1 :], w[:i] + r.choice("abcéß") + w[i:], w[:i] + r.choice("xyzÀ") + w[i + 1 :]])
    r.shuffle(words)
    rows = awkward()[:8] + [(8, "日本語 ééééééé×× AAAAAAA aaaaaaa"), (None, "municipal Municipal"), (None, None)]
    rows += [(i, " ".join(w.title() if r.random() < 0.1 else w for w in words[i * 40 : i * 40 + 40])) for i in range(len(words) // 40 + 1)]
    rows = [(d, t[:3000] if t else t) for d, t in rows]
    got = rows_of(spelling.variants(frame(spark, rows), every=7))
    assert {(x["word"], x["form"], x["root"], x["n"], x["n_near"], x["form_n"]) for x in got} == variants_by_hand(rows, 7)
    assert any(x["root"] not in (x["word"], x["form"]) for x in got)
    assert rows_of(spelling.variants(frame(spark, []))) == []


def test_variants_of_very_long_words(spark):
    long = "abcdefghij" * 3000
    got = {x["word"]: x for x in rows_of(spelling.variants(frame(spark, [(1, f"{long} {long} {long}x {long}x")]), every=0))}
    assert got[long]["n_near"] == 1 and got[long + "x"]["n_near"] == 1


def shingles(text: str) -> set[int]:
    words = [w for w in re.split(r"[\W_]+", text.lower()) if w]
    out = set()
    for i in range(max(len(words) - 4, 1) if words else 0):
        h = 42
        for w in words[i : i + 5]:
            h = xxhash.xxh64_intdigest(w.encode(), seed=h)
        out.add(h - (1 << 64) if h >> 63 else h)
    return out


def likeness(a: set[int], b: set[int], size: int) -> float:
    if not a and not b:
        return 1.0
    both = set(sorted(a | b)[:size])
    return len(both & a & b) / len(both)


@pytest.mark.parametrize("size", [16, 128])
def test_fingerprints_by_hand(spark, size):
    rows = [(d, t) for d, t in ROWS if d not in (4, 50, None)] + [(None, prose(77, 50)), (4, prose(4, 99)), (3000, prose(2, 700))]
    order = sorted(rows, key=lambda x: (x[0] is None, -(x[0] or 0)))
    same = Counter(d for d, _ in rows)
    want = {}
    for (d, t), (e, u) in zip(order, order[1:] + order[:1], strict=True):
        t, u = t or "", u or ""
        half = len(t) // 2
        edited = t[: len(t) - half] + u[:half]
        if same[d] == 1 and same[e] == 1:  # the order of equal ids is free
            want[d] = (len(t), hashlib.sha256(edited.encode()).hexdigest(), *(" ".join(f"{h % (1 << 64):x}" for h in sorted(shingles(x))[:size]) for x in (t, edited)),
                       likeness(shingles(t), shingles(edited), size), likeness(shingles(t), shingles(u), size))
    got = rows_of(fingerprints.edited(frame(spark, rows), size=size))
    assert Counter(x["doc_id"] for x in got) == same
    columns = ["n_chars", "edited_sha256", "fingerprint", "edited_fingerprint", "near_edited", "near_next"]
    for x in got:
        if x["doc_id"] in want:
            assert [x[c] for c in columns[:4]] == list(want[x["doc_id"]][:4])
            assert [x["near_edited"], x["near_next"]] == pytest.approx(want[x["doc_id"]][4:])
    assert len(want) > 80


def test_fingerprints_of_equal_rows_and_few_rows(spark):
    assert rows_of(fingerprints.edited(frame(spark, []))) == []
    one = rows_of(fingerprints.edited(frame(spark, [(1, "abc def")])))
    assert one[0]["edited_sha256"] == hashlib.sha256(b"abc abc").hexdigest() and one[0]["near_next"] == 1.0
    hot = rows_of(fingerprints.edited(frame(spark, [(5, prose(3, 40))] * 3000 + [(6, "b"), (None, None), (None, None)])))
    assert len(hot) == 3003 and sum(x["near_next"] == 1.0 for x in hot if x["doc_id"] == 5) == 2999


def test_sketches_merge_and_estimate(spark):
    texts = [prose(i, 3000) for i in range(4)]
    rows = [(i, " ".join(texts[j] for j in range(4) if j in (i, (i + 1) % 4))) for i in range(4)]
    sketched = fingerprints.fingerprints(frame(spark, rows * 50), size=1024)
    whole = rows_of(fingerprints.merge_groups(sketched.selectExpr("doc_id % 2 AS half", "sketch"), ["half"], size=1024))
    for r in whole:
        sets = set().union(*(shingles(t) for d, t in rows if d % 2 == r["half"]))
        assert r["sketch"] == sorted(sets)[:1024]
    a, b = shingles(rows[0][1]), shingles(rows[1][1])
    pair = spark.createDataFrame([(sorted(a)[:1024], sorted(b)[:1024])], "a array<bigint>, b array<bigint>")
    from pyspark.sql import functions as F

    x = pair.select(
        fingerprints.resemblance(F.col("a"), F.col("b"), 1024).alias("r"), fingerprints.containment(F.col("a"), F.col("b"), 1024).alias("c"),
        fingerprints.distinct_count(F.col("a"), 1024).alias("n")).first()
    assert x["r"] == pytest.approx(len(a & b) / len(a | b), abs=0.06)
    assert x["c"] == pytest.approx(len(a & b) / len(a), abs=0.08)
    assert x["n"] == pytest.approx(len(a), rel=0.12)
