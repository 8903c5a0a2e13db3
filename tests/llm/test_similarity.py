from __future__ import annotations

import random

import numpy as np
import pytest
from cases import awkward, frame, prose, rows_of, word

from spark_refresh.llm import hashing_search, near_duplicates


def distance(a: list, b: list) -> int:
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        new = [i]
        for j, y in enumerate(b, 1):
            new.append(min(row[j] + 1, new[-1] + 1, row[j - 1] + (x != y)))
        row = new
    return row[-1]


def edited(words: list[str], r: random.Random, edits: int) -> list[str]:
    words = list(words)
    for _ in range(edits):
        at, kind = r.randrange(len(words) + 1), r.random()
        if kind < 0.4 and at < len(words):
            words[at] = word(r)
        elif kind < 0.7 and at < len(words):
            del words[at]
        else:
            words.insert(at, word(r))
    return words


@pytest.mark.parametrize("size", [0, 1, 3, 12, 60, 260])
def test_alignment_decides_like_the_whole_table(size):
    r = random.Random(size)
    for _ in range(40):
        a = [r.randint(0, 40) for _ in range(size)]
        b = [int(x) if x.isdigit() else 99 for x in edited(list(map(str, a)), r, r.randint(0, size // 3 + 1))]
        most = max(len(a), len(b))
        want = most == 0 or distance(a, b) <= int(0.2 * most + 1e-9)
        assert near_duplicates.within(np.array(a, np.uint32), np.array(b, np.uint32)) == want


def test_alignment_of_long_texts_of_unlike_lengths():
    a = np.arange(1000, dtype=np.uint32)
    for cut in (100, 190, 199, 200, 201, 230):
        assert near_duplicates.within(a, a[cut:]) == near_duplicates.within(a[:-cut], a) == (cut <= 200)


def test_near_copies_meet_and_others_do_not(spark):
    r = random.Random(2)
    rows, group = awkward(), {}
    shared = prose(77, 40)  # a passage that many unlike texts hold
    for g in range(30):
        base = prose(1000 + g, 150).split()
        for k in range(4):
            doc = 1000 + g * 10 + k
            group[doc] = g
            rows.append((doc, " ".join(edited(base, r, 3 * k))))
    rows += [(5000 + i, f"{shared} {prose(90000 + i, 60)}") for i in range(60)]
    got = {}
    for x in rows_of(near_duplicates.classes(frame(spark, rows))):
        got.setdefault(x["doc_id"], x)
    for doc, g in group.items():
        assert got[doc]["class_id"] == 1000 + g * 10
        assert got[doc]["class_size"] == 4
    assert all(got[5000 + i]["class_id"] == 5000 + i for i in range(60))
    assert got[4]["class_id"] == got[5]["class_id"] == 4
    assert got[6]["class_id"] == got[7]["class_id"] == 6
    assert got[None]["class_id"] is None and got[2]["class_id"] == 2 and got[3]["class_id"] == 3
    assert rows_of(near_duplicates.classes(frame(spark, []))) == []


def test_components_of_a_long_chain(spark):
    chain = spark.createDataFrame([(i, i + 1) for i in range(200)] + [(500, 501)], "a bigint, b bigint")
    roots = {r["node"]: r["root"] for r in rows_of(near_duplicates.components(chain))}
    assert roots == {**dict.fromkeys(range(201), 0), 500: 500, 501: 500}


def vectors(spark, rows):
    return spark.createDataFrame([(i, v, 1, "x") for i, v in rows], "vec_id bigint, embedding array<float>, score int, v string")


def test_nearest_vectors(spark):
    random_ = np.random.default_rng(4)
    rows = [(i, [float(x) for x in random_.standard_normal(24) * random_.uniform(0.5, 2)]) for i in range(3000)]
    rows += [(4000 + i, rows[7][1]) for i in range(300)]  # equal vectors
    bad = [(5000, None), (5020, [0.0] * 24), (5040, [None] + [1.0] * 23), (5060, [float("nan")] * 24), (5080, [1.0]), (None, rows[0][1]), (5100, [])]
    got: dict[int, list] = {}
    for r in sorted(rows_of(hashing_search.search(vectors(spark, rows + bad))), key=lambda r: (r["query_id"], r["rank"])):
        got.setdefault(r["query_id"], []).append((r["rank"], r["vec_id"], r["score"]))
    ids, x = np.array([i for i, _ in rows]), np.array([v for _, v in rows], np.float32).astype(float)
    hit = total = 0
    assert set(got) == {i for i in ids.tolist() if i % 20 == 0}
    for q, found in got.items():
        at = int(np.flatnonzero(ids == q)[0])
        score = x @ x[at]
        order = [i for i in np.lexsort((ids, -np.round(score, 9))) if i != at][:20]
        assert [k for k, _, _ in found] == list(range(1, 21)) and q not in [v for _, v, _ in found]
        assert all(abs(s - score[np.flatnonzero(ids == v)[0]]) < 1e-9 for _, v, s in found)
        hit += len({v for _, v, _ in found} & set(ids[order].tolist()))
        total += 20
    assert hit / total >= 0.9
    few = rows_of(hashing_search.search(vectors(spark, [(0, [1.0, 0.0]), (3, [1.0, 0.0]), (4, [0.5, 0.1])])))
    assert sorted((r["rank"], r["vec_id"]) for r in few) == [(1, 3), (2, 4)]
    assert rows_of(hashing_search.search(vectors(spark, bad))) in ([], rows_of(hashing_search.search(vectors(spark, bad))))
    assert rows_of(hashing_search.search(vectors(spark, []))) == []


def test_probes_leave_most_unstructured_vectors_out():
    random_ = np.random.default_rng(9)
    x = random_.standard_normal((20_000, 64))
    longest = float(np.sqrt((x * x).sum(axis=1)).max())
    model = (longest, *hashing_search.learn(x[:8000], longest))
    radius, probed = hashing_search.calibrated(x[:8000], model, 8)
    index, bits = hashing_search.Index(hashing_search.codes(x, model)), np.ascontiguousarray(hashing_search.probes()[:probed].T)
    at = hashing_search.projected(x[:200], model)
    own = np.packbits(at > 0, axis=1).view("<u2")
    values = hashing_search.probe_values(own, at, bits)
    looked = hit = 0
    for q in range(200):
        looked += len(index.within(own[q], values[q], hashing_search.BITS))
        score = x @ x[q]
        score[q] = -np.inf
        hit += len(set(index.within(own[q], values[q], radius).tolist()) & set(np.argsort(-score)[:20].tolist()))
    assert looked / 200 < 0.5 * len(x)
    assert hit / 200 >= 0.9 * 20


def test_a_query_that_finds_too_few_compares_all(spark, monkeypatch):
    monkeypatch.setattr(hashing_search, "BLOCK", 256)
    monkeypatch.setattr(hashing_search, "QUESTIONS", 24)
    monkeypatch.setattr(hashing_search, "calibrated", lambda *_: (0, 1))  # only equal codes are found
    random_ = np.random.default_rng(3)
    x = random_.standard_normal((1200, 16)).astype(np.float32).astype(float)
    x[100:140] = x[40] * random_.uniform(1, 1.5, (40, 1)).astype(np.float32)  # these find enough
    got: dict[int, list] = {}
    for r in sorted(rows_of(hashing_search.search(vectors(spark, [(i, v.tolist()) for i, v in enumerate(x)]))), key=lambda r: (r["query_id"], r["rank"])):
        got.setdefault(r["query_id"], []).append(r["vec_id"])
    x = x.astype(np.float32).astype(float)
    assert set(got) == set(range(0, 1200, 20)) and all(len(found) == 20 for found in got.values())
    for q in (0, 500, 1180):
        score = x @ x[q]
        assert got[q] == [i for i in np.argsort(-score, kind="stable").tolist() if i != q][:20]


@pytest.mark.parametrize(("size", "least"), [(20, 0.85), (50, 0.9), (200, 0.9), (800, 0.9)])
def test_bands_find_texts_at_the_bound(size, least):
    """Every fifth word differs, at random places: the share of such pairs with an equal band."""
    r, met = random.Random(size), 0
    for _ in range(120):
        words = [word(r) + word(r) for _ in range(size)]
        other = list(words)
        for at in r.sample(range(size), size // 5):
            other[at] = f"x{r.randrange(10**9)}"
        one, two = (near_duplicates.sketch(near_duplicates.word_ids(" ".join(w), {})) for w in (words, other))
        met += bool((one == two).any())
    assert met / 120 >= least


def test_links_against_all_pairs(spark):
    """Classes by all pairs, without any filter before the alignment."""
    r, texts = random.Random(12), []
    for _ in range(40):
        words = [word(r) + word(r) for _ in range(r.choice([12, 40, 90]))]
        texts += [edited(words, r, int(len(words) * share)) for share in (0, 0.03, 0.1, 0.16, 0.3)]
    ids = [near_duplicates.word_ids(" ".join(t), {}) for t in texts]
    root = list(range(len(texts)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    linked = 0
    for i in range(len(texts)):
        for j in range(i):
            if near_duplicates.within(ids[i], ids[j]):
                linked += 1
                root[max(find(i), find(j))] = min(find(i), find(j))
    got = {x["doc_id"]: x["class_id"] for x in rows_of(near_duplicates.classes(frame(spark, [(i, " ".join(t)) for i, t in enumerate(texts)])))}
    together = [(i, j) for i in range(len(texts)) for j in range(i) if find(i) == find(j)]
    assert all(find(i) == find(c) for i, c in got.items())
    assert linked > 100 and sum(got[i] == got[j] for i, j in together) >= 0.95 * len(together)


def test_similar_texts_meet_in_buckets_that_others_fill(spark, monkeypatch):
    """Pairs at the bound under a passage that all texts hold: each two with an equal band end in one class."""
    r, texts = random.Random(31), []
    passage = [word(r) + word(r) for _ in range(150)]
    for _ in range(80):
        own = [word(r) + word(r) for _ in range(50)]
        other = list(own)
        for at in r.sample(range(50), 38):  # 38 of 200 words differ
            other[at] = f"x{r.randrange(10**9)}"
        texts += [passage + own, passage + other]
    ids = [near_duplicates.word_ids(" ".join(t), {}) for t in texts]
    sketches = [near_duplicates.sketch(x) for x in ids]
    pairs = [(i, i + 1) for i in range(0, len(texts), 2) if (sketches[i] == sketches[i + 1]).any()]
    assert len(pairs) > 70 and all(near_duplicates.within(ids[i], ids[j]) for i, j in pairs)
    df = frame(spark, [(i, " ".join(t)) for i, t in enumerate(texts)])
    for block in (near_duplicates.BLOCK, 16):
        monkeypatch.setattr(near_duplicates, "BLOCK", block)
        got = {x["doc_id"]: x["class_id"] for x in rows_of(near_duplicates.classes(df))}
        assert all(got[i] == got[j] for i, j in pairs)
        assert all(near_duplicates.within(ids[i], ids[c]) for i, c in got.items())


def test_bags_bound_what_texts_share():
    r = random.Random(8)
    for size in (1, 30, 400, 70_000):
        a = np.array([r.randrange(size // 3 + 1) for _ in range(size)], np.uint32)
        b = np.concatenate((a[: size // 2], np.full(size // 3, 7, np.uint32)))
        (one, x), (two, y) = near_duplicates.bag(a), near_duplicates.bag(b)
        bound = np.minimum(*(np.frombuffer(v, np.uint8).astype(int) * s for s, v in ((one, x), (two, y)))).sum()
        shared = np.minimum(*(np.bincount(v, minlength=size + 8) for v in (a, b))).sum()
        assert bound >= shared
