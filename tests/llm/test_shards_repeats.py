from __future__ import annotations

import hashlib
import random
import re
import zlib
from collections import Counter

from cases import awkward, frame, prose, rows_of
from pyspark.sql import functions as F

from spark_refresh.llm import repeats, sharding


def test_shards_hold_equal_bytes_and_whole_groups(spark):
    rows = awkward() + [(1000 + i, prose(i % 900, 40 + i % 50)) for i in range(2500)] + [(9000 + i, "hot copy") for i in range(1500)] + [(8000, "one row again and again")] * 2500
    got = rows_of(sharding.shard(frame(spark, rows)))
    want = Counter((d, len((t or "").encode()) + 1, zlib.crc32((t or "").encode())) for d, t in rows)
    assert Counter((r["doc_id"], r["size"], r["text_crc32"]) for r in got) == want
    bytes_, slots = Counter(), {}
    for r in got:
        assert r["law"] == "bytes" and r["grown_shard"] is None
        bytes_[r["shard"]] += r["size"]
        slots.setdefault(r["shard"], []).append(r["slot"])
    for s in slots.values():
        assert sorted(s) == list(range(len(s)))
    most = max(r["size"] for r in got)
    assert max(bytes_.values()) - min(bytes_.values()) <= 2 * most + 0.01 * sum(bytes_.values()) / 8
    assert rows_of(sharding.shard(frame(spark, []))) == []


def test_equal_rows_are_no_single_draw_or_range(spark):
    df = spark.range(40_000).selectExpr("id AS r", "CAST(5 AS BIGINT) AS h", "CAST(6 AS BIGINT) AS d", "CAST(10 AS BIGINT) AS size")
    keys = sharding.splitters(df, 64, 400_000)
    assert len(keys) > 50 and len({k[2] for k in keys}) > 50
    sizes = df.groupBy(sharding.binary_search(keys, F.struct("h", "d", "r")).alias("range")).count().collect()
    assert max(r["count"] for r in sizes) < 4 * 40_000 / 64


def brute(rows: list[tuple]) -> Counter:
    first: dict[tuple, int] = {}
    cut = [(d, re.findall(r"[^\x20\x09-\x0D]+", t or "")) for d, t in rows]
    for d, w in cut:
        for i in range(len(w) - 49) if d is not None else ():
            key = tuple(w[i : i + 50])
            first[key] = min(d, first.get(key, d))
    out: Counter = Counter()
    for d, w in cut:
        gone = [False] * len(w)
        for i in range(len(w) - 49) if d is not None else ():
            if first[tuple(w[i : i + 50])] < d:
                gone[i : i + 50] = [True] * 50
        kept = " ".join(x for x, g in zip(w, gone, strict=True) if not g)
        out[d, len(w), sum(gone), hashlib.sha256(kept.encode()).hexdigest()] += 1
    return out


def test_repeated_passages_go_as_windows_say(spark):
    r = random.Random(9)
    passages = [prose(500 + i, n) for i, n in enumerate((50, 51, 70, 130, 49))]
    rows = [(d, t) for d, t in awkward() if d not in (6, 7)] + [(6, prose(1, 4000)), (7, prose(1, 4000) + " end")]
    for i in range(120):
        parts = [prose(7000 + i, r.randint(0, 60))]
        for _ in range(r.randint(0, 3)):
            parts += [r.choice(passages), prose(r.randint(0, 10**6), r.randint(0, 30))]
        rows.append((r.randint(100, 180), " ".join(parts)))
    got = rows_of(repeats.deduplicate(frame(spark, rows)))
    assert Counter((x["doc_id"], x["n_words"], x["n_removed"], x["kept_sha256"]) for x in got) == brute(rows)
    assert rows_of(repeats.deduplicate(frame(spark, []))) == []
