"""Nearest vectors by multi-index hashing over learned binary codes.

1. Vectors get a further component that makes all of one norm, so the largest inner product
   is the smallest angle. A rotation, several times over, is learned on a bounded sample
   (alternating between the signs and the best rotation to them) and gives each vector
   ``BITS`` bits. Every vector is coded. A query's further component is 0: it has no part in
   the inner product.
2. A code is cut into substrings of 16 bits, and each is indexed: rows in order of its value,
   by block of rows. A query probes the values nearest to its own in every substring, those
   first that differ in the bits where it lies nearest to the boundary.
3. How many values are probed, and the distance between codes within which a row counts, are
   calibrated on the sample, so that each finds almost all of the nearest of its own queries
   (as many of them as the sample's share of all rows leaves of the ``k`` nearest, so less is
   probed as rows grow). What is within is ranked by the exact inner product in double
   precision, ties to the smaller id. A query that finds fewer than asked in all blocks
   compares all rows, so the result is never short.

Equal vectors are one entry with its smallest ids: no more of them can be among the nearest.
Queries are compared in blocks with blocks of entries, and the best of each block are merged.
Blocks of entries grow with the rows up to ``BLOCK``, so until there are ``BLOCKS`` such blocks a
query probes no more often however many rows there are; only the rows it finds grow.

Vectors that are null, zero, of another length than most, or hold null or non-finite numbers
take no part, nor do rows with null ids. Repeated ids are one row, that with the smallest
vector. With no vectors the result is empty.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import stored

BITS = 256
SUBSTRING = 16
SAMPLE = 8192  # vectors to learn from, at most
QUERIES = 1024  # of the sample, to calibrate the radius and the probes
RECALL = 0.97  # of the sample's nearest within the radius, and as many within the probes
BLOCK = 65536  # entries in a block, at most about, and
BLOCK_BYTES = 32 << 20  # bytes of their vectors
QUESTIONS = 8192  # in a block, at most about
BLOCKS = 4  # blocks of either that are made at least, of
LEAST = 1024  # at least
TOP = 20


def learn(vectors, longest: float, bits: int = BITS, turns: int = 12):
    """Mean and projection: codes are the signs of (augmented - mean) @ projection."""
    import numpy as np

    x = augmented(vectors, longest)
    mean = x.mean(axis=0)
    x = x - mean
    d = x.shape[1]
    random = np.random.default_rng(11)
    parts = []
    while sum(p.shape[1] for p in parts) < bits:
        r = np.linalg.qr(random.standard_normal((d, d)))[0]
        for _ in range(turns):
            u, _, v = np.linalg.svd(np.sign(x @ r).T @ x, full_matrices=False)
            r = (u @ v).T
        parts.append(r)
    return mean, np.concatenate(parts, axis=1)[:, :bits]


def augmented(vectors, longest: float):
    """Vectors of one norm: the further component is what each lacks to the longest."""
    import numpy as np

    rest = np.maximum(longest**2 - np.einsum("ij,ij->i", vectors, vectors), 0)
    return np.concatenate((vectors, np.sqrt(rest)[:, None]), axis=1)


def codes(vectors, model):
    """Packed bits, as unsigned 16-bit substrings."""
    import numpy as np

    longest, mean, projection = model
    out = np.zeros((len(vectors), BITS // SUBSTRING), "<u2")
    for at in range(0, len(vectors), 8192):
        some = augmented(vectors[at : at + 8192], longest)
        out[at : at + 8192] = np.packbits((some - mean) @ projection > 0, axis=1).view("<u2")
    return out


def projected(asked, model):
    """Queries on the axes of the bits: the sign is the bit, the size how far it is from turning."""
    import numpy as np

    _, _, projection = model
    return np.concatenate((asked, np.zeros((len(asked), 1))), axis=1) @ projection


def probes():
    """All differences of a substring, nearest first: which of its bits differ, by the rank of
    their distances from the boundary (as far as these are for normal numbers on average)."""
    import numpy as np

    far = np.sort(np.abs(np.random.default_rng(5).standard_normal((4096, SUBSTRING))), axis=1).mean(axis=0)
    bits = (np.arange(1 << SUBSTRING)[:, None] >> np.arange(SUBSTRING) & 1).astype(np.float32)
    return bits[np.argsort(bits @ far, kind="stable")]


def ranked(at):
    """For each substring of projected queries, its bits' values in the code, nearest to the boundary first."""
    import numpy as np

    place = np.packbits(np.eye(SUBSTRING, dtype=bool), axis=1).view("<u2").ravel()
    return place[np.argsort(np.abs(at).reshape(len(at), -1, SUBSTRING), axis=2)]


def distances(a, b):
    """Differing bits between one code and many."""
    import numpy as np

    return np.bitwise_count(a.view("<u8") ^ b.view("<u8")).sum(axis=1, dtype=np.int64)


def calibrated(vectors, model, k: int = TOP) -> tuple[int, int]:
    """The radius within which the sample has RECALL of the nearest of its queries, and the probes that find as many."""
    import numpy as np

    code = codes(vectors, model)
    step = max(1, len(vectors) // QUERIES)
    at = projected(vectors[::step], model)
    own, places = np.packbits(at > 0, axis=1).view("<u2"), ranked(at)
    steps = probes() @ (1 << np.arange(SUBSTRING)).astype(np.float32)
    nth = np.empty(1 << SUBSTRING, np.int64)
    nth[steps.astype(np.int64)] = np.arange(1 << SUBSTRING)
    found, first = [], []
    for i, q in enumerate(range(0, len(vectors), step)):
        score = vectors @ vectors[q]
        score[q] = -np.inf
        near = np.argsort(-score)[: min(k, len(score) - 1)]
        found.append(distances(own[i], code[near]))
        differs = (code[near] ^ own[i])[:, :, None] & places[i] != 0
        first.append(nth[differs @ (1 << np.arange(SUBSTRING))].min(axis=1))
    if not any(map(len, found)):
        return BITS, 1 << SUBSTRING
    return int(np.quantile(np.concatenate(found), RECALL)) + 1, int(np.quantile(np.concatenate(first), RECALL)) + 1


class Index:
    """A block's substrings, each with the rows of each value."""

    def __init__(self, code) -> None:
        import numpy as np

        self.words = np.ascontiguousarray(code.view("<u8").T)
        self.order = np.argsort(code, axis=0, kind="stable").T.ravel().astype(np.int32)
        rows = np.concatenate([np.bincount(code[:, s], minlength=1 << SUBSTRING) for s in range(code.shape[1])])
        self.starts = np.concatenate(([0], np.cumsum(rows))).astype(np.int32)
        self.filled = rows > 0
        self.hit = np.zeros(len(code), bool)

    def within(self, query, values, radius: int):
        """Places of the codes that share a probed value with a query's and are within the
        radius. ``values``: the values to probe, each as its place in the tables one after the other."""
        import numpy as np

        values = values[np.flatnonzero(self.filled.take(values))]
        start = self.starts.take(values)
        n = self.starts.take(values + 1) - start
        before = np.cumsum(n) - n
        # the runs of the probed values, one after the other
        runs = np.arange(n.sum()) + np.repeat(start - before, n)
        self.hit[self.order.take(runs)] = True
        places = np.flatnonzero(self.hit)
        self.hit[places] = False
        apart = np.bitwise_count(self.words.take(places, axis=1) ^ query.view("<u8")[:, None]).sum(axis=0, dtype=np.int16)
        return places[apart <= radius]


def probe_values(own, at, bits):
    """The values that projected queries probe, as ``Index.within`` takes them, of codes ``own``;
    a column of ``bits`` is a probe."""
    import numpy as np

    n, m = own.shape
    steps = (ranked(at).reshape(-1, SUBSTRING).astype(np.float32) @ bits).astype(np.int32).reshape(n, m, -1)
    tables = np.arange(m, dtype=np.int32)[:, None] << SUBSTRING
    return ((steps ^ own[:, :, None].astype(np.int32)) + tables).reshape(n, -1)


def _floats(column, dim: int):
    return column.combine_chunks().flatten().to_numpy().reshape(-1, dim)


def search(
    df: DataFrame, vec_id: str = "vec_id", vector: str = "embedding", every: int = 20, k: int = TOP,
) -> DataFrame:
    """``query_id``, ``rank``, ``vec_id``, ``score``: the ``k`` nearest of each row whose id ``every`` divides."""
    spark = df.sparkSession
    values = F.col("v")
    sound = (
        F.col("id").isNotNull() & values.isNotNull() & (F.size(values) > 0)
        & F.forall(values, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf"))) & F.exists(values, lambda x: x != 0))
    rows = df.select(df[vec_id].cast("long").alias("id"), df[vector].cast("array<double>").alias("v")).where(sound)
    lengths = rows.groupBy(F.size("v").alias("dim")).agg(F.count("*").alias("n")).orderBy(F.desc("n"), "dim").first()
    if lengths is None:
        return spark.createDataFrame([], "query_id bigint, rank int, vec_id bigint, score double")
    dim = lengths["dim"]
    normal = F.transform("v", lambda x: F.when(x == 0, F.lit(0.0)).otherwise(x))  # no negative zeros
    rows = rows.where(F.size("v") == dim).groupBy("id").agg(F.min("v").alias("v")).select("id", normal.alias("v"))
    # equal vectors become one entry; each task passes on the smallest ids of a vector only
    nth = F.row_number().over(Window.partitionBy("v").orderBy("id"))
    grouped = rows.withColumn("nth", nth).where(F.col("nth") <= k + 1).groupBy("v").agg(F.array_sort(F.collect_list("id")).alias("ids"))
    grouped = stored(grouped.withColumn("entry", F.element_at("ids", 1)), "entries")

    asked = stored(rows.where(F.col("id") % every == 0), "asked")
    distinct = stored(asked.groupBy("v").agg(F.min("id").alias("question")), "questions")
    norm = F.sqrt(F.aggregate("v", F.lit(0.0), lambda a, x: a + x * x))
    n, ids, longest = grouped.agg(F.count("*"), F.sum(F.size("ids")), F.max(norm)).first()
    sample = sampled(grouped, n)
    model = (longest, *learn(sample, longest))
    radius, probed = calibrated(sample, model, max(1, round(k * min(1, len(sample) / n))))
    block = max(1, min(BLOCK, BLOCK_BYTES // (8 * dim)))
    blocks = max(-(-n // block), min(BLOCKS, -(-n // LEAST)))
    asking = distinct.count()
    shipped = spark.sparkContext.broadcast((model, radius, probed, dim, k))

    def compare(everything: bool):
        def best(entries, questions):
            import numpy as np
            import pyarrow as pa

            model, radius, probed, dim, k = shipped.value
            schema = pa.schema([("question", pa.int64()), ("vec_id", pa.int64()), ("score", pa.float64())])
            if not entries.num_rows or not questions.num_rows:
                return schema.empty_table()
            vectors, asked = _floats(entries.column("v"), dim), _floats(questions.column("v"), dim)
            ids = entries.column("ids").to_pylist()
            index, bits, out = Index(codes(vectors, model)), np.ascontiguousarray(probes()[:probed].T), []
            for q, question in enumerate(questions.column("question").to_pylist()):
                if everything:
                    places = np.arange(len(vectors))
                else:
                    if q % 16 == 0:
                        at = projected(asked[q : q + 16], model)
                        own = np.packbits(at > 0, axis=1).view("<u2")
                        values = probe_values(own, at, bits)
                    places = index.within(own[q % 16], values[q % 16], radius)
                score = (vectors[places] * asked[q]).sum(axis=1)
                if len(places) > k + 1:
                    least = np.partition(score, len(score) - k - 1)[len(score) - k - 1]
                    kept = score >= least
                    places, score = places[kept], score[kept]
                found = [(-s, i) for p, s in zip(places.tolist(), score.tolist(), strict=True) for i in ids[p]]
                out.extend((question, i, -s) for s, i in sorted(found)[: k + 1])
            columns = list(zip(*out, strict=True)) or [[], [], []]
            return pa.Table.from_arrays([pa.array(c, t.type) for c, t in zip(columns, schema, strict=True)], schema=schema)

        return best

    def met(questions: DataFrame, n: int, everything: bool) -> DataFrame:
        """The best ``k + 1`` of each of ``n`` questions, of the rows found for it or of all rows."""
        parts = max(1, -(-n // QUESTIONS), min(BLOCKS, -(-n // LEAST)))
        left = grouped.select("v", "ids", F.pmod(F.xxhash64("entry"), F.lit(blocks)).cast("int").alias("block"), F.explode(F.sequence(F.lit(0), F.lit(parts - 1))).alias("part"))
        right = questions.select("question", "v", F.explode(F.sequence(F.lit(0), F.lit(blocks - 1))).alias("block"), F.pmod(F.xxhash64("question"), F.lit(parts)).cast("int").alias("part"))
        found = left.groupBy("block", "part").cogroup(right.groupBy("block", "part")).applyInArrow(compare(everything), "question bigint, vec_id bigint, score double")
        order = Window.partitionBy("question").orderBy(F.desc("score"), "vec_id")
        return stored(found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k + 1), "best")

    best = met(distinct, asking, False)
    enough = best.groupBy("question").agg(F.count("*").alias("n")).where(F.col("n") >= min(k + 1, ids)).select("question")
    short = stored(distinct.join(enough, "question", "left_anti"), "short")
    rest = short.count()
    if rest:
        best = best.join(short.select("question"), "question", "left_anti").unionByName(met(short, rest, True))
    return answers(asked, distinct, best, k)


def sampled(grouped: DataFrame, n: int):
    """At most SAMPLE entries as an array, drawn by a hash of their ids."""
    import numpy as np

    share = min(1.0, SAMPLE / max(n, 1))
    drawn = grouped.where(F.pmod(F.xxhash64("entry", F.lit("sample")), F.lit(1 << 30)) < int(share * (1 << 30))).limit(2 * SAMPLE)
    found = [r["v"] for r in drawn.select("v").collect()] or [r["v"] for r in grouped.limit(1).select("v").collect()]
    return np.array(found, float)


def answers(asked: DataFrame, distinct: DataFrame, best: DataFrame, k: int) -> DataFrame:
    """The answers of each distinct question for all rows that ask it, without the row itself."""
    lists = best.groupBy("question").agg(F.array_sort(F.collect_list(F.struct("rank", "vec_id", "score"))).alias("found"))
    answered = distinct.join(lists, "question").select("v", "found")
    own = asked.join(answered, "v").select("id", F.slice(F.filter("found", lambda f: f["vec_id"] != F.col("id")), 1, k).alias("found"))
    return own.select(F.col("id").alias("query_id"), F.posexplode("found").alias("at", "f")).select(
        "query_id", (F.col("at") + 1).cast("int").alias("rank"), F.col("f.vec_id").alias("vec_id"), F.col("f.score").alias("score"))
