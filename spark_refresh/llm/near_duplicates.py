"""Near duplicates by order MinHash, verified by banded alignment.

1. Equal texts (same words) are one text here; one row of each stands for all.
2. A sketch of a text takes, for each of ``BANDS`` hash functions, the two k-mers of
   ``SHINGLE`` words with the smallest hashes, each labelled with its number of occurrence,
   and keeps them in text order. Texts with an equal band are candidates; texts that keep
   the order of their words are far likelier to agree than texts that share words only.
   K-mers are short because the similarity is that of edits: where every fifth word differs,
   half of the k-mers of three words are still the same, but a third of those of five.
3. In each band's bucket, members whose lengths and words allow the similarity are compared.
   The words of a text are counted in ``BINS`` bins; what two texts share in each bin bounds
   from above how many words they can share, so no similar pair is passed over. Buckets of
   many members are compared block by block.
4. A pair is a link if the edit similarity of the words (1 - distance / longer length) is at
   least ``SIMILARITY``, decided by an alignment within the band of diagonals that allows it.
5. This goes in ``PASSES``. The first are for what is easily found: of a class so far one
   member stands in a bucket, each with the first that it may be similar to. The last one takes
   every pair of a bucket whose classes differ, in the first bucket that the two share: a few
   pairs of two classes, then all those of classes that are still apart. So two texts with an
   equal band and the similarity are in one class, whatever else fills their bucket.
6. Classes are the connected components of the links, found by label propagation over stored
   tables; each pass joins the classes of the one before.

Null and empty texts are in classes of their own, each row by itself; texts shorter than a
shingle are compared as a whole, by equality. Rows with null ids get a null class. Of equal
ids with different texts each text is compared; they share the smallest class. The class id
is the smallest id in it, so ties cannot occur. Empty tables give no rows.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import stored

SHINGLE = 3
SIMILARITY = 0.8
BANDS = 28
PASSES = ((1, False), (BANDS, False), (BANDS, True))  # bands, whether every pair of a bucket is compared
FEW = 4  # pairs of two classes that are aligned before all others, about
BINS = 1024  # of the words of a text
BLOCK = 2048  # members of a bucket that are compared with as many others at once, about
LARGE = 1000  # a class with more than this part of all texts is joined apart
SKETCHED = 40_000  # k-mers whose hashes for all bands are made together
WORD = re.compile(r"\w+")
ROUNDS = 60


def word_ids(text: str, memory: dict[str, int]):
    """A 32-bit number for each lower-cased word."""
    import numpy as np
    import xxhash

    words = WORD.findall(text.lower())
    if len(memory) > 500_000:
        memory.clear()
    for w in set(words):
        if w not in memory:
            memory[w] = xxhash.xxh32_intdigest(w)
    return np.array([memory[w] for w in words], np.uint32)


def _mixed(x):
    import numpy as np

    x = (x ^ x >> np.uint64(33)) * np.uint64(0xFF51AFD7ED558CCD)
    x = (x ^ x >> np.uint64(29)) * np.uint64(0xC4CEB9FE1A85EC53)
    return x ^ x >> np.uint64(32)


def _family(bands: int):
    """A mask and an odd factor of each band's hash function."""
    import random

    import numpy as np

    numbers = random.Random(20241)
    drawn = [(numbers.getrandbits(64), numbers.getrandbits(64) | 1) for _ in range(bands)]
    return (np.array(x, np.uint64) for x in zip(*drawn, strict=True))


_MASKS, _FACTORS = _family(BANDS)


def sketch(ids, bands: int = BANDS):
    """The hash of each band of a text's order MinHash sketch."""
    import numpy as np

    n = len(ids) - SHINGLE + 1
    with np.errstate(over="ignore"):
        if n < 1:
            whole = np.uint64(len(ids) + 1)
            for v in ids.tolist():
                whole = _mixed(np.array([whole * np.uint64(0x9E3779B97F4A7C15) + np.uint64(v)], np.uint64))[0]
            return _mixed(np.arange(1, bands + 1, dtype=np.uint64) * np.uint64(0xD6E8FEB86659FD93) + whole)
        wide = ids.astype(np.uint64)
        shingles = np.zeros(n, np.uint64)
        for i in range(SHINGLE):
            shingles = _mixed(shingles * np.uint64(0x9E3779B97F4A7C15) + wide[i : i + n])
        order = np.argsort(shingles, kind="stable")
        ranked = shingles[order]
        first = np.concatenate(([True], ranked[1:] != ranked[:-1]))
        at = np.arange(n)
        occurrence = np.zeros(n, np.uint64)
        occurrence[order] = (at - np.maximum.accumulate(np.where(first, at, 0))).astype(np.uint64)
        shingles = _mixed(shingles + occurrence * np.uint64(0xA0761D6478BD642F))
        lower, upper = np.zeros(bands, np.int64), np.zeros(bands, np.int64)
        masks, factors = _MASKS[:bands, None], _FACTORS[:bands, None]
        step, every = max(1, SKETCHED // n), np.arange(bands)
        for at in range(0, bands, step):
            some = slice(at, min(at + step, bands))
            h = (shingles ^ masks[some]) * factors[some]
            h ^= h >> np.uint64(32)
            i = j = h.argmin(axis=1)
            if n > 1:
                h[every[: len(i)], i] = np.uint64(0xFFFFFFFFFFFFFFFF)
                j = h.argmin(axis=1)
            lower[some], upper[some] = np.minimum(i, j), np.maximum(i, j)
        return _mixed(shingles[lower] * np.uint64(3) + shingles[upper])


def within(a, b, similarity: float = SIMILARITY) -> bool:
    """Whether the edit similarity of two sequences of numbers reaches the bound.

    First the words both have bound the distance from below; then furthest points on the
    diagonals of the band are followed, one edit after the other.
    """
    import numpy as np

    if len(a) > len(b):
        a, b = b, a
    n, m = len(a), len(b)
    most = int((1 - similarity) * m + 1e-9)
    if m - n > most:
        return False
    if n == 0:
        return m == 0
    bag, counts = np.unique(np.concatenate((a, b)), return_inverse=True)
    shared = np.minimum(np.bincount(counts[:n], minlength=len(bag)), np.bincount(counts[n:], minlength=len(bag))).sum()
    if m - shared > most:
        return False
    return _distance_within(a, b, most)


def _distance_within(a, b, most: int) -> bool:
    import numpy as np

    n, m = len(a), len(b)
    near = min(most, 40 + most // 8)
    if _furthest(a, b, near):  # few edits: edit by edit
        return True
    if near == most:
        return False
    # rows of the band, vectorised: the insertion chain is a running minimum
    width = 2 * most + 1
    big = 1 << 30
    offsets = np.arange(width)
    padded = np.full(m + 2 * most + 2, -1, np.int64)
    padded[most : most + m] = b
    column = offsets - most
    row = np.where((column >= 0) & (column <= m), column, big)
    for i in range(1, n + 1):
        column = i + offsets - most
        same = padded[i - 1 : i - 1 + width] == a[i - 1]
        best = row + ~same
        np.minimum(best[:-1], row[1:] + 1, out=best[:-1])
        best[(column < 0) | (column > m)] = big
        if 0 <= most - i < width:
            best[most - i] = i
        row = np.minimum.accumulate(best - offsets) + offsets
        row[(column < 0) | (column > m)] = big
        if row.min() > most:
            return False
    return bool(row[m - n + most] <= most)


def _furthest(a, b, most: int) -> bool:
    n, m = len(a), len(b)
    wanted = m - n
    if wanted > most:
        return False
    left, right = [*a.tolist(), -1], [*b.tolist(), -2]  # ends that equal nothing
    i = 0
    while left[i] == right[i]:
        i += 1
    if not wanted and i >= n:
        return True
    middle = most + 2
    reach, new = [-2] * (2 * middle + 1), [-2] * (2 * middle + 1)
    reach[middle] = i
    for edits in range(1, most + 1):
        rest = most - edits
        for k in range(max(-edits, wanted - rest), min(edits, wanted + rest) + 1):
            at = middle + k
            i, other, third = reach[at] + 1, reach[at - 1], reach[at + 1] + 1
            if other > i:
                i = other
            if third > i:
                i = third
            if i > n:
                i = n
            if i + k > m:
                i = m - k
            if i < 0 or i + k < 0:
                continue
            while left[i] == right[i + k]:
                i += 1
            new[at] = i
        reach, new = new, reach
        if reach[middle + wanted] >= n:
            return True
    return False


def bag(ids) -> tuple[int, bytes]:
    """How many words of a text fall in each bin: a scale, and a byte for each bin, rounded up."""
    import numpy as np

    counts = np.bincount(ids % BINS, minlength=BINS)
    scale = int(counts.max()) // 255 + 1
    return scale, (-(-counts // scale)).astype(np.uint8).tobytes()


def _sketched(batches: Iterator) -> Iterator:
    """(doc, text) to (doc, h, g, n, ids, bands, scale, bag)."""
    import pyarrow as pa
    import xxhash

    memory: dict[str, int] = {}
    for batch in batches:
        rows = []
        for value in batch.column(1):
            ids = word_ids(value.as_py() or "", memory)
            raw = ids.tobytes()
            rows.append((
                xxhash.xxh3_64_intdigest(raw) - (1 << 63), xxhash.xxh64_intdigest(raw) - (1 << 63), len(ids),
                raw, sketch(ids).astype("i8") if len(ids) else [], *bag(ids)))
        columns = list(zip(*rows, strict=True)) or [[]] * 7
        yield pa.RecordBatch.from_arrays(
            [batch.column(0), pa.array(columns[0], pa.int64()), pa.array(columns[1], pa.int64()), pa.array(columns[2], pa.int64()),
             pa.array(columns[3], pa.binary()), pa.array(columns[4], pa.list_(pa.int64())), pa.array(columns[5], pa.int64()),
             pa.array(columns[6], pa.binary())],
            names=["doc", "h", "g", "n", "ids", "bands", "scale", "bag"])


def _verified(batches: Iterator) -> Iterator:
    """(one, other, a_ids, b_ids) to the classes (a, b) that a link joins."""
    import numpy as np
    import pyarrow as pa

    for batch in batches:
        kept = [
            within(np.frombuffer(x, np.uint32), np.frombuffer(y, np.uint32))
            for x, y in zip(batch.column(2).to_pylist(), batch.column(3).to_pylist(), strict=True)]
        yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1)], names=["a", "b"]).filter(pa.array(kept, pa.bool_()))


def bucketed(texts: DataFrame) -> DataFrame:
    """(doc, at, bucket) of the texts that share a bucket of a band with another."""
    exploded = texts.select("doc", F.posexplode("bands").alias("at", "key"))
    keyed = stored(exploded.select("doc", F.col("at").cast("tinyint").alias("at"), F.xxhash64("at", "key").alias("bucket")), "bands")
    crowded = keyed.groupBy("bucket").agg(F.count("*").alias("members")).where("members > 1")
    return stored(keyed.join(crowded.select("bucket"), "bucket", "left_semi"), "buckets")


def cells(buckets: DataFrame, texts: DataFrame, every: bool) -> DataFrame:
    """Members of the buckets that hold several classes, in cells whose members are compared.

    Unless ``every`` member is wanted, one stands for its class in a bucket. A bucket of more
    than ``BLOCK`` members is dealt over blocks; it has a cell for each two of them, in which
    only those of different blocks (``side``) are compared.
    """
    if not every:
        buckets = buckets.groupBy("bucket", "class").agg(F.min("doc").alias("doc"), F.min("at").alias("at"))
    several = buckets.groupBy("bucket").agg(F.min("class").alias("one"), F.max("class").alias("other"), F.count("*").alias("members"))
    blocks = several.where("one < other").select("bucket", F.ceil(F.col("members") / BLOCK).cast("int").alias("blocks"))
    dealt = buckets.join(blocks, "bucket").withColumn("side", F.pmod(F.xxhash64("doc", "bucket"), F.col("blocks")).cast("int"))
    met = dealt.withColumn("met", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    low, high = F.least("side", "met"), F.greatest("side", "met")
    placed = met.select("doc", "class", "at", "side", (low < high).alias("across"), F.xxhash64("bucket", low, high).alias("cell"))
    more = F.col("bands") if every else F.array().cast("array<bigint>")
    return placed.join(texts.select("doc", "n", "scale", "bag", more.alias("bands")), "doc").select(
        "cell", "class", "doc", "at", "side", "across", "n", "scale", "bag", "bands")


def alike(rows, every: bool):
    """Pairs of members of a cell, of different classes, whose lengths and bags let them be similar.

    Rows come in order of cells. With ``every``, all such pairs, once each; else each member's first.
    """
    import numpy as np

    cell, group, doc, band, side, across, n, scale = (rows.column(i).to_numpy(zero_copy_only=False) for i in range(8))
    kind = np.uint16 if scale.max() <= 257 else np.uint32
    bags = np.frombuffer(b"".join(rows.column(8).to_pylist()), np.uint8).reshape(-1, BINS).astype(kind) * scale.astype(kind)[:, None]
    bands = np.array(rows.column(9).to_pylist(), np.int64) if every else None
    earlier = np.arange(BANDS) < band[:, None]
    waiting, start, found = np.arange(len(cell)), np.searchsorted(cell, cell), []
    for at in range(len(cell)):
        waiting = waiting[start[waiting] + at < waiting]
        if not len(waiting):
            break
        first = start[waiting] + at
        longer = np.maximum(n[first], n[waiting])
        most = ((1 - SIMILARITY) * longer + 1e-9).astype(np.int64)
        fit = (group[first] != group[waiting]) & (longer - np.minimum(n[first], n[waiting]) <= most)
        fit = np.flatnonzero(fit & (~across[waiting] | (side[first] != side[waiting])))
        shared = np.minimum(bags[first[fit]], bags[waiting[fit]]).sum(axis=1, dtype=np.int64)
        near = longer[fit] - shared <= most[fit]
        if every:  # a pair is taken in the first band that both share
            near &= ~((bands[first[fit]] == bands[waiting[fit]]) & earlier[waiting[fit]]).any(axis=1)
        fit, shared = fit[near], shared[near]
        found.append((first[fit], waiting[fit], shared * 1000 // longer[fit]))
        if not every:
            waiting = np.delete(waiting, fit)
    one, two, share = (np.concatenate(x) for x in zip(*found, strict=True)) if found else (np.zeros(0, np.int64),) * 3
    swapped = group[one] > group[two]
    one, two = np.where(swapped, two, one), np.where(swapped, one, two)
    return group[one], group[two], doc[one], doc[two], share


def _paired(every: bool):
    """Members in order of cells to (a, b, one, other, share): classes, and their members to compare."""

    def pair(batches: Iterator) -> Iterator:
        import pyarrow as pa

        def pairs(rows):
            return pa.RecordBatch.from_arrays([pa.array(x, pa.int64()) for x in alike(rows, every)], names=["a", "b", "one", "other", "share"])

        rest = None
        for batch in batches:
            rows = pa.Table.from_batches([batch] if rest is None else [*rest.to_batches(), batch]).combine_chunks()
            whole = rows.column(0).to_numpy().searchsorted(rows.column(0)[-1].as_py()) if len(rows) else 0
            if whole:  # the last cell may go on in the next batch
                yield pairs(rows.slice(0, whole))
            rest = rows.slice(whole)
        if rest is not None and len(rest):
            yield pairs(rest)

    return pair


def candidates(members: DataFrame, every: bool) -> DataFrame:
    """(a, b, one, other, share): members ``one`` and ``other`` of the classes ``a`` and ``b`` to compare.

    Unless ``every`` pair is wanted, two classes have one.
    """
    ordered = members.repartition("cell").sortWithinPartitions("cell", "class", "doc")
    pairs = ordered.mapInArrow(_paired(every), "a bigint, b bigint, one bigint, other bigint, share bigint")
    return pairs if every else best(pairs, 1)


def best(pairs: DataFrame, most: int) -> DataFrame:
    """At most so many pairs of two classes, of those that may share most words."""
    drawn = F.pmod(F.xxhash64("one", "other"), F.lit(most)).alias("drawn")
    return pairs.groupBy("a", "b", drawn).agg(F.max(F.struct("share", "one", "other")).alias("pair")).select("a", "b", "pair.one", "pair.other", "pair.share")


def aligned(pairs: DataFrame, ids: DataFrame) -> DataFrame:
    """(node, root) of the classes that the links among the pairs join."""
    both = pairs.join(ids.select(F.col("doc").alias("one"), F.col("ids").alias("a_ids")), "one").join(
        ids.select(F.col("doc").alias("other"), F.col("ids").alias("b_ids")), "other").select("a", "b", "a_ids", "b_ids")
    return components(stored(both.mapInArrow(_verified, "a bigint, b bigint"), "links"))


def followed(roots: DataFrame | None, joined: DataFrame) -> DataFrame:
    """(node, root) of all that are in another's class, after classes have been joined."""
    moved = joined.where("node != root")
    if roots is not None:
        before = roots.join(joined.select(F.col("node").alias("root"), F.col("root").alias("next")), "root", "left")
        moved = moved.unionByName(before.select("node", F.coalesce("next", "root").alias("root")))
    return stored(moved, "classes")


def links(df: DataFrame, doc_id: str, text: str) -> tuple[DataFrame, DataFrame]:
    """(rows with the text that stands for each, (node, root) of the texts that are in another's class)."""
    source = df.where(df[doc_id].isNotNull()).select(df[doc_id].cast("long").alias("doc"), df[text].cast("string").alias("text"))
    sketched = stored(
        source.mapInArrow(_sketched, "doc bigint, h bigint, g bigint, n bigint, ids binary, bands array<bigint>, scale bigint, bag binary"),
        "sketches", "zstd")
    full = sketched.where("n > 0")
    groups = stored(full.groupBy("h", "g").agg(F.min("doc").alias("stands")), "texts")
    standing = full.join(groups, (full["h"] == groups["h"]) & (full["g"] == groups["g"]) & (full["doc"] == groups["stands"]), "left_semi")
    texts = stored(standing.dropDuplicates(["doc", "h", "g"]).select(F.xxhash64("h", "g").alias("doc"), "n", "ids", "bands", "scale", "bag"), "standing", "zstd")
    buckets, ids, roots, tried = bucketed(texts), texts.select("doc", "ids"), None, None
    for bands, every in PASSES:
        classed = buckets.where(F.col("at") < bands).withColumn("class", F.col("doc"))
        if roots is not None:
            classed = classed.drop("class").join(roots.withColumnRenamed("node", "doc"), "doc", "left").select(
                "doc", "at", "bucket", F.coalesce("root", "doc").alias("class"))
        pairs = candidates(cells(classed, texts, every), every)
        if tried is not None:
            pairs = pairs.join(tried, (F.least("one", "other") == tried["x"]) & (F.greatest("one", "other") == tried["y"]), "left_anti")
        pairs = stored(pairs, "pairs")
        some = stored(best(pairs, FEW), "few") if every else pairs
        joined = aligned(some, ids)
        roots = followed(roots, joined)
        if every:
            rest = pairs.join(some.select("one", "other"), ["one", "other"], "left_anti")
            for side in ("a", "b"):
                now = joined.select(F.col("node").alias(side), F.col("root").alias("now"))
                rest = rest.join(now, side, "left").withColumn(side, F.coalesce("now", side)).drop("now")
            roots = followed(roots, aligned(stored(rest.where("a != b"), "rest"), ids))
        tested = pairs.select(F.least("one", "other").alias("x"), F.greatest("one", "other").alias("y"))
        tried = tested if tried is None else tried.unionByName(tested)
    members = sketched.select("doc", F.when(F.col("n") > 0, F.xxhash64("h", "g")).alias("words"))
    return members, roots


def components(pairs: DataFrame) -> DataFrame:
    """(node, root): the smallest node of each connected component, of nodes that have a pair.

    Each round links every node with the smallest node near it and then with the smallest of
    that one's, over stored tables, until nothing changes; chains shrink by halving.
    """
    edges = stored(pairs.unionByName(pairs.select(F.col("b").alias("a"), F.col("a").alias("b"))).where("a != b").distinct(), "edges")
    state = stored(edges.groupBy("a").agg(F.min("b").alias("b")).select(F.col("a").alias("node"), F.least("a", "b").alias("root")), "roots")
    for _ in range(ROUNDS):
        near = edges.join(state.select(F.col("node").alias("b"), F.col("root").alias("near")), "b").groupBy("a").agg(F.min("near").alias("near"))
        hooked = state.join(near.withColumnRenamed("a", "node"), "node").select("node", F.col("root").alias("before"), F.least("root", "near").alias("root"))
        # a root that its members see a smaller root from follows them
        moved = hooked.where("root < before").groupBy(F.col("before").alias("node")).agg(F.min("root").alias("pulled"))
        pulled = stored(hooked.join(moved, "node", "left").select("node", "before", F.least("root", F.coalesce("pulled", "root")).alias("root")), "hooked")
        jumped = pulled.join(pulled.select(F.col("node").alias("root"), F.col("root").alias("next")), "root", "left")
        state = stored(jumped.select("node", "before", F.coalesce("next", "root").alias("root")), "roots")
        if state.where("root != before").isEmpty():
            break
    else:
        raise RuntimeError("components did not settle")
    return state.select("node", "root")


def classes(df: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """``doc_id``, ``class_id`` (the smallest id of its class) and ``class_size`` of each row."""
    members, roots = links(df, doc_id, text)
    rooted = members.join(roots.withColumnRenamed("node", "words"), "words", "left").select(
        "doc", F.coalesce("root", "words").alias("root"))
    # rows of one id are one document, whatever its texts are; without words each is by itself
    named = rooted.where("root IS NOT NULL").groupBy("root").agg(F.min("doc").alias("class_id"), F.count("*").alias("class_size"))
    # rows of the few large classes are not sent to one task each
    named = stored(named, "named")
    large = F.col("class_size") > F.lit(named.agg(F.sum("class_size").alias("n")).first()["n"] or 0) / LARGE
    few = F.broadcast(named.where(large))  # at most LARGE classes
    rest = rooted.join(few.select("root"), "root", "left_anti").join(named.where(~large), "root", "left")
    joined = rooted.join(few, "root").unionByName(rest)
    placed = joined.select("doc", F.coalesce("class_id", "doc").alias("class_id"), F.coalesce("class_size", F.lit(1)).alias("class_size"))
    lost = df.where(df[doc_id].isNull()).select(df[doc_id].cast("long").alias("doc"), F.lit(None).cast("long").alias("class_id"), F.lit(1).cast("long").alias("class_size"))
    return placed.unionByName(lost).select(F.col("doc").cast(df.schema[doc_id].dataType).alias("doc_id"), "class_id", "class_size")
