"""Documents that hold benchmark items, found through templates, with built-in functions only.

1. A text becomes tokens, once: words in lower case; numbers (also spelled out), units after
   them and names (capitals within a sentence) become typed placeholders that remember what
   they stand for.
2. Windows of ``WINDOW`` tokens are hashed from the hashes of their tokens. A bit map of the
   items' windows, sized by their number, lets through the windows of documents that may be
   among them; a hash join decides. Templates and plain tokens are tested in the same scan.
3. A document that holds ``SHARE`` of an item's windows holds at least one of any
   (1 - SHARE) of them and one more: the windows that fewest documents have make the
   candidates, so a phrase that many items and documents share does not multiply.
4. A candidate counts if it holds ``SHARE`` of the item's windows and its slots are consistent:
   nearly each value in the item stands for one value in the document (for as many as there are
   repetitions of the item's windows), which tells re-parameterised questions from chance.
5. The same search runs with the tokens themselves in place of placeholders, so that an item
   held as it is counts, whatever share of it are numbers and names.

Whether an item's first word is a name depends on what stands before it, so an item takes part
both ways. Windows with fewer than ``LITERALS`` words are counted only as they are. An item
shorter than a window is one window, looked for in windows of its length. Null texts and null
ids take no part; items of equal text are all reported; repeated rows of one id are one
document. Empty tables give no rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import stored

WINDOW = 5
SHARE = 0.8
CONSISTENT = 0.9  # of an item's values
LITERALS = 3
BITS = 64  # of the bit map for each window, two of them set
MOST_BITS = 24  # the bit map has at most 2^24 bits, so it serves up to 260,000 windows with full sharpness
SECOND = 26  # place in the hash of the second bit's number
# what a match begins with is asked first: it is cheaper than to look behind, and seldom there
NAME = r"(?=\p{Lu})(?<=[\p{L}\p{N},;:%&*#$)'’\"] )\p{Lu}\p{Ll}[\p{L}'’]*"
UNITS = ("kg|g|mg|lbs?|pounds?|ounces?|km|cm|mm|m|miles?|feet|foot|inch(?:es)?|yards?|l|ml|litres?|liters?|gallons?|h|hours?|minutes?|seconds?|"
         "days?|weeks?|months?|years?|dollars?|cents?|euros?|pence|percent|degrees?|mph|kmh|kw|watts?|volts?|hz|kb|mb|gb|tb")
NUMBER_WORDS = ("one|t(?:wo|hree|en|welve|hirteen|wenty|hirty|housand)|f(?:our|ive|ourteen|ifteen|orty|ifty)|s(?:ix|even|ixteen|eventeen|ixty|eventy)|"
                "e(?:ight|leven|ighteen|ighty)|n(?:ine|ineteen|inety)|hundred|million|billion|dozen")
SPELLED = rf"(?i:(?:{NUMBER_WORDS})(?:(?:-| and | )(?:{NUMBER_WORDS}))*)(?![\p{{L}}])"
DIGITS = r"\d+(?:[.,]\d+)*"
NUMBER = rf"(?=[\dBDEFHMNOSTbdefhmnost])(?:{DIGITS}|(?<![\p{{L}}]){SPELLED})"
VALUE = rf"\x02(?:[\d.,]*\d|{SPELLED})"
TOKEN = rf"\x01[\p{{L}}'’]+|{VALUE}|\x03\p{{L}}+|\p{{L}}[\p{{L}}\p{{M}}]*"


def tokens(text: Column) -> Column:
    """Words in lower case, and placeholders with their value: name, number, unit are marked by \\x01, \\x02, \\x03."""
    for mark in "\x01\x02\x03":
        text = F.replace(text, F.lit(mark), F.lit(" "))
    named = F.regexp_replace(text, NAME, "\x01$0")
    numbered = F.regexp_replace(F.regexp_replace(named, NUMBER, "\x02$0 "), rf"(?i)({VALUE} {{1,2}}-?)({UNITS})(?![\p{{L}}])", "$1\x03$2")
    return F.regexp_extract_all(F.lower(numbered), F.lit(f"({TOKEN})"), F.lit(0))


def template(found: Column) -> Column:
    """A hash of each token, placeholders by their kind."""
    return F.transform(found, lambda t: F.xxhash64(F.when(t < "\x04", F.left(t, F.lit(1))).otherwise(t)))


def verbatim(found: Column) -> Column:
    """A hash of each token, placeholders by what they stand for."""
    return F.transform(found, lambda t: F.xxhash64(F.when(t < "\x04", F.substring(t, 2, 1 << 30)).otherwise(t)))


def window_hashes(parts: Column, length: int) -> Column:
    """The hash of each window of so many tokens, by its place; no window in shorter texts."""
    starts = F.slice(parts, 1, F.greatest(F.size(parts) - (length - 1), F.lit(0)))
    # the same hash as that of a slice, which would copy the array for each window
    return F.transform(starts, lambda x, i: F.xxhash64(x, *(F.get(parts, i + j) for j in range(1, length))))


def item_tokens(items: DataFrame, item_id: str, text: str) -> DataFrame:
    """``item_id`` and ``found``, with the first word as at the start of a text and as within one."""
    body = items[text].cast("string")
    known = items.where(items[item_id].isNotNull() & items[text].isNotNull())
    return known.select(items[item_id].alias("item_id"), F.explode(F.array(tokens(body), tokens(F.concat(F.lit(": "), body)))).alias("found")).where(
        F.size("found") > 0).distinct()


def item_windows(cut: DataFrame, parts: Column, literals: int) -> DataFrame:
    """``item_id`` (the item and its tokens' hash), ``place``, ``hash``, ``values`` of each window that counts."""
    own = F.struct("item_id", F.xxhash64("found").alias("form")).alias("item_id")
    places = F.sequence(F.lit(0), F.greatest(F.size("found") - WINDOW, F.lit(0)))
    values = F.slice("found", F.col("place") + 1, WINDOW)
    each = cut.withColumn("parts", parts).select(own, "found", "parts", F.explode(places).alias("place")).select(
        "item_id", "place", F.xxhash64(F.slice("parts", F.col("place") + 1, WINDOW)).alias("hash"), values.alias("values"))
    literal = F.size(F.filter("values", lambda t: t >= "\x04"))
    return each.where(literal >= F.least(F.lit(literals), F.size("values")))


def bit_map(windows: DataFrame) -> tuple[list[int], int]:
    """Two bits set for each of the windows' hashes, as longs, and the number of bits (as a power of two)."""
    hashes = windows.select("hash").distinct()
    power = max(10, min(MOST_BITS, (hashes.count() * BITS).bit_length()))
    mask = F.lit((1 << power) - 1)
    both = hashes.select(F.explode(F.array(F.col("hash").bitwiseAND(mask), F.shiftright("hash", SECOND).bitwiseAND(mask))).alias("at"))
    words = both.select(F.shiftright("at", 6).cast("int").alias("word"), F.expr("shiftleft(1L, cast(at & 63 as int))").alias("bit"))
    out = [0] * (1 << (power - 6))
    for r in words.groupBy("word").agg(F.bit_or("bit").alias("bits")).collect():
        out[r["word"]] = r["bits"]
    return out, power


def contaminated(
    df: DataFrame, items: DataFrame, doc_id: str = "doc_id", text: str = "text", item_id: str = "item_id", item_text: str = "text",
) -> DataFrame:
    """``doc_id``, ``item_id``, ``share`` (of the item's windows), ``slots``, ``consistent`` of each find."""
    cut = stored(item_tokens(items, item_id, item_text), "items")
    short = cut.select(F.size("found").alias("n")).where(F.col("n") < WINDOW).distinct()
    lengths = sorted([r["n"] for r in short.collect()] + [WINDOW])
    windows = stored(item_windows(cut, template(F.col("found")), LITERALS), "item_windows")
    # the words are the same in both forms of an item
    plain = cut.groupBy("item_id", verbatim(F.col("found")).alias("parts")).agg(F.min("found").alias("found"))
    words = stored(item_windows(plain, F.col("parts"), 0), "plain_windows")

    named = df.where(df[doc_id].isNotNull() & df[text].isNotNull()).select(
        df[doc_id].cast("long").alias("doc_id"), tokens(df[text].cast("string")).alias("found"))
    hits = stored(marked(named, {"hits": (template, windows), "same": (verbatim, words)}, lengths), "hits")
    judged = consistent(hits, holding(hits, "hits", windows), windows).where(F.col("consistent") >= CONSISTENT)
    same = holding(hits, "same", words)
    both = judged.unionByName(same.select("doc_id", "item_id", "share", F.lit(0).cast("long").alias("slots"), F.lit(1.0).alias("consistent")))
    best = both.groupBy("doc_id", F.col("item_id.item_id").alias("item_id")).agg(F.max(F.struct("share", "slots", "consistent")).alias("best"))
    return best.select(F.col("doc_id").cast(df.schema[doc_id].dataType).alias("doc_id"), "item_id", "best.*")


def marked(named: DataFrame, forms: dict, lengths: list[int]) -> DataFrame:
    """Documents with windows that items may have, in any of the forms (name: how tokens are
    hashed, the items' windows): ``place`` and ``hash`` of these windows. One scan."""
    rows = named
    for form, (hashed, windows) in forms.items():
        bits, power = bit_map(windows)
        maps, found = F.split(F.lit(",".join(map(str, bits))), ",").cast("array<bigint>"), []
        rows = rows.withColumn(f"{form}_parts", hashed(F.col("found")))
        for length in lengths:
            name = f"{form}_{length}"
            rows = rows.withColumn(name, window_hashes(F.col(f"{form}_parts"), length))
            found.append(_passed(F.col(name), maps, (1 << power) - 1))
        rows = rows.withColumn(form, F.concat(*found))
    # the row number keeps the filter from being pushed below, where the hits would be made twice
    rows = rows.select("doc_id", "found", *forms, F.monotonically_increasing_id().alias("row"))
    return rows.where(" OR ".join(f"size({form}) > 0" for form in forms))


def _passed(hashes: Column, maps: Column, mask: int) -> Column:
    """``place`` and ``hash`` of the windows whose bits are set."""

    def is_set(at: Column) -> Column:
        word = F.get(maps, F.shiftright(at.bitwiseAND(F.lit(mask)), 6).cast("int"))
        return F.getbit(word, at.bitwiseAND(F.lit(63)).cast("int")) == 1

    def kept(h: Column, i: Column) -> Column:
        return F.when(is_set(h) & is_set(F.shiftright(h, SECOND)), F.struct(i.alias("place"), h.alias("hash")))

    return F.array_compact(F.transform(hashes, kept))


def holding(hits: DataFrame, form: str, windows: DataFrame) -> DataFrame:
    """Pairs of documents and items with the ``share`` of the item's windows that the document has, if it is enough."""
    each = hits.select("doc_id", F.explode(F.array_distinct(F.transform(form, lambda s: s["hash"]))).alias("hash"))
    wanted = windows.select("item_id", "hash").distinct()
    present = stored(each.join(wanted.select("hash").distinct(), "hash", "left_semi"), "present")
    frequency = present.groupBy("hash").agg(F.count("*").alias("documents"))
    ranked = wanted.join(frequency, "hash", "left").select(
        "item_id", "hash", F.count("*").over(Window.partitionBy("item_id")).alias("n"),
        F.row_number().over(Window.partitionBy("item_id").orderBy(F.coalesce("documents", F.lit(0)), "hash")).alias("nth"))
    prefix = stored(ranked.where(F.col("nth") <= F.col("n") - F.ceil(F.col("n") * SHARE) + 1).select("item_id", "hash", "n"), "prefix")
    pairs = stored(present.join(prefix.select("item_id", "hash"), "hash").select("doc_id", "item_id").distinct(), "pairs")

    held = hits.select("doc_id", F.transform(form, lambda s: s["hash"]).alias("hashes"))
    sets = wanted.groupBy("item_id").agg(F.collect_set("hash").alias("wanted"))
    shared = F.size(F.array_intersect("wanted", "hashes")) / F.size("wanted")
    enough = pairs.join(held, "doc_id").join(sets, "item_id").select("doc_id", "item_id", shared.alias("share")).where(F.col("share") >= SHARE)
    return stored(enough.groupBy("doc_id", "item_id").agg(F.max("share").alias("share")), "enough")


def consistent(hits: DataFrame, enough: DataFrame, windows: DataFrame) -> DataFrame:
    """The pairs with the number of their ``slots`` and the share of these that are ``consistent``."""
    slotted = windows.where(F.exists("values", lambda v: v < "\x04")).select("item_id", "hash", "values")
    inside = windows.groupBy("item_id", "hash").agg(F.count("*").alias("inside"))
    found = enough.join(hits, "doc_id").select("doc_id", "item_id", "found", F.explode("hits").alias("hit")).select(
        "doc_id", "item_id", F.col("hit.place").alias("at"), F.col("hit.hash").alias("hash"), F.slice("found", F.col("hit.place") + 1, WINDOW).alias("there"))
    facing = found.join(slotted, ["item_id", "hash"]).select(
        "doc_id", "item_id", "hash", "at", F.explode(F.arrays_zip(F.col("values"), F.col("there"))).alias("slot")).where(F.col("slot.values") < "\x04")
    repeats = facing.groupBy("doc_id", "item_id", "hash", F.col("slot.values").alias("value")).agg(F.count_distinct("at").alias("times"))
    repeats = repeats.join(inside, ["item_id", "hash"]).withColumn("times", F.ceil(F.col("times") / F.col("inside")))
    most = repeats.groupBy("doc_id", "item_id", "value").agg(F.max("times").alias("times"))
    meant = facing.groupBy("doc_id", "item_id", F.col("slot.values").alias("value")).agg(F.count_distinct("slot.there").alias("kinds"))
    agreed = meant.join(most, ["doc_id", "item_id", "value"]).groupBy("doc_id", "item_id").agg(
        F.count("*").alias("slots"), F.avg((F.col("kinds") <= F.col("times")).cast("double")).alias("consistent"))
    return enough.join(agreed, ["doc_id", "item_id"], "left").select(
        "doc_id", "item_id", "share", F.coalesce("slots", F.lit(0)).alias("slots"), F.coalesce("consistent", F.lit(1.0)).alias("consistent"))
