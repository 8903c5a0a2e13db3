"""Documents with the awkward cases, shared by the tests."""

from __future__ import annotations

import random

from pyspark.sql import DataFrame, SparkSession

#: Extra columns carry names that operators use inside.
SCHEMA = "doc_id bigint, text string, lang string, size int, shard string, length string, hits int, score string, `row` int, ids int"
SYLLABLES = "ba ce di fo gu ha ke li mo nu pa re si to vu".split()


def word(r: random.Random) -> str:
    return "".join(r.choice(SYLLABLES) for _ in range(r.randint(1, 4)))


def prose(seed: int, words: int) -> str:
    r = random.Random(seed)
    return " ".join(word(r) + ("." if i % 11 == 10 else "") for i in range(words))


def awkward() -> list[tuple]:
    """(doc_id, text): nulls, empty, repeated rows, ties, a very long text and odd characters."""
    long = prose(1, 30_000)
    return [
        (None, None), (None, "text of a row without id"), (1, None), (2, ""), (3, " \n\t "), (4, prose(4, 120)), (4, prose(4, 120)),
        (5, prose(4, 120)), (6, long), (7, long + " end"), (8, "日本語 テスト ▁ 🙂 é́ \u0000 x"), (9, "one"), (10, "one two three"),
        (11, prose(11, 60)), (12, prose(12, 300)), (13, prose(12, 300).replace("ba", "be", 3)),
    ]


def frame(spark: SparkSession, rows: list[tuple]) -> DataFrame:
    return spark.createDataFrame([(d, t, None, 1, "s", "l", 2, None, 3, 4) for d, t in rows], SCHEMA)


def rows_of(df: DataFrame) -> list[dict]:
    return [r.asDict() for r in df.collect()]
