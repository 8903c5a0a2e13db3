"""From raw documents to packed sequences, stage by stage.

Each stage takes what its predecessor kept and is one operator of ``spark_refresh.llm``. All
but the last return documents with the columns they came with; their rules for nulls, empty
texts and repeated rows are those of the operators. Learned statistics (toxic language,
classes of near duplicates, benchmark windows, surrogates) come from the documents of the
stage and the tables beside them.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from spark_refresh.llm import decontamination, near_duplicates, packing, surrogates, toxicity
from spark_refresh.llm.common import fresh, stored, table

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]

KEY_SETTING = "spark.refresh.surrogates.key"

ORACLE_SQL = None  # learned scores, sketches, keyed hashes and token ids are beyond SQL


def surrogate_key(spark: SparkSession) -> str:
    """The secret of the surrogates, as the session names it; without it, one for tests."""
    return spark.conf.get(KEY_SETTING, "not a secret")


def toxicity_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the class-conditional models do not call toxic.

    Texts are scored apart from their rows; what is called toxic is kept as 128 bits of hash
    of its text, which decides the score.
    """
    mine, other = (fresh(docs, n) for n in ("mine", "other"))
    body = F.coalesce(docs["text"].cast("string"), F.lit(""))
    hashes = [F.xxhash64(body), F.xxhash64(F.lit(1), body)]
    rows = docs.select("doc_id", "text", hashes[0].alias(mine), hashes[1].alias(other))
    scored = toxicity.score(rows, table(spark, sf_dir, "labels"), keep=(mine, other))
    toxic = stored(scored.where("predicted = 1").select(F.col(mine).alias("h"), F.col(other).alias("g")).distinct(), "toxic")
    return docs.join(toxic, (hashes[0] == toxic["h"]) & (hashes[1] == toxic["g"]), "left_anti")


def near_duplicate_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each class of near duplicates: that with the smallest id.

    Rows with null ids stay; rows of one id are one document and stay or go together.
    """
    classes = near_duplicates.classes(docs)
    dropped = stored(classes.where("doc_id != class_id").select("doc_id").distinct(), "dropped")
    return _without(docs, dropped)


def decontamination_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no benchmark item."""
    found = decontamination.contaminated(docs, table(spark, sf_dir, "benchmark"))
    return _without(docs, stored(found.select("doc_id").distinct(), "contaminated"))


def surrogate_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, with personal data replaced."""
    return surrogates.replace(docs, surrogate_key(spark), counts=False)


def packing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of the documents and their places in sequences."""
    return packing.packed_documents(docs)


def _without(docs: DataFrame, dropped: DataFrame) -> DataFrame:
    gone = fresh(docs, "gone")
    return docs.join(dropped.select(F.col("doc_id").alias(gone)), docs["doc_id"] == F.col(gone), "left_anti")


STAGES: list[tuple[str, Stage]] = [
    ("toxicity", toxicity_stage),
    ("near_duplicates", near_duplicate_stage),
    ("decontamination", decontamination_stage),
    ("surrogates", surrogate_stage),
    ("packing", packing_stage),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``, each stored before the next."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = stored(stage(spark, docs, sf_dir), name)
    return docs
