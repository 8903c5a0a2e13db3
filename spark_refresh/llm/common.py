"""Small helpers the operators share."""

from __future__ import annotations

import os
import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from spark_refresh.sources.scratch import fresh_folder, written

__all__ = ["fresh", "stored", "table", "text_or_empty", "tokenizer_file", "xxhash_words"]


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def text_or_empty(name: str) -> Column:
    return F.coalesce(F.col(name).cast("string"), F.lit(""))


def fresh(df: DataFrame, label: str) -> str:
    """A column name that no column of the frame has, so that extra columns cannot clash."""
    name = f"_{label}"
    while name.lower() in {c.lower() for c in df.columns}:
        name = f"_{label}_{uuid.uuid4().hex[:8]}"
    return name


def stored(df: DataFrame, label: str, compression: str | None = None) -> DataFrame:
    """The frame as a table in the shared working folder: lost executors cost no recomputation."""
    if compression is None:
        return written(df, label)
    folder = fresh_folder(df.sparkSession, label)
    df.write.option("compression", compression).parquet(folder)
    return df.sparkSession.read.schema(df.schema).parquet(folder)


def tokenizer_file(name: str, folder: str | None = None) -> str:
    """A vocabulary file of the installed public tokenizers, or of ``folder``."""
    if folder is not None:
        return os.path.join(folder, name)
    import public_tokenizers

    return str(public_tokenizers.path(name))


def xxhash_words(words: list[str]):
    """A 64-bit hash of each word, the same in every process."""
    import numpy as np
    import xxhash

    return np.array([xxhash.xxh64_intdigest(w) for w in words], dtype=np.uint64)
