"""Registered queries: each operator over its whole table, and SQL where SQL can say the same."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

import corpus_pipeline

from . import (
    bpe_count,
    decontamination,
    extraction,
    fingerprints,
    hashing_search,
    near_duplicates,
    packing,
    repeats,
    resampling,
    sharding,
    spelling,
    surrogates,
    toxicity,
)
from .common import table

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(sql: str | None = None):
    def register(function):
        QUERIES[function.__name__] = function
        if sql is not None:
            ORACLES[function.__name__] = sql.strip()
        return function

    return register


@query()
def op1_order_minhash_classes(spark: SparkSession, folder: str) -> DataFrame:
    return near_duplicates.classes(table(spark, folder, "documents"))


@query()
def op2_linear_grouping_packing(spark: SparkSession, folder: str) -> DataFrame:
    return packing.packed_documents(table(spark, folder, "documents"))


@query()
def op3_multi_index_hashing(spark: SparkSession, folder: str) -> DataFrame:
    return hashing_search.search(table(spark, folder, "embeddings"))


@query()
def op4_template_decontamination(spark: SparkSession, folder: str) -> DataFrame:
    return decontamination.contaminated(table(spark, folder, "documents"), table(spark, folder, "benchmark"))


@query()
def op5_tree_scored_text(spark: SparkSession, folder: str) -> DataFrame:
    return extraction.extract(table(spark, folder, "pages"))


@query()
def op6_piece_bpe_counts(spark: SparkSession, folder: str) -> DataFrame:
    return bpe_count.count_tokens(table(spark, folder, "documents"))


@query()
def op7_sampled_splitter_shards(spark: SparkSession, folder: str) -> DataFrame:
    return sharding.shard(table(spark, folder, "documents"))


@query()
def op8_repeated_phrase_automata(spark: SparkSession, folder: str) -> DataFrame:
    return repeats.deduplicate(table(spark, folder, "documents"))


@query()
def op9_kneser_ney_toxicity(spark: SparkSession, folder: str) -> DataFrame:
    return toxicity.score(table(spark, folder, "documents"), table(spark, folder, "labels"))


@query()
def op10_keyed_surrogates(spark: SparkSession, folder: str) -> DataFrame:
    return surrogates.replace(table(spark, folder, "documents").select("doc_id", "text"), corpus_pipeline.surrogate_key(spark))


@query()
def op11_line_resampling(spark: SparkSession, folder: str) -> DataFrame:
    return resampling.resample(table(spark, folder, "documents"), table(spark, folder, "benchmark"))


@query()
def op12_reduced_alphabet_variants(spark: SparkSession, folder: str) -> DataFrame:
    return spelling.variants(table(spark, folder, "documents"))


@query()
def op13_bottom_k_fingerprints(spark: SparkSession, folder: str) -> DataFrame:
    return fingerprints.edited(table(spark, folder, "documents"))


@query(corpus_pipeline.ORACLE_SQL)
def pipeline(spark: SparkSession, folder: str) -> DataFrame:
    return corpus_pipeline.run(spark, folder)
