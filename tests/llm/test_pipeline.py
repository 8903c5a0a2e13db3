from __future__ import annotations

import pytest
from cases import rows_of
from conftest import SMALL

import corpus_pipeline
from spark_refresh.llm import decontamination, near_duplicates, toxicity


def test_stages_keep_what_their_operators_say(spark, tmp_path):
    docs = spark.read.parquet(f"{SMALL}/documents.parquet")
    for number, (_, stage) in enumerate(corpus_pipeline.STAGES):
        before = docs
        out = stage(spark, docs, SMALL)
        out.write.parquet(str(tmp_path / str(number)))
        docs = spark.read.parquet(str(tmp_path / str(number)))
        if number < 4:
            assert docs.columns == before.columns
        ids = {r["doc_id"] for r in docs.select("doc_id").collect()}
        had = {r["doc_id"] for r in before.select("doc_id").collect()}
        if number == 0:
            labels = spark.read.parquet(f"{SMALL}/labels.parquet")
            assert had - ids == {r["doc_id"] for r in rows_of(toxicity.score(before, labels)) if r["predicted"]}
        elif number == 1:
            assert ids == {r["class_id"] for r in rows_of(near_duplicates.classes(before))}
        elif number == 2:
            items = spark.read.parquet(f"{SMALL}/benchmark.parquet")
            assert had - ids == {r["doc_id"] for r in rows_of(decontamination.contaminated(before, items))}
        else:
            assert ids == had
    assert {"doc_id", "sequence_id", "offset", "length"} <= set(docs.columns)


@pytest.mark.parametrize("stage", [s for _, s in corpus_pipeline.STAGES])
def test_stages_take_awkward_documents(spark, stage):
    rows = [(None, None, None, None, None, 1), (1, "", "en", "s", 0, 1), (1, "", "en", "s", 0, 1), (2, "call +1 (217) 555-7713 now", "en", "s", 3, 2)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, lang string, source string, n_chars bigint, score int")
    out = stage(spark, docs, SMALL)
    assert out.count() == 4
    assert stage(spark, docs.where("false"), SMALL).count() == 0
