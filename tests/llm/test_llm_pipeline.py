"""The pipeline's stages, each on its own input."""

import corpus_pipeline
import pytest

from tidemark.llm import packing, simhash
from tidemark.llm.queries import tokenizer


@pytest.fixture(scope="module")
def results(spark, sf_dir, tmp_path_factory):
    folder, docs, found = tmp_path_factory.mktemp("stages"), spark.read.parquet(f"{sf_dir}/documents.parquet"), {}
    for name, step in corpus_pipeline.STAGES:
        step(spark, docs, sf_dir).write.parquet(f"{folder}/{name}")
        before, docs = docs, spark.read.parquet(f"{folder}/{name}")
        found[name] = (before, docs)
    return found


def test_filters_return_documents_and_take_effect(spark, sf_dir, results):
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    for name, label, bad in (("quality", "quality", 0), ("toxicity", "toxic", 1)):
        before, after = results[name]
        assert after.columns == before.columns and 0 < after.count() <= before.count()
        clean = before.join(labels.filter(f"{label} = {1 - bad}"), "doc_id")
        assert after.join(clean.select("doc_id"), "doc_id").count() > 0.95 * clean.count()


def test_one_document_of_each_group_stays(results):
    before, after = results["near_duplicates"]
    groups = {r["component_id"] for r in simhash.near_duplicates(before).collect()}
    assert {r["doc_id"] for r in after.collect()} == groups and after.columns == before.columns


def test_packing_holds_what_is_left(results):
    before, after = results["packing"]
    assert {r["doc_id"] for r in before.collect()} == {r["doc_id"] for r in after.collect()}
    again = packing.pack(before, tokenizer("word_bpe_49k.json"))
    assert again.exceptAll(after).count() == 0


def test_run_gives_the_last_stage(spark, sf_dir, results):
    assert corpus_pipeline.run(spark, sf_dir).exceptAll(results["packing"][1]).count() == 0
