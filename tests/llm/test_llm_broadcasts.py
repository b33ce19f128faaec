"""Joins whose sides grow with the input are shuffled, however small Spark takes the sides to be."""

import numpy as np
import pytest
from conftest import plan_of

import corpus_pipeline
from tidemark.llm import ranking, simhash


@pytest.fixture
def stored(spark, tmp_path):
    """A table that Spark sizes by its file, as it does the tables of a folder."""

    def store(rows, shape, name="documents"):
        spark.createDataFrame(rows, shape).coalesce(1).write.parquet(f"{tmp_path}/{name}")
        return spark.read.parquet(f"{tmp_path}/{name}")

    return store


@pytest.fixture
def most_broadcast(spark):
    """The largest table that may be broadcast; building a larger one is an error, as where the driver has no room for it."""
    key = "spark.sql.maxBroadcastTableSize"
    before = spark.conf.get(key)
    yield lambda size: spark.conf.set(key, size)
    spark.conf.set(key, before)


def broadcast_sides(df) -> list[str]:
    """The joins of the plan that broadcast, but for those with a table of links."""
    joins = [x for x in plan_of(df).split("== Physical Plan ==")[1].splitlines() if "BroadcastHashJoin" in x]
    return [x for x in joins if "[root#" not in x and "LeftOuter" not in x]


def made_texts(n: int) -> list[str]:
    """Texts of 30 words, each third one a copy of its predecessor with one word less."""
    rng = np.random.default_rng(3)
    texts = [" ".join(map(str, rng.integers(0, 1 << 40, 30))) for _ in range(n)]
    for i in range(2, n, 3):
        texts[i] = texts[i - 1].rpartition(" ")[0]
    return texts


def test_keys_of_few_fingerprints_are_not_broadcast(stored, most_broadcast):
    texts = made_texts(3000)
    docs = stored([*enumerate(texts)], "doc_id long, text string")
    bits = np.array([simhash.fingerprint(t) for t in texts], np.uint64)
    near = np.bitwise_count(bits[1::3] ^ bits[2::3]) <= 2
    assert near.any()
    most_broadcast("4MB")
    found = {r["doc_id"]: r["component_id"] for r in simhash.near_duplicates(docs).collect()}
    assert found == {i: i - 1 if i % 3 == 2 and near[i // 3] else i for i in range(3000)}


def test_documents_and_their_components_are_shuffled(stored):
    docs = stored([*enumerate(made_texts(300))], "doc_id long, text string")
    assert not broadcast_sides(simhash.near_duplicates(docs))


def test_near_duplicates_stage_needs_no_large_broadcast(spark, sf_dir, stored, most_broadcast):
    texts = made_texts(3000)
    docs = stored([*enumerate(texts)], "doc_id long, text string")
    assert not broadcast_sides(simhash.one_of_each(docs))
    bits = np.array([simhash.fingerprint(t) for t in texts], np.uint64)
    near = np.bitwise_count(bits[1::3] ^ bits[2::3]) <= 2
    most_broadcast("4MB")
    kept = {r["doc_id"] for r in corpus_pipeline.near_duplicates(spark, docs, sf_dir).collect()}
    assert kept == {i for i in range(3000) if i % 3 != 2 or not near[i // 3]}


def test_labels_are_not_broadcast(stored, most_broadcast):
    docs = stored([(i, f"word{i} and more words" if i % 2 else f"#### $$ {i}") for i in range(200)], "doc_id long, text string")
    labels = stored([(i, i % 2) for i in range(400)], "doc_id long, quality int", "labels")
    most_broadcast("1MB")  # the least that Spark takes for a table by a number
    assert {r["doc_id"] for r in ranking.good(docs, labels).collect()} == set(range(1, 200, 2))
