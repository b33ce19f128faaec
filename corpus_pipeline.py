"""Training corpus from raw documents: quality, toxicity, near duplicates, packing.

Each stage reads what its predecessor kept (written as Parquet and read back) and the labels of the tables' folder. All but
the last return the documents' own columns; the last returns the pieces of the packed sequences.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from tidemark.lineage import new_folder
from tidemark.llm import packing, ranking, simhash, toxicity
from tidemark.llm.common import table
from tidemark.llm.queries import tokenizer


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the Bradley-Terry ranking accepts."""
    return ranking.good(docs, table(spark, sf_dir, "labels"))


def toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the positive-unlabelled classifier does not call toxic."""
    return toxicity.clean(docs, table(spark, sf_dir, "labels"))


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group that SimHash links (three-word shingles, at most two differing bits), the row with the smallest doc_id."""
    return simhash.one_of_each(docs)


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of the packed sequences."""
    return packing.pack(docs, tokenizer("word_bpe_49k.json"))


STAGES = [("quality", quality), ("toxicity", toxic), ("near_duplicates", near_duplicates), ("packing", packed)]

ORACLE_SQL = None  # fitted classifiers, XXH64 and the tokenizer are beyond SQL; the tests compare with plain Python


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; each result is written to the shared folder and read back for the next."""
    docs = table(spark, sf_dir, "documents")
    for name, step in STAGES:
        path = new_folder(spark, f"pipeline-{name}")
        step(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs
