"""The operators as registered queries over whole tables, with SQL where SQL can express them."""

from __future__ import annotations

from collections.abc import Callable

import numpy as np
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm import (
    fingerprints,
    lm,
    neighbours,
    odd_sketches,
    packing,
    pieces,
    ranking,
    repair,
    runs,
    simhash,
    token_counts,
    toxicity,
    url_filters,
)
from tidemark.llm.common import fold_of, table

Build = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Build] = {}
ORACLES: dict[str, str] = {}


def query(name: str, sql: str | None = None) -> Callable[[Build], Build]:
    def add(build: Build) -> Build:
        QUERIES[name] = build
        if sql is not None:
            ORACLES[name] = sql
        return build

    return add


def tokenizer(name: str) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


@query("op1_toxicity_nnpu")
def op1(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity.classify(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


@query("op2_piecewise_fingerprints")
def op2(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fingerprints.fingerprint_edits(table(spark, sf_dir, "documents"))


@query("op3_quality_ranking")
def op3(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ranking.rank(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


@query("op4_nn_descent")
def op4(spark: SparkSession, sf_dir: str) -> DataFrame:
    return neighbours.nearest(table(spark, sf_dir, "embeddings"), lambda vec_id: vec_id % 100 == 0)


@query("op5_simhash_near_dedup")
def op5(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.near_duplicates(table(spark, sf_dir, "documents"))


@query("op6_sentencepiece")
def op6(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pieces.encode_and_check(table(spark, sf_dir, "documents"), tokenizer("piece_bpe_32k.model"))


@query("op7_token_counts")
def op7(spark: SparkSession, sf_dir: str) -> DataFrame:
    counted = token_counts.count_tokens(table(spark, sf_dir, "documents"), tokenizer("piece_bpe_32k.model"))
    return token_counts.with_limit(counted, 4096)


RULES = [("net", "/", "block"), ("example.net", "/en/", "allow"), ("example.com", "/de/", "block"), ("org", "/fr/", "allow")]
OP8_SQL = f"""
WITH cut AS (
    SELECT page_id, CASE WHEN strpos(url, '://') > 0 THEN substr(url, strpos(url, '://') + 3) END AS rest FROM pages
), parts AS (
    SELECT page_id,
        coalesce(translate(regexp_extract(rest, '^([^/?#]*)', 1), '{url_filters.UPPER}', '{url_filters.LOWER}'), '') AS host,
        coalesce(regexp_extract(rest, '^[^/?#]*([^?#]*)', 1), '') AS path
    FROM cut
), rules(h, p, verdict) AS (
    VALUES {", ".join(str(r) for r in RULES)}
), met AS (
    SELECT parts.*, h || p AS rule, verdict,
        row_number() OVER (PARTITION BY page_id ORDER BY length(h || p) DESC NULLS LAST, length(h) DESC, verdict DESC) AS n
    FROM parts LEFT JOIN rules ON (host = h OR ends_with(host, '.' || h)) AND starts_with(path, p)
)
SELECT page_id, host, path, rule, coalesce(verdict, 'allow') AS verdict FROM met WHERE n = 1
"""


@query("op8_url_filters", OP8_SQL)
def op8(spark: SparkSession, sf_dir: str) -> DataFrame:
    rules = spark.createDataFrame(RULES, "host string, path string, verdict string")
    return url_filters.judge(table(spark, sf_dir, "pages"), rules)


@query("op9_lm_scoring")
def op9(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return lm.score(docs, lm.train(docs))


@query("op10_packing")
def op10(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(table(spark, sf_dir, "documents"), tokenizer("word_bpe_49k.json"))


def repeated_tail(doc_id: int | None, n: int) -> np.ndarray | None:
    """For one id in ten by hash: from some word on, the words repeat with some period. None: the words as they are."""
    h = fold_of(doc_id, 1 << 32)
    g = h // 10
    if h % 10 or not n:
        return None
    first = g % n
    period = 1 + (n - first) // (3 + g % 8)
    order = np.arange(n)
    order[first:] = first + (order[first:] - first) % period
    return order


@query("op11_periodic_runs")
def op11(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = runs.periodic_runs(table(spark, sf_dir, "documents"), edit=repeated_tail)
    best = F.expr("array_max(transform(runs, r -> struct(r.length AS length, -r.start AS start, -r.period AS period)))")
    lines = F.expr("array_join(transform(runs, r -> concat(r.start, ',', r.length, ',', r.period, '\n')), '')")
    made = found.select("doc_id", F.size("runs").cast("long").alias("n_runs"), best.alias("best"), lines.alias("lines"), "collapsed")
    return made.select(
        "doc_id",
        "n_runs",
        (-F.col("best.start")).alias("start"),
        F.col("best.length").alias("length"),
        (-F.col("best.period")).alias("period"),
        F.expr("(1000 * best.length) div -best.period").alias("exponent_milli"),
        F.sha2("lines", 256).alias("runs_sha256"),
        F.sha2("collapsed", 256).alias("collapsed_sha256"),
    )


def damaged(rows: DataFrame) -> DataFrame:
    """Conversations with faults: by a hash of id and turn a row is dropped, emptied, cut, repeated or given the role user."""
    told = [F.coalesce(F.col(c).cast("string"), F.lit(" ")) for c in ("conv_id", "turn")]
    kind = F.crc32(F.concat_ws(":", *told).cast("binary")) % 20
    role, text = (F.coalesce(F.col(c), F.lit(" ")) for c in ("role", "text"))
    cut = F.when(kind == 1, "").when(kind == 2, F.regexp_replace(text, "[.!?]", "")).otherwise(text)
    copies = F.when(kind == 0, 0).when(kind == 3, 2).otherwise(1)
    return rows.select("conv_id", "turn", F.when(kind == 4, "user").otherwise(role).alias("role"), cut.alias("text"), copies.alias("copies"))


@query("op12_conversation_repair")
def op12(spark: SparkSession, sf_dir: str) -> DataFrame:
    return repair.repair(damaged(table(spark, sf_dir, "conversations")), "copies")


@query("op13_odd_sketch_near_dedup")
def op13(spark: SparkSession, sf_dir: str) -> DataFrame:
    return odd_sketches.near_duplicates(table(spark, sf_dir, "documents"))
