"""Sketches keep their promises: nothing is missed, errors stay in bounds, merging equals building at once."""

from datetime import datetime

import pytest
from pyspark.sql import functions as F

from tidemark.operators import sketches as S
from tidemark.plans import ingest
from tidemark.plans.ingest import load_new_sessions, read_sketch


def test_membership_misses_nothing(spark):
    keys = spark.range(40_000).select((F.col("id") * 7).alias("k"), F.concat(F.lit("n"), F.col("id")).alias("name"))
    blocks = S.blocks_for(40_000)
    sketch = S.membership(keys, ["k", "name"], blocks)
    assert S.with_maybe(keys, sketch, ["k", "name"], blocks).filter("NOT maybe").count() == 0
    others = keys.withColumn("name", F.concat("name", F.lit("x")))
    report = S.membership_report(others, keys, sketch, ["k", "name"], blocks).first()
    assert (report["rows"], report["present"], report["missed"]) == (40_000, 0, 0) and 0 < report["passed_share"] < 0.01
    assert sketch.count() <= blocks


def test_merged_membership_is_the_sketch_of_all(spark):
    keys = spark.range(3000).select(F.col("id").alias("k"))
    parts = [S.membership(keys.filter(f"k % 3 = {i}"), ["k"], 64) for i in range(3)]
    whole = S.membership(keys, ["k"], 64)
    assert S.merged_membership(*parts).exceptAll(whole).count() == 0 == whole.exceptAll(S.merged_membership(*parts)).count()


@pytest.mark.parametrize("blocks", [1, 64])
def test_absent_keys_are_exact(spark, blocks):
    """Also with a sketch so full that it lets everything pass, nulls, repeats and an empty side."""
    rows = spark.createDataFrame([(1, "a"), (1, "a"), (2, "b"), (None, "c"), (9, "d")], "k long, v string")
    known = spark.createDataFrame([(1,), (1,), (None,), (500,)] + [(i,) for i in range(1000, 3000)], "k int")
    sketch = S.membership(known, ["k"], blocks)
    absent = S.keys_absent_by_sketch(rows, known, sketch, ["k"], blocks)
    assert sorted(r["v"] for r in absent.collect()) == ["b", "c", "d"]
    nothing = known.limit(0)
    assert S.keys_absent_by_sketch(rows, nothing, S.membership(nothing, ["k"], blocks), ["k"], blocks).count() == 5


def test_keys_that_differ_as_text_are_refused(spark):
    with pytest.raises(ValueError):
        S.membership(spark.range(3).select(F.col("id").cast("double").alias("k")), ["k"], 4)


def test_runs_keep_a_sketch_of_the_ledger(spark, tmp_path, monkeypatch):
    source, events, ledger, sketch = (tmp_path / n for n in ("in", "events", "ledger", "sketch"))
    source.mkdir()
    for run in range(3):
        for i in range(2):
            (source / f"s{run}{i}").write_bytes(b"SESSION_START 01.01.2024_00:00:00\nSESSION_END 01.01.2024_00:00:01\n")
        added = load_new_sessions(spark, str(source), str(events), str(ledger), datetime(2024, 1, 2), sketch_path=str(sketch), blocks=16)
        assert added.count() == 2
    known = S.merged_membership(read_sketch(spark, str(sketch)))
    paths = spark.read.parquet(str(ledger)).select("path")
    assert paths.count() == 6 and S.with_maybe(paths, known, ["path"], 16).filter("maybe").count() == 6
    assert ingest.new_files(paths, paths, sketch=known, blocks=16).count() == 0


def test_sketch_columns_merge(spark):
    df = spark.range(60_000).select((F.col("id") % 6).alias("day"), "id", F.when(F.col("id") % 3 == 0, 1).otherwise(F.col("id")).alias("v"))
    names = {"distinct": {"d": "id"}, "frequent": {"f": "v"}, "quantiles": {"q": "id"}}
    mart = S.sketched(df, ["day"], **names, counters=64)
    whole = S.merged(mart, distinct=["d"], frequent=["f"], quantiles=["q"], counters=64)
    told = whole.select(S.distinct_estimate("d").alias("d"), *[S.quantile_estimate("q", q).alias(f"q{i}") for i, q in enumerate((0.1, 0.5, 0.99))]).first()
    assert abs(told["d"] - 60_000) <= S.distinct_error() * 60_000
    for i, q in enumerate((0.1, 0.5, 0.99)):
        assert abs(told[f"q{i}"] - q * 60_000) <= S.quantile_error() * 60_000
    top = S.frequent_estimate(whole, "f", 5).first()
    assert top["value"] == 1 and abs(top["cnt"] - 20_000) <= S.frequent_error(64) * 60_000
    empty = S.sketched(df.limit(0), [], **names).select(S.distinct_estimate("d").alias("d")).first()
    assert empty["d"] == 0
