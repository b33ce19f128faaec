"""The plans are the ones we want."""

import pytest
from conftest import plan_of
from pyspark.sql import functions as F

from tidemark.catalog import REGISTRY, logs, relational
from tidemark.operators import joins
from tidemark.operators import relational as R
from tidemark.operators.medallion import card_hits_daily, hot_since


def physical(df):
    return plan_of(df).split("== Physical Plan ==")[1]


def test_filters_and_columns_reach_the_scan(spark, sf_dir):
    plan = physical(REGISTRY["filter_eq"].build(spark, sf_dir))
    assert "EqualTo(source,src7)" in plan and "ReadSchema: struct<doc_id:bigint,text:string,source:string>" in plan


def test_hot_mart_prunes_partitions(spark, sf_dir):
    from datetime import date

    plan = physical(card_hits_daily(logs.events(spark, sf_dir), since=hot_since(date(2024, 1, 31))))
    assert "PartitionFilters: [isnotnull(event_date" in plan and "EqualTo(event_type,CARD_SEARCH)" in plan


def test_min_max_come_from_footers(spark, sf_dir):
    assert "PushedAggregation: [MIN(n_chars), MAX(n_chars)]" in physical(REGISTRY["agg_minmax"].build(spark, sf_dir))


def test_row_number_is_limited_before_the_shuffle(spark, sf_dir):
    plan = physical(REGISTRY["topn_row_number"].build(spark, sf_dir))
    assert plan.count("WindowGroupLimit") == 2


def test_join_strategies(spark, sf_dir):
    left, right = relational.imp(spark, sf_dir), relational.geo(spark, sf_dir)
    assert "BroadcastHashJoin" in physical(joins.join_on(left, right, ["geo_id"], strategy="broadcast"))
    salted = physical(joins.join_on(left, right, ["geo_id"], strategy="merge", salts=8))
    assert "SortMergeJoin [geo_id" in salted and "__salt" in salted
    assert "ShuffledHashJoin" in physical(joins.join_on(left, right, ["geo_id"], strategy="shuffle_hash"))


def test_broadcast_is_refused_for_a_large_side(spark, sf_dir):
    left, right = relational.imp(spark, sf_dir), relational.geo(spark, sf_dir)
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        plan = physical(joins.join_on(left, right, ["geo_id"], strategy="broadcast", broadcast_limit=1))
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
    assert "BroadcastHashJoin" not in plan and "SortMergeJoin" in plan


@pytest.mark.parametrize("how", ["inner", "left", "left_semi", "left_anti"])
def test_salted_join_equals_plain_join(spark, how):
    left = spark.createDataFrame([(i % 3, i) for i in range(60)] + [(9, 60)], "k int, v int")
    right = spark.createDataFrame([(0, "a"), (1, "b"), (1, "c"), (5, "d")], "k int, w string")
    plain = joins.join_on(left, right, ["k"], how)
    salted = joins.join_on(left, right, ["k"], how, strategy="merge", salts=4)
    assert sorted(map(tuple, salted.collect())) == sorted(map(tuple, plain.collect()))
    with pytest.raises(ValueError):
        joins.join_on(left, right, ["k"], "full", salts=4)


def test_rank_with_ties_equals_window_rank(spark):
    from pyspark.sql import Window

    rows = [(i, "g" if i % 4 else None, None if i % 11 == 0 else i % 5) for i in range(200)]
    df = spark.createDataFrame(rows, "id int, g string, v int")
    got = R.top_n(df, ["g"], "v", 60).select("id", "rank").collect()
    window = df.withColumn("rank", F.rank().over(Window.partitionBy("g").orderBy(F.desc("v")))).filter("rank <= 60")
    assert sorted(map(tuple, got)) == sorted(map(tuple, window.select("id", "rank").collect()))


def test_scalar_mean_stays_in_the_plan(spark, sf_dir):
    assert "scalar-subquery" in plan_of(REGISTRY["filter_above_avg_having"].build(spark, sf_dir))


def test_no_cross_joins_and_no_python_in_native_queries(spark, sf_dir):
    for name, q in REGISTRY.items():
        if name.startswith(("stream_", "udf_", "src_", "sink_", "scan_", "export_", "append_", "fmt_", "storage_", "text_")):
            continue
        plan = physical(q.build(spark, sf_dir))
        assert "CartesianProduct" not in plan and "BroadcastNestedLoopJoin" not in plan, name
        if name != "attribution_scan":
            assert "Python" not in plan and "Pandas" not in plan, name


def test_running_steps_read_twice_and_shuffle_three_times(spark, sf_dir):
    """The initial plans of the tape's last rule and of the session numbering, whatever the size of the data."""
    from tidemark.catalog import adtape

    for plan in (physical(adtape.attributed(spark, sf_dir)), physical(REGISTRY["parse_sessions"].build(spark, sf_dir))):
        initial = plan.split("== Initial Plan ==")[-1]
        assert initial.count("FileScan") <= 4 and initial.count("Exchange hashpartitioning") <= 6
