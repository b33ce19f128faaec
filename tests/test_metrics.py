"""Metric algebra edge cases."""

import pytest
from pyspark.sql import functions as F

from tidemark.operators import metrics as M

SEC = 1_000_000


def samples(spark, rows):
    data = [(i, s, t * SEC, float(v)) for i, (s, t, v) in enumerate(rows)]
    return spark.createDataFrame(data, "sample_id bigint, series string, ts_us bigint, value double")


@pytest.mark.parametrize("grain", [SEC, 10**12])
def test_increase_counts_resets_from_zero(spark, grain):
    df = samples(spark, [("a", 0, 5), ("a", 10, 8), ("a", 20, 2), ("a", 70, 4), ("b", 0, 1)])
    got = {(r.series, r.window_start.second + 60 * r.window_start.minute): r.increase for r in M.increase(df, ["series"], 60, grain_us=grain).collect()}
    assert got == {("a", 0): 5.0, ("a", 60): 2.0, ("b", 0): 0.0}


def test_quantile_interpolates_and_stops_at_the_last_bound(spark):
    def quantile(counts, q):
        buckets = spark.createDataFrame(
            [("g", le, float(n)) for le, n in zip((1.0, 2.0, 4.0, float("inf")), counts)], "g string, le double, count double"
        )
        return M.histogram_quantile(buckets, q, ["g"]).collect()[0].quantile

    assert quantile((0, 10, 20, 20), 0.5) == 2.0
    assert quantile((0, 10, 20, 20), 0.75) == 3.0
    assert quantile((10, 10, 10, 10), 0.5) == 0.5
    assert quantile((0, 0, 10, 100), 0.99) == 4.0
    assert quantile((0, 0, 0, 0), 0.5) is None


@pytest.mark.parametrize("grain", [SEC, 30 * SEC, 10**12])
def test_sustained_needs_an_unbroken_stretch(spark, grain):
    rows = [("a", t, 9) for t in (0, 20, 40)] + [("a", 50, 1)] + [("a", t, 9) for t in (60, 70, 130)] + [("b", 0, 1)]
    got = M.alert_sustained(samples(spark, rows), ["series"], F.col("value") > 5, 60, grain).collect()
    assert [(r.series, r.from_us // SEC, r.until_us // SEC, r.samples) for r in got] == [("a", 60, 130, 3)]


def test_absent_ratio_topk_last_run(spark):
    df = samples(spark, [("a", 0, 1), ("b", 100, 3), ("b", 90, 7)])
    assert [(r.series, r.age_s) for r in M.absent(df, ["series"], 200 * SEC, 120).collect()] == [("a", 200)]
    share = M.ratio(df, [], F.col("series") == "a", F.col("series") == "b", "value").collect()[0].ratio
    none = M.ratio(df, [], F.col("series") == "a", F.lit(False), "value").collect()[0].ratio
    assert (share, none) == (0.1, None)
    assert [r.value for r in M.topk(df, 2, "value").collect()] == [7.0, 3.0]
    assert {r.series: r.value for r in M.last_run(df, ["series"]).collect()} == {"a": 1.0, "b": 3.0}


def test_sliding_counts_equal_spark_windows(spark):
    df = samples(spark, [("a", t * 7, 1) for t in range(60)])
    got = {(r.window_start, round(r.rate * 60)) for r in M.sliding_rate(df, ["series"], 60, 20).collect()}
    window = F.window(F.timestamp_micros("ts_us"), "60 seconds", "20 seconds")
    want = {(r.s, r.n) for r in df.groupBy(window.start.alias("s")).agg(F.count("*").alias("n")).collect()}
    assert got == want
