"""Ad-tape rules at their default limits."""

import pytest
from pyspark.sql import functions as F

from tidemark.operators import adtape as A

MS, S, MIN, H, DAY = 1000, A.SECOND, A.MINUTE, A.HOUR, A.DAY
SCHEMA = "event_id bigint, device_id string, ts_us bigint, event_type string, ad_id int, campaign_id int, spend double"


def tape(spark, rows):
    data = [(i, d, t, e, ad, c, 1.0 if e == "impression" else 0.0) for i, (d, t, e, ad, c) in enumerate(rows)]
    return spark.createDataFrame(data, SCHEMA).withColumn("ts", F.timestamp_micros("ts_us"))


def by_id(df, *columns):
    return {row.event_id: tuple(row[c] for c in columns) for row in df.select("event_id", *columns).collect()}


def test_impression_window_is_inclusive_and_per_ad(spark):
    df = tape(
        spark,
        [
            ("d", 0, "impression", 1, 1), ("d", 30 * MIN, "click", 1, 1), ("d", 30 * MIN + 1, "click", 1, 1),
            ("d", 10 * MIN, "click", 2, 1), ("e", 10 * MIN, "click", 1, 1),
        ],
    )
    got = by_id(A.with_impression_lag(df), "has_impression")
    assert {k: v[0] for k, v in got.items() if k} == {1: True, 2: False, 3: False, 4: False}


def test_too_fast_needs_less_than_50_ms(spark):
    df = tape(
        spark,
        [("d", 0, "impression", 1, 1), ("d", 49 * MS, "click", 1, 1), ("d", 50 * MS, "click", 1, 1), ("d", 40 * MS, "conversion", 1, 1)],
    )
    got = by_id(A.with_too_fast(A.with_impression_lag(df)), "too_fast")
    assert [got[i][0] for i in range(4)] == [False, True, False, False]


def test_burst_needs_more_than_20_clicks_and_no_conversion(spark):
    clicks = [("d", i * S, "click", 1, 1) for i in range(21)]
    other = [("e", i * S, "click", 1, 1) for i in range(21)] + [("e", 5 * S, "conversion", 1, 1)]
    got = by_id(A.with_burst(tape(spark, clicks + other)), "clicks_seen", "burst")
    assert got[19] == (20, False) and got[20] == (21, True) and got[41] == (21, False)


def test_attribution_prefers_clicks_and_has_limits(spark):
    rows = [
        ("a", 0, "impression", 1, 1), ("a", MIN, "click", 1, 1), ("a", 7 * DAY, "impression", 1, 1),
        ("a", 7 * DAY + MIN, "conversion", 1, 1), ("a", 7 * DAY + MIN + 1, "conversion", 1, 1),
        ("a", 8 * DAY + 1, "conversion", 1, 1), ("a", 8 * DAY, "conversion", 1, 2),
    ]
    judged = A.with_too_fast(A.with_impression_lag(tape(spark, rows)))
    judged = A.with_valid_click(A.with_burst(judged)).cache()
    want = {3: (MIN, "click"), 4: (7 * DAY, "view"), 5: (None, "none"), 6: (None, "none")}
    for credited in (A.attribute(judged), A.attribute_scan(judged)):
        assert by_id(credited.filter(A.is_type("conversion")), "attributed_us", "source") == want
    mart = A.campaign_hour_mart(A.attribute(judged))
    sums = mart.groupBy("campaign_id").agg(
        F.sum("spend"), F.sum("valid_clicks"), F.sum("attributed_conversions"), F.sum("post_view_conversions")
    )
    assert {tuple(r) for r in sums.collect()} == {(1, 2.0, 1, 1, 1), (2, 0.0, 0, 0, 0)}
    cpa = {r.campaign_id: (r.cpa, r.roas) for r in A.campaign_cpa(mart).collect()}
    assert cpa == {1: (2.0, 0.5), 2: (None, None)}


def test_dedup_keeps_the_first_of_a_chain(spark):
    rows = [("d", t * S, "click", 1, 1) for t in (0, 0, 1, 2, 10)] + [("d", S, "click", 2, 1)]
    assert A.dedup_tape(tape(spark, rows)).count() == 5
    kept = A.dedup_tape(tape(spark, rows), tolerance_us=2 * S)
    assert sorted((r.ad_id, r.ts_us) for r in kept.collect()) == [(1, 0), (1, 10 * S), (2, S)]


def test_identity_falls_back(spark):
    df = spark.createDataFrame(
        [("d", "u", "c"), (None, "u", "c"), (None, None, "c")], "raw_device_id string, user_id string, cookie string"
    )
    assert [r.device_id for r in A.with_identity(df).collect()] == ["d", "u", "c"]


@pytest.mark.parametrize("partitions", [1, 7])
def test_scan_equals_windows_on_a_hot_device(spark, partitions):
    import random

    rng = random.Random(3)
    rows = [
        ("hot" if rng.random() < 0.6 else f"d{rng.randrange(5)}", rng.randrange(20 * DAY), rng.choice(["impression", "click", "conversion"]),
         rng.randrange(3), rng.randrange(2))
        for _ in range(2000)
    ]
    judged = A.with_impression_lag(tape(spark, rows), 6 * H).withColumn("valid_click", A.is_type("click") & F.col("has_impression"))
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", partitions)
    try:
        a = by_id(A.attribute(judged, grain_us=H), "attributed_us", "source")
        b = by_id(A.attribute_scan(judged, grain_us=H), "attributed_us", "source")
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)
    assert a == b and any(v[1] == "click" for v in a.values())
