"""Click rules and late rows on streams, against the batch operators on the same rows."""

import random

import pandas as pd
from pyspark.sql import functions as F

from tidemark.operators import adtape as A
from tidemark.operators import metrics as M
from tidemark.streaming import alerts, jobs, late, state
from tidemark.streaming.fraud import judged_clicks
from tidemark.streaming.sources import stream_files

COLUMNS = ["event_id", "impression_us", "has_impression", "too_fast", "clicks_seen", "conversions_seen", "burst"]


def tape_of(spark, rows):
    df = spark.createDataFrame(rows, "event_id long, device_id string, ts_us long, event_type string, ad_id int")
    return df.withColumn("ts", F.timestamp_micros("ts_us"))


def drained(spark, stream, folder):
    jobs.start_table_sink(stream, f"{folder}/out", f"{folder}/log").awaitTermination()
    return spark.read.schema(stream.schema).parquet(f"{folder}/out")


def test_rules_on_unordered_parts_equal_the_batch(spark, tmp_path):
    rng = random.Random(4)
    kinds = ["impression", "click", "click", "conversion", "other"]
    rows = [(i, rng.choice("abc"), rng.randrange(0, 7200) * 500_000 + 7, rng.choice(kinds), rng.randrange(2)) for i in range(1500)]
    rows += [(5000 + i, "hot", 1_000_000_000 + i // 3, "click", 0) for i in range(300)]  # equal times, one device
    rows.append((9999, "a", 8000 * 500_000 * 2, "click", 0))  # moves the watermark past all others
    arrival = sorted(rows, key=lambda r: (r[2] + rng.randrange(0, 300_000_000)) // 600_000_000)
    source, cut = str(tmp_path / "in"), len(arrival) // 5
    for k in range(5):
        tape_of(spark, arrival[k * cut : (k + 1) * cut if k < 4 else None]).coalesce(1).write.mode("append").parquet(source)
    limits = dict(impression_us=400_000_000, burst_us=200_000_000, clicks=2)
    stream = stream_files(spark, source, tape_of(spark, rows[:1]).schema, max_files=1)
    judged = drained(spark, judged_clicks(stream, "15 minutes", too_fast_us=20_000_000, **limits), str(tmp_path / "a"))
    tape = tape_of(spark, rows).filter("event_type <> 'other'")
    batch = A.with_burst(A.with_too_fast(A.with_impression_lag(tape, 400_000_000), 20_000_000), 200_000_000, 2)
    want = sorted(map(str, (tuple(r) for r in batch.filter("event_id <> 9999").select(*COLUMNS).collect())))
    assert sorted(map(str, (tuple(r) for r in judged.select(*COLUMNS).collect()))) == want
    flagged = judged.agg(F.count_if("too_fast"), F.count_if("burst")).first()
    assert flagged[0] > 0 and flagged[1] > 0


def test_late_rows_correct_closed_windows_once(spark, tmp_path):
    source, target, final, log = (str(tmp_path / n) for n in ("in", "out", "final", "log"))
    shape, days = "ts timestamp, k string", 86_400
    parts = [[(5, "a")] * 3 + [(6, None)] * 2, [(9, "a"), (5, "a")], [(5, "a"), (6, None), (7, "b"), (20, "a")], [(None, "a"), (7, "b")]]
    for part in parts:
        rows = spark.createDataFrame([(None if d is None else f"2024-01-{d:02}", k) for d, k in part], "d string, k string")
        rows.select(F.col("d").cast("timestamp").alias("ts"), "k").write.mode("append").parquet(source)
        stream = stream_files(spark, source, spark.createDataFrame([], shape).schema)
        late.start_late_aware_counts(stream, "ts", ["k"], days, days, target, log).awaitTermination()
        for _ in range(2):  # a repeated run adds nothing
            late.settle(spark, target, final, ["k"], days, days)
    got = {(r["day"].day, r["k"]): (r["n"], r["late"]) for r in spark.read.parquet(final).collect()}
    assert got == {(5, "a"): (5, 1), (6, None): (3, 1), (7, "b"): (2, 2), (9, "a"): (1, 0)}
    assert late.late_rows(spark, target).count() == 4


def test_alerts_on_unordered_samples_equal_the_batch(spark, tmp_path):
    rng = random.Random(9)
    rows = [(i, "ab"[i % 2], rng.randrange(0, 3000) * 1_000_000, rng.random() < 0.8) for i in range(800) if not 1000 < i < 1200]
    rows = [r for r in rows if r[1] == "b" or not 900_000_000 < r[2] < 1_500_000_000]  # series a falls silent
    ends = [(9001, "a", 9_000_000_000, False), (9002, "b", 9_000_000_000, False)]
    shape = "sample_id long, k string, ts_us long, on boolean"
    arrival = sorted(rows, key=lambda r: (r[2] + rng.randrange(0, 300_000_000)) // 600_000_000) + ends
    source = str(tmp_path / "in")
    for at in range(0, len(arrival), 200):
        spark.createDataFrame(arrival[at : at + 200], shape).withColumn("ts", F.timestamp_micros("ts_us")).coalesce(1).write.mode("append").parquet(source)
    stream = stream_files(spark, source, spark.read.parquet(source).schema, max_files=1)
    found = drained(spark, alerts.watch(stream, ["k"], F.col("on"), 40, 300, "15 minutes"), str(tmp_path / "a")).collect()
    batch = M.alert_sustained(spark.createDataFrame(rows + ends, shape), ["k"], F.col("on"), 40).collect()
    want = {(r["k"], r["from_us"], r["until_us"], r["samples"]) for r in batch}
    broken = {r for r in want if any(x[1] == r[0] and not x[3] and r[2] <= x[2] < 8_000_000_000 for x in rows)}
    resolved = {(r["k"], r["from_us"], r["until_us"], r["samples"]) for r in found if r["kind"] == "resolved"}
    assert resolved == broken and len(broken) > 3
    assert {(r["k"], r["from_us"]) for r in found if r["kind"] == "firing"} == {r[:2] for r in want}
    silent = [(r["k"], r["at_us"] - r["from_us"]) for r in found if r["kind"] == "absent" and r["from_us"] < 1_000_000_000]
    assert silent == [("a", 300_000_000)]


def test_rules_keep_no_state_for_each_device(spark, tmp_path):
    rows = [(i, f"d{i}", 1_000_000 + i, "click", None if i % 2 else 1) for i in range(3000)] + [(None, "d1", 9_000_000_000, "click", 1)]
    source = str(tmp_path / "in")
    tape_of(spark, rows).coalesce(1).write.parquet(source)
    stream = stream_files(spark, source, tape_of(spark, rows[:1]).schema)
    judged = judged_clicks(stream, "1 minute", buckets=4)
    query = jobs.start_table_sink(judged, str(tmp_path / "out"), str(tmp_path / "log"))
    query.awaitTermination()
    assert max(op["numRowsTotal"] for p in query.recentProgress for op in p["stateOperators"]) <= 100
    assert spark.read.parquet(str(tmp_path / "out")).filter("clicks_seen = 1").count() == 3000


def _one_by_one(known, due, hold, gap):
    """The rules of alerts.changes for one series, sample by sample."""
    (last, told), (start, until, n, fired), found = known[:2], known[2:], []
    for at, _, held in sorted(due):
        if not told and at > last + gap:
            found.append(("absent", last + gap, last, last, 0))
        last, told = at, False
        if held:
            start, until, n = (at if n == 0 else start), at, n + 1
            if not fired and until - start >= hold:
                fired = True
                found.append(("firing", at, start, until, n))
        else:
            if fired:
                found.append(("resolved", at, start, until, n))
            start, until, n, fired = 0, 0, 0, False
    return (last, told, start, until, n, fired), found


def test_changes_of_many_series_equal_one_by_one():
    rng, names = random.Random(3), [name for name, _ in alerts.STANDING]
    for hold, gap in ((0, 5), (7, 9), (20, 3)):
        states = [(0, True, 0, 0, 0, False)] * 40
        for step in range(6):
            due = [(k, step * 50 + rng.randrange(50), rng.randrange(3), rng.random() < 0.8) for k in rng.sample(range(40), 25) for _ in range(rng.randrange(1, 12))]
            standing, found = alerts.changes(pd.DataFrame(states, columns=names), pd.DataFrame(due, columns=["series", "ts_us", "sample_id", "held"]), hold, gap)
            want = []
            for k in sorted({d[0] for d in due}):
                states[k], told = _one_by_one(states[k], [d[1:] for d in due if d[0] == k], hold, gap)
                want += [(k, *t) for t in told]
                assert tuple(standing.loc[k, names]) == states[k]
            assert sorted(found[["series", *alerts.COLUMNS]].itertuples(index=False, name=None)) == sorted(want)


class _State:
    """A state handle in memory that counts calls."""

    def __init__(self):
        self.value, self.rows, self.calls, self.timers = None, [], 0, []

    def getValueState(self, *_, **__):
        return self

    getListState = getValueState

    def exists(self):
        return self.value is not None

    def get(self):
        self.calls += 1
        return self.value

    def update(self, value):
        self.calls += 1
        self.value = value


class _Clock:
    def __init__(self, now):
        self.now = now

    def getCurrentProcessingTimeInMs(self):
        return self.now


def test_click_state_of_a_bucket_takes_few_calls_and_expires_by_key():
    handle, counter = _State(), state.TouchCounter(100)
    counter.init(handle)

    def batch(now, devices):
        rows = pd.DataFrame({"device_id": devices, "ad_id": None, "shard": 0, "event_type": "impression", "ts_us": now})
        return pd.concat(counter.handleInputRows((0,), iter([rows, rows]), _Clock(now))).set_index("device_id")

    assert len(batch(1000, [f"d{i}" for i in range(2000)])) == 2000
    assert handle.calls <= 3
    again = batch(1060, ["d1", "d1"])
    assert again.loc["d1", ["impressions", "born"]].tolist() == [6, 1000]
    later = batch(1120, ["d1", "d2"])  # d2 was idle for its time to live, d1 was not
    assert later.loc["d1", ["impressions", "born"]].tolist() == [8, 1000]
    assert later.loc["d2", ["impressions", "born"]].tolist() == [2, 1120]
