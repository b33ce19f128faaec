"""Streams give what the batch jobs give, also across restarts."""

from datetime import datetime

from pyspark.sql import functions as F

from tidemark.operators.sessionlog import parse_files
from tidemark.sources.sessions import read_sessions
from tidemark.streaming import jobs, windows
from tidemark.streaming.sources import stream_files


def log(i):
    return f"SESSION_START 01.01.2024_00:00:0{i}\nQS 01.01.2024_00:00:1{i} {{q{i}}}\n{i} A_{i}\nDOC_OPEN  {i} A_{i}\njunk"


def test_ingest_resumes_and_equals_batch(spark, tmp_path):
    source, target, marks = (tmp_path / n for n in ("in", "out", "log"))
    source.mkdir()
    for i in range(5):
        (source / f"s{i}").write_bytes(log(i).encode("cp1251"))
        if i in (2, 4):
            jobs.start_ingest(spark, str(source), str(target), str(marks), max_files=2).awaitTermination()
    batch = parse_files(read_sessions(spark, str(source)))
    stored = spark.read.schema(batch.schema).parquet(str(target)).select(*batch.columns)
    order = ["session_id", "event_seq"]
    assert stored.orderBy(*order).collect() == batch.orderBy(*order).collect()


def test_repeated_batch_replaces_itself(spark, tmp_path):
    df = spark.range(3)
    for _ in range(2):
        jobs._replace_batch(df, str(tmp_path / "t"), 0)
    assert spark.read.parquet(str(tmp_path / "t")).count() == 3


def test_late_rows_are_dropped_after_the_delay(spark, tmp_path):
    source, target, marks = (str(tmp_path / n) for n in ("in", "out", "log"))
    schema = "ts timestamp, k string"
    for day, rows in ((1, 3), (20, 1), (2, 5), (25, 1)):
        spark.createDataFrame([(datetime(2024, 1, day), "a")] * rows, schema).write.mode("append").parquet(source)
        counts = windows.daily_counts(stream_files(spark, source, spark.read.parquet(source).schema), "ts", ["k"], "10 days")
        jobs.start_table_sink(counts, target, marks).awaitTermination()
    got = {(r.window_start.day, r.n) for r in spark.read.parquet(target).collect()}
    assert got == {(1, 3)}


def test_dedup_keeps_one_of_many_copies(spark, tmp_path):
    source, target, marks = (str(tmp_path / n) for n in ("in", "out", "log"))
    rows = [(datetime(2024, 1, 1), 0)] * 500 + [(datetime(2024, 1, 1), i) for i in range(20)]
    df = spark.createDataFrame(rows, "ts timestamp, id int").repartition(6)
    df.write.parquet(source)
    unique = windows.dedup_stream(stream_files(spark, source, df.schema), ["id"], "ts", "1 hour", shards=3)
    jobs.start_table_sink(unique, target, marks).awaitTermination()
    assert sorted(r.id for r in spark.read.parquet(target).collect()) == list(range(20))


def test_retain(spark):
    df = spark.createDataFrame([(datetime(2024, 1, d),) for d in (1, 8, 9)], "ts timestamp")
    kept = windows.retain(df, "ts", "7 days", F.lit("2024-01-15").cast("timestamp"))
    assert sorted(r.ts.day for r in kept.collect()) == [8, 9]


def test_streams_read_every_part_file(spark, sf_dir, tmp_path):
    """A table of three part files gives what the single file gives."""
    from tidemark.catalog import REGISTRY

    folder = str(tmp_path / "tables")
    spark.read.parquet(f"{sf_dir}/events.parquet").repartition(3).write.parquet(f"{folder}/events.parquet")
    for name in ("stream_sink", "stream_latest", "stream_dedup", "stream_click_state", "stream_daily_counts"):
        one, many = (sorted(map(str, REGISTRY[name].build(spark, d).collect())) for d in (sf_dir, folder))
        assert one == many, name


def test_latest_keeps_two_states(spark, tmp_path):
    source, target, marks = (str(tmp_path / n) for n in ("in", "out", "log"))
    for i in range(4):
        spark.createDataFrame([(1, i), (i, 0)], "k int, v int").write.mode("append").parquet(source)
        jobs.start_latest(stream_files(spark, source, spark.read.parquet(source).schema), ["k"], "v", target, marks).awaitTermination()
    kept = [len(list(bucket.glob("batch=*"))) for bucket in (tmp_path / "out").glob("bucket=*")]
    assert max(kept) == 2
    assert sorted(map(tuple, jobs.read_latest(spark, target).collect())) == [(0, 0), (1, 3), (2, 0), (3, 0)]


def test_counts_survive_the_time_to_live(spark):
    from tidemark.streaming.state import fold_click_state

    kinds = "device_id string, ad_id int, shard int, impressions bigint, clicks bigint, last_impression_us bigint, born bigint"
    updates = [("d", 1, 0, 1, 0, 5, 100), ("d", 1, 0, 3, 1, 9, 100), ("d", 1, 0, 2, 0, 20, 900), ("d", 1, 1, 1, 0, 7, 100)]
    (row,) = fold_click_state(spark.createDataFrame(updates, kinds)).collect()
    assert (row.impressions, row.clicks, row.last_impression_us) == (6, 1, 20)


def test_latest_rewrites_touched_buckets_only(spark, tmp_path):
    source, target, marks = (str(tmp_path / n) for n in ("in", "out", "log"))

    def load(values):
        spark.createDataFrame(values, "k int, v int").coalesce(1).write.mode("append").parquet(source)
        jobs.start_latest(stream_files(spark, source, spark.read.parquet(source).schema), ["k"], "v", target, marks).awaitTermination()
        return {f: f.stat().st_mtime_ns for f in (tmp_path / "out").glob("bucket=*/batch=*/*.parquet")}

    before, after = load([(k, 0) for k in range(300)]), load([(7, 5)])
    assert len(after) == len(before) + 1 and all(after[f] == t for f, t in before.items())
    assert sorted(map(tuple, jobs.read_latest(spark, target).collect())) == [(k, 5 if k == 7 else 0) for k in range(300)]


def test_attribution_writes_what_arrives_and_ignores_a_clock_far_ahead(spark, tmp_path):
    minute, day = 60_000_000, 86_400_000_000
    kinds = "event_id int, device_id string, ad_id int, campaign_id int, ts_us bigint, event_type string"

    def answers(name, extra):
        source, target, carry, marks = (str(tmp_path / name / n) for n in ("in", "out", "carry", "log"))
        written = []
        for b in range(3):
            start = b * day
            rows = [(b * 1000 + i, f"d{i % 40}", 1, 1, start + i * minute, "impression" if i % 2 else "click") for i in range(400)]
            rows += [(b * 1000 + 500 + i, f"d{i}", 1, 1, start + 12 * 60 * minute, "conversion") for i in range(40)]
            if b == 2:  # late touches of the days before, and one batch repeated in part
                rows += [(2900, "d0", 1, 1, 11 * 60 * minute, "impression"), *rows[:3], (1001, "d1", 1, 1, day + minute, "impression")]
            if b == 1 and extra:
                rows.append((9999, "far", 1, 1, 3650 * day, "impression"))
            spark.createDataFrame(rows, kinds).coalesce(1).write.mode("append").parquet(source)
            stream = stream_files(spark, source, spark.read.parquet(source).schema)
            jobs.start_attribution(stream, target, carry, marks, click_us=2 * day, late_us=day).awaitTermination()
            written.append(sum(1 for _ in spark.read.parquet(carry).filter(f"batch = {b}").select("event_id").toLocalIterator()))
        assert written[0] == 440 and written[1] == 440 + extra and written[2] == 445
        found = jobs.read_attribution(spark, target).filter("device_id <> 'far'")
        return sorted(map(tuple, found.select("event_id", "device_id", "attributed_us", "source").collect()), key=str), found.count()

    plain, n = answers("plain", 0)
    assert n == 120 and {a[0]: a[2] for a in plain}[500] == 11 * 60 * minute
    assert answers("ahead", 1) == (plain, n)


def test_click_counts_keep_one_row_for_each_state(spark, tmp_path):
    source, target, marks = (str(tmp_path / n) for n in ("in", "out", "log"))
    kinds = "event_id int, device_id string, ad_id int, ts_us bigint, event_type string"
    for b in range(3):
        rows = [(b * 100 + i, f"d{i % 3}", i % 2, b * 1000 + i, ["impression", "click", "conversion"][i % 5 % 3]) for i in range(60)]
        spark.createDataFrame(rows, kinds).coalesce(1).write.mode("append").parquet(source)
        stream = stream_files(spark, source, spark.read.parquet(source).schema)
        jobs.start_click_counts(stream, 10**9, target, marks, shards=2, buckets=4).awaitTermination()
    assert jobs.read_latest(spark, target).count() <= 3 * 2 * 2
    every = spark.read.parquet(source).groupBy("device_id", "ad_id").agg(
        F.count_if(F.expr("event_type = 'impression'")), F.count_if(F.expr("event_type = 'click'")), F.max(F.expr("if(event_type = 'impression', ts_us, null)"))
    )
    assert sorted(map(tuple, jobs.read_click_counts(spark, target).collect())) == sorted(map(tuple, every.collect()))
