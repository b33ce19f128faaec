"""Streaming queries: a stream over the tables runs to its end, and what it wrote is read back."""

from __future__ import annotations

from pyspark.sql import functions as F

from tidemark.bridges import ad_tape, gauge_samples
from tidemark.catalog.adtape import BURST_CLICKS, BURST_WINDOW, GRAIN, LOOK_BACK, TAPE, TOO_FAST
from tidemark.catalog.logs import EV
from tidemark.catalog.metrics import SAMPLES, SERIES
from tidemark.catalog.registry import query, table
from tidemark.catalog.storage import write_session_files
from tidemark.lineage import new_folder
from tidemark.operators import adtape as A
from tidemark.functions.times import epoch_us
from tidemark.streaming import alerts, jobs, late, windows
from tidemark.streaming.fraud import judged_clicks
from tidemark.streaming.sources import stream_files, stream_table


def event_stream(spark, sf_dir):
    """The events table as a stream, whether it is one file or a folder of part files."""
    return stream_table(spark, f"{sf_dir.rstrip('/')}/events.parquet", table(spark, sf_dir, "events").schema)


def drained(spark, stream, label):
    """Run the stream to its end into a fresh table and read that."""
    target = new_folder(spark, label)
    jobs.start_table_sink(stream, target, new_folder(spark, f"{label}-log")).awaitTermination()
    return spark.read.schema(stream.schema).parquet(target)


@query(
    "stream_ingest",
    f"""
WITH {EV}
SELECT event_type, count(*) AS n FROM (
  SELECT CASE event_type WHEN 'signup' THEN 'QS' WHEN 'error' THEN 'CARD_SEARCH' WHEN 'purchase' THEN 'MALFORMED'
         ELSE 'DOC_OPEN' END AS event_type FROM ev WHERE NOT (event_type = 'signup' AND event_id % 11 = 0))
GROUP BY event_type""",
)
def stream_ingest(spark, sf_dir):
    source, target = write_session_files(spark, sf_dir), new_folder(spark, "ingested")
    jobs.start_ingest(spark, source, target, new_folder(spark, "ingest-log")).awaitTermination()
    return spark.read.parquet(target).groupBy("event_type").agg(F.count("*").alias("n"))


# Windows that end after the watermark are still open when the stream stops.
@query(
    "stream_daily_counts",
    """
SELECT strftime(date_trunc('day', ts), '%Y-%m-%d %H:%M:%S') AS window_start, event_type, count(*) AS n FROM events
WHERE date_trunc('day', ts) + INTERVAL 1 DAY <= (SELECT max(ts) FROM events) - INTERVAL 10 DAY GROUP BY ALL""",
)
def stream_daily_counts(spark, sf_dir):
    return drained(spark, windows.daily_counts(event_stream(spark, sf_dir), "ts", ["event_type"]), "daily")


@query(
    "stream_tumbling",
    """
SELECT strftime(date_trunc('minute', ts), '%Y-%m-%d %H:%M:%S') AS window_start, event_type, count(*) AS n FROM events
WHERE date_trunc('minute', ts) + INTERVAL 1 MINUTE <= (SELECT max(ts) FROM events) - INTERVAL 1 HOUR GROUP BY ALL""",
)
def stream_tumbling(spark, sf_dir):
    counts = windows.tumbling(event_stream(spark, sf_dir), "ts", ["event_type"], "1 minute", "1 hour")
    return drained(spark, counts, "tumbling")


@query(
    "stream_sliding",
    """
SELECT strftime(w, '%Y-%m-%d %H:%M:%S') AS window_start, event_type, count(*) AS n
FROM (SELECT event_type, time_bucket(INTERVAL 1 HOUR, ts) - s * INTERVAL 1 HOUR AS w FROM events, range(6) AS r(s))
WHERE w + INTERVAL 6 HOUR <= (SELECT max(ts) FROM events) - INTERVAL 1 HOUR GROUP BY ALL""",
)
def stream_sliding(spark, sf_dir):
    counts = windows.sliding(event_stream(spark, sf_dir), "ts", ["event_type"], "6 hours", "1 hour", "1 hour")
    return drained(spark, counts, "sliding")


@query("stream_dedup", "SELECT event_id, event_type, user_id FROM events")
def stream_dedup(spark, sf_dir):
    stream = event_stream(spark, sf_dir)
    doubled = stream.unionByName(stream.filter(F.col("event_id") % 3 == 0))
    unique = windows.dedup_stream(doubled, ["event_id"], "ts", "1 day").select("event_id", "event_type", "user_id")
    return drained(spark, unique, "dedup")


@query(
    "stream_latest",
    "SELECT user_id, arg_max(event_type, event_id) AS event_type, max(event_id) AS event_id FROM events GROUP BY user_id",
)
def stream_latest(spark, sf_dir):
    target = new_folder(spark, "latest")
    stream = event_stream(spark, sf_dir).select("user_id", "event_type", "event_id")
    jobs.start_latest(stream, ["user_id"], "event_id", target, new_folder(spark, "latest-log")).awaitTermination()
    return jobs.read_latest(spark, target)


@query("stream_sink", "SELECT event_type, count(*) AS n, max(event_id) AS last_id FROM events GROUP BY event_type")
def stream_sink(spark, sf_dir):
    stored = drained(spark, event_stream(spark, sf_dir), "sink")
    return stored.groupBy("event_type").agg(F.count("*").alias("n"), F.max("event_id").alias("last_id"))


ATTRIBUTED = TAPE + """, simple AS (
  SELECT *, event_type = 'click' AND has_impression AS good FROM fast),
met AS (
  SELECT *,
    max(CASE WHEN good THEN ts END) OVER (PARTITION BY device_id, campaign_id ORDER BY ts
      RANGE BETWEEN INTERVAL 7 DAY PRECEDING AND CURRENT ROW) AS click_at,
    max(CASE WHEN event_type = 'impression' THEN ts END) OVER (PARTITION BY device_id, campaign_id ORDER BY ts
      RANGE BETWEEN INTERVAL 24 HOUR PRECEDING AND CURRENT ROW) AS view_at
  FROM simple)
SELECT event_id, device_id, campaign_id, epoch_us(coalesce(click_at, view_at)) AS attributed_us,
       CASE WHEN click_at IS NOT NULL THEN 'click' WHEN view_at IS NOT NULL THEN 'view' ELSE 'none' END AS source
FROM met WHERE event_type = 'conversion'"""


# The events arrive in three parts out of time order, and the stream stops and resumes between them.
@query("stream_attribution", ATTRIBUTED)
def stream_attribution(spark, sf_dir):
    source, target, carry, log = (new_folder(spark, f"attribution-{n}") for n in ("in", "out", "carry", "log"))
    tape = A.with_identity(ad_tape(table(spark, sf_dir, "events")))
    edges = [F.lit(day).cast("timestamp") for day in ("2024-01-01", "2024-01-11", "2024-01-21", "2024-02-01")]
    for part in (1, 2, 0):
        start, end = edges[part], edges[part + 1]
        first, last = part == 0, part == len(edges) - 2
        inside = F.lit(True) if first else F.col("ts") >= start
        inside = inside if last else inside & (F.col("ts") < end)
        tape.filter(inside).write.mode("append").parquet(source)
        stream = stream_files(spark, source, tape.schema)
        jobs.start_attribution(
            stream, target, carry, log, impression_us=3 * A.DAY, grain_us=GRAIN, late_us=31 * A.DAY
        ).awaitTermination()
    stored = jobs.read_attribution(spark, target)
    return stored.select("event_id", "device_id", "campaign_id", "attributed_us", "source")


@query(
    "stream_click_state",
    TAPE + """
SELECT device_id, ad_id, CAST(count(*) FILTER (WHERE event_type = 'impression') AS BIGINT) AS impressions,
       CAST(count(*) FILTER (WHERE event_type = 'click') AS BIGINT) AS clicks,
       epoch_us(max(CASE WHEN event_type = 'impression' THEN ts END)) AS last_impression_us
FROM tape GROUP BY device_id, ad_id""",
)
def stream_click_state(spark, sf_dir):
    target = new_folder(spark, "click-state")
    tape = A.with_identity(ad_tape(event_stream(spark, sf_dir)))
    log = new_folder(spark, "click-state-log")
    jobs.start_click_counts(tape, 7 * 24 * 3600 * 1000, target, log, shards=4).awaitTermination()
    return jobs.read_click_counts(spark, target)


PASSED = "epoch_us(ts) <= (SELECT epoch_us(max(ts)) // 1000 * 1000 FROM tape) - 86400000000"


def drained_in_parts(spark, rows, by, build, label):
    """Rows arrive in three parts that overlap by up to a day in time; the stream stops and resumes between them."""
    source, target, log = (new_folder(spark, f"{label}-{n}") for n in ("in", "out", "log"))
    jitter = F.pmod(F.xxhash64(by), F.lit(A.DAY - 1))
    part = F.least(F.floor((F.col("ts_us") + jitter - 1_704_067_200 * A.SECOND) / F.lit(10 * A.DAY)), F.lit(2))
    for number in range(3):
        rows.filter(part == number).write.mode("append").parquet(source)
        stream = build(stream_files(spark, source, rows.schema))
        jobs.start_table_sink(stream, target, log).awaitTermination()
    return spark.read.schema(stream.schema).parquet(target)


def judged_stream(spark, sf_dir):
    tape = A.with_identity(ad_tape(table(spark, sf_dir, "events")))

    def build(stream):
        return judged_clicks(stream, "1 day", LOOK_BACK, TOO_FAST, BURST_WINDOW, BURST_CLICKS)

    return drained_in_parts(spark, tape, "event_id", build, "judged")


# Rows in the last day before the newest one still wait for the watermark when the stream stops.
@query(
    "stream_too_fast",
    TAPE + f"SELECT event_id, device_id, epoch_us(imp) AS impression_us, too_fast FROM fast WHERE event_type = 'click' AND {PASSED}",
)
def stream_too_fast(spark, sf_dir):
    judged = judged_stream(spark, sf_dir).filter("event_type = 'click'")
    return judged.select("event_id", "device_id", "impression_us", "too_fast")


@query("stream_burst", TAPE + f"SELECT event_id, clicks_seen, conversions_seen, burst FROM judged WHERE {PASSED}")
def stream_burst(spark, sf_dir):
    return judged_stream(spark, sf_dir).select("event_id", "clicks_seen", "conversions_seen", "burst")


LATE_EDGES = ("2024-01-01", "2024-01-11", "2024-01-21", "2024-02-01")
DAY_S = 86_400


def late_aware(spark, sf_dir, size_s=DAY_S):
    """Three parts of the events arrive, the oldest last, long after its windows were closed; each run settles what is closed."""
    source, target, final, log = (new_folder(spark, f"late-{n}") for n in ("in", "out", "final", "log"))
    events = table(spark, sf_dir, "events")
    for part in (1, 2, 0):
        inside = F.col("ts") >= LATE_EDGES[part] if part else F.lit(True)
        inside = inside & (F.col("ts") < LATE_EDGES[part + 1]) if part < 2 else inside
        events.filter(inside).write.mode("append").parquet(source)
        stream = stream_files(spark, source, events.schema)
        late.start_late_aware_counts(stream, "ts", ["event_type"], size_s, DAY_S, target, log).awaitTermination()
        late.settle(spark, target, final, ["event_type"], size_s, DAY_S)
    return target, final


@query(
    "stream_corrected_windows",
    f"""
SELECT strftime(w, '%Y-%m-%d %H:%M:%S') AS window_start, event_type, count(*) AS n,
       CAST(count(*) FILTER (WHERE ts < TIMESTAMP '{LATE_EDGES[1]}') AS BIGINT) AS late
FROM (SELECT *, time_bucket(INTERVAL 6 HOUR, ts) AS w FROM events)
WHERE w + INTERVAL 6 HOUR <= (SELECT max(ts) FROM events) - INTERVAL 1 DAY GROUP BY ALL""",
)
def stream_corrected_windows(spark, sf_dir):
    settled = spark.read.parquet(late_aware(spark, sf_dir, 6 * 3600)[1])
    return settled.select(F.timestamp_micros("window_us").alias("window_start"), "event_type", "n", "late")


@query(
    "stream_late_rows",
    f"SELECT event_id, user_id, event_type FROM events WHERE ts < TIMESTAMP '{LATE_EDGES[1]}'",
)
def stream_late_rows(spark, sf_dir):
    return late.late_rows(spark, late_aware(spark, sf_dir)[0]).select("event_id", "user_id", "event_type")


MARK = "(SELECT epoch_us(max(ts)) // 1000 * 1000 FROM events) - 86400000000"


@query(
    "stream_alert_sustained",
    SAMPLES + f""", marked AS (
  SELECT *, sum(CASE WHEN gauge > 5 THEN 0 ELSE 1 END) OVER (PARTITION BY metric, instance ORDER BY ts, sample_id) AS run FROM samples),
broken AS (
  SELECT metric, instance, run, epoch_us(min(ts)) AS at_us FROM marked WHERE gauge <= 5 OR gauge IS NULL GROUP BY ALL),
held AS (
  SELECT metric, instance, run, epoch_us(min(ts)) AS from_us, epoch_us(max(ts)) AS until_us, count(*) AS samples
  FROM marked WHERE gauge > 5 GROUP BY ALL HAVING epoch_us(max(ts)) - epoch_us(min(ts)) >= 7200000000)
SELECT h.metric, h.instance, b.at_us, h.from_us, h.until_us, h.samples FROM held h
JOIN broken b ON b.metric = h.metric AND b.instance = h.instance AND b.run = h.run + 1 WHERE b.at_us <= {MARK}""",
)
def stream_alert_sustained(spark, sf_dir):
    """Stretches that were resolved before the watermark."""
    gauges = gauge_samples(table(spark, sf_dir, "events")).select("ts", "ts_us", "sample_id", *SERIES, "value")

    def build(stream):
        return alerts.watch(stream, SERIES, F.col("value") > 5, 7200, 86_400, "1 day")

    resolved = drained_in_parts(spark, gauges, "sample_id", build, "alerts").filter("kind = 'resolved'")
    return resolved.select(*SERIES, "at_us", "from_us", "until_us", "samples")


@query(
    "stream_alert_absent",
    f"""
SELECT user_id, last_us, last_us + 86400000000 AS at_us FROM (
  SELECT user_id, epoch_us(ts) AS last_us, epoch_us(lead(ts) OVER (PARTITION BY user_id ORDER BY ts, event_id)) AS next_us FROM events)
WHERE last_us + 86400000000 <= {MARK} AND (next_us IS NULL OR next_us > last_us + 86400000000)""",
)
def stream_alert_absent(spark, sf_dir):
    """Every silence of a user of more than a day that the watermark has passed."""
    seen = table(spark, sf_dir, "events").select("user_id", "ts", epoch_us(F.col("ts")).alias("ts_us"), F.col("event_id").alias("sample_id"))

    def build(stream):
        return alerts.watch(stream, ["user_id"], F.lit(False), 0, 86_400, "1 day")

    silent = drained_in_parts(spark, seen, "sample_id", build, "silences").filter("kind = 'absent'")
    return silent.select("user_id", F.col("from_us").alias("last_us"), "at_us")
