"""Metric-algebra queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from tidemark.bridges import budgets, counter_samples, gauge_samples
from tidemark.catalog.registry import query, table
from tidemark.functions.times import epoch_us
from tidemark.operators import metrics as M

SERIES = ["metric", "instance"]
GRAIN = 6 * 3600 * 1_000_000
BOUNDS = [10.0, 25.0, 50.0, 100.0, 250.0]
AS_OF_US = 1_706_659_200_000_000  # 2024-01-31 00:00:00 UTC

SAMPLES = """
WITH samples AS (
  SELECT event_id AS sample_id, ts, event_type AS metric, CAST(user_id % 3 AS INT) AS instance,
         CAST(json_extract(props, '$.k') AS INT) % 25 AS campaign_id,
         CAST(event_id % 1000 AS DOUBLE) AS value, value AS gauge FROM events),
stepped AS (
  SELECT *, lag(value) OVER (PARTITION BY metric, instance ORDER BY ts, sample_id) AS prev FROM samples),
deltas AS (
  SELECT *, CASE WHEN prev IS NULL THEN 0 WHEN value < prev THEN value ELSE value - prev END AS delta FROM stepped)
"""
WINDOW = "strftime(time_bucket(INTERVAL {0}, ts), '%Y-%m-%d %H:%M:%S') AS window_start"


def counters(spark, sf_dir):
    return counter_samples(table(spark, sf_dir, "events"))


def gauges(spark, sf_dir):
    return gauge_samples(table(spark, sf_dir, "events"))


def histograms(spark, sf_dir, by):
    return M.histogram(gauges(spark, sf_dir), by, "value", BOUNDS)


@query(
    "metric_increase",
    SAMPLES + f"SELECT metric, instance, {WINDOW.format('1 HOUR')}, sum(delta) AS increase FROM deltas GROUP BY ALL",
)
def metric_increase(spark, sf_dir):
    return M.increase(counters(spark, sf_dir), SERIES, 3600, grain_us=GRAIN)


@query(
    "metric_rate",
    SAMPLES + f"SELECT metric, {WINDOW.format('1 HOUR')}, round(sum(delta) / 3600, 9) AS rate FROM deltas GROUP BY ALL",
)
def metric_rate(spark, sf_dir):
    rates = M.rate(counters(spark, sf_dir), SERIES, 3600, by=["metric"], grain_us=GRAIN)
    return rates.withColumn("rate", F.round("rate", 9))


@query(
    "metric_sum_by",
    SAMPLES + "SELECT metric, round(sum(gauge), 2) AS sum_value, round(avg(gauge), 6) AS avg_value, "
    "max(gauge) AS max_value FROM samples GROUP BY metric",
)
def metric_sum_by(spark, sf_dir):
    summed = M.aggregate_by(gauges(spark, sf_dir), ["metric"])
    return summed.withColumns({"sum_value": F.round("sum_value", 2), "avg_value": F.round("avg_value", 6)})


@query(
    "metric_topk",
    SAMPLES + f""", days AS (
  SELECT campaign_id, {WINDOW.format('1 DAY')}, sum(delta) AS increase FROM deltas GROUP BY ALL)
SELECT * FROM days QUALIFY row_number() OVER (PARTITION BY window_start ORDER BY increase DESC, campaign_id) <= 10""",
)
def metric_topk(spark, sf_dir):
    daily = M.increase(counters(spark, sf_dir), SERIES, 86_400, by=["campaign_id"], grain_us=GRAIN)
    return M.topk(daily, 10, "increase", by=["window_start"], tie_break=["campaign_id"])


@query(
    "metric_ratio",
    SAMPLES + f"""
SELECT {WINDOW.format('1 HOUR')}, round(sum(CASE WHEN metric = 'purchase' THEN delta ELSE 0 END)
       / nullif(sum(CASE WHEN metric = 'click' THEN delta ELSE 0 END), 0), 9) AS ratio FROM deltas GROUP BY ALL""",
)
def metric_ratio(spark, sf_dir):
    hourly = M.increase(counters(spark, sf_dir), SERIES, 3600, by=["metric"], grain_us=GRAIN)
    won, offered = F.col("metric") == "purchase", F.col("metric") == "click"
    return M.ratio(hourly, ["window_start"], won, offered, "increase").withColumn("ratio", F.round("ratio", 9))


HISTOGRAM = SAMPLES + """, buckets AS (
  SELECT metric, {0} le, CAST(count(*) FILTER (WHERE gauge <= le) AS DOUBLE) AS n
  FROM samples, (SELECT unnest([10.0, 25.0, 50.0, 100.0, 250.0, 'inf'::DOUBLE]) AS le) GROUP BY ALL),
placed AS (
  SELECT *, coalesce(lag(n) OVER w, 0) AS below, coalesce(lag(le) OVER w, 0) AS lower,
         {1} * max(n) OVER (PARTITION BY metric{2}) AS target
  FROM buckets WINDOW w AS (PARTITION BY metric{2} ORDER BY le)),
answers AS (
  SELECT metric{2}, arg_min(CASE WHEN isinf(le) THEN lower ELSE lower + (le - lower) * (target - below) / (n - below) END, le)
         AS quantile
  FROM placed WHERE n >= target AND target > 0 GROUP BY ALL)
"""


@query("metric_hist_quantile", HISTOGRAM.format("", 0.9, "") + "SELECT metric, round(quantile, 6) AS quantile FROM answers")
def metric_hist_quantile(spark, sf_dir):
    answered = M.histogram_quantile(histograms(spark, sf_dir, ["metric"]), 0.9, ["metric"])
    return answered.withColumn("quantile", F.round("quantile", 6))


@query(
    "alert_threshold",
    HISTOGRAM.format("instance,", 0.99, ", instance")
    + "SELECT metric, instance, round(quantile, 6) AS quantile FROM answers WHERE quantile > 200",
)
def alert_threshold(spark, sf_dir):
    answered = M.histogram_quantile(histograms(spark, sf_dir, SERIES), 0.99, SERIES)
    return M.alert(answered, F.col("quantile") > 200).withColumn("quantile", F.round("quantile", 6))


@query(
    "alert_sustained",
    SAMPLES + """, marked AS (
  SELECT *, sum(CASE WHEN gauge > 5 THEN 0 ELSE 1 END) OVER (PARTITION BY metric, instance ORDER BY ts, sample_id) AS run
  FROM samples)
SELECT metric, instance, epoch_us(min(ts)) AS from_us, epoch_us(max(ts)) AS until_us, count(*) AS samples
FROM marked WHERE gauge > 5 GROUP BY metric, instance, run HAVING epoch_us(max(ts)) - epoch_us(min(ts)) >= 7200000000""",
)
def alert_sustained(spark, sf_dir):
    return M.alert_sustained(gauges(spark, sf_dir), SERIES, F.col("value") > 5, hold_s=7200, grain_us=GRAIN)


@query(
    "alert_overspend",
    SAMPLES + f""", days AS (
  SELECT campaign_id, {WINDOW.format('1 DAY')}, sum(delta) AS increase FROM deltas GROUP BY ALL)
SELECT campaign_id, window_start, increase, CAST(n_regionkey * 200 + 100 AS DOUBLE) AS budget
FROM days JOIN nation ON n_nationkey = campaign_id WHERE increase > 1.1 * (n_regionkey * 200 + 100)""",
)
def alert_overspend(spark, sf_dir):
    limits = budgets(table(spark, sf_dir, "nation"))
    return M.overspend(counters(spark, sf_dir), SERIES, limits, "campaign_id", grain_us=GRAIN)


@query(
    "alert_absent",
    f"""
SELECT user_id, CAST(floor(({AS_OF_US} - epoch_us(max(ts))) / 1000000) AS BIGINT) AS age_s FROM events
GROUP BY user_id HAVING floor(({AS_OF_US} - epoch_us(max(ts))) / 1000000) > 86400""",
)
def alert_absent(spark, sf_dir):
    samples = table(spark, sf_dir, "events").select("user_id", epoch_us(F.col("ts")).alias("ts_us"))
    return M.absent(samples, ["user_id"], AS_OF_US, 86_400)


@query(
    "job_last_run",
    SAMPLES + """, runs AS (
  SELECT metric, instance, CAST(date_diff('day', DATE '2024-01-01', CAST(ts AS DATE)) AS INT) AS run_id,
         arg_max(gauge, sample_id) AS value FROM samples GROUP BY ALL)
SELECT metric, max(run_id) AS run_id, arg_max(value, (run_id, instance)) AS value FROM runs GROUP BY metric""",
)
def job_last_run(spark, sf_dir):
    runs = gauges(spark, sf_dir).withColumn("run_id", F.datediff("ts", F.lit("2024-01-01").cast("date")))
    per_run = M.last_run(runs, ["metric", "instance", "run_id"])
    return per_run.groupBy("metric").agg(
        F.max("run_id").alias("run_id"), F.max_by("value", F.struct("run_id", "instance")).alias("value")
    )


@query(
    "sliding_rate",
    """
WITH panes AS (
  SELECT event_type AS metric, time_bucket(INTERVAL 1 HOUR, ts) - s * INTERVAL 1 HOUR AS w
  FROM events, range(6) AS r(s))
SELECT metric, strftime(w, '%Y-%m-%d %H:%M:%S') AS window_start, round(count(*) / 21600, 12) AS rate
FROM panes GROUP BY ALL""",
)
def sliding_rate(spark, sf_dir):
    rates = M.sliding_rate(gauges(spark, sf_dir), ["metric"], size_s=6 * 3600, slide_s=3600)
    return rates.withColumn("rate", F.round("rate", 12))
