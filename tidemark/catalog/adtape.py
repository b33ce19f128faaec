"""Ad-tape queries. Limits are wider than the defaults because the driver's events are sparse."""

from __future__ import annotations

from pyspark.sql import functions as F

from tidemark.bridges import ad_tape
from tidemark.catalog.registry import query, table
from tidemark.lineage import written
from tidemark.operators import adtape as A

LOOK_BACK = 3 * A.DAY
TOO_FAST = A.HOUR
BURST_WINDOW, BURST_CLICKS = 2 * A.DAY, 1
GRAIN = 6 * A.HOUR

TAPE = """
WITH tape AS (
  SELECT event_id, ts,
         coalesce(CASE WHEN user_id % 5 <> 0 THEN 'd' || user_id END, 'u' || user_id) AS device_id,
         CASE event_type WHEN 'view' THEN 'impression' WHEN 'click' THEN 'click' ELSE 'conversion' END AS event_type,
         CAST(json_extract(props, '$.k') AS INT) % 4 AS ad_id,
         CAST(json_extract(props, '$.k') AS INT) % 2 AS campaign_id,
         CASE WHEN event_type = 'view' THEN value ELSE 0.0 END AS spend
  FROM events WHERE event_type IN ('view', 'click', 'purchase')),
seen AS (
  SELECT *, max(CASE WHEN event_type = 'impression' THEN ts END)
    OVER (PARTITION BY device_id, ad_id ORDER BY ts RANGE BETWEEN INTERVAL 3 DAY PRECEDING AND CURRENT ROW) AS imp
  FROM tape),
fast AS (
  SELECT *, imp IS NOT NULL AS has_impression,
         coalesce(event_type = 'click' AND epoch_us(ts) - epoch_us(imp) < 3600000000, false) AS too_fast FROM seen),
counted AS (
  SELECT *,
    count(CASE WHEN event_type = 'click' THEN 1 END) OVER w AS clicks_seen,
    count(CASE WHEN event_type = 'conversion' THEN 1 END) OVER w AS conversions_seen
  FROM fast
  WINDOW w AS (PARTITION BY device_id ORDER BY ts RANGE BETWEEN INTERVAL 2 DAY PRECEDING AND CURRENT ROW)),
judged AS (
  SELECT *, clicks_seen > 1 AND conversions_seen = 0 AS burst,
         event_type = 'click' AND has_impression AND NOT too_fast
           AND NOT (clicks_seen > 1 AND conversions_seen = 0) AS valid_click FROM counted),
touched AS (
  SELECT *,
    max(CASE WHEN valid_click THEN ts END) OVER (PARTITION BY device_id, campaign_id ORDER BY ts
      RANGE BETWEEN INTERVAL 7 DAY PRECEDING AND CURRENT ROW) AS click_at,
    max(CASE WHEN event_type = 'impression' THEN ts END) OVER (PARTITION BY device_id, campaign_id ORDER BY ts
      RANGE BETWEEN INTERVAL 24 HOUR PRECEDING AND CURRENT ROW) AS view_at
  FROM judged),
credited AS (
  SELECT *, epoch_us(coalesce(click_at, view_at)) AS attributed_us,
         CASE WHEN click_at IS NOT NULL THEN 'click' WHEN view_at IS NOT NULL THEN 'view' ELSE 'none' END AS source
  FROM touched),
mart AS (
  SELECT campaign_id, date_trunc('hour', ts) AS hour, sum(spend) AS spend,
         count(*) FILTER (WHERE valid_click) AS valid_clicks,
         count(*) FILTER (WHERE event_type = 'conversion' AND source = 'click') AS attributed_conversions,
         count(*) FILTER (WHERE event_type = 'conversion' AND source = 'view') AS post_view_conversions
  FROM credited GROUP BY 1, 2)
"""
ATTRIBUTED = "SELECT event_id, device_id, campaign_id, attributed_us, source FROM credited WHERE event_type = 'conversion'"


def tape(spark, sf_dir):
    return A.with_identity(ad_tape(table(spark, sf_dir, "events")))


def judged(spark, sf_dir):
    """The tape with all click rules. Stored before and after each rule, as every rule reads its input twice."""
    stored = written(tape(spark, sf_dir), "tape")
    ruled = written(A.with_too_fast(A.with_impression_lag(stored, LOOK_BACK, GRAIN), TOO_FAST), "tape-seen")
    return written(A.with_valid_click(A.with_burst(ruled, BURST_WINDOW, BURST_CLICKS, GRAIN)), "tape-judged")


def attributed(spark, sf_dir):
    return A.attribute(judged(spark, sf_dir), grain_us=GRAIN)


@query(
    "prev_event",
    TAPE + "SELECT event_id, device_id, event_type, lag(event_type) OVER (PARTITION BY device_id ORDER BY ts, event_id) "
    "AS prev_type FROM tape",
)
def prev_event(spark, sf_dir):
    return A.with_previous(tape(spark, sf_dir), GRAIN).select("event_id", "device_id", "event_type", "prev_type")


@query("click_has_impression", TAPE + "SELECT event_id, has_impression FROM fast WHERE event_type = 'click'")
def click_has_impression(spark, sf_dir):
    found = A.with_impression_lag(tape(spark, sf_dir), LOOK_BACK, GRAIN)
    return found.filter(A.is_type("click")).select("event_id", "has_impression")


@query("click_too_fast", TAPE + "SELECT event_id, device_id, ad_id FROM fast WHERE too_fast")
def click_too_fast(spark, sf_dir):
    found = A.with_too_fast(A.with_impression_lag(tape(spark, sf_dir), LOOK_BACK, GRAIN), TOO_FAST)
    return found.filter("too_fast").select("event_id", "device_id", "ad_id")


@query("click_burst", TAPE + "SELECT event_id, clicks_seen, conversions_seen, burst FROM judged")
def click_burst(spark, sf_dir):
    counted = A.with_burst(tape(spark, sf_dir), BURST_WINDOW, BURST_CLICKS, GRAIN)
    return counted.select("event_id", "clicks_seen", "conversions_seen", "burst")


@query("attribution", TAPE + ATTRIBUTED)
def attribution(spark, sf_dir):
    credited = attributed(spark, sf_dir).filter(A.is_type("conversion"))
    return credited.select("event_id", "device_id", "campaign_id", "attributed_us", "source")


@query("attribution_scan", TAPE + ATTRIBUTED)
def attribution_scan(spark, sf_dir):
    credited = A.attribute_scan(judged(spark, sf_dir), grain_us=GRAIN).filter(A.is_type("conversion"))
    return credited.select("event_id", "device_id", "campaign_id", "attributed_us", "source")


@query(
    "campaign_hour_mart",
    TAPE + "SELECT campaign_id, strftime(m.hour, '%Y-%m-%d %H:%M:%S') AS hour, round(spend, 2) AS spend, valid_clicks, "
    "attributed_conversions, post_view_conversions FROM mart m",
)
def campaign_hour_mart(spark, sf_dir):
    return A.campaign_hour_mart(attributed(spark, sf_dir)).withColumn("spend", F.round("spend", 2))


@query(
    "campaign_cpa",
    TAPE + "SELECT campaign_id, round(sum(spend) / nullif(sum(attributed_conversions), 0), 4) AS cpa, "
    "round(sum(attributed_conversions) * 100.0 / nullif(sum(spend), 0), 4) AS roas FROM mart GROUP BY campaign_id",
)
def campaign_cpa(spark, sf_dir):
    rates = A.campaign_cpa(A.campaign_hour_mart(attributed(spark, sf_dir)), conversion_value=100.0)
    return rates.select("campaign_id", F.round("cpa", 4).alias("cpa"), F.round("roas", 4).alias("roas"))


@query("dedup_exact", TAPE + "SELECT DISTINCT device_id, event_type, ad_id, campaign_id, epoch_us(ts) AS ts_us FROM tape")
def dedup_exact(spark, sf_dir):
    doubled = tape(spark, sf_dir).unionByName(tape(spark, sf_dir))
    return A.dedup_tape(doubled).select("device_id", "event_type", "ad_id", "campaign_id", "ts_us")


@query(
    "dedup_tolerance",
    TAPE + """, spaced AS (
  SELECT *, lag(ts) OVER (PARTITION BY device_id, event_type, ad_id, campaign_id ORDER BY ts) AS twin FROM tape)
SELECT device_id, event_type, ad_id, epoch_us(ts) AS ts_us FROM spaced
WHERE twin IS NULL OR epoch_us(ts) - epoch_us(twin) > 86400000000""",
)
def dedup_tolerance(spark, sf_dir):
    kept = A.dedup_tape(tape(spark, sf_dir), tolerance_us=A.DAY, grain_us=GRAIN)
    return kept.select("device_id", "event_type", "ad_id", "ts_us")


@query("sorted_tape", TAPE + "SELECT device_id, epoch_us(ts) AS ts_us, event_id FROM tape")
def sorted_tape(spark, sf_dir):
    return A.sorted_tape(tape(spark, sf_dir)).select("device_id", "ts_us", "event_id")
