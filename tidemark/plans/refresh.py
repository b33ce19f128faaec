"""Recurring refresh of the daily marts."""

from __future__ import annotations

from collections.abc import Callable
from datetime import datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.lineage import drop_folder
from tidemark.operators.medallion import card_hits_daily, hot_since, latest_by_key, qs_opens_daily, sketches_daily
from tidemark.sources.tables import write_by

Mart = Callable[..., DataFrame]
MARTS: dict[str, tuple[Mart, str]] = {
    "card_hits": (card_hits_daily, "date"),
    "qs_opens": (qs_opens_daily, "open_date"),
    "sketches": (sketches_daily, "event_date"),
}
NEEDED = ["session_id", "event_seq", "event_type", "event_date", "search_kind", "doc_id", "result_doc_ids", "ingested_at"]


def refresh_window(as_of: datetime, mode: str, days: int = 10) -> dict:
    """Day limits of a run: "hot" is the last ``days`` days, "cold" all before them, "full" everything."""
    edge = hot_since(as_of.date(), days)
    return {"hot": {"since": edge}, "cold": {"until": edge}, "full": {}}[mode]


def refresh_mart(
    spark: SparkSession, event_path: str, mart_path: str, mart: str, as_of: datetime, mode: str = "hot", days: int = 10
) -> None:
    """Recompute one mart for the days of ``mode`` and replace just those day partitions; days without rows are removed.

    Replayed events are dropped first. The day filter prunes partitions of the event table before anything shuffles.
    """
    build, day = MARTS[mart]
    limits = refresh_window(as_of, mode, days)
    events = spark.read.parquet(event_path).select(*NEEDED).filter(F.col("event_date").isNotNull())
    if "since" in limits:
        events = events.filter(F.col("event_date") >= limits["since"])
    if "until" in limits:
        events = events.filter(F.col("event_date") < limits["until"])
    current = latest_by_key(events, ["session_id", "event_seq"], "ingested_at")
    fresh = build(current, **limits).withColumn("computed_at", F.lit(as_of).cast("timestamp"))
    write_by(fresh, mart_path, day)
    _remove_vanished(spark, mart_path, day, as_of, limits)


def _remove_vanished(spark: SparkSession, mart_path: str, day: str, as_of: datetime, limits: dict) -> None:
    """Delete the day directories inside the limits that this run did not write. Only partition names come to the driver."""
    stored = spark.read.parquet(mart_path).filter(F.col(day).isNotNull())
    if "since" in limits:
        stored = stored.filter(F.col(day) >= limits["since"])
    if "until" in limits:
        stored = stored.filter(F.col(day) < limits["until"])
    newest = stored.groupBy(day).agg(F.max("computed_at").alias("at"))
    for row in newest.filter(F.col("at") < F.lit(as_of).cast("timestamp")).collect():
        drop_folder(spark, f"{mart_path}/{day}={row[day]}")
