"""Windowed counts, retention and deduplication on streams (all of it also works on batch frames)."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def with_event_time(stream: DataFrame, ts: str, delay: str) -> DataFrame:
    """Event time with a watermark; zone-less times are read as UTC because watermarks need a zone."""
    return stream.withColumn(ts, F.col(ts).cast("timestamp")).withWatermark(ts, delay)


def daily_counts(stream: DataFrame, ts: str, keys: Sequence[str], delay: str = "10 days") -> DataFrame:
    """Rows per day and key; days older than the delay are closed and later rows for them are dropped."""
    return tumbling(stream, ts, keys, "1 day", delay)


def tumbling(stream: DataFrame, ts: str, keys: Sequence[str], size: str, delay: str) -> DataFrame:
    return sliding(stream, ts, keys, size, size, delay)


def sliding(stream: DataFrame, ts: str, keys: Sequence[str], size: str, slide: str, delay: str) -> DataFrame:
    """Rows per window and key. Counts are combined per task before the shuffle, so hot keys stay small."""
    timed = with_event_time(stream, ts, delay)
    counted = timed.groupBy(F.window(ts, size, slide), *keys).agg(F.count("*").alias("n"))
    return counted.select(F.col("window.start").alias("window_start"), *keys, "n")


def dedup_stream(stream: DataFrame, keys: Sequence[str], ts: str, delay: str, shards: int = 64) -> DataFrame:
    """Drop repeats of a key that arrive within the delay.

    Stateful operators do not combine before their shuffle, so a key repeated without end would fill one task.
    A first pass drops repeats per (key, shard), a second one per key over what is left; shards follow the input splits.
    """
    timed = with_event_time(stream, ts, delay)
    if shards > 1:
        spread = timed.withColumn("__shard", F.pmod(F.spark_partition_id(), F.lit(shards)))
        timed = spread.dropDuplicatesWithinWatermark([*keys, "__shard"]).drop("__shard")
    return timed.dropDuplicatesWithinWatermark(list(keys))


def retain(df: DataFrame, ts: str, age: str, as_of: Column) -> DataFrame:
    """Rows not older than ``age`` (for example "7 days") at ``as_of``."""
    return df.filter(F.col(ts) >= as_of - F.expr(f"INTERVAL {age}"))
