"""Ad-event sequence rules: click validity, bursts, attribution and the campaign mart.

Every "latest earlier event" rule is a running maximum per key with the time limit checked afterwards: when the
latest event is too old, so is every other one. That needs no self-join and no wide range window, and the running
maximum splits devices over time buckets of ``grain_us``.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.operators.scan import Carry, by_time, rolling_counts, running

SECOND = 1_000_000
MINUTE = 60 * SECOND
HOUR = 60 * MINUTE
DAY = 24 * HOUR
GRAIN = 10 * MINUTE


def is_type(name: str) -> Column:
    return F.col("event_type") == name


def with_identity(tape: DataFrame) -> DataFrame:
    """device_id = the device, else the user, else the cookie."""
    return tape.withColumn("device_id", F.coalesce("raw_device_id", "user_id", "cookie"))


def dedup_tape(tape: DataFrame, tolerance_us: int | None = None, grain_us: int = GRAIN) -> DataFrame:
    """Drop exact copies; with a tolerance also events that follow their twin within it.

    A twin has the same device, type, ad and campaign. A chain of close twins keeps only its first event.
    """
    identity = ["device_id", "event_type", "ad_id", "campaign_id"]
    unique = tape.dropDuplicates([*identity, "ts_us"])
    if tolerance_us is None:
        return unique
    spaced = running(
        unique, identity, ["ts_us"], [Carry("twin_us", "max", F.col("ts_us"), "before")],
        by_time(F.col("ts_us"), grain_us),
    )
    return spaced.filter(F.col("twin_us").isNull() | (F.col("ts_us") - F.col("twin_us") > tolerance_us)).drop("twin_us")


def with_previous(tape: DataFrame, grain_us: int = GRAIN) -> DataFrame:
    """prev_type: the type of the device's preceding event (ties in order of event_id)."""
    return (
        running(
            tape, ["device_id"], ["ts_us", "event_id"],
            [Carry("prev", "max", F.struct("ts_us", "event_id", "event_type"), "before")],
            by_time(F.col("ts_us"), grain_us),
        )
        .withColumn("prev_type", F.col("prev.event_type"))
        .drop("prev")
    )


def _recent(moment: Column, now: Column, window_us: int) -> Column:
    return F.when(now - moment <= window_us, moment)


def with_impression_lag(tape: DataFrame, window_us: int = 30 * MINUTE, grain_us: int = GRAIN) -> DataFrame:
    """impression_us: the latest impression of the same ad on the device within the window, itself included."""
    seen = Carry("impression_us", "max", F.when(is_type("impression"), F.col("ts_us")), "peers")
    found = running(tape, ["device_id", "ad_id"], ["ts_us"], [seen], by_time(F.col("ts_us"), grain_us))
    return found.withColumn("impression_us", _recent(F.col("impression_us"), F.col("ts_us"), window_us)).withColumn(
        "has_impression", F.col("impression_us").isNotNull()
    )


def with_too_fast(tape: DataFrame, limit_us: int = 50_000) -> DataFrame:
    """Clicks that follow their impression in less than the limit."""
    quick = is_type("click") & (F.col("ts_us") - F.col("impression_us") < limit_us)
    return tape.withColumn("too_fast", F.coalesce(quick, F.lit(False)))


def with_burst(tape: DataFrame, window_us: int = 10 * MINUTE, clicks: int = 20, grain_us: int = GRAIN) -> DataFrame:
    """burst: more than ``clicks`` clicks and no conversion of the device within the window."""
    conditions = {"clicks_seen": is_type("click"), "conversions_seen": is_type("conversion")}
    counted = rolling_counts(tape, ["device_id"], "ts_us", conditions, window_us, grain_us)
    return counted.withColumn("burst", (F.col("clicks_seen") > clicks) & (F.col("conversions_seen") == 0))


def with_valid_click(tape: DataFrame) -> DataFrame:
    """A click with an impression that is neither too fast nor part of a burst."""
    return tape.withColumn(
        "valid_click", is_type("click") & F.col("has_impression") & ~F.col("too_fast") & ~F.col("burst")
    )


def attribute(
    tape: DataFrame, click_us: int = 7 * DAY, view_us: int = 24 * HOUR, grain_us: int = GRAIN
) -> DataFrame:
    """Per event: the last valid click of its campaign on the device, else the last impression, and which it was."""
    touched = running(
        tape,
        ["device_id", "campaign_id"],
        ["ts_us"],
        [
            Carry("click_at", "max", F.when(F.col("valid_click"), F.col("ts_us")), "peers"),
            Carry("view_at", "max", F.when(is_type("impression"), F.col("ts_us")), "peers"),
        ],
        by_time(F.col("ts_us"), grain_us),
    )
    return _credited(touched, click_us, view_us)


def _credited(touched: DataFrame, click_us: int, view_us: int) -> DataFrame:
    by_click = _recent(F.col("click_at"), F.col("ts_us"), click_us)
    by_view = _recent(F.col("view_at"), F.col("ts_us"), view_us)
    return touched.withColumns(
        {
            "attributed_us": F.coalesce(by_click, by_view),
            "source": F.when(by_click.isNotNull(), "click").when(by_view.isNotNull(), "view").otherwise("none"),
        }
    ).drop("click_at", "view_at")


def campaign_hour_mart(attributed: DataFrame) -> DataFrame:
    """Spend, valid clicks and conversions by campaign and hour."""
    return attributed.groupBy("campaign_id", F.date_trunc("hour", "ts").alias("hour")).agg(
        F.sum("spend").alias("spend"),
        F.count_if("valid_click").alias("valid_clicks"),
        F.count_if(is_type("conversion") & (F.col("source") == "click")).alias("attributed_conversions"),
        F.count_if(is_type("conversion") & (F.col("source") == "view")).alias("post_view_conversions"),
    )


def campaign_cpa(mart: DataFrame, conversion_value: float = 1.0) -> DataFrame:
    """Cost per attributed conversion and return on spend; null where the denominator is 0."""
    totals = mart.groupBy("campaign_id").agg(
        F.sum("spend").alias("spend"), F.sum("attributed_conversions").alias("conversions")
    )
    return totals.select(
        "campaign_id",
        F.try_divide("spend", "conversions").alias("cpa"),
        F.try_divide(F.col("conversions") * conversion_value, F.col("spend")).alias("roas"),
    )


def attribute_scan(
    tape: DataFrame, click_us: int = 7 * DAY, view_us: int = 24 * HOUR, grain_us: int = GRAIN
) -> DataFrame:
    """attribute() once more as a forward scan of sorted rows, kept to cross-check the windows.

    Rows are range-partitioned and sorted by (device, campaign, bucket, time). A seed row opens every bucket with
    the state left by earlier buckets, so a scan may start at any bucket and a hot device spans many partitions.
    Batches stream through; the only state is two numbers.
    """
    valid = F.when(F.col("valid_click"), F.col("ts_us"))
    viewed = F.when(is_type("impression"), F.col("ts_us"))
    keys = ["device_id", "campaign_id"]
    rows = tape.select(
        "event_id", *keys, "ts_us", "event_type", valid.alias("click_at"), viewed.alias("view_at"),
        F.floor(F.col("ts_us") / F.lit(grain_us)).alias("bucket"), F.lit(1).alias("is_row"),
    )
    per_bucket = rows.groupBy(*keys, "bucket").agg(
        F.max("click_at").alias("click_at"), F.max("view_at").alias("view_at")
    )
    earlier = Window.partitionBy(*keys).orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    seeds = per_bucket.select(
        *keys, "bucket", F.max("click_at").over(earlier).alias("click_at"),
        F.max("view_at").over(earlier).alias("view_at"), F.lit(0).alias("is_row"),
    )
    # At equal times touches come first: an event sees its peers.
    touch_first = F.when(F.coalesce("click_at", "view_at").isNotNull(), 0).otherwise(1)
    ordered = (
        rows.unionByName(seeds, allowMissingColumns=True)
        .withColumn("touch_order", touch_first)
        .repartitionByRange(*keys, "bucket")
        .sortWithinPartitions(*keys, "bucket", "is_row", "ts_us", "touch_order", "event_id")
    )

    def scan(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        carry = {"click_at": -np.inf, "view_at": -np.inf}
        for batch in batches:
            run = (batch["is_row"] == 0).cumsum().to_numpy()
            out = {}
            for name in carry:
                filled = batch[name].astype("float64").fillna(-np.inf)
                if run[0] == 0:
                    filled.iloc[0] = max(filled.iloc[0], carry[name])
                seen = filled.groupby(run).cummax()
                carry[name] = seen.iloc[-1]
                out[name] = seen.to_numpy()
            real = batch["is_row"].to_numpy() == 1
            result = batch.loc[real, ["event_id", *keys, "ts_us", "event_type"]].copy()
            for name, values in out.items():
                column = pd.Series(values[real], index=result.index)
                result[name] = column.where(column > -np.inf).astype("Int64")
            yield result

    schema = ", ".join(
        f"{name} {tape.schema[name].dataType.simpleString()}" for name in ["event_id", *keys, "ts_us", "event_type"]
    )
    scanned = ordered.mapInPandas(scan, f"{schema}, click_at bigint, view_at bigint")
    return _credited(scanned, click_us, view_us)


def sorted_tape(tape: DataFrame) -> DataFrame:
    """The tape in (device, time) order, cut into balanced ranges so that a hot device spans many partitions."""
    return tape.repartitionByRange("device_id", "ts_us", "event_id").sortWithinPartitions("device_id", "ts_us", "event_id")
