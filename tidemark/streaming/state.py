"""Custom keyed state with a time to live."""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

from tidemark.streaming.packed import PACKED, as_text, from_text, pack, unpack

STATE = "impressions bigint, clicks bigint, last_impression_us bigint, born bigint"
NEVER = -1
KEYS = ["device_id", "ad_id", "shard"]
COUNTS = ["impressions", "clicks", "last_impression_us"]
STANDING = pa.schema(
    [("device_id", pa.string()), ("ad_id", pa.string()), ("shard", pa.int32())]
    + [(name, pa.int64()) for name in [*COUNTS, "born", "touched"]]
)


def _folded(rows: pd.DataFrame) -> pd.DataFrame:
    """One row a key: counts added up, times at their latest, births at their earliest."""
    how = {"impressions": "sum", "clicks": "sum", "last_impression_us": "max", "born": "min", "touched": "max"}
    return rows.groupby(KEYS, dropna=False, sort=False, as_index=False).agg(how)


class TouchCounter(StatefulProcessor):
    """Impressions, clicks and the latest impression of each key of a bucket. The result does not depend on arrival order.

    A key that was not touched for its time to live starts at zero under a new birth time, so totals add up over births. The keys of
    a bucket are kept in one value, so the calls of the state store follow buckets, not keys.
    """

    def __init__(self, ttl_ms: int):
        self.ttl_ms = ttl_ms

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.known = handle.getValueState("known", PACKED, ttlDurationMs=self.ttl_ms)

    def handleInputRows(self, key, rows, timerValues) -> Iterator[pd.DataFrame]:
        now = timerValues.getCurrentProcessingTimeInMs()
        fresh = None
        for batch in rows:
            shown = batch["event_type"] == "impression"
            counted = batch[KEYS].assign(
                impressions=shown.astype("int64"), clicks=(batch["event_type"] == "click").astype("int64"),
                last_impression_us=batch["ts_us"].where(shown).fillna(NEVER).astype("int64"), born=now, touched=now,
            )
            fresh = _folded(counted if fresh is None else pd.concat([fresh, counted], ignore_index=True))
        known = unpack([self.known.get()] if self.known.exists() else [], STANDING)
        known = known[known["touched"] + self.ttl_ms > now]
        if len(known):
            known = _folded(pd.concat([known, fresh], ignore_index=True))
        else:
            known = fresh
        self.known.update(pack(known, STANDING))
        yield known[known["touched"] == now][[*KEYS, *COUNTS, "born"]]

    def close(self) -> None:
        pass


def click_state(stream: DataFrame, ttl_ms: int, shards: int = 64, buckets: int = 256) -> DataFrame:
    """Running touch counts per (device, ad, shard) in update mode; idle keys are cleared after ``ttl_ms``.

    Shards spread a hot device over tasks; fold_click_state() adds them up. Keys lie in ``buckets``; a batch rewrites those it
    touches, and the keys of one must fit a task. The session must use the RocksDB state store, which session.prepare() sets.
    """
    spread = stream.withColumn("shard", F.pmod(F.xxhash64("event_id"), F.lit(shards)).cast("int"))
    kinds = {name: stream.schema[name].dataType for name in ("device_id", "ad_id")}
    counted = (
        spread.withColumn("bucket", F.pmod(F.xxhash64(*KEYS), F.lit(buckets)).cast("int"))
        .select("bucket", *[as_text(F.col(name), kind).alias(name) for name, kind in kinds.items()], "shard", "event_type", "ts_us")
        .groupBy("bucket")
        .transformWithStateInPandas(
            TouchCounter(ttl_ms),
            f"device_id string, ad_id string, shard int, {STATE}",
            "update",
            "processingTime",
        )
    )
    return counted.withColumns({name: from_text(F.col(name), kind) for name, kind in kinds.items()})


def fold_click_state(updates: DataFrame) -> DataFrame:
    """Counts per (device, ad) from state updates; from one birth of a shard's state on, its counts only grow."""
    per_shard = updates.groupBy("device_id", "ad_id", "shard", "born").agg(
        F.max("impressions").alias("impressions"),
        F.max("clicks").alias("clicks"),
        F.max("last_impression_us").alias("last_impression_us"),
    )
    return per_shard.groupBy("device_id", "ad_id").agg(
        F.sum("impressions").alias("impressions"),
        F.sum("clicks").alias("clicks"),
        F.max(F.when(F.col("last_impression_us") >= 0, F.col("last_impression_us"))).alias("last_impression_us"),
    )
