"""Too-fast and burst rules on a stream of ad events, in any order within the watermark's delay.

A row is judged once the watermark has passed its time: nothing before it can arrive any more, so the answer is the batch
job's. Buckets of devices are cut into spans of time, each with state of its own, so a device without end neither fills one
task nor grows one state. A span is given the rows of the span before that its windows reach back to. A bucket is judged in
one step over its arrays, so the calls of the state store follow buckets and spans, not devices.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

from tidemark.operators import adtape
from tidemark.streaming.packed import NO_NUMBER, PACKED, numbered, pack, unpack

KINDS = {"impression": 0, "click": 1, "conversion": 2}
WAITING = pa.schema([("device_id", pa.string()), ("event_id", pa.int64()), ("ts_us", pa.int64()), ("kind", pa.int64()), ("ad_id", pa.int64())])
TOUCHES = pa.schema([("device_id", pa.string()), ("ts_us", pa.int64()), ("kind", pa.int64()), ("ad_id", pa.int64()), ("n", pa.int64())])
JUDGED = "event_id bigint, device_id string, ts_us bigint, event_type string, impression_us bigint, clicks_seen bigint, conversions_seen bigint"


class Windows:
    """Touches of many devices, and for each due row what its windows hold. Keys are (device, rank of the time) in one number."""

    def __init__(self, touches: pd.DataFrame, due: pd.DataFrame):
        self.touches, self.now, self.n = touches, due["ts_us"].to_numpy(), len(touches)
        self.times = np.unique(touches["ts_us"].to_numpy())
        self.wide = len(self.times) + 1
        self.rank = np.searchsorted(self.times, touches["ts_us"].to_numpy())
        self.upto = np.searchsorted(self.times, self.now, "right")
        both = pd.concat([touches[["device_id", "ad_id"]], due[["device_id", "ad_id"]]], ignore_index=True)
        self.device = pd.factorize(both["device_id"])[0].astype(np.int64)
        self.ad = both.assign(device_id=self.device).groupby(["device_id", "ad_id"], sort=False).ngroup().to_numpy().astype(np.int64)

    def _places(self, kind: str, group: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The keys of the touches of a kind in order, and which touches they are."""
        chosen = np.flatnonzero(self.touches["kind"].to_numpy() == KINDS[kind])
        keys = group[chosen] * self.wide + self.rank[chosen]
        order = np.argsort(keys, kind="stable")
        return keys[order], chosen[order]

    def counted(self, kind: str, width_us: int) -> np.ndarray:
        """How many touches of a kind lie in [t - width, t], for each time."""
        keys, which = self._places(kind, self.device)
        total = np.concatenate([[0], np.cumsum(self.touches["n"].to_numpy()[which])])
        mine = self.device[self.n :] * self.wide
        since = np.searchsorted(self.times, self.now - width_us, "left")
        return total[np.searchsorted(keys, mine + self.upto)] - total[np.searchsorted(keys, mine + since)]

    def latest(self, kind: str, width_us: int) -> np.ndarray:
        """Time of the latest touch of a kind of the same device and ad in [t - width, t]; -1 where there is none."""
        keys, which = self._places(kind, self.ad)
        if not len(keys):
            return np.full(len(self.now), -1, np.int64)
        mine = self.ad[self.n :]
        place = np.searchsorted(keys, mine * self.wide + self.upto) - 1
        found = keys[np.maximum(place, 0)]
        last = self.times[found % self.wide]
        return np.where((place >= 0) & (found // self.wide == mine) & (self.now - last <= width_us), last, -1)


class ClickJudge(StatefulProcessor):
    """Rows of one (bucket of devices, span) wait for the watermark; touches stay while a window can reach them."""

    def __init__(self, impression_us: int, burst_us: int, span_us: int):
        self.impression_us, self.burst_us, self.span_us = impression_us, burst_us, span_us

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.waiting = handle.getListState("waiting", PACKED)
        self.touches = handle.getListState("touches", PACKED)

    def handleInputRows(self, key, rows, timerValues) -> Iterator[pd.DataFrame]:
        first = None
        for batch in rows:
            seen = batch.groupby(["device_id", "ts_us", "kind", "ad_id"], sort=False).size().reset_index(name="n")
            self.touches.appendValue(pack(seen, TOUCHES))
            own = batch[~batch["carried"]]
            if len(own):
                self.waiting.appendValue(pack(own[WAITING.names], WAITING))
                first = int(own["ts_us"].min()) if first is None else min(first, int(own["ts_us"].min()))
        if first is not None:
            self.handle.registerTimer(-(-first // 1000))
        else:  # touches of the span before alone: they go when the span is over
            self.handle.registerTimer((int(key[1]) + 1) * self.span_us // 1000 + 1)
        yield from ()

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        passed = timerValues.getCurrentWatermarkInMs() * 1000
        waiting = unpack(self.waiting.get(), WAITING)
        touches = unpack(self.touches.get(), TOUCHES)
        due, left = waiting[waiting["ts_us"] <= passed], waiting[waiting["ts_us"] > passed]
        if len(due):
            due = due.reset_index(drop=True)
            windows = Windows(touches, due)
            latest = pd.Series(windows.latest("impression", self.impression_us))
            names = {number: name for name, number in KINDS.items()}
            yield pd.DataFrame(
                {
                    "event_id": due["event_id"], "device_id": due["device_id"], "ts_us": due["ts_us"], "event_type": due["kind"].map(names),
                    "impression_us": latest.where(latest >= 0).astype("Int64"),
                    "clicks_seen": windows.counted("click", self.burst_us),
                    "conversions_seen": windows.counted("conversion", self.burst_us),
                }
            )
        end = (int(key[1]) + 1) * self.span_us
        if passed >= end:
            self.waiting.clear()
            self.touches.clear()
            return
        if len(due):
            self._store(self.waiting, left, WAITING)
            self._store(self.touches, touches[touches["ts_us"] >= passed - max(self.impression_us, self.burst_us)], TOUCHES)
        self.handle.registerTimer(-(-int(left["ts_us"].min()) // 1000) if len(left) else end // 1000 + 1)

    def _store(self, state, rows: pd.DataFrame, shape: pa.Schema) -> None:
        if len(rows):
            state.put([pack(rows, shape)])
        else:
            state.clear()

    def close(self) -> None:
        pass


def judged_clicks(
    tape: DataFrame, delay: str, impression_us: int = 30 * adtape.MINUTE, too_fast_us: int = 50_000,
    burst_us: int = 10 * adtape.MINUTE, clicks: int = 20, span_us: int | None = None, buckets: int = 64,
) -> DataFrame:
    """Every event of a streaming tape, once, with what with_impression_lag, with_too_fast and with_burst add.

    ``tape``: event_id, device_id, ts, ts_us, event_type, ad_id (number). Rows may be out of order by ``delay``; later ones are
    dropped. A span (by default the widest window) must not be shorter than a window. Choose ``buckets`` so that the rows of two
    spans of a bucket fit a task. The session must use the RocksDB state store, which session.prepare() sets.
    """
    reach = max(impression_us, burst_us)
    span_us = span_us or reach
    if span_us < reach:
        raise ValueError("a span must be at least as long as the widest window")
    kinds = F.create_map(*[x for name, number in KINDS.items() for x in (F.lit(name), F.lit(number))])
    timed = tape.withColumn("ts", F.col("ts").cast("timestamp")).withWatermark("ts", delay)
    rows = timed.select(
        numbered(F.col("event_id")).alias("event_id"), "device_id", "ts", "ts_us",
        F.try_element_at(kinds, F.col("event_type")).alias("kind"), numbered(F.col("ad_id")).alias("ad_id"),
    ).filter("kind IS NOT NULL AND device_id IS NOT NULL AND ts_us IS NOT NULL")
    span = F.floor(F.col("ts_us") / F.lit(span_us))
    # What the next span looks back on goes there too, so that spans do not wait for each other.
    reaches_on = F.col("ts_us") >= (span + 1) * span_us - reach
    places = F.when(reaches_on, F.sequence(span, span + 1)).otherwise(F.array(span))
    dealt = rows.withColumn("home", span).withColumn("span", F.explode(places)).withColumn("carried", F.col("span") != F.col("home"))
    found = (
        dealt.withColumn("bucket", F.pmod(F.xxhash64("device_id"), F.lit(buckets)).cast("int"))
        .select("bucket", "span", "device_id", "event_id", "ts", "ts_us", "kind", "ad_id", "carried")
        .groupBy("bucket", "span")
        .transformWithStateInPandas(ClickJudge(impression_us, burst_us, span_us), JUDGED, "append", "eventTime")
        .withColumn("event_id", F.nullif("event_id", F.lit(NO_NUMBER)))
    )
    quick = (F.col("event_type") == "click") & (F.col("ts_us") - F.col("impression_us") < too_fast_us)
    return found.withColumns(
        {
            "has_impression": F.col("impression_us").isNotNull(),
            "too_fast": F.coalesce(quick, F.lit(False)),
            "burst": (F.col("clicks_seen") > clicks) & (F.col("conversions_seen") == 0),
        }
    )
