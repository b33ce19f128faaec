"""Alerts on a stream of samples: conditions that hold for a time, and series that fall silent.

An alert is pending while its condition holds, fires when it has held long enough, and is resolved by the first sample that
breaks it. A silent series fires without a row, by a timer. Samples may come in any order within the watermark's delay: they
wait until the watermark has passed them, so the answers are the batch operators' (metrics.alert_sustained, metrics.absent).
Buckets of series share a state and are worked on as arrays, so the calls of the state store follow buckets, not series or samples.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

from tidemark.streaming.packed import PACKED, as_text, from_text, numbered, pack, unpack

CHANGES = "kind string, at_us bigint, from_us bigint, until_us bigint, samples bigint"
COLUMNS = ["kind", "at_us", "from_us", "until_us", "samples"]
SAMPLE = [("ts_us", pa.int64()), ("sample_id", pa.int64()), ("held", pa.bool_())]
STANDING = [  # of one series: its last sample and whether its silence was told, and its open stretch (no samples: none)
    ("last_us", pa.int64()), ("told", pa.bool_()), ("from_us", pa.int64()), ("until_us", pa.int64()), ("samples", pa.int64()), ("fired", pa.bool_()),
]


def _shift(values: np.ndarray, first: np.ndarray, before: np.ndarray) -> np.ndarray:
    """The value of the row before, and ``before`` at the first row of each series."""
    shifted = np.concatenate([values[:1], values[:-1]])
    shifted[first] = before
    return shifted


def changes(known: pd.DataFrame, due: pd.DataFrame, hold_us: int, gap_us: int) -> tuple[pd.DataFrame, pd.DataFrame]:
    """The new standing of the series ``due`` touches, and what changed, with the number of its series.

    ``known``: a row for each series (in the order of their numbers) with the columns of STANDING; ``due``: series (number), ts_us,
    sample_id, held, in any order.
    """
    due = due.sort_values(["series", "ts_us", "sample_id", "held"], ignore_index=True)
    series, at, held = due["series"].to_numpy(), due["ts_us"].to_numpy(), due["held"].to_numpy(bool)
    rows = np.arange(len(due))
    first = np.flatnonzero(np.concatenate([[True], series[1:] != series[:-1]]))
    last = np.concatenate([first[1:] - 1, [len(due) - 1]])
    mine = known.iloc[series[first]]
    seen = _shift(at, first, mine["last_us"].to_numpy())
    told = _shift(np.zeros(len(due), bool), first, mine["told"].to_numpy(bool))
    silent = ~told & (at > seen + gap_us)

    # Runs of held samples. The first of a series may go on with the stretch that stood open.
    open_ = mine["samples"].to_numpy() > 0
    held_before = _shift(held, first, open_)
    starts = held & ~held_before
    goes_on = np.zeros(len(due), bool)
    goes_on[first] = held[first] & open_
    begin = np.maximum.accumulate(np.where(starts | goes_on, rows, -1))  # the run's first row here; used at held rows only
    count, since, fired_then = np.zeros(len(due), np.int64), at.copy(), np.zeros(len(due), bool)
    count[first] = np.where(goes_on[first], mine["samples"].to_numpy(), 0)
    since[first] = np.where(goes_on[first], mine["from_us"].to_numpy(), at[first])
    fired_then[first] = goes_on[first] & mine["fired"].to_numpy(bool)
    run = np.maximum(begin, 0)
    samples, from_us = count[run] + rows - run + 1, since[run]
    fired = held & (fired_then[run] | (at - from_us >= hold_us))
    fired_before = _shift(fired, first, open_ & mine["fired"].to_numpy(bool))
    fires = fired & ~(held_before & fired_before)
    ends = ~held & held_before & fired_before
    ended = {
        "from_us": _shift(from_us, first, mine["from_us"].to_numpy()),
        "until_us": _shift(at, first, mine["until_us"].to_numpy()),
        "samples": _shift(samples, first, mine["samples"].to_numpy()),
    }
    made = [
        pd.DataFrame({"series": series[silent], "kind": "absent", "at_us": seen[silent] + gap_us, "from_us": seen[silent], "until_us": seen[silent], "samples": 0}),
        pd.DataFrame({"series": series[fires], "kind": "firing", "at_us": at[fires], "from_us": from_us[fires], "until_us": at[fires], "samples": samples[fires]}),
        pd.DataFrame({"series": series[ends], "kind": "resolved", "at_us": at[ends], **{n: v[ends] for n, v in ended.items()}}),
    ]
    stands = held[last]
    standing = {
        "last_us": at[last], "told": False, "from_us": np.where(stands, from_us[last], 0), "until_us": np.where(stands, at[last], 0),
        "samples": np.where(stands, samples[last], 0), "fired": fired[last],
    }
    return pd.DataFrame(standing, index=series[first]), pd.concat(made, ignore_index=True)


class AlertWatch(StatefulProcessor):
    """One bucket of series. Its state is a row for each series and the samples that wait for the watermark."""

    def __init__(self, series: list[str], hold_us: int, gap_us: int):
        self.series, self.hold_us, self.gap_us = series, hold_us, gap_us
        names = [(name, pa.string()) for name in series]
        self.sample, self.standing = pa.schema(names + SAMPLE), pa.schema(names + STANDING)

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.waiting = handle.getListState("waiting", PACKED)
        self.known = handle.getValueState("known", PACKED)

    def handleInputRows(self, key, rows, timerValues) -> Iterator[pd.DataFrame]:
        first = None
        for batch in rows:
            self.waiting.appendValue(pack(batch[self.sample.names], self.sample))
            least = int(batch["ts_us"].min())
            first = least if first is None else min(first, least)
        self.handle.registerTimer(-(-first // 1000))
        yield from ()

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        passed = timerValues.getCurrentWatermarkInMs() * 1000
        waiting = unpack(self.waiting.get(), self.sample)
        known = unpack([self.known.get()] if self.known.exists() else [], self.standing)
        due, left = waiting[waiting["ts_us"] <= passed], waiting[waiting["ts_us"] > passed]
        made = []
        if len(due):
            both = pd.concat([known[self.series], due[self.series]], ignore_index=True)
            numbers = both.groupby(self.series, dropna=False, sort=False).ngroup().to_numpy()
            new = both.assign(number=numbers)[len(known) :].drop_duplicates("number")
            new = new[new["number"] >= len(known)][self.series].assign(
                last_us=0, told=True, from_us=0, until_us=0, samples=0, fired=False
            )
            known = pd.concat([known, new], ignore_index=True).astype({"told": bool, "fired": bool})
            rows = due[["ts_us", "sample_id", "held"]].assign(series=numbers[len(known) - len(new) :])
            standing, found = changes(known, rows, self.hold_us, self.gap_us)
            for name in standing:
                known.loc[standing.index, name] = standing[name]
            made.append(found)
        silent = ~known["told"].to_numpy(bool) & (known["last_us"].to_numpy() + self.gap_us <= passed)
        if silent.any():
            since = known["last_us"].to_numpy()[silent]
            made.append(pd.DataFrame({"series": np.flatnonzero(silent), "kind": "absent", "at_us": since + self.gap_us, "from_us": since, "until_us": since, "samples": 0}))
            known.loc[silent, "told"] = True
        if len(due):
            self.waiting.put([pack(left, self.sample)]) if len(left) else self.waiting.clear()
        if made:
            self.known.update(pack(known, self.standing))
        if len(left):
            self.handle.registerTimer(-(-int(left["ts_us"].min()) // 1000))
        heard = known.loc[~known["told"].to_numpy(bool), "last_us"]
        if len(heard):
            self.handle.registerTimer(-(-(int(heard.min()) + self.gap_us) // 1000))
        if made and any(map(len, made)):
            told = pd.concat(made, ignore_index=True)
            named = known[self.series].iloc[told["series"].to_numpy()].reset_index(drop=True)
            yield pd.concat([named, told[COLUMNS]], axis=1)

    def close(self) -> None:
        pass


def watch(samples: DataFrame, series: Sequence[str], condition: Column, hold_s: int, gap_s: int, delay: str, buckets: int = 256) -> DataFrame:
    """Changes of state of each series: ``(series..., kind, at_us, from_us, until_us, samples)``.

    ``samples``: ts, ts_us, sample_id, series columns and what ``condition`` needs. kind "firing": the condition has held from from_us
    for ``hold_s`` seconds; "resolved": that stretch was broken at at_us, until_us was its last sample; "absent": nothing since from_us for
    ``gap_s`` seconds. Samples of one time are taken by sample_id. Samples later than ``delay`` are dropped. A batch rewrites the
    state of the buckets it touches: choose ``buckets`` so that the samples of one that wait fit a task.
    """
    timed = samples.withColumn("ts", F.col("ts").cast("timestamp")).withWatermark("ts", delay).filter("ts_us IS NOT NULL")
    held = F.coalesce(condition, F.lit(False)).alias("held")
    kinds = {c: samples.schema[c].dataType for c in series}
    shape = ", ".join(f"`{c}` string" for c in series)
    found = (
        timed.select(
            F.pmod(F.xxhash64(*series), F.lit(buckets)).cast("int").alias("__bucket"),
            *[as_text(F.col(c), kinds[c]).alias(c) for c in series], "ts", "ts_us", numbered(F.col("sample_id")).alias("sample_id"), held,
        )
        .groupBy("__bucket")
        .transformWithStateInPandas(
            AlertWatch(list(series), hold_s * 1_000_000, gap_s * 1_000_000), f"{shape}, {CHANGES}", "append", "eventTime"
        )
    )
    return found.select(*[from_text(F.col(c), kinds[c]).alias(c) for c in series], *COLUMNS)
