"""Running aggregates over ordered groups, split so that no group has to fit one task.

A plain ``Window.partitionBy(key).orderBy(t)`` sends a whole key to one task. When one key holds a third of
the rows, that task never ends. ``running`` cuts every key into buckets along the order; each bucket is aggregated
(with map-side combine), the aggregate of the earlier buckets is carried into it as one seed row, and rows are folded
only inside (key, bucket). Sums, minima and maxima compose that way exactly; "latest non-null" is a maximum over a
struct that starts with the order columns. The plan is the same for every size: two reads of the input (rows and
totals), three shuffles, of which only one carries rows. Write the input first where it is costly to make, and between
steps that follow each other.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

_FOLDS = {"sum": F.sum, "max": F.max, "min": F.min}


@dataclass(frozen=True)
class Carry:
    """One running aggregate: ``how`` over ``value``, seen from each row through ``frame``.

    frame "upto" covers the row and all before it, "before" only strictly earlier rows, and "peers" also
    every row with an equal order value.
    """

    name: str
    how: str
    value: Column
    frame: str = "upto"


@dataclass(frozen=True)
class Split:
    """How to cut keys: ``bucket`` must not decrease along the order within a key. Choose it so that the rows of one key in
    one bucket fit a task."""

    bucket: Column


def _frame(keys: Sequence[str], order: Sequence[str], frame: str):
    base = Window.partitionBy(*keys).orderBy(*order)
    if frame == "upto":
        return base.rowsBetween(Window.unboundedPreceding, 0)
    if frame == "before":
        return base.rowsBetween(Window.unboundedPreceding, -1)
    if frame == "peers":
        return base.rangeBetween(Window.unboundedPreceding, Window.currentRow)
    raise ValueError(f"unknown frame: {frame}")


def running(
    df: DataFrame,
    keys: Sequence[str],
    order: Sequence[str],
    carries: Sequence[Carry],
    split: Split | None = None,
) -> DataFrame:
    """Add one column per carry.

    Without a split each key is folded in one task; use that only for keys whose size is bounded.
    """
    slots = [f"__v{i}" for i in range(len(carries))]
    staged = df.withColumns({slot: c.value for slot, c in zip(slots, carries)})
    if split is None:
        folded = staged.withColumns(
            {c.name: _FOLDS[c.how](slot).over(_frame(keys, order, c.frame)) for slot, c in zip(slots, carries)}
        )
        return folded.drop(*slots)

    staged = staged.withColumns({"__bucket": split.bucket, "__is_row": F.lit(1)})
    totals = staged.groupBy(*keys, "__bucket").agg(
        *[_FOLDS[c.how](slot).alias(slot) for slot, c in zip(slots, carries)]
    )
    earlier = Window.partitionBy(*keys).orderBy("__bucket").rowsBetween(Window.unboundedPreceding, -1)
    seeds = (
        totals.select(
            *keys,
            "__bucket",
            *[_FOLDS[c.how](slot).over(earlier).alias(slot) for slot, c in zip(slots, carries)],
        )
        .filter(F.coalesce(*[F.when(F.col(slot).isNotNull(), F.lit(1)) for slot in slots]).isNotNull())
        .withColumn("__is_row", F.lit(0))
    )
    both = staged.unionByName(seeds, allowMissingColumns=True)
    within = [*keys, "__bucket"]
    folded = both.withColumns(
        {
            c.name: _FOLDS[c.how](slot).over(_frame(within, ["__is_row", *order], c.frame))
            for slot, c in zip(slots, carries)
        }
    )
    return folded.filter(F.col("__is_row") == 1).drop("__is_row", "__bucket", *slots)


def rolling_counts(
    df: DataFrame,
    keys: Sequence[str],
    ts_us: str,
    conditions: dict[str, Column],
    width_us: int,
    grain_us: int,
) -> DataFrame:
    """Count rows meeting each condition in [t - width, t], as a sweep: +1 on arrival, -1 after expiry.

    The bucket grain is independent of the width, so a wide window does not widen the tasks.
    """
    flags = {f"__hit_{name}": F.when(cond, 1).otherwise(0).cast("bigint") for name, cond in conditions.items()}
    arrivals = df.withColumns({**flags, "__phase": F.lit(0)})
    hits = [F.col(flag) for flag in flags]
    any_hit = hits[0] == 1
    for hit in hits[1:]:
        any_hit = any_hit | (hit == 1)
    expiries = arrivals.filter(any_hit).select(
        *keys,
        (F.col(ts_us) + F.lit(width_us)).alias(ts_us),
        *[(-F.col(flag)).alias(flag) for flag in flags],
        F.lit(1).alias("__phase"),
    )
    swept = running(
        arrivals.unionByName(expiries, allowMissingColumns=True),
        keys,
        [ts_us, "__phase"],
        [Carry(name, "sum", F.col(f"__hit_{name}"), "peers") for name in conditions],
        by_time(F.col(ts_us), grain_us),
    )
    return swept.filter(F.col("__phase") == 0).drop("__phase", *flags)


def by_time(ts_us: Column, grain_us: int) -> Split:
    """Cut an epoch-microsecond order into spans of ``grain_us``."""
    return Split(F.floor(ts_us / F.lit(grain_us)))


def by_line(line_no: Column, size: int | None) -> Split | None:
    """Cut a line-number order into runs of ``size`` numbers; None keeps every key whole."""
    return None if size is None else Split(F.floor(line_no / F.lit(size)))
