"""Metric-series algebra over samples ``(ts, ts_us, sample_id, labels..., value)``.

A series is a handful of labels with very many samples, so everything that looks at neighbouring samples goes
through the bucketed running aggregates. Increases count inside the window only, without extrapolation to its edges.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.operators.joins import join_on
from tidemark.operators.scan import Carry, by_time, running

GRAIN = 600 * 1_000_000


def window_start(range_s: int) -> Column:
    """Start of the tumbling window of ``range_s`` seconds around ts_us."""
    width = range_s * 1_000_000
    return F.timestamp_micros((F.floor(F.col("ts_us") / width) * width).cast("bigint"))


def deltas(samples: DataFrame, series: Sequence[str], grain_us: int = GRAIN) -> DataFrame:
    """Growth of a counter since the sample before; after a reset the new value itself."""
    previous = Carry("prev", "max", F.struct("ts_us", "sample_id", "value"), "before")
    paired = running(samples, series, ["ts_us", "sample_id"], [previous], by_time(F.col("ts_us"), grain_us))
    before, now = F.col("prev.value"), F.col("value")
    grown = F.when(before.isNull(), 0.0).when(now < before, now).otherwise(now - before)
    return paired.withColumn("delta", grown).drop("prev")


def increase(
    samples: DataFrame, series: Sequence[str], range_s: int, by: Sequence[str] | None = None, grain_us: int = GRAIN
) -> DataFrame:
    """Counter growth per window, summed over the series of each ``by`` group."""
    group = list(series if by is None else by)
    grown = deltas(samples, series, grain_us)
    return grown.groupBy(*group, window_start(range_s).alias("window_start")).agg(F.sum("delta").alias("increase"))


def rate(
    samples: DataFrame, series: Sequence[str], range_s: int, by: Sequence[str] | None = None, grain_us: int = GRAIN
) -> DataFrame:
    """increase() per second."""
    grown = increase(samples, series, range_s, by, grain_us)
    return grown.withColumn("rate", F.col("increase") / range_s).drop("increase")


def aggregate_by(df: DataFrame, by: Sequence[str], value: str = "value") -> DataFrame:
    """sum, mean and maximum of a value per label group."""
    return df.groupBy(*by).agg(
        F.sum(value).alias("sum_value"), F.avg(value).alias("avg_value"), F.max(value).alias("max_value")
    )


def topk(df: DataFrame, n: int, value: str, by: Sequence[str] = (), tie_break: Sequence[str] = ()) -> DataFrame:
    """The n largest rows, overall or per group. Spark keeps n rows per group and task before the shuffle."""
    order = [F.desc(value), *tie_break]
    if not by:
        return df.orderBy(*order).limit(n)
    ranked = df.withColumn("__rank", F.row_number().over(Window.partitionBy(*by).orderBy(*order)))
    return ranked.filter(F.col("__rank") <= n).drop("__rank")


def ratio(df: DataFrame, by: Sequence[str], numerator: Column, denominator: Column, value: str) -> DataFrame:
    """Sum of ``value`` where one condition holds over the sum where another does; null when the latter is 0."""
    return (
        df.groupBy(*by)
        .agg(
            F.sum(F.when(numerator, F.col(value)).otherwise(0.0)).alias("__top"),
            F.sum(F.when(denominator, F.col(value)).otherwise(0.0)).alias("__bottom"),
        )
        .select(*by, F.try_divide("__top", "__bottom").alias("ratio"))
    )


def histogram(observations: DataFrame, by: Sequence[str], value: str, bounds: Sequence[float]) -> DataFrame:
    """Cumulative bucket counts ``(by..., le, count)``; the last bucket is unbounded. One row per group shuffles."""
    limits = [*bounds, float("inf")]
    counted = observations.groupBy(*by).agg(
        *[F.count_if(F.col(value) <= F.lit(limit)).cast("double").alias(f"__b{i}") for i, limit in enumerate(limits)]
    )
    rows = F.array(
        *[F.struct(F.lit(limit).alias("le"), F.col(f"__b{i}").alias("count")) for i, limit in enumerate(limits)]
    )
    return counted.select(*by, F.inline(rows))


def histogram_quantile(buckets: DataFrame, q: float, by: Sequence[str]) -> DataFrame:
    """Quantile by linear interpolation inside its bucket.

    In the unbounded bucket the answer is the highest finite bound; groups without observations give null. The
    windows run over the few buckets of a group.
    """
    ordered = Window.partitionBy(*by).orderBy("le")
    whole = Window.partitionBy(*by)
    placed = buckets.withColumns(
        {
            "below": F.coalesce(F.lag("count").over(ordered), F.lit(0.0)),
            "lower": F.coalesce(F.lag("le").over(ordered), F.least(F.lit(0.0), F.col("le"))),
            "target": F.max("count").over(whole) * q,
        }
    )
    inside = F.col("lower") + (F.col("le") - F.col("lower")) * F.try_divide(
        F.col("target") - F.col("below"), F.col("count") - F.col("below")
    )
    # An empty first bucket at or under the target answers with its bound.
    answer = F.when(F.col("le") == float("inf"), F.col("lower")).otherwise(F.coalesce(inside, F.col("le")))
    reached = F.when((F.col("count") >= F.col("target")) & (F.col("target") > 0), F.struct("le", answer.alias("answer")))
    return placed.groupBy(*by).agg(F.min(reached).alias("first")).select(*by, F.col("first.answer").alias("quantile"))


def alert(df: DataFrame, condition: Column) -> DataFrame:
    """Rows on which the condition holds."""
    return df.filter(condition)


def alert_sustained(
    samples: DataFrame, series: Sequence[str], condition: Column, hold_s: int, grain_us: int = GRAIN
) -> DataFrame:
    """Unbroken stretches of samples meeting the condition for at least ``hold_s`` seconds.

    A stretch is named by the last sample that broke the condition before it.
    """
    held = F.coalesce(condition, F.lit(False))
    broken = Carry("broken", "max", F.when(~held, F.struct("ts_us", "sample_id")))
    marked = running(
        samples.withColumn("__held", held), series, ["ts_us", "sample_id"], [broken],
        by_time(F.col("ts_us"), grain_us),
    )
    stretches = (
        marked.filter("__held")
        .groupBy(*series, "broken")
        .agg(F.min("ts_us").alias("from_us"), F.max("ts_us").alias("until_us"), F.count("*").alias("samples"))
    )
    return stretches.filter(F.col("until_us") - F.col("from_us") >= hold_s * 1_000_000).drop("broken")


def overspend(
    samples: DataFrame, series: Sequence[str], budgets: DataFrame, key: str, factor: float = 1.1, grain_us: int = GRAIN
) -> DataFrame:
    """Days on which a campaign's increase exceeds ``factor`` times its budget."""
    daily = increase(samples, series, 86_400, by=[key], grain_us=grain_us)
    return join_on(daily, budgets, [key], strategy="broadcast").filter(F.col("increase") > factor * F.col("budget"))


def absent(samples: DataFrame, series: Sequence[str], as_of_us: int | Column, gap_s: int) -> DataFrame:
    """Series whose last sample is older than ``gap_s`` at ``as_of_us``, with the age in seconds."""
    now = as_of_us if isinstance(as_of_us, Column) else F.lit(as_of_us)
    aged = samples.groupBy(*series).agg(F.floor((now - F.max("ts_us")) / 1_000_000).alias("age_s"))
    return aged.filter(F.col("age_s") > gap_s)


def last_run(samples: DataFrame, series: Sequence[str]) -> DataFrame:
    """The latest value of each series; an aggregate, so long series shrink before the shuffle."""
    return samples.groupBy(*series).agg(
        F.max_by("value", F.struct("ts_us", "sample_id")).alias("value"), F.max("ts_us").alias("last_us")
    )


def sliding_rate(samples: DataFrame, series: Sequence[str], size_s: int, slide_s: int) -> DataFrame:
    """Samples per second over [start, start + size), one window every ``slide_s``.

    Samples are first counted per slide, and only those panes are copied into the windows that cover them.
    """
    slide = slide_s * 1_000_000
    panes = samples.groupBy(*series, F.floor(F.col("ts_us") / slide).alias("pane")).agg(F.count("*").alias("n"))
    starts = F.sequence(F.col("pane") - (size_s // slide_s - 1), F.col("pane"))
    return (
        panes.select(*series, F.explode(starts).alias("start"), "n")
        .groupBy(*series, F.timestamp_micros(F.col("start") * slide).alias("window_start"))
        .agg((F.sum("n") / size_s).alias("rate"))
    )
