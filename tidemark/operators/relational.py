"""Everyday aggregates, filters and reshapes."""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def agg_by(df: DataFrame, keys: Sequence[str | Column], **measures: Column) -> DataFrame:
    """Named aggregates per key in one pass."""
    return df.groupBy(*keys).agg(*[column.alias(name) for name, column in measures.items()])


def above_average(df: DataFrame, key: str, value: str, min_count: int) -> DataFrame:
    """Rows above the overall mean, counted per key, keys with more than ``min_count`` of them.

    The mean is a scalar subquery of the same plan, so nothing is collected in between.
    """
    mean = df.agg(F.avg(value)).scalar()
    counted = df.filter(F.col(value) > mean).groupBy(key).agg(F.count("*").alias("cnt"))
    return counted.filter(F.col("cnt") > min_count)


def top_n(
    df: DataFrame, keys: Sequence[str], value: str, n: int, ties: bool = True, tie_break: Sequence[str] = ()
) -> DataFrame:
    """The n largest rows per group: by rank, keeping ties, or by row number, exactly n.

    Row numbers need only n rows per group and task, which Spark cuts before the shuffle. Ranks may tie without
    bound, so they are computed on counted distinct values and joined back: no task sorts a whole group.
    """
    if not ties:
        order = [F.desc(value), *tie_break]
        placed = df.withColumn("rank", F.row_number().over(Window.partitionBy(*keys).orderBy(*order)))
        return placed.filter(F.col("rank") <= n).withColumn("rank", F.col("rank").cast("bigint"))
    by_value = Window.partitionBy(*keys).orderBy(F.desc(value))
    counted = df.groupBy(*keys, value).agg(F.count("*").alias("__n"))
    largest = counted.withColumn("__place", F.row_number().over(by_value)).filter(F.col("__place") <= n)
    above = F.sum("__n").over(by_value.rowsBetween(Window.unboundedPreceding, -1))
    ranked = largest.select(*keys, value, (F.coalesce(above, F.lit(0)) + 1).alias("rank")).filter(F.col("rank") <= n)
    right = ranked.select(*[F.col(c).alias(f"__r_{c}") for c in [*keys, value]], "rank")
    matches = [df[c].eqNullSafe(right[f"__r_{c}"]) for c in [*keys, value]]
    return df.join(right, matches, "inner").select(*df.columns, "rank")


def salted_agg(df: DataFrame, keys: Sequence[str], value: str, salts: int) -> DataFrame:
    """Sum and count per key in two steps, first per (key, salt).

    Spark's own partial aggregation already shrinks hot keys; the salt helps when almost every row of a task has
    another key, so that partial results stay as large as the input.
    """
    salted = df.withColumn("__salt", F.pmod(F.monotonically_increasing_id(), F.lit(salts)))
    partial = salted.groupBy(*keys, "__salt").agg(F.sum(value).alias("s"), F.count("*").alias("n"))
    return partial.groupBy(*keys).agg(F.sum("s").alias("total"), F.sum("n").alias("cnt"))


def pivot_count(df: DataFrame, row: str, column: str, values: Sequence) -> DataFrame:
    """Rows per (row, column value), one output column per listed value; absent pairs are 0."""
    pivoted = df.groupBy(row).pivot(column, list(values)).agg(F.count(F.lit(1)))
    return pivoted.na.fill(0, [str(v) for v in values])


def unpivot_mean(df: DataFrame, ids: Sequence[str], columns: Sequence[str]) -> DataFrame:
    """Wide scores to long form, then the mean score per id group."""
    typed = df.select(*ids, *[F.col(c).cast("double").alias(c) for c in columns])
    long = typed.unpivot(list(ids), list(columns), "criterion", "score")
    return long.groupBy(*ids).agg(F.avg("score").alias("score"), F.count("score").alias("answers"))


def fewer_partitions(df: DataFrame, kept: float) -> DataFrame:
    """Merge neighbouring partitions after a filter that keeps about the fraction ``kept`` of the rows.

    The count follows the input instead of being fixed, so the merged tasks stay as large as the unfiltered ones.
    """
    return df.coalesce(max(1, math.ceil(df.rdd.getNumPartitions() * kept)))


def rebalanced(df: DataFrame) -> DataFrame:
    """Shuffle into evenly sized partitions; adaptive execution picks their number from the data size."""
    return df.hint("rebalance")


def distinct_keys(df: DataFrame, *keys: str) -> DataFrame:
    return df.select(*keys).distinct()


def approx_distinct(df: DataFrame, keys: Sequence[str], value: str, rsd: float = 0.05) -> DataFrame:
    """Distinct values per key from a fixed-size sketch."""
    return df.groupBy(*keys).agg(F.approx_count_distinct(value, rsd).alias("approx"))


def frequent_values(df: DataFrame, value: str, k: int, tracked: int = 10_000) -> DataFrame:
    """The about k most frequent values with approximate counts, from a sketch of ``tracked`` counters."""
    sketched = df.agg(F.expr(f"approx_top_k(`{value}`, {k}, {tracked})").alias("top"))
    return sketched.select(F.inline("top")).toDF("value", "cnt")


def with_surrogate_id(df: DataFrame, name: str = "surrogate_id") -> DataFrame:
    """A unique, not dense, id without a shuffle."""
    return df.withColumn(name, F.monotonically_increasing_id())
