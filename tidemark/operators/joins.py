"""Equi-joins with a checked broadcast and a salted shuffle."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

BROADCAST_LIMIT = 64 * 1024 * 1024


def estimated_bytes(df: DataFrame) -> int | None:
    """The optimizer's size estimate of a plan; None where the session does not expose it."""
    plan = getattr(df, "_jdf", None)
    if plan is None:
        return None
    return int(str(plan.queryExecution().optimizedPlan().stats().sizeInBytes()))


def is_small(df: DataFrame, limit: int = BROADCAST_LIMIT) -> bool:
    size = estimated_bytes(df)
    return size is not None and size <= limit


def join_on(
    left: DataFrame,
    right: DataFrame,
    on: Sequence[str],
    how: str = "inner",
    strategy: str | None = None,
    salts: int = 1,
    broadcast_limit: int = BROADCAST_LIMIT,
) -> DataFrame:
    """Join with an optional strategy: broadcast, merge or shuffle_hash.

    "broadcast" holds only while the right side's estimated size is under the limit; otherwise the join shuffles,
    salted if asked. ``salts`` > 1 spreads each key of the left side over that many tasks and
    copies the right side's rows to each of them; the right side must be the smaller one. Salts follow the row
    position, so identical rows spread too; read the left side from a stored table, whose row order a retried
    task sees again.
    """
    keys = list(on)
    if strategy == "broadcast":
        if is_small(right, broadcast_limit):
            return left.join(F.broadcast(right), keys, how)
        strategy = None
    hinted = right if strategy is None else right.hint(strategy)
    if salts <= 1:
        return left.join(hinted, keys, how)
    if how not in ("inner", "left", "left_semi", "left_anti"):
        raise ValueError("a salted join copies the right side, so it cannot keep unmatched right rows")
    salted_left = left.withColumn("__salt", F.pmod(F.monotonically_increasing_id(), F.lit(salts)).cast("int"))
    copies = right.withColumn("__salt", F.explode(F.sequence(F.lit(0), F.lit(salts - 1))))
    if strategy is not None:
        copies = copies.hint(strategy)
    return salted_left.join(copies, [*keys, "__salt"], how).drop("__salt")


def keys_absent(left: DataFrame, known: DataFrame, on: Sequence[str]) -> DataFrame:
    """Rows of ``left`` whose key does not occur in ``known``.

    Known keys are reduced to one each first, so a key that ``known`` repeats without end costs one row.
    """
    return left.join(known.select(*on).distinct(), list(on), "left_anti")


def keys_present(left: DataFrame, known: DataFrame, on: Sequence[str]) -> DataFrame:
    """Rows of ``left`` whose key occurs in ``known``; known keys are reduced to one each first."""
    return left.join(known.select(*on).distinct(), list(on), "left_semi")
