"""Sketches stored as tables: membership, distinct counts, frequent values and quantiles.

All of them merge: a sketch of two days is made from the sketches of each, and events are not read again. They are
built and merged by aggregates of the engine with map-side combine, so what shuffles is sketches, not rows.

A membership sketch is a blocked Bloom filter kept as a table ``(block, w0 ... w7)``: a key belongs to one block of 512 bits
and sets one bit in each of its eight words. Blocks merge by a bitwise or and are probed by a join, so the filter
is never held whole by a task or the driver and may be as large as a table.
"""

from __future__ import annotations

import math
from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DecimalType, DoubleType, FloatType

WORDS = 8
BLOCK_BITS = 64 * WORDS
BITS_SEED = 1


def blocks_for(expected_keys: int, bits_per_key: int = 12) -> int:
    """Blocks for so many keys; 12 bits a key let about one absent key in two hundred pass."""
    return max(1, math.ceil(expected_keys * bits_per_key / BLOCK_BITS))


def _place(df: DataFrame, on: Sequence[str], blocks: int) -> tuple[Column, list[Column]]:
    """The block of a row's key and its bit in each word. Keys are compared as text, so both sides may differ in integer width."""
    for name in on:
        kind = df.schema[name].dataType
        if isinstance(kind, (FloatType, DoubleType, DecimalType)):
            raise ValueError(f"equal values of {name} ({kind.simpleString()}) may differ as text")
    key = [F.coalesce(F.col(name).cast("string"), F.lit("")) for name in on]
    bits = F.xxhash64(*key, F.lit(BITS_SEED))
    places = [F.shiftrightunsigned(bits, 6 * i).bitwiseAND(F.lit(63)).cast("int") for i in range(WORDS)]
    masks = [F.call_function("shiftleft", F.lit(1).cast("long"), place) for place in places]
    return F.pmod(F.xxhash64(*key), F.lit(blocks)), masks


def membership(keys: DataFrame, on: Sequence[str], blocks: int) -> DataFrame:
    """The membership sketch of the keys: at most ``blocks`` rows ``(block, w0 ... w7)``. No keys give no rows."""
    block, masks = _place(keys, on, blocks)
    placed = keys.select(block.alias("block"), *[m.alias(f"w{i}") for i, m in enumerate(masks)])
    return _by_block(placed)


def _by_block(rows: DataFrame) -> DataFrame:
    return rows.groupBy("block").agg(*[F.bit_or(f"w{i}").alias(f"w{i}") for i in range(WORDS)])


def merged_membership(*sketches: DataFrame) -> DataFrame:
    """The sketch of all keys of sketches that were made with one number of blocks."""
    together = sketches[0]
    for sketch in sketches[1:]:
        together = together.unionByName(sketch)
    return _by_block(together)


def with_maybe(rows: DataFrame, sketch: DataFrame, on: Sequence[str], blocks: int) -> DataFrame:
    """Add ``maybe``: false where the key is surely not in the sketch. Keys that are in it always get true."""
    block, masks = _place(rows, on, blocks)
    held = sketch.select(F.col("block").alias("__block"), *[F.col(f"w{i}").alias(f"__w{i}") for i in range(WORDS)])
    asked = rows.withColumns({"__block": block, **{f"__m{i}": m for i, m in enumerate(masks)}})
    found = asked.join(held, "__block", "left")
    passed = F.lit(True)
    for i in range(WORDS):
        passed = passed & (F.col(f"__w{i}").bitwiseAND(F.col(f"__m{i}")) != 0)
    return found.withColumn("maybe", F.coalesce(passed, F.lit(False))).select(*rows.columns, "maybe")


def keys_absent_by_sketch(rows: DataFrame, known: DataFrame, sketch: DataFrame, on: Sequence[str], blocks: int) -> DataFrame:
    """Rows whose key does not occur in ``known``, exactly; ``sketch`` holds at least the keys of ``known``.

    Only rows that the sketch lets pass are compared with ``known``, and of ``known`` only rows that a sketch of those lets
    pass: with few new or few old keys next to nothing of the larger side shuffles. A null key occurs nowhere.
    """
    marked = with_maybe(rows, sketch, on, blocks)
    asked = marked.filter("maybe").drop("maybe")
    near = with_maybe(known.select(*on), membership(asked, on, blocks), on, blocks).filter("maybe").select(*on).distinct()
    return marked.filter(~F.col("maybe")).drop("maybe").unionByName(asked.join(near, list(on), "left_anti"))


def membership_report(rows: DataFrame, known: DataFrame, sketch: DataFrame, on: Sequence[str], blocks: int, by: Sequence[str] = ()) -> DataFrame:
    """Exact answer beside the sketch's, per ``by`` group: rows, present, missed (present, but not seen; always 0), passed
    (absent, but let pass) and passed_share of the absent."""
    exact = known.select(*on).distinct().withColumn("__known", F.lit(True))
    told = with_maybe(rows, sketch, on, blocks).join(exact, list(on), "left")
    present = F.coalesce("__known", F.lit(False))
    counted = told.groupBy(*by).agg(
        F.count("*").alias("rows"),
        F.count_if(present).alias("present"),
        F.count_if(present & ~F.col("maybe")).alias("missed"),
        F.count_if(~present & F.col("maybe")).alias("passed"),
    )
    return counted.withColumn("passed_share", F.coalesce(F.try_divide("passed", F.col("rows") - F.col("present")), F.lit(0.0)))


# ---------------------------------------------------------------- sketch columns of a mart


def sketched(
    df: DataFrame,
    by: Sequence[str],
    distinct: Mapping[str, str] | None = None,
    frequent: Mapping[str, str] | None = None,
    quantiles: Mapping[str, str] | None = None,
    lg_k: int = 12,
    counters: int = 1024,
    k: int = 400,
) -> DataFrame:
    """One row per ``by`` group with a sketch column for each name: ``{name: column}``.

    ``distinct``: 2^lg_k registers, standard error 1.04 / sqrt(2^lg_k). ``frequent``: about ``counters`` counters. ``quantiles``: rank
    error under 2.3 / k^0.9 at 99 %. Nulls are left out of all. Store the result like any mart; merged() adds groups up.
    """
    made = [F.hll_sketch_agg(c, lg_k).alias(name) for name, c in (distinct or {}).items()]
    for name, c in (frequent or {}).items():
        made.append(F.expr(f"approx_top_k_accumulate(`{c}`, {counters}) FILTER (WHERE `{c}` IS NOT NULL)").alias(name))
    made += [F.kll_sketch_agg_double(F.col(c).cast("double"), k).alias(name) for name, c in (quantiles or {}).items()]
    return df.groupBy(*by).agg(*made)


def merged(
    mart: DataFrame, by: Sequence[str] = (), distinct: Sequence[str] = (), frequent: Sequence[str] = (),
    quantiles: Sequence[str] = (), counters: int = 1024,
) -> DataFrame:
    """The sketches of coarser groups (or of all, as one row) from those of a stored mart."""
    made = [F.hll_union_agg(name).alias(name) for name in distinct]
    made += [F.expr(f"approx_top_k_combine(`{name}`, {counters})").alias(name) for name in frequent]
    made += [F.kll_merge_agg_double(name).alias(name) for name in quantiles]
    return mart.groupBy(*by).agg(*made)


def distinct_estimate(sketch: str) -> Column:
    return F.hll_sketch_estimate(sketch)


def distinct_error(lg_k: int = 12) -> float:
    """Three standard errors of a distinct count, as a share of it."""
    return 3 * 1.04 / math.sqrt(1 << lg_k)


def frequent_estimate(df: DataFrame, sketch: str, k: int, by: Sequence[str] = ()) -> DataFrame:
    """The about k most frequent values: ``(by..., value, cnt)``; a count is never less than the true one less frequent_error()."""
    return df.select(*by, F.inline(F.expr(f"approx_top_k_estimate(`{sketch}`, {k})"))).toDF(*by, "value", "cnt")


def frequent_error(counters: int) -> float:
    """How far a count may be off, as a share of all rows; every value above this share is found."""
    return 3.5 / (1 << max(3, math.ceil(math.log2(counters / 0.75))))


def quantile_estimate(sketch: str, q: float) -> Column:
    return F.kll_sketch_get_quantile_double(sketch, F.lit(q))


def quantile_error(k: int = 400) -> float:
    """How far the rank of an estimated quantile may be off, at 99 %, as a share of all rows."""
    return 2.3 / k**0.9
