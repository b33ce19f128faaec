"""Windowed counts whose late rows are kept: a side table of them, and corrections of windows that were closed.

Every micro-batch writes, under its own ``batch=N``, its counts per window (late ones apart), its late rows whole, and the
clock: the newest event time so far. A window is closed when the clock has passed its end by the delay; a row is late when its window
was closed before its batch came. settle() merges closed windows and corrections into a table by day and rewrites only the days
they touch.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from tidemark.functions.times import epoch_us
from tidemark.lineage import staged, written
from tidemark.operators.medallion import write_upsert
from tidemark.sources.tables import write_by
from tidemark.streaming.jobs import start_batches

CLOCK = "clock_us long"


def _exists(spark: SparkSession, path: str) -> bool:
    root = spark._jvm.org.apache.hadoop.fs.Path(path)
    return root.getFileSystem(spark._jsc.hadoopConfiguration()).exists(root)


def clock_us(spark: SparkSession, target: str, batch: int | None = None) -> int | None:
    """The newest event time up to a batch (default: of all); None before the first row."""
    path = f"{target}/clock"
    if not _exists(spark, path):
        return None
    stored = spark.read.schema(f"{CLOCK}, batch long").parquet(path)
    if batch is not None:
        stored = stored.filter(F.col("batch") <= batch)
    return stored.agg(F.max("clock_us").alias("at")).first()["at"]


def start_late_aware_counts(
    stream: DataFrame, ts: str, keys: Sequence[str], size_s: int, delay_s: int, target: str, checkpoint: str, every: str | None = None
) -> StreamingQuery:
    """Count rows per window of ``size_s`` seconds and ``keys``; rows that come after their window was closed go to the side table too.

    A batch that is repeated after a failure replaces what it wrote. Rows without a time are in no window.
    """
    size = size_s * 1_000_000

    def write(rows: DataFrame, batch: int) -> None:
        spark = rows.sparkSession
        before = clock_us(spark, target, batch - 1)
        start = (F.floor(epoch_us(F.col(ts)) / size) * size).cast("long")
        late = F.lit(False) if before is None else F.col("window_us") + size <= before - delay_s * 1_000_000
        with staged(spark):
            fresh = written(rows.filter(F.col(ts).isNotNull()).withColumn("window_us", start).withColumn("late", late), "late-aware")
            counts = fresh.groupBy("window_us", *keys, "late").agg(F.count("*").alias("n"))
            counts.write.mode("overwrite").parquet(f"{target}/counts/batch={batch}")
            fresh.filter("late").drop("late").write.mode("overwrite").parquet(f"{target}/late/batch={batch}")
            newest = fresh.agg(F.greatest(F.max(epoch_us(F.col(ts))), F.lit(before).cast("long")).alias("clock_us"))
            newest.write.mode("overwrite").parquet(f"{target}/clock/batch={batch}")

    return start_batches(stream, write, checkpoint, every=every)


def late_rows(spark: SparkSession, target: str) -> DataFrame:
    """The side table: rows that came after their window was closed, with the batch that brought them."""
    return spark.read.parquet(f"{target}/late")


def settle(spark: SparkSession, target: str, final: str, keys: Sequence[str], size_s: int, delay_s: int) -> None:
    """Merge windows that are closed, and corrections of windows that were, into ``final``: day, window_us, keys, n, late, upto.

    ``late`` is how much of ``n`` came late. ``upto`` is the last batch that a row holds: what it has is never added again,
    so a run that broke off is repeated as it is. Only days with something new are rewritten.
    """
    clock = clock_us(spark, target)
    if clock is None:
        return
    size, key = size_s * 1_000_000, ["window_us", *keys]
    counts = spark.read.parquet(f"{target}/counts").filter(F.col("window_us") + size <= clock - delay_s * 1_000_000)
    first = not _exists(spark, final)
    with staged(spark):
        if first:
            had = counts.select(*key, F.lit(0).cast("long").alias("had"), F.lit(0).cast("long").alias("had_late"), F.lit(-1).cast("long").alias("upto")).limit(0)
        else:
            kinds = ", ".join(f"`{k}` {counts.schema[k].dataType.simpleString()}" for k in key)
            stored = spark.read.schema(f"{kinds}, n long, late long, upto long, day date").parquet(final)
            had = stored.select(*key, F.col("n").alias("had"), F.col("late").alias("had_late"), "upto")
        same = [F.col(f"c.{k}").eqNullSafe(F.col(f"h.{k}")) for k in key]
        on = same[0]
        for condition in same[1:]:
            on = on & condition
        new = counts.alias("c").join(had.alias("h"), on, "left").filter(F.coalesce(F.col("upto"), F.lit(-1)) < F.col("c.batch"))
        total = new.groupBy(*[F.col(f"c.{k}") for k in key]).agg(
            (F.coalesce(F.max("had"), F.lit(0)) + F.sum("c.n")).alias("n"),
            (F.coalesce(F.max("had_late"), F.lit(0)) + F.sum(F.when(F.col("c.late"), F.col("c.n")).otherwise(0))).alias("late"),
            F.max("c.batch").cast("long").alias("upto"),
        )
        day = F.timestamp_micros("window_us").cast("date").alias("day")
        delta = written(total.select("window_us", *keys, "n", "late", "upto", day), "settled")
        if first:
            write_by(delta, final, "day")
        else:
            write_upsert(final, delta, key, "day")
