"""Streaming jobs. Each runs over what is there and stops, or keeps running with a trigger interval.

Every micro-batch writes its own ``batch=N`` directory and replaces it when the batch is repeated after a failure,
so results hold each batch once.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import IntegerType, LongType

from tidemark.lineage import drop_folder, staged, written
from tidemark.operators import adtape
from tidemark.operators.medallion import latest_by_key
from tidemark.operators.sessionlog import parse_files
from tidemark.sources.sessions import decode_sessions
from tidemark.streaming.sources import stream_session_files
from tidemark.streaming.state import click_state, fold_click_state


ONE_BATCH = "one batch"


def _start(writer, every: str | None) -> StreamingQuery:
    """Run over what is there (None), over it in a single batch (ONE_BATCH), or on an interval.

    State with a processing-time limit asks for another batch after each batch, so a finite run over it needs
    ONE_BATCH.
    """
    if every is None:
        return writer.trigger(availableNow=True).start()
    if every == ONE_BATCH:
        return writer.trigger(once=True).start()
    return writer.trigger(processingTime=every).start()


def start_table_sink(
    stream: DataFrame, target: str, checkpoint: str, partition_by: Sequence[str] = (), every: str | None = None
) -> StreamingQuery:
    """Append a stream to parquet; the sink's own log makes each batch appear once."""
    writer = stream.writeStream.format("parquet").outputMode("append")
    writer = writer.option("path", target).option("checkpointLocation", checkpoint)
    return _start(writer.partitionBy(*partition_by) if partition_by else writer, every)


def start_batches(
    stream: DataFrame, write: Callable[[DataFrame, int], None], checkpoint: str, mode: str = "append",
    every: str | None = None,
) -> StreamingQuery:
    writer = stream.writeStream.foreachBatch(write).outputMode(mode).option("checkpointLocation", checkpoint)
    return _start(writer, every)


def _replace_batch(df: DataFrame, target: str, batch: int) -> None:
    df.write.mode("overwrite").parquet(f"{target}/batch={batch}")


def start_ingest(
    spark: SparkSession, source: str, target: str, checkpoint: str, max_files: int = 5000, every: str | None = None
) -> StreamingQuery:
    """Parse new session files into the event table."""

    def write(files: DataFrame, batch: int) -> None:
        _replace_batch(parse_files(decode_sessions(files)), target, batch)

    return start_batches(stream_session_files(spark, source, max_files), write, checkpoint, every=every)


def start_latest(
    stream: DataFrame, keys: Sequence[str], version: str, target: str, checkpoint: str, every: str | None = None,
    buckets: int = 64, mode: str = "append",
) -> StreamingQuery:
    """Keep the newest row per key. The state is cut into buckets by key hash; a batch reads and writes those its keys lie in.

    A bucket keeps its last two versions, so a batch can be repeated and a reader of the version before is not disturbed. The
    columns ``bucket`` and ``batch`` are taken, and ``buckets`` must stay the same for one target.
    """

    def write(rows: DataFrame, batch: int) -> None:
        spark = rows.sparkSession
        with staged(spark):
            fresh = written(latest_by_key(rows, keys, version), "latest-fresh")
            touched = [r[0] for r in fresh.select(_bucket(keys, buckets)).distinct().collect()]  # at most ``buckets``
            versions = _versions(spark, target)
            earlier = [(k, max(v)) for k in touched if (v := [n for n in versions.get(k, []) if n < batch])]
            known = fresh.withColumn("batch", F.lit(batch))
            if earlier:
                before = spark.read.schema(rows.schema).parquet(*(f"{target}/bucket={k}/batch={n}" for k, n in earlier))
                known = known.unionByName(before.withColumn("batch", F.lit(-1)))
            newest = latest_by_key(known, keys, version, ["batch"]).withColumns(
                {"bucket": _bucket(keys, buckets), "batch": F.lit(batch)}
            )
            _replace_partitions(newest.hint("rebalance", F.col("bucket")), target, ["bucket", "batch"])
        _mark(spark, target, batch)
        for k in touched:
            for old in sorted({*versions.get(k, []), batch})[:-2]:
                drop_folder(spark, f"{target}/bucket={k}/batch={old}")

    return start_batches(stream, write, checkpoint, mode, every)


def read_latest(spark: SparkSession, target: str) -> DataFrame:
    """The newest state that start_latest() has finished."""
    done = max(int(path.rsplit("/", 1)[1]) for path in _paths(spark, f"{target}/_batches/*"))
    newest = {k: max(n for n in found if n <= done) for k, found in _versions(spark, target).items() if min(found) <= done}
    return spark.read.parquet(*(f"{target}/bucket={k}/batch={n}" for k, n in newest.items()))


def start_click_counts(
    tape: DataFrame, ttl_ms: int, target: str, checkpoint: str, shards: int = 64, every: str = ONE_BATCH, buckets: int = 64
) -> StreamingQuery:
    """Running touch counts in a table with a row for each birth of a shard's state, not for each update of it."""
    counts = click_state(tape, ttl_ms, shards).withColumn("touches", F.col("impressions") + F.col("clicks"))
    keys = ["device_id", "ad_id", "shard", "born"]
    return start_latest(counts, keys, "touches", target, checkpoint, every, buckets, "update")


def read_click_counts(spark: SparkSession, target: str) -> DataFrame:
    """Counts per (device, ad) as of the last finished batch."""
    return fold_click_state(read_latest(spark, target))


def _bucket(keys: Sequence[str], buckets: int) -> Column:
    return F.pmod(F.xxhash64(*keys), F.lit(buckets)).cast("int")


def _replace_partitions(df: DataFrame, target: str, partition_by: Sequence[str]) -> None:
    """Write partitions, each whole; others stay as they are."""
    writer = df.write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
    writer.partitionBy(*partition_by).parquet(target)


def _paths(spark: SparkSession, pattern: str) -> list[str]:
    glob = spark._jvm.org.apache.hadoop.fs.Path(pattern)
    found = glob.getFileSystem(spark._jsc.hadoopConfiguration()).globStatus(glob)
    return [status.getPath().toString() for status in found or []]


def _versions(spark: SparkSession, target: str) -> dict[int, list[int]]:
    """The batches stored for each bucket: two or three each."""
    found: dict[int, list[int]] = {}
    for path in _paths(spark, f"{target}/bucket=*/batch=*"):
        bucket, batch = (int(part.split("=")[1]) for part in path.split("/")[-2:])
        found.setdefault(bucket, []).append(batch)
    return found


def _mark(spark: SparkSession, target: str, batch: int) -> None:
    """Note that a batch is through; readers ignore later versions."""
    root = spark._jvm.org.apache.hadoop.fs.Path(f"{target}/_batches/{batch}")
    root.getFileSystem(spark._jsc.hadoopConfiguration()).create(root, True).close()
    drop_folder(spark, f"{target}/_batches/{batch - 2}")


def start_attribution(
    stream: DataFrame,
    target: str,
    carry: str,
    checkpoint: str,
    impression_us: int = 30 * adtape.MINUTE,
    click_us: int = 7 * adtape.DAY,
    view_us: int = 24 * adtape.HOUR,
    grain_us: int = adtape.GRAIN,
    late_us: int = 7 * adtape.DAY,
    every: str | None = None,
    buckets: int = 16,
) -> StreamingQuery:
    """Attribute conversions as they arrive, and again when late touches arrive; read_attribution() shows the last answer.

    The carry is partitioned by day and device bucket. A batch appends its own rows to it, so what it writes follows the batch
    and not the look-back, and reads the buckets of its devices from the look-back before its earliest row on. It brings
    the carried rows of its own devices together with its new rows in any order, runs the same skew-safe operators as
    the batch job over both, and writes the conversions that are new or not older than the device's earliest new row. Nothing
    pairs a click with every conversion. ``buckets`` must stay the same for one carry.

    Rows may be late by ``late_us``, across batches too: days that lie the look-back and ``late_us`` before a batch's median time,
    or before now if that is earlier, are removed. So a few rows with a time far ahead move nothing. Rows without a time
    are answered but not carried.
    """
    columns = ["event_id", "device_id", "ad_id", "campaign_id", "ts_us", "event_type"]
    look_back = max(click_us, view_us) + impression_us
    day_of = F.expr(f"(ts_us - pmod(ts_us, {adtape.DAY}L)) div {adtape.DAY}L").cast("int")

    def write(rows: DataFrame, batch: int) -> None:
        spark = rows.sparkSession
        with staged(spark):
            fresh = written(rows.select(*columns).withColumn("fresh", F.lit(True)), "tape-fresh")
            clock = fresh.agg(
                F.min("ts_us").alias("first"),
                F.least(F.percentile_approx("ts_us", 0.5), F.unix_micros(F.current_timestamp())).alias("now"),
            ).first()
            known = fresh.withColumn("first_us", F.lit(None).cast("bigint"))
            if clock["first"] is not None and _paths(spark, f"{carry}/day=*"):
                touched = [r[0] for r in fresh.select(_bucket(["device_id"], buckets)).distinct().collect()]
                firsts = fresh.groupBy("device_id").agg(F.min("ts_us").alias("first_us"))
                kept = spark.read.schema(rows.select(*columns).schema.add("day", IntegerType()).add("bucket", IntegerType()).add("batch", LongType()))
                kept = kept.parquet(carry).filter(
                    (F.col("day") >= (clock["first"] - look_back) // adtape.DAY) & F.col("bucket").isin(touched) & (F.col("batch") < batch)
                )
                mine = kept.join(firsts, "device_id").filter(F.col("ts_us") >= F.col("first_us") - look_back)
                # A batch that repeats carried rows (a source that was replayed) must not count them twice.
                mine = mine.dropDuplicates(["event_id"]).join(fresh.select("event_id"), "event_id", "left_anti")
                known = known.unionByName(mine.withColumn("fresh", F.lit(False)).select(*known.columns))
            known = written(known, "tape-known")
            seen = adtape.with_impression_lag(known, impression_us, grain_us)
            is_click = adtape.is_type("click")
            ruled = written(seen.withColumn("valid_click", is_click & F.col("has_impression")), "tape-ruled")
            credited = adtape.attribute(ruled, click_us, view_us, grain_us)
            due = F.col("fresh") | (F.col("ts_us") >= F.col("first_us"))
            answers = credited.filter(due & adtape.is_type("conversion"))
            _replace_batch(
                answers.select("event_id", "device_id", "campaign_id", "ts_us", "attributed_us", "source"), target, batch
            )
            dated = fresh.filter(F.col("ts_us").isNotNull()).select(
                *columns, day_of.alias("day"), _bucket(["device_id"], buckets).alias("bucket"), F.lit(batch).cast("bigint").alias("batch")
            )
            _replace_partitions(dated.hint("rebalance", F.col("day"), F.col("bucket")), carry, ["day", "bucket", "batch"])
        if clock["now"] is not None:
            oldest = (clock["now"] - late_us - look_back) // adtape.DAY
            for path in _paths(spark, f"{carry}/day=*"):
                if int(path.rsplit("=", 1)[1]) < oldest:
                    drop_folder(spark, path)

    return start_batches(stream, write, checkpoint, every=every)


def read_attribution(spark: SparkSession, target: str) -> DataFrame:
    """The last answer for each conversion."""
    return latest_by_key(spark.read.parquet(target), ["event_id"], "batch").drop("batch")
