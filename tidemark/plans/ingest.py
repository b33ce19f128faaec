"""Incremental load of session files into the event table."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.lineage import new_folder, staged, written
from tidemark.operators.joins import join_on, keys_absent
from tidemark.operators.sessionlog import parse_files
from tidemark.operators.sketches import keys_absent_by_sketch, membership, merged_membership
from tidemark.schemas import LEDGER
from tidemark.sources.sessions import list_sessions, read_sessions
from tidemark.sources.tables import write_by, write_table


MEMBERSHIP = "block long, w0 long, w1 long, w2 long, w3 long, w4 long, w5 long, w6 long, w7 long"
LEDGER_BLOCKS = 1 << 20  # 64 MB in all when full, enough for 40 million paths


def new_files(
    files: DataFrame, ledger: DataFrame, cap: int | None = None, sketch: DataFrame | None = None, blocks: int = LEDGER_BLOCKS
) -> DataFrame:
    """All paths that the ledger does not know; with a ``cap`` the first of them by name, for runs of bounded length.

    The ledger grows, so it is joined, not broadcast. A membership ``sketch`` of its paths (of ``blocks`` blocks) keeps new paths and
    ledger rows that cannot meet out of that join; the answer stays exact.
    """
    if sketch is None:
        unknown = keys_absent(files.select("path"), ledger, ["path"])
    else:
        unknown = keys_absent_by_sketch(files.select("path"), ledger.select("path"), sketch, ["path"], blocks)
    return unknown if cap is None else unknown.orderBy("path").limit(cap)


def _stored(spark: SparkSession, path: str, schema) -> DataFrame:
    root = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    fs = root.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    if not fs.exists(root):
        return spark.createDataFrame([], schema)
    return spark.read.schema(schema).parquet(path)


def read_ledger(spark: SparkSession, path: str) -> DataFrame:
    """The stored ledger, empty when nothing was loaded yet."""
    return _stored(spark, path, LEDGER)


def read_sketch(spark: SparkSession, path: str) -> DataFrame:
    """The membership sketches that runs have stored, empty when nothing was loaded yet."""
    return _stored(spark, path, MEMBERSHIP)


def load_new_sessions(
    spark: SparkSession, source: str, event_path: str, ledger_path: str, as_of: datetime, cap: int | None = None,
    sketch_path: str | None = None, blocks: int = LEDGER_BLOCKS,
) -> DataFrame:
    """One run: pick new files, append their events, then append them to the ledger.

    Events are appended before the ledger, so a crash in between repeats files on the next run; readers drop
    the copies with latest_by_key or dedup_events. Returns the ledger rows this run added.

    With a ``sketch_path`` each run appends a membership sketch of its paths there, before the ledger: a path
    that is in the sketch alone is looked for in the ledger and loaded again. Start it with the ledger, not later.
    """
    report = new_folder(spark, "added")
    with staged(spark):
        known = None if sketch_path is None else merged_membership(read_sketch(spark, sketch_path))
        fresh = new_files(list_sessions(spark, source), read_ledger(spark, ledger_path), cap, known, blocks)
        picked = written(fresh, "picked")
        texts = join_on(read_sessions(spark, source), picked, ["path"], "left_semi")
        parsed = written(
            parse_files(texts, with_path=True).withColumn("ingested_at", F.lit(as_of).cast("timestamp")), "parsed"
        )
        write_by(parsed.drop("path"), event_path, "event_date", mode="append", sort=("session_id", "event_seq"))
        counts = parsed.groupBy("path").agg(F.count("*").alias("events_count"))
        added = picked.join(counts, "path", "left").select(
            "path",
            F.lit(as_of).cast("timestamp").alias("processed_at"),
            F.coalesce("events_count", F.lit(0)).cast("bigint").alias("events_count"),
        )
        added.write.parquet(report)
    added = spark.read.schema(LEDGER).parquet(report)
    if sketch_path is not None:
        write_table(membership(added, ["path"], blocks), sketch_path, mode="append")
    write_table(added, ledger_path, mode="append")
    return added
