"""Event table to daily marts, and the keyed refresh operators behind them."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import date

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.lineage import written
from tidemark.operators.joins import is_small
from tidemark.operators.sketches import sketched


def latest_by_key(df: DataFrame, keys: Sequence[str], version: str, tie_break: Sequence[str] = ()) -> DataFrame:
    """The newest row of each key. An aggregate, not a window: copies of a hot key shrink before the shuffle."""
    rest = [name for name in df.columns if name not in keys]
    newest = F.max_by(F.struct(*rest), F.struct(version, *tie_break)).alias("newest")
    return df.groupBy(*keys).agg(newest).select(*keys, "newest.*").select(*df.columns)


def dedup_events(events: DataFrame) -> DataFrame:
    """One row per (session_id, event_seq); the copies are replays of the same event."""
    return events.dropDuplicates(["session_id", "event_seq"])


def _within(day: Column, since: date | Column | None, until: date | Column | None) -> Column:
    """since <= day < until; null days never pass."""
    kept = day.isNotNull()
    if since is not None:
        kept = kept & (day >= since)
    if until is not None:
        kept = kept & (day < until)
    return kept


def card_hits_daily(
    events: DataFrame, since: date | Column | None = None, until: date | Column | None = None
) -> DataFrame:
    """How often each document was returned by a card search per day; repeats in one result list count."""
    found = events.filter((F.col("event_type") == "CARD_SEARCH") & _within(F.col("event_date"), since, until))
    return (
        found.select(F.col("event_date").alias("date"), F.explode("result_doc_ids").alias("doc_id"))
        .groupBy("date", "doc_id")
        .agg(F.count("*").alias("hits"))
    )


def qs_opens_daily(
    events: DataFrame, since: date | Column | None = None, until: date | Column | None = None
) -> DataFrame:
    """How often each document was opened from a quick search per day."""
    opened = events.filter(
        (F.col("event_type") == "DOC_OPEN")
        & (F.col("search_kind") == "QS")
        & F.col("doc_id").isNotNull()
        & _within(F.col("event_date"), since, until)
    )
    return opened.groupBy(F.col("event_date").alias("open_date"), "doc_id").agg(F.count("*").alias("opens"))


def sketches_daily(
    events: DataFrame, since: date | Column | None = None, until: date | Column | None = None
) -> DataFrame:
    """Per day: events, and sketches of its sessions, opened documents (distinct and frequent) and events per session.

    Sketches of days merge (operators.sketches.merged), so any span of days is answered from the mart.
    """
    day = F.col("event_date")
    kept = events.filter(_within(day, since, until)).select("event_date", "session_id", F.when(F.col("event_type") == "DOC_OPEN", F.col("doc_id")).alias("doc_id"))
    sizes = kept.groupBy("event_date", "session_id").agg(F.count("*").alias("size"))
    by_session = sketched(sizes, ["event_date"], distinct={"sessions": "session_id"}, quantiles={"sizes": "size"})
    by_event = sketched(kept, ["event_date"], distinct={"docs": "doc_id"}, frequent={"opened": "doc_id"})
    return by_session.join(by_event, "event_date")


def hot_since(as_of: date | Column, days: int = 10) -> Column:
    """First day of the hot window; the cold run covers everything before it."""
    return F.date_sub(as_of if isinstance(as_of, Column) else F.lit(as_of), days)


def adaptive_cutoff(mart: DataFrame, day: str, as_of: date | Column, days: int = 3) -> DataFrame:
    """min(as_of - days, newest day already in the mart), as one row."""
    fixed = hot_since(as_of, days)
    return mart.agg(F.least(fixed, F.coalesce(F.max(day), fixed)).alias("cutoff"))


def upsert(target: DataFrame, delta: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Rows of ``delta`` replace rows of ``target`` with the same key; the others stay."""
    return target.join(delta.select(*keys), list(keys), "left_anti").unionByName(delta)


def write_upsert(path: str, delta: DataFrame, keys: Sequence[str], partition: str) -> None:
    """Upsert into a partitioned parquet table, rewriting only the partitions that ``delta`` touches."""
    spark = delta.sparkSession
    staged = written(delta, "delta")
    target = spark.read.schema(delta.schema).parquet(path)
    touched = written(staged.select(partition).distinct(), "touched")
    touched = F.broadcast(touched) if is_small(touched) else touched
    merged = written(upsert(target.join(touched, partition, "left_semi"), staged, keys), "merged")
    (
        merged.hint("rebalance", partition)
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy(partition)
        .parquet(path)
    )
