"""The dashboard questions over the event table, the marts and the ledger. "Now" is always a parameter."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.functions.pricing import labelled
from tidemark.functions.times import monday_first, seconds_between

# Fixed labels of the panels.
SIZE_LABELS = [(1, "1 событие"), (5, "2-5"), (10, "6-10"), (20, "11-20"), (50, "21-50")]
DURATION_LABELS = [(60, "< 1 мин"), (300, "1-5 мин"), (900, "5-15 мин"), (1800, "15-30 мин"), (3600, "30-60 мин")]
OPENS_LABELS = [(0, "0 (bounce)"), (2, "1-2"), (5, "3-5"), (10, "6-10")]
WEEKDAYS = ["Пн", "Вт", "Ср", "Чт", "Пт", "Сб", "Вс"]
BEHAVIOURS = {"both": "QS + CARD", "qs": "только QS", "card": "только CARD", "opens": "только просмотр", "none": "без активности"}


def _moment(as_of: datetime | Column) -> Column:
    return as_of if isinstance(as_of, Column) else F.lit(as_of).cast("timestamp")


def _ago(as_of: datetime | Column, amount: int, unit: str) -> Column:
    return _moment(as_of) - F.expr(f"INTERVAL '{amount}' {unit}")


def doc_hits(mart: DataFrame, doc_id: str) -> DataFrame:
    return mart.filter(F.col("doc_id") == doc_id).agg(F.sum("hits").alias("hits"))


def event_count(events: DataFrame) -> DataFrame:
    return events.agg(F.count("*").alias("events"))


def sessions(events: DataFrame) -> DataFrame:
    return events.agg(F.countDistinct("session_id").alias("sessions"))


def type_mix(events: DataFrame) -> DataFrame:
    return events.groupBy("event_type").agg(F.count("*").alias("cnt")).orderBy(F.desc("cnt"), "event_type")


def top_opens(mart: DataFrame, n: int = 20) -> DataFrame:
    return mart.select("open_date", "doc_id", "opens").orderBy(F.desc("opens"), "open_date", "doc_id").limit(n)


def doc_series(mart: DataFrame, doc_id: str) -> DataFrame:
    return mart.filter(F.col("doc_id") == doc_id).select("date", "hits").orderBy("date")


def topk_series(mart: DataFrame, k: int = 3) -> DataFrame:
    """Daily series of the k most opened documents."""
    best = mart.groupBy("doc_id").agg(F.sum("opens").alias("total")).orderBy(F.desc("total"), "doc_id").limit(k)
    return (
        mart.join(F.broadcast(best.select("doc_id")), "doc_id", "left_semi")  # k rows
        .select("open_date", "doc_id", "opens")
        .orderBy("open_date", "doc_id")
    )


def top_queries(events: DataFrame, n: int = 20) -> DataFrame:
    asked = events.filter((F.col("event_type") == "QS") & F.col("query_text").isNotNull())
    return (
        asked.groupBy(F.col("query_text").alias("query"))
        .agg(F.count("*").alias("searches"))
        .orderBy(F.desc("searches"), "query")
        .limit(n)
    )


def bucketed(df: DataFrame, value: str, label: Column, measure: str) -> DataFrame:
    """Rows per label, ordered by the smallest value under it."""
    return (
        df.groupBy(label.alias("bucket"))
        .agg(F.count("*").alias(measure), F.min(value).alias("__least"))
        .orderBy("__least")
        .drop("__least")
    )


def session_size(events: DataFrame) -> DataFrame:
    sized = events.groupBy("session_id").agg(F.count("*").alias("n"))
    return bucketed(sized, "n", labelled(F.col("n"), SIZE_LABELS, "50+"), "sessions")


def session_quantiles(events: DataFrame, as_of: datetime | Column, hours: int = 24) -> DataFrame:
    """Mean and quantiles of events per recent session.

    Sessions are first counted per length, so the exact percentile works on a short list of lengths.
    """
    recent = events.filter(F.col("event_time") >= _ago(as_of, hours, "HOUR"))
    sized = recent.groupBy("session_id").agg(F.count("*").alias("n"))
    lengths = sized.groupBy("n").agg(F.count("*").alias("weight"))
    quantiles = [F.percentile("n", F.lit(p), F.col("weight")).alias(f"p{int(p * 100)}") for p in (0.5, 0.9, 0.99)]
    mean = F.try_divide(F.sum(F.col("n") * F.col("weight")), F.sum("weight"))
    return lengths.agg(F.round(mean, 1).alias("avg"), *quantiles)


def weekday_hour(events: DataFrame, as_of: datetime | Column, days: int = 7) -> DataFrame:
    """Session starts by weekday (rows) and hour (columns 00 to 23)."""
    started = events.filter(
        (F.col("event_type") == "SESSION_START") & (F.col("event_time") >= _ago(as_of, days, "DAY"))
    )
    hour = F.hour("event_time")
    counts = started.groupBy(monday_first(F.col("event_time")).alias("weekday")).agg(
        *[F.count_if(hour == h).alias(f"{h:02d}") for h in range(24)]
    )
    names = F.array(*[F.lit(name) for name in WEEKDAYS])
    hours = [f"{h:02d}" for h in range(24)]
    return counts.orderBy("weekday").select(F.element_at(names, F.col("weekday")).alias("day"), *hours)


def session_duration(events: DataFrame) -> DataFrame:
    spans = (
        events.filter(F.col("event_time").isNotNull())
        .groupBy("session_id")
        .agg(seconds_between(F.min("event_time"), F.max("event_time")).alias("dur"))
    )
    return bucketed(spans, "dur", labelled(F.col("dur"), DURATION_LABELS, "> 1 час", closed=False), "sessions")


def behaviour(events: DataFrame) -> DataFrame:
    def seen(kind: str) -> Column:
        return F.max(F.col("event_type") == kind)

    marks = events.groupBy("session_id").agg(
        seen("QS").alias("qs"), seen("CARD_SEARCH").alias("card"), seen("DOC_OPEN").alias("opened")
    )
    pattern = (
        F.when(F.col("qs") & F.col("card"), BEHAVIOURS["both"])
        .when(F.col("qs"), BEHAVIOURS["qs"])
        .when(F.col("card"), BEHAVIOURS["card"])
        .when(F.col("opened"), BEHAVIOURS["opens"])
        .otherwise(BEHAVIOURS["none"])
    )
    return marks.groupBy(pattern.alias("pattern")).agg(F.count("*").alias("sessions")).orderBy(F.desc("sessions"), "pattern")


def opens_per_session(events: DataFrame) -> DataFrame:
    opened = events.groupBy("session_id").agg(F.count_if(F.col("event_type") == "DOC_OPEN").alias("opens"))
    return bucketed(opened, "opens", labelled(F.col("opens"), OPENS_LABELS, "10+"), "sessions")


def sessions_per_minute(events: DataFrame, as_of: datetime | Column, hours: int = 3) -> DataFrame:
    """New sessions per minute of ingestion."""
    fresh = events.filter(
        (F.col("event_type") == "SESSION_START") & (F.col("ingested_at") >= _ago(as_of, hours, "HOUR"))
    )
    return (
        fresh.groupBy(F.date_trunc("minute", "ingested_at").alias("t")).agg(F.count("*").alias("new_sessions")).orderBy("t")
    )


def files_total(ledger: DataFrame) -> DataFrame:
    return ledger.agg(F.count("*").alias("files"))


def files_recent(ledger: DataFrame, as_of: datetime | Column, hours: int = 1) -> DataFrame:
    return ledger.filter(F.col("processed_at") >= _ago(as_of, hours, "HOUR")).agg(F.count("*").alias("files"))


def freshness(ledger: DataFrame, as_of: datetime | Column) -> DataFrame:
    """Seconds since the last ingested file."""
    return ledger.agg(seconds_between(F.max("processed_at"), _moment(as_of)).alias("seconds_since"))
