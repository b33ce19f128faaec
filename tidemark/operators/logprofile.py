"""Profile of raw log lines: session sizes, kinds, gaps, documents and queries.

The profile reads lines by their prefix only, so it also describes logs that do not parse.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.functions.times import epoch_us, parse_local
from tidemark.operators.scan import Carry, by_line, running


def _profile_kind() -> Column:
    return (
        F.when(F.col("line").startswith("QS "), "QS")
        .when(F.col("line").startswith("CARD_SEARCH_START"), "CARD")
        .when(F.col("line").startswith("DOC_OPEN"), "DOC_OPEN")
    )


def profile_sizes(lines: DataFrame) -> DataFrame:
    """Counted lines per session, zero included."""
    return lines.groupBy("session_id").agg(F.count(_profile_kind()).alias("events"))


def profile_kinds(lines: DataFrame) -> DataFrame:
    """Count and share of each kind; the total is the sum of three rows."""
    kinds = lines.select(_profile_kind().alias("kind")).filter(F.col("kind").isNotNull())
    counts = kinds.groupBy("kind").agg(F.count("*").alias("n"))
    total = counts.agg(F.sum("n")).scalar()
    return counts.withColumn("share", F.col("n") / total)


def profile_gaps(lines: DataFrame, limit_s: int = 3600, bucket_lines: int | None = 1 << 20) -> DataFrame:
    """Seconds between neighbouring timed lines of a session, at least 0; long pauses are left out."""
    timed = (
        lines.select("session_id", "line_no", F.get(F.split("line", r"\s+"), F.lit(1)).alias("token"))
        .select("session_id", "line_no", epoch_us(parse_local(F.col("token"))).alias("ts_us"))
        .filter(F.col("ts_us").isNotNull())
    )
    previous = Carry("previous", "max", F.struct("line_no", "ts_us"), "before")
    gaps = running(timed, ["session_id"], ["line_no"], [previous], by_line(F.col("line_no"), bucket_lines))
    seconds = F.greatest(((F.col("ts_us") - F.col("previous.ts_us")) / 1_000_000).cast("bigint"), F.lit(0))
    paired = gaps.filter(F.col("previous").isNotNull())
    return paired.select("session_id", "line_no", seconds.alias("gap_s")).filter(F.col("gap_s") < limit_s)


def profile_docs(lines: DataFrame, top: int | None = None) -> DataFrame:
    """Document ids in open lines and result lines with their counts; all of them, or the ``top`` most frequent."""
    words = F.split("line", r"\s+")
    listed = F.filter(F.slice(words, 2, F.size(words)), lambda w: w.contains("_"))
    named = F.when(F.col("line").startswith("DOC_OPEN"), F.array(F.element_at(words, -1))).when(
        F.col("line").rlike("^[0-9-]"), listed
    )
    docs = lines.select(F.explode(named).alias("doc_id"))
    counts = docs.groupBy("doc_id").agg(F.count("*").alias("n"))
    return counts if top is None else counts.orderBy(F.desc("n"), "doc_id").limit(top)


def profile_queries(lines: DataFrame, first: int | None = None) -> DataFrame:
    """All query texts, or the ``first`` of them in (session, line) order."""
    query = F.regexp_extract("line", r"\{(.*)\}", 1)
    asked = lines.filter(F.col("line").startswith("QS ") & F.col("line").rlike(r"\{.*\}"))
    queries = asked.select("session_id", "line_no", query.alias("query"))
    return queries if first is None else queries.orderBy("session_id", "line_no").limit(first)
