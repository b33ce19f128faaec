"""Sketch queries: the exact answer, and whether the sketch kept its promise beside it."""

from __future__ import annotations

from pyspark.sql import functions as F

from tidemark.catalog.logs import AS_OF, HOT_DAYS, PARSED, TS, events, ledger
from tidemark.catalog.registry import query, table
from tidemark.lineage import new_folder, written
from tidemark.operators import sketches as S
from tidemark.operators.medallion import hot_since
from tidemark.plans.ingest import new_files
from tidemark.plans.refresh import refresh_mart
from tidemark.sources.tables import write_by


def known_orders(spark, sf_dir):
    """Every third order, its key as another integer width than the lines', and its sketch."""
    known = table(spark, sf_dir, "orders").filter("o_orderkey % 3 = 0").select(F.col("o_orderkey").cast("int").alias("l_orderkey"))
    blocks = S.blocks_for(known.count())
    return known, written(S.membership(known, ["l_orderkey"], blocks), "known-orders"), blocks


# No key that is there is missed, and at most one absent key in fifty passes.
@query(
    "membership_probe",
    """
SELECT l_returnflag, count(*) AS rows, count(o_orderkey) AS present, CAST(0 AS BIGINT) AS missed, true AS few_passed
FROM lineitem LEFT JOIN (SELECT DISTINCT o_orderkey FROM orders WHERE o_orderkey % 3 = 0) ON o_orderkey = l_orderkey
GROUP BY l_returnflag""",
)
def membership_probe(spark, sf_dir):
    known, sketch, blocks = known_orders(spark, sf_dir)
    lines = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_returnflag")
    told = S.membership_report(lines, known, sketch, ["l_orderkey"], blocks, ["l_returnflag"])
    return told.select("l_returnflag", "rows", "present", "missed", (F.col("passed_share") <= 0.02).alias("few_passed"))


@query(
    "anti_by_sketch",
    "SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey FROM lineitem "
    "WHERE l_orderkey NOT IN (SELECT o_orderkey FROM orders WHERE o_orderkey % 3 = 0)",
)
def anti_by_sketch(spark, sf_dir):
    known, sketch, blocks = known_orders(spark, sf_dir)
    lines = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey")
    return S.keys_absent_by_sketch(lines, known, sketch, ["l_orderkey"], blocks)


# The sketch is the merger of one sketch for each of three earlier runs.
@query("incremental_ingest_sketched", PARSED + "SELECT path FROM ledger WHERE events_count % 3 <> 0")
def incremental_ingest_sketched(spark, sf_dir):
    files = written(ledger(spark, sf_dir).select("path", "events_count"), "files")
    known = files.filter(F.col("events_count") % 3 == 0)
    runs = [known.filter(F.pmod(F.xxhash64("path"), F.lit(3)) == run) for run in range(3)]
    sketch = S.merged_membership(*[S.membership(run, ["path"], 512) for run in runs])
    return new_files(files, known, sketch=sketch, blocks=512)


def sketch_mart(spark, sf_dir):
    """The daily sketches as the recurring job stores them: a hot and a cold run over events that are stored twice."""
    source, mart = new_folder(spark, "sketch-events"), new_folder(spark, "sketch-mart")
    for _ in range(2):
        write_by(events(spark, sf_dir).withColumn("ingested_at", F.col("event_time")), source, "event_date", mode="append")
    for mode in ("hot", "cold"):
        refresh_mart(spark, source, mart, "sketches", AS_OF, mode, HOT_DAYS)
    return spark.read.parquet(mart)


def _near(estimate, exact, share):
    return F.abs(estimate - exact) <= F.greatest(F.lit(1.0), share * exact)


WEEK = "date_trunc('week', event_date)"
DATED = "FROM bronze WHERE event_date IS NOT NULL"


@query(
    "sketch_distinct_weekly",
    PARSED + f"""
SELECT {TS.format(WEEK)} AS week, count(DISTINCT session_id) AS sessions,
       count(DISTINCT CASE WHEN event_type = 'DOC_OPEN' THEN doc_id END) AS docs, true AS near {DATED} GROUP BY 1""",
)
def sketch_distinct_weekly(spark, sf_dir):
    week = F.date_trunc("week", "event_date").alias("week")
    mart = sketch_mart(spark, sf_dir).select(week, "sessions", "docs")
    told = S.merged(mart, ["week"], distinct=["sessions", "docs"])
    told = told.select("week", *[S.distinct_estimate(c).alias(f"told_{c}") for c in ("sessions", "docs")])
    opened = F.when(F.col("event_type") == "DOC_OPEN", F.col("doc_id"))
    exact = events(spark, sf_dir).filter("event_date IS NOT NULL").groupBy(week).agg(
        F.countDistinct("session_id").alias("sessions"), F.countDistinct(opened).alias("docs")
    )
    error = S.distinct_error()
    near = _near(F.col("told_sessions"), F.col("sessions"), error) & _near(F.col("told_docs"), F.col("docs"), error)
    return exact.join(told, "week").select("week", "sessions", "docs", near.alias("near"))


@query(
    "sketch_hot_and_cold",
    PARSED + f"""
SELECT count(DISTINCT session_id) AS sessions, true AS sessions_equal, true AS docs_equal, true AS sessions_near,
       CAST(count(DISTINCT (session_id, event_date)) AS BIGINT) AS sizes {DATED}""",
)
def sketch_hot_and_cold(spark, sf_dir):
    """Hot and cold days merged apart and then together against the sketch of all sessions and documents at once."""
    stored, edge = sketch_mart(spark, sf_dir), hot_since(AS_OF.date(), HOT_DAYS)
    parts = None
    for days in (F.col("event_date") < edge, F.col("event_date") >= edge):
        part = S.merged(stored.filter(days), distinct=["sessions", "docs"], quantiles=["sizes"])
        parts = part if parts is None else parts.unionByName(part)
    told = S.merged(parts, distinct=["sessions", "docs"], quantiles=["sizes"]).select(
        S.distinct_estimate("sessions").alias("a"), S.distinct_estimate("docs").alias("b"), F.kll_sketch_get_n_double("sizes").alias("sizes")
    )
    dated = events(spark, sf_dir).filter("event_date IS NOT NULL")
    opened = dated.withColumn("doc_id", F.when(F.col("event_type") == "DOC_OPEN", F.col("doc_id")))
    whole = S.sketched(opened, [], distinct={"x": "session_id", "y": "doc_id"}).select(S.distinct_estimate("x").alias("x"), S.distinct_estimate("y").alias("y"))
    exact = dated.agg(F.countDistinct("session_id").alias("sessions"))
    rows = told.unionByName(whole, allowMissingColumns=True).unionByName(exact, allowMissingColumns=True)
    one = rows.agg(*[F.max(c).alias(c) for c in rows.columns])  # each of the three is one row with columns of its own
    near = _near(F.col("a"), F.col("sessions"), S.distinct_error())
    equal = [_near(F.col(p), F.col(q), 0.01).alias(n) for p, q, n in (("a", "x", "sessions_equal"), ("b", "y", "docs_equal"))]
    return one.select("sessions", *equal, near.alias("sessions_near"), "sizes")


QUANTILES = (0.5, 0.9, 0.99)


@query(
    "sketch_quantiles_weekly",
    PARSED + f""", sizes AS (
  SELECT event_date, session_id, count(*) AS n {DATED} GROUP BY ALL)
SELECT {TS.format(WEEK)} AS week, 0.5::DOUBLE AS q, count(*) AS sizes, quantile_cont(n, 0.5) AS exact, true AS near FROM sizes GROUP BY 1
UNION ALL SELECT {TS.format(WEEK)}, 0.9, count(*), quantile_cont(n, 0.9), true FROM sizes GROUP BY 1
UNION ALL SELECT {TS.format(WEEK)}, 0.99, count(*), quantile_cont(n, 0.99), true FROM sizes GROUP BY 1""",
)
def sketch_quantiles_weekly(spark, sf_dir):
    """The rank of the estimate, ties counted as a span, must be within the sketch's error of the asked one."""
    week = F.date_trunc("week", "event_date").alias("week")
    told = S.merged(sketch_mart(spark, sf_dir).select(week, "sizes"), ["week"], quantiles=["sizes"])
    asked = F.array(*[F.struct(F.lit(q).alias("q"), S.quantile_estimate("sizes", q).alias("told")) for q in QUANTILES])
    told = told.select("week", F.inline(asked))
    sizes = events(spark, sf_dir).filter("event_date IS NOT NULL").groupBy("event_date", "session_id").agg(F.count("*").alias("n"))
    sizes = sizes.select(week, "n").groupBy("week", "n").agg(F.count("*").alias("times"))
    ranked = sizes.join(told, "week").groupBy("week", "q", "told").agg(
        F.sum("times").alias("sizes"),
        F.sum(F.when(F.col("n") < F.col("told"), F.col("times")).otherwise(0)).alias("below"),
        F.sum(F.when(F.col("n") <= F.col("told"), F.col("times")).otherwise(0)).alias("upto"),
        *[F.expr(f"percentile(n, {q}, times)").alias(f"p{i}") for i, q in enumerate(QUANTILES)],
    )
    error = S.quantile_error()
    near = (F.col("below") / F.col("sizes") <= F.col("q") + error) & (F.col("upto") / F.col("sizes") >= F.col("q") - error)
    exact = F.coalesce(*[F.when(F.col("q") == q, F.col(f"p{i}")) for i, q in enumerate(QUANTILES)])
    return ranked.select("week", "q", "sizes", exact.alias("exact"), near.alias("near"))


COUNTERS = 2048


# Many more words than counters. Every word above twice the error bound is found, with a count that is off by at most the bound.
@query(
    "sketch_frequent_words",
    f"""
WITH words AS (SELECT unnest(string_split(text, ' ')) AS word FROM documents WHERE text IS NOT NULL),
counted AS (SELECT word, count(*) AS cnt FROM words WHERE word <> '' GROUP BY word)
SELECT word, cnt, true AS found, true AS near FROM counted WHERE cnt >= {2 * S.frequent_error(COUNTERS)!r} * (SELECT sum(cnt) FROM counted)""",
)
def sketch_frequent_words(spark, sf_dir):
    docs = table(spark, sf_dir, "documents")
    words = docs.select("lang", "source", F.explode(F.split("text", " ")).alias("word")).filter("word <> ''")
    mart = written(S.sketched(words, ["lang", "source"], frequent={"words": "word"}, counters=COUNTERS), "word-sketches")
    whole = S.merged(mart, frequent=["words"], counters=COUNTERS)
    told = S.frequent_estimate(whole, "words", COUNTERS // 2).select(F.col("value").alias("word"), F.col("cnt").alias("told"))
    exact = written(words.groupBy("word").agg(F.count("*").alias("cnt")), "word-counts")
    bound = S.frequent_error(COUNTERS) * exact.agg(F.sum("cnt")).scalar()
    often = exact.filter(F.col("cnt") >= 2 * bound).join(told, "word", "left")
    near = F.coalesce(F.abs(F.col("told") - F.col("cnt")) <= bound, F.lit(False))
    return often.select("word", "cnt", F.col("told").isNotNull().alias("found"), near.alias("near"))
