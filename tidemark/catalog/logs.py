"""Session-log queries: lines, parsing, daily marts and dashboard."""

from __future__ import annotations

from datetime import date, datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.bridges import session_chunks
from tidemark.catalog.registry import built_once, query, table
from tidemark.functions.times import parse_time
from tidemark.lineage import new_folder
from tidemark.operators import logprofile, medallion
from tidemark.operators.loglines import classify, to_lines
from tidemark.operators.sessionlog import parse_sessions, with_json_columns
from tidemark.plans import dashboard
from tidemark.plans.ingest import new_files
from tidemark.plans.refresh import refresh_mart
from tidemark.schemas import EVENT_TABLE
from tidemark.sources.tables import write_by

AS_OF = datetime(2024, 1, 31)
HOT_DAYS = 10
DOC = "ACC_3"

# Expected event rows, computed from the events table without looking at any log text.
EV = """
ev AS (
  SELECT event_id, date_trunc('second', ts) AS t, event_type,
         CAST(json_extract(props, '$.k') AS INT) AS k,
         'u' || user_id || '_' || strftime(date_trunc('week', ts), '%Y%m%d') AS session_id
  FROM events)"""

PARSED = f"""
WITH {EV},
marked AS (
  SELECT *, CAST(k % 7 AS VARCHAR) AS small,
         event_type = 'signup' AND event_id % 11 = 0 AS dropped,
         coalesce(last_value(CASE WHEN event_type IN ('signup', 'error')
                             THEN event_type = 'signup' AND event_id % 11 = 0 END IGNORE NULLS)
                  OVER (PARTITION BY session_id ORDER BY event_id), false) AS pending
  FROM ev),
emitted AS (
  SELECT session_id, min(event_id) * 8 - 1 AS ord, min(t) AS t, 'SESSION_START' AS event_type,
         NULL AS search_id, NULL AS kind, NULL AS query_text, '[]' AS params, '[]' AS docs,
         NULL AS doc_id, NULL AS parse_error, NULL AS raw_line
  FROM ev GROUP BY session_id
  UNION ALL
  SELECT session_id, max(event_id) * 8 + 7, max(t), 'SESSION_END', NULL, NULL, NULL, '[]', '[]', NULL, NULL, NULL
  FROM ev GROUP BY session_id
  UNION ALL
  SELECT session_id, event_id * 8, t, 'QS', small, 'QS', 'q' || (k % 20), '[]',
         '["LAW_' || k || '","LAW_' || ((k + 1) % 100) || '"]', NULL, NULL, NULL
  FROM marked WHERE event_type = 'signup' AND NOT dropped
  UNION ALL
  SELECT session_id, event_id * 8, t, 'CARD_SEARCH', CASE WHEN k % 2 = 0 THEN small ELSE '-' || small END, 'CARD',
         NULL, '[{{"param_id":"' || k || '","value":"v' || k || '"}},{{"param_id":"' || (k + 1) || '","value":"w  x"}}]',
         '["ACC_' || (k % 10) || '","ACC_' || (k % 10) || '"]', NULL, NULL, NULL
  FROM marked WHERE event_type = 'error'
  UNION ALL
  SELECT session_id, event_id * 8, t, 'DOC_OPEN', CASE WHEN k % 3 = 0 THEN '-' || small ELSE small END, NULL,
         NULL, '[]', '[]', 'LAW_' || k, NULL, NULL
  FROM marked WHERE event_type = 'view'
  UNION ALL
  SELECT session_id, event_id * 8, NULL, 'DOC_OPEN', small, NULL, NULL, '[]', '[]', 'LAW_' || k, NULL, NULL
  FROM marked WHERE event_type = 'click'
  UNION ALL
  SELECT session_id, event_id * 8, NULL, 'MALFORMED', NULL, NULL, NULL, '[]', '[]', NULL,
         CASE k % 4
           WHEN 0 THEN 'unexpected ''CardSearchEnd$'' in state ' || state
           WHEN 1 THEN 'unparseable timestamp: 99.99.2024_10:00:00'
           WHEN 2 THEN 'unrecognized prefix'
           ELSE 'unexpected ''CardParamLine'' in state ' || state END,
         CASE k % 4 WHEN 0 THEN 'CARD_SEARCH_END' WHEN 1 THEN 'QS 99.99.2024_10:00:00 {{x}}'
                    WHEN 2 THEN 'junk ' || k ELSE '$' || k || ' stray' END
  FROM (SELECT *, CASE WHEN pending THEN 'AwaitingQsResults' ELSE 'Neutral$' END AS state FROM marked)
  WHERE event_type = 'purchase'),
parsed AS (
  SELECT session_id,
         CAST(row_number() OVER (PARTITION BY session_id ORDER BY ord) - 1 AS INT) AS event_seq,
         CASE WHEN event_type = 'DOC_OPEN'
              THEN last_value(t IGNORE NULLS) OVER (PARTITION BY session_id ORDER BY ord) ELSE t END AS event_time,
         event_type, search_id,
         CASE WHEN event_type = 'DOC_OPEN'
              THEN last_value(kind IGNORE NULLS) OVER (PARTITION BY session_id, search_id ORDER BY ord)
              ELSE kind END AS search_kind,
         query_text, params, docs, doc_id, parse_error, raw_line
  FROM emitted),
bronze AS (SELECT *, CAST(event_time AS DATE) AS event_date FROM parsed),
hits AS (
  SELECT event_date AS date, d.doc_id, count(*) AS hits
  FROM bronze b, unnest(from_json(b.docs, '["VARCHAR"]')) AS d(doc_id)
  WHERE event_type = 'CARD_SEARCH' AND event_date IS NOT NULL GROUP BY 1, 2),
opens AS (
  SELECT event_date AS open_date, doc_id, count(*) AS opens FROM bronze
  WHERE event_type = 'DOC_OPEN' AND search_kind = 'QS' AND doc_id IS NOT NULL AND event_date IS NOT NULL
  GROUP BY 1, 2),
ledger AS (
  SELECT 'sessions/' || session_id AS path, max(event_time) AS processed_at, count(*) AS events_count
  FROM bronze GROUP BY session_id)
"""

TS = "strftime({0}, '%Y-%m-%d %H:%M:%S')"
DAY = "strftime({0}, '%Y-%m-%d')"
STAMP = TS.format("event_time") + " AS event_time"


def chunks(spark: SparkSession, sf_dir: str) -> DataFrame:
    return session_chunks(table(spark, sf_dir, "events"))


def events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The parsed event table, partitioned by day and written once; marts and panels read it as stored."""

    def write(path: str) -> None:
        write_by(parse_sessions(chunks(spark, sf_dir)), path, "event_date", sort=("session_id", "event_seq"))

    path = built_once(spark, sf_dir, "events", "events", write)
    return spark.read.schema(EVENT_TABLE).parquet(path)


def card_hits(spark: SparkSession, sf_dir: str) -> DataFrame:
    return medallion.card_hits_daily(events(spark, sf_dir))


def qs_opens(spark: SparkSession, sf_dir: str) -> DataFrame:
    return medallion.qs_opens_daily(events(spark, sf_dir))


def ledger(spark: SparkSession, sf_dir: str) -> DataFrame:
    return (
        events(spark, sf_dir)
        .groupBy(F.concat(F.lit("sessions/"), F.col("session_id")).alias("path"))
        .agg(F.max("event_time").alias("processed_at"), F.count("*").alias("events_count"))
    )


# ---------------------------------------------------------------- lines


@query(
    "log_lines",
    """
SELECT CAST(doc_id AS VARCHAR) AS session_id, line_no, line FROM (
  SELECT doc_id, CAST(i - 1 AS BIGINT) AS line_no,
         regexp_replace(string_split_regex(text, '[\\n\\f]')[i], '^[\\x00-\\x20]+|[\\x00-\\x20]+$', '', 'g') AS line
  FROM documents, unnest(range(1, len(string_split_regex(text, '[\\n\\f]')) + 1)) AS u(i))
WHERE line <> ''""",
)
def log_lines(spark, sf_dir):
    documents = table(spark, sf_dir, "documents")
    return to_lines(documents.select(F.col("doc_id").cast("string").alias("session_id"), F.col("text").alias("content")))


LINE_KINDS = f"""
WITH {EV},
per AS (
  SELECT session_id, 'SESSION_START' AS kind FROM ev GROUP BY session_id
  UNION ALL SELECT session_id, 'SESSION_END' FROM ev GROUP BY session_id
  UNION ALL SELECT session_id, 'QS' FROM ev WHERE event_type = 'signup'
  UNION ALL SELECT session_id, 'RESULTS' FROM ev WHERE event_type = 'signup' AND event_id % 11 <> 0
  UNION ALL SELECT session_id, unnest(['CARD_START', 'PARAM', 'PARAM', 'CARD_END', 'RESULTS']) FROM ev
            WHERE event_type = 'error'
  UNION ALL SELECT session_id, 'OPEN' FROM ev WHERE event_type = 'view'
  UNION ALL SELECT session_id, 'OPEN_UNTIMED' FROM ev WHERE event_type = 'click'
  UNION ALL SELECT session_id, CASE k % 4 WHEN 0 THEN 'CARD_END' WHEN 1 THEN 'BAD_TIME' WHEN 2 THEN 'UNKNOWN'
            ELSE 'PARAM' END FROM ev WHERE event_type = 'purchase')
SELECT session_id, kind, count(*) AS n FROM per GROUP BY ALL"""


@query("log_line_kinds", LINE_KINDS)
def log_line_kinds(spark, sf_dir):
    return classify(to_lines(chunks(spark, sf_dir))).groupBy("session_id", "kind").agg(F.count("*").alias("n"))


@query(
    "log_timestamps",
    f"""
WITH {EV}
SELECT session_id, event_id * 8 AS line_no, {TS.format('t')} AS time FROM ev
WHERE event_type IN ('signup', 'error', 'view')
UNION ALL SELECT session_id, min(event_id) * 8 - 1, {TS.format('min(t)')} FROM ev GROUP BY session_id
UNION ALL SELECT session_id, max(event_id) * 8 + 7, {TS.format('max(t)')} FROM ev GROUP BY session_id""",
)
def log_timestamps(spark, sf_dir):
    lines = to_lines(chunks(spark, sf_dir))
    token = F.get(F.split("line", r"\s+"), F.lit(1))
    return (
        lines.filter(F.col("line").rlike("^[A-Z]"))
        .select("session_id", "line_no", F.explode(F.array(token)).alias("token"))
        .select("session_id", "line_no", parse_time(F.col("token")).alias("time"))
        .filter(F.col("time").isNotNull())
    )


# ---------------------------------------------------------------- parsing


@query(
    "parse_sessions",
    PARSED + f"SELECT session_id, event_seq, {STAMP}, {DAY.format('event_date')} AS event_date, event_type, "
    "search_id, search_kind, query_text, doc_id FROM bronze",
)
def parse_all(spark, sf_dir):
    parsed = parse_sessions(chunks(spark, sf_dir))
    return parsed.drop("card_params", "result_doc_ids", "parse_error", "raw_line")


@query(
    "open_search_kind",
    PARSED + "SELECT session_id, event_seq, search_id, search_kind FROM bronze WHERE event_type = 'DOC_OPEN'",
)
def open_search_kind(spark, sf_dir):
    opens = events(spark, sf_dir).filter(F.col("event_type") == "DOC_OPEN")
    return opens.select("session_id", "event_seq", "search_id", "search_kind")


@query(
    "open_inherited_time",
    PARSED + f"SELECT session_id, event_seq, {STAMP} FROM bronze WHERE event_type = 'DOC_OPEN'",
)
def open_inherited_time(spark, sf_dir):
    opens = events(spark, sf_dir).filter(F.col("event_type") == "DOC_OPEN")
    return opens.select("session_id", "event_seq", "event_time")


@query(
    "log_malformed",
    PARSED + "SELECT session_id, event_seq, parse_error, raw_line FROM bronze WHERE event_type = 'MALFORMED'",
)
def log_malformed(spark, sf_dir):
    broken = events(spark, sf_dir).filter(F.col("event_type") == "MALFORMED")
    return broken.select("session_id", "event_seq", "parse_error", "raw_line")


@query(
    "bronze_json_cols",
    PARSED + "SELECT session_id, event_seq, params AS card_params_json, docs AS result_doc_ids_json FROM bronze",
)
def bronze_json_cols(spark, sf_dir):
    rendered = with_json_columns(events(spark, sf_dir))
    return rendered.select("session_id", "event_seq", "card_params_json", "result_doc_ids_json")


@query(
    "incremental_ingest",
    PARSED + "SELECT path FROM ledger WHERE events_count % 3 <> 0",
)
def incremental_ingest(spark, sf_dir):
    files = ledger(spark, sf_dir)
    known = files.filter(F.col("events_count") % 3 == 0)
    return new_files(files.select("path"), known)


# ---------------------------------------------------------------- profile

PROFILE_LINES = f"""
WITH {EV},
prof AS (
  SELECT session_id, event_id,
         CASE event_type WHEN 'signup' THEN 'QS' WHEN 'error' THEN 'CARD' WHEN 'view' THEN 'DOC_OPEN'
              WHEN 'click' THEN 'DOC_OPEN' WHEN 'purchase' THEN CASE WHEN k % 4 = 1 THEN 'QS' END END AS kind
  FROM ev)"""


@query("log_profile_sizes", PROFILE_LINES + "SELECT session_id, count(kind) AS events FROM prof GROUP BY session_id")
def log_profile_sizes(spark, sf_dir):
    return logprofile.profile_sizes(to_lines(chunks(spark, sf_dir)))


@query(
    "log_profile_kinds",
    PROFILE_LINES + """
SELECT kind, count(*) AS n, round(count(*) / sum(count(*)) OVER (), 9) AS share
FROM prof WHERE kind IS NOT NULL GROUP BY kind""",
)
def log_profile_kinds(spark, sf_dir):
    kinds = logprofile.profile_kinds(to_lines(chunks(spark, sf_dir)))
    return kinds.withColumn("share", F.round("share", 9))


# Only the plain time form counts here, so events written in the zoned form are skipped.
@query(
    "log_profile_gaps",
    f"""
WITH {EV},
timed AS (
  SELECT session_id, event_id * 8 AS line_no, t FROM ev
  WHERE event_type IN ('signup', 'error', 'view') AND event_id % 7 <> 0
  UNION ALL SELECT session_id, min(event_id) * 8 - 1, min(t) FROM ev GROUP BY session_id
  UNION ALL SELECT session_id, max(event_id) * 8 + 7, max(t) FROM ev GROUP BY session_id),
gaps AS (
  SELECT session_id, line_no,
         greatest(date_diff('second', lag(t) OVER (PARTITION BY session_id ORDER BY line_no), t), 0) AS gap_s,
         lag(t) OVER (PARTITION BY session_id ORDER BY line_no) AS prev
  FROM timed)
SELECT session_id, line_no, CAST(gap_s AS BIGINT) AS gap_s FROM gaps WHERE prev IS NOT NULL AND gap_s < 3600""",
)
def log_profile_gaps(spark, sf_dir):
    return logprofile.profile_gaps(to_lines(chunks(spark, sf_dir)))


@query(
    "log_profile_docs",
    f"""
WITH {EV},
docs AS (
  SELECT 'LAW_' || k AS doc_id FROM ev WHERE event_type IN ('view', 'click')
  UNION ALL SELECT unnest(['LAW_' || k, 'LAW_' || ((k + 1) % 100)]) FROM ev
            WHERE event_type = 'signup' AND event_id % 11 <> 0
  UNION ALL SELECT unnest(['ACC_' || (k % 10), 'ACC_' || (k % 10)]) FROM ev WHERE event_type = 'error')
SELECT doc_id, count(*) AS n FROM docs GROUP BY doc_id""",
)
def log_profile_docs(spark, sf_dir):
    return logprofile.profile_docs(to_lines(chunks(spark, sf_dir)))


@query(
    "log_profile_queries",
    f"""
WITH {EV}
SELECT session_id, event_id * 8 AS line_no,
       CASE WHEN event_type = 'signup' THEN 'q' || (k % 20) ELSE 'x' END AS query
FROM ev WHERE event_type = 'signup' OR (event_type = 'purchase' AND k % 4 = 1)""",
)
def log_profile_queries(spark, sf_dir):
    return logprofile.profile_queries(to_lines(chunks(spark, sf_dir)))


# ---------------------------------------------------------------- daily marts

HOT_SQL = f"DATE '{AS_OF:%Y-%m-%d}' - {HOT_DAYS}"
HITS_ROW = f"SELECT {DAY.format('date')} AS date, doc_id, hits FROM hits"
OPENS_ROW = f"SELECT {DAY.format('open_date')} AS open_date, doc_id, opens FROM opens"


@query("gold_card_hits", PARSED + HITS_ROW)
def gold_card_hits(spark, sf_dir):
    return card_hits(spark, sf_dir)


@query("gold_qs_opens", PARSED + OPENS_ROW)
def gold_qs_opens(spark, sf_dir):
    return qs_opens(spark, sf_dir).orderBy("open_date", F.desc("opens"), "doc_id")


@query("gold_hot", PARSED + HITS_ROW + f" WHERE date >= {HOT_SQL}")
def gold_hot(spark, sf_dir):
    return medallion.card_hits_daily(events(spark, sf_dir), since=medallion.hot_since(AS_OF.date(), HOT_DAYS))


@query("gold_cold", PARSED + HITS_ROW + f" WHERE date < {HOT_SQL}")
def gold_cold(spark, sf_dir):
    return medallion.card_hits_daily(events(spark, sf_dir), until=medallion.hot_since(AS_OF.date(), HOT_DAYS))


@query("gold_opens_hot", PARSED + OPENS_ROW + f" WHERE open_date >= {HOT_SQL}")
def gold_opens_hot(spark, sf_dir):
    return medallion.qs_opens_daily(events(spark, sf_dir), since=medallion.hot_since(AS_OF.date(), HOT_DAYS))


@query("gold_opens_cold", PARSED + OPENS_ROW + f" WHERE open_date < {HOT_SQL}")
def gold_opens_cold(spark, sf_dir):
    return medallion.qs_opens_daily(events(spark, sf_dir), until=medallion.hot_since(AS_OF.date(), HOT_DAYS))


@query("mart_refresh", PARSED + f"SELECT {DAY.format('date')} AS date, doc_id, hits FROM hits")
def mart_refresh(spark, sf_dir):
    """The hot and the cold run of the recurring job, over events that are stored twice."""
    source, mart = new_folder(spark, "mart-events"), new_folder(spark, "mart-hits")
    for _ in range(2):
        write_by(events(spark, sf_dir).withColumn("ingested_at", F.col("event_time")), source, "event_date", mode="append")
    for mode in ("hot", "cold"):
        refresh_mart(spark, source, mart, "card_hits", AS_OF, mode, HOT_DAYS)
    return spark.read.parquet(mart).select("date", "doc_id", "hits")


@query("gold_full_from_hot_and_cold", PARSED + OPENS_ROW)
def gold_full_from_hot_and_cold(spark, sf_dir):
    cut = medallion.hot_since(AS_OF.date(), HOT_DAYS)
    table_ = events(spark, sf_dir)
    return medallion.qs_opens_daily(table_, until=cut).unionByName(medallion.qs_opens_daily(table_, since=cut))


@query(
    "latest_by_key",
    f"""
WITH {EV}
SELECT session_id, arg_max(event_type, event_id) AS event_type, {TS.format('arg_max(t, event_id)')} AS t,
       max(event_id) AS event_id
FROM ev GROUP BY session_id""",
)
def latest_by_key(spark, sf_dir):
    from tidemark.bridges import session_id

    versions = table(spark, sf_dir, "events").select(
        session_id().alias("session_id"), "event_type", F.date_trunc("second", "ts").alias("t"), "event_id"
    )
    return medallion.latest_by_key(versions, ["session_id"], "event_id")


@query(
    "upsert_daily",
    PARSED + f"""
SELECT {DAY.format('open_date')} AS open_date, doc_id,
       CASE WHEN open_date >= {HOT_SQL} THEN opens * 10 ELSE opens END AS opens
FROM opens WHERE open_date >= {HOT_SQL} OR opens > 1""",
)
def upsert_daily(spark, sf_dir):
    mart = qs_opens(spark, sf_dir)
    target = mart.filter(F.col("opens") > 1)
    hot = medallion.qs_opens_daily(events(spark, sf_dir), since=medallion.hot_since(AS_OF.date(), HOT_DAYS))
    return medallion.upsert(target, hot.withColumn("opens", F.col("opens") * 10), ["open_date", "doc_id"])


@query("dedup_events", PARSED + f"SELECT session_id, event_seq, event_type, {STAMP} FROM bronze")
def dedup_events(spark, sf_dir):
    replayed = events(spark, sf_dir).unionByName(events(spark, sf_dir).filter(F.col("event_seq") < 5))
    return medallion.dedup_events(replayed).select("session_id", "event_seq", "event_type", "event_time")


@query(
    "adaptive_cutoff",
    PARSED + f"SELECT {DAY.format('least(DATE ' + chr(39) + format(AS_OF, '%Y-%m-%d') + chr(39) + ' - 3, max(open_date))')} AS cutoff FROM opens",
)
def adaptive_cutoff(spark, sf_dir):
    return medallion.adaptive_cutoff(qs_opens(spark, sf_dir), "open_date", AS_OF.date(), days=3)


# ---------------------------------------------------------------- dashboard

NOW = f"TIMESTAMP '{AS_OF:%Y-%m-%d %H:%M:%S}'"


@query("metric_doc_hits", PARSED + f"SELECT CAST(sum(hits) AS BIGINT) AS hits FROM hits WHERE doc_id = '{DOC}'")
def metric_doc_hits(spark, sf_dir):
    return dashboard.doc_hits(card_hits(spark, sf_dir), DOC)


@query("dash_event_count", PARSED + "SELECT count(*) AS events FROM bronze")
def dash_event_count(spark, sf_dir):
    return dashboard.event_count(events(spark, sf_dir))


@query("dash_sessions", PARSED + "SELECT count(DISTINCT session_id) AS sessions FROM bronze")
def dash_sessions(spark, sf_dir):
    return dashboard.sessions(events(spark, sf_dir))


@query("dash_type_mix", PARSED + "SELECT event_type, count(*) AS cnt FROM bronze GROUP BY event_type")
def dash_type_mix(spark, sf_dir):
    return dashboard.type_mix(events(spark, sf_dir))


@query(
    "dash_top_opens",
    PARSED + f"SELECT {DAY.format('o.open_date')} AS open_date, doc_id, opens FROM opens o "
    "ORDER BY opens DESC, o.open_date, doc_id LIMIT 20",
)
def dash_top_opens(spark, sf_dir):
    return dashboard.top_opens(qs_opens(spark, sf_dir))


@query("dash_doc_series", PARSED + f"SELECT {DAY.format('date')} AS date, hits FROM hits WHERE doc_id = '{DOC}'")
def dash_doc_series(spark, sf_dir):
    return dashboard.doc_series(card_hits(spark, sf_dir), DOC)


@query(
    "dash_top3_series",
    PARSED + ", best AS (SELECT doc_id FROM opens GROUP BY doc_id ORDER BY sum(opens) DESC, doc_id LIMIT 3) "
    + OPENS_ROW + " WHERE doc_id IN (SELECT doc_id FROM best)",
)
def dash_top3_series(spark, sf_dir):
    return dashboard.topk_series(qs_opens(spark, sf_dir))


@query(
    "dash_top_queries",
    PARSED + "SELECT query_text AS query, count(*) AS searches FROM bronze WHERE event_type = 'QS' "
    "GROUP BY query_text ORDER BY searches DESC, query LIMIT 20",
)
def dash_top_queries(spark, sf_dir):
    return dashboard.top_queries(events(spark, sf_dir))


def _case(value: str, labels: list, rest: str, sign: str) -> str:
    return "CASE " + " ".join(f"WHEN {value} {sign} {b} THEN '{t}'" for b, t in labels) + f" ELSE '{rest}' END"


@query(
    "dash_session_size",
    PARSED + f"SELECT {_case('n', dashboard.SIZE_LABELS, '50+', '<=')} AS bucket, count(*) AS sessions "
    "FROM (SELECT session_id, count(*) AS n FROM bronze GROUP BY session_id) GROUP BY 1",
)
def dash_session_size(spark, sf_dir):
    return dashboard.session_size(events(spark, sf_dir))


@query(
    "dash_session_quantiles",
    PARSED + f"""
SELECT round(avg(n), 1) AS avg, quantile_cont(n, 0.5) AS p50, quantile_cont(n, 0.9) AS p90, quantile_cont(n, 0.99) AS p99
FROM (SELECT session_id, count(*) AS n FROM bronze WHERE event_time >= {NOW} - INTERVAL 48 HOUR GROUP BY session_id)""",
)
def dash_session_quantiles(spark, sf_dir):
    return dashboard.session_quantiles(events(spark, sf_dir), AS_OF, hours=48)


HOURS_SQL = ", ".join(
    f"count(*) FILTER (WHERE hour(event_time) = {h}) AS \"{h:02d}\"" for h in range(24)
)


@query(
    "dash_weekday_hour",
    PARSED + f"""
SELECT list_element(['Пн', 'Вт', 'Ср', 'Чт', 'Пт', 'Сб', 'Вс'], CAST(isodow(event_time) AS INT)) AS day, {HOURS_SQL}
FROM bronze WHERE event_type = 'SESSION_START' AND event_time >= {NOW} - INTERVAL 7 DAY GROUP BY 1""",
)
def dash_weekday_hour(spark, sf_dir):
    return dashboard.weekday_hour(events(spark, sf_dir), AS_OF)


@query(
    "dash_session_duration",
    PARSED + f"SELECT {_case('dur', dashboard.DURATION_LABELS, '> 1 час', '<')} AS bucket, count(*) AS sessions FROM "
    "(SELECT session_id, date_diff('second', min(event_time), max(event_time)) AS dur FROM bronze "
    "WHERE event_time IS NOT NULL GROUP BY session_id) GROUP BY 1",
)
def dash_session_duration(spark, sf_dir):
    return dashboard.session_duration(events(spark, sf_dir))


@query(
    "dash_behaviour",
    PARSED + """
SELECT CASE WHEN q > 0 AND c > 0 THEN 'QS + CARD' WHEN q > 0 THEN 'только QS' WHEN c > 0 THEN 'только CARD'
            WHEN d > 0 THEN 'только просмотр' ELSE 'без активности' END AS pattern, count(*) AS sessions
FROM (SELECT session_id, count(*) FILTER (WHERE event_type = 'QS') AS q,
             count(*) FILTER (WHERE event_type = 'CARD_SEARCH') AS c,
             count(*) FILTER (WHERE event_type = 'DOC_OPEN') AS d FROM bronze GROUP BY session_id) GROUP BY 1""",
)
def dash_behaviour(spark, sf_dir):
    return dashboard.behaviour(events(spark, sf_dir))


@query(
    "dash_opens_per_session",
    PARSED + f"SELECT {_case('n', dashboard.OPENS_LABELS, '10+', '<=')} AS bucket, count(*) AS sessions "
    "FROM (SELECT session_id, count(*) FILTER (WHERE event_type = 'DOC_OPEN') AS n FROM bronze GROUP BY session_id) "
    "GROUP BY 1",
)
def dash_opens_per_session(spark, sf_dir):
    return dashboard.opens_per_session(events(spark, sf_dir))


# Rows count as ingested 90 seconds after their event.
@query(
    "dash_sessions_per_minute",
    PARSED + f"""
SELECT {TS.format("date_trunc('minute', event_time + INTERVAL 90 SECOND)")} AS t, count(*) AS new_sessions
FROM bronze WHERE event_type = 'SESSION_START' AND event_time + INTERVAL 90 SECOND >= {NOW} - INTERVAL 72 HOUR GROUP BY 1""",
)
def dash_sessions_per_minute(spark, sf_dir):
    stamped = events(spark, sf_dir).withColumn("ingested_at", F.col("event_time") + F.expr("INTERVAL 90 SECONDS"))
    return dashboard.sessions_per_minute(stamped, AS_OF, hours=72)


@query("dash_files_total", PARSED + "SELECT count(*) AS files FROM ledger")
def dash_files_total(spark, sf_dir):
    return dashboard.files_total(ledger(spark, sf_dir))


@query("dash_files_hour", PARSED + f"SELECT count(*) AS files FROM ledger WHERE processed_at >= {NOW} - INTERVAL 6 HOUR")
def dash_files_hour(spark, sf_dir):
    return dashboard.files_recent(ledger(spark, sf_dir), AS_OF, hours=6)


@query(
    "dash_freshness",
    PARSED + f"SELECT date_diff('second', max(processed_at), {NOW}) AS seconds_since FROM ledger",
)
def dash_freshness(spark, sf_dir):
    return dashboard.freshness(ledger(spark, sf_dir), AS_OF)
