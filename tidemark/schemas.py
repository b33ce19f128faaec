"""Table schemas."""

from __future__ import annotations

from pyspark.sql import types as T

PARAMS = T.ArrayType(T.StructType([T.StructField("param_id", T.StringType()), T.StructField("value", T.StringType())]))
IDS = T.ArrayType(T.StringType())

# Parsed session events. The two lists stay native; with_json_columns() turns them into text at the edges.
EVENT_TABLE = T.StructType(
    [
        T.StructField("session_id", T.StringType(), False),
        T.StructField("event_seq", T.IntegerType(), False),
        T.StructField("event_time", T.TimestampType()),
        T.StructField("event_date", T.DateType()),
        T.StructField("event_type", T.StringType(), False),
        T.StructField("search_id", T.StringType()),
        T.StructField("search_kind", T.StringType()),
        T.StructField("query_text", T.StringType()),
        T.StructField("card_params", PARAMS),
        T.StructField("result_doc_ids", IDS),
        T.StructField("doc_id", T.StringType()),
        T.StructField("parse_error", T.StringType()),
        T.StructField("raw_line", T.StringType()),
    ]
)

LEDGER = T.StructType(
    [
        T.StructField("path", T.StringType(), False),
        T.StructField("processed_at", T.TimestampType(), False),
        T.StructField("events_count", T.LongType(), False),
    ]
)

CARD_HITS = T.StructType(
    [
        T.StructField("date", T.DateType(), False),
        T.StructField("doc_id", T.StringType(), False),
        T.StructField("hits", T.LongType(), False),
        T.StructField("computed_at", T.TimestampType()),
    ]
)

QS_OPENS = T.StructType(
    [
        T.StructField("open_date", T.DateType(), False),
        T.StructField("doc_id", T.StringType(), False),
        T.StructField("opens", T.LongType(), False),
        T.StructField("computed_at", T.TimestampType()),
    ]
)
