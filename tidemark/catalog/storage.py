"""Source and sink queries: every one writes data derived from the tables to the shared folder and reads it back."""

from __future__ import annotations

from pyspark.sql import functions as F

from tidemark.bridges import corpus, event_blocks
from tidemark.catalog.logs import EV, PARSED, card_hits, events, qs_opens
from tidemark.catalog.registry import query, table
from tidemark.catalog.relational import IMP, docs, imp
from tidemark.lineage import new_folder
from tidemark.operators.loglines import classify, to_lines
from tidemark.sources.sessions import read_session_lines, read_sessions
from tidemark.sources.tables import (
    compact,
    file_count,
    read_table,
    read_whole_texts,
    storage_report,
    write_by,
    write_export,
    write_table,
)

BLOCKS_PER_FILE = 20_000
TEXTS_PER_FILE = 2_000  # a whole text file is one row
ROWS_PER_TEXT_FILE = "50000"  # a multi-line CSV file is read by one task, so files stay small


def write_session_files(spark, sf_dir):
    """Log text as plain files of bounded size; returns the folder."""
    folder = new_folder(spark, "session-files")
    blocks = event_blocks(table(spark, sf_dir, "events")).select("content")
    blocks.write.option("maxRecordsPerFile", BLOCKS_PER_FILE).text(folder)
    return folder


BLOCK_KINDS = f"""
WITH {EV},
per AS (
  SELECT 'QS' AS kind FROM ev WHERE event_type = 'signup'
  UNION ALL SELECT 'RESULTS' FROM ev WHERE event_type = 'signup' AND event_id % 11 <> 0
  UNION ALL SELECT unnest(['CARD_START', 'PARAM', 'PARAM', 'CARD_END', 'RESULTS']) FROM ev WHERE event_type = 'error'
  UNION ALL SELECT 'OPEN' FROM ev WHERE event_type = 'view'
  UNION ALL SELECT 'OPEN_UNTIMED' FROM ev WHERE event_type = 'click'
  UNION ALL SELECT CASE k % 4 WHEN 0 THEN 'CARD_END' WHEN 1 THEN 'BAD_TIME' WHEN 2 THEN 'UNKNOWN' ELSE 'PARAM' END
            FROM ev WHERE event_type = 'purchase')
SELECT kind, count(*) AS n FROM per GROUP BY kind"""


@query("src_session_files", BLOCK_KINDS)
def src_session_files(spark, sf_dir):
    files = read_sessions(spark, write_session_files(spark, sf_dir))
    return classify(to_lines(files)).groupBy("kind").agg(F.count("*").alias("n"))


@query("src_session_lines", BLOCK_KINDS)
def src_session_lines(spark, sf_dir):
    files = read_session_lines(spark, write_session_files(spark, sf_dir))
    return classify(to_lines(files)).groupBy("kind").agg(F.count("*").alias("n"))


@query("text_char_count", "SELECT CAST(sum(length(text) + 1) AS BIGINT) AS n_chars FROM documents")
def text_char_count(spark, sf_dir):
    folder = new_folder(spark, "texts")
    docs(spark, sf_dir).select("prompt").write.option("maxRecordsPerFile", TEXTS_PER_FILE).text(folder)
    return read_whole_texts(spark, folder).agg(F.sum("n_chars").alias("n_chars"))


ROUND_TRIP = IMP + "SELECT prompt_id, md5(prompt) AS digest, category, prompt_model, prompt_token_length FROM docs"


def _digest(df):
    return df.select("prompt_id", F.md5("prompt").alias("digest"), "category", "prompt_model", "prompt_token_length")


def _round_trip(spark, sf_dir, fmt):
    stored, folder = docs(spark, sf_dir), new_folder(spark, fmt)
    write_table(stored, folder, fmt, maxRecordsPerFile=ROWS_PER_TEXT_FILE)
    return _digest(read_table(spark, folder, fmt, schema=stored.schema))


@query("scan_csv_roundtrip", ROUND_TRIP)
def scan_csv_roundtrip(spark, sf_dir):
    return _round_trip(spark, sf_dir, "csv")


@query("scan_json_roundtrip", ROUND_TRIP)
def scan_json_roundtrip(spark, sf_dir):
    return _round_trip(spark, sf_dir, "json")


CODECS = ("snappy", "zstd", "gzip", "uncompressed")


@query(
    "sink_codecs",
    IMP + """
SELECT codec, count(*) AS n, CAST(sum(length(prompt)) AS BIGINT) AS chars
FROM docs, (SELECT unnest(['snappy', 'zstd', 'gzip', 'uncompressed']) AS codec) GROUP BY codec""",
)
def sink_codecs(spark, sf_dir):
    result = None
    for codec in CODECS:
        folder = new_folder(spark, codec)
        write_table(docs(spark, sf_dir), folder, codec=codec)
        part = read_table(spark, folder).agg(F.count("*").alias("n"), F.sum(F.length("prompt")).alias("chars"))
        part = part.select(F.lit(codec).alias("codec"), "n", "chars")
        result = part if result is None else result.unionByName(part)
    return result


@query(
    "append_then_read",
    IMP + """
SELECT stage, count(*) AS n, count(DISTINCT prompt_id) AS keys
FROM (SELECT prompt_id FROM docs UNION ALL SELECT prompt_id FROM docs WHERE prompt_model = 'en'),
     (SELECT unnest(['appended', 'compacted']) AS stage) GROUP BY stage""",
)
def append_then_read(spark, sf_dir):
    folder, small = new_folder(spark, "append"), new_folder(spark, "compact")
    write_table(docs(spark, sf_dir), folder)
    write_table(docs(spark, sf_dir).filter(F.col("prompt_model") == "en"), folder)
    compact(spark, folder, small)

    def count(path, stage):
        counted = read_table(spark, path).agg(F.count("*").alias("n"), F.countDistinct("prompt_id").alias("keys"))
        return counted.select(F.lit(stage).alias("stage"), "n", "keys")

    return count(folder, "appended").unionByName(count(small, "compacted"))


def _exports(spark, sf_dir):
    """The three exports: events by day, both marts by month."""
    folders = {name: new_folder(spark, f"export-{name}") for name in ("events", "card_hits", "qs_opens")}
    write_export(
        events(spark, sf_dir), folders["events"], "event_date", "day", keys=("session_id", "event_seq"), undated=True
    )
    write_export(card_hits(spark, sf_dir), folders["card_hits"], "date", "month")
    write_export(qs_opens(spark, sf_dir), folders["qs_opens"], "open_date", "month")
    return folders


@query(
    "export_daily_parquet",
    PARSED + """
SELECT 'events' AS export, CAST(strftime(coalesce(event_date, DATE '1970-01-01'), '%Y%m%d') AS INT) AS part, count(*) AS n
FROM bronze GROUP BY ALL
UNION ALL SELECT 'card_hits', CAST(strftime(date, '%Y%m') AS INT), count(*) FROM hits GROUP BY ALL
UNION ALL SELECT 'qs_opens', CAST(strftime(open_date, '%Y%m') AS INT), count(*) FROM opens GROUP BY ALL""",
)
def export_daily_parquet(spark, sf_dir):
    result = None
    for name, folder in _exports(spark, sf_dir).items():
        counted = read_table(spark, folder).groupBy("part").agg(F.count("*").alias("n"))
        counted = counted.select(F.lit(name).alias("export"), F.col("part").cast("int").alias("part"), "n")
        result = counted if result is None else result.unionByName(counted)
    return result


# The number of files depends on their layout; that each part has one does not.
@query(
    "export_file_count",
    PARSED + """
SELECT 'events' AS export, count(DISTINCT coalesce(event_date, DATE '1970-01-01')) AS parts, true AS enough FROM bronze
UNION ALL SELECT 'card_hits', count(DISTINCT date_trunc('month', date)), true FROM hits
UNION ALL SELECT 'qs_opens', count(DISTINCT date_trunc('month', open_date)), true FROM opens""",
)
def export_file_count(spark, sf_dir):
    result = None
    for name, folder in _exports(spark, sf_dir).items():
        counted = file_count(spark, folder, "part").agg(F.count("*").alias("parts"), F.min("files").alias("least"))
        counted = counted.select(F.lit(name).alias("export"), "parts", (F.col("least") > 0).alias("enough"))
        result = counted if result is None else result.unionByName(counted)
    return result


FORMATS = ("parquet", "orc")  # delta, iceberg and hudi take the same calls once their jars are on the class path


@query(
    "fmt_filtered_count",
    IMP + "SELECT fmt, count(*) AS n FROM imp, (SELECT unnest(['parquet', 'orc']) AS fmt) WHERE bid_price > 0.5 GROUP BY fmt",
)
def fmt_filtered_count(spark, sf_dir):
    result = None
    for fmt in FORMATS:
        folder = new_folder(spark, fmt)
        write_table(imp(spark, sf_dir), folder, fmt)
        counted = read_table(spark, folder, fmt).filter(F.col("bid_price") > 0.5).agg(F.count("*").alias("n"))
        counted = counted.select(F.lit(fmt).alias("fmt"), "n")
        result = counted if result is None else result.unionByName(counted)
    return result


@query(
    "partitioned_table",
    PARSED + "SELECT strftime(event_date, '%Y-%m-%d') AS event_date, count(*) AS n FROM bronze "
    "WHERE event_date >= DATE '2024-01-20' GROUP BY event_date",
)
def partitioned_table(spark, sf_dir):
    folder = new_folder(spark, "by-day")
    write_by(events(spark, sf_dir), folder, "event_date", codec="zstd")
    recent = read_table(spark, folder).filter(F.col("event_date") >= F.lit("2024-01-20").cast("date"))
    return recent.groupBy("event_date").agg(F.count("*").alias("n"))


@query(
    "storage_report",
    "SELECT * FROM (VALUES ('csv', true, 1.0), ('json', true, NULL), ('orc', true, NULL), ('parquet-snappy', true, NULL), "
    "('parquet-zstd', true, NULL)) AS t(label, stored, base_ratio)",
)
def storage_report_query(spark, sf_dir):
    paths = {}
    for label, fmt, codec in (
        ("csv", "csv", None), ("json", "json", None), ("orc", "orc", None),
        ("parquet-snappy", "parquet", "snappy"), ("parquet-zstd", "parquet", "zstd"),
    ):
        paths[label] = new_folder(spark, label)
        write_table(corpus(table(spark, sf_dir, "documents")), paths[label], fmt, codec=codec)
    report = storage_report(spark, paths, base="csv")
    base_ratio = F.when(F.col("label") == "csv", F.col("ratio"))
    return report.select("label", (F.col("bytes") > 0).alias("stored"), base_ratio.alias("base_ratio"))
