"""From classified lines to the event table: the per-session state machine as running aggregates.

A session line is read in one of three situations: nothing pending, a query waiting for its result line, or a
card search collecting parameters and then waiting for its result line. Four header kinds set the situation
whatever came before, so a line's situation depends only on its latest header and on the lines since then.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.functions.text import last_path_part
from tidemark.lineage import written
from tidemark.operators.loglines import BAD_TIME, UNKNOWN, classify, to_lines
from tidemark.operators.scan import Carry, by_line, running

HEADERS = ("SESSION_START", "SESSION_END", "QS", "CARD_START")
BODY = ("CARD_END", "PARAM", "RESULTS")
DIRECT = ("SESSION_START", "SESSION_END", "OPEN", "OPEN_UNTIMED", BAD_TIME, UNKNOWN)

# Fixed names used in the error text of a line that does not fit its situation.
LINE_NAMES = {"CARD_END": "CardSearchEnd$", "PARAM": "CardParamLine", "RESULTS": "SearchResults"}
NOTHING_PENDING, QUERY_PENDING, CARD_PENDING = "Neutral$", "AwaitingQsResults", "InCardSearch"

EMITTED = (
    "session_id", "line_no", "event_time", "event_type", "search_id", "search_kind", "query_text",
    "card_params", "result_doc_ids", "doc_id", "parse_error", "raw_line",
)
_NO_PARAMS = "cast(array() as array<struct<param_id: string, value: string>>)"
_NO_DOCS = "cast(array() as array<string>)"

Stage = Callable[[DataFrame, str], DataFrame]


def segment(lines: DataFrame, bucket_lines: int | None, stage: Stage) -> DataFrame:
    """Give every body line its header, the line that closes the card form and the accepted result line, as far as they were read.

    Both lines are the first of their kind under a header: a running maximum over (header line, -line number). So all three are
    folded in the order of lines, and without a split one shuffle by session serves them. A split step reads its input twice,
    so its input is stored.
    """
    line_no, kind, pending = F.col("line_no"), F.col("kind"), F.col("header.kind")
    split = by_line(line_no, bucket_lines)

    def kept(df: DataFrame, label: str) -> DataFrame:
        return df if split is None else stage(df, label)

    def first(df: DataFrame, name: str, found: Column) -> DataFrame:
        latest = Carry("latest", "max", F.when(found, F.struct("segment", (-line_no).alias("back"))))
        here = F.when(F.col("latest.segment") == F.col("segment"), -F.col("latest.back"))
        return running(df, ["session_id"], ["line_no"], [latest], split).withColumn(name, here).drop("latest")

    header = Carry("header", "max", F.when(kind.isin(*HEADERS), F.struct("line_no", "kind", "time", "query")))
    read = lines.filter(kind.isin(*HEADERS, *BODY))
    headed = running(read, ["session_id"], ["line_no"], [header], split).filter(kind.isin(*BODY))
    in_segment = F.when(pending.isin("QS", "CARD_START") & F.col("session_id").isNotNull(), F.col("header.line_no"))
    keyed = kept(headed.withColumn("segment", in_segment), "segments")
    in_form = F.col("segment").isNotNull() & (pending == "CARD_START")
    closed = kept(first(keyed, "card_end", in_form & (kind == "CARD_END")), "closed")
    awaited = F.col("segment").isNotNull() & ((pending == "QS") | (line_no > F.col("card_end")))
    return stage(first(closed, "results_at", awaited & (kind == "RESULTS")), "segmented")


def emit(lines: DataFrame, segmented: DataFrame) -> DataFrame:
    """One row per event, still without sequence numbers, inherited times and search kinds of opens."""
    line_no, kind, pending = F.col("line_no"), F.col("kind"), F.col("header.kind")
    is_card = F.coalesce(pending == "CARD_START", F.lit(False))
    is_query = F.coalesce(pending == "QS", F.lit(False))
    is_result = F.coalesce(line_no == F.col("results_at"), F.lit(False))
    before_end = F.col("card_end").isNull() | (line_no < F.col("card_end"))
    is_param = is_card & (kind == "PARAM") & before_end
    is_end = F.coalesce(is_card & (line_no == F.col("card_end")), F.lit(False))

    opens = F.col("kind").isin("OPEN", "OPEN_UNTIMED")
    failed = F.col("error").isNotNull()
    direct = lines.filter(kind.isin(*DIRECT)).select(
        "session_id",
        "line_no",
        F.col("time").alias("event_time"),
        F.when(failed, "MALFORMED").when(opens, "DOC_OPEN").otherwise(kind).alias("event_type"),
        F.when(opens, F.col("search_id")).alias("search_id"),
        F.lit(None).cast("string").alias("search_kind"),
        F.lit(None).cast("string").alias("query_text"),
        F.expr(_NO_PARAMS).alias("card_params"),
        F.expr(_NO_DOCS).alias("result_doc_ids"),
        F.when(opens, F.col("doc_id")).alias("doc_id"),
        F.col("error").alias("parse_error"),
        F.when(failed, F.col("line")).alias("raw_line"),
    )

    name = F.coalesce(*[F.when(kind == k, F.lit(v)) for k, v in LINE_NAMES.items()])
    answered = F.col("results_at").isNotNull() & (line_no > F.col("results_at"))
    situation = (
        F.when(is_query & ~answered, QUERY_PENDING).when(is_card & ~answered, CARD_PENDING).otherwise(NOTHING_PENDING)
    )
    single = segmented.filter(~is_param & ~is_end & ~(is_card & is_result)).select(
        "session_id",
        "line_no",
        F.when(is_result, F.col("header.time")).alias("event_time"),
        F.when(is_result, "QS").otherwise("MALFORMED").alias("event_type"),
        F.when(is_result, F.col("search_id")).alias("search_id"),
        F.when(is_result, "QS").alias("search_kind"),
        F.when(is_result, F.col("header.query")).alias("query_text"),
        F.expr(_NO_PARAMS).alias("card_params"),
        F.when(is_result, F.col("docs")).otherwise(F.expr(_NO_DOCS)).alias("result_doc_ids"),
        F.lit(None).cast("string").alias("doc_id"),
        F.when(
            ~is_result, F.concat(F.lit("unexpected '"), name, F.lit("' in state "), situation)
        ).alias("parse_error"),
        F.when(~is_result, F.col("line")).alias("raw_line"),
    )

    # A card event needs the parameters of its form in one cell, so only form and result lines are grouped.
    answer = F.max(F.when(is_result, F.struct("search_id", "docs")))
    form = F.array_sort(
        F.collect_list(F.when(kind == "PARAM", F.struct("line_no", "param.param_id", "param.value")))
    )
    cards = (
        segmented.filter(is_card & F.col("segment").isNotNull() & (is_param | is_result))
        .groupBy("session_id", "segment")
        .agg(
            F.max("results_at").alias("line_no"), F.max("header.time").alias("event_time"),
            answer.alias("answer"), form.alias("form"),
        )
        .filter(F.col("line_no").isNotNull())
        .select(
            "session_id",
            "line_no",
            "event_time",
            F.lit("CARD_SEARCH").alias("event_type"),
            F.col("answer.search_id").alias("search_id"),
            F.lit("CARD").alias("search_kind"),
            F.lit(None).cast("string").alias("query_text"),
            F.transform(
                "form", lambda p: F.struct(p["param_id"].alias("param_id"), p["value"].alias("value"))
            ).alias("card_params"),
            F.col("answer.docs").alias("result_doc_ids"),
            F.lit(None).cast("string").alias("doc_id"),
            F.lit(None).cast("string").alias("parse_error"),
            F.lit(None).cast("string").alias("raw_line"),
        )
    )
    return direct.unionByName(single).unionByName(cards)


def number(emitted: DataFrame, bucket_lines: int | None, stage: Stage) -> DataFrame:
    """Sequence number, time of untimed opens, and the kind of search each open came from.

    Without a split both steps are served by one shuffle by session. Each reads its input twice if it splits, so both inputs are
    stored then.
    """
    split = by_line(F.col("line_no"), bucket_lines)
    is_search = F.col("event_type").isin("QS", "CARD_SEARCH")
    matched = running(
        emitted.repartition("session_id") if split is None else stage(emitted, "emitted"),
        ["session_id", "search_id"],
        ["line_no"],
        [Carry("searched", "max", F.when(is_search, F.struct("line_no", "search_kind")))],
        split,
    )
    clocked = running(
        matched if split is None else stage(matched, "matched"),
        ["session_id"],
        ["line_no"],
        [
            Carry("seen", "sum", F.lit(1).cast("bigint")),
            Carry("clock", "max", F.when(F.col("event_time").isNotNull(), F.struct("line_no", "event_time"))),
        ],
        split,
    )
    is_open = F.col("event_type") == "DOC_OPEN"
    return clocked.withColumns(
        {
            "event_seq": (F.col("seen") - 1).cast("int"),
            "event_time": F.when(is_open, F.col("clock.event_time")).otherwise(F.col("event_time")),
            "search_kind": F.when(is_open, F.col("searched.search_kind")).otherwise(F.col("search_kind")),
        }
    )


def by_size(lines: DataFrame, bucket_lines: int | None, stage: Stage) -> list[tuple[DataFrame, int | None]]:
    """The lines of sessions that fit a task, read without a split, and those of sessions with more than ``bucket_lines`` lines.

    Long sessions are few, at most one in ``bucket_lines`` of all lines; mostly there are none, and nothing is joined.
    """
    if bucket_lines is None:
        return [(lines, None)]
    sizes = lines.groupBy(F.col("session_id").alias("long_id")).agg(F.count("*").alias("n"))
    long = stage(sizes.filter(F.col("n") > bucket_lines).select("long_id"), "long-sessions")
    if long.isEmpty():
        return [(lines, None)]
    same = F.col("session_id").eqNullSafe(F.col("long_id"))
    return [(lines.join(long, same, "left_anti"), None), (lines.join(long, same, "left_semi"), bucket_lines)]


def events_from_lines(lines: DataFrame, bucket_lines: int | None, stage: Stage) -> DataFrame:
    # Only a line that may end up malformed has to keep its text.
    may_fail = F.col("kind").isin(*BODY, BAD_TIME, UNKNOWN)
    staged = stage(classify(lines).withColumn("line", F.when(may_fail, F.col("line"))), "lines")
    numbered = [
        number(emit(part, segment(part, split, stage)), split, stage).select(
            "session_id",
            "event_seq",
            "event_time",
            F.to_date("event_time").alias("event_date"),
            *[name for name in EMITTED if name not in ("session_id", "line_no", "event_time")],
        )
        for part, split in by_size(staged, bucket_lines, stage)
    ]
    return numbered[0] if len(numbered) == 1 else numbered[0].unionByName(numbered[1])


def parse_sessions(
    chunks: DataFrame, bucket_lines: int | None = 1 << 20, stage: Stage = written
) -> DataFrame:
    """Session text to event rows.

    A session of up to ``bucket_lines`` lines is folded by one task; longer ones are split into runs of so many line numbers.
    Pass None when each session is one file read as a whole: its size is then bounded by the file reader.
    """
    return events_from_lines(to_lines(chunks), bucket_lines, stage)


def parse_files(
    sessions: DataFrame, stage: Stage = written, with_path: bool = False, bucket_lines: int | None = None
) -> DataFrame:
    """Parse sessions that are files, whole ones (a row of at most 2 GB each) or the lines of ``read_session_lines``.

    A file is parsed by itself: its path tells it apart, so files of one name in different folders do not mix. Give
    ``bucket_lines`` where files come as lines, so that no task holds a whole one.
    """
    events = parse_sessions(sessions.withColumn("session_id", F.col("path")), bucket_lines=bucket_lines, stage=stage)
    named = events.withColumn("path", F.col("session_id")).withColumn("session_id", last_path_part(F.col("session_id")))
    return named if with_path else named.drop("path")


def with_json_columns(events: DataFrame) -> DataFrame:
    """Render the two lists as JSON text, ``[]`` when empty."""
    lists = {"card_params_json": "card_params", "result_doc_ids_json": "result_doc_ids"}
    rendered = {name: F.coalesce(F.to_json(source), F.lit("[]")) for name, source in lists.items()}
    return events.withColumns(rendered).drop(*lists.values())
