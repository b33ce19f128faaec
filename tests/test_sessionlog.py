"""The session parser on literal logs, and on random logs against a line-by-line reader."""

import random
import re
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from tidemark.functions.times import parse_time
from tidemark.lineage import unwritten, written
from tidemark.operators.loglines import to_lines
from tidemark.operators.sessionlog import by_size, parse_files, parse_sessions, with_json_columns
from tidemark.sources.sessions import read_session_lines, read_sessions

T1, T2 = "07.07.2020_06:38:07", "07.07.2020_06:40:00"
D1, D2 = datetime(2020, 7, 7, 6, 38, 7), datetime(2020, 7, 7, 6, 40)

LOGS = {
    "basic": f"SESSION_START {T1}\nQS {T1} {{abc {{x}}}}\n12 LAW_1 LAW_2\nDOC_OPEN {T2} 12 LAW_1\nSESSION_END {T2}\n",
    "no_time": f"QS {T1} {{a}}\n1 L_1\nDOC_OPEN  1 L_1\n",
    "card": f"CARD_SEARCH_START {T1}\r\n$0 A_1\r\nCARD_SEARCH_END  \r\n-5 A_1\r\n",
    "zoned": "SESSION_START Tue,_7_Jul_2020_06:38:07_+0300",
    "orphan": f"1 A_1\nCARD_SEARCH_START {T1}\nCARD_SEARCH_END\n$1 x\nCARD_SEARCH_END\n",
    "abandoned": f"QS {T1} {{a}}\nCARD_SEARCH_START {T1}\nCARD_SEARCH_END\n7 B_1\n",
    "bad_time": "QS bad {x}\n1 A",
    "reuse": f"QS {T1} {{a}}\n1 L\nDOC_OPEN {T1} 1 L\nCARD_SEARCH_START {T1}\nCARD_SEARCH_END\n1 L\nDOC_OPEN {T2} 1 L\n",
    "month_end": "SESSION_START 31.02.2025_10:00:00",
    "empty": "",
    "blank": "\n  \n\t\n",
    "cyrillic": f"QS {T1} {{налог на прибыль}}\n1",
    "no_doc": f"DOC_OPEN {T1} 5",
}
FIELDS = ["event_type", "event_time", "search_id", "search_kind", "query_text", "doc_id", "parse_error", "raw_line"]


@pytest.fixture(scope="module")
def parsed(spark, tmp_path_factory):
    folder = tmp_path_factory.mktemp("sessions")
    for name, text in LOGS.items():
        (folder / name).write_bytes(text.encode("cp1251"))
    events = parse_files(read_sessions(spark, str(folder)))
    by_session = {name: [] for name in LOGS}
    for row in with_json_columns(events).orderBy("session_id", "event_seq").collect():
        by_session[row.session_id].append(row)
    return by_session


def kinds(rows):
    return [row.event_type for row in rows]


def test_basic(parsed):
    rows = parsed["basic"]
    assert kinds(rows) == ["SESSION_START", "QS", "DOC_OPEN", "SESSION_END"]
    assert [row.event_seq for row in rows] == [0, 1, 2, 3]
    assert rows[1].query_text == "abc {x}" and rows[1].result_doc_ids_json == '["LAW_1","LAW_2"]'
    assert rows[2].search_kind == "QS" and rows[2].event_time == D2 and rows[0].card_params_json == "[]"
    assert rows[0].event_date == D1.date()


def test_open_without_time_inherits(parsed):
    assert parsed["no_time"][1].event_time == D1 and parsed["no_time"][1].search_kind == "QS"


def test_card_with_carriage_returns(parsed):
    (row,) = parsed["card"]
    assert (row.event_type, row.search_id, row.search_kind) == ("CARD_SEARCH", "-5", "CARD")
    assert row.card_params_json == '[{"param_id":"0","value":"A_1"}]' and row.result_doc_ids_json == '["A_1"]'


def test_zoned_and_month_end(parsed):
    assert parsed["zoned"][0].event_time == datetime(2020, 7, 7, 3, 38, 7)
    assert parsed["month_end"][0].event_time == datetime(2025, 2, 28, 10)


def test_lines_out_of_place(parsed):
    rows = parsed["orphan"]
    assert kinds(rows) == ["MALFORMED"] * 3
    assert [row.parse_error for row in rows] == [
        "unexpected 'SearchResults' in state Neutral$",
        "unexpected 'CardParamLine' in state InCardSearch",
        "unexpected 'CardSearchEnd$' in state InCardSearch",
    ]
    assert [row.raw_line for row in rows] == ["1 A_1", "$1 x", "CARD_SEARCH_END"]


def test_abandoned_query_leaves_no_row(parsed):
    assert kinds(parsed["abandoned"]) == ["CARD_SEARCH"]


def test_unreadable_time(parsed):
    rows = parsed["bad_time"]
    assert [row.parse_error for row in rows] == [
        "unparseable timestamp: bad", "unexpected 'SearchResults' in state Neutral$",
    ]


def test_latest_use_of_a_search_id_wins(parsed):
    assert [row.search_kind for row in parsed["reuse"] if row.event_type == "DOC_OPEN"] == ["QS", "CARD"]


def test_nothing_in_nothing_out(parsed):
    assert parsed["empty"] == [] and parsed["blank"] == []


def test_cyrillic_and_empty_results(parsed):
    (row,) = parsed["cyrillic"]
    assert row.query_text == "налог на прибыль" and row.result_doc_ids_json == "[]"


def test_open_without_document_reads_as_untimed(parsed):
    (row,) = parsed["no_doc"]
    assert (row.search_id, row.doc_id, row.event_time) == (T1, "5", None)


def test_times(spark):
    cases = {
        "29.02.2023_00:00:00": datetime(2023, 2, 28), "29.02.2024_00:00:00": datetime(2024, 2, 29),
        "31.04.2024_23:59:59": datetime(2024, 4, 30, 23, 59, 59), "32.01.2024_00:00:00": None,
        "01.13.2024_00:00:00": None, "01.01.2024_24:00:00": datetime(2024, 1, 2), "01.01.2024_24:00:01": None, "31.12.2024_24:00:00": datetime(2025, 1, 1), "1.01.2024_00:00:00": None, "01.01.0000_00:00:00": None,
        "Wed,_7_Jul_2020_06:38:07_+0300": None, "Tue,_07_Jul_2020_06:38:07_-0130": datetime(2020, 7, 7, 8, 8, 7),
        "Tue,_7_Jul_2020_24:00:00_+0000": datetime(2020, 7, 8), "Wed,_7_Jul_2020_24:00:00_+0000": None,
        "Tue,_7_Xxx_2020_06:38:07_+0300": None, "": None,
    }
    df = spark.createDataFrame([(k,) for k in cases], "token string")
    got = {r.token: r.t for r in df.select("token", parse_time(F.col("token")).alias("t")).collect()}
    assert got == cases


# ------------------------------------------------------------------ random logs


def read_line_by_line(text):
    """Expected events of one session, from a plain reading of the log format."""
    events, kinds_seen, pending, last = [], {}, None, None

    def moment(token):
        return datetime.strptime(token, "%d.%m.%Y_%H:%M:%S") if re.fullmatch(r"\d\d\.\d\d\.\d{4}_[\d:]{8}", token) else None

    def bad(line, why):
        events.append(("MALFORMED", None, None, None, None, None, why, line, (), ()))

    def misplaced(line, name):
        where = "Neutral$" if pending is None else "AwaitingQsResults" if "query" in pending else "InCardSearch"
        bad(line, f"unexpected '{name}' in state {where}")

    for line in (raw.strip() for raw in text.split("\n")):
        words = line.split()
        if not words:
            continue
        head, count = words[0], len(words)
        timed = (
            (head in ("SESSION_START", "SESSION_END", "CARD_SEARCH_START") and count == 2)
            or (head == "QS" and re.fullmatch(r"QS\s+\S+\s+\{.*\}", line))
            or (head == "DOC_OPEN" and count == 4)
        )
        at = moment(words[1]) if timed else None
        if timed and at is None:
            bad(line, f"unparseable timestamp: {words[1]}")
        elif timed and head == "QS":
            pending = {"at": at, "query": line[line.index("{") + 1 : -1]}
        elif timed and head == "CARD_SEARCH_START":
            pending = {"at": at, "params": [], "closed": False}
        elif timed and head == "DOC_OPEN":
            last = at
            events.append(("DOC_OPEN", at, words[2], kinds_seen.get(words[2]), None, words[3], None, None, (), ()))
        elif timed:
            pending, last = None, at
            events.append((head, at, None, None, None, None, None, None, (), ()))
        elif line == "CARD_SEARCH_END":
            if pending and pending.get("closed") is False:
                pending["closed"] = True
            else:
                misplaced(line, "CardSearchEnd$")
        elif head == "DOC_OPEN" and count == 3:
            events.append(("DOC_OPEN", last, words[1], kinds_seen.get(words[1]), None, words[2], None, None, (), ()))
        elif head.startswith("$") and len(head) > 1 and count > 1:
            if pending and pending.get("closed") is False:
                pending["params"].append((head[1:], line.split(None, 1)[1]))
            else:
                misplaced(line, "CardParamLine")
        elif re.fullmatch(r"-?\d+", head):
            if pending and ("query" in pending or pending["closed"]):
                kind = "QS" if "query" in pending else "CARD"
                kinds_seen[head], last = kind, pending["at"]
                events.append(
                    ("QS" if kind == "QS" else "CARD_SEARCH", pending["at"], head, kind, pending.get("query"), None, None,
                     None, tuple(pending.get("params", ())), tuple(words[1:]))
                )
                pending = None
            else:
                misplaced(line, "SearchResults")
        else:
            bad(line, "unrecognized prefix")
    return events


def random_log(rng):
    start = datetime(2024, 1, 1)
    lines = []
    for _ in range(rng.randrange(0, 40)):
        time = (start + timedelta(seconds=rng.randrange(10**6))).strftime("%d.%m.%Y_%H:%M:%S")
        time = time if rng.random() < 0.93 else "oops"
        sid = str(rng.randrange(-3, 4))
        lines.append(
            rng.choice(
                [
                    f"SESSION_START {time}", f"SESSION_END {time}", f"QS {time} {{q{sid}}}", f"QS {time} {{}}",
                    f"CARD_SEARCH_START {time}", "CARD_SEARCH_END", "CARD_SEARCH_END", f"${sid} a  b {sid}", "$7 z",
                    f"{sid} D_1 D_2", sid, f"DOC_OPEN {time} {sid} D_1", f"DOC_OPEN  {sid} D_2", "junk", "QS nothing", "$", "  ",
                ]
            )
        )
    return "\n".join(lines)


@pytest.mark.parametrize("bucket", [None, 1, 5, 1000])
def test_random_logs(spark, bucket):
    rng = random.Random(11)
    logs = {f"s{i}": random_log(rng) for i in range(250)}
    chunks = spark.createDataFrame(list(logs.items()), "session_id string, content string")
    stage = unwritten if bucket is None else written
    got = {name: [] for name in logs}
    for row in parse_sessions(chunks, bucket, stage).orderBy("session_id", "event_seq").collect():
        assert row.event_seq == len(got[row.session_id])
        got[row.session_id].append(
            (*[row[name] for name in FIELDS], tuple((p.param_id, p.value) for p in row.card_params), tuple(row.result_doc_ids))
        )
    assert got == {name: read_line_by_line(text) for name, text in logs.items()}


def test_chunks_of_one_session_join_up(spark):
    text = f"QS {T1} {{a}}\n1 L\nDOC_OPEN  1 L"
    whole = spark.createDataFrame([("s", text)], "session_id string, content string")
    parts = spark.createDataFrame(
        [("s", i * 10, line) for i, line in enumerate(text.split("\n"))], "session_id string, line_base bigint, content string"
    )
    assert parse_sessions(parts, 1).orderBy("event_seq").collect() == parse_sessions(whole, None).orderBy("event_seq").collect()


def test_files_read_in_splits_parse_like_whole_ones(spark, tmp_path):
    rng = random.Random(3)
    names = ["one.txt", "with blank + plus.txt", "deep/one.txt", "empty.txt", "feeds.txt", "blanks.txt"]
    texts = ["\n".join(random_log(rng) for _ in range(30)) for _ in names]
    texts[3:] = ["", texts[4].replace("\n", "\f"), texts[5].replace("\n", "\n\n\r\n") + "\nQS привет"]
    for name, text in zip(names, texts):
        (tmp_path / name).parent.mkdir(exist_ok=True)
        (tmp_path / name).write_bytes(text.encode("cp1251"))
    before = {k: spark.conf.get(k) for k in ("spark.sql.files.maxPartitionBytes", "spark.sql.files.openCostInBytes")}
    whole = parse_files(read_sessions(spark, str(tmp_path)), with_path=True)
    numbers = to_lines(read_sessions(spark, str(tmp_path)))
    try:
        spark.conf.set("spark.sql.files.maxPartitionBytes", "997")
        spark.conf.set("spark.sql.files.openCostInBytes", "0")
        lines = read_session_lines(spark, str(tmp_path))
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)
    assert sorted(map(tuple, to_lines(lines).collect())) == sorted(map(tuple, numbers.collect()))
    cut = parse_files(lines, with_path=True, bucket_lines=50)
    order = ["path", "event_seq"]
    assert whole.count() > 500 and cut.orderBy(*order).collect() == whole.orderBy(*order).collect()


def test_sessions_that_fit_a_task_take_one_shuffle(spark):
    """Beside it only the lines of card forms are grouped; no step joins lines or reads them twice."""
    chunks = spark.createDataFrame([("a", LOGS["basic"]), ("b", LOGS["card"])], "session_id string, content string")
    labels = []

    def stage(df, label):
        labels.append(label)
        return written(df, label)

    plan = parse_sessions(chunks, stage=stage)._jdf.queryExecution().executedPlan().toString()
    assert labels == ["lines", "long-sessions", "segmented"]
    assert plan.count("Exchange hashpartitioning(") == 2 and "Join" not in plan


def test_long_sessions_are_split_and_short_ones_are_not(spark):
    rng = random.Random(7)
    logs = {"short": random_log(rng), "other": LOGS["reuse"], "long": "\n".join(random_log(rng) for _ in range(8)), None: "junk\n" * 60}
    chunks = spark.createDataFrame(list(logs.items()), "session_id string, content string")
    lines = written(to_lines(chunks), "lines")
    (few, whole), (many, cut) = by_size(lines, 50, written)
    assert (whole, cut) == (None, 50)
    assert {r.session_id for r in few.select("session_id").distinct().collect()} == {"short", "other"}
    assert {r.session_id for r in many.select("session_id").distinct().collect()} == {"long", None}
    got = {name: [] for name in logs}
    for row in parse_sessions(chunks, 50).orderBy("session_id", "event_seq").collect():
        assert row.event_seq == len(got[row.session_id])
        got[row.session_id].append(
            (*[row[name] for name in FIELDS], tuple((p.param_id, p.value) for p in row.card_params), tuple(row.result_doc_ids))
        )
    assert got == {name: read_line_by_line(text) for name, text in logs.items()}


@pytest.mark.parametrize("bucket", [None, 1])
def test_repeated_lines_answer_together(spark, bucket):
    """Lines that come twice have one number: both results are accepted, and one form holds all parameters."""
    text = {0: f"QS {T1} {{a}}\n1 L", 10: f"CARD_SEARCH_START {T2}\n$0 A\nCARD_SEARCH_END\n2 M"}
    rows = [("s", base, content) for base, content in text.items()] * 2
    chunks = spark.createDataFrame(rows, "session_id string, line_base bigint, content string")
    found = parse_sessions(chunks, bucket).collect()
    assert sorted(kinds(found)) == ["CARD_SEARCH", "QS", "QS"]
    assert [len(r.card_params) for r in found if r.event_type == "CARD_SEARCH"] == [2]


def test_text_is_made_by_many_tasks(spark, tmp_path):
    """A table of one row group is read by one task; the lines must not be."""
    from tidemark.bridges import BLOCK, session_chunks

    ts = F.timestamp_seconds(F.lit(1704067200) + F.col("id")).cast("timestamp_ntz")
    events = spark.range(0, 2000, 1, 1).select(
        F.col("id").alias("event_id"), ts.alias("ts"), (F.col("id") % 3).alias("user_id"),
        F.lit("view").alias("event_type"), F.lit(1.0).alias("value"), F.lit('{"k": 5}').alias("props"),
    )
    events.write.parquet(str(tmp_path / "events"))
    key = "spark.sql.adaptive.coalescePartitions.enabled"
    spark.conf.set(key, "false")
    try:
        chunks = session_chunks(spark.read.parquet(str(tmp_path / "events"))).filter(F.col("line_base") % BLOCK == 0)
        rows = chunks.groupBy(F.spark_partition_id().alias("task")).count().collect()
    finally:
        spark.conf.set(key, "true")
    assert sum(r["count"] for r in rows) == 2000 and len(rows) == 4
