"""Files, tables, exports and the incremental load."""

from datetime import date, datetime

import pytest
from pyspark.sql import functions as F

from tidemark.functions.text import decode_single_byte, strip_control
from tidemark.operators.medallion import dedup_events
from tidemark.plans.ingest import load_new_sessions, new_files, read_ledger
from tidemark.schemas import CARD_HITS, EVENT_TABLE
from tidemark.sources import tables as S
from tidemark.sources.sessions import read_sessions

NOW = datetime(2024, 5, 1)


def test_every_byte_decodes(spark):
    raw = bytes(range(256))
    df = spark.createDataFrame([(bytearray(raw),)], "content binary")
    assert df.select(decode_single_byte(F.col("content"))).collect()[0][0] == raw.decode("cp1251", errors="replace")


def test_strip_control(spark):
    df = spark.createDataFrame([("\x00\t a\x01b \r\n",)], "s string")
    assert df.select(strip_control(F.col("s"))).collect()[0][0] == "a\x01b"


def session(i):
    return f"SESSION_START 0{i}.01.2024_00:00:00\nQS 0{i}.01.2024_00:00:01 {{q}}\n1 A_1\nSESSION_END 0{i}.01.2024_00:00:02"


def test_incremental_load_takes_each_file_once(spark, tmp_path):
    source, events, ledger = (tmp_path / n for n in ("in", "events", "ledger"))
    source.mkdir()
    for i in range(1, 6):
        (source / f"s{i}").write_bytes(session(i).encode("cp1251"))
    (source / "s0").write_bytes(b"")

    def load(cap=2):
        return load_new_sessions(spark, str(source), str(events), str(ledger), NOW, cap).count()

    assert [load(), load(), load(), load()] == [2, 2, 1, 0]  # the file source shows no row for an empty file
    (source / "s6").write_bytes(session(6).encode("cp1251"))
    assert load(100) == 1
    stored = spark.read.parquet(str(events))
    assert stored.groupBy("session_id").count().collect().__len__() == 6 and stored.count() == 18
    assert {r.event_date for r in stored.collect()} == {date(2024, 1, i) for i in range(1, 7)}
    counts = {r.path.split("/")[-1]: r.events_count for r in read_ledger(spark, str(ledger)).collect()}
    assert counts == {f"s{i}": 3 for i in range(1, 7)}
    assert dedup_events(stored.unionByName(stored)).count() == 18


def test_new_files_is_ordered_and_capped(spark):
    files = spark.createDataFrame([(f"p{i}",) for i in range(9)], "path string")
    known = spark.createDataFrame([("p0",), ("p3",)], "path string")
    assert [r.path for r in new_files(files, known, 3).collect()] == ["p1", "p2", "p4"]


def test_export_replaces_everything_and_skips_undated(spark, tmp_path):
    path, schema = str(tmp_path / "x"), "id int, day date"
    S.write_export(spark.createDataFrame([(1, date(2024, 1, 1)), (2, None)], schema), path, "day")
    S.write_export(spark.createDataFrame([(3, date(2024, 2, 1)), (4, date(2024, 2, 9))], schema), path, "day", "month")
    assert {(r.id, r.part) for r in spark.read.parquet(path).collect()} == {(3, 202402), (4, 202402)}
    assert S.file_count(spark, path).collect()[0].files == 1


def test_text_round_trip_keeps_awkward_text(spark, tmp_path):
    rows = [(1, 'a "quoted", line\nsecond\\n'), (2, "  padded\t"), (3, "юникод"), (4, "\\\"")]
    df = spark.createDataFrame(rows, "id int, text string")
    for fmt in ("csv", "json", "orc", "parquet"):
        S.write_table(df, str(tmp_path / fmt), fmt)
        back = S.read_table(spark, str(tmp_path / fmt), fmt, schema=df.schema)
        assert sorted(map(tuple, back.collect())) == rows, fmt
    with pytest.raises(ValueError):
        S.read_table(spark, str(tmp_path / "csv"), "csv")


def test_storage_report(spark, tmp_path):
    df = spark.range(5000).select(F.col("id"), F.lit("same text").alias("t"))
    paths = {fmt: str(tmp_path / fmt) for fmt in ("csv", "parquet")}
    for fmt, path in paths.items():
        S.write_table(df, path, fmt)
    report = {r.label: r for r in S.storage_report(spark, paths, "csv").collect()}
    assert report["csv"].ratio == 1.0 and 0 < report["parquet"].ratio < 1


@pytest.mark.parametrize("fmt", ["avro", "delta", "iceberg", "hudi"])
def test_formats_that_need_a_package(spark, tmp_path, fmt):
    df = spark.range(3)
    try:
        S.write_table(df, str(tmp_path / fmt), fmt)
    except Exception as error:  # noqa: BLE001
        pytest.skip(f"{fmt} is not on the class path: {type(error).__name__}")
    assert S.read_table(spark, str(tmp_path / fmt), fmt).count() == 3


def test_create_table_is_idempotent(spark, tmp_path):
    for name, schema, day in (("mart_ddl", CARD_HITS, "date"), ("events_ddl", EVENT_TABLE, "event_date")):
        spark.sql(f"DROP TABLE IF EXISTS {name}")
        for _ in range(2):
            S.create_table(spark, name, schema, [day], str(tmp_path / name))
        assert set(spark.table(name).columns) == set(schema.names)
        spark.sql(f"DROP TABLE {name}")


def test_read_sessions_names_and_paths(spark, tmp_path):
    (tmp_path / "deep").mkdir()
    (tmp_path / "deep" / "s1").write_bytes("тест".encode("cp1251"))
    (row,) = read_sessions(spark, str(tmp_path)).collect()
    assert (row.session_id, row.content) == ("s1", "тест") and row.path.endswith("/deep/s1")


def test_files_of_one_name_are_two_sessions(spark, tmp_path):
    from tidemark.operators.sessionlog import parse_files
    from tidemark.sources.sessions import read_sessions

    for folder, query in (("a", "first"), ("b", "second")):
        (tmp_path / folder).mkdir()
        (tmp_path / folder / "s1").write_bytes(f"SESSION_START 01.01.2024_00:00:00\nQS 01.01.2024_00:00:01 {{{query}}}\n1 A_1".encode())
    events = parse_files(read_sessions(spark, str(tmp_path)), with_path=True).collect()
    assert sorted((r.path[-4:], r.session_id, r.event_seq, r.query_text) for r in events if r.event_type == "QS") == [
        ("a/s1", "s1", 1, "first"), ("b/s1", "s1", 1, "second")
    ]


def test_derived_tables_follow_their_input(spark, sf_dir, tmp_path):
    from tidemark.catalog import REGISTRY

    folder = str(tmp_path / "tables")
    events = spark.read.parquet(f"{sf_dir}/events.parquet")
    events.write.parquet(f"{folder}/events.parquet")
    before = REGISTRY["dash_event_count"].build(spark, folder).collect()
    events.limit(100).write.mode("overwrite").parquet(f"{folder}/events.parquet")
    assert REGISTRY["dash_event_count"].build(spark, folder).collect() != before


def test_staged_tables_go_with_their_scope(spark, tmp_path):
    import os

    from tidemark.lineage import staged, written

    with staged(spark):
        kept = written(spark.range(3), "scoped")
        (path,) = {os.path.dirname(f.removeprefix("file://")) for f in kept.inputFiles()}
        assert os.path.isdir(path) and kept.count() == 3
    assert not os.path.exists(path)


def test_export_drops_copies_and_files_undated_rows(spark, tmp_path):
    rows = [(1, date(2024, 1, 1)), (1, date(2024, 1, 1)), (2, None)]
    S.write_export(spark.createDataFrame(rows, "id int, day date"), str(tmp_path / "e"), "day", keys=["id"], undated=True)
    assert sorted((r.id, r.part) for r in spark.read.parquet(str(tmp_path / "e")).collect()) == [(1, 20240101), (2, 19700101)]
