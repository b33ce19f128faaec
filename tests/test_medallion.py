"""Marts and keyed refresh."""

from datetime import date

from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from tidemark.operators import medallion as G
from tidemark.sources.tables import write_by

EVENTS = "event_type string, event_date date, search_kind string, doc_id string, result_doc_ids array<string>"


def test_hits_count_repeats_and_skip_undated(spark):
    day = date(2024, 1, 1)
    rows = [
        ("CARD_SEARCH", day, "CARD", None, ["A", "A", "B"]), ("CARD_SEARCH", None, "CARD", None, ["A"]),
        ("QS", day, "QS", None, ["A"]), ("DOC_OPEN", day, "QS", "X", []), ("DOC_OPEN", day, "CARD", "X", []),
        ("DOC_OPEN", day, "QS", None, []), ("DOC_OPEN", None, "QS", "X", []),
    ]
    events = spark.createDataFrame(rows, EVENTS)
    assert {tuple(r) for r in G.card_hits_daily(events).collect()} == {(day, "A", 2), (day, "B", 1)}
    assert {tuple(r) for r in G.qs_opens_daily(events).collect()} == {(day, "X", 1)}


def test_hot_and_cold_make_the_full_mart(spark, sf_dir):
    from tidemark.catalog import logs

    events = logs.events(spark, sf_dir)
    for as_of in (date(2024, 1, 5), date(2024, 1, 20), date(2030, 1, 1)):
        cut = G.hot_since(as_of)
        parts = G.card_hits_daily(events, until=cut).unionByName(G.card_hits_daily(events, since=cut))
        assert sorted(parts.collect()) == sorted(G.card_hits_daily(events).collect())


@settings(max_examples=8, deadline=None)
@given(st.lists(st.tuples(st.integers(0, 4), st.integers(0, 6), st.integers(0, 9)), min_size=1, max_size=30))
def test_latest_by_key(spark, rows):
    df = spark.createDataFrame(rows, "k int, version int, value int")
    got = {r.k: (r.version, r.value) for r in G.latest_by_key(df, ["k"], "version", ["value"]).collect()}
    assert got == {k: max((v, x) for kk, v, x in rows if kk == k) for k, _, _ in rows}


def test_write_upsert_rewrites_only_touched_days(spark, tmp_path):
    path, schema = str(tmp_path / "mart"), "doc_id string, opens bigint, open_date date"
    d1, d2 = date(2024, 1, 1), date(2024, 1, 2)
    write_by(spark.createDataFrame([("a", 1, d1), ("b", 2, d1), ("a", 3, d2)], schema), path, "open_date")
    kept = {p.name for p in (tmp_path / "mart" / "open_date=2024-01-02").iterdir()}
    for _ in range(2):
        G.write_upsert(path, spark.createDataFrame([("b", 9, d1), ("c", 5, d1)], schema), ["open_date", "doc_id"], "open_date")
        got = {(r.doc_id, r.opens, r.open_date) for r in spark.read.parquet(path).collect()}
        assert got == {("a", 1, d1), ("b", 9, d1), ("c", 5, d1), ("a", 3, d2)}
    assert {p.name for p in (tmp_path / "mart" / "open_date=2024-01-02").iterdir()} == kept


def test_adaptive_cutoff(spark):
    mart = spark.createDataFrame([(date(2024, 1, 1),), (date(2024, 1, 9),)], "day date")

    def cutoff(df, as_of):
        return G.adaptive_cutoff(df, "day", as_of).collect()[0].cutoff

    assert cutoff(mart, date(2024, 1, 20)) == date(2024, 1, 9)
    assert cutoff(mart, date(2024, 1, 10)) == date(2024, 1, 7)
    assert cutoff(mart.filter(F.lit(False)), date(2024, 1, 10)) == date(2024, 1, 7)


def test_refresh_hot_then_cold_equals_full(spark, sf_dir, tmp_path):
    from datetime import datetime

    from tidemark.catalog import logs
    from tidemark.plans.refresh import refresh_mart

    stamped = logs.events(spark, sf_dir).withColumn("ingested_at", F.col("event_time"))
    source = str(tmp_path / "events")
    # Every event is stored twice; the refresh must count it once.
    for _ in range(2):
        write_by(stamped, source, "event_date", mode="append")
    as_of = datetime(2024, 1, 21)
    for mart, build in (("card_hits", G.card_hits_daily), ("qs_opens", G.qs_opens_daily)):
        path = str(tmp_path / mart)
        for mode in ("hot", "cold", "hot"):
            refresh_mart(spark, source, path, mart, as_of, mode)
        want = build(logs.events(spark, sf_dir))
        got = spark.read.parquet(path).select(*want.columns)
        assert sorted(map(tuple, got.collect())) == sorted(map(tuple, want.collect()))
        refresh_mart(spark, source, path, mart, as_of, "full")
        assert spark.read.parquet(path).select(*want.columns).count() == want.count()


def test_refresh_removes_days_without_rows(spark, tmp_path):
    from datetime import datetime

    from tidemark.plans.refresh import refresh_mart

    kinds = (
        "session_id string, event_seq int, event_type string, event_date date, search_kind string, doc_id string, "
        "result_doc_ids array<string>, ingested_at timestamp"
    )
    rows = [("s", i, "DOC_OPEN", date(2024, 1, d), "QS", "x", [], datetime(2024, 1, d)) for i, d in enumerate((5, 28, 29))]
    source, mart = str(tmp_path / "events"), str(tmp_path / "mart")
    write_by(spark.createDataFrame(rows, kinds), source, "event_date")
    refresh_mart(spark, source, mart, "qs_opens", datetime(2024, 1, 30), "full")
    spark.createDataFrame(rows[:2], kinds).write.mode("overwrite").option("partitionOverwriteMode", "static").partitionBy("event_date").parquet(source)
    refresh_mart(spark, source, mart, "qs_opens", datetime(2024, 1, 31), "hot")
    assert sorted(r.open_date.day for r in spark.read.parquet(mart).collect()) == [5, 28]
