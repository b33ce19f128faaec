"""Periodic runs against comparison of every pair of words."""

import hashlib
import zlib

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from tidemark.llm import runs
from tidemark.llm.queries import QUERIES


def brute(words, least=12):
    found, n = [], len(words)
    for period in range(1, n // 2 + 1):
        at = 0
        while at + period < n:
            end = at
            while end + period < n and words[end] == words[end + period]:
                end += 1
            part = words[at : end + period]
            if end > at and len(part) >= max(least, 2 * period):
                if not any(part[r:] == part[:-r] for r in range(1, period)):
                    found.append((at, len(part), period))
            at = end + 1
    return sorted(found, key=lambda r: (r[0], r[2]))


def found_in(lists):
    numbers = [np.array([*w, -2 - k], np.int64) for k, w in enumerate(lists)]
    return [tuple(r) for r in runs.find_runs(np.concatenate(numbers), max(map(len, lists))).tolist()]


def wanted(lists):
    starts = np.cumsum([0, *[len(w) + 1 for w in lists]])
    return [(int(s) + a, n, q) for s, w in zip(starts, lists) for a, n, q in brute(w)]


unit = st.lists(st.integers(0, 2), min_size=1, max_size=40)
repeated = st.tuples(unit, st.integers(1, 5)).map(lambda x: x[0] * x[1])
text = st.lists(repeated, max_size=5).map(lambda parts: [w for p in parts for w in p])


@settings(max_examples=150, deadline=None)
@given(st.lists(text, min_size=1, max_size=3))
def test_all_runs_are_found(lists):
    assert found_in(lists) == wanted(lists)


@pytest.mark.parametrize("a, b", [(50, 50), (9, 40), (33, 12)])
def test_two_progressions_hold_runs_of_many_periods(a, b):
    lists = [[0, 1] * a + [1, 0] * b, ([0] * a + [1]) * 3 + [0] * b, [0] * 300]
    assert found_in(lists) == wanted(lists)


def test_query(spark, sf_dir):
    rows = {r["doc_id"]: r for r in QUERIES["op11_periodic_runs"](spark, sf_dir).collect()}
    docs = {r["doc_id"]: r["text"] for r in spark.read.parquet(f"{sf_dir}/documents.parquet").collect()}
    assert rows.keys() == docs.keys()
    checked = 0
    for i, t in docs.items():
        words, h = t.encode().split(), zlib.crc32(str(i).encode())
        if len(words) > 700:
            continue
        if h % 10 == 0 and words:
            a = (h // 10) % len(words)
            p = 1 + (len(words) - a) // (3 + (h // 10) % 8)
            words = words[:a] + [words[a + (k - a) % p] for k in range(a, len(words))]
        want, row = brute(words), rows[i]
        lines = "".join(f"{a},{n},{q}\n" for a, n, q in want)
        gone = {k for a, n, q in want for k in range(a + q, a + n)}
        left = b" ".join(w for k, w in enumerate(words) if k not in gone)
        assert row["n_runs"] == len(want)
        assert row["runs_sha256"] == hashlib.sha256(lines.encode()).hexdigest()
        assert row["collapsed_sha256"] == hashlib.sha256(left).hexdigest()
        best = min(want, key=lambda r: (-r[1], r[0], r[2]), default=None)
        shown = (row["start"], row["length"], row["period"], row["exponent_milli"])
        assert shown == ((*best, 1000 * best[1] // best[2]) if best else (None,) * 4)
        checked += len(want)
    assert checked


def test_odd_rows(spark):
    words = " ".join("ab c d e f g h i j".split() * 3)
    rows = [(1, None, 0), (2, "", 0), (3, " \t\n", 0), (None, "a " * 12, 0), (4, "A a " * 6, 1), (4, "A a " * 6, 1), (5, "x\u00a0 " * 40_000, 1), (6, words, 2)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, runs int")
    found = sorted(((r["doc_id"], r["n_words"], [tuple(x) for x in r["runs"]], r["collapsed"][:9]) for r in runs.periodic_runs(docs).collect()), key=str)
    twice = (4, 12, [(0, 12, 2)], "A a")
    want = [(1, 0, [], ""), (2, 0, [], ""), (3, 0, [], ""), (None, 12, [(0, 12, 1)], "a"), twice, twice, (5, 40_000, [(0, 40_000, 1)], "x\u00a0"), (6, 27, [(0, 27, 9)], "ab c d e ")]
    assert found == sorted(want, key=str)
    assert runs.periodic_runs(docs.limit(0)).count() == 0
    named = docs.selectExpr("cast(doc_id as string) AS `a.b`", "text AS doc_id")
    assert runs.periodic_runs(named, id_col="a.b", text_col="doc_id").filter("doc_id = '6'").first()["n_words"] == 27
