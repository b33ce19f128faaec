"""Conversation repair against a search of all edits."""

import hashlib
import re
import zlib
from functools import cache

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from tidemark.llm import repair
from tidemark.llm.queries import QUERIES

SPACE = "\x20\x09-\x0d"


def fault(role, text, seen):
    if not re.search(f"[^{SPACE}]", text):
        return "blank"
    if (role, text) in seen:
        return "duplicate"
    return "" if re.search(f"[^{SPACE}]", text[::-1])[0] in ".!?" else "truncated"


def edits(rows):
    """rows: (role, text, fault). Least (cost, letters) and the lines left, by trying every edit at every place."""

    @cache
    def rest(i, made, inserted):
        found = []
        if re.fullmatch("(s?(ua)+)?", made) and i == len(rows):
            found.append((0, "", ()))
        if not re.match("s?(ua)*u?$", made):
            return (10**6, "", ())
        short = made if len(made) < 3 else made[0] * (made[0] == "s") + "ua" + made[-1] * (made[-1] == "u")
        if inserted < 3:
            for role in ("user", "assistant"):
                c, l, t = rest(i, short + role[0], inserted + 1)
                found.append((c + 3, "I" + l, (f"{role}:", *t)))
        if i < len(rows):
            role, text, wrong = rows[i]
            c, l, t = rest(i + 1, short, 0)
            found.append((c + 4, "D" + l, t))
            if wrong in ("", "truncated"):
                more = 3 * (wrong == "truncated")
                for new, letter, cost in ((role, "K", 0), ("user", "R", 3), ("assistant", "R", 3)):
                    if new[:1] in "sua" and new:
                        c, l, t = rest(i + 1, short + new[0], 0)
                        found.append((c + cost + more, letter + l, (f"{new}:{text}", *t)))
        return min(found, default=(10**6, "", ()))

    return rest(0, "", 0)


def wanted(rows):
    """rows: (turn, role, text) of one conversation as they stand."""
    rows = sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0, r[1], hashlib.sha256(r[2].encode()).hexdigest()))
    seen, judged = set(), []
    for _, role, text in rows:
        judged.append((role, text, fault(role, text, seen)))
        seen.add((role, text))
    cost, letters, lines = edits(judged)
    turns = {t for t, _, _ in rows if t is not None}
    count = [w for _, _, w in judged]
    return {
        "gaps": max(turns) - min(turns) + 1 - len(turns) if turns else 0, "blank": count.count("blank"),
        "duplicate": count.count("duplicate"), "truncated": count.count("truncated"),
        "illegal": sum(a[0][:1] + b[0][:1] not in ("su", "ua", "au") for a, b in zip(judged, judged[1:])),
        "cost": cost, "audit": letters, "repaired_sha256": hashlib.sha256("\n".join(lines).encode()).hexdigest(),
    }


def shown(row):
    return {k: v for k, v in row.asDict().items() if k != "conv_id"}


codes = st.lists(st.sampled_from([repair.code_of(r, go, cut) for r in ("system", "user", "assistant", "tool") for go, cut in ((0, 0), (1, 0), (0, 1))]), max_size=9)


@settings(max_examples=300, deadline=None)
@given(codes)
def test_cheapest_edits(found):
    names, faults = ("system", "user", "assistant", "tool"), {0: "", repair.MUST_GO: "blank", repair.CUT: "truncated"}
    rows = [(names[c & 3], "x", faults[c & 12]) for c in found]
    cost, letters, _ = edits(rows)
    assert repair.cheapest(bytes(found), repair.Steps()) == (cost, letters.encode())


def test_blocks_do_not_change_the_edits():
    whole = bytes([1, 2, 1, 1, 2, 9, 5, 2, 3, 1] * 700)
    steps = repair.Steps()
    cost, letters = repair.cheapest(whole, steps)
    assert len(letters) - letters.count(b"I") == len(whole) and len(steps.vectors) < 100
    priced = 4 * letters.count(b"D") + 3 * letters.count(b"I") + 3 * letters.count(b"R")
    left = [c for c, k in zip(whole, letters.replace(b"I", b"")) if chr(k) != "D"]
    assert cost == priced + 3 * sum(c & repair.CUT > 0 for c in left)


def test_query(spark, sf_dir):
    given_rows = [tuple(r) for r in spark.read.parquet(f"{sf_dir}/conversations.parquet").select("conv_id", "turn", "role", "text").collect()]
    held = {}
    for conv, turn, role, text in given_rows:
        kind = zlib.crc32(f"{conv}:{turn}".encode()) % 20
        text = "" if kind == 1 else re.sub("[.!?]", "", text) if kind == 2 else text
        row = (turn, "user" if kind == 4 else role, text)
        held.setdefault(conv, []).extend([] if kind == 0 else [row] * (1 + (kind == 3)))
    found = {r["conv_id"]: shown(r) for r in QUERIES["op12_conversation_repair"](spark, sf_dir).collect()}
    assert found.keys() == held.keys()
    assert found == {conv: wanted(rows) for conv, rows in held.items()}
    assert len({r["audit"] for r in found.values()}) > 3


@pytest.mark.parametrize("parts", [1, 7])
def test_odd_rows(spark, parts):
    many = [(5, t, "user" if t % 2 else "assistant", "same text") for t in range(3000)]
    rows = [
        (1, 0, "user", None), (1, 1, None, "What?"), (1, None, "user", "First."), (1, 9, "", "none"), (1, 9, "", "none"), (1, 9, "tool", "no."),
        (2, None, None, None), (None, 3, "user", "Hi."), (None, 4, "assistant", "é日🙂!  \t"), (3, -5, "User", "x "), (3, 7, "system", "a\n"), *many,
    ]
    shape = "conv_id long, turn long, role string, text string"
    df = spark.createDataFrame([(*r, 1, "x") for r in rows], shape + ", repair_copies int, first string").repartition(parts)
    held = {}
    for conv, turn, role, text in rows:
        held.setdefault(conv, []).append((turn, " " if role is None else role, " " if text is None else text))
    found = {r["conv_id"]: r for r in repair.repair(df).collect()}
    big = found.pop(5)
    assert big["duplicate"] == 2998 and big["gaps"] == 0 and big["audit"].count("D") >= 2998
    held.pop(5)
    assert {k: shown(r) for k, r in found.items()} == {k: wanted(v) for k, v in held.items()}
    gone = repair.repair(df.selectExpr("conv_id", "turn", "role", "text", "0 AS n"), "n").collect()
    empty = {"gaps": 0, "blank": 0, "duplicate": 0, "truncated": 0, "illegal": 0, "cost": 0, "audit": "", "repaired_sha256": hashlib.sha256(b"").hexdigest()}
    assert len(gone) == 5 and all(shown(r) == empty for r in gone)
    assert repair.repair(df.limit(0)).count() == 0
