"""Repair of conversation structure by a dynamic program with square-root checkpoints.

The rows of a conversation, ordered by (turn, role, text), nulls first, must become a sequence of roles that is empty or
an optional system row and then pairs of user and assistant. Edits and what they cost:

* K, keep a row: 0;
* R, give a row the role user or assistant: 3;
* D, delete a row: 4 (blank and repeated rows must be deleted);
* I, insert an empty user or assistant row: 3;
* a row that is cut off and not deleted: 3 more.

The cost of what is left, for each of four states (nothing yet, after system, after user, after assistant), is worked out from
the end. Only the vectors at every sqrt(n)-th row are stored; the walk from the start works out the vectors of one block at a
time again and takes, among the edits that keep the total least ("tight"), the one with the least letter. A letter leaves one
next state, so this gives the cheapest edits that come first in the order of ASCII.

Vectors are kept relative to their least entry; these differ by a few edits at most, so there are few, and steps
between them are looked up after they were met once.

Spark groups equal rows, finds the first of each repeated text and sorts a conversation's rows into one task, which reads
them as a stream and holds a byte for each row, less than the edits it returns. Texts are sorted once more beside the edits,
and each repaired text goes through its hash as it is read: no conversation is held as a whole.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from itertools import repeat
from math import isqrt

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import arrow_schema, col, stage

START, SYSTEM, USER, ASSISTANT = range(4)
NEXT = (USER, USER, ASSISTANT, USER)  # the state after a user or assistant row; no other of the two may follow
INITIALS = {"s": 0, "u": 1, "a": 2}
OTHER = 3
MUST_GO, CUT = 4, 8  # added to the initial's number in a row's code
DELETE, REROLE, INSERT, CUT_OFF = 4, 3, 3, 3
NEVER = 1 << 20
END = (0, NEVER, NEVER, 0)
COPIES, ORDER = "repair_copies", ["conv_id", "turn", "role", "digest"]

Vector = tuple[int, int, int, int]


def relaxed(costs: list[int]) -> list[int]:
    """Costs when rows may be inserted first: going round user and assistant twice gains nothing."""
    for _ in range(3):
        costs = [min(c, INSERT + costs[NEXT[state]]) for state, c in enumerate(costs)]
    return costs


def kept_state(state: int, initial: int) -> int | None:
    """The state after a kept row, or None where its role may not stand there."""
    if initial == 0:
        return SYSTEM if state == START else None
    wanted = NEXT[state]
    return wanted if initial != OTHER and wanted == initial + 1 else None


class Steps:
    """Cost vectors by number, and what was found for (vector, row) before."""

    def __init__(self):
        self.vectors: list[Vector] = []
        self.numbers: dict[Vector, int] = {}
        self.back: dict[int, tuple[int, int]] = {}
        self.walks: dict[int, tuple[bytes, int, int]] = {}
        self.end = self.number(relaxed(list(END)))[0]

    def number(self, costs: list[int]) -> tuple[int, int]:
        """The number of a vector relative to its least entry, and that entry."""
        least = min(costs)
        vector = tuple(min(c - least, NEVER) for c in costs)
        if vector not in self.numbers:
            self.numbers[vector] = len(self.vectors)
            self.vectors.append(vector)
        return self.numbers[vector], least

    def options(self, state: int, code: int) -> list[tuple[bytes, int, int]]:
        """Letter, cost and next state of what may become of a row, letters in the order of ASCII."""
        found = [(b"D", DELETE, state)]
        if not code & MUST_GO:
            more = CUT_OFF if code & CUT else 0
            if (kept := kept_state(state, code & 3)) is not None:
                found.append((b"K", more, kept))
            found.append((b"R", REROLE + more, NEXT[state]))
        return found

    def before(self, after: int, code: int) -> tuple[int, int]:
        """The vector before a row and what to add to it, from the vector after it."""
        key = after << 4 | code
        if key not in self.back:
            rest = self.vectors[after]
            self.back[key] = self.number(relaxed([min(cost + rest[to] for _, cost, to in self.options(state, code)) for state in range(4)]))
        return self.back[key]

    def walk(self, after: int, code: int, state: int) -> tuple[bytes, int, int]:
        """Letters up to and with a row's own, the state after it and their cost."""
        key = (after << 4 | code) << 2 | state
        if key not in self.walks:
            rest = self.vectors[after]
            row = [min(cost + rest[to] for _, cost, to in self.options(s, code)) for s in range(4)]
            best = relaxed(row)
            letters, paid, at = b"", 0, state
            while True:
                chosen = [(b"D", DELETE, at)] if DELETE + rest[at] == best[at] else []
                if not chosen and INSERT + best[NEXT[at]] == best[at]:
                    letters, paid, at = letters + b"I", paid + INSERT, NEXT[at]
                    continue
                letter, cost, to = (chosen or [o for o in self.options(at, code) if o[1] + rest[o[2]] == best[at]])[0]
                self.walks[key] = (letters + letter, to, paid + cost)
                break
        return self.walks[key]


def cheapest(codes: bytes, steps: Steps) -> tuple[int, bytes]:
    """Cost and letters of the cheapest edits of the coded rows; of equal cost, the letters that come first."""
    n = len(codes)
    width = max(1, isqrt(n))
    marks = {}
    at = steps.end
    for i in range(n - 1, -1, -1):
        if (i + 1) % width == 0 or i == n - 1:
            marks[i // width] = at  # the vector after the block's last row
        at = steps.before(at, codes[i])[0]
    state, cost, letters = START, 0, []
    for block in range(-(-n // width)):
        first, last = block * width, min(n, (block + 1) * width)
        after = [marks[block]]
        for i in range(last - 1, first, -1):
            after.append(steps.before(after[-1], codes[i])[0])
        for i in range(first, last):
            found, state, paid = steps.walk(after.pop(), codes[i], state)
            letters.append(found)
            cost += paid
    while state not in (START, ASSISTANT):
        letters.append(b"I")
        state, cost = NEXT[state], cost + INSERT
    return cost, b"".join(letters)


def code_of(role: str | None, must_go: bool, cut: bool) -> int:
    return INITIALS.get((role or "")[:1], OTHER) | (MUST_GO if must_go else CUT if cut else 0)


def prepared(rows: DataFrame, copies: str | None) -> DataFrame:
    """Equal rows as one with their number; null roles and texts are one space. No copies: the conversation is named, no more."""
    number = col(copies) if copies else F.lit(1)
    chosen = rows.select(
        col("conv_id").alias("conv_id"),
        col("turn").alias("turn"),
        F.coalesce(col("role"), F.lit(" ")).alias("role"),
        F.coalesce(col("text"), F.lit(" ")).alias("text"),
        F.coalesce(number.cast("long"), F.lit(0)).alias(COPIES),
    )
    # Rows that are not there any more keep their conversation in the table, but no text.
    chosen = chosen.select("conv_id", *[F.when(F.col(COPIES) > 0, F.col(c)).alias(c) for c in ("turn", "role", "text")], COPIES)
    return chosen.groupBy("conv_id", "turn", "role", "text").agg(F.sum(COPIES).alias(COPIES)).withColumn("digest", F.sha2("text", 256))


def coded(rows: DataFrame) -> DataFrame:
    """Without the texts: whether each row is blank, cut off, and holds the first place of its role and text."""
    word = r"[^\x20\x09-\x0D]"
    end = F.regexp_extract("text", rf"({word})[\x20\x09-\x0D]*\z", 1)
    facts = rows.select(*ORDER, COPIES, (end == "").alias("blank"), (~end.rlike(r"[.!?]")).alias("cut"))
    first = facts.filter(f"{COPIES} > 0").groupBy("conv_id", "role", "digest").agg(F.min(F.struct(F.col("turn").isNotNull().alias("known"), "turn")).alias("first"))
    same = [F.col(f"f.{c}").eqNullSafe(F.col(f"r.{c}")) for c in ("conv_id", "role", "digest")]
    met = facts.alias("r").join(first.alias("f"), same[0] & same[1] & same[2], "left")
    return met.select(*[F.col(f"r.{c}") for c in ORDER], COPIES, "blank", "cut", F.col("first.turn").eqNullSafe(F.col("r.turn")).alias("first"))


class Conversation:
    """What is gathered of one conversation as its rows come by."""

    def __init__(self, conv_id):
        self.conv_id = conv_id
        self.codes = bytearray()
        self.blank = self.duplicate = self.truncated = self.illegal = self.turns = 0
        self.low = self.high = self.last = None
        self.before: str | None = None

    def add(self, turn, role, copies, blank, cut, first) -> None:
        initial = role[:1]
        if turn is not None:
            self.low = turn if self.low is None else self.low
            self.turns += turn != self.last
            self.high = self.last = turn
        if self.before is not None:
            self.illegal += self.before + initial not in ("su", "ua", "au")
        self.illegal += copies - 1
        self.before = initial
        fresh = 1 if first and not blank else 0
        if blank:
            self.blank += copies
        else:
            self.duplicate += copies - fresh
            self.truncated += bool(fresh and cut)
        if fresh:
            self.codes.append(code_of(role, False, cut))
        self.codes.extend(repeat(code_of(role, True, False), copies - fresh))

    def row(self, steps: Steps) -> tuple:
        cost, letters = cheapest(bytes(self.codes), steps)
        gaps = 0 if self.low is None else self.high - self.low + 1 - self.turns
        return self.conv_id, gaps, self.blank, self.duplicate, self.truncated, self.illegal, cost, letters.decode()


def judged(rows: DataFrame) -> DataFrame:
    """A row for each conversation: its faults, the cost of its repair and the edits."""
    kind = rows.schema["conv_id"].dataType.simpleString()
    counts = ["gaps", "blank", "duplicate", "truncated", "illegal", "cost"]
    id_type = arrow_schema(rows.select("conv_id").schema).field("conv_id").type

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        steps, held, done, size = Steps(), None, [], 0
        names = ["conv_id", *counts, "audit"]
        types = [id_type, *[pa.int64()] * len(counts), pa.string()]

        def packed():
            made = pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*done), types)], names=names)
            done.clear()
            return made

        for batch in batches:
            for conv_id, turn, role, copies, blank, cut, first in zip(*(c.to_pylist() for c in batch.columns)):
                if held is None or held.conv_id != conv_id:
                    if held is not None:
                        done.append(held.row(steps))
                        size += len(done[-1][-1]) + 100
                    held = Conversation(conv_id)
                    if size > 1 << 20:
                        yield packed()
                        size = 0
                if copies:
                    held.add(turn, role, copies, blank, cut, first)
        if held is not None:
            done.append(held.row(steps))
        if done:
            yield packed()

    sorted_rows = rows.repartition("conv_id").sortWithinPartitions(*ORDER).select("conv_id", "turn", "role", COPIES, "blank", "cut", "first")
    return sorted_rows.mapInArrow(run, f"conv_id {kind}, {', '.join(f'{c} long' for c in counts)}, audit string")


class Repair:
    """The hash of one conversation's repaired rows, as its rows come by."""

    def __init__(self, audit: str):
        self.digest, self.state, self.at, self.any = hashlib.sha256(), START, 0, False
        self.audit = audit

    def emit(self, role: str, text: str, state: int) -> None:
        self.digest.update(f"{'\n' if self.any else ''}{role}:{text}".encode("utf-8", "replace"))
        self.any, self.state = True, state

    def inserts(self) -> None:
        while self.audit[self.at : self.at + 1] == "I":
            self.at += 1
            self.emit("user" if NEXT[self.state] == USER else "assistant", "", NEXT[self.state])

    def add(self, role: str, text: str, copies: int) -> None:
        for _ in range(copies):
            self.inserts()
            letter = self.audit[self.at]
            self.at += 1
            if letter == "K":
                self.emit(role, text, SYSTEM if self.state == START and role[:1] == "s" else NEXT[self.state])
            elif letter == "R":
                self.emit("user" if NEXT[self.state] == USER else "assistant", text, NEXT[self.state])

    def hexadecimal(self) -> str:
        self.inserts()
        return self.digest.hexdigest()


def hashed(rows: DataFrame, found: DataFrame) -> DataFrame:
    """The hash of each conversation's repaired ``role:text`` lines: its edits come first, then its rows in order."""
    kind = rows.schema["conv_id"].dataType.simpleString()
    id_type = arrow_schema(rows.select("conv_id").schema).field("conv_id").type
    lines = rows.filter(f"{COPIES} > 0").select(*ORDER, "text", COPIES)
    heads = found.select("conv_id", *[F.lit(None).cast(lines.schema[c].dataType).alias(c) for c in ("turn", "role", "digest")], F.col("audit").alias("text"), F.lit(0).cast("long").alias(COPIES))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        conv_id, held = None, None
        for batch in batches:
            ids, digests = [], []
            for at in range(0, batch.num_rows, 256):
                for key, role, text, copies in zip(*(c.to_pylist() for c in batch.slice(at, 256).columns)):
                    if not copies:
                        if held is not None:
                            ids.append(conv_id)
                            digests.append(held.hexadecimal())
                        conv_id, held = key, Repair(text)
                    else:
                        held.add(role, text, copies)
            yield pa.RecordBatch.from_arrays([pa.array(ids, id_type), pa.array(digests, pa.string())], names=["conv_id", "repaired_sha256"])
        if held is not None:
            yield pa.RecordBatch.from_arrays([pa.array([conv_id], id_type), pa.array([held.hexadecimal()])], names=["conv_id", "repaired_sha256"])

    together = lines.union(heads.select(*lines.columns)).withColumn("line", F.col(COPIES) > 0)
    ordered = together.repartition("conv_id").sortWithinPartitions("conv_id", "line", *ORDER[1:])
    return ordered.select("conv_id", "role", "text", COPIES).mapInArrow(run, f"conv_id {kind}, repaired_sha256 string")


def repair(rows: DataFrame, copies: str | None = None) -> DataFrame:
    """A row for each conv_id: gaps, blank, duplicate, truncated, illegal, cost, audit, repaired_sha256.

    Rows: conv_id, turn, role, text; ``copies`` may name a column with how often a row stands there (0: not, but its conversation
    counts). A row's first fault counts: blank, duplicate (role and text were met before), truncated (does not end with
    ``.``, ``!`` or ``?``). ``gaps`` are the whole numbers between the least and the greatest turn that no row has, ``illegal`` the
    neighbours that are not system-user, user-assistant or assistant-user. A role counts by its first letter; an
    empty role is like an unknown one. Null roles and texts are one space. A null turn comes first and is no turn; rows of one turn are
    ordered by role and text hash. A null conv_id is a conversation of its own. A conversation without rows has zeros, no edits and the
    hash of the empty text; without conversations the result is empty. Other columns are ignored.
    """
    given = stage(prepared(rows, copies), "conversation-rows")
    found = stage(judged(coded(given)), "conversation-edits")
    digests = hashed(given, found)
    same = F.col("f.conv_id").eqNullSafe(F.col("d.conv_id"))
    return found.alias("f").join(digests.alias("d"), same).select("f.*", "d.repaired_sha256")
