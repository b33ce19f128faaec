"""Periodic runs of words, found by minimizers at several scales.

A run is a stretch of consecutive words with smallest period q, at least ``max(least, 2 * q)`` words long, that no
neighbouring word extends. Periods below 8 are read off directly: words are compared with those q places on. Longer ones go by
scales: at scale s, for periods from 2^s to 2^(s+1) - 1, a minimizer is the least hash of the k = 2^(s-1) word sequences that
start in a window and end within 2^s words of its start. A window in the first period of a run comes again one period later
with the same words, so its least sequence is chosen at both places: every run holds a pair of equal minimizers at the
distance of its period. Each pair is a seed that is extended both ways; what is long enough and has no shorter period is a
run.

Sequences that repeat at half their length or less lie in a run of a shorter period. Their places form progressions, and two
places of one progression can seed nothing new. Of two progressions, all places of one are paired with the first place of
the other: this meets every distance between them, so a text of one repeated word costs as much as any other.

Texts are worked on together, several at a time, with a unique word between them. Sequences are compared by 64-bit values
built by doubling (the first level is the exact word number). A text is held by one task; nothing is shuffled.
"""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Callable, Iterator
from itertools import count

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from tidemark.llm.common import arrow_schema, texts

SHORT = 8  # periods below this are compared directly
ROWS = 256  # texts taken out of a batch together
SLICE = 1 << 17  # words worked on together; a longer text is worked on alone
MIX_A, MIX_B = np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB)

Edit = Callable[[object, int], "np.ndarray | None"]


def mixed(values: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit values that spreads neighbours."""
    values = (values ^ (values >> np.uint64(30))) * MIX_A
    values = (values ^ (values >> np.uint64(27))) * MIX_B
    return values ^ (values >> np.uint64(31))


def doubled(level: np.ndarray, width: int) -> np.ndarray:
    """Values of sequences of 2 * width words from those of width words."""
    return mixed(level[:-width] * np.uint64(0x9E3779B97F4A7C15) + (level[width:] ^ (level[width:] >> np.uint64(17))))


def sliding(values: np.ndarray, width: int, of: Callable) -> np.ndarray:
    """``of`` (minimum or maximum) over each window of ``width`` values."""
    done = 1
    while 2 * done <= width:
        values, done = of(values[:-done], values[done:]), 2 * done
    return of(values[: len(values) - (width - done)], values[width - done :]) if done < width else values


class Sequences:
    """Equality of sequences of one array of word numbers."""

    def __init__(self, numbers: np.ndarray, longest: int):
        self.numbers = numbers
        self.levels = [mixed(numbers.astype(np.uint64) + np.uint64(1))]
        while (width := 1 << (len(self.levels) - 1)) * 2 <= min(longest, len(numbers)):
            self.levels.append(doubled(self.levels[-1], width))

    def ahead(self, x: np.ndarray, y: np.ndarray) -> np.ndarray:
        """How many words from x on equal those from y on (x < y)."""
        return self._common(x, y, 1)

    def behind(self, x: np.ndarray, y: np.ndarray) -> np.ndarray:
        """How many words before x equal those before y (x < y)."""
        return self._common(x, y, -1)

    def _common(self, x: np.ndarray, y: np.ndarray, way: int) -> np.ndarray:
        length = np.zeros(len(x), np.int64)
        top = len(self.levels) - 1
        open_ = np.arange(len(x))
        while len(open_):  # whole sequences of the top level may follow each other
            open_ = open_[self._step(x, y, way, length, open_, top)]
        for level in range(top - 1, -1, -1):
            self._step(x, y, way, length, np.arange(len(x)), level)
        return length

    def _step(self, x, y, way, length, which, level) -> np.ndarray:
        values, width = self.levels[level], 1 << level
        if way > 0:
            a, b = x[which] + length[which], y[which] + length[which]
            inside = b < len(values)
        else:
            a, b = x[which] - length[which] - width, y[which] - length[which] - width
            inside = a >= 0
        equal = np.zeros(len(which), bool)
        equal[inside] = values[a[inside]] == values[b[inside]]
        length[which[equal]] += width
        return equal


def short_runs(numbers: np.ndarray, period: int, least: int) -> tuple[np.ndarray, np.ndarray]:
    """Starts and lengths of the longest stretches of this period, by direct comparison."""
    same = np.concatenate([[False], numbers[:-period] == numbers[period:], [False]])
    edges = np.flatnonzero(same[1:] != same[:-1])
    starts, lengths = edges[::2], edges[1::2] - edges[::2] + period
    kept = lengths >= max(least, 2 * period)
    return starts[kept], lengths[kept]


def occurrences(values: np.ndarray, width: int) -> np.ndarray:
    """Places of the minimizers of windows of ``width + 1`` sequences, ties included."""
    least = sliding(values, width + 1, np.minimum)
    edge = np.zeros(width, np.uint64)
    return np.flatnonzero(sliding(np.concatenate([edge, least, edge]), width + 1, np.maximum) == values)


def seeds(values: np.ndarray, width: int) -> tuple[np.ndarray, np.ndarray]:
    """Places x and distances from 2 * width to 4 * width - 1 at which equal minimizers meet."""
    if len(values) < width + 2:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    places = occurrences(values, width)
    order = np.lexsort((places, values[places]))
    places = places[order]
    same = values[places[1:]] == values[places[:-1]]
    near = same & (np.diff(places) < 4 * width)
    places = places[np.concatenate([near, [False]]) | np.concatenate([[False], near])]
    if not len(places):
        return places, places
    tight = np.zeros(len(places), bool)
    tight[1:] = (values[places[1:]] == values[places[:-1]]) & (np.diff(places) <= width // 2)
    if tight.any():  # progressions: take every place of these sequences, not the minimizers alone
        repeating = np.unique(values[places[tight]])
        at = np.minimum(np.searchsorted(repeating, values), len(repeating) - 1)
        places = np.union1d(places, np.flatnonzero(repeating[at] == values))
        places = places[np.lexsort((places, values[places]))]
    group = np.concatenate([[0], np.cumsum(values[places[1:]] != values[places[:-1]])])
    breaks = np.concatenate([[True], (group[1:] != group[:-1]) | (np.diff(places) > width // 2)])
    progression = np.cumsum(breaks) - 1
    first = np.flatnonzero(breaks)
    found = []
    n = len(first)
    for step in range(1, n):  # progressions of one sequence are over width / 2 apart: at most 8 within 4 * width
        left, right = np.arange(n - step), np.arange(step, n)
        last = np.concatenate([first[1:], [len(places)]]) - 1
        reach = (group[first[left]] == group[first[right]]) & (places[first[right]] - places[last[left]] < 4 * width)
        if not reach.any():
            break
        partner = np.full(n, -1)
        partner[left[reach]] = right[reach]
        mine = np.flatnonzero(partner[progression] >= 0)
        found.append((places[mine], places[first[partner[progression[mine]]]]))
        partner[:] = -1
        partner[right[reach]] = left[reach]
        mine = np.flatnonzero(partner[progression] >= 0)
        found.append((places[first[partner[progression[mine]]]], places[mine]))
    if not found:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    x, y = (np.concatenate([f[k] for f in found]) for k in (0, 1))
    kept = (y - x >= 2 * width) & (y - x < 4 * width)
    pairs = np.unique(np.stack([x[kept], (y - x)[kept]]), axis=1)
    return pairs[0], pairs[1]


def prime_factors(n: int) -> list[int]:
    found, f = [], 2
    while f * f <= n:
        if n % f == 0:
            found.append(f)
            while n % f == 0:
                n //= f
        f += 1
    return found + [n] * (n > 1)


def find_runs(numbers: np.ndarray, longest: int, least: int = 12) -> np.ndarray:
    """Rows (start, length, period), in this order, of all runs; ``longest`` bounds the length of a run."""
    found = []
    for period in range(1, min(SHORT - 1, len(numbers) - 1) + 1):
        starts, lengths = short_runs(numbers, period, least)
        found.append(np.stack([starts, lengths, np.full(len(starts), period)], axis=1))
    whole = Sequences(numbers, longest)
    width = SHORT // 2
    while 4 * width <= longest and width.bit_length() <= len(whole.levels):
        x, distance = seeds(whole.levels[width.bit_length() - 1], width)
        if len(x):
            back = whole.behind(x, x + distance)
            rows = np.unique(np.stack([x - back, distance], axis=1), axis=0)
            ahead = whole.ahead(rows[:, 0], rows[:, 0] + rows[:, 1])
            rows = np.column_stack([rows[:, 0], ahead + rows[:, 1], rows[:, 1]])
            found.append(rows[rows[:, 1] >= np.maximum(least, 2 * rows[:, 2])])
        width *= 2
    rows = np.concatenate(found) if found else np.zeros((0, 3), np.int64)
    if len(rows):
        pairs = [(i, int(q) // f) for i, q in enumerate(rows[:, 2].tolist()) for f in prime_factors(q)]
        which, shorter = (np.array(c, np.int64) for c in zip(*pairs)) if pairs else (np.zeros(0, np.int64),) * 2
        start = rows[which, 0]
        kept = np.ones(len(rows), bool)
        kept[which[whole.ahead(start, start + shorter) >= rows[which, 1] - shorter]] = False
        rows = rows[kept]
    return rows[np.lexsort((rows[:, 1], rows[:, 2], rows[:, 0]))]


def covered(n: int, rows: np.ndarray) -> np.ndarray:
    """Which of n words a run contains after its first period."""
    change = np.zeros(n + 1, np.int64)
    np.add.at(change, rows[:, 0] + rows[:, 2], 1)
    np.add.at(change, rows[:, 0] + rows[:, 1], -1)
    return np.cumsum(change[:-1]) > 0


def slices(batches: Iterator[pa.RecordBatch], edit: Edit | None) -> Iterator[list[tuple[object, list[bytes], np.ndarray | None]]]:
    """Ids, words and the order of the words to take (None: as they are), some texts at a time."""
    held, size = [], 0
    for batch in batches:
        for part in (batch.slice(at, ROWS) for at in range(0, batch.num_rows, ROWS)):
            for doc_id, text in zip(part.column("doc_id").to_pylist(), part.column("text").cast(pa.binary()).to_pylist()):
                found = text.split()
                if held and size + len(found) > SLICE:
                    yield held
                    held, size = [], 0
                held.append((doc_id, found, edit(doc_id, len(found)) if edit else None))
                size += len(found)
    if held:
        yield held


def periodic_runs(docs: DataFrame, least: int = 12, id_col: str = "doc_id", text_col: str = "text", edit: Edit | None = None) -> DataFrame:
    """A row for each document: doc_id, n_words, runs (start, length, period of each, in this order) and collapsed text.

    Words are separated by ASCII white space. ``collapsed`` joins by one space the words that no run contains after its first
    period. ``edit(id, n)`` may give the numbers of the words to take instead of the n words of a text. A null or empty
    text, or one of white space, has no words, no runs and an empty collapsed text. Repeated rows stay; other columns are ignored.
    """
    chosen = texts(docs, id_col, text_col)
    id_type = arrow_schema(chosen.schema).field("doc_id").type
    fields = ["start", "length", "period"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for held in slices(batches, edit):
            known: dict[bytes, int] = defaultdict(count().__next__)
            parts, starts, lengths = [], [], []
            at = 0
            for k, (_, found, order) in enumerate(held):
                numbers = np.fromiter(map(known.__getitem__, found), np.int64, len(found))
                numbers = numbers if order is None else numbers[order]
                parts += [numbers, np.array([-2 - k], np.int64)]  # its own number between texts, equal to no word
                starts.append(at)
                lengths.append(len(numbers))
                at += len(numbers) + 1
            rows = find_runs(np.concatenate(parts), max(lengths), least)
            cut = np.searchsorted(rows[:, 0], [*starts, at])
            collapsed = []
            for k, (_, found, order) in enumerate(held):
                rows[cut[k] : cut[k + 1], 0] -= starts[k]
                kept = found if order is None else [found[i] for i in order.tolist()]
                if cut[k] < cut[k + 1]:
                    drop = covered(lengths[k], rows[cut[k] : cut[k + 1]])
                    kept = [w for w, gone in zip(kept, drop.tolist()) if not gone]
                collapsed.append(b" ".join(kept))
            items = pa.StructArray.from_arrays([pa.array(rows[:, i].astype(np.int64)) for i in range(3)], fields)
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array([h[0] for h in held], id_type), pa.array(lengths, pa.int64()),
                    pa.ListArray.from_arrays(pa.array(cut, pa.int32()), items), pa.array(collapsed, pa.binary()).cast(pa.string()),
                ],
                names=["doc_id", "n_words", "runs", "collapsed"],
            )

    shape = "array<struct<start: long, length: long, period: long>>"
    return chosen.mapInArrow(run, f"doc_id {chosen.schema['doc_id'].dataType.simpleString()}, n_words long, runs {shape}, collapsed string")
