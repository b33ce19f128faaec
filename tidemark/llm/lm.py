"""Language-model scores from an Elias-Fano n-gram trie.

Counting. Words are counted over all training texts, then bigrams, then trigrams. All are kept; a caller may prune bigrams
and trigrams seen fewer than ``least`` times, and then trigrams are counted only where their two bigrams are kept.

Each level takes one exchange: tasks send sorted blocks of keys and counts to parts, whose bounds follow from the level before,
and a part's task merges them and writes its shards. No n-gram is stored anywhere else.

Trie. A level is a sorted set of keys: words by hash; bigrams by (word, next word); trigrams by (bigram, place of the last
word among the successors of the middle one), so the last key part is small: it is relative to its context. Each level
is cut by key ranges into shards, which tasks write to the shared folder and readers map into memory. In a shard, keys
are in Elias-Fano form: low bits packed, high bits as monotone bucket starts; a search looks at one bucket. Beside the
keys lie smoothed log10 probabilities, in 16 bits.

Smoothing. Absolute discounting, interpolated: p(w | context) = max(c - D, 0) / C + gamma p(w | shorter context), where gamma
is what the kept n-grams leave. p(w) = (1 - u) c / N, and u, the share of words seen once, goes to the class of unknown words.
Every context sums to one over the known words, the end and that class, up to the rounding of the stored values.
"""

from __future__ import annotations

import os
import tempfile
from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from tidemark.lineage import new_folder
from tidemark.llm.common import arrow_schema, fold, fold_of, ragged_sums, rows_of, shuffle_partitions, texts

END = b"\n"  # no word holds white space, so this cannot be one
FLOOR, STEPS = -16.0, 65535  # stored log10 probabilities reach from FLOOR to 0 in so many steps
PER_BUCKET = 8
SLICE = 1024  # texts that are looked up together
TASK_KEYS = 4_000_000  # keys that a task counts by itself before it sends them on
BLOCK_KEYS = 1 << 16
PART_TOKENS = 3_000_000  # occurrences that a part of bigrams or trigrams holds, about
CUTS = 8  # places in so many occurrences where a part of the next level may begin


def tokens_of(values: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """All tokens of some texts, each text's end included: places among the distinct ones, whose hashes follow, and each text's
    first place. Words are cut as ``common.words`` cuts them."""
    lists = pc.ascii_split_whitespace(pc.ascii_lower(pa.array(values, pa.large_string())))
    flat = lists.flatten()
    real = np.asarray(pc.binary_length(flat)) > 0  # white space at a text's ends leaves empty parts
    before = np.concatenate([[0], np.cumsum(real)])[np.asarray(lists.offsets) - lists.offsets[0].as_py()]
    encoded = flat.filter(pa.array(real)).dictionary_encode()
    distinct = encoded.dictionary.cast(pa.large_binary()).to_pylist()
    offsets = before + np.arange(len(before))
    local = np.full(int(offsets[-1]), len(distinct), np.int32)
    ends = np.zeros(len(local), bool)
    ends[offsets[1:] - 1] = True
    local[~ends] = np.asarray(encoded.indices)
    return local, hashes_of([*distinct, END]), offsets


def hashes_of(some) -> np.ndarray:
    found = np.fromiter(map(xxhash.xxh64_intdigest, some), np.uint64, len(some))
    return (found >> np.uint64(1)).astype(np.int64)


def code(log10: np.ndarray) -> np.ndarray:
    return np.round((np.clip(log10, FLOOR, 0) - FLOOR) / -FLOOR * STEPS).astype(np.uint16)


def decoded(codes: np.ndarray) -> np.ndarray:
    return codes.astype(float) / STEPS * -FLOOR + FLOOR


class Sequence:
    """Sorted distinct numbers below 2^63 in Elias-Fano form, over memory-mapped arrays."""

    def __init__(self, parts: dict[str, np.ndarray]):
        self.first, self.width, self.n = (int(x) for x in parts["facts"])
        self.low, self.starts = parts["low"], parts["starts"]

    @staticmethod
    def encode(keys: np.ndarray) -> dict[str, np.ndarray]:
        n = len(keys)
        away = (keys - keys[0]).astype(np.uint64)
        width = max(0, int(away[-1]).bit_length() - max(0, n // PER_BUCKET).bit_length())
        high = (away >> np.uint64(width)).astype(np.int64)
        starts = np.concatenate([[0], np.cumsum(np.bincount(high))]).astype(np.uint32)
        low = np.zeros(n * width // 64 + 2, np.uint64)
        if width:
            value = away & np.uint64((1 << width) - 1)
            at = np.arange(n, dtype=np.uint64) * np.uint64(width)
            word, shift = (at >> np.uint64(6)).astype(np.int64), at & np.uint64(63)
            np.bitwise_or.at(low, word, value << shift)
            over = shift + np.uint64(width) > np.uint64(64)
            np.bitwise_or.at(low, word[over] + 1, value[over] >> (np.uint64(64) - shift[over]))
        return {"facts": np.array([keys[0], width, n], np.int64), "low": low, "starts": starts}

    def low_at(self, i: np.ndarray) -> np.ndarray:
        if not self.width:
            return np.zeros(len(i), np.uint64)
        at = i.astype(np.uint64) * np.uint64(self.width)
        word, shift = (at >> np.uint64(6)).astype(np.int64), at & np.uint64(63)
        value = self.low[word] >> shift
        carried = (self.low[word + 1] << (np.uint64(63) - shift)) << np.uint64(1)
        return (value | carried) & np.uint64((1 << self.width) - 1)

    def get(self, i: np.ndarray) -> np.ndarray:
        high = np.searchsorted(self.starts, i, side="right") - 1
        return self.first + (high << self.width) + self.low_at(i).astype(np.int64)

    def rank(self, keys: np.ndarray) -> np.ndarray:
        """How many numbers are smaller than each key: the place of its successor."""
        return self._search(keys)[0]

    def find(self, keys: np.ndarray) -> np.ndarray:
        """The place of each key, or -1."""
        place, end, wanted = self._search(keys)
        inside = place < end
        hit = self.low_at(np.where(inside, place, 0)) == wanted
        return np.where(inside & hit, place, -1)

    def _search(self, keys: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Each key's successor, the end of the key's bucket, and its low bits."""
        away = keys - self.first
        high = away >> self.width
        buckets = len(self.starts) - 1
        inside = (away >= 0) & (high < buckets)
        bucket = np.where(inside, high, 0)
        left = np.where(inside, self.starts[bucket], np.where(away < 0, 0, self.n)).astype(np.int64)
        right = np.where(inside, self.starts[bucket + 1], left).astype(np.int64)
        end = right.copy()
        wanted = (away & ((1 << self.width) - 1)).astype(np.uint64)
        active = np.flatnonzero(left < right)
        while len(active):
            middle = (left[active] + right[active]) >> 1
            less = self.low_at(middle) < wanted[active]
            left[active] = np.where(less, middle + 1, left[active])
            right[active] = np.where(less, right[active], middle)
            active = active[left[active] < right[active]]
        return left, end, wanted


# ---- shards in the shared folder


def local_path(uri: str) -> str | None:
    return uri.removeprefix("file://") if uri.startswith(("file:", "/")) else None


def write_shard(uri: str, parts: dict[str, np.ndarray]) -> None:
    """One file: a header with names, kinds and places, then the arrays. A repeated task replaces it whole."""
    head, at, body = [], 0, []
    for name, a in parts.items():
        raw = np.ascontiguousarray(a).tobytes()
        raw += b"\0" * (-len(raw) % 8)
        head.append(f"{name},{a.dtype.str},{len(a)},{at}")
        body.append(raw)
        at += len(raw)
    header = ";".join(head).encode().ljust(512)
    if path := local_path(uri):
        os.makedirs(os.path.dirname(path), exist_ok=True)
        scratch = f"{path}.{os.getpid()}"
        with open(scratch, "wb") as f:
            f.writelines([header, *body])
        os.replace(scratch, path)
    else:
        from pyarrow import fs

        store, path = fs.FileSystem.from_uri(uri)
        store.create_dir(os.path.dirname(path), recursive=True)
        with store.open_output_stream(path) as f:
            for part in [header, *body]:
                f.write(part)


@lru_cache(maxsize=4096)
def read_shard(uri: str) -> dict[str, np.ndarray]:
    """The arrays of a shard, mapped into memory; from a remote store through a file of this process."""
    path = local_path(uri)
    if path is None:
        from pyarrow import fs

        store, remote = fs.FileSystem.from_uri(uri)
        with store.open_input_stream(remote) as source, tempfile.NamedTemporaryFile(delete=False) as f:
            while part := source.read(1 << 22):
                f.write(part)
        path = f.name
    data = np.asarray(np.memmap(path, np.uint8, "r"))
    if local_path(uri) is None:
        os.unlink(path)  # the mapping stays
    found = {}
    for entry in data[:512].tobytes().decode().strip().split(";"):
        name, kind, n, at = entry.split(",")
        size = np.dtype(kind).itemsize
        begin = 512 + int(at)
        found[name] = data[begin : begin + int(n) * size].view(kind)
    return found


@dataclass(frozen=True)
class Level:
    """A level: its shards in key order, with the first key and the number of keys before each."""

    uris: tuple[str, ...]
    firsts: np.ndarray
    bases: np.ndarray
    size: int

    def _by_shard(self, shard: np.ndarray) -> Iterator[tuple[int, np.ndarray]]:
        """Each shard that occurs, with the places where it does."""
        order = np.argsort(shard, kind="stable")
        cuts = np.flatnonzero(np.diff(shard[order], prepend=-1, append=-1))
        for a, b in zip(cuts[:-1], cuts[1:]):
            yield int(shard[order[a]]), order[a:b]

    def rank(self, keys: np.ndarray) -> np.ndarray:
        """How many keys of the level are smaller."""
        result = np.zeros(len(keys), np.int64)
        if self.size:
            for s, rows in self._by_shard(np.maximum(np.searchsorted(self.firsts, keys, side="right") - 1, 0)):
                result[rows] = self.bases[s] + Sequence(read_shard(self.uris[s])).rank(keys[rows])
        return result

    def get(self, nodes: np.ndarray) -> np.ndarray:
        result = np.zeros(len(nodes), np.int64)
        for s, rows in self._by_shard(np.searchsorted(self.bases, nodes, side="right") - 1):
            result[rows] = Sequence(read_shard(self.uris[s])).get(nodes[rows] - self.bases[s])
        return result

    def value(self, name: str, nodes: np.ndarray) -> np.ndarray:
        result: np.ndarray | None = None
        for s, rows in self._by_shard(np.searchsorted(self.bases, nodes, side="right") - 1):
            column = read_shard(self.uris[s])[name]
            if result is None:
                result = np.zeros(len(nodes), column.dtype)
            result[rows] = column[nodes[rows] - self.bases[s]]
        return np.zeros(0) if result is None else result

    def counts(self, nodes: np.ndarray) -> np.ndarray:
        """How often each node's key was seen."""
        result = np.zeros(len(nodes), np.int64)
        for s, rows in self._by_shard(np.searchsorted(self.bases, nodes, side="right") - 1):
            shard, at = read_shard(self.uris[s]), nodes[rows] - self.bases[s]
            n = shard["count"][at].astype(np.int64)
            large = np.flatnonzero(n == 255)
            n[large] = shard["large"][np.searchsorted(shard["over"], at[large])]
            result[rows] = n
        return result

    def find(self, keys: np.ndarray) -> np.ndarray:
        """The node of each key, or -1."""
        if not self.size or not len(keys):
            return np.full(len(keys), -1, np.int64)
        result = np.full(len(keys), -1, np.int64)
        for s, rows in self._by_shard(np.maximum(np.searchsorted(self.firsts, keys, side="right") - 1, 0)):
            place = Sequence(read_shard(self.uris[s])).find(keys[rows])
            result[rows] = np.where(place >= 0, place + self.bases[s], -1)
        return result


# ---- counting: one exchange of sorted blocks for each level


def narrow(n: np.ndarray) -> dict[str, np.ndarray]:
    """Counts in a byte each; those of 255 and more lie beside them, by place."""
    over = np.flatnonzero(n >= 255)
    return {"count": np.minimum(n, 255).astype(np.uint8), "over": over, "large": n[over]}


def planes(values: np.ndarray) -> bytes:
    """Non-negative numbers as byte planes, lowest first, as many as the largest needs: high planes compress to nothing."""
    width = max(1, (int(values.max()).bit_length() + 7) // 8)
    return np.ascontiguousarray(values.astype("<u8").view(np.uint8).reshape(-1, 8)[:, :width].T).tobytes()


def from_planes(raw: bytes, n: int) -> np.ndarray:
    wide = np.zeros((n, 8), np.uint8)
    part = np.frombuffer(raw, np.uint8).reshape(-1, n)
    wide[:, : len(part)] = part.T
    return wide.view("<u8").ravel().astype(np.int64)


BLOCK = pa.schema([("part", pa.int32()), ("n", pa.int32()), ("first", pa.int64()), ("gaps", pa.binary()), ("counts", pa.binary())])


def blocks(keys: np.ndarray, n: np.ndarray, bounds: np.ndarray) -> Iterator[pa.RecordBatch]:
    """Sorted keys with counts, cut at the parts' bounds; a block holds the gaps between its keys."""
    cuts = np.concatenate([[0], np.searchsorted(keys, bounds), [len(keys)]])
    for part in np.flatnonzero(np.diff(cuts)):
        for at in range(cuts[part], cuts[part + 1], BLOCK_KEYS):
            end = min(at + BLOCK_KEYS, cuts[part + 1])
            gaps = np.diff(keys[at:end], prepend=keys[at])
            yield pa.RecordBatch.from_pylist(
                [{"part": int(part), "n": int(end - at), "first": int(keys[at]), "gaps": planes(gaps), "counts": planes(n[at:end])}], BLOCK
            )


def merged(parts: list[tuple[np.ndarray, np.ndarray]]) -> tuple[np.ndarray, np.ndarray]:
    """Sorted runs as one, counts of equal keys added."""
    if len(parts) == 1:
        return parts[0]
    keys, n = (np.concatenate([p[i] for p in parts]) for i in (0, 1))
    order = np.argsort(keys, kind="stable")  # merges runs
    keys = keys[order]
    begins = np.flatnonzero(np.diff(keys, prepend=keys[0] - 1))
    return keys[begins], np.add.reduceat(n[order], begins)


@dataclass(frozen=True)
class Counted:
    """A counted level, its contexts' level, and what the driver learned of it: a line for each shard."""

    level: Level
    contexts: Level
    total: int
    singles: int
    widest: int  # most keys of one context
    cuts: np.ndarray  # places in the level, ascending,
    masses: np.ndarray  # and the occurrences before each

    def bounds(self, radix: int, part_tokens: int) -> np.ndarray:
        """First keys of the next level's parts, all but the first: about ``part_tokens`` occurrences lie between two.

        A part never ends inside a context. What a context holds is at most its own count.
        """
        wanted = np.arange(part_tokens, self.total, part_tokens) if len(self.cuts) else np.zeros(0, np.int64)
        return np.unique(self.cuts[np.minimum(np.searchsorted(self.masses, wanted), len(self.cuts) - 1)]) * radix


def joined(lines: list, uri: str, first: str, n: str) -> Level:
    lines = [r for r in lines if r[n]]
    counts = np.array([r[n] for r in lines], np.int64)
    return Level(tuple(r[uri] for r in lines), np.array([r[first] for r in lines], np.int64), np.cumsum(counts) - counts, int(counts.sum()))


def count_level(
    docs: DataFrame, keys_of, bounds: np.ndarray, folder: str, finish, least: int = 1, part_tokens: int = PART_TOKENS, buffer: int = TASK_KEYS
) -> Counted:
    """Count the keys of all documents, and write the level's shards and those of its contexts.

    ``keys_of`` maps texts to an array of keys, repeats included. A task sorts and counts what fits its buffer and sends it as
    blocks, so a frequent key is a few bytes from each buffer. A part's task merges its blocks, keeps what occurs ``least``
    times and writes the shards; nothing else is stored. Parts are key ranges that do not cut a context, so ``finish``
    has the sums of every context at hand: from sorted keys and counts it makes the level's arrays, the contexts with
    theirs, and the most keys of one context. A repeated task writes the same files.
    """

    grain = max(1, part_tokens // CUTS)

    def send(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[np.ndarray] = []
        size = 0
        for _, values in rows_of(batches, SLICE):
            held.append(keys_of(values))
            size += len(held[-1])
            if size > buffer:
                yield from blocks(*np.unique(np.concatenate(held), return_counts=True), bounds)
                held, size = [], 0
        if size:
            yield from blocks(*np.unique(np.concatenate(held), return_counts=True), bounds)

    def receive(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        runs: list[tuple[np.ndarray, np.ndarray]] = []
        part, size, rest = None, 0, 0
        for batch in batches:
            for row in batch.to_pylist():
                if part not in (None, row["part"]):
                    raise ValueError("a task got blocks of two parts")
                part = row["part"]
                runs.append((row["first"] + np.cumsum(from_planes(row["gaps"], row["n"])), from_planes(row["counts"], row["n"])))
                rest += row["n"]
                if rest > max(buffer // 2, size):
                    runs = [merged(runs)]
                    size, rest = len(runs[0][0]), 0
        if not runs:
            return
        keys, n = merged(runs)
        del runs
        if least > 1:
            keys, n = keys[n >= least], n[n >= least]
        if not len(keys):
            return
        arrays, contexts, context_arrays, widest = finish(keys, n)
        uri = f"{folder}/{part:07d}"
        write_shard(uri, Sequence.encode(keys) | narrow(n) | arrays)
        if len(contexts):
            write_shard(f"{uri}-contexts", Sequence.encode(contexts) | context_arrays)
        mass = np.cumsum(n)
        cuts = np.unique(np.searchsorted(mass, np.arange(grain, mass[-1], grain)) + 1)
        yield pa.RecordBatch.from_pylist(
            [
                {
                    "part": part, "uri": uri, "first": int(keys[0]), "n": len(keys), "context_uri": f"{uri}-contexts",
                    "context_first": int(contexts[0]) if len(contexts) else 0, "contexts": len(contexts), "total": int(mass[-1]),
                    "singles": int((n == 1).sum()), "widest": widest, "cuts": cuts.tolist(), "masses": mass[cuts - 1].tolist(),
                }
            ],
            arrow_lines,
        )

    kinds = (
        "part int, uri string, first long, n long, context_uri string, context_first long, contexts long, "
        "total long, singles long, widest long, cuts array<long>, masses array<long>"
    )
    arrow_lines = arrow_schema(StructType.fromDDL(kinds))
    made = docs.mapInArrow(send, "part int, n int, first long, gaps binary, counts binary")
    dealt = made.repartitionById(len(bounds) + 1, F.col("part"))
    lines = sorted(dealt.mapInArrow(receive, kinds).collect(), key=lambda r: r["part"])
    level, contexts = joined(lines, "uri", "first", "n"), joined(lines, "context_uri", "context_first", "contexts")
    before = np.cumsum([0, *(r["total"] for r in lines)])
    cuts = np.array([base + c for base, r in zip(level.bases, lines) for c in r["cuts"]], np.int64)
    masses = np.array([mass + m for mass, r in zip(before, lines) for m in r["masses"]], np.int64)
    widest, singles = max((r["widest"] for r in lines), default=0), sum(r["singles"] for r in lines)
    return Counted(level, contexts, int(before[-1]), singles, widest, cuts, masses)


def grouped(context: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Where each context begins among sorted keys, and the number of its keys."""
    begins = np.flatnonzero(np.diff(context, prepend=context[0] - 1))
    return begins, np.diff(begins, append=len(context))


# ---- the model


@dataclass(frozen=True)
class Model:
    words: Level  # by hash; count
    gammas: Level  # by word; log10 gamma of a word as context
    pairs: Level  # by word * V + next word; log10 p, count
    pair_gammas: Level  # by bigram node
    triples: Level  # by bigram node * radix + place of the last word among the middle word's successors
    tokens: int
    singles: int
    radix: int

    @property
    def unknown(self) -> float:
        return (self.singles + 1) / (self.tokens + 2)

    def look_up(self, values: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Word ids (-1 unknown) and counts of all tokens of some texts, ends included, and each text's first place."""
        local, hashes, offsets = tokens_of(values)
        ids = self.words.find(hashes)
        counts = np.zeros(len(ids), np.int64)
        if (ids >= 0).any():
            counts[ids >= 0] = self.words.counts(ids[ids >= 0])
        return ids[local], counts[local], offsets

    def pair_nodes(self, first: np.ndarray, second: np.ndarray) -> np.ndarray:
        """Nodes of bigrams, -1 where a word is unknown (-1) or the bigram is not kept."""
        nodes = np.full(len(first), -1, np.int64)
        both = np.flatnonzero((first >= 0) & (second >= 0))
        if len(both) and self.pairs.size:
            keys, back = np.unique(first[both] * self.words.size + second[both], return_inverse=True)
            nodes[both] = self.pairs.find(keys)[back]
        return nodes

    def relative(self, node: np.ndarray, middle: np.ndarray) -> np.ndarray:
        """Place of a bigram among those with the same first word ``middle``."""
        mid, back = np.unique(middle, return_inverse=True)
        return node - self.pairs.rank(mid * self.words.size)[back]

    def triple_keys(self, before: np.ndarray, node: np.ndarray, middle: np.ndarray) -> np.ndarray:
        """Trigram keys from the nodes of both bigrams and the middle word."""
        return before * self.radix + self.relative(node, middle)

    def log10(self, ids: np.ndarray, counts: np.ndarray, starts: np.ndarray) -> np.ndarray:
        """log10 p of each token given the two before it in its text: the longest n-gram kept, and what longer contexts leave."""
        result = np.zeros(len(ids))
        begins = np.zeros(len(ids) + 1, bool)
        begins[starts] = True
        at = np.flatnonzero(~begins[: len(ids)])
        node = np.full(len(ids), -1, np.int64)  # of (previous, this)
        node[at] = self.pair_nodes(ids[at - 1], ids[at])
        shorter = np.ones(len(ids), bool)  # no trigram ends here
        if self.triples.size:
            both = np.flatnonzero((node[1:] >= 0) & (node[:-1] >= 0)) + 1
            one, back = np.unique(self.triple_keys(node[both - 1], node[both], ids[both - 1]), return_inverse=True)
            found = self.triples.find(one)
            value = np.zeros(len(one))
            value[found >= 0] = decoded(self.triples.value("p", found[found >= 0]))
            kept = (found >= 0)[back]
            result[both[kept]] = value[back[kept]]
            shorter[both[kept]] = False
        rest = np.flatnonzero(shorter)
        pair = rest[node[rest] >= 0]
        if len(pair):
            result[pair] = decoded(self.pairs.value("p", node[pair]))
        word = rest[node[rest] < 0]
        u, c = self.unknown, counts[word]
        result[word] = np.log10(np.where(c > 0, (1 - u) * c / max(self.tokens, 1), u))
        after = word[~begins[word]]
        result[after] += optional(self.gammas, ids[after - 1])
        after = rest[~begins[rest]]
        after = after[node[after - 1] >= 0]
        result[after] += optional(self.pair_gammas, node[after - 1])
        return result


def optional(level: Level, keys: np.ndarray) -> np.ndarray:
    """Stored log10 values, 0 where a key is not there."""
    one, back = np.unique(keys, return_inverse=True)
    node = level.find(one)
    value = np.zeros(len(one))
    if (node >= 0).any():
        value[node >= 0] = decoded(level.value("p", node[node >= 0]))
    return value[back]


def training(docs: DataFrame, folds: int, held: int) -> DataFrame:
    return texts(docs).filter(fold(F.col("doc_id"), folds) != held)


def train(
    docs: DataFrame, folds: int = 7, held: int = 2, least: int = 1, discount: float = 0.75,
    part_tokens: int = PART_TOKENS, buffer: int = TASK_KEYS,
) -> Model:
    """Learn from the documents outside the held-out fold; all of them are counted, and all their n-grams unless ``least`` > 1.

    ``part_tokens`` and ``buffer`` bound the memory of a task and change no score. The followers of one word, distinct ones, lie in
    one part, so the vocabulary bounds it too.
    """
    spark = docs.sparkSession
    folder = new_folder(spark, "ngram-trie")
    learned = training(docs, folds, held)
    nothing = Level((), np.zeros(0, np.int64), np.zeros(0, np.int64), 0)

    def word_keys(values: list[str]) -> np.ndarray:
        local, hashes, _ = tokens_of(values)
        return hashes[local]

    def word_parts(keys: np.ndarray, n: np.ndarray) -> tuple:
        return {}, keys[:0], {}, 0

    parts = shuffle_partitions(spark)
    hash_bounds = np.array([(i << 63) // parts for i in range(1, parts)], np.int64)
    unigrams = count_level(learned, word_keys, hash_bounds, f"{folder}/words", word_parts, 1, part_tokens, buffer)
    tokens, size = unigrams.total, unigrams.level.size
    base = Model(unigrams.level, nothing, nothing, nothing, nothing, tokens, unigrams.singles, 1)
    if not tokens:
        return base
    fits(size, size)

    def pair_keys(values: list[str]) -> np.ndarray:
        ids, counts, offsets = base.look_up(values)
        often = counts >= least
        within = np.ones(len(ids), bool)
        within[offsets[:-1]] = False
        at = np.flatnonzero(within[1:] & often[1:] & often[:-1]) + 1
        return ids[at - 1] * size + ids[at]

    def pair_parts(keys: np.ndarray, n: np.ndarray) -> tuple:
        begins, children = grouped(keys // size)
        first = keys[begins] // size
        c = base.words.counts(first)
        gamma = left_over(n - discount, begins, c)
        second, back = np.unique(keys % size, return_inverse=True)
        shorter = ((1 - base.unknown) * base.words.counts(second) / tokens)[back]
        p = (n - discount) / np.repeat(c, children) + np.repeat(10 ** decoded(gamma), children) * shorter
        return {"p": code(np.log10(p))}, first, {"p": gamma}, int(children.max())

    bigrams = count_level(learned, pair_keys, unigrams.bounds(size, part_tokens), f"{folder}/pairs", pair_parts, least, part_tokens, buffer)
    radix = bigrams.widest + 1
    two = Model(unigrams.level, bigrams.contexts, bigrams.level, nothing, nothing, tokens, unigrams.singles, radix)
    if not bigrams.total:
        return two
    fits(bigrams.level.size, radix)

    def triple_keys(values: list[str]) -> np.ndarray:
        ids, _, offsets = base.look_up(values)
        within = np.ones(len(ids), bool)
        within[offsets[:-1]] = False
        node = np.full(len(ids), -1, np.int64)
        at = np.flatnonzero(within)
        node[at] = two.pair_nodes(ids[at - 1], ids[at])
        third = np.flatnonzero((node[1:] >= 0) & (node[:-1] >= 0)) + 1
        return two.triple_keys(node[third - 1], node[third], ids[third - 1])

    def triple_parts(keys: np.ndarray, n: np.ndarray) -> tuple:
        begins, children = grouped(keys // radix)
        before = keys[begins] // radix
        c = two.pairs.counts(before)
        gamma = left_over(n - discount, begins, c)
        middle, back = np.unique(two.pairs.get(before) % size, return_inverse=True)
        node = np.repeat(two.pairs.rank(middle * size)[back], children) + keys % radix
        shorter = 10 ** decoded(two.pairs.value("p", node))
        p = (n - discount) / np.repeat(c, children) + np.repeat(10 ** decoded(gamma), children) * shorter
        return {"p": code(np.log10(p))}, before, {"p": gamma}, int(children.max())

    trigrams = count_level(learned, triple_keys, bigrams.bounds(radix, part_tokens), f"{folder}/triples", triple_parts, least, part_tokens, buffer)
    return Model(
        unigrams.level, bigrams.contexts, bigrams.level, trigrams.contexts, trigrams.level, tokens, unigrams.singles, radix
    )


def fits(contexts: int, radix: int) -> None:
    if contexts * radix >= 1 << 63:
        raise ValueError(f"{contexts} contexts of up to {radix} keys each do not fit in 63 bits")


def left_over(kept: np.ndarray, begins: np.ndarray, c: np.ndarray) -> np.ndarray:
    """Stored log10 of what the kept n-grams of each context leave."""
    return code(np.log10(np.maximum(1 - np.add.reduceat(kept, begins) / c, 1e-16)))


def score(docs: DataFrame, model: Model, folds: int = 7, held: int = 2) -> DataFrame:
    """A row for each document: doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score.

    Null and empty texts are one end token. Ids may be null (never held out) or repeated; other columns are left out. With
    nothing to learn from, every token is unknown. Nothing is shuffled; readers map the trie's shards into memory.
    """
    chosen = texts(docs)
    id_type = arrow_schema(chosen.schema).field("doc_id").type
    n, v = model.tokens, model.words.size

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for doc_ids, values in rows_of(batches, SLICE):
            ids, counts, offsets = model.look_up(values)
            size = np.diff(offsets)
            plain = np.log10((counts + 1) / (n + v + 1))
            whole = model.log10(ids, counts, offsets[:-1])
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(doc_ids, id_type), pa.array([fold_of(d, folds) == held for d in doc_ids], pa.bool_()),
                    pa.array(size), pa.array(ragged_sums((counts > 0).astype(float), offsets).astype(np.int64)),
                    pa.array(np.full(len(size), n, np.int64)), pa.array(ragged_sums(plain, offsets)),
                    pa.array(ragged_sums(whole, offsets)),
                ],
                names=["doc_id", "held_out", "n_tokens", "n_known", "train_tokens", "base_score", "score"],
            )

    id_sql = chosen.schema["doc_id"].dataType.simpleString()
    kinds = "held_out boolean, n_tokens long, n_known long, train_tokens long, base_score double, score double"
    return chosen.mapInArrow(run, f"doc_id {id_sql}, {kinds}")
