"""SentencePiece BPE encoding by suffix-array matching, and decoding.

The new pre-tokens of a batch are concatenated and indexed by a suffix array, sorted as far as the longest piece
reaches. Every piece of the vocabulary finds its occurrences by binary search, as one range of the array. The
occurrences are the edges of a lattice; they are dealt to their positions (a counting sort by position and length).
Relaxing follows the model's own order, as a BPE model asks for: in each round, every pre-token joins the best-scored
edge that spans exactly two neighbouring nodes, until none does. Unknown characters fall back to bytes.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from tidemark.llm.bpe import SPACE, Vocabulary, plain_words, pre_tokens, vocabulary
from tidemark.llm.common import arrow_schema, col, rows_of, texts

LONG = 64  # longer pre-tokens join one edge at a time from a heap, as rounds over them would be quadratic
BATCH_CHARS = 600_000
BETWEEN = 0x1FFFFF  # stands between pre-tokens, unlike any character


def suffix_array(text: np.ndarray, depth: int) -> np.ndarray:
    """Positions sorted by the ``depth`` code points from there on (at least): by three of them, then by doubling."""
    n = len(text)
    padded = np.concatenate([text.astype(np.int64), np.zeros(2, np.int64)])
    key, reach = (padded[:-2] << 42) | (padded[1:-1] << 21) | padded[2:], 3
    while True:
        order = np.argsort(key)
        if reach >= depth:
            return order
        ordered = key[order]
        rank = np.empty(n, np.int64)
        rank[order] = np.concatenate([[1], 1 + np.cumsum(ordered[1:] != ordered[:-1])])
        key = rank * (n + 2) + np.concatenate([rank[reach:], np.zeros(min(reach, n), np.int64)])[:n]
        reach *= 2


class Matcher:
    """The pieces as a matrix of code points, and the search for their occurrences."""

    def __init__(self, pieces: Vocabulary):
        self.depth, self.wide = pieces.longest, pieces.longest + 1  # one more, so that each piece has an upper bound
        names = list(pieces.ids)
        self.ids = np.array([pieces.ids[p] for p in names], np.int32)
        self.length = np.array([len(p) for p in names], np.int64)
        self.low = np.zeros((len(names), self.wide), np.uint32)
        for row, p in zip(self.low, names):
            row[: len(p)] = np.frombuffer(p.encode("utf-32-le"), np.uint32)
        inside = np.arange(self.wide) < self.length[:, None]
        self.low = np.where(inside, self.low, np.uint32(0))
        self.high = np.where(inside, self.low, np.uint32(0xFFFFFFFF))

    def bound(self, text: np.ndarray, order: np.ndarray, wanted: np.ndarray) -> np.ndarray:
        """For each row of ``wanted``, how many suffixes are smaller."""
        padded = np.concatenate([text, np.zeros(self.wide, np.uint32)])
        first, last = np.zeros(len(wanted), np.int64), np.full(len(wanted), len(order), np.int64)
        every, reach = np.arange(len(wanted)), np.arange(self.wide)
        while (first < last).any():
            middle = (first + last) // 2
            found = padded[order[np.minimum(middle, len(order) - 1)][:, None] + reach]
            at = np.argmax(found != wanted, axis=1)
            less = (found[every, at] < wanted[every, at]) & (first < last)
            first = np.where(less, middle + 1, first)
            last = np.where(less | (first >= last), last, middle)
        return first

    def edges(self, text: np.ndarray) -> np.ndarray:
        """The piece's id at [position, length], or -1."""
        order = suffix_array(text, self.wide)
        begin, end = self.bound(text, order, self.low), self.bound(text, order, self.high)
        counts = end - begin
        which = np.repeat(np.arange(len(counts)), counts)
        nth = np.arange(counts.sum()) - np.repeat(np.cumsum(counts) - counts, counts)
        edge = np.full((len(text), self.depth + 1), -1, np.int32)
        edge[order[begin[which] + nth], self.length[which]] = self.ids[which]
        return edge


def relax(edge: np.ndarray, starts: np.ndarray, ends: np.ndarray, score: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Nodes (positions where a symbol begins) and symbols' ends, after all joins inside [starts, ends) of each token."""
    lengths = ends - starts
    token = np.repeat(np.arange(len(starts)), lengths)
    node = np.arange(lengths.sum()) - np.repeat(np.cumsum(lengths) - lengths, lengths) + starts[token]
    done_nodes, done_ends = [], []
    depth = edge.shape[1] - 1
    while len(node):
        last = np.concatenate([token[1:] != token[:-1], [True]])
        symbol_end = np.where(last, ends[token], np.concatenate([node[1:], [0]]))
        pair_end = np.concatenate([symbol_end[1:], [0]])
        span = np.where(last, depth + 1, pair_end - node)
        piece = np.where(span <= depth, edge[node, np.minimum(span, depth)], -1)
        value = np.where(piece >= 0, score[np.maximum(piece, 0)], -np.inf)
        heads = np.flatnonzero(np.concatenate([[True], token[1:] != token[:-1]]))
        best = np.maximum.reduceat(value, heads)
        sizes = np.diff(np.concatenate([heads, [len(node)]]))
        hit = (value == np.repeat(best, sizes)) & (piece >= 0)
        nth = np.cumsum(hit)
        before = np.repeat(nth[heads] - hit[heads], sizes)
        joined = hit & (nth - before == 1)  # the leftmost of each token
        active = np.repeat(best > -np.inf, sizes)
        done_nodes.append(node[~active])
        done_ends.append(symbol_end[~active])
        stays = active & ~np.concatenate([[False], joined[:-1]])
        node, token = node[stays], token[stays]
    nodes, symbol_ends = np.concatenate(done_nodes), np.concatenate(done_ends)
    order = np.argsort(nodes)
    return nodes[order], symbol_ends[order]


class Encoder(dict):
    """Ids of pre-tokens (without their first space mark), matched in batches and kept up to ``limit`` of them."""

    def __init__(self, pieces: Vocabulary, limit: int = 700_000):
        super().__init__()
        self.pieces, self.limit, self.matcher = pieces, limit, Matcher(pieces)
        self.score = np.zeros(len(pieces.pieces))
        for piece, i in pieces.ids.items():
            self.score[i] = pieces.scores[piece]
        self.bytes = [bytes([int(p[3:5], 16)]) if b else p.replace(SPACE, " ").encode() for p, b in zip(pieces.pieces, pieces.is_byte)]

    def match(self, tokens: list[str]) -> list[tuple[int, ...]]:
        """Ids of each pre-token, through one suffix array of them all."""
        lengths = np.array([len(t) for t in tokens], np.int64)
        text = np.frombuffer("\n".join(tokens).encode("utf-32-le", "replace"), np.uint32)
        starts = np.cumsum(lengths + 1) - lengths - 1
        marks = starts[1:] - 1
        text = text.copy()
        text[marks] = BETWEEN
        edge = self.matcher.edges(text)
        nodes, ends = relax(edge, starts, starts + lengths, self.score)
        found = edge[nodes, np.minimum(ends - nodes, self.matcher.depth)]
        owner = np.searchsorted(starts, nodes, side="right") - 1
        cuts = np.searchsorted(owner, np.arange(len(tokens) + 1)).tolist()
        ids = found.tolist()
        result = [tuple(ids[a:b]) for a, b in zip(cuts, cuts[1:])]
        for i in np.unique(owner[found < 0]).tolist():  # characters without a piece
            parts = ([k] if k >= 0 else self.pieces.symbol_ids(chr(text[nodes[cuts[i] + n]])) for n, k in enumerate(result[i]))
            result[i] = tuple(chain.from_iterable(parts))
        return result

    def learn(self, tokens: set[str]) -> None:
        new = [t for t in tokens if t not in self and len(t) <= LONG]
        if len(self) + len(new) > self.limit:
            self.clear()
            new = [t for t in tokens if len(t) <= LONG]
        batch, size = [], 0
        for n, t in enumerate(new, 1):
            batch.append(t)
            size += len(t) + 2
            if size >= BATCH_CHARS or n == len(new):
                self.update(zip(batch, self.match([SPACE + w for w in batch])))
                batch, size = [], 0

    def __missing__(self, token: str) -> tuple[int, ...]:
        return tuple(self.pieces.encode(SPACE + token))

    def encode_all(self, values: list[str]) -> list[list[int]]:
        split = []
        for t in values:
            plain = plain_words(t)
            split.append(plain if plain is not None else [p[1:] for p in pre_tokens(t)])
        self.learn(set(chain.from_iterable(split)))
        return [list(chain.from_iterable(map(self.__getitem__, tokens))) for tokens in split]

    def decode(self, ids: list[int]) -> str:
        return b"".join(map(self.bytes.__getitem__, ids)).decode("utf-8", "replace")[1:]


@lru_cache(maxsize=2)
def encoder(path: str) -> Encoder:
    return Encoder(vocabulary(path))


def encode(docs: DataFrame, model_path: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """A row for each document: doc_id, ids (array of int), without begin or end ids.

    Null and empty texts have no ids. Ids of documents may be null or repeated; rows stay as they are, other columns are
    left out. Nothing is shuffled.
    """
    chosen = texts(docs, id_col, text_col)
    id_type = arrow_schema(chosen.schema).field("doc_id").type

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = encoder(model_path)
        for ids, values in rows_of(batches, 2048):
            encoded = known.encode_all(values)
            yield pa.RecordBatch.from_arrays(
                [pa.array(ids, id_type), pa.array(encoded, pa.list_(pa.int32()))], names=["doc_id", "ids"]
            )

    id_sql = chosen.schema["doc_id"].dataType.simpleString()
    return chosen.mapInArrow(run, f"doc_id {id_sql}, ids array<int>")


def decode(encoded: DataFrame, model_path: str, id_col: str = "doc_id", ids_col: str = "ids") -> DataFrame:
    """A row for each document: doc_id, text. No ids (null or empty) give the empty text; bytes that are not UTF-8 give
    replacement characters."""
    chosen = encoded.select(col(id_col).alias("doc_id"), col(ids_col).alias("ids"))
    id_type = arrow_schema(chosen.schema).field("doc_id").type

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = encoder(model_path)
        for batch in batches:
            for at in range(0, batch.num_rows, 512):
                part = batch.slice(at, 512)
                values = [known.decode(ids or []) for ids in part.column("ids").to_pylist()]
                kept = part.column("doc_id").cast(id_type)
                yield pa.RecordBatch.from_arrays([kept, pa.array(values, pa.string())], names=["doc_id", "text"])

    return chosen.mapInArrow(run, f"doc_id {chosen.schema['doc_id'].dataType.simpleString()}, text string")


def encode_and_check(docs: DataFrame, model_path: str) -> DataFrame:
    """doc_id, n_tokens, ids, and whether decoding the ids gives the text back (null as empty).

    The text comes back whole, unless it holds the space mark itself, which decodes to a space.
    """
    chosen = texts(docs)
    id_type = arrow_schema(chosen.schema).field("doc_id").type

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = encoder(model_path)
        for ids, values in rows_of(batches, 2048):
            encoded = known.encode_all(values)
            same = [known.decode(e) == t for e, t in zip(encoded, values)]
            offsets = np.concatenate([[0], np.cumsum([len(e) for e in encoded])]).astype(np.int32)
            flat = np.fromiter(chain.from_iterable(encoded), np.int32, int(offsets[-1]))
            columns = [pa.array(ids, id_type), pa.array(np.diff(offsets).astype(np.int64)), pa.ListArray.from_arrays(offsets, flat), pa.array(same)]
            yield pa.RecordBatch.from_arrays(columns, names=["doc_id", "n_tokens", "ids", "round_trip"])

    id_sql = chosen.schema["doc_id"].dataType.simpleString()
    return chosen.mapInArrow(run, f"doc_id {id_sql}, n_tokens long, ids array<int>, round_trip boolean")
