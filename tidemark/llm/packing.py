"""Shortest-pack-first packing over the histogram of lengths.

1. Each document becomes token ids, cut into full pieces of the sequence length and one shorter rest.
2. The histogram of rest lengths has at most one bin for each length, whatever the number of documents. On it, lengths
   are placed longest first, each into the shortest pack pattern that still has room; patterns carry counts, so one step
   places many documents.
3. Patterns become slots (a length, a range of ranks, a first sequence, an offset). Documents get their rank among those
   of the same length from counts by (length, bucket), and the slot of their rank gives sequence and offset.
"""

from __future__ import annotations

import bisect
import os
import re
import unicodedata
import zlib
from collections import defaultdict
from collections.abc import Iterator
from functools import lru_cache
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidemark.llm.common import arrow_schema, rows_of, shuffle_partitions, stage, texts

PUNCTUATED = re.compile(r"([^\W\d_]+)([!-/:-@\[-`{-~]+)")
CHUNK_CHARS = 64  # longer chunks are not kept


class Chunks:
    """Token ids (as bytes) of a text between two spaces, by the tokenizer library; kept up to ``limit`` chunks.

    The tokenizer drops white space and its pre-tokens never hold a space or line end, so a text may be cut there. A chunk
    of letters is one pre-token: many are encoded in one call, joined by spaces, and taken apart at tokens that end a
    word. Letters that stay letters when lowered, followed by ASCII punctuation, are two pre-tokens. In Latin-1 texts letters are lowered before the
    lookup, which the tokenizer does itself and which only makes chunks meet more often.
    """

    def __init__(self, path: str, limit: int = 700_000):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.known: dict[str, bytes] = {}
        self.tokenizer, self.limit = Tokenizer.from_file(path), limit
        vocabulary = self.tokenizer.get_vocab()
        self.ends_word = np.zeros(max(vocabulary.values()) + 1, bool)
        self.ends_word[[i for token, i in vocabulary.items() if token.endswith("</w>")]] = True

    def encode(self, text: str) -> np.ndarray:
        return np.array(self.tokenizer.encode_batch_fast([text], add_special_tokens=False)[0].ids, "<u4")

    def learn_words(self, new: list[str], most: int = 4096) -> None:
        for at in range(0, len(new), most):
            some = new[at : at + most]
            ids = self.encode(" ".join(some))
            cuts = (4 * (np.flatnonzero(self.ends_word[ids]) + 1)).tolist()
            raw = ids.tobytes()
            if len(cuts) == len(some):
                self.known.update((w, raw[a:b]) for w, a, b in zip(some, [0, *cuts], cuts))
            elif len(some) > 1:  # lower case or normal form made something else than the letters of one word
                self.learn_words(some, (len(some) + 7) // 8)
            else:
                self.known[some[0]] = raw

    def learn(self, chunks: set[str]) -> None:
        known = self.known
        if len(known) + len(chunks) > self.limit:
            known.clear()
        new = chunks.difference(known)
        words = set(filter(str.isalpha, new))
        matches = ((c, PUNCTUATED.fullmatch(c)) for c in new.difference(words))
        pairs = {c: m.groups() for c, m in matches if m and all_letters(m[1])}
        words.update(word for word, _ in pairs.values())
        self.learn_words(list(words.difference(known)))
        known.update({m: self.encode(m).tobytes() for m in {m for _, m in pairs.values()}.difference(known)})
        known.update((c, known[word] + known[marks]) for c, (word, marks) in pairs.items())
        known.update({c: self.encode(c).tobytes() for c in new.difference(known)})

    def encode_all(self, values: list[str]) -> list[bytes]:
        """The ids of each text as little-endian unsigned 32-bit numbers."""
        split = [lowered(t).replace("\n", " ").split(" ") for t in values]
        chunks = set(chain.from_iterable(split))
        self.learn(chunks)
        encoded = [b"".join(map(self.known.__getitem__, parts)) for parts in split]
        for long in [c for c in chunks if len(c) > CHUNK_CHARS]:
            del self.known[long]
        return encoded


def all_letters(word: str) -> bool:
    """Whether it is letters for the tokenizer too, in its normal form and lower case: a mark would join the punctuation behind it."""
    return word.isascii() or unicodedata.normalize("NFC", word).lower().isalpha()


def lowered(text: str) -> str:
    if not text.isascii():
        try:
            text.encode("latin-1")
        except UnicodeEncodeError:
            return text
    return text if "<|" in text else text.lower()


@lru_cache(maxsize=2)
def chunk_ids(path: str) -> Chunks:
    return Chunks(path)


def cut_documents(docs: DataFrame, tokenizer_path: str, end_id: int, capacity: int) -> DataFrame:
    """A row for each piece: doc_id, start, length, ids_crc32, doc_tokens and key (tells repeated documents apart)."""
    chosen = texts(docs)
    id_type = arrow_schema(chosen.schema).field("doc_id").type
    id_sql = chosen.schema["doc_id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known, end = chunk_ids(tokenizer_path), np.array([end_id], "<u4").tobytes()
        for ids, values in rows_of(batches, 2048):
            out: list[list] = [[], [], [], [], []]
            for doc_id, tokens in zip(ids, known.encode_all(values)):
                tokens += end
                n = len(tokens) // 4
                for start in range(0, n, capacity):
                    piece = tokens[4 * start : 4 * (start + capacity)]
                    for column, value in zip(out, (doc_id, start, len(piece) // 4, zlib.crc32(piece), n)):
                        column.append(value)
            kinds = [id_type, pa.int64(), pa.int64(), pa.int64(), pa.int64()]
            arrays = [pa.array(v, k) for v, k in zip(out, kinds)]
            yield pa.RecordBatch.from_arrays(arrays, names=["doc_id", "start", "length", "ids_crc32", "doc_tokens"])

    return chosen.mapInArrow(run, f"doc_id {id_sql}, start long, length long, ids_crc32 long, doc_tokens long")


def shortest_pack_first(histogram: dict[int, int], capacity: int) -> list[tuple[tuple[int, ...], int]]:
    """Patterns (lengths in order of placement, number of packs) that hold every length as often as the histogram says.

    Longest lengths first; a length goes to the open pattern with the most room. If the pattern has more packs than the
    length has documents left, it is divided. There are at most a few patterns for each length.
    """
    open_by_room: dict[int, list[tuple[tuple[int, ...], int]]] = defaultdict(list)
    rooms: list[int] = []
    closed: list[tuple[tuple[int, ...], int]] = []

    def put(pattern: tuple[int, ...], count: int, room: int) -> None:
        if room == 0:
            closed.append((pattern, count))
            return
        if not open_by_room[room]:
            bisect.insort(rooms, room)
        open_by_room[room].append((pattern, count))

    for length in sorted(histogram, reverse=True):
        left = histogram[length]
        while left:
            if not rooms or rooms[-1] < length:
                fit = capacity // length
                if whole := left // fit:
                    put((length,) * fit, whole, capacity - fit * length)
                if rest := left % fit:
                    put((length,) * rest, 1, capacity - rest * length)
                break
            room = rooms[-1]
            pattern, count = open_by_room[room].pop()
            if not open_by_room[room]:
                rooms.pop()
            # several at once where a pattern takes them all before it stops being the shortest
            times = max(1, min(room // length, left // count if left >= count else 1))
            used = min(count, left)
            times = times if used == count else 1
            put(pattern + (length,) * times, used, room - times * length)
            if used < count:
                put(pattern, count - used, room)
            left -= used * times
    return closed + [entry for entries in open_by_room.values() for entry in entries]


def slots_of(patterns: list[tuple[tuple[int, ...], int]]) -> dict[str, np.ndarray]:
    """Slots sorted by (length, first rank): where the documents of a length go, in ranges of their ranks."""
    ranks: dict[int, int] = defaultdict(int)
    rows, sequence = [], 0
    for pattern, count in patterns:
        offset = 0
        for length in pattern:
            rows.append((length, ranks[length], sequence, offset))
            ranks[length] += count
            offset += length
        sequence += count
    rows.sort()
    names = ("length", "rank", "sequence", "offset")
    return {n: np.array([r[i] for r in rows], np.int64) for i, n in enumerate(names)}


def with_rank(pieces: DataFrame, buckets: int) -> DataFrame:
    """``rank`` from 0 among the pieces of one length, without bringing a length's pieces together.

    Pieces are numbered inside (length, bucket of the id's hash); the counts of the earlier buckets come in front. The
    table of counts has a row for each length and bucket.
    """
    order = [F.col("doc_id").asc_nulls_first(), "start", "ids_crc32", "doc_tokens"]
    dealt = pieces.withColumn("bucket", F.pmod(F.xxhash64("doc_id", "start"), F.lit(buckets)))
    counts = dealt.groupBy("length", "bucket").agg(F.count("*").alias("n"))
    before = counts.select(
        "length", "bucket",
        (F.sum("n").over(Window.partitionBy("length").orderBy("bucket")) - F.col("n")).alias("before"),
    )
    inside = F.row_number().over(Window.partitionBy("length", "bucket").orderBy(*order)) - 1
    return (
        dealt.withColumn("inside", inside)
        .join(before, ["length", "bucket"])
        .withColumn("rank", F.col("before") + F.col("inside"))
        .drop("bucket", "inside", "before")
    )


def pack(
    docs: DataFrame, tokenizer_path: str, end_id: int = 2, capacity: int = 4096, buckets: int | None = None
) -> DataFrame:
    """A row for each piece: doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset.

    Null and empty texts are the end id alone. Repeated documents stay; an empty table gives an empty table. Other
    columns are left out. The token step runs once and leaves a narrow table in the shared folder. To the driver comes
    the histogram only: at most ``capacity`` rows.
    """
    spark = docs.sparkSession
    pieces = stage(cut_documents(docs, tokenizer_path, end_id, capacity), "pieces")
    histogram = {r["length"]: r["count"] for r in pieces.groupBy("length").count().collect()}
    slots = slots_of(shortest_pack_first(histogram, capacity))
    key = slots["length"] * (1 << 44) + slots["rank"]
    id_type = arrow_schema(pieces.schema).field("doc_id").type
    names = ["doc_id", "start", "length", "ids_crc32", "doc_tokens"]

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            length, rank = (batch.column(n).to_numpy(zero_copy_only=False) for n in ("length", "rank"))
            slot = np.searchsorted(key, length * (1 << 44) + rank, side="right") - 1
            sequence = slots["sequence"][slot] + rank - slots["rank"][slot]
            kept = [batch.column(n) for n in names]
            kept[0] = kept[0].cast(id_type)
            yield pa.RecordBatch.from_arrays(
                [*kept, pa.array(sequence), pa.array(slots["offset"][slot])], names=[*names, "sequence_id", "offset"]
            )

    ranked = with_rank(pieces, buckets or 4 * shuffle_partitions(spark))
    id_sql = pieces.schema["doc_id"].dataType.simpleString()
    numbers = ", ".join(f"{n} long" for n in [*names[1:], "sequence_id", "offset"])
    return ranked.mapInArrow(place, f"doc_id {id_sql}, {numbers}")
