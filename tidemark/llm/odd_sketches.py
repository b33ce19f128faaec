"""Near duplicates by MinHash with odd sketches.

A document's set of word shingles has ``SAMPLES`` MinHash values. The first ``BANDS * ROWS`` of them, ``ROWS`` at a time, are
keys: sets with a Jaccard similarity of J share a key with probability 1 - (1 - J^ROWS)^BANDS, which at 0.85 misses 2e-8 of the
pairs. All samples are folded into an odd sketch: each (place, value) flips one of ``BITS`` bits. The exclusive or of two
sketches keeps only the samples in which the sets differ, so the number of its ones tells how many differ, most
sharply where few do. Candidates with more ones than similar sets have but once in a million are left out; the others are
confirmed on their whole sets.

Documents with equal sets are one node. Each node is confirmed first against the nearest, by sketch, of the hubs of its keys
(the least node of each key); links make components. Then all nodes that share a key but are of unlike components meet, in
pieces of bounded size, with their whole sets: pairs that the sketches let pass are measured there, nearest first, and a piece
returns no more links than join its components. No candidate is left out for being one of many, pairs that are linked already
are never measured, and pairs are never listed.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from fractions import Fraction

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import arrow_schema, stage, texts, words
from tidemark.llm.components import components

SEED = 42
SAMPLES, BANDS, ROWS, BITS = 256, 24, 4, 512
LONGS = BITS // 64
BLOCK = 256  # nodes of one key that meet as many others in one piece
SLICE = 256  # texts that are worked on together
PART = 1 << 9  # shingles whose samples are made together
FACTOR, MIX = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xBF58476D1CE4E5B9)
_DRAWN = np.random.default_rng(SEED)
FLIP = _DRAWN.integers(0, 1 << 32, SAMPLES, dtype=np.uint32)
TIMES = _DRAWN.integers(0, 1 << 32, SAMPLES, dtype=np.uint32) | np.uint32(1)


def mixed(values: np.ndarray) -> np.ndarray:
    values = (values ^ (values >> np.uint64(29))) * MIX
    return values ^ (values >> np.uint64(32))


def shingles(text: str, size: int) -> np.ndarray:
    """Sorted distinct 64-bit hashes of the word shingles; a shorter text is one shingle, a text without words has none."""
    found = words(text)
    if not found:
        return np.zeros(0, np.uint64)
    distinct = {w: xxhash.xxh3_64_intdigest(w, SEED) for w in set(found)}
    hashed = np.fromiter(map(distinct.__getitem__, found), np.uint64, len(found))
    wide = min(size, len(found))
    total = np.full(len(found) - wide + 1, wide, np.uint64)
    for k in range(wide):
        total = mixed(total * FACTOR + hashed[k : len(found) - wide + 1 + k])
    return np.unique(total)


def samples(found: np.ndarray) -> np.ndarray:
    """The MinHash values of a set that is not empty."""
    low = mixed(found).astype(np.uint32)[:, None]
    least = np.full(SAMPLES, 0xFFFFFFFF, np.uint32)
    for at in range(0, len(low), PART):
        np.minimum(least, ((low[at : at + PART] ^ FLIP) * TIMES).min(0), out=least)
    return least


def marks(found: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Band keys and the odd sketch, as 64-bit integers, of the rows of samples."""
    placed = mixed(found.astype(np.uint64) | (np.arange(SAMPLES, dtype=np.uint64) << np.uint64(32)))
    keys = np.full((len(found), BANDS), 1, np.uint64)
    banded = placed[:, : BANDS * ROWS].reshape(len(found), BANDS, ROWS)
    for k in range(ROWS):
        keys = mixed(keys * FACTOR + banded[:, :, k])
    bit = (mixed(placed * FACTOR) % np.uint64(BITS)).astype(np.int64)
    hits = np.bincount((bit + BITS * np.arange(len(found))[:, None]).ravel(), minlength=BITS * len(found))
    odd = (hits & 1).astype(np.uint8).reshape(len(found), BITS)
    return keys, np.packbits(odd, axis=1, bitorder="little").view("<u8")


def most_ones(similarity: Fraction) -> int:
    """Ones in the exclusive or of two sketches that similar sets exceed but once in a million, at the most."""
    differ = SAMPLES * float(1 - similarity)
    flips = 2 * (differ + 4.9 * math.sqrt(differ * float(similarity)) + 1)
    ones = BITS / 2 * (1 - (1 - 2 / BITS) ** flips)
    return math.ceil(ones + 1)


def marked(docs: DataFrame, size: int) -> DataFrame:
    """doc_id, digest (of the text), node (of the shingle set, null if empty), n (its size), keys and sketch of each row."""
    id_type = arrow_schema(docs.schema).field("doc_id").type

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, SLICE):
                part = batch.slice(at, SLICE)
                sets = [shingles(t, size) for t in part.column("text").to_pylist()]
                full = np.array([len(s) > 0 for s in sets], bool)
                keys, sketch = marks(np.array([samples(s) for s in sets if len(s)], np.uint32).reshape(-1, SAMPLES))

                def lists(values: np.ndarray) -> pa.ListArray:
                    ends = np.concatenate([[0], np.cumsum(full * values.shape[1])]).astype(np.int32)
                    return pa.ListArray.from_arrays(ends, pa.array(values.view(np.int64).ravel()))

                yield pa.RecordBatch.from_arrays(
                    [
                        part.column("doc_id").cast(id_type), part.column("digest"),
                        pa.array([xxhash.xxh3_128_digest(s.tobytes(), SEED) if len(s) else None for s in sets], pa.binary()),
                        pa.array([len(s) for s in sets], pa.int64()), lists(keys), lists(sketch),
                    ],
                    names=["doc_id", "digest", "node", "n", "keys", "sketch"],
                )

    kind = docs.schema["doc_id"].dataType.simpleString()
    return docs.mapInArrow(run, f"doc_id {kind}, digest binary, node binary, n long, keys array<long>, sketch array<long>")


def sized(n: str, m: str, similarity: Fraction) -> Column:
    """Whether sets of n and m shingles can be similar."""
    return F.least(n, m) * similarity.denominator >= F.greatest(n, m) * similarity.numerator


def ones(a: str, b: str) -> Column:
    """Ones in the exclusive or of two sketches."""
    return sum((F.bit_count(F.col(a)[i].bitwiseXOR(F.col(b)[i])) for i in range(LONGS)), F.lit(0))


def alike(left, right, up: int, down: int) -> bool:
    """Whether two sorted sets, as bytes, have a Jaccard similarity of at least up / down."""
    x, y = np.frombuffer(left, np.uint64), np.frombuffer(right, np.uint64)
    at = np.minimum(np.searchsorted(x, y), len(x) - 1)
    shared = int((x[at] == y).sum())
    return shared * down >= up * (len(x) + len(y) - shared)


def confirmed(pairs: DataFrame, sets: DataFrame, similarity: Fraction) -> DataFrame:
    """Those of the pairs (a, b) whose whole sets are similar."""
    up, down = similarity.numerator, similarity.denominator

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            left, right = batch.column("left"), batch.column("right")
            kept = np.zeros(batch.num_rows, bool)
            for i in range(batch.num_rows):
                kept[i] = alike(left[i].as_buffer(), right[i].as_buffer(), up, down)
            yield batch.select(["a", "b"]).filter(pa.array(kept))

    left, right = (sets.select(F.col("node").alias(k), F.col("set").alias(s)) for k, s in (("a", "left"), ("b", "right")))
    return pairs.join(left, "a").join(right, "b").select("a", "b", "left", "right").mapInArrow(run, "a binary, b binary")


def whole_sets(docs: DataFrame, asked: DataFrame, size: int) -> DataFrame:
    """node and set (sorted 64-bit hashes, as bytes) of the asked nodes, from one of the texts that have it."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, SLICE):
                part = batch.slice(at, SLICE)
                made = [shingles(t, size).tobytes() for t in part.column("text").to_pylist()]
                yield pa.RecordBatch.from_arrays([part.column("node"), pa.array(made, pa.binary())], names=["node", "set"])

    one = asked.select("node", F.col("source.doc_id").alias("source_id"), F.col("source.digest").alias("source_digest"))
    same = F.col("doc_id").eqNullSafe(F.col("source_id")) & (F.col("digest") == F.col("source_digest"))
    made = docs.join(one, same).select("node", "text").mapInArrow(run, "node binary, set binary")
    return made.groupBy("node").agg(F.min("set").alias("set"))  # rows with one id and text stand there once


def rooted(links: DataFrame, nodes: DataFrame) -> DataFrame:
    """bits (node) and component_id (least node) of every linked node."""
    linked = links.select(F.explode(F.array("a", "b")).alias("bits")).distinct()
    return components(links, linked.select("bits", F.col("bits").alias("least")))


def similar_nodes(docs: DataFrame, nodes: DataFrame, size: int, similarity: Fraction) -> DataFrame:
    """Pairs (a, b) of similar nodes that reach all that similar pairs reach."""
    most = most_ones(similarity)
    keyed = nodes.select("node", F.posexplode("keys").alias("band", "key")).select("node", F.xxhash64("band", "key").alias("key"))
    hubs = keyed.groupBy("key").agg(F.count("*").alias("held"), F.min("node").alias("hub")).filter("held > 1")
    shared = stage(keyed.join(hubs, "key"), "shared-keys")
    asked = shared.select("node").distinct()
    known = stage(nodes.join(asked, "node").select("node", "n", "sketch", "source"), "candidate-nodes")
    sets = stage(whole_sets(docs, known.select("node", "source"), size), "candidate-sets")

    first, other = (known.select(*[F.col(c).alias(f"{c}_{k}") for c in ("node", "n", "sketch")]) for k in (1, 2))
    to_hub = shared.filter("node <> hub").select(F.col("node").alias("node_1"), F.col("hub").alias("node_2")).distinct()
    measured = to_hub.join(first, "node_1").join(other, "node_2").withColumn("ones", ones("sketch_1", "sketch_2"))
    near = measured.filter((F.col("ones") <= most) & sized("n_1", "n_2", similarity)).groupBy("node_1").agg(F.min(F.struct("ones", "node_2")).alias("best"))
    near = stage(near.select(F.col("node_1").alias("a"), F.col("best.node_2").alias("b")), "hub-pairs")
    links = stage(confirmed(near, sets, similarity), "hub-links")

    roots = rooted(links, known).select(F.col("bits").alias("node"), F.col("component_id").alias("linked"))
    placed = known.join(roots, "node", "left").select("node", "n", "sketch", F.coalesce("linked", "node").alias("root"))
    return links.union(linked_in_pieces(pieces(shared, stage(placed, "candidate-roots")), sets, similarity))


def pieces(shared: DataFrame, placed: DataFrame) -> DataFrame:
    """Nodes of keys that hold more than one component, dealt to pieces (key, p, q) in which all pairs of unlike components meet.

    A key's most frequent component is one side, the rest the other; its own pairs are linked already. Both are cut into blocks of
    about ``BLOCK`` nodes: block p of the rest meets each block q of the frequent component and each later block of the
    rest. ``second`` tells the sides of a piece apart.
    """
    rows = shared.select("key", "node").join(placed.select("node", "root"), "node")
    counted = rows.groupBy("key", "root").agg(F.count("*").alias("n"))
    tops = counted.groupBy("key").agg(F.max(F.struct("n", "root")).alias("top"), F.sum("n").alias("held"), F.count("*").alias("roots"))
    blocks = [F.ceil(F.col("top.n") / BLOCK).alias("frequent"), F.ceil((F.col("held") - F.col("top.n")) / BLOCK).alias("rest")]
    rows = rows.join(tops.filter("roots > 1").select("key", F.col("top.root").alias("most"), *blocks), "key")
    own = F.expr("pmod(xxhash64(node), if(root = most, frequent, rest))")
    rest = """concat(
        transform(sequence(0L, frequent - 1), m -> struct(own AS p, m AS q, false AS second)),
        transform(filter(sequence(0L, rest - 1), o -> o > own), o -> struct(own AS p, frequent + o AS q, false AS second)),
        transform(filter(sequence(0L, rest - 1), o -> o < own), o -> struct(o AS p, frequent + own AS q, true AS second)))"""
    frequent = "transform(sequence(0L, rest - 1), o -> struct(o AS p, own AS q, true AS second))"
    dealt = rows.withColumn("own", own).withColumn("piece", F.explode(F.expr(f"if(root = most, {frequent}, {rest})")))
    return dealt.select("key", "piece.*", "node").join(placed, "node")


def linked_in_pieces(dealt: DataFrame, sets: DataFrame, similarity: Fraction) -> DataFrame:
    """For each piece, links (a, b) that reach all that its similar pairs reach; their whole sets are compared."""
    most, up, down = most_ones(similarity), similarity.numerator, similarity.denominator

    def links_of(held: list[tuple]) -> list[tuple[bytes, bytes]]:
        first = [k for k, h in enumerate(held) if not h[3]]
        second = [k for k, h in enumerate(held) if h[3]]
        sketch = np.array([h[7] for h in held], np.int64).view(np.uint64).reshape(len(held), LONGS)
        size = np.array([h[5] for h in held], np.int64)
        number: dict[bytes, int] = {}
        part = np.array([number.setdefault(h[6], len(number)) for h in held])
        found = []
        for at, x in enumerate(first):
            others = np.array(second + (first[at + 1 :] if held[x][2] == 0 else []), np.int64)
            others = others[part[others] != part[x]]
            ones = np.bitwise_count(sketch[others] ^ sketch[x]).sum(1)
            near = (ones <= most) & (np.minimum(size[others], size[x]) * down >= np.maximum(size[others], size[x]) * up)
            found += zip(ones[near].tolist(), [x] * int(near.sum()), others[near].tolist())
        root = list(range(len(number)))

        def find(i: int) -> int:
            while root[i] != i:
                root[i] = i = root[root[i]]
            return i

        links = []
        for _, x, y in sorted(found):
            a, b = find(int(part[x])), find(int(part[y]))
            if a != b and alike(held[x][8], held[y][8], up, down):
                root[b] = a
                links.append((held[x][4], held[y][4]))
        return links

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple] = []
        for batch in batches:
            links = []
            for at in range(0, batch.num_rows, SLICE):
                for row in zip(*(c.to_pylist() for c in batch.slice(at, SLICE).columns)):
                    if held and held[0][:3] != row[:3]:
                        links += links_of(held)
                        held = []
                    held.append(row)
            yield pairs_of(links)
        yield pairs_of(links_of(held) if held else [])

    def pairs_of(links: list[tuple[bytes, bytes]]) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array([x[i] for x in links], pa.binary()) for i in (0, 1)], names=["a", "b"])

    whole = dealt.join(sets, "node").select("key", "p", "q", "second", "node", "n", "root", "sketch", "set")
    ordered = whole.repartition("key", "p", "q").sortWithinPartitions("key", "p", "q")
    return ordered.mapInArrow(run, "a binary, b binary").select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct()


def near_duplicates(docs: DataFrame, size: int = 5, similarity: Fraction = Fraction(85, 100)) -> DataFrame:
    """A row for each document: doc_id, n_shingles (size of its set of ``size``-word shingles), component_id, kept.

    Documents are linked if their sets have a Jaccard similarity of at least ``similarity``; component_id is the smallest
    doc_id that links reach, and the document with it is kept. A text with fewer words than a shingle is one shingle. Null texts and
    texts without words have an empty set and are linked with nothing: their component is their own id. A null
    doc_id counts as larger than every other; a component of nulls only has null and its rows are kept. Rows
    with one doc_id all stay in the result, each with its own set's component. Other columns are ignored.
    """
    plain = texts(docs).withColumn("digest", F.unhex(F.md5(F.col("text").cast("binary"))))
    found = stage(marked(plain, size), "set-marks")
    source = F.min(F.struct(F.col("doc_id").isNull().alias("unnamed"), "doc_id", "digest")).alias("source")
    facts = [F.first(c).alias(c) for c in ("n", "keys", "sketch")]
    nodes = stage(found.filter("n > 0").groupBy("node").agg(source, *facts), "distinct-sets")
    links = stage(similar_nodes(plain, nodes, size, similarity), "set-links")
    linked = links.select(F.explode(F.array("a", "b")).alias("node")).distinct()
    ends = nodes.join(linked, "node").select(F.col("node").alias("bits"), F.col("source.doc_id").alias("least"))
    joined = components(links, ends).select(F.col("bits").alias("node"), F.col("component_id").alias("reached"))
    least = nodes.select("node", F.col("source.doc_id").alias("least"))
    ids = least.join(joined, "node", "left").select("node", F.coalesce("reached", "least").alias("component_id"))
    placed = found.select("doc_id", "n", "node").join(ids, "node", "left")
    component = F.when(F.col("n") == 0, F.col("doc_id")).otherwise(F.col("component_id"))
    return placed.select("doc_id", F.col("n").alias("n_shingles"), component.alias("component_id"), F.col("doc_id").eqNullSafe(component).alias("kept"))
