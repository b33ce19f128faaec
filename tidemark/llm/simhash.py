"""SimHash near duplicates by one-wildcard segment variants.

Two 64-bit fingerprints that differ in at most two bits have a half (32 bits) in which they differ by at most one bit.
A half with one position left out ("wildcard") is equal for both if they differ there alone, so variants meet in an
equality join. What is known about the other half goes into the same key and keeps the join's groups small:

* first half differs in one bit: one variant of it is equal, and the other half differs in at most one bit, so one of
  its two quarters is equal: 32 variants x 2 quarters;
* a half is equal: of three parts of the other half, at most two differ: 3 keys for each half.

Every link has such a key, and every candidate is verified by counting differing bits. Only distinct fingerprints are
joined; documents with equal ones follow their smallest id.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import arrow_schema, col, rows_of, shuffled, stage, texts, words
from tidemark.llm.components import components

SEED = 42
BLOCK = 1 << 15  # shingles hashed at once
ROW = "simhash_row"


def fingerprint(text: str, size: int = 3) -> int:
    """A bit is 1 if set in over half of the XXH64 values of all word shingles, repeats included."""
    found = words(text)
    if not found:
        return 0
    joined = b" ".join(found)
    hashed = xxhash.xxh64_intdigest
    if len(found) <= size:
        return hashed(joined, SEED)
    ends = np.cumsum(np.fromiter(map(len, found), np.int64, len(found)) + 1) - 1
    starts = np.concatenate([[0], ends[: -size] + 1])
    ends = ends[size - 1 :]
    total, n = np.zeros(64, np.int64), len(starts)
    for at in range(0, n, BLOCK):
        spans = zip(starts[at : at + BLOCK].tolist(), ends[at : at + BLOCK].tolist())
        values = np.array([hashed(joined[a:b], SEED) for a, b in spans], "<u8")
        total += np.unpackbits(values.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(0, dtype=np.int64)
    bits = (2 * total > n).astype(np.uint8)
    return int(np.packbits(bits, bitorder="little").view("<u8")[0])


def fingerprints(docs: DataFrame, size: int = 3) -> DataFrame:
    """doc_id and ``bits`` (the fingerprint as a signed long) of each document."""
    chosen = texts(docs)
    id_type = arrow_schema(chosen.schema).field("doc_id").type

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for ids, values in rows_of(batches):
            bits = np.array([fingerprint(t, size) for t in values], np.uint64).view(np.int64)
            yield pa.RecordBatch.from_arrays([pa.array(ids, id_type), pa.array(bits)], names=["doc_id", "bits"])

    return chosen.mapInArrow(run, f"doc_id {chosen.schema['doc_id'].dataType.simpleString()}, bits long")


def keys(bits: np.ndarray) -> np.ndarray:
    """The 70 join keys of each fingerprint: kind in the top 7 bits, then the equal bits, packed without hashing."""
    bits = bits.view(np.uint64)
    one = np.uint64
    low, high = bits & one(0xFFFFFFFF), bits >> one(32)
    made, kind = [], 0

    def add(value: np.ndarray) -> None:
        nonlocal kind
        made.append(value | (one(kind) << one(57)))
        kind += 1

    for p in range(32):
        below = high & one((1 << p) - 1)
        variant = below | ((high >> one(p + 1)) << one(p))
        for shift in (0, 16):
            add((variant << one(16)) | ((low >> one(shift)) & one(0xFFFF)))
    for whole, other in ((high, low), (low, high)):
        for shift, width in ((0, 11), (11, 11), (22, 10)):
            add((whole << one(11)) | ((other >> one(shift)) & one((1 << width) - 1)))
    return np.stack(made, axis=1).view(np.int64)


def candidate_keys(distinct: DataFrame) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            bits = batch.column("bits").to_numpy(zero_copy_only=False)
            for at in range(0, len(bits), 4096):
                made = keys(bits[at : at + 4096])
                repeated = np.repeat(bits[at : at + 4096], made.shape[1])
                yield pa.RecordBatch.from_arrays([pa.array(made.ravel()), pa.array(repeated)], names=["key", "bits"])

    return distinct.select("bits").mapInArrow(run, "key long, bits long")


def links(distinct: DataFrame, most: int = 2) -> DataFrame:
    """Pairs (a < b) of distinct fingerprints that differ in at most ``most`` bits (2 or fewer).

    A fingerprint becomes 70 rows, so the keys of a small table are many: they are never broadcast.
    """
    if not 0 <= most <= 2:
        raise ValueError("the keys find links of at most two differing bits")
    made = candidate_keys(distinct)
    left, right = made.withColumnRenamed("bits", "a"), made.withColumnRenamed("bits", "b")
    differing = F.bit_count(F.col("a").bitwiseXOR(F.col("b")))
    return left.join(shuffled(right), "key").filter((F.col("a") < F.col("b")) & (differing <= most)).select("a", "b").distinct()


def near_duplicates(docs: DataFrame, size: int = 3, most: int = 2) -> DataFrame:
    """A row for each document: doc_id, fingerprint (16 hexadecimal digits), component_id.

    component_id is the smallest doc_id that can be reached over links. Null texts and texts without words have the
    fingerprint zero and link like others; texts with fewer words than a shingle hash their whole sequence. Repeated
    rows stay. A null doc_id counts as larger than every other for component_id; a group of nulls only has null.
    """
    marked = stage(fingerprints(docs, size), "fingerprints")
    nodes = stage(marked.groupBy("bits").agg(F.min("doc_id").alias("least")), "distinct-fingerprints")
    found = components(links(nodes, most), nodes)
    hexadecimal = F.lower(F.lpad(F.hex("bits"), 16, "0")).alias("fingerprint")
    return marked.join(shuffled(found), "bits").select("doc_id", hexadecimal, "component_id")


def one_of_each(docs: DataFrame, size: int = 3, most: int = 2) -> DataFrame:
    """The documents that stay: one row of each component, with all its columns.

    It is the row with the smallest doc_id (null counts as larger than every other), then the smallest digest of the text. Ids decide
    nothing else: rows with one id and unlike texts all stay, copies without an id go like others.
    """
    rows = stage(docs.withColumn(ROW, F.monotonically_increasing_id()), "numbered-documents")
    found = near_duplicates(rows.select(F.col(ROW).alias("doc_id"), col("text").alias("text")), size, most)
    place = rows.select(ROW, col("doc_id").alias("doc_id"), F.md5(F.coalesce(col("text"), F.lit("")).cast("binary")).alias("digest"))
    grouped = found.select(F.col("doc_id").alias(ROW), "component_id").join(shuffled(place), ROW)
    first = F.min(F.struct(F.col("doc_id").isNull().alias("unnamed"), "doc_id", "digest", ROW))
    stays = grouped.groupBy("component_id").agg(first[ROW].alias(ROW)).select(ROW)
    return rows.join(stays, ROW, "left_semi").select(*[col(c) for c in docs.columns])
