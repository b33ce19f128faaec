"""Document fingerprints by context-triggered piecewise hashing.

A rolling hash over the last seven bytes ends a chunk wherever its low bits are all ones; each chunk's hash gives one
letter. Block sizes are powers of two, so the boundaries at twice the size are among those at the size itself. A
fingerprint is ``size:letters:letters at twice the size``, at the smallest size that gives at most 64 letters when runs of
one letter are cut to three, so no part of a text is left out. Fingerprints are compared where they have a block size in common, by the edit distance of
their letters.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import arrow_schema, shuffle_partitions, texts

ALPHABET = np.frombuffer(b"ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/", np.uint8)
WINDOW, MOST = 7, 64
RUN = 4  # unequal signatures are alike only if they share so many letters in a row (or all of the shorter one)
ODD, MIX = 0x9E3779B97F4A7C15, 0xD6E8FEB86659FD93
PART = 1 << 20


@lru_cache(maxsize=1)
def powers() -> tuple[np.ndarray, np.ndarray]:
    """Powers of an odd number modulo 2^64, and of its inverse."""
    up, down = np.full(PART + WINDOW, ODD, np.uint64), np.full(PART + WINDOW, pow(ODD, -1, 1 << 64), np.uint64)
    up[0] = down[0] = 1
    return np.multiply.accumulate(up), np.multiply.accumulate(down)


def mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(32))) * np.uint64(MIX)
    return x ^ (x >> np.uint64(29))


def running(data: np.ndarray) -> np.ndarray:
    """Sums of byte times power before each position of a part: a slice's difference, shifted, is its hash."""
    sums = np.zeros(len(data) + 1, np.uint64)
    np.cumsum((data.astype(np.uint64) + np.uint64(1)) * powers()[0][: len(data)], out=sums[1:])
    return sums


def levels(sums: np.ndarray) -> np.ndarray:
    """For each byte, the number of low one bits of the rolling hash there: chunks of size 2^k end where it is >= k."""
    rolled = sums[1:].copy()
    rolled[WINDOW:] -= sums[1:-WINDOW]
    h = mixed(rolled * powers()[1][: len(rolled)]) >> np.uint64(20)
    return np.bitwise_count(h & ~(h + np.uint64(1))).astype(np.uint8)


def letters(data: np.ndarray, sums: np.ndarray | None, ends: np.ndarray) -> np.ndarray:
    """A letter for each chunk that ends at ``ends`` (exclusive) and for what follows the last; runs cut to three."""
    closed = len(ends) and ends[-1] == len(data)
    edges = np.concatenate([[0], ends] if closed else [[0], ends, [len(data)]])
    if sums is not None:
        hashes = sums[edges[1:]] - sums[edges[:-1]]
        shift = powers()[1][edges[:-1]]
    else:  # a long text in parts of bounded memory
        hashes = np.zeros(len(edges) - 1, np.uint64)
        for start in range(0, len(data), PART):
            part = running(data[start : start + PART])
            inside = np.clip(edges - start, 0, len(part) - 1)
            hashes += (part[inside[1:]] - part[inside[:-1]]) * np.uint64(pow(ODD, start, 1 << 64))
        whole = np.array([pow(ODD, -PART * int(q), 1 << 64) for q in edges[:-1] // PART], np.uint64)
        shift = powers()[1][edges[:-1] % PART] * whole
    found = ALPHABET[(mixed(hashes * shift) >> np.uint64(40)) & np.uint64(63)]
    if len(found) > 3:
        again = (found[3:] == found[2:-1]) & (found[3:] == found[1:-2]) & (found[3:] == found[:-3])
        found = found[np.concatenate([[True, True, True], ~again])]
    return found


def fingerprint(text: str) -> str:
    data = np.frombuffer(text.encode("utf-8", "replace"), np.uint8)
    n = len(data)
    if not n:
        return "1::"
    if n <= PART:
        sums = running(data)
        level = levels(sums)
    else:
        sums, before = None, WINDOW - 1
        parts = [levels(running(data[:PART]))]
        parts += [levels(running(data[at - before : at + PART]))[before:] for at in range(PART, n, PART)]
        level = np.concatenate(parts)
    chunks = np.bincount(level, minlength=64)[::-1].cumsum()[::-1] + 1  # at each size, the open end included
    k = int(np.argmax(chunks <= MOST))
    ends = np.flatnonzero(level >= k)
    found = letters(data, sums, ends + 1)
    while k:  # runs of equal letters are short, so a repetitive text may take a smaller size
        finer = np.flatnonzero(level >= k - 1)
        more = letters(data, sums, finer + 1)
        if len(more) > MOST:
            break
        k, ends, found = k - 1, finer, more
    twice = letters(data, sums, ends[level[ends] > k] + 1)
    return f"{1 << k}:{found.tobytes().decode()}:{twice.tobytes().decode()}"


def common_length(a: np.ndarray, b: np.ndarray, b_length: np.ndarray) -> np.ndarray:
    """Longest common subsequence of rows of letters (0 pads), with 64 positions of ``a`` in one machine word."""
    n, one = len(a), np.uint64(1)
    masks = np.zeros((n, 256), np.uint64)
    for i in range(MOST):
        rows = np.flatnonzero(a[:, i])
        masks[rows, a[rows, i]] |= one << np.uint64(i)
    state, every = np.full(n, ~np.uint64(0)), np.arange(n)
    for j in range(MOST):
        m = np.where(j < b_length, masks[every, b[:, j]], np.uint64(0))
        u = state & m
        state = (state + u) | (state - u)
    return np.bitwise_count(~state).astype(np.int64)


def shares_run(a: np.ndarray, b: np.ndarray, a_length: np.ndarray, b_length: np.ndarray) -> np.ndarray:
    """Whether RUN letters in a row (all of a shorter signature) occur in both."""
    shared = np.zeros(len(a), bool)
    for r in range(1, RUN + 1):
        rows = np.flatnonzero(np.minimum(np.minimum(a_length, b_length), RUN) == r)
        for at in range(0, len(rows), 512):
            some = rows[at : at + 512]
            codes = []
            for x, length in ((a[some], a_length[some]), (b[some], b_length[some])):
                code = np.zeros((len(some), MOST - r + 1), np.int64)
                for i in range(r):
                    code = code * 256 + x[:, i : MOST - r + 1 + i]
                codes.append(np.where(np.arange(MOST - r + 1) <= (length - r)[:, None], code, -1 - len(codes)))
            shared[some] = (codes[0][:, :, None] == codes[1][:, None, :]).any((1, 2))
    return shared


def matrix(signatures: list[str]) -> tuple[np.ndarray, np.ndarray]:
    padded = np.zeros((len(signatures), MOST), np.uint8)
    for row, s in zip(padded, signatures):
        row[: len(s)] = np.frombuffer(s.encode(), np.uint8)
    return padded, np.array([len(s) for s in signatures], np.int64)


def likeness(left: list[str], right: list[str]) -> np.ndarray:
    """1 - edit distance / both lengths (a replaced letter is one deletion and one insertion), at the best common size.

    1 for equal fingerprints, 0 without a common block size or without a common run of letters.
    """
    result = np.zeros(len(left))
    owners, first, second = [], [], []
    for i, (a, b) in enumerate(zip(left, right)):
        if a == b:
            result[i] = 1.0
            continue
        (size_a, *sig_a), (size_b, *sig_b) = a.split(":"), b.split(":")
        n_a, n_b = int(size_a), int(size_b)
        for x in range(2):
            for y in range(2):
                if n_a << x == n_b << y and sig_a[x] and sig_b[y]:
                    owners.append(i)
                    first.append(sig_a[x])
                    second.append(sig_b[y])
    if owners:
        (a, a_length), (b, b_length) = matrix(first), matrix(second)
        value = 2 * common_length(a, b, b_length) / (a_length + b_length) * shares_run(a, b, a_length, b_length)
        np.maximum.at(result, owners, value)
    return result


def edited(text: str, following: str) -> str:
    """The text with its last third of code points replaced by as many (or all) of the next text's first."""
    n = len(text) // 3
    return text[: len(text) - n] + following[:n]


def in_order(docs: DataFrame, partitions: int) -> DataFrame:
    """doc_id, text, and ``tail``, sorted inside each partition by bucket and descending doc_id.

    Buckets are ranges of ids cut at quantiles, so no partition holds all. The first document of each bucket is also
    sent to the bucket before it, at its end (tail true), so that each document meets its next one; that of the first
    bucket goes to the last. The driver sees the cuts and one id for each bucket.
    """
    spark = docs.sparkSession
    chosen = texts(docs)
    buckets = 4 * partitions  # several in each partition, so that partitions are alike
    cuts = chosen.agg(F.percentile_approx("doc_id", [i / buckets for i in range(1, buckets)], 10_000)).first()[0]
    bounds = sorted(set(cuts or []), reverse=True)

    def bucket_of(ids: pd.Series) -> pd.Series:
        place = np.searchsorted(-np.array(bounds, float), -pd.to_numeric(ids).to_numpy(float, na_value=-np.inf), side="left")
        return pd.Series(place.astype(np.int32))

    bucket = F.pandas_udf(bucket_of, "int")("doc_id")
    dealt = chosen.withColumn("bucket", bucket)
    heads = sorted(dealt.groupBy("bucket").agg(F.max("doc_id").alias("head")).collect(), key=lambda r: r["bucket"])
    rows = [(heads[i - 1]["bucket"], r["bucket"], r["head"]) for i, r in enumerate(heads)]
    kinds = f"to int, bucket int, head {chosen.schema['doc_id'].dataType.simpleString()}"
    first = F.broadcast(spark.createDataFrame(rows, kinds))  # one row for each bucket
    here = F.struct("bucket", F.lit(False).alias("tail"))
    there = F.struct(F.col("to").alias("bucket"), F.lit(True).alias("tail"))
    is_head = F.col("head").eqNullSafe(F.col("doc_id"))
    return (
        dealt.join(first, "bucket")
        .select("doc_id", "text", F.explode(F.when(is_head, F.array(here, there)).otherwise(F.array(here))).alias("at"))
        .select("doc_id", "text", "at.bucket", "at.tail")
        .repartition(partitions, "bucket")
        .sortWithinPartitions("bucket", "tail", F.col("doc_id").desc_nulls_last(), F.xxhash64("text"))
    )


def fingerprint_edits(docs: DataFrame, partitions: int | None = None) -> DataFrame:
    """A row for each document: doc_id, n_chars, edited_sha256, fingerprint, edited_fingerprint, near_edited, near_next.

    The next document is the one with the next smaller doc_id, after the last the first; repeated ids follow each other
    by a hash of their text, null ids come last. A single document is its own next one. Null and empty texts have the
    fingerprint ``1::``. Likeness is 1 for equal fingerprints. Other columns are left out. The texts are shuffled once,
    by ranges of ids, and each task reads its range as a stream.
    """
    ordered = in_order(docs, partitions or shuffle_partitions(docs.sparkSession))
    id_type = arrow_schema(ordered.schema).field("doc_id").type
    names = ["doc_id", "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint", "near_edited", "near_next"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        previous, sent = None, set()
        out: list[tuple] = []

        def flush() -> pa.RecordBatch:
            ids, chars, sha, own, other, following = map(list, zip(*out))
            out.clear()
            columns = [pa.array(ids, id_type), pa.array(chars, pa.int64()), pa.array(sha), pa.array(own), pa.array(other)]
            near = [pa.array(likeness(own, other)), pa.array(likeness(own, following))]
            return pa.RecordBatch.from_arrays(columns + near, names=names)

        for batch in batches:
            for start in range(0, batch.num_rows, 256):
                for row in batch.slice(start, 256).to_pylist():
                    if row["tail"] and row["bucket"] in sent:
                        continue  # another document with the id of a bucket's first: the first is enough
                    if row["tail"]:
                        sent.add(row["bucket"])
                    own = fingerprint(row["text"])
                    if previous is not None and previous["bucket"] == row["bucket"]:
                        text = edited(previous["text"], row["text"])
                        digest = hashlib.sha256(text.encode("utf-8", "replace")).hexdigest()
                        out.append((previous["doc_id"], len(previous["text"]), digest, previous["own"], fingerprint(text), own))
                    previous = row | {"own": own}
                    if len(out) >= 1024:
                        yield flush()
        if out:
            yield flush()

    id_sql = ordered.schema["doc_id"].dataType.simpleString()
    kinds = "n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, near_edited double, near_next double"
    return ordered.mapInArrow(run, f"doc_id {id_sql}, {kinds}")
