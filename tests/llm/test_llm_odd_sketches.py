"""MinHash near duplicates with odd sketches against comparison of all pairs of shingle sets."""

from fractions import Fraction

import numpy as np
import pytest

from tidemark.llm import odd_sketches
from tidemark.llm.queries import QUERIES


def sets_of(texts):
    found = {}
    for i, text in texts.items():
        w = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "").encode().split()
        found[i] = {tuple(w[k : k + 5]) for k in range(max(1, len(w) - 4))} if w else set()
    return found


def brute(texts):
    sets, order = sets_of(texts), sorted(texts)
    root = {i: i for i in order}

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for k, i in enumerate(order):
        for j in order[:k]:
            if sets[i] and sets[j] and min(len(sets[i]), len(sets[j])) * 100 >= 85 * max(len(sets[i]), len(sets[j])):
                if 100 * len(sets[i] & sets[j]) >= 85 * len(sets[i] | sets[j]):
                    a, b = find(i), find(j)
                    root[max(a, b)] = min(a, b)
    return {i: (len(sets[i]), find(i), find(i) == i) for i in order}


def shown(df):
    return {r["doc_id"]: (r["n_shingles"], r["component_id"], r["kept"]) for r in df.collect()}


def test_query(spark, sf_dir):
    docs = {r["doc_id"]: r["text"] for r in spark.read.parquet(f"{sf_dir}/documents.parquet").collect()}
    assert shown(QUERIES["op13_odd_sketch_near_dedup"](spark, sf_dir)) == brute(docs)


@pytest.fixture(scope="module")
def groups():
    """Texts in groups whose members lie about the limit: chains, dense groups and near misses."""
    rng = np.random.default_rng(5)
    texts = {}
    for g in range(4):
        base = [f"g{g}w{k}" for k in range(90 + 40 * g)]
        for _ in range(45):
            copy = list(base)
            for at in rng.integers(0, len(copy), rng.integers(0, 3)):
                copy[at] = f"x{rng.integers(0, 50)}"
            texts[len(texts)] = " ".join(copy[: len(copy) - rng.integers(0, 12)])
    return texts


@pytest.mark.parametrize("block", [256, 8])
def test_groups_about_the_limit(spark, monkeypatch, groups, block):
    monkeypatch.setattr(odd_sketches, "BLOCK", block)
    df = spark.createDataFrame(list(groups.items()), "doc_id long, text string").repartition(5)
    want = brute(groups)
    assert shown(odd_sketches.near_duplicates(df)) == want
    assert 4 <= len({c for _, c, _ in want.values()}) < len(groups)


def test_sketches_tell_similarity():
    rng = np.random.default_rng(3)
    for similarity in (0.98, 0.9, 0.85):
        shared = rng.integers(0, 1 << 62, int(2000 * similarity), dtype=np.uint64)
        own = rng.integers(0, 1 << 62, (2, (2000 - len(shared)) // 2), dtype=np.uint64)
        made = np.stack([odd_sketches.samples(np.concatenate([shared, o])) for o in own])
        sketch = odd_sketches.marks(made)[1]
        ones = int(np.bitwise_count(sketch[0] ^ sketch[1]).sum())
        told = 1 + odd_sketches.BITS / (4 * odd_sketches.SAMPLES) * np.log(1 - 2 * ones / odd_sketches.BITS)
        assert abs(told - similarity) < 0.09 and ones <= odd_sketches.most_ones(Fraction(85, 100))
    apart = odd_sketches.marks(np.stack([odd_sketches.samples(rng.integers(0, 1 << 62, 500, dtype=np.uint64)) for _ in range(2)]))[1]
    assert np.bitwise_count(apart[0] ^ apart[1]).sum() > odd_sketches.most_ones(Fraction(85, 100))


def test_odd_rows(spark):
    long = "word " * 30_000 + " ".join(f"v{k}" for k in range(9000))
    rows = [
        (9, None), (3, ""), (4, " \t\n"), (5, "a b"), (2, "A  b"), (6, "a c"), (None, "a b"), (None, "only null"), (None, None),
        (7, long), (8, long + " end"), (8, "other text than the other eight here"), (1, "one"), (1, "one"),
    ]
    docs = spark.createDataFrame([(*r, 0, "x") for r in rows], "doc_id long, text string, n int, node string")
    found = sorted((tuple(r) for r in odd_sketches.near_duplicates(docs).collect()), key=str)
    want = [
        (9, 0, 9, True), (3, 0, 3, True), (4, 0, 4, True), (5, 1, 2, False), (2, 1, 2, True), (6, 1, 6, True), (None, 1, 2, False),
        (None, 1, None, True), (None, 0, None, True), (7, 9001, 7, True), (8, 9002, 7, False), (8, 3, 8, True), (1, 1, 1, True), (1, 1, 1, True),
    ]
    assert len(found) == len(want)
    assert {(f[0], f[2], f[3]) for f in found} == {(w[0], w[2], w[3]) for w in want}
    assert odd_sketches.near_duplicates(docs.limit(0)).count() == 0
