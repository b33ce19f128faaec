"""Operators against brute force, the libraries, round trips and held-out labels, over the given tables."""

import os
import zlib
from collections import Counter

import numpy as np
import pytest
import xxhash
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from tidemark.llm import bpe, fingerprints, lm, neighbours, packing, pieces, simhash, toxicity
from tidemark.llm.common import words
from tidemark.llm.queries import ORACLES, QUERIES, tokenizer

MODEL = tokenizer("piece_bpe_32k.model")


@pytest.fixture(scope="module")
def docs(spark, sf_dir):
    return {r["doc_id"]: r["text"] for r in spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text").collect()}


@pytest.fixture(scope="module")
def library():
    import sentencepiece

    return sentencepiece.SentencePieceProcessor(model_file=MODEL)


def rows(spark, sf_dir, name):
    return {r["doc_id"]: r for r in QUERIES[name](spark, sf_dir).collect()}


def test_every_operator_has_one_query():
    assert sorted(int(n[2:].split("_")[0]) for n in QUERIES) == list(range(1, 14))


def test_url_filters_match_sql(spark, sf_dir):
    from oracle_check import connect

    got = sorted(map(str, (tuple(r) for r in QUERIES["op8_url_filters"](spark, sf_dir).collect())))
    want = sorted(map(str, connect(sf_dir).execute(ORACLES["op8_url_filters"]).fetchall()))
    assert got == want


@pytest.mark.parametrize("name, label, folds, held", [("op1_toxicity_nnpu", "toxic", 4, 2), ("op3_quality_ranking", "quality", 5, 0)])
def test_classifier_folds_and_scores(spark, sf_dir, name, label, folds, held):
    found = rows(spark, sf_dir, name)
    assert all(r["held_out"] == (zlib.crc32(str(i).encode()) % folds == held) for i, r in found.items())
    assert all(0 <= r["score"] <= 1 and r["predicted"] == (r["score"] >= 0.3) for r in found.values())
    truth = {r["doc_id"]: r[label] for r in spark.read.parquet(f"{sf_dir}/labels.parquet").collect()}
    hits = [found[i]["predicted"] == v for i, v in truth.items() if i in found]
    assert np.mean(hits) > 0.85


def test_toxicity_without_signal(spark, sf_dir):
    """Few labels, or labels that tell nothing: clean documents stay."""
    docs, labels = (spark.read.parquet(f"{sf_dir}/{t}.parquet") for t in ("documents", "labels"))
    clean = docs.join(labels.filter("toxic = 0"), "doc_id", "left_semi")
    assert toxicity.clean(docs, labels).join(clean.select("doc_id"), "doc_id").count() == clean.count()
    noise = labels.withColumn("toxic", (F.crc32(F.col("doc_id").cast("string").cast("binary")) % 3 == 0).cast("int"))
    assert toxicity.clean(docs, noise).count() >= 0.9 * docs.count()


def test_toxicity_on_held_out_labels(spark, sf_dir):
    larger = os.path.join(os.path.dirname(sf_dir.rstrip("/")), "sf0.01")
    if not os.path.isdir(larger):
        pytest.skip("no larger tables")
    truth = {r["doc_id"]: r["toxic"] for r in spark.read.parquet(f"{larger}/labels.parquet").collect()}
    held = [(truth[i], r["predicted"]) for i, r in rows(spark, larger, "op1_toxicity_nnpu").items() if r["held_out"] and i in truth]
    hits = sum(t and p for t, p in held)
    assert hits >= 0.5 * sum(t for t, _ in held) and hits >= 0.8 * sum(p for _, p in held)


def test_piecewise_fingerprints(spark, sf_dir, docs):
    found = rows(spark, sf_dir, "op2_piecewise_fingerprints")
    order = sorted(docs, reverse=True)
    import hashlib

    for i, following in zip(order, order[1:] + order[:1]):
        n = len(docs[i]) // 3
        text = docs[i][: len(docs[i]) - n] + docs[following][:n]
        assert found[i]["edited_sha256"] == hashlib.sha256(text.encode()).hexdigest()
        assert found[i]["fingerprint"] == fingerprints.fingerprint(docs[i])
        assert found[i]["edited_fingerprint"] == fingerprints.fingerprint(text)
    long = [r for r in found.values() if r["n_chars"] > 300]
    assert np.mean([r["near_edited"] > 0.5 for r in long]) > 0.95 and np.mean([r["near_next"] < 0.2 for r in long]) > 0.95


def test_fingerprint_of_parts_of_a_long_text(monkeypatch):
    text = " ".join(str(i * i) for i in range(9000))
    whole = fingerprints.fingerprint(text)
    monkeypatch.setattr(fingerprints, "PART", 1 << 13)
    fingerprints.powers.cache_clear()
    assert fingerprints.fingerprint(text) == whole
    monkeypatch.undo()
    fingerprints.powers.cache_clear()


def subsequence(a, b):
    table = [[0] * (len(b) + 1) for _ in range(len(a) + 1)]
    for i, x in enumerate(a):
        for j, y in enumerate(b):
            table[i + 1][j + 1] = table[i][j] + 1 if x == y else max(table[i][j + 1], table[i + 1][j])
    return table[-1][-1]


@settings(max_examples=60, deadline=None)
@given(st.text("abcd", min_size=1, max_size=64), st.text("abcd", min_size=1, max_size=64))
def test_edit_distance(a, b):
    (x, n), (y, m) = fingerprints.matrix([a]), fingerprints.matrix([b])
    assert fingerprints.common_length(x, y, m)[0] == subsequence(a, b)
    run = min(len(a), len(b), fingerprints.RUN)
    assert fingerprints.shares_run(x, y, n, m)[0] == any(a[i : i + run] in b for i in range(len(a) - run + 1))


def brute_components(bits):
    ids = sorted(bits)
    parent = {i: i for i in ids}

    def root(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for k, i in enumerate(ids):
        for j in ids[:k]:
            if (bits[i] ^ bits[j]).bit_count() <= 2:
                a, b = root(i), root(j)
                parent[max(a, b)] = min(a, b)
    return {i: root(i) for i in ids}


def test_simhash_components(spark, sf_dir, docs):
    bits = {}
    for i, t in docs.items():
        w = words(t)
        hashes = [xxhash.xxh64_intdigest(b" ".join(w[k : k + 3]), 42) for k in range(max(1, len(w) - 2))] if w else []
        bits[i] = sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes)) if hashes else 0
    found = rows(spark, sf_dir, "op5_simhash_near_dedup")
    assert {i: r["fingerprint"] for i, r in found.items()} == {i: f"{b:016x}" for i, b in bits.items()}
    assert {i: r["component_id"] for i, r in found.items()} == brute_components(bits)


def test_links_among_clustered_fingerprints(spark):
    rng = np.random.default_rng(1)
    values = set()
    for centre in rng.integers(0, 1 << 63, 6).tolist():
        for _ in range(60):
            value = centre
            for b in rng.integers(0, 64, rng.integers(0, 4)).tolist():
                value ^= 1 << b
            values.add(value - (1 << 64) if value >> 63 else value)
    values = sorted(values)
    found = {(r["a"], r["b"]) for r in simhash.links(spark.createDataFrame([(v,) for v in values], "bits long")).collect()}
    mask = (1 << 64) - 1
    assert found == {(a, b) for i, a in enumerate(values) for b in values[i + 1 :] if ((a ^ b) & mask).bit_count() <= 2}


ODD = ["", "  a ", " ", "▁▁x", "héllo\n\n\tworld  日本語🙂 x", "a" * 300, "ab " * 50 + "   " * 20, "\x00\x01z", "éá", "word" * 100 + " end", "</s><s> <unk>"]


def test_sentencepiece_matches_the_library(spark, sf_dir, docs, library):
    encoder = pieces.encoder(MODEL)
    assert encoder.encode_all(ODD) == [library.encode(t) for t in ODD]
    found = rows(spark, sf_dir, "op6_sentencepiece")
    assert all(r["ids"] == library.encode(docs[i]) and r["round_trip"] for i, r in found.items())
    encoded = spark.createDataFrame([(i, r["ids"]) for i, r in found.items()], "doc_id long, ids array<int>")
    assert {r["doc_id"]: r["text"] for r in pieces.decode(encoded, MODEL).collect()} == docs


@settings(max_examples=80, deadline=None)
@given(st.text(st.sampled_from("ab thein▁\n é日🙂."), max_size=80))
def test_merges_match_the_library(text):
    import sentencepiece

    model = sentencepiece.SentencePieceProcessor(model_file=MODEL)
    vocabulary = bpe.vocabulary(MODEL)
    want = model.encode(text)
    assert [i for p in bpe.pre_tokens(text) for i in vocabulary.encode(p)] == want
    assert pieces.encoder(MODEL).encode_all([text]) == [want]


def test_token_counts_match_the_library(spark, sf_dir, docs, library):
    found = rows(spark, sf_dir, "op7_token_counts")
    assert all(r["n_tokens"] == len(library.encode(docs[i])) and r["n_bytes"] == len(docs[i].encode()) for i, r in found.items())
    assert all(r["over_limit"] == (r["n_tokens"] > 4096) for r in found.values())


def test_neighbours_recall(spark, sf_dir):
    table = spark.read.parquet(f"{sf_dir}/embeddings.parquet").collect()
    ids, x = np.array([r["vec_id"] for r in table]), np.array([r["embedding"] for r in table], float)
    got: dict[int, list] = {}
    for r in sorted(QUERIES["op4_nn_descent"](spark, sf_dir).collect(), key=lambda r: (r["query_id"], r["rank"])):
        got.setdefault(r["query_id"], []).append((r["vec_id"], r["score"]))
    hits = 0
    for q in ids[ids % 100 == 0].tolist():
        d = np.sqrt(((x - x[ids == q]) ** 2).sum(1))
        d[ids == q] = np.inf
        order = np.lexsort((ids, d))[:10]
        hits += len({v for v, _ in got[q]} & set(ids[order].tolist()))
        assert np.allclose([s for _, s in got[q]], [d[ids == v][0] for v, _ in got[q]], atol=1e-12)
    assert hits / (10 * len(got)) >= 0.9


def test_equal_vectors_come_back_whole(spark):
    rng = np.random.default_rng(2)
    rows = [(i, [1.0, 2.0, 3.0, 4.0] if i % 3 == 0 else rng.standard_normal(4).tolist()) for i in range(600)]
    found = neighbours.nearest(spark.createDataFrame(rows, "vec_id long, embedding array<double>"), lambda i: i == 300).orderBy("rank").collect()
    assert [(r["vec_id"], r["score"]) for r in found] == [(3 * i, 0.0) for i in range(10)]


def test_elias_fano_sequence():
    rng = np.random.default_rng(3)
    for keys in (rng.integers(0, 1 << 62, 3000), rng.integers(0, 5000, 4000), np.array([7]), np.arange(9), np.r_[0, np.arange(1 << 40, (1 << 40) + 900)]):
        keys = np.unique(keys)
        s = lm.Sequence(lm.Sequence.encode(keys))
        assert (s.get(np.arange(len(keys))) == keys).all()
        probes = np.concatenate([keys, keys + 1, keys - 1, [0, 1 << 62]])
        assert (s.rank(probes) == np.searchsorted(keys, probes)).all()
        assert (s.find(probes) == [np.searchsorted(keys, p) if p in set(keys.tolist()) else -1 for p in probes]).all()


def test_language_model_matches_plain_counts(spark, sf_dir, docs):
    found = rows(spark, sf_dir, "op9_lm_scoring")
    tokens = {i: [*words(t), lm.END] for i, t in docs.items()}
    learned = [tokens[i] for i in docs if zlib.crc32(str(i).encode()) % 7 != 2]
    c = Counter(w for t in learned for w in t)
    pairs = {k: v for k, v in Counter(p for t in learned for p in zip(t, t[1:])).items()}
    triples = {k: v for k, v in Counter(p for t in learned for p in zip(t, t[1:], t[2:])).items()}
    n, v, discount = sum(c.values()), len(c), 0.75
    left, left2 = Counter(), Counter()
    for (a, _), k in pairs.items():
        left[a] += k - discount
    for (a, b, _), k in triples.items():
        left2[a, b] += k - discount
    unknown = (sum(k == 1 for k in c.values()) + 1) / (n + 2)

    def p(w, b=None, a=None):
        if a is not None and (a, b) in pairs:
            return max(triples.get((a, b, w), 0) - discount, 0) / pairs[a, b] + (1 - left2[a, b] / pairs[a, b]) * p(w, b)
        if b is not None:
            return (max(pairs.get((b, w), 0) - discount, 0) / c[b] if c[b] else 0) + (1 - left[b] / c[b] if c[b] else 1) * p(w)
        return (1 - unknown) * c[w] / n if c[w] else unknown

    for i in list(docs)[:60]:
        t, r = tokens[i], found[i]
        score = sum(np.log10(p(w, *reversed(t[max(0, k - 2) : k]))) for k, w in enumerate(t))
        base = sum(np.log10((c[w] + 1) / (n + v + 1)) for w in t)
        assert abs(r["score"] - score) < 3e-4 * len(t) and abs(r["base_score"] - base) < 1e-9 * len(t)
        assert (r["n_tokens"], r["n_known"], r["train_tokens"]) == (len(t), sum(c[w] > 0 for w in t), n)
    held = [r for r in found.values() if r["held_out"]]
    assert sum(r["score"] for r in held) > sum(r["base_score"] for r in held)


def test_packing(spark, sf_dir, docs):
    from tokenizers import Tokenizer

    model = Tokenizer.from_file(tokenizer("word_bpe_49k.json"))
    ids = {i: model.encode(t, add_special_tokens=False).ids + [2] for i, t in docs.items()}
    found = QUERIES["op10_packing"](spark, sf_dir).collect()
    total = Counter()
    sequences: dict[int, list] = {}
    for r in found:
        piece = ids[r["doc_id"]][r["start"] : r["start"] + r["length"]]
        assert len(piece) == r["length"] and r["doc_tokens"] == len(ids[r["doc_id"]])
        assert zlib.crc32(np.array(piece, "<u4").tobytes()) == r["ids_crc32"]
        total[r["doc_id"]] += r["length"]
        sequences.setdefault(r["sequence_id"], []).append((r["offset"], r["length"]))
    assert total == {i: len(v) for i, v in ids.items()}
    for spans in sequences.values():
        at = 0
        for offset, length in sorted(spans):
            assert offset == at
            at += length
        assert at <= 4096
    assert 4096 * len(sequences) < 1.06 * sum(total.values())


TEXTS = ["", " a ", "dog's it's O'Neil's WE'LL", "İstanbul ΑΣ. ΑΣΣ", "<|endoftext|> x<|startoftext|>y", "A1b2 3.14 x_y ###!! of%%% ª º ½ ﬁ ẞ Straße. \x1c \x85 x", "l'été. 's're ’s " * 9]


@settings(max_examples=60, deadline=None)
@given(st.text(st.sampled_from("aB'éÉ.,!_ \n1½İσΣ日🙂<|>"), max_size=60))
def test_chunks_match_the_tokenizer(text):
    known = packing.chunk_ids(tokenizer("word_bpe_49k.json"))
    for t in [text, *TEXTS]:
        (got,) = known.encode_all([t])
        assert np.frombuffer(got, "<u4").tolist() == known.tokenizer.encode(t, add_special_tokens=False).ids


@pytest.mark.parametrize("text", ["\u0130<", "x\u0130.,", "\u0958!", "\u0130 <", "Stra\u00dfe!", "\u01c5?"])
def test_marks_that_lowering_makes_join_the_punctuation(text):
    known = packing.Chunks(tokenizer("word_bpe_49k.json"))
    (got,) = known.encode_all([text])
    assert np.frombuffer(got, "<u4").tolist() == known.tokenizer.encode(text, add_special_tokens=False).ids


@settings(max_examples=100, deadline=None)
@given(st.dictionaries(st.integers(1, 64), st.integers(1, 40), max_size=20))
def test_shortest_pack_first(histogram):
    patterns = packing.shortest_pack_first(histogram, 64)
    assert all(sum(p) <= 64 and n > 0 for p, n in patterns)
    placed = Counter()
    for p, n in patterns:
        for length in p:
            placed[length] += n
    assert placed == histogram
    assert len(patterns) <= 4 * len(histogram) + 4
