"""Nothing is left out of a result for being rare, far apart or oddly scaled."""

from collections import Counter

import numpy as np
import xxhash

import corpus_pipeline
from tidemark.llm import lm, ranking
from tidemark.llm.common import fold_of, words


def test_language_model_keeps_ngrams_seen_once(spark):
    learned = [i for i in range(40) if fold_of(i, 7) != 2][:4]
    texts = ["a b c d e f", "a b d c e g", "f e d c b a", "g a b c f"]
    asked = next(i for i in range(40) if fold_of(i, 7) == 2)
    docs = spark.createDataFrame([*zip(learned, texts), (asked, "a b c f e new d c")], "doc_id long, text string")
    split = [[*words(t), lm.END] for t in texts]
    one, two, three = (Counter(x for t in split for x in zip(*(t[k:] for k in range(n)))) for n in (1, 2, 3))
    n, discount = sum(one.values()), 0.75
    unknown = (sum(k == 1 for k in one.values()) + 1) / (n + 2)

    def p(context, w):
        if not context:
            return (1 - unknown) * one[w,] / n if one[w,] else unknown
        table = (one, two, three)[len(context)]
        total = (one, two)[len(context) - 1][context]
        if not total:
            return p(context[1:], w)
        kinds = sum(k[:-1] == context for k in table)
        return max(table[*context, w] - discount, 0) / total + discount * kinds / total * p(context[1:], w)

    found = {r["doc_id"]: r["score"] for r in lm.score(docs, lm.train(docs)).collect()}
    for i, t in [*zip(learned, split), (asked, [*words("a b c f e new d c"), lm.END])]:
        want = sum(np.log10(p(tuple(t[max(0, k - 2) : k]), w)) for k, w in enumerate(t))
        assert abs(found[i] - want) < 3e-4 * len(t)


def simhash_of(text):
    w = text.encode().split()
    hashes = [xxhash.xxh64_intdigest(b" ".join(w[k : k + 3]), 42) for k in range(max(1, len(w) - 2))]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def test_near_duplicates_stage_links_every_near_fingerprint(spark, sf_dir):
    """The stage calls the SimHash operator: three-word shingles, at most two differing bits."""
    rng = np.random.default_rng(5)
    made = []
    for _ in range(25):
        base = rng.integers(0, 400, 120)
        for changes in (0, 1, 1, 2, 3, 4, 6, 9):
            copy = base.copy()
            copy[rng.integers(0, 120, changes)] = rng.integers(400, 800, changes)
            made.append(" ".join(map(str, copy)))
    bits = [simhash_of(t) for t in made]
    group = list(range(len(made)))
    for i, x in enumerate(bits):
        for j, y in enumerate(bits[:i]):
            if (x ^ y).bit_count() <= 2:
                old, new = max(group[i], group[j]), min(group[i], group[j])
                group = [new if g == old else g for g in group]
    docs = spark.createDataFrame([*enumerate(made)], "doc_id long, text string")
    kept = {r["doc_id"] for r in corpus_pipeline.near_duplicates(spark, docs, sf_dir).collect()}
    assert kept == set(group) and 25 <= len(kept) < len(made)


def test_near_duplicates_stage_goes_by_text_not_by_id(spark, sf_dir):
    a, b, c = (" ".join(f"{w}{k}" for k in range(30)) for w in "abc")
    rows = [(1, a), (2, a), (2, b), (3, c), (3, b), (None, a), (None, "only here"), (None, "only here"), (4, None), (None, "")]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    kept = sorted(((r["doc_id"], r["text"]) for r in corpus_pipeline.near_duplicates(spark, docs, sf_dir).collect()), key=str)
    assert kept == sorted([(1, a), (2, b), (3, c), (None, "only here"), (4, None)], key=str)


def test_language_model_parts_and_buffers_change_no_score(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    whole, cut = lm.train(docs), lm.train(docs.repartition(5), part_tokens=4000, buffer=900)
    assert len(cut.pairs.uris) > 4 and len(cut.triples.uris) > 4
    assert (cut.pairs.size, cut.triples.size, cut.tokens) == (whole.pairs.size, whole.triples.size, whole.tokens)
    one, other = (dict(lm.score(docs, m).select("doc_id", "score").collect()) for m in (whole, cut))
    assert one == other


def test_language_model_tokens_are_the_common_words():
    some = ["", " \t\n", "a", " A\x0bb\x0c\r É\x1c\x85 \xa0x ", "\x00 Σ😀  İ"]
    place, hashes, offsets = lm.tokens_of(some)
    found = [hashes[place[a:b]].tolist() for a, b in zip(offsets[:-1], offsets[1:])]
    assert found == [lm.hashes_of([*words(t), lm.END]).tolist() for t in some]


def test_language_model_keeps_large_counts(tmp_path):
    n = np.array([1, 254, 255, 256, 7, 1 << 40])
    lm.write_shard(str(tmp_path / "s"), lm.Sequence.encode(np.arange(6) * 3) | lm.narrow(n))
    level = lm.Level((str(tmp_path / "s"),), np.array([0]), np.array([0]), 6)
    assert level.counts(np.array([5, 2, 0, 1, 3, 4, 2])).tolist() == [1 << 40, 255, 1, 254, 256, 7, 255]


def test_ranking_learns_from_every_label(spark):
    """The one trait that tells the labels apart is met in a few of many labelled rows, and every row counts for the cut."""
    shape = "doc_id long, text string"
    texts = [(i, f"word{i} and some more words, in a line {i % 7}") for i in range(9000)]
    texts += [(9000 + i, f"word{i} #### $$$$ {i}") for i in range(400)]
    docs = spark.createDataFrame(texts, shape)
    labels = spark.createDataFrame([(i, int(i < 9000)) for i, _ in texts], "doc_id long, quality int")
    model = ranking.fit(docs, labels, block_rows=256)
    assert model is not None
    got = {r["doc_id"]: r["predicted"] for r in ranking.score(docs, model).collect()}
    assert got == {i: int(i < 9000) for i, _ in texts}
    seen = spark.createDataFrame(texts, shape).join(labels, "doc_id").groupBy("quality").count().collect()
    assert {r["quality"]: r["count"] for r in seen} == {1: 9000, 0: 400}
    mean = np.mean([ranking.features([t])[0] for _, t in texts], axis=0)
    assert np.allclose(model.centre, mean)  # of all rows, not of some
