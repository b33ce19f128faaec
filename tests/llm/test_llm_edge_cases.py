"""Nulls, empty and long texts, ties, repeated rows, empty tables and clashing column names, for every operator."""

import pytest

from tidemark.llm import fingerprints, lm, neighbours, packing, pieces, ranking, simhash, token_counts, toxicity, url_filters
from tidemark.llm.queries import tokenizer

KINDS = (
    "doc_id long, text string, lang string, source string, n_chars long, bits long, key long, bucket int, label int, "
    "in_u boolean, score double, tail boolean, n_tokens long, length long, `a.b` string"
)
EXTRA = (1, 2, 3, 0, True, 0.5, False, 9, 9, "x")
LONG = "word " * 30_000 + "x" * 200_000


def row(doc_id, text, lang="en", source=None):
    return (doc_id, text, lang, source, None, *EXTRA)


@pytest.fixture(scope="module")
def odd(spark):
    rows = [
        row(1, None), row(2, ""), row(3, "  \n\t "), row(4, "one two three four five"), row(4, "one two three four five"),
        row(5, "one two three four five", None), row(None, "no id at all here"), row(None, None), row(6, LONG), row(7, "héllo 日本語 🙂"),
        row(8, "a"),
    ]
    return spark.createDataFrame(rows, KINDS)


@pytest.fixture(scope="module")
def labels(spark):
    rows = [(i, i % 2, (i + 1) % 2, "x") for i in range(1, 9)] + [(None, 1, 1, "x"), (5, None, None, "x"), (4, 0, 1, "y"), (99, 1, 0, "z")]
    return spark.createDataFrame(rows, "doc_id long, quality int, toxic int, text string")


OPERATORS = {
    "toxicity": lambda d, l: toxicity.classify(d, l),
    "toxicity_filter": lambda d, l: toxicity.clean(d, l),
    "fingerprints": lambda d, l: fingerprints.fingerprint_edits(d),
    "quality": lambda d, l: ranking.rank(d, l),
    "quality_filter": lambda d, l: ranking.good(d, l),
    "simhash": lambda d, l: simhash.near_duplicates(d),
    "one_of_each": lambda d, l: simhash.one_of_each(d),
    "pieces": lambda d, l: pieces.encode_and_check(d, tokenizer("piece_bpe_32k.model")),
    "token_counts": lambda d, l: token_counts.count_tokens(d, tokenizer("piece_bpe_32k.model")),
    "lm": lambda d, l: lm.score(d, lm.train(d)),
    "packing": lambda d, l: packing.pack(d, tokenizer("word_bpe_49k.json")),
}
FILTERS = {"toxicity_filter", "quality_filter", "one_of_each"}


@pytest.mark.parametrize("name", OPERATORS)
def test_odd_rows_keep_their_place(odd, labels, name):
    result = OPERATORS[name](odd, labels)
    ids = [r["doc_id"] for r in result.select("doc_id").collect()]
    given = [r["doc_id"] for r in odd.select("doc_id").collect()]
    if name in FILTERS:
        assert result.columns == odd.columns
        assert set(ids) <= set(given)
    elif name == "packing":
        assert set(ids) == set(given)
    else:
        assert sorted(ids, key=str) == sorted(given, key=str)


@pytest.mark.parametrize("name", OPERATORS)
def test_empty_table(odd, labels, name):
    assert OPERATORS[name](odd.limit(0), labels).count() == 0


@pytest.mark.parametrize("name", OPERATORS)
def test_no_labels(odd, labels, name):
    if name.startswith(("toxicity", "quality")):
        assert OPERATORS[name](odd, labels.limit(0)).count() == odd.count()


def test_equal_texts_get_equal_results(odd, labels):
    for name, column in (("fingerprints", "fingerprint"), ("simhash", "component_id"), ("lm", "score"), ("quality", "score")):
        rows = OPERATORS[name](odd, labels).filter("doc_id in (4, 5)").collect()
        assert (name, len(rows), len({r[column] for r in rows})) == (name, 3, 1)


def test_repeated_documents_leave_one(odd, labels):
    kept = [r["doc_id"] for r in simhash.one_of_each(odd).collect()]
    assert kept.count(4) == 1 and 5 not in kept and kept.count(None) == 1  # the other null id has no words
    assert {1, 6, 7, 8} <= set(kept) and not {2, 3} & set(kept)  # 1, 2 and 3 have no words


def test_ids_do_not_make_copies(spark):
    rows = [(1, "one text"), (1, "quite another"), (None, "one text"), (None, "third"), (None, "third"), (0, "quite another")]
    kept = simhash.one_of_each(spark.createDataFrame(rows, "doc_id long, text string"))
    assert sorted(map(tuple, kept.collect()), key=str) == [(0, "quite another"), (1, "one text"), (None, "third")]


def test_url_filters_on_odd_pages(spark):
    pages = spark.createDataFrame(
        [
            (1, None, "h"), (2, "", "h"), (3, "no scheme", "h"), (4, "HTTP://A.Example.NET/en/x?y#z", "h"), (4, "HTTP://A.Example.NET/en/x?y#z", "h"),
            (None, "http://net", "h"), (5, "http://net/", "h"), (6, "://x.net/?q", "h"), (7, "http://fakenet/", "h"), (8, "a://b://c.net/", "h"),
            (9, "http://" + "a." * 5000 + "net/" + "p" * 5000, "h"),
        ],
        "page_id long, url string, host string",
    )
    rules = spark.createDataFrame([("net", "/", "block"), ("example.net", "/en/", "allow"), (None, "/", "block")], "host string, path string, verdict string")
    found = {(r["page_id"], r["host"][:12], r["path"][:8], r["rule"], r["verdict"]) for r in url_filters.judge(pages, rules).collect()}
    assert url_filters.judge(pages, rules).count() == pages.count()
    assert (4, "a.example.ne", "/en/x", "example.net/en/", "allow") in found
    assert (None, "net", "", None, "allow") in found and (5, "net", "/", "net/", "block") in found
    assert (6, "x.net", "/", "net/", "block") in found and (7, "fakenet", "/", None, "allow") in found
    assert (8, "b:", "//c.net/", None, "allow") in found and (1, "", "", None, "allow") in found
    assert any(f[0] == 9 and f[3] == "net/" for f in found)
    assert url_filters.judge(pages, rules.limit(0)).filter("verdict <> 'allow'").count() == 0
    assert url_filters.judge(pages.limit(0), rules).count() == 0


def test_neighbours_leave_out_unusable_vectors(spark):
    nan, inf = float("nan"), float("inf")
    rows = [
        (0, [1.0, 0.0], 0), (100, [0.0, 1.0], 0), (1, [1.0, 0.0], 0), (2, [0.5, 0.5], 0), (2, [0.5, 0.5], 0), (3, None, 0), (4, [0.0, 0.0], 0),
        (5, [nan, 1.0], 0), (6, [inf, 1.0], 0), (7, [None, 1.0], 0), (8, [1.0, 2.0, 3.0], 0), (None, [1.0, 1.0], 0), (200, None, 0),
    ]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>, node int")
    found = [tuple(r) for r in neighbours.nearest(df, lambda i: i % 100 == 0).orderBy("query_id", "rank").collect()]
    half = 0.5**0.5
    assert found == [(0, 1, 1, 0.0), (0, 2, 2, half), (0, 3, 100, 2**0.5), (100, 1, 2, half), (100, 2, 0, 2**0.5), (100, 3, 1, 2**0.5)]
    assert neighbours.nearest(df.limit(0), lambda i: i % 100 == 0).count() == 0
    assert neighbours.nearest(df.filter("vec_id = 0"), lambda i: i % 100 == 0).count() == 0
