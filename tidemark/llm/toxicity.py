"""Toxicity by non-negative positive-unlabelled learning.

Confirmed toxic documents (P) and documents whose labels are not looked at (U) train a linear classifier on word and
word-beginning features. With the class prior p, the risk on negatives is estimated as E_U[l(-g)] - p E_P[l(-g)]; where
that estimate falls below zero the step climbs it again, which keeps a flexible model from fitting it away. The cut
that is reported as 0.3 is then chosen on the labelled rows of the training folds.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import arrow_schema, col, fold, rows_of, texts

WORD = re.compile(r"[^\W\d_]+")
BEGINNINGS = (3, 4, 5, 6)
CUT = 0.3  # scores from here on are predicted 1


def features_of(word: str) -> list[str]:
    return [word, *(f"^{word[:n]}" for n in BEGINNINGS if len(word) > n)]


class Lookup(dict):
    """Word -> positions of its known features; bounded, restarted when full. Words without any share one empty tuple."""

    def __init__(self, known: dict[str, int], limit: int = 600_000):
        self.known, self.limit = known, limit
        super().__init__()

    def __missing__(self, word: str) -> tuple[int, ...]:
        found = tuple(self.known[f] for f in features_of(word) if f in self.known)
        if len(word) <= 64:
            if len(self) >= self.limit:
                self.clear()
            self[word] = found
        return found

    def positions(self, text: str) -> set[int]:
        return set().union(*map(self.__getitem__, set(WORD.findall(text.lower()))))


@dataclass(frozen=True)
class Model:
    known: dict[str, int]
    weights: np.ndarray
    bias: float
    middle: float  # the raw score in 0..1 that becomes CUT

    def scores(self, found: list[set[int]]) -> np.ndarray:
        raw = np.array([self.bias + self.weights[sorted(f)].sum() for f in found])
        return recut(1 / (1 + np.exp(-np.clip(raw, -30, 30))), self.middle)


def recut(score: np.ndarray, middle: float) -> np.ndarray:
    """A rising map of 0..1 to itself that takes ``middle`` to CUT."""
    high = CUT + (1 - CUT) * (score - middle) / max(1 - middle, 1e-12)
    return np.where(score < middle, CUT * score / max(middle, 1e-12), np.minimum(high, 1.0))


def best_cut(score: np.ndarray, label: np.ndarray) -> float:
    """Halfway between neighbouring scores where predicting 1 from there on has the best F1.

    1 (nothing is predicted) where no cut does better than predicting 1 for all: such scores tell nothing.
    """
    order = np.argsort(-score, kind="stable")
    s, hits = score[order], np.cumsum(label[order])
    f1 = 2 * hits / (np.arange(1, len(s) + 1) + max(label.sum(), 1))
    f1[:-1][s[:-1] == s[1:]] = -1
    at = int(np.argmax(f1))
    if f1[at] <= f1[-1]:
        return 1.0
    return float((s[at] + s[at + 1]) / 2 if at + 1 < len(s) else s[at] / 2)


def train_nnpu(
    rows: np.ndarray, offsets: np.ndarray, positive: np.ndarray, width: int, prior: float,
    steps: int = 150, rate: float = 0.05, decay: float = 1e-4,
) -> tuple[np.ndarray, float]:
    """Weights and bias. ``rows[offsets[i]:offsets[i + 1]]``: features of document i; positive: P, the rest is U.

    Logistic loss, Adam steps on all rows at once.
    """
    lengths = np.diff(offsets)
    owner = np.repeat(np.arange(len(lengths)), lengths)
    share = np.where(positive, 1 / max(positive.sum(), 1), 1 / max((~positive).sum(), 1))
    weights, first, second = (np.zeros(width + 1) for _ in range(3))
    for step in range(1, steps + 1):
        g = np.bincount(owner, weights[rows], len(lengths)) + weights[-1]
        s = 1 / (1 + np.exp(-np.clip(g, -30, 30)))
        loss_as_negative = np.logaddexp(0, g) * share
        negative_risk = loss_as_negative[~positive].sum() - prior * loss_as_negative[positive].sum()
        slope_negative = share * s * np.where(positive, -prior, 1.0)  # of the risk on negatives
        slope = slope_negative + np.where(positive, prior * share * (s - 1), 0) if negative_risk >= 0 else -slope_negative
        gradient = np.append(np.bincount(rows, slope[owner], width), slope.sum()) + decay * weights
        first = 0.9 * first + 0.1 * gradient
        second = 0.999 * second + 0.001 * gradient**2
        weights -= rate * (first / (1 - 0.9**step)) / (np.sqrt(second / (1 - 0.999**step)) + 1e-8)
    return weights[:-1], float(weights[-1])


def sample(labels: DataFrame, label_col: str, positives: int, unlabelled: int) -> DataFrame:
    """Up to so many toxic and so many other labelled ids, in the order of a hash: doc_id, label, in_u."""
    known = labels.groupBy("doc_id").agg(F.max(col(label_col)).alias("label")).dropna()
    mixed = F.xxhash64("doc_id")
    p = known.filter("label = 1").orderBy(mixed, "doc_id").limit(positives).withColumn("in_u", F.lit(False))
    u = known.orderBy(F.xxhash64(mixed), "doc_id").limit(unlabelled).withColumn("in_u", F.lit(True))
    return p.union(u)


def fit(
    docs: DataFrame, labels: DataFrame, label_col: str = "toxic", positives: int = 3000, unlabelled: int = 6000,
    least_documents: int = 8,
) -> Model:
    """Train on at most ``positives`` toxic rows (P) and ``unlabelled`` rows (U, labels unseen) of ``labels``.

    The class prior is the share of toxic rows among all of ``labels``. Features occur in at least ``least_documents``
    sampled documents, or, with fewer toxic ones than that, in as many as there are (2 at least). Without any toxic row, or where the
    sample tells nothing about toxicity, no text is predicted toxic.
    """
    facts = labels.agg(F.avg(F.when(col(label_col) == 1, 1.0).when(col(label_col) == 0, 0.0)).alias("prior")).first()
    if not facts["prior"]:
        return Model({}, np.zeros(0), -30.0, 0.5)
    chosen = F.broadcast(sample(labels, label_col, positives, unlabelled))
    drawn = texts(docs).dropna(subset=["doc_id"]).join(chosen, "doc_id")

    def counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for _, values in rows_of(batches):
            seen: Counter[str] = Counter()
            for t in values:
                seen.update({f for w in set(WORD.findall(t.lower())) for f in features_of(w)})
            yield pa.RecordBatch.from_arrays(
                [pa.array(list(seen), pa.string()), pa.array(list(seen.values()), pa.int64())], names=["feature", "n"]
            )

    totals = drawn.mapInArrow(counted, "feature string, n long").groupBy("feature").agg(F.sum("n").alias("n"))
    toxic = drawn.filter(~F.col("in_u")).select("doc_id").distinct().count()
    least_documents = min(least_documents, max(toxic, 2))
    known = {f: i for i, f in enumerate(sorted(r[0] for r in totals.filter(F.col("n") >= least_documents).collect()))}

    def indexed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        lookup = Lookup(known)
        for batch in batches:
            found = [np.array(sorted(lookup.positions(t)), "<i4").tobytes() for t in batch.column("text").to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [batch.column("label"), batch.column("in_u"), pa.array(found, pa.binary())],
                names=["label", "in_u", "found"],
            )

    label_sql = drawn.schema["label"].dataType.simpleString()
    got = drawn.mapInArrow(indexed, f"label {label_sql}, in_u boolean, found binary").toArrow()
    label, in_u = np.array(got["label"].to_pylist()), np.array(got["in_u"].to_pylist(), bool)
    found = [np.frombuffer(f, "<i4") for f in got["found"].to_pylist()]
    if in_u.all() or not in_u.any():
        return Model({}, np.zeros(0), -30.0, 0.5)
    names = np.array(list(known))
    parts = np.arange(len(found)) % 5  # cross-fitted scores place the cut: a model's own rows would flatter it
    apart = np.empty(len(found))
    for part in range(5):
        kept, weights, bias = fit_rows([f for f, k in zip(found, parts) if k != part], in_u[parts != part], len(known), facts["prior"])
        scale = np.zeros(len(known))
        scale[kept] = weights
        told = np.zeros(len(known), bool)
        told[kept] = True
        # A text without a kept feature gets the least score: how the parts' biases differ must not decide.
        apart[parts == part] = [scale[f].sum() + bias if told[f].any() else -30 for f, k in zip(found, parts) if k == part]
    middle = best_cut(1 / (1 + np.exp(-np.clip(apart[in_u], -30, 30))), label[in_u] == 1)
    kept, weights, bias = fit_rows(found, in_u, len(known), facts["prior"])
    middle = max(middle, min(1.0, 1 / (1 + np.exp(-np.clip(bias, -30, 30))) + 1e-9))
    return Model({f: n for n, f in enumerate(names[kept].tolist())}, weights, bias, middle)


def fit_rows(found: list[np.ndarray], in_u: np.ndarray, width: int, prior: float, least_z: float = 4.0):
    """Positions of the features kept, their weights, the bias.

    Kept are features whose share of documents is higher in P than in U by ``least_z`` standard errors.
    """
    lengths = np.array([len(f) for f in found])
    rows = np.concatenate(found).astype(np.int64)
    in_p = np.repeat(~in_u, lengths)
    n_p, n_u = max((~in_u).sum(), 1), max(in_u.sum(), 1)
    share_p, share_u = np.bincount(rows[in_p], minlength=width) / n_p, np.bincount(rows[~in_p], minlength=width) / n_u
    both = (share_p * n_p + share_u * n_u) / (n_p + n_u)
    z = (share_p - share_u) / np.sqrt(np.maximum(both * (1 - both), 1e-9) * (1 / n_p + 1 / n_u))
    kept = np.flatnonzero(z >= least_z)
    place = np.full(width, -1)
    place[kept] = np.arange(len(kept))
    left = place[rows] >= 0
    owner = np.repeat(np.arange(len(found)), lengths)[left]
    offsets = np.concatenate([[0], np.cumsum(np.bincount(owner, minlength=len(found)))])
    weights, bias = train_nnpu(place[rows[left]], offsets, ~in_u, len(kept), prior)
    return kept, weights, bias


def score(docs: DataFrame, model: Model) -> DataFrame:
    """doc_id, score (0 to 1) and predicted (1 if score >= 0.3) for each document; nothing is shuffled.

    Null and empty texts, and texts without letters, get the score of a text without features. Ids may be null or
    repeated; other columns are left out.
    """
    chosen = texts(docs)
    id_type = arrow_schema(chosen.schema).field("doc_id").type

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        lookup = Lookup(model.known)
        for ids, values in rows_of(batches):
            s = model.scores([lookup.positions(t) for t in values])
            yield pa.RecordBatch.from_arrays(
                [pa.array(ids, id_type), pa.array(s), pa.array((s >= CUT).astype(np.int32))],
                names=["doc_id", "score", "predicted"],
            )

    id_sql = chosen.schema["doc_id"].dataType.simpleString()
    return chosen.mapInArrow(run, f"doc_id {id_sql}, score double, predicted int")


def classify(docs: DataFrame, labels: DataFrame, folds: int = 4, held: int = 2) -> DataFrame:
    """Fit on the labels outside the held-out fold and score every document: doc_id, held_out, score, predicted."""
    model = fit(docs, labels.filter(fold(F.col("doc_id"), folds) != held))
    held_out = (fold(F.col("doc_id"), folds) == held).alias("held_out")
    return score(docs, model).select("doc_id", held_out, "score", "predicted")


def clean(docs: DataFrame, labels: DataFrame, folds: int = 4, held: int = 2) -> DataFrame:
    """The documents that are not predicted toxic, with all their columns. Scored and filtered in one pass."""
    model = fit(docs, labels.filter(fold(F.col("doc_id"), folds) != held))
    return keep(docs, lambda values: model_keeps(model, values))


def model_keeps(model: Model, values: list[str]) -> np.ndarray:
    lookup = Lookup(model.known)
    return model.scores([lookup.positions(t) for t in values]) < CUT


def keep(docs: DataFrame, kept) -> DataFrame:
    """Rows for whose text (null read as empty) ``kept`` says yes."""
    @F.pandas_udf("boolean")
    def wanted(text: pd.Series) -> pd.Series:
        return pd.Series(kept(text.fillna("").tolist()))

    return docs.filter(wanted(col("text")))
