"""Quality by Bradley-Terry pairwise ranking.

A preference pair says that one document (quality 1) is better than another (quality 0). The score is linear in a few
measures of the text, and the logistic loss of the score difference over many pairs fits the weights: only differences
of features enter. Afterwards the scores are cut where the labels are separated best. All labelled documents take part: they
are dealt to blocks, pairs are made inside blocks, and the driver adds up what blocks return.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, replace
from operator import eq

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import LOWER, arrow_schema, col, fold, rows_of, shuffled, stage, texts
from tidemark.llm.toxicity import CUT, keep

SYMBOLS = b"#$%&*+<=>@[\\]^_`{|}~"
DIGITS = b"0123456789"
CAPITALS = bytes(range(65, 91))
STOPS = b".!?,;:"
QUOTES = b"\"'()/-"
BARS = b"|\t"
NAMES = (
    "log_words", "word_length", "symbols", "digits", "capitals", "stops", "quotes", "bars", "repeated_neighbours",
    "distinct", "top_word", "lines", "distinct_lines", "exclamations", "long_words", "short_words", "other_bytes", "empty",
)
MIXED = 64  # rows of the rarer label that a block should hold


def measures(text: str) -> list[float]:
    raw = text.encode("utf-8", "replace")
    size = max(len(raw), 1)
    found = raw.translate(LOWER).split()
    if not found:
        return [0.0] * (len(NAMES) - 1) + [1.0]
    n = len(found)
    counts = Counter(found)
    lines = raw.split(b"\n")

    def share(chars: bytes) -> float:
        return (size - len(raw.translate(None, chars))) / size

    lengths = Counter(map(len, found))
    return [
        np.log1p(n), size / n, share(SYMBOLS) ** 0.5, share(DIGITS) ** 0.5, share(CAPITALS), share(STOPS), share(QUOTES),
        share(BARS) ** 0.5, sum(map(eq, found, found[1:])) / n, len(counts) / n, max(counts.values()) / n,
        len(lines) / n, len(set(lines)) / len(lines), (raw.count(b"!") / size) ** 0.5,
        sum(k for w, k in lengths.items() if w > 20) / n, sum(k for w, k in lengths.items() if w < 4) / n,
        len(raw.translate(None, bytes(range(128)))) / size, 0.0,
    ]


def features(values: list[str]) -> np.ndarray:
    """Measures and their squares."""
    x = np.array([measures(t) for t in values]).reshape(len(values), len(NAMES))
    return np.hstack([x, x**2])


@dataclass(frozen=True)
class Ranking:
    centre: np.ndarray
    scale: np.ndarray
    weights: np.ndarray
    threshold: float  # the raw score of the cut; becomes CUT

    def raw(self, x: np.ndarray) -> np.ndarray:
        # Row by row, not as a matrix product: a score must not depend on the texts beside it.
        return (np.clip((x - self.centre) / self.scale, -8, 8) * self.weights).sum(axis=1)

    def scores(self, values: list[str]) -> np.ndarray:
        away = np.clip(self.raw(features(values)) - self.threshold + np.log(CUT / (1 - CUT)), -30, 30)
        return 1 / (1 + np.exp(-away))


def _blocks(rows: DataFrame, counts: dict[int, int], block_rows: int) -> DataFrame:
    """Rows ``label, x, n`` dealt to blocks of about ``block_rows``, each block one row of packed arrays.

    The rarer label's rows go to several blocks where one would hold fewer than MIXED of them; ``own`` marks one copy.
    """
    blocks = max(1, -(-sum(counts.values()) // block_rows))
    rare = min(counts, key=counts.get)
    copies = min(blocks, max(1, -(-MIXED * blocks // counts[rare])))
    copy = F.explode(F.sequence(F.lit(0), F.when(F.col("label") == rare, copies - 1).otherwise(0)))
    dealt = rows.withColumn("copy", copy).withColumn("block", F.pmod(F.xxhash64("label", "x", "copy"), F.lit(blocks)).cast("int"))

    def packed(table: pa.Table) -> pa.Table:
        x = table.column("x").combine_chunks().flatten().to_numpy(zero_copy_only=False).reshape(table.num_rows, len(NAMES))
        label, n, own = (table.column(c).to_numpy() for c in ("label", "n", "copy"))
        order = np.lexsort((*x.T, own, label))
        arrays = (x, label.astype(np.int64), n.astype(np.int64), (own == 0).astype(np.int64))
        cells = [pa.array([np.ascontiguousarray(v[order]).tobytes()], pa.binary()) for v in arrays]
        return pa.Table.from_arrays([table.column("block")[:1].combine_chunks(), *cells], names=["block", "x", "label", "n", "own"])

    kept = dealt.select("block", "label", "n", "copy", "x")
    return stage(kept.groupBy("block").applyInArrow(packed, "block int, x binary, label binary, n binary, own binary"), "ranking-blocks")


def _unpacked(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[int, np.ndarray, np.ndarray, np.ndarray, np.ndarray]]:
    """Block number, features, labels, numbers of copies and whether a row is the block's own."""
    for batch in batches:
        for row in range(batch.num_rows):
            block, x, *rest = (c[row].as_py() for c in batch.columns)
            x = np.frombuffer(x).reshape(-1, len(NAMES))
            label, n, own = (np.frombuffer(v, np.int64) for v in rest)
            yield block, np.hstack([x, x**2]), label, n, own == 1


def _per_block(blocks: DataFrame, work) -> list[np.ndarray]:
    """What ``work`` makes of each block, in the order of the blocks."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for block, *arrays in _unpacked(batches):
            made = np.asarray(work(block, *arrays), np.float64)
            yield pa.RecordBatch.from_arrays([pa.array([block], pa.int32()), pa.array([made.tobytes()], pa.binary())], names=["block", "made"])

    found = blocks.mapInArrow(run, "block int, made binary").collect()
    return [np.frombuffer(bytes(r["made"])) for r in sorted(found, key=lambda r: r["block"])]


def _moments(blocks: DataFrame) -> tuple[np.ndarray, np.ndarray]:
    """Mean and deviation of every feature over all rows."""

    def work(block, x, label, n, own):
        x, n = x[own], n[own]
        mean = np.average(x, axis=0, weights=n) if len(n) else np.zeros(x.shape[1])
        return np.concatenate([[n.sum()], mean, (n[:, None] * (x - mean) ** 2).sum(0)])

    found = np.array(_per_block(blocks, work))
    n, means, squares = found[:, :1], *np.hsplit(found[:, 1:], 2)
    mean = (n * means).sum(0) / n.sum()
    return mean, np.sqrt((squares + n * (means - mean) ** 2).sum(0) / n.sum())


def fit_pairs(blocks: DataFrame, centre: np.ndarray, scale: np.ndarray, rounds: int, decay: float = 1e-3, passes: int = 30, seed: int = 5) -> np.ndarray:
    """Weights that minimise the mean of log(1 + exp(-w (better - worse))) over the pairs; Newton steps, halved where they overshoot.

    In each block every row is in ``rounds`` pairs or more. A pass returns sums of each block.
    """
    width = len(centre)

    def sums(weights: np.ndarray):
        def work(block, x, label, n, own):
            good, bad = (np.flatnonzero(label == v) for v in (1, 0))
            if not len(good) or not len(bad):
                return np.zeros(2 + width + width * width)
            pairs = rounds * max(len(good), len(bad))
            rng = np.random.default_rng([seed, block])
            better, worse = (np.concatenate([rng.permutation(side) for _ in range(-(-pairs // len(side)))])[:pairs] for side in (good, bad))
            z = np.clip((x - centre) / scale, -8, 8)
            d = z[better] - z[worse]
            margin, weight = np.clip(d @ weights, -30, 30), n[better] * n[worse]
            miss = weight / (1 + np.exp(margin))
            bend = miss / (1 + np.exp(-margin))
            return np.concatenate([[weight.sum(), (weight * np.log1p(np.exp(-margin))).sum()], -d.T @ miss, ((d * bend[:, None]).T @ d).ravel()])

        total = np.sum(_per_block(blocks, work), axis=0)
        pairs = max(total[0], 1)
        slope = total[2 : 2 + width] / pairs + decay * weights
        return total[1] / pairs + decay / 2 * weights @ weights, slope, total[2 + width :].reshape(width, width) / pairs + decay * np.eye(width)

    best = np.zeros(width)
    loss, slope, bend = sums(best)
    move = np.linalg.solve(bend, slope)
    for _ in range(passes):
        if slope @ move < 1e-10:
            break
        tried = sums(best - move)
        if tried[0] > loss:
            move = move / 2
            continue
        best = best - move
        loss, slope, bend = tried
        move = np.linalg.solve(bend, slope)
    return best


def threshold_of(blocks: DataFrame, ranking: Ranking, bins: int = 1 << 16) -> float:
    """The raw score that separates all labels with the fewest errors, of ``bins`` equal steps; in a tie the lowest."""
    ends = np.array(_per_block(blocks, lambda block, x, *_: (lambda s: [s.min(), s.max()])(ranking.raw(x))))
    low, high = ends[:, 0].min(), ends[:, 1].max()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for _, x, label, n, own in _unpacked(batches):
            raw = ranking.raw(x)[own]
            at = np.minimum((raw - low) * (bins / max(high - low, 1e-300)), bins - 1).astype(np.int64)
            gain = np.where(label[own] == 1, n[own], -n[own])
            yield pa.RecordBatch.from_arrays([pa.array(at), pa.array(gain), pa.array(raw)], names=["at", "gain", "raw"])

    found = blocks.mapInArrow(run, "at long, gain long, raw double").groupBy("at")
    counted = found.agg(F.sum("gain").alias("gain"), F.min("raw").alias("least"), F.max("raw").alias("most")).orderBy("at").collect()
    # errors made when the bins below are rejected, less those made when none is
    wrong = np.concatenate([[0], np.cumsum([r["gain"] for r in counted])[:-1]])
    cut = int(np.argmin(wrong))
    return (counted[cut - 1]["most"] + counted[cut]["least"]) / 2 if cut else counted[0]["least"] - 1


def fit(docs: DataFrame, labels: DataFrame, label_col: str = "quality", rounds: int = 5, block_rows: int = 4096) -> Ranking | None:
    """Rank all labelled documents by preferences: each is in ``rounds`` pairs or more.

    None if the labelled documents do not hold both labels. Measures of texts are joined with the labels, texts are not shuffled;
    the driver gets sums of blocks and the counts of 65,536 steps of the score.
    """
    known = labels.groupBy("doc_id").agg(F.max(col(label_col)).cast("int").alias("label")).filter("doc_id IS NOT NULL AND label IN (0, 1)")
    named = texts(docs).dropna(subset=["doc_id"])
    id_type = arrow_schema(named.schema).field("doc_id").type

    def measured(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for ids, values in rows_of(batches):
            x = np.array([measures(t) for t in values]).reshape(len(values), len(NAMES))
            flat = pa.FixedSizeListArray.from_arrays(pa.array(x.ravel()), x.shape[1]).cast(pa.list_(pa.float64()))
            yield pa.RecordBatch.from_arrays([pa.array(ids, id_type), flat], names=["doc_id", "x"])

    id_sql = named.schema["doc_id"].dataType.simpleString()
    found = named.mapInArrow(measured, f"doc_id {id_sql}, x array<double>").join(shuffled(known), "doc_id")
    rows = stage(found.groupBy("label", "x").agg(F.count("*").alias("n")), "ranking-rows")
    counts = {r["label"]: r["count"] for r in rows.groupBy("label").count().collect()}
    if len(counts) < 2:
        return None
    blocks = _blocks(rows, counts, block_rows)
    centre, spread = _moments(blocks)
    scale = np.maximum(spread, 1e-6)
    ranking = Ranking(centre, scale, fit_pairs(blocks, centre, scale, rounds), 0.0)
    return replace(ranking, threshold=float(threshold_of(blocks, ranking)))


def score(docs: DataFrame, model: Ranking | None) -> DataFrame:
    """doc_id, score (0 to 1) and predicted (1 if score >= 0.3) for each document; nothing is shuffled.

    Null and empty texts, and texts of white space alone, have the measures of an empty text. Without a model every
    score is 1. Ids may be null or repeated; other columns are left out.
    """
    chosen = texts(docs)
    id_type = arrow_schema(chosen.schema).field("doc_id").type

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for ids, values in rows_of(batches):
            s = model.scores(values) if model else np.ones(len(values))
            yield pa.RecordBatch.from_arrays(
                [pa.array(ids, id_type), pa.array(s), pa.array((s >= CUT).astype(np.int32))],
                names=["doc_id", "score", "predicted"],
            )

    id_sql = chosen.schema["doc_id"].dataType.simpleString()
    return chosen.mapInArrow(run, f"doc_id {id_sql}, score double, predicted int")


def rank(docs: DataFrame, labels: DataFrame, folds: int = 5, held: int = 0) -> DataFrame:
    """Fit on the labels outside the held-out fold and score every document: doc_id, held_out, score, predicted."""
    model = fit(docs, labels.filter(fold(F.col("doc_id"), folds) != held))
    held_out = (fold(F.col("doc_id"), folds) == held).alias("held_out")
    return score(docs, model).select("doc_id", held_out, "score", "predicted")


def good(docs: DataFrame, labels: DataFrame, folds: int = 5, held: int = 0) -> DataFrame:
    """The documents that are predicted good, with all their columns."""
    model = fit(docs, labels.filter(fold(F.col("doc_id"), folds) != held))
    return keep(docs, lambda values: model.scores(values) >= CUT) if model else docs
