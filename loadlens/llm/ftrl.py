"""Toxicity: FTRL-proximal logistic regression over hashed word n-grams and skip-grams.

Every coordinate has its own learning rate, and the L1 term keeps weights at
exactly 0 unless the labels move them, so the model that scores every
document is a short list of indices and weights.  A bounded sample of labelled
rows is dealt into shards; each shard makes its passes, and the shards'
weights are averaged (parameter mixing).  A logistic map, fitted on rows that a
first fit did not see, turns margins into probabilities.

Defined cases: a null or empty text has no features and scores the bias alone;
rows of one doc_id share the mean of their labels; without labelled rows every
score is 0.5; an empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from loadlens.llm import textbuf as B
from loadlens.llm.common import cut, fold, texts

BITS = 22           # hashed feature space: 2**BITS weights; index 2**BITS is the bias
FIT_ROWS = 40_000   # bound of the labelled rows that a fit reads
SHARD_ROWS = 10_000 # rows that one shard learns from, one after the other
EPOCHS = 8
ALPHA, BETA, L1, L2 = 3.0, 1.0, 6.0, 0.0


def features(data: np.ndarray, offsets: np.ndarray, bits: int = BITS) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(document number, hashed index) of words, word pairs, triples and pairs with a gap, repeats included."""
    data = B.lowered(data)
    start, end, first = B.words(data, offsets, B.IS_BREAK)
    values = B.word_values(data, start, end)
    doc = np.repeat(np.arange(len(offsets) - 1), np.diff(first))
    yield doc, (values >> B.U(64 - bits)).astype(np.int64)
    for kind, steps in ((2, (1,)), (3, (1, 2)), (4, (2,))):
        far = steps[-1]
        if len(values) <= far:
            continue
        same = doc[far:] == doc[:-far]
        h = values[:-far] * B.U(0x9E3779B97F4A7C15) + B.U(kind)
        for s in steps:
            h = B.mix64(h) + values[s : len(values) - far + s]
        yield doc[:-far][same], (B.mix64(h)[same] >> B.U(64 - bits)).astype(np.int64)


def feature_sets(data: np.ndarray, offsets: np.ndarray, bits: int) -> list[np.ndarray]:
    """The distinct feature indices of each document."""
    docs, index = (np.concatenate(x) for x in zip(*features(data, offsets, bits)))
    keys = np.unique(docs << bits | index)
    cuts = np.searchsorted(keys, np.arange(len(offsets)) << bits)
    keys = (keys & ((1 << bits) - 1)).astype(np.int32)
    return [keys[a:b] for a, b in zip(cuts[:-1], cuts[1:])]


class Ftrl:
    """Online FTRL-proximal with per-coordinate rates, on binary features."""

    def __init__(self, size: int, alpha: float = ALPHA, beta: float = BETA, l1: float = L1, l2: float = L2):
        self.z, self.n = np.zeros(size), np.zeros(size)
        self.alpha, self.beta, self.l1, self.l2 = alpha, beta, l1, l2

    def weights(self, k=slice(None)) -> np.ndarray:
        z, n = self.z[k], self.n[k]
        return np.where(np.abs(z) <= self.l1, 0.0, (np.sign(z) * self.l1 - z) / ((self.beta + np.sqrt(n)) / self.alpha + self.l2))

    def learn(self, k: np.ndarray, y: float) -> None:
        w = self.weights(k)
        g = 1.0 / (1.0 + np.exp(-np.clip(w.sum(), -35, 35))) - y
        n = self.n[k]
        self.z[k] += g - (np.sqrt(n + g * g) - np.sqrt(n)) / self.alpha * w
        self.n[k] = n + g * g


@dataclass
class Model:
    """Non-zero weights only: broadcast with the scoring closure, a few kB."""

    bits: int
    index: np.ndarray
    weight: np.ndarray
    bias: float
    slope: float = 1.0   # the logistic map from margins to probabilities
    offset: float = 0.0

    def table(self) -> np.ndarray:
        """The weights by index; each task spreads them out for itself."""
        table = np.zeros(1 << self.bits, np.float32)
        table[self.index] = self.weight
        return table

    def margins(self, table: np.ndarray, data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
        """Sum of the weights of each document's distinct features, plus the bias."""
        hit = []
        for doc, index in features(data, offsets, self.bits):
            keep = table[index] != 0
            hit.append(doc[keep] << self.bits | index[keep])
        keys = np.unique(np.concatenate(hit))
        return np.bincount(keys >> self.bits, table[keys & ((1 << self.bits) - 1)], minlength=len(offsets) - 1) + self.bias


def platt(margin: np.ndarray, y: np.ndarray, steps: int = 50) -> tuple[float, float]:
    """Slope and offset of the logistic map from margins to labels, by Newton steps on smoothed targets."""
    high, low = float((y >= 0.5).sum()), float((y < 0.5).sum())
    if not high or not low:
        return 1.0, 0.0
    target = np.where(y >= 0.5, (high + 1) / (high + 2), 1 / (low + 2))
    x, at = np.column_stack([margin, np.ones(len(margin))]), np.array([1.0, 0.0])
    for _ in range(steps):
        q = 1.0 / (1.0 + np.exp(-np.clip(x @ at, -35, 35)))
        hessian = (x * (q * (1 - q))[:, None]).T @ x + 1e-3 * np.eye(2)
        step = np.linalg.solve(hessian, x.T @ (target - q) + 1e-3 * (np.array([1.0, 0.0]) - at))
        at = at + step / max(1.0, np.abs(step).max())
    return (float(at[0]), float(at[1])) if at[0] > 0 else (1.0, 0.0)


def fit(docs: DataFrame, labelled: DataFrame, bits: int = BITS, epochs: int = EPOCHS, fit_rows: int = FIT_ROWS,
        shard_rows: int = SHARD_ROWS, calibration: int = 5) -> Model:
    """Fit on labelled (doc_id, y): at most about fit_rows of them, chosen by a hash of doc_id.

    One row in ``calibration`` is held back from a first fit; its margins there
    (at most fit_rows / calibration numbers) give the logistic map of the
    final fit, which learns from all rows of the sample.
    """
    y = labelled.where("doc_id IS NOT NULL AND y IS NOT NULL").groupBy("doc_id").agg(F.avg("y").alias("y"))
    n = y.count()
    if n > fit_rows:
        y = y.where(F.pmod(F.xxhash64("doc_id"), F.lit(1_000_000)) < int(1_000_000 * fit_rows / n))
        n = y.count()
    # the sample's ids are few by fit_rows, so they go to the documents: only sampled texts move
    rows = texts(docs).join(F.broadcast(y) if n <= 2 * fit_rows else y, "doc_id")
    rows = cut(rows.withColumn("part", F.pmod(F.xxhash64("doc_id", F.lit(6)), F.lit(calibration))))
    shards = -(-n // shard_rows) or 1
    first = _train(rows.where("part <> 0"), bits, epochs, shards)

    def margins(source: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = first.table()
        for batch in source:
            data, offsets = B.raw(batch.column(0))
            m = [first.margins(table, data[offsets[i] : offsets[j]], offsets[i : j + 1] - offsets[i]) for i, j in B.pieces(offsets)]
            yield pa.RecordBatch.from_arrays([pa.array(np.concatenate([np.zeros(0), *m])), batch.column(1)], names=["m", "y"])

    held = rows.where("part = 0").select("text", "y").mapInArrow(margins, "m double, y double").collect()
    model = _train(rows, bits, epochs, shards)
    model.slope, model.offset = platt(np.array([r["m"] for r in held], float), np.array([r["y"] for r in held], float))
    return model


def _train(rows: DataFrame, bits: int, epochs: int, shards: int) -> Model:
    """The average of the weights that each shard of rows (doc_id, text, y) learns."""

    def train(group: pa.Table) -> pa.Table:
        group = group.sort_by([("doc_id", "ascending")])
        data, offsets = B.raw(group.column("text"))
        sets = [s for i, j in B.pieces(offsets) for s in feature_sets(data[offsets[i] : offsets[j]], offsets[i : j + 1] - offsets[i], bits)]
        target = group.column("y").to_numpy()
        model, rng = Ftrl((1 << bits) + 1), np.random.default_rng(5)
        for _ in range(epochs):
            for i in rng.permutation(len(sets)):
                model.learn(np.append(sets[i], 1 << bits), target[i])
        w = model.weights()
        k = np.flatnonzero(w)
        return pa.table({"k": np.append(k, -1), "w": np.append(w[k], 1.0) * len(sets)})  # -1: the shard's rows

    dealt = rows.withColumn("shard", F.pmod(F.xxhash64("doc_id", F.lit(5)), F.lit(shards)))
    weights = dealt.groupBy("shard").applyInArrow(train, "k long, w double")
    # at most 2**bits + 2 numbers, in fact the sparse few
    got = weights.groupBy("k").agg(F.sum("w").alias("w")).toArrow()
    k, w = got.column("k").to_numpy(), got.column("w").to_numpy()
    w = w / max(1.0, w[k == -1].sum())
    here = (k >= 0) & (k < 1 << bits)
    order = np.argsort(k[here])
    return Model(bits, k[here][order], w[here][order].astype(np.float32), float(w[k == 1 << bits].sum()))


def score(docs: DataFrame, model: Model) -> DataFrame:
    """doc_id and the probability of label 1, for every document."""

    def batches(source: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = model.table()
        for batch in source:
            data, offsets = B.raw(batch.column(1))
            for i, j in B.pieces(offsets):
                m = model.margins(table, data[offsets[i] : offsets[j]], offsets[i : j + 1] - offsets[i])
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(i, j - i), pa.array(1.0 / (1.0 + np.exp(-np.clip(model.slope * m + model.offset, -35, 35))))],
                                                 names=["doc_id", "score"])

    return texts(docs).mapInArrow(batches, "doc_id long, score double")


def toxicity(docs: DataFrame, labels: DataFrame, folds: int = 3, held_fold: int = 1, threshold: float = 0.7) -> DataFrame:
    """doc_id, held_out, score and predicted of every document; labels of the held-out fold are never read."""
    labelled = (labels.select(labels["doc_id"].cast("long").alias("doc_id"), labels["toxic"].cast("double").alias("y"))
                .where(fold(F.col("doc_id"), folds) != held_fold))
    return (score(docs, fit(docs, labelled))
            .select("doc_id", (fold(F.col("doc_id"), folds) == held_fold).alias("held_out"), "score",
                    (F.col("score") >= threshold).cast("int").alias("predicted")))
