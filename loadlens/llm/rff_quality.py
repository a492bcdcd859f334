"""Quality classifier: random Fourier features over document statistics.

Each document becomes a short vector of statistics (nothing but its text is
used).  Cosines of random projections approximate a Gaussian kernel on them;
partitions sum the normal equations of a ridge regression on the labelled
rows, and an isotonic map, fitted on labelled rows kept out of the regression,
turns the ridge score into a probability.

Defined cases: a null or empty text has statistics 0 and still gets a score;
rows of one doc_id share the mean of their labels; without labelled rows every
score is 0.5; an empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from loadlens.llm import textbuf as B
from loadlens.llm.common import cut, fold, keep_rows, texts

STATISTICS = (
    "log_words", "log_bytes", "mean_word", "sd_word", "upper", "digit", "period", "comma", "exclamation", "pipe", "symbol",
    "other_punct", "non_ascii", "lines_per_word", "dup_lines", "repeated_words", "adjacent_equal", "distinct", "initial_caps",
    "longest_word")
FEATURES = 256
CAP = 4.0          # statistics are clipped at so many standard deviations
RIDGE = 1e-3       # times the number of rows
FIT_PARTS = 32     # partial sums, FEATURES**2 * 8 bytes each
FIT_SUMS = 4       # of which so many totals reach the driver
FIT_ROWS = 200_000  # bound of the labelled rows that a fit reads
BINS = 2048        # resolution of the isotonic fit: its input is this many sums

_BYTES = np.arange(256)
UPPER = (_BYTES >= 65) & (_BYTES <= 90)
DIGIT = (_BYTES >= 48) & (_BYTES <= 57)
SYMBOL = np.isin(_BYTES, list(b"#*$%&<>@^~_=+\\"))
OTHER = np.isin(_BYTES, list(b"\"'()-/:;?[]`{}"))


def _equal_earlier(keys: np.ndarray) -> np.ndarray:
    order = np.argsort(keys, kind="stable")
    out = np.zeros(len(keys), bool)
    out[order[1:]] = keys[order][1:] == keys[order][:-1]
    return out


def describe(data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """The statistics of each document of a piece of text, one row each."""
    docs = np.arange(len(offsets) - 1)
    salt = B.mix64(docs.astype(B.U) + B.U(1))
    start, end, first = B.words(data, offsets)
    sums = B.Windows(B.BYTE_VALUES[0][data])
    values = sums.names(start, end)
    doc_of_word = np.repeat(docs, np.diff(first))
    n_bytes, n_words = np.diff(offsets), np.diff(first)
    nb, nw = np.maximum(n_bytes, 1), np.maximum(n_words, 1)
    length = end - start
    share = lambda table: B.per_doc(table[data], offsets) / nb
    one = lambda ch: B.per_doc(data == ord(ch), offsets) / nb
    mean = B.per_doc(length, first) / nw
    square = B.per_doc(length.astype(np.int64) ** 2, first) / nw
    feeds = np.flatnonzero(data == 0x0A)
    heads, tails = np.sort(np.concatenate([offsets[:-1], feeds + 1])), np.sort(np.concatenate([feeds, offsets[1:]]))
    n_lines = np.diff(np.searchsorted(feeds, offsets)) + 1
    doc_of_line = np.repeat(docs, n_lines)
    full = tails > heads
    again = _equal_earlier(B.mix64(sums.names(heads[full], tails[full]) ^ salt[doc_of_line[full]]))
    dup_lines = np.bincount(doc_of_line[full][again], minlength=len(docs))
    in_doc = B.mix64(values ^ salt[doc_of_word]) if len(values) else values
    distinct = B.per_doc(~_equal_earlier(in_doc), first)
    five = np.maximum(n_words - 4, 0)
    at = B.ranges(first[:-1], five)
    repeated = np.bincount(np.repeat(docs, five)[_equal_earlier(B.Windows(in_doc).names(at, at + 5))], minlength=len(docs))
    adjacent = np.zeros(len(values), bool)
    adjacent[1:] = in_doc[1:] == in_doc[:-1]
    longest = np.zeros(len(docs))
    if len(length):
        some = n_words > 0
        longest[some] = np.maximum.reduceat(length, first[:-1][some])
    return np.column_stack([
        np.log1p(n_words), np.log1p(n_bytes), mean, np.sqrt(np.maximum(square - mean**2, 0)), share(UPPER), share(DIGIT), one("."),
        one(","), one("!"), one("|"), share(SYMBOL), share(OTHER), B.per_doc(data >= 128, offsets) / nb,
        (n_lines - 1) / nw, dup_lines / n_lines, repeated / nw, B.per_doc(adjacent, first) / nw,
        np.log1p(distinct) / np.log1p(nw), B.per_doc(UPPER[data[start]], first) / nw, np.log1p(longest)]).astype(np.float32)


def statistics(docs: DataFrame) -> DataFrame:
    """doc_id and its statistics (float32 values as binary)."""

    def batches(source: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in source:
            data, offsets = B.raw(batch.column(1))
            for i, j in B.pieces(offsets):
                rows = describe(data[offsets[i] : offsets[j]], offsets[i : j + 1] - offsets[i])
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(i, j - i), pa.array([r.tobytes() for r in rows], pa.binary())],
                                                 names=["doc_id", "stats"])

    return texts(docs).mapInArrow(batches, "doc_id long, stats binary")


def _matrix(column: pa.Array) -> np.ndarray:
    data, _ = B.raw(column)
    return data.view(np.float32).reshape(-1, len(STATISTICS)).astype(np.float64)


def _moments(stats: DataFrame) -> tuple[np.ndarray, np.ndarray]:
    """Mean and standard deviation of each statistic over every document."""

    def sums(source):
        n, a, b = 0, np.zeros(len(STATISTICS)), np.zeros(len(STATISTICS))
        for batch in source:
            x = _matrix(batch.column(0))
            n, a, b = n + len(x), a + x.sum(0), b + (x**2).sum(0)
        yield pa.RecordBatch.from_pydict({"k": np.arange(len(STATISTICS)), "n": np.full(len(STATISTICS), n), "a": a, "b": b})

    got = (stats.select("stats").mapInArrow(sums, "k long, n long, a double, b double")
           .groupBy("k").agg(F.sum("n").alias("n"), F.sum("a").alias("a"), F.sum("b").alias("b")).orderBy("k").collect())
    n, a, b = (np.array([r[c] for r in got], float) for c in ("n", "a", "b"))
    if not len(n) or not n[0]:
        return np.zeros(len(STATISTICS)), np.ones(len(STATISTICS))
    return a / n, np.sqrt(np.maximum(b / n - (a / n) ** 2, 1e-12))


@dataclass
class Model:
    """Everything that scoring needs; a few hundred kB."""

    mean: np.ndarray
    sd: np.ndarray
    directions: np.ndarray
    phases: np.ndarray
    weights: np.ndarray | None = None
    knots: tuple[np.ndarray, np.ndarray] | None = None

    def lift(self, x: np.ndarray) -> np.ndarray:
        z = np.clip((x - self.mean) / self.sd, -CAP, CAP)
        waves = np.cos(z @ self.directions + self.phases) * np.sqrt(2.0 / len(self.phases))
        return np.column_stack([waves, np.ones(len(x))])

    def ridge(self, x: np.ndarray) -> np.ndarray:
        return self.lift(x) @ self.weights

    def score(self, x: np.ndarray) -> np.ndarray:
        if self.weights is None:
            return np.full(len(x), 0.5)
        r = self.ridge(x)
        return np.clip(np.interp(r, *self.knots) if self.knots else r, 0.0, 1.0)


def isotonic(at: np.ndarray, weight: np.ndarray, total: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Pool adjacent violators: knots of the best non-decreasing fit to total / weight."""
    blocks: list[list[float]] = []
    for x, w, t in zip(at, weight, total):
        blocks.append([w, t, x * w])
        while len(blocks) > 1 and blocks[-2][1] * blocks[-1][0] >= blocks[-1][1] * blocks[-2][0]:
            last = blocks.pop()
            blocks[-1] = [a + b for a, b in zip(blocks[-1], last)]
    w, t, xw = np.array(blocks).T
    return xw / w, t / w


def fit(stats: DataFrame, labelled: DataFrame, features: int = FEATURES, seed: int = 4, fit_rows: int = FIT_ROWS) -> Model:
    """Fit on labelled (doc_id, y, calibrate): rows marked calibrate fit the isotonic map, the others the ridge."""
    rng = np.random.default_rng(seed)
    d = len(STATISTICS)
    model = Model(*_moments(stats), rng.normal(size=(d, features)) / np.sqrt(d), rng.uniform(0, 2 * np.pi, features))
    y = labelled.where("doc_id IS NOT NULL AND y IS NOT NULL").groupBy("doc_id").agg(
        F.avg("y").alias("y"), F.max("calibrate").alias("calibrate"))
    n = y.count()
    if n > fit_rows:
        y = y.where((F.xxhash64("doc_id") % 1_000_000 + 1_000_000) % 1_000_000 < int(1_000_000 * fit_rows / n))
    rows = cut(stats.join(y, "doc_id").select("doc_id", "stats", "y", "calibrate").repartition(FIT_PARTS, "doc_id"))

    def normal(source):
        a, b, n = np.zeros((features + 1, features + 1)), np.zeros(features + 1), 0
        for batch in source:
            for i in range(0, batch.num_rows, 4096):
                x = model.lift(_matrix(batch.column(0).slice(i, 4096)))
                t = batch.column(1).slice(i, 4096).to_numpy(zero_copy_only=False)
                a, b, n = a + x.T @ x, b + x.T @ t, n + len(x)
        if n:
            yield pa.RecordBatch.from_pydict({"a": [a.tobytes()], "b": [b.tobytes()], "n": [n]})

    def added(group: pa.Table) -> pa.Table:
        a, b = (sum(np.frombuffer(x.as_buffer()) for x in group.column(c)) for c in "ab")
        return pa.table({"a": [a.tobytes()], "b": [b.tobytes()], "n": [pc.sum(group.column("n")).as_py()]})

    # the partitions' sums are added on the executors; a few matrices reach the driver
    parts = (rows.where("NOT calibrate").select("stats", "y").mapInArrow(normal, "a binary, b binary, n long")
             .groupBy(F.pmod(F.xxhash64("b"), F.lit(FIT_SUMS)).alias("k")).applyInArrow(added, "a binary, b binary, n long").collect())
    if not parts:
        return model
    a = sum(np.frombuffer(p["a"]).reshape(features + 1, -1) for p in parts)
    b = sum(np.frombuffer(p["b"]) for p in parts)
    model.weights = np.linalg.solve(a + RIDGE * sum(p["n"] for p in parts) * np.eye(features + 1), b)

    def histogram(source):
        w, t, s = np.zeros(BINS), np.zeros(BINS), np.zeros(BINS)
        for batch in source:
            r = model.ridge(_matrix(batch.column(0)))
            k = np.clip(((r + 0.5) / 2.0 * BINS).astype(int), 0, BINS - 1)
            np.add.at(w, k, 1)
            np.add.at(t, k, batch.column(1).to_numpy(zero_copy_only=False))
            np.add.at(s, k, r)
        k = np.flatnonzero(w)
        yield pa.RecordBatch.from_pydict({"k": k, "w": w[k], "t": t[k], "s": s[k]})

    bins = (rows.where("calibrate").select("stats", "y").mapInArrow(histogram, "k long, w double, t double, s double")
            .groupBy("k").agg(F.sum("w").alias("w"), F.sum("t").alias("t"), F.sum("s").alias("s")).orderBy("k").collect())
    if bins:
        w, t, s = (np.array([r[c] for r in bins]) for c in ("w", "t", "s"))
        model.knots = isotonic(s / w, w, t)
    return model


def score(stats: DataFrame, model: Model) -> DataFrame:
    """doc_id and score in [0, 1] for every row of stats."""

    def batches(source):
        for batch in source:
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(model.score(_matrix(batch.column(1))))], names=["doc_id", "score"])

    return stats.mapInArrow(batches, "doc_id long, score double")


def labelled_rows(labels: DataFrame, folds: int) -> DataFrame:
    """(doc_id, y, calibrate): fold 0 is held out and never read, the last fold fits the isotonic map."""
    return (labels.select(labels["doc_id"].cast("long").alias("doc_id"), labels["quality"].cast("double").alias("y"))
            .withColumn("fold", fold(F.col("doc_id"), folds)).where("fold <> 0")
            .select("doc_id", "y", (F.col("fold") == folds - 1).alias("calibrate")))


def quality(docs: DataFrame, labels: DataFrame, folds: int = 5, threshold: float = 0.3) -> DataFrame:
    """doc_id, held_out, score and predicted of every document."""
    stats = cut(statistics(docs))
    return (score(stats, fit(stats, labelled_rows(labels, folds)))
            .select("doc_id", (fold(F.col("doc_id"), folds) == 0).alias("held_out"), "score",
                    (F.col("score") >= threshold).cast("int").alias("predicted")))


def accepted(docs: DataFrame, labels: DataFrame, folds: int = 5, threshold: float = 0.3) -> DataFrame:
    """The documents, every column kept, whose score reaches the threshold."""
    stats = cut(statistics(docs))
    model = fit(stats, labelled_rows(labels, folds))

    def judge(column: pa.Array) -> np.ndarray:
        data, offsets = B.raw(column)
        scores = [model.score(describe(data[offsets[i] : offsets[j]], offsets[i : j + 1] - offsets[i]).astype(np.float64))
                  for i, j in B.pieces(offsets)]
        return np.concatenate([np.zeros(0), *scores]) >= threshold

    return keep_rows(docs, judge)
