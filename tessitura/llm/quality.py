"""Quality by Bradley-Terry ranking: scores learnt from pairs of which one is preferred.

Features are plain measures of a text: variety and repetition of words and lines, overall
and in the worst run of ``RUN`` words, shares of upper case, digits, marks and white space,
word lengths. A pair is a good and a poor training document; the chance that the good one
is preferred is the logistic of the score difference, so the loss is logistic on feature
differences and has no offset. The threshold is the score quantile, among the
training documents, that tells the two labels apart best; a monotone map puts it at
``THRESHOLD`` on the scale of 0 to 1.

The fit sees at most ``TRAIN_ROWS`` labelled rows of either label and ``PAIRS`` pairs.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import checkpointed, held_out, table, text_rows
from .training import fit_logistic, labelled

TRAIN_ROWS = 4000
PAIRS = 20_000
RUN = 40
THRESHOLD = 0.7
# Byte classes by first column of the histogram.
_CLASSES = {"upper": range(65, 91), "lower": range(97, 123), "digit": range(48, 58), "bang": (33, 63), "symbol": (35, 36, 37, 38, 42, 43, 47, 60, 61, 62, 64, 92, 94, 95, 126), "bar": (124,), "comma": (44, 59), "dot": (46,), "line": (10,), "quote": (34, 39, 96), "bracket": (40, 41, 91, 93, 123, 125), "high": range(128, 256)}
_MASKS = np.array([[b in set(members) for b in range(256)] for members in _CLASSES.values()], dtype=float)


def features(text: str) -> list[float]:
    """Measures of one text; an empty text has zeros for all."""
    words = text.split()
    n = len(words)
    if not n:
        return [0.0] * N_FEATURES
    counts = _MASKS @ np.bincount(np.frombuffer(text.encode("utf-8", "replace"), dtype=np.uint8), minlength=256)
    by = dict(zip(_CLASSES, counts.tolist()))
    size = max(len(text), 1)
    letters = max(by["upper"] + by["lower"], 1.0)
    lengths = np.fromiter(map(len, words), dtype=np.int64, count=n)
    repeats = np.fromiter(map(str.__eq__, words[1:], words), dtype=bool, count=n - 1)
    marked = np.fromiter((not (w[-1].isalnum() or w[-1] in ".,;:") for w in words), dtype=bool, count=n)
    shouted = np.fromiter(map(str.isupper, words), dtype=bool, count=n)
    lines = [x for x in text.split("\n") if x]
    runs = range(0, n, RUN)
    worst = [len(set(words[a : a + RUN])) / len(words[a : a + RUN]) for a in runs if a == 0 or a + RUN <= n]
    starts = np.array([a for a in runs if a == 0 or a + RUN <= n])
    width = np.minimum(starts + RUN, n) - starts
    total = lambda x: np.concatenate([[0], np.cumsum(x)])
    peak = lambda x: float(((total(x)[starts + width] - total(x)[starts]) / width).max())
    again = np.concatenate([[False], repeats])
    far = len({*zip(words[::3], words[1::3], words[2::3])}) / max(n // 3, 1) if n >= 3 else 1.0
    return [
        min(np.log1p(n), 6.0), min(np.log1p(n), 3.0), len(set(words)) / n, len(set(words)) / np.sqrt(n) / 10, far,
        again.mean(), peak(again), min(worst), marked.mean(), peak(marked), shouted.mean(), peak(shouted),
        by["upper"] / letters, by["digit"] / size, by["bang"] / size, by["symbol"] / size, by["bar"] / size, by["comma"] / size,
        by["dot"] / size, by["line"] / size, by["quote"] / size, by["bracket"] / size, min(by["high"] / size, 1.0),
        float(lengths.mean()) / 10, float(np.minimum(lengths, 40).std()) / 10, float((lengths > 30).mean()), 1 - (len(lines) - len(set(lines))) / max(len(lines), 12),
        float(n / max(len(lines), 1) > 3), min(n, 20) / 20,
    ]


N_FEATURES = 29


class Ranking:
    """Fitted weights on standardised features, and the map of raw scores to 0..1."""

    def __init__(self, mean, spread, weights, edge: float, scale: float):
        self.mean, self.spread, self.weights, self.edge, self.scale = mean, spread, weights, edge, scale

    def raw(self, x: np.ndarray) -> np.ndarray:
        return np.clip((x - self.mean) / self.spread, -8, 8) @ self.weights

    def scores(self, texts: list[str]) -> np.ndarray:
        x = np.array([features(t) for t in texts], dtype=float).reshape(-1, N_FEATURES)
        z = self.scale * (self.raw(x) - self.edge) + np.log(THRESHOLD / (1 - THRESHOLD))
        return 1 / (1 + np.exp(-np.clip(z, -30, 30)))


def rank_pairs(x: np.ndarray, y: np.ndarray, pairs: int = PAIRS, ridge: float = 1.0) -> Ranking:
    """Bradley-Terry weights from pairs of one row with label 1 and one with label 0."""
    mean, spread = x.mean(axis=0), x.std(axis=0) + 1e-6
    z = np.clip((x - mean) / spread, -8, 8)
    rng = np.random.default_rng(7)
    good, poor = (rng.choice(np.flatnonzero(y == k), pairs) for k in (1, 0))
    turned = rng.random(pairs) < 0.5  # either document may be named first
    gap = np.where(turned[:, None], -1.0, 1.0) * (z[good] - z[poor])
    weights = fit_logistic(gap, (~turned).astype(float), np.ones(pairs), ridge, offset=False)
    made = Ranking(mean, spread, weights, 0.0, 1.0)
    raw = made.raw(x)
    # Quantiles of the raw score, told apart by the mean of both labels' right shares.
    edges = np.unique(np.quantile(raw, np.linspace(0, 1, 401)))
    right = [(raw[y == 1] >= e).mean() + (raw[y == 0] < e).mean() for e in edges]
    best = np.flatnonzero(np.array(right) >= max(right) - 1e-9)
    made.edge = float(edges[best[len(best) // 2]])
    fitted = fit_logistic((raw - made.edge)[:, None], y.astype(float), np.ones(len(y)), 0.01)
    made.scale = float(max(fitted[0], 0.05))
    return made


def fit(docs: DataFrame, labels: DataFrame, train_rows: int = TRAIN_ROWS) -> Ranking:
    """Ranking from labelled rows outside the held-out quarter.

    Without rows of both labels no pair exists; every text then scores near 1 if there are only good rows,
    near 0 otherwise.
    """

    def run(batches):
        for batch in batches:
            made = [features(t) for t in batch.column("text").to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), batch.column("y"), pa.array(made, pa.list_(pa.float64()))], ["doc_id", "y", "x"])

    rows = labelled(docs, labels, "quality", train_rows).mapInArrow(run, "doc_id long, y int, x array<double>")
    found = checkpointed(rows).toPandas().sort_values("doc_id", kind="stable")
    y = found["y"].to_numpy()
    if len(set(y)) < 2:
        edge = -100.0 if len(y) and y[0] == 1 else 100.0
        return Ranking(np.zeros(N_FEATURES), np.ones(N_FEATURES), np.zeros(N_FEATURES), edge, 1.0)
    return rank_pairs(np.array(found["x"].tolist(), dtype=float), y)


def score(docs: DataFrame, ranking: Ranking) -> DataFrame:
    """``doc_id, held_out, score, predicted`` of every row; null texts are empty ones.

    Null and repeated doc_ids are rows like any other; empty tables give no rows; columns
    besides doc_id and text are ignored.
    """

    def run(batches):
        for batch in batches:
            made = ranking.scores(batch.column("text").to_pylist())
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(made, pa.float64())], ["doc_id", "score"])

    scored = text_rows(docs).mapInArrow(run, "doc_id long, score double")
    return scored.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "score", (F.col("score") >= THRESHOLD).cast("int").alias("predicted"))


def op9_quality(spark, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return score(docs, fit(docs, table(spark, sf_dir, "labels")))
