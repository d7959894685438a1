"""What the two classifiers share: labelled rows that a fit may see, and linear solvers."""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import held_out, text_rows


def labelled(docs: DataFrame, labels: DataFrame, mark: str, most: int) -> DataFrame:
    """``doc_id, text, y`` of at most ``most`` labelled ids of either label, none held out.

    Ids are taken in the order of a hash. Labels other than 0 and 1 and null ids are left
    out; a doc_id with two labels counts with the larger one. The drawn ids, at most twice
    ``most``, go to the tasks that read the texts, so no text is shuffled.
    """
    marks = labels.select(F.col("doc_id").cast("long").alias("doc_id"), F.col(mark).cast("int").alias("y")).filter("y in (0, 1) and doc_id is not null")
    marks = marks.filter(~held_out(F.col("doc_id"))).groupBy("doc_id").agg(F.max("y").alias("y"))
    halves = [marks.filter(F.col("y") == y).orderBy(F.xxhash64("doc_id", F.lit(11)), "doc_id").limit(most) for y in (0, 1)]
    return text_rows(docs).join(F.broadcast(halves[0].unionByName(halves[1])), "doc_id")


def fit_logistic(x: np.ndarray, y: np.ndarray, weights: np.ndarray, ridge: float, steps: int = 60, offset: bool = True) -> np.ndarray:
    """Logistic regression by Newton steps; the last coefficient is the offset if asked for."""
    x = np.hstack([x, np.ones((len(x), 1))]) if offset else x
    beta, keep = np.zeros(x.shape[1]), ridge * np.eye(x.shape[1])
    if offset:
        keep[-1, -1] = 1e-8
    for _ in range(steps):
        p = 1 / (1 + np.exp(-np.clip(x @ beta, -30, 30)))
        grad = x.T @ (weights * (p - y)) + keep @ beta
        hess = (x * (weights * p * (1 - p))[:, None]).T @ x + keep
        step = np.linalg.solve(hess + 1e-9 * np.eye(len(beta)), grad)
        beta -= step
        if np.abs(step).max() < 1e-8:
            break
    return beta


def fit_svm(x: np.ndarray, y: np.ndarray, weights: np.ndarray, ridge: float, steps: int = 400) -> np.ndarray:
    """Linear SVM with squared hinge loss by Newton steps on the active rows; offset last."""
    x, s = np.hstack([x, np.ones((len(x), 1))]), 2 * y - 1
    beta, keep = np.zeros(x.shape[1]), ridge * np.eye(x.shape[1])
    keep[-1, -1] = 1e-8
    loss = lambda b: float(weights @ np.maximum(0, 1 - s * (x @ b)) ** 2 + b @ keep @ b)
    now = loss(beta)
    for _ in range(steps):
        gap = 1 - s * (x @ beta)
        on = gap > 0
        grad = -2 * x[on].T @ (weights[on] * s[on] * gap[on]) + 2 * keep @ beta
        hess = 2 * (x[on] * weights[on][:, None]).T @ x[on] + 2 * keep + 1e-9 * np.eye(len(beta))
        step, rate = np.linalg.solve(hess, grad), 1.0
        while rate > 1e-6 and loss(beta - rate * step) > now:
            rate /= 2
        beta = beta - rate * step
        before, now = now, loss(beta)
        if before - now < 1e-9 * max(1.0, before):
            break
    return beta
