"""Linear models fitted on the driver over bounded samples of rows."""

from __future__ import annotations

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

SAMPLE = 12_000


def bounded_sample(rows: DataFrame, key: str, limit: int, seed: str) -> DataFrame:
    """The ``limit`` rows of least seeded hash of ``key``: the same ones on every run."""
    return rows.orderBy(F.xxhash64(F.lit(seed), F.col(key)), key).limit(limit)


def sample_texts(docs: DataFrame, labels: DataFrame, label: str, train: Column, limit: int, seed: str) -> DataFrame:
    """text and label of at most ``limit`` labelled documents; the labels, not the texts, are broadcast.

    Of several labels or texts under one doc_id the least stands for all.
    """
    wanted = labels.where(train & F.col(label).isin(0, 1) & F.col("doc_id").isNotNull())
    chosen = wanted.groupBy("doc_id").agg(F.min(F.col(label).cast("int")).alias("label"))
    # At most ``limit`` rows of two numbers.
    few = F.broadcast(bounded_sample(chosen, "doc_id", limit, seed))
    found = docs.select("doc_id", "text").join(few, "doc_id").groupBy("doc_id", "label").agg(F.min("text").alias("text"))
    return found.select("text", "label")


def sigmoid(x):
    return 1 / (1 + np.exp(-np.clip(x, -40, 40)))


def logistic(x: np.ndarray, y: np.ndarray, penalty: float, rounds: int = 25, bias: bool = True) -> np.ndarray:
    """Newton's method for L2-penalised logistic loss; the last weight is the bias, if any."""
    if bias:
        x = np.hstack([x, np.ones((len(x), 1))])
    weights = np.zeros(x.shape[1])
    ridge = np.full(x.shape[1], penalty)
    if bias:
        ridge[-1] = 1e-6
    for _ in range(rounds):
        p = sigmoid(x @ weights)
        slope = x.T @ (p - y) + ridge * weights
        curve = (x * (p * (1 - p) + 1e-9)[:, None]).T @ x + np.diag(ridge)
        step = np.linalg.solve(curve, slope)
        weights = weights - step
        if np.abs(step).max() < 1e-8:
            break
    return weights


def linear_svm(x: np.ndarray, y: np.ndarray, penalty: float = 1e-3, rounds: int = 150) -> np.ndarray:
    """Weights (last: bias) of a linear SVM with squared hinge loss; y is -1 or 1. Accelerated descent."""
    x = np.hstack([x, np.ones((len(x), 1), x.dtype)])
    weights = np.zeros(x.shape[1])
    ahead = weights.copy()
    rate = 1 / (2 * float((x * x).sum(axis=1).max()) + penalty)
    for turn in range(rounds):
        slack = np.maximum(0, 1 - y * (x @ ahead))
        slope = penalty * ahead - 2 * (x.T @ (slack * y)) / len(x)
        new = ahead - rate * slope
        ahead = new + turn / (turn + 3) * (new - weights)
        weights = new
    return weights
