"""Bounded samples of labelled documents, held-out splits, and a small logistic regression."""

from __future__ import annotations

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import first_by_hash


def remainder(id_col: str, modulus: int) -> Column:
    """crc32 of the id as text, modulo ``modulus``; null for a null id."""
    return F.crc32(F.col(id_col).cast("string").cast("binary")) % modulus


def label_sample(labels: DataFrame, label: str, most: int, modulus: int, held_out: int) -> DataFrame:
    """(doc_id, y): up to ``most`` / 2 training rows of each class, the first by a hash of the id.

    A top-k per class, so the input's size does not matter; rows without id or label, or with another label than 0 and 1,
    teach nothing. Of contradicting labels of one id each counts.
    """
    rows = labels.select(F.col("doc_id"), F.col(label).cast("int").alias("y")).filter(remainder("doc_id", modulus) != held_out)
    parts = [first_by_hash(rows.filter(F.col("y") == y), "doc_id", most // 2) for y in (0, 1)]
    return parts[0].union(parts[1])


def sampled_documents(docs: DataFrame, labels: DataFrame, label: str, most: int, modulus: int, held_out: int) -> DataFrame:
    """(doc_id, text, y) of the sampled labels' documents; the sample has at most ``most`` rows, which bounds the broadcast."""
    own = label_sample(labels, label, most, modulus, held_out).toPandas()
    own = docs.sparkSession.createDataFrame([(int(i), int(y)) for i, y in zip(own["doc_id"], own["y"])], "doc_id long, y int")
    return docs.select("doc_id", "text").join(F.broadcast(own), "doc_id")


def logistic(x: np.ndarray, y: np.ndarray, penalty: float = 1e-2, steps: int = 30) -> np.ndarray:
    """Weights (the last is the constant) by Newton's method; zeros for no rows."""
    x = np.hstack([x, np.ones((len(x), 1))])
    w = np.zeros(x.shape[1])
    for _ in range(steps if len(x) else 0):
        p = sigmoid(x @ w)
        grad = x.T @ (p - y) + penalty * w
        hess = (x * (p * (1 - p))[:, None]).T @ x + (penalty + 1e-9) * np.eye(len(w))
        step = np.linalg.solve(hess, grad)
        w -= step
        if np.abs(step).max() < 1e-9:
            break
    return w


def sigmoid(z: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(z, -40, 40)))
