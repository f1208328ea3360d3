"""What the trained operators share: held-out rows, bounded samples of labelled rows, calibration."""

from __future__ import annotations

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def held_out(key: str, modulus: int, remainder: int) -> Column:
    """True where crc32 of the key as text has this remainder; false for a null key."""
    crc = F.crc32(F.col(key).cast("string").cast("binary"))
    return F.coalesce(crc % modulus == remainder, F.lit(False))


def labelled_sample(
    documents: DataFrame, labels: DataFrame, label: str, modulus: int, remainder: int, rows: int
) -> DataFrame:
    """Whole texts of at most ``rows`` labelled documents that are not held out: columns text, label.

    The documents are those with the smallest hash of their id, so the choice is the same at every run. Their ids
    are at most ``rows`` long integers, which bounds the broadcast; texts are not shuffled. Rows without an
    id or label are left out; with several labels for one id the largest counts. Repeated documents count repeatedly.
    """
    chosen = (
        labels.select(F.col("doc_id").alias("chosen_id"), F.col(label).cast("int").alias("label"))
        .where(F.col("chosen_id").isNotNull() & F.col("label").isNotNull())
        .where(~held_out("chosen_id", modulus, remainder))
        .groupBy("chosen_id").agg(F.max("label").alias("label"))
        .orderBy(F.xxhash64("chosen_id"), "chosen_id").limit(rows)
    )
    texts = documents.select(F.col("doc_id").alias("chosen_id"), "text")
    return texts.join(F.broadcast(chosen), "chosen_id").select("text", "label")


def logistic(features: np.ndarray, target: np.ndarray, penalty: float = 1e-3, steps: int = 50) -> np.ndarray:
    """Weights and then the intercept of a logistic regression, by damped Newton steps."""
    x = np.column_stack([features, np.ones(len(target))])
    weights = np.zeros(x.shape[1])
    ridge = np.full(x.shape[1], penalty)
    for _ in range(steps):
        p = sigmoid(x @ weights)
        gradient = x.T @ (p - target) / len(target) + ridge * weights
        curve = (x * (p * (1 - p))[:, None]).T @ x / len(target) + np.diag(ridge)
        step = np.linalg.solve(curve, gradient)
        weights -= step * min(1.0, 4.0 / (np.abs(step).max() + 1e-12))
        if np.abs(step).max() < 1e-8:
            break
    return weights


def sigmoid(x):
    return 1.0 / (1.0 + np.exp(-np.clip(x, -500, 500)))
