"""Bounded samples of labelled documents, and a small logistic regression."""

from __future__ import annotations

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

_CELL_BITS = 16


def remainder(doc_id: str | Column, of: int) -> Column:
    """crc32 of an id as text modulo `of`; -1 for a null id."""
    doc_id = F.col(doc_id) if isinstance(doc_id, str) else doc_id
    return F.coalesce(F.crc32(doc_id.cast("string")) % of, F.lit(-1))


def thinned(df: DataFrame, hashed: Column, n: int) -> DataFrame:
    """Of `df` the rows that can be among the `n` of least hash, a 64-bit number, and few others; null hashes go.

    A sort with a limit takes up to `n` rows of every task to one. Here rows are counted by the first `_CELL_BITS` bits of
    their hash, and the least cells that together hold `n` rows stay: the `n` rows, and those that share the last
    cell. The driver sees the counts, at most one per cell. All rows are kept if they are no more than `n`.
    """
    cell = F.shiftright(hashed, 64 - _CELL_BITS)
    counts = df.where(hashed.isNotNull()).groupBy(cell.alias("cell")).count().collect()
    held, last = 0, 1 << _CELL_BITS
    for number, rows in sorted(counts):
        held += rows
        if held >= n:
            last = number
            break
    return df.where(cell <= last)


def labelled_sample(labels: DataFrame, per_class: int, turn: int = 0) -> DataFrame:
    """`doc_id, label` of at most `per_class` rows for each label 0 and 1, those of least hash.

    Rows with a null id or another label do not count, nor does a document with both labels.
    """
    order = F.xxhash64(F.lit(turn), "doc_id")
    known = labels.where("doc_id is not null and label in (0, 1)").groupBy("doc_id")
    known = known.agg(F.min("label").alias("label"), F.max("label").alias("other")).where("label = other")
    known = known.select("doc_id", F.col("label").cast("int").alias("label"))
    zeros, ones = (thinned(known.where(f"label = {label}"), order, per_class) for label in (0, 1))
    return zeros.orderBy(order, "doc_id").limit(per_class).unionByName(ones.orderBy(order, "doc_id").limit(per_class))


def sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -60, 60)))


def fit_logistic(x: np.ndarray, y: np.ndarray, ridge: float = 1e-2, steps: int = 50) -> np.ndarray:
    """Weights of a logistic regression, the constant last, by Newton's method."""
    x = np.column_stack([x, np.ones(len(x))])
    weights, penalty = np.zeros(x.shape[1]), np.full(x.shape[1], ridge)
    penalty[-1] = 1e-6
    for _ in range(steps):
        p = sigmoid(x @ weights)
        slope = x.T @ (p - y) + penalty * weights
        curve = (x * (p * (1 - p))[:, None]).T @ x + np.diag(penalty)
        step = np.linalg.solve(curve, slope)
        weights -= step
        if np.abs(step).max() < 1e-8:
            break
    return weights
