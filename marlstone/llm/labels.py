"""Labelled rows and the small fits on the driver that the classifiers share."""

from __future__ import annotations

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from marlstone.llm.common import logistic


def share(ident: Column, fraction: float, seed: int) -> Column:
    """True for about ``fraction`` of the identifiers, always the same ones."""
    steps = 1 << 30
    return F.pmod(F.xxhash64(ident, F.lit(seed)), F.lit(steps)) < int(fraction * steps)


def labelled_texts(
    docs: DataFrame, labels: DataFrame, label: str, learn: Column, ident: str = "doc_id", text: str = "text",
) -> DataFrame:
    """(doc_id, text, label) of labelled rows for which ``learn``, a condition on doc_id, holds.

    Rows are reduced before they are shuffled.  Of contradicting labels the larger counts;
    null labels and null identifiers do not.
    """
    known = labels.select(F.col(ident).alias("doc_id"), F.col(label).cast("int").alias("label"))
    known = known.where(F.col("label").isNotNull() & learn).groupBy("doc_id").agg(F.max("label").alias("label"))
    texts = docs.select(F.col(ident).alias("doc_id"), F.coalesce(F.col(text), F.lit("")).alias("text")).where(learn)
    # One plan at every size: labels grow with the documents, so they are never broadcast.
    return texts.join(known.hint("merge"), "doc_id")


def fit_logistic(x: np.ndarray, y: np.ndarray, ridge: float, penalise: np.ndarray | None = None, steps: int = 60):
    """Weights of a logistic regression by damped Newton steps (ridge on ``penalise`` columns)."""
    w = np.zeros(x.shape[1])
    ridges = ridge * (np.ones(x.shape[1]) if penalise is None else penalise) + 1e-9

    def loss(v):
        return np.logaddexp(0, -(2 * y - 1) * (x @ v)).mean() + 0.5 * (ridges * v * v).sum()

    for _ in range(steps):
        p = logistic(x @ w)
        gradient = x.T @ (p - y) / len(y) + ridges * w
        hessian = (x * (p * (1 - p))[:, None]).T @ x / len(y) + np.diag(ridges)
        step, size, now = np.linalg.solve(hessian, gradient), 1.0, loss(w)
        while size > 1e-6 and loss(w - size * step) > now:
            size /= 2
        w = w - size * step
        if np.abs(size * step).max() < 1e-8:
            break
    return w
