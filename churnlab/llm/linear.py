"""Small helpers of the classifiers: bounded labelled samples and weighted logistic regression by Newton steps."""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def sigmoid(z):
    return 1.0 / (1.0 + np.exp(-np.clip(z, -500, 500)))


def logit(p):
    p = np.clip(p, 1e-9, 1 - 1e-9)
    return np.log(p / (1 - p))


def fit_logistic(x: np.ndarray, y: np.ndarray, weight: np.ndarray | None = None, l2: float = 1.0,
                 extra: np.ndarray | None = None, steps: int = 30) -> np.ndarray:
    """Coefficients, the intercept last, that minimise  sum(weight * log loss) + l2/2 |w|^2 + 1/2 w' extra w.

    ``extra`` is a positive semi-definite matrix over the features. Without rows, or with one class, the small
    penalty on the intercept keeps the result finite.
    """
    n, d = x.shape
    x1 = np.concatenate([x, np.ones((n, 1))], axis=1).astype(np.float64)
    weight = np.ones(n) if weight is None else weight
    penalty = np.diag(np.r_[np.full(d, l2), 1e-2])
    if extra is not None:
        penalty[:d, :d] += extra

    def loss(w):
        z = x1 @ w
        return float(weight @ (np.logaddexp(0, z) - y * z) + 0.5 * w @ penalty @ w)
    w = np.zeros(d + 1)
    now = loss(w)
    for _ in range(steps):
        p = sigmoid(x1 @ w)
        grad = x1.T @ (weight * (p - y)) + penalty @ w
        step = np.linalg.solve((x1 * (weight * np.maximum(p * (1 - p), 1e-6))[:, None]).T @ x1 + penalty, grad)
        size = 1.0
        while (new := loss(w - size * step)) > now and size > 1e-6:
            size /= 2
        if now - new < 1e-9 * max(1.0, abs(now)):
            break
        w, now = w - size * step, new
    return w


def labelled_sample(labels: DataFrame, label: str, rows: int) -> DataFrame:
    """(doc_id, y int, weight double): at most ``rows`` / 2 labelled ids of each class, the first by hash of the id.

    Weights restore the classes' shares. A repeated id with different labels counts as 1; null labels are left out.
    """
    one = labels.where(F.col("doc_id").isNotNull() & F.col(label).isNotNull()).groupBy("doc_id").agg(
        F.max((F.col(label) != 0).cast("int")).alias("y"))
    counts = {r["y"]: r["count"] for r in one.groupBy("y").count().collect()}
    parts = []
    for y in (0, 1):
        weight = max(1.0, counts.get(y, 0) / (rows // 2))
        parts.append(one.where(F.col("y") == y).orderBy(F.xxhash64("doc_id"), "doc_id").limit(rows // 2)
                     .withColumn("weight", F.lit(weight)))
    return parts[0].union(parts[1])


def one_row_per_id(rows: DataFrame, values: list[str], same: list[str] = ()) -> DataFrame:
    """One row of each doc_id, the one with the smallest hash of its ``values``; ``same`` are equal for an id."""
    best = F.min_by(F.struct(*values), F.xxhash64(*values)).alias("_best")
    return rows.groupBy("doc_id", *same).agg(best).select("doc_id", *same, "_best.*")
