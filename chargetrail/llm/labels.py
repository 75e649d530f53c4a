"""Bounded, reproducible samples of labelled documents, and small logistic fits."""

from __future__ import annotations

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from chargetrail.session import materialise


def crc_fold(id_col: str, folds: int) -> Column:
    """CRC-32 of the id's decimal text, modulo `folds`; NULL for a NULL id."""
    return F.pmod(F.crc32(F.col(id_col).cast("string").cast("binary")), F.lit(folds)).cast("int")


def training_sample(
    docs: DataFrame, labels: DataFrame, label: str, usable: Column, most: int, id_col: str = "doc_id", text_col: str = "text"
) -> tuple[DataFrame, dict[int, int]]:
    """`(text, label)` of at most `most` documents per class, and how many usable ones each class has.

    Of the labelled ids that are `usable`, those with the smallest MD5 are taken: only ids are sorted, and of the
    documents only the chosen ones leave their task. Ids with a NULL label or with both labels are not used; rows that
    repeat an id give one text.
    """
    agreed = (
        labels.select(F.col(id_col).alias("_id"), F.col(label).cast("int").alias("label"), usable.alias("_usable"))
        .where("_usable AND _id IS NOT NULL AND label IN (0, 1)")
        .groupBy("_id")
        .agg(F.min("label").alias("label"), F.max("label").alias("_other"))
        .where("label = _other")
    )
    agreed = materialise(agreed.select("_id", "label"), "labels")
    counts = {row["label"]: row["count"] for row in agreed.groupBy("label").count().collect()}
    by_hash = F.md5(F.col("_id").cast("string").cast("binary"))
    chosen = None
    for value in (0, 1):
        part = agreed.where(F.col("label") == value).orderBy(by_hash, "_id").limit(most)
        chosen = part if chosen is None else chosen.unionByName(part)
    # At most 2 * most ids of 8 bytes.
    chosen = F.broadcast(materialise(chosen, "chosen"))
    texts = docs.select(F.col(id_col).alias("_id"), F.col(text_col).alias("text")).join(chosen, "_id")
    return texts.groupBy("_id").agg(F.min_by(F.struct("text", "label"), F.xxhash64("text")).alias("_row")).select("_row.*"), counts


def class_weights(y: np.ndarray, counts: dict[int, int]) -> np.ndarray:
    """Weights that give each class of a sample its share of all usable labels; they add up to the sample's size."""
    total = sum(counts.values())
    share = np.array([counts.get(0, 0), counts.get(1, 0)]) / max(total, 1)
    own = np.array([(y == 0).mean(), (y == 1).mean()])
    return (share / np.maximum(own, 1e-9))[y]


def sigmoid(z: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(z, -40, 40)))


def fit_line(x: np.ndarray, y: np.ndarray, weights: np.ndarray, l2: float = 1e-3, steps: int = 50) -> tuple[float, float]:
    """Slope and intercept of a logistic regression on one number, by Newton steps."""
    middle, spread = x.mean(), x.std() or 1.0
    design = np.stack([(x - middle) / spread, np.ones_like(x)], axis=1)
    w = np.zeros(2)
    for _ in range(steps):
        p = sigmoid(design @ w)
        gradient = design.T @ (weights * (p - y)) + l2 * len(x) * w * [1, 0]
        hessian = (design * (weights * p * (1 - p))[:, None]).T @ design + np.diag([l2 * len(x), 1e-9])
        step = np.linalg.solve(hessian, gradient)
        w -= step
        if np.abs(step).max() < 1e-9:
            break
    return float(w[0] / spread), float(w[1] - w[0] * middle / spread)
