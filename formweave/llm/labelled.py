"""A bounded labelled sample for training, and a small optimiser."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def labelled_sample(documents: DataFrame, labels: DataFrame, label: str, usable: Column,
                    per_class: int) -> tuple[pa.Array, np.ndarray]:
    """Whole texts and 0/1 labels of at most ``per_class`` documents of each
    class, the ones smallest by a hash of their id, in order of id.

    ``usable`` is a condition over ``doc_id``.  Rows of ``labels`` with a
    null or other value are left out; of several labels for one document the
    largest counts.  Only chosen ids are broadcast (``2 * per_class`` rows),
    and only their texts reach the driver."""
    known = (labels.where(F.col(label).isin(0, 1) & F.col("doc_id").isNotNull() & usable)
             .groupBy("doc_id").agg(F.max(label).cast("int").alias("label")))
    order = (F.xxhash64("doc_id", F.lit(label)), "doc_id")
    chosen = known.where("label = 0").orderBy(*order).limit(per_class).union(
        known.where("label = 1").orderBy(*order).limit(per_class))
    rows = (documents.select("doc_id", "text").join(F.broadcast(chosen), "doc_id")
            .select("doc_id", F.coalesce("text", F.lit("")).alias("text"), "label").toArrow()
            .sort_by([("doc_id", "ascending"), ("text", "ascending")]))
    return rows.column("text").combine_chunks().cast(pa.string()), rows.column("label").to_numpy().astype(np.float64)


def sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -40, 40)))


class Adam:
    """Adam over a dict of arrays, updated in place."""

    def __init__(self, params: dict[str, np.ndarray], rate: float, decay: float = 0.0):
        self.params, self.rate, self.decay, self.t = params, rate, decay, 0
        self.m = {k: np.zeros_like(v) for k, v in params.items()}
        self.v = {k: np.zeros_like(v) for k, v in params.items()}

    def step(self, grads: dict[str, np.ndarray]) -> None:
        self.t += 1
        for k, g in grads.items():
            g = g + self.decay * self.params[k]
            self.m[k] = 0.9 * self.m[k] + 0.1 * g
            self.v[k] = 0.999 * self.v[k] + 0.001 * g * g
            self.params[k] -= (self.rate * self.m[k] / (1 - 0.9 ** self.t)
                               / (np.sqrt(self.v[k] / (1 - 0.999 ** self.t)) + 1e-8)).astype(self.params[k].dtype)
