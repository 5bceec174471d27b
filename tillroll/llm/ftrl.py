"""Follow-the-regularised-leader (proximal, per-coordinate) with elastic net over sparse rows.

Rows (idx array<int>, val array<float>, target array<float>) are dealt to a fixed number of
partitions; in each epoch every partition goes on from the common state, and the partitions' states
are averaged by their row counts (parameter mixing).  What reaches the driver is ``PARTITIONS``
states, of the model's fixed size.  One target column makes a logistic model, more a multinomial."""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
from pyspark.sql import DataFrame

from tillroll.llm.rows import runs

PARTITIONS = 8


@dataclass
class Ftrl:
    classes: int
    width: int
    alpha: float = 0.2
    beta: float = 1.0
    l1: float = 0.5
    l2: float = 1.0

    def weights(self, z: np.ndarray, n: np.ndarray) -> np.ndarray:
        step = (self.beta + np.sqrt(n)) / self.alpha + self.l2
        return np.where(np.abs(z) <= self.l1, 0.0, (np.sign(z) * self.l1 - z) / step)

    def learn(self, z, n, idx, val, target) -> None:
        """One row: predict, then move z and n at the row's coordinates."""
        zi, ni = z[:, idx], n[:, idx]
        w = self.weights(zi, ni)
        g = (probabilities((w @ val)[None, :])[0] - target)[:, None] * val
        grown = ni + g * g
        z[:, idx] = zi + g - (np.sqrt(grown) - np.sqrt(ni)) / self.alpha * w
        n[:, idx] = grown


def probabilities(logits: np.ndarray) -> np.ndarray:
    """Sigmoid of one column, softmax of several."""
    if logits.shape[1] == 1:
        return 1 / (1 + np.exp(-np.clip(logits, -40, 40)))
    e = np.exp(logits - logits.max(1, keepdims=True))
    return e / e.sum(1, keepdims=True)


def sparse_logits(weights: np.ndarray, idx: list[np.ndarray], val: list[np.ndarray]) -> np.ndarray:
    return np.array([weights[:, i] @ v for i, v in zip(idx, val)]).reshape(len(idx), weights.shape[0])


def train(rows: DataFrame, model: Ftrl, epochs: int) -> np.ndarray:
    """Weights (classes, width) of a staged, bounded table of rows; zeros for no rows."""
    z, n = np.zeros((model.classes, model.width)), np.zeros((model.classes, model.width))
    rows = rows.select("idx", "val", "target").coalesce(PARTITIONS)
    for _ in range(epochs):
        def run(batches, z=z, n=n):
            import pyarrow as pa
            z, n, seen = z.copy(), n.copy(), 0
            for b in batches:
                for i, v, t in zip(runs(b.column("idx")), runs(b.column("val")), runs(b.column("target"))):
                    model.learn(z, n, i, v.astype(np.float64), t.astype(np.float64))
                    seen += 1
            if seen:
                yield pa.RecordBatch.from_pydict({"z": [z.tobytes()], "n": [n.tobytes()], "seen": [seen]})

        got = rows.mapInArrow(run, "z binary, n binary, seen long").collect()
        if not got:
            break
        share = np.array([r["seen"] for r in got], float) / sum(r["seen"] for r in got)
        z = sum(s * np.frombuffer(r["z"]).reshape(z.shape) for s, r in zip(share, got))
        n = sum(s * np.frombuffer(r["n"]).reshape(n.shape) for s, r in zip(share, got))
    return model.weights(z, n)
