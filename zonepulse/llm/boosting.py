"""Gradient-boosted trees for binary labels, in numpy, on binned features.

Small and plain: logistic loss, Newton leaf values, level-wise trees of fixed depth whose
splits are searched on histograms.  ``train_on`` fits on all rows of a DataFrame: every level
of every tree is one pass of Spark over the binned rows, and only histograms of a fixed size
reach the driver.  ``train`` does the same on arrays.  A model is a few kilobytes and goes to
the tasks with the function that uses it.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import durable_freed

BINS = 32
SCALE = 1 << 24  # gradients are summed as whole numbers of 1 / SCALE, so in any order alike


@dataclass
class Boosted:
    edges: list[np.ndarray] = field(default_factory=list)  # per feature
    trees: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = field(default_factory=list)  # feature, bin, leaf values
    bias: float = 0.0
    depth: int = 3

    def _binned(self, x: np.ndarray) -> np.ndarray:
        return np.stack([np.searchsorted(e, x[:, j], side="left") for j, e in enumerate(self.edges)], axis=1)

    def _leaf(self, binned: np.ndarray, feature: np.ndarray, cut: np.ndarray) -> np.ndarray:
        node = np.zeros(len(binned), dtype=np.int64)
        rows = np.arange(len(binned))
        for _ in range(self.depth):
            node = 2 * node + 1 + (binned[rows, feature[node]] > cut[node])
        return node - (2**self.depth - 1)

    def margin(self, x: np.ndarray) -> np.ndarray:
        return self._margin(self._binned(x)) if len(x) and self.trees else np.full(len(x), self.bias)

    def _margin(self, binned: np.ndarray) -> np.ndarray:
        out = np.full(len(binned), self.bias)
        for feature, cut, values in self.trees:
            out += values[self._leaf(binned, feature, cut)]
        return out


def _splits(g: np.ndarray, h: np.ndarray, ridge: float) -> tuple[np.ndarray, np.ndarray]:
    """Best feature and bin of each node, from sums (node, feature, bin) up to each bin; a node
    without a gain is not split (bin ``BINS``)."""
    gt, ht = g[:, :, -1:], h[:, :, -1:]
    gains = g**2 / (h + ridge) + (gt - g) ** 2 / (ht - h + ridge) - gt**2 / (ht + ridge)
    best = gains.reshape(len(g), -1).argmax(1)
    use = gains.reshape(len(g), -1).max(1) > 1e-9
    return np.where(use, best // BINS, 0), np.where(use, best % BINS, BINS)


def train(x: np.ndarray, y: np.ndarray, rounds: int = 60, depth: int = 3, rate: float = 0.2, ridge: float = 1.0) -> Boosted:
    """Fits on rows ``x`` (floats) with labels ``y`` (0 or 1); deterministic."""
    model = Boosted(depth=depth)
    n, m = x.shape
    share = (y.sum() + 1) / (n + 2)
    model.bias = float(np.log(share / (1 - share)))
    if n == 0:
        return model
    model.edges = [np.unique(np.quantile(x[:, j], np.linspace(0, 1, BINS)[1:-1], method="lower")) for j in range(m)]
    binned = model._binned(x)
    margin = np.full(n, model.bias)
    inner, leaves = 2**depth - 1, 2**depth
    for _ in range(rounds):
        p = 1 / (1 + np.exp(-margin))
        gradient, hessian = y - p, p * (1 - p)
        feature, cut = np.zeros(inner, dtype=np.int64), np.full(inner, BINS, dtype=np.int64)
        node = np.zeros(n, dtype=np.int64)
        for level in range(depth):
            first, count = 2**level - 1, 2**level
            local = node - first
            sums = np.zeros((2, count, m, BINS))
            for j in range(m):
                key = local * BINS + binned[:, j]
                sums[0, :, j] = np.bincount(key, gradient, count * BINS).reshape(count, BINS).cumsum(1)
                sums[1, :, j] = np.bincount(key, hessian, count * BINS).reshape(count, BINS).cumsum(1)
            feature[first : first + count], cut[first : first + count] = _splits(*sums, ridge)
            node = 2 * node + 1 + (binned[np.arange(n), feature[node]] > cut[node])
        leaf = node - inner
        values = rate * np.bincount(leaf, gradient, leaves) / (np.bincount(leaf, hessian, leaves) + ridge)
        model.trees.append((feature, cut, values))
        margin += values[leaf]
    return model


def quantile_edges(rows: DataFrame) -> list[np.ndarray]:
    """Bin edges per feature: lower quantiles over all ``rows`` (x array<float>, n long)."""
    values = rows.select(F.posexplode("x").alias("j", "v"), "n").groupBy("j", "v").agg(F.sum("n").alias("n"))
    by = Window.partitionBy("j")
    ranked = values.select(
        "j", "v", "n", (F.sum("n").over(by.orderBy("v")) - F.col("n")).alias("before"), (F.sum("n").over(by) - 1).alias("last")
    )
    # the first quantile i / (BINS - 1) that isn't below the value, if it is at the value
    i = F.expr(f"greatest(1, ({BINS - 1} * before + greatest(last, 1) - 1) div greatest(last, 1))")
    hit = ranked.withColumn("i", i).where(f"i < {BINS - 1} and i * last div {BINS - 1} < before + n").select("j", "v").collect()
    return [np.array(sorted(r.v for r in hit if r.j == j)) for j in range(max((r.j for r in hit), default=-1) + 1)]


def train_on(rows: DataFrame, rounds: int = 60, depth: int = 3, rate: float = 0.2, ridge: float = 1.0) -> Boosted:
    """Fits on all ``rows`` (x array<float>, y boolean, n long), ``n`` being the number of equal
    rows; deterministic."""
    model = Boosted(depth=depth)
    total, positive = (v or 0 for v in rows.agg(F.sum("n"), F.sum(F.when(F.col("y"), F.col("n")))).first())
    share = (positive + 1) / (total + 2)
    model.bias = float(np.log(share / (1 - share)))
    if not total:
        return model
    model.edges = quantile_edges(rows)
    m = len(model.edges)

    def to_bins(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x = batch.column(0).flatten().to_numpy().astype(np.float64).reshape(-1, m)
            bins = model._binned(x).astype(np.uint8)
            yield pa.RecordBatch.from_arrays([pa.array([b.tobytes() for b in bins], pa.binary()), *batch.columns[1:]], names=["bins", "y", "n"])

    binned = durable_freed(
        rows.select("x", "y", "n").mapInArrow(to_bins, "bins binary, y boolean, n long").groupBy("bins", "y").agg(F.sum("n").alias("n"))
    )
    inner = 2**depth - 1
    for _ in range(rounds):
        feature, cut = np.zeros(inner, dtype=np.int64), np.full(inner, BINS, dtype=np.int64)
        for level in range(depth):
            first, count = 2**level - 1, 2**level
            g, h = _sums(binned, model, feature, cut, level, m)
            feature[first : first + count], cut[first : first + count] = _splits(g, h, ridge)
        # sums of the leaves: on each side of the last splits
        nodes = np.arange(count)
        j, at = feature[first:], np.minimum(cut[first:], BINS - 1)
        left, whole = ([x[nodes, j, c] for x in (g, h)] for c in (at, BINS - 1))
        gradient, hessian = (np.stack([a, b - a], axis=1).ravel() for a, b in zip(left, whole))
        model.trees.append((feature, cut, rate * gradient / (hessian + ridge)))
    return model


def _sums(binned: DataFrame, model: Boosted, feature: np.ndarray, cut: np.ndarray, level: int, m: int) -> np.ndarray:
    """Gradients and hessians (2, node, feature, bin) of all rows up to each bin, for the nodes
    of ``level`` of the tree that is being grown; a task sends one row."""
    count = 2**level

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((2, m, count * BINS), dtype=np.int64)
        for batch in batches:
            bins = np.frombuffer(b"".join(batch.column(0).to_pylist()), dtype=np.uint8).reshape(-1, m).astype(np.int64)
            y, n = batch.column(1).to_numpy(zero_copy_only=False), batch.column(2).to_numpy()
            p = 1 / (1 + np.exp(-model._margin(bins)))
            node, at = np.zeros(len(bins), dtype=np.int64), np.arange(len(bins))
            for _ in range(level):
                node = 2 * node + 1 + (bins[at, feature[node]] > cut[node])
            weights = [np.rint(v * SCALE) * n for v in (y - p, p * (1 - p))]
            for j in range(m):
                key = (node - (count - 1)) * BINS + bins[:, j]
                for i in (0, 1):
                    total[i, j] += np.bincount(key, weights[i], count * BINS).astype(np.int64)
        yield pa.RecordBatch.from_arrays([pa.array([total.ravel()], pa.list_(pa.int64()))], names=["sums"])

    got = binned.mapInArrow(run, "sums array<bigint>").toArrow()["sums"]
    total = np.sum([x.values.to_numpy() for x in got], axis=0).reshape(2, m, count, BINS)
    return total.transpose(0, 2, 1, 3).cumsum(3) / SCALE
