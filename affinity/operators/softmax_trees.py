"""Boosted trees for several classes: softmax gradients, one tree per class and round.

Columns are cut in bins at quantiles once. A round takes the gradients p - y and curvatures p (1 - p) of every
class at the scores so far and grows all classes' trees level by level: a level is one pass in which tasks add
up gradients in (class, node, column, bin) histograms, whose size the parameters fix; a shuffle adds the
histograms of each (class, node), and the driver picks the splits from those sums. Rows are only rewritten
once a round, with their new scores.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from affinity.operators.partials import PARTIAL, as_lists, as_matrix, partial_rows, summed
from affinity.session import materialize

MISSING = -1  # the bin of a null, which goes left


@dataclass
class Tree:
    """Nodes in level order: column and last bin that goes left (column -1: a leaf with ``value``)."""

    column: list[int]
    bin: list[int]
    value: list[float]

    def leaf(self, bins: np.ndarray) -> np.ndarray:
        """The node at which each row ends; the children of node n are 2 n + 1 and 2 n + 2."""
        column, last = np.array(self.column), np.array(self.bin)
        node = np.zeros(len(bins), dtype=np.int64)
        while True:
            inner = np.flatnonzero(column[node] >= 0)
            if not len(inner):
                return node
            at = node[inner]
            node[inner] = 2 * at + 1 + (bins[inner, column[at]] > last[at])


@dataclass
class SoftmaxTrees:
    features: list[str]
    cuts: list[np.ndarray]
    rounds: list[list[Tree]]
    labels: int
    rate: float

    def scores(self, bins: np.ndarray) -> np.ndarray:
        out = np.zeros((len(bins), self.labels))
        for trees in self.rounds:
            for k, tree in enumerate(trees):
                out[:, k] += self.rate * np.array(tree.value)[tree.leaf(bins)]
        return out

    def predict(self, rows: DataFrame) -> DataFrame:
        """``rows`` with ``probabilities`` (an array) and ``prediction``, the most probable class (the least of equal ones)."""
        fields = ", ".join(f"`{n}` {t}" for n, t in rows.dtypes)

        def run(batches):
            for batch in batches:
                if batch.num_rows:
                    p = softmax(self.scores(binned(batch, self.features, self.cuts)))
                    yield batch.append_column("probabilities", as_lists(p)).append_column("prediction", pa.array(p.argmax(1), pa.int32()))

        return rows.mapInArrow(run, f"{fields}, probabilities array<double>, prediction int")


def softmax(scores: np.ndarray) -> np.ndarray:
    e = np.exp(scores - scores.max(1, keepdims=True))
    return e / e.sum(1, keepdims=True)


def binned(batch, features: list[str], cuts: list[np.ndarray]) -> np.ndarray:
    """Bin of every row in every column: the number of cut points below the value; null and NaN are missing."""
    out = np.empty((batch.num_rows, len(features)), dtype=np.int64)
    for j, (name, cut) in enumerate(zip(features, cuts)):
        x = batch.column(name).cast(pa.float64()).to_numpy(zero_copy_only=False)
        out[:, j] = np.where(np.isnan(x), MISSING, np.searchsorted(cut, x, side="left"))
    return out


def quantile_cuts(rows: DataFrame, features: list[str], bins: int, error: float = 0.001) -> list[np.ndarray]:
    """Distinct cut points at approximate quantiles, fewer than ``bins`` per column; a value up to a cut lies below it."""
    asked = [i / bins for i in range(1, bins)]
    found = rows.select(*[F.col(c).cast("double").alias(c) for c in features]).approxQuantile(features, asked, error)
    return [np.unique(np.array(c, dtype=np.float64)) for c in found]


def best_split(g: np.ndarray, h: np.ndarray, l2: float, least: float) -> tuple[float, int, int]:
    """Gain, column and last left bin of the best split of one node; sums by column and bin, bin 0 being missing."""
    left_g, left_h = np.cumsum(g, axis=1)[:, :-1], np.cumsum(h, axis=1)[:, :-1]
    all_g, all_h = g.sum(1)[:, None], h.sum(1)[:, None]
    right_g, right_h = all_g - left_g, all_h - left_h
    gain = left_g**2 / (left_h + l2) + right_g**2 / (right_h + l2) - all_g**2 / (all_h + l2)
    gain = np.where((left_h >= least) & (right_h >= least), np.round(gain, 9), -np.inf)
    at = int(gain.argmax())  # of equal gains the first column and bin
    column, bin_ = divmod(at, gain.shape[1])
    return float(gain[column, bin_]), column, bin_ - 1


def _histograms(rows: DataFrame, trees: list[Tree], level: int, n_columns: int, width: int, labels: int) -> DataFrame:
    """Sums (side, id, g): for each class and open node of a level its gradients and curvatures by column and bin."""
    first, count = 2**level - 1, 2**level

    def run(batches):
        sums = np.zeros((labels, count, 2, n_columns * width))
        for batch in batches:
            if batch.num_rows:
                bins, scores = as_matrix(batch.column("bins")).astype(np.int64), as_matrix(batch.column("scores"))
                p = softmax(scores)
                target = batch.column("target").to_numpy()
                place = np.arange(n_columns)[None, :] * width + bins + 1
                for k, tree in enumerate(trees):
                    node = tree.leaf(bins) - first
                    open_ = np.flatnonzero(node >= 0)
                    if len(open_):
                        at = node[open_][:, None] * (n_columns * width) + place[open_]
                        for n, x in enumerate((p[:, k] - (target == k), p[:, k] * (1 - p[:, k]))):
                            each = np.repeat(x[open_], n_columns)
                            sums[k, :, n] += np.bincount(at.ravel(), weights=each, minlength=count * n_columns * width).reshape(count, -1)
        ids = np.flatnonzero(np.abs(sums).sum((2, 3)).ravel() > 0)
        yield partial_rows("node", ids, sums.reshape(labels * count, -1)[ids])

    return summed(rows.mapInArrow(run, PARTIAL))


def _grow(rows: DataFrame, cuts, labels: int, max_depth: int, l2: float, least: float) -> list[Tree]:
    """The trees of one round, one for each class."""
    n_columns, width = len(cuts), 2 + max(len(c) for c in cuts)  # a place for missing values before the bins
    size = 2 ** (max_depth + 1) - 1
    trees = [Tree([-1] * size, [0] * size, [0.0] * size) for _ in range(labels)]
    for level in range(max_depth + 1):
        first, count, split = 2**level - 1, 2**level, False
        found = _histograms(rows, trees, level, n_columns, width, labels).select("id", "g").toArrow()  # classes x nodes rows
        for i, flat in zip(found["id"].to_pylist(), as_matrix(found["g"].combine_chunks()) if found.num_rows else []):
            k, node = divmod(i, count)
            g, h = flat.reshape(2, n_columns, width)
            total_g, total_h = g[0].sum(), h[0].sum()
            trees[k].value[first + node] = -total_g / (total_h + l2)
            if level < max_depth:
                gain, column, last = best_split(g, h, l2, least)
                if gain > 1e-9:
                    trees[k].column[first + node], trees[k].bin[first + node], split = column, last, True
        if not split:
            break
    return trees


def fit(
    train: DataFrame, features: list[str], target: str = "target", labels: int = 2, max_depth: int = 5, rounds: int = 10,
    rate: float = 0.3, bins: int = 32, l2: float = 1.0, least: float = 1e-3, cuts: list[list[float]] | None = None,
) -> SoftmaxTrees:
    """Fit to whole-number targets from 0 to ``labels`` - 1; rows without a target are left out.

    A null or NaN value lies left of every cut. ``least`` is the curvature each side of a split must have.
    """
    cuts = [np.array(sorted(c), dtype=np.float64) for c in cuts] if cuts else quantile_cuts(train, features, bins)
    wrong = train.where(F.col(target).isNotNull() & ~F.col(target).between(0, labels - 1))
    if not wrong.isEmpty():
        raise ValueError(f"{target} is not within 0 to {labels - 1}")
    given = train.where(F.col(target).isNotNull()).select(*[F.col(c).cast("double").alias(c) for c in features], F.col(target).cast("int").alias("target"))

    def prepare(batches):
        for batch in batches:
            if batch.num_rows:
                yield pa.RecordBatch.from_arrays(
                    [batch.column("target"), as_lists(binned(batch, features, cuts)), as_lists(np.zeros((batch.num_rows, labels)))],
                    names=["target", "bins", "scores"],
                )

    schema = "target int, bins array<long>, scores array<double>"
    rows = materialize(given.mapInArrow(prepare, schema), "tree-rows")
    model = SoftmaxTrees(features, cuts, [], labels, rate)
    for n in range(rounds):
        trees = _grow(rows, cuts, labels, max_depth, l2, least)
        model.rounds.append(trees)
        if n < rounds - 1:
            rows = materialize(rows.mapInArrow(_scored(trees, rate), schema), "tree-rows")
    return model


def _scored(trees: list[Tree], rate: float):
    def run(batches):
        for batch in batches:
            if batch.num_rows:
                bins, scores = as_matrix(batch.column("bins")).astype(np.int64), as_matrix(batch.column("scores"))
                for k, tree in enumerate(trees):
                    scores[:, k] += rate * np.array(tree.value)[tree.leaf(bins)]
                yield batch.set_column(2, "scores", as_lists(scores))

    return run
