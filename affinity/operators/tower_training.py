"""Training two towers: id vectors through dense layers, scored by the dot product of the outputs.

A step is one pass over the given pairs, in tiles (``operators.tiles``). A tile's task runs both towers forward and
back over its pairs; it adds up the gradients of the layers, which have a fixed size, and those of its id vectors, and
gives them out once. One shuffle adds these sums; the layers' come to the driver as one row. Layers take an Adam
step, id vectors a row-wise Adagrad step.
"""

from __future__ import annotations

from dataclasses import dataclass, field

import numpy as np
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from affinity.functions.hashing import md5_u32
from affinity.functions.vectors import bce_with_logits, sigmoid
from affinity.operators import factors, tiles, towers
from affinity.operators.metrics import auroc
from affinity.operators.towers import Layer
from affinity.session import materialize

SIDES = ("user", "item")


@dataclass
class Net:
    """The layers of both towers with their Adam moments; small, and the same for any data."""

    layers: dict[str, list[Layer]]
    m: np.ndarray = field(default=None)
    v: np.ndarray = field(default=None)
    steps: int = 0

    def __post_init__(self):
        size = len(self.flat())
        self.m = np.zeros(size) if self.m is None else self.m
        self.v = np.zeros(size) if self.v is None else self.v

    def flat(self) -> np.ndarray:
        return np.concatenate([part.ravel() for side in SIDES for layer in self.layers[side] for part in layer])

    def unflat(self, flat: np.ndarray) -> dict[str, list[Layer]]:
        out, at = {}, 0
        for side in SIDES:
            out[side] = []
            for layer in self.layers[side]:
                parts = []
                for part in layer:
                    parts.append(flat[at : at + part.size].reshape(part.shape))
                    at += part.size
                out[side].append(tuple(parts))
        return out

    def adam(self, g: np.ndarray, lr: float, b1: float = 0.9, b2: float = 0.999, eps: float = 1e-8) -> Net:
        n = self.steps + 1
        m, v = b1 * self.m + (1 - b1) * g, b2 * self.v + (1 - b2) * g * g
        change = lr * (m / (1 - b1**n)) / (np.sqrt(v / (1 - b2**n)) + eps)
        return Net(self.unflat(self.flat() - change), m, v, n)

    def table(self, spark: SparkSession) -> DataFrame:
        """One row for each weight, in order: side, layer, row (-1: bias), col, value, m, v, steps."""
        rows, values, at = [], self.flat(), 0
        for side in SIDES:
            for n, (w, b) in enumerate(self.layers[side]):
                places = [(i, j) for i in range(w.shape[0]) for j in range(w.shape[1])] + [(-1, j) for j in range(len(b))]
                for i, j in places:
                    rows.append((side, n, i, j, float(values[at]), float(self.m[at]), float(self.v[at]), self.steps))
                    at += 1
        return spark.createDataFrame(rows, "side string, layer int, row int, col int, value double, m double, v double, steps int")


def read_net(table: DataFrame) -> Net:
    """The net that ``Net.table`` was written from."""
    rows = table.toPandas()
    layers, m, v = {}, [], []
    for side in SIDES:
        layers[side] = []
        mine = rows[rows["side"] == side]
        for n in sorted(mine["layer"].unique()):
            part = mine[mine["layer"] == n].sort_values(["row", "col"])
            bias, weights = part[part["row"] < 0], part[part["row"] >= 0]
            width = len(bias)
            layers[side].append((weights["value"].to_numpy().reshape(-1, width), bias["value"].to_numpy()))
            for out, name in ((m, "m"), (v, "v")):
                out += [weights[name].to_numpy(), bias[name].to_numpy()]
    return Net(layers, np.concatenate(m), np.concatenate(v), int(rows["steps"].iloc[0]))


# ---- one batch --------------------------------------------------------------------------


def outputs(x: np.ndarray, layers: list[Layer]) -> list[np.ndarray]:
    """The input and each layer's output; every layer ends in a relu."""
    out = [x]
    for w, b in layers:
        out.append(np.maximum(out[-1] @ w + b, 0.0))
    return out


def backward(outs: list[np.ndarray], g: np.ndarray, layers: list[Layer]) -> tuple[np.ndarray, list[np.ndarray]]:
    """Gradients of the input rows, and of the weights and biases of each layer in order."""
    parts: list[np.ndarray] = []
    for (w, _), before, after in zip(reversed(layers), reversed(outs[:-1]), reversed(outs[1:])):
        g = g * (after > 0)
        parts = [before.T @ g, g.sum(0), *parts]
        g = g @ w.T
    return g, parts


def pair_gradients(user: np.ndarray, item: np.ndarray, label: np.ndarray, net: Net, n_rows: int):
    """Loss, gradients of both inputs, and the flat gradient of all layers, of the mean cross-entropy over ``n_rows``."""
    outs = [outputs(x, net.layers[side]) for x, side in ((user, "user"), (item, "item"))]
    logit = (outs[0][-1] * outs[1][-1]).sum(1)
    loss = np.maximum(logit, 0) - logit * label + np.log1p(np.exp(-np.abs(logit)))
    error = ((1 / (1 + np.exp(-logit)) - label) / n_rows)[:, None]
    inputs, flat = [], []
    for n, side in enumerate(SIDES):
        g, parts = backward(outs[n], error * outs[1 - n][-1], net.layers[side])
        inputs.append(g)
        flat += [p.ravel() for p in parts]
    return loss.sum() / n_rows, inputs[0], inputs[1], np.concatenate(flat)


# ---- steps ------------------------------------------------------------------------------


def step(pairs: DataFrame, state: DataFrame, net: Net, dim: int, lr: float, vector_lr: float) -> tuple[DataFrame, Net, float]:
    """One step over all of ``pairs``: the new id vectors, the new net, and the loss before."""
    n_rows = pairs.count()
    if not n_rows:
        return state, net, float("nan")

    def learn(u, w, label):
        loss, gu, gw, flat = pair_gradients(u, w, label, net, n_rows)
        return gu, gw, np.append(flat, loss)

    history = state.withColumn("acc", F.array("acc"))
    found = tiles.run_pass(history, dim, train=pairs, learn=learn, move=factors.adagrad(vector_lr))
    found = materialize(found, "tower-vectors")
    sums = tiles.sums_of(found, "learned")
    total = np.array(sums[0][1]) if sums else np.zeros(len(net.flat()) + 1)
    return factors.as_state(found), net.adam(total[:-1], lr), float(total[-1])


def initial_net(dim: int, widths: list[int], seed: int, scale: float = 1.0) -> Net:
    """Keyed weights for both towers: ``dim`` inputs, then the given widths."""
    return Net({side: towers.keyed_layers(seed + n, [dim, *widths], scale) for n, side in enumerate(SIDES)})


def tower_outputs(state: DataFrame, net: Net, side: str, key: str) -> DataFrame:
    """Tower output per id."""
    rows = state.where(F.col("side") == side).select(F.col("id").alias(key), F.col("v").alias("embedding"))
    return towers.tower(rows, key, "embedding", net.layers[side])


def evaluate(pairs: DataFrame, state: DataFrame, net: Net) -> dict[str, float]:
    """Mean loss per row and AUROC of the pairs whose ids are known."""
    users, items = (tower_outputs(state, net, side, key) for side, key in zip(SIDES, ("user_id", "product_id")))
    scored = materialize(towers.score_pairs(pairs, users, items).select("logit", "label"), "scored")
    loss = scored.agg(F.avg(bce_with_logits("logit", "label"))).first()[0]
    return {"loss": loss, "auroc": auroc(scored.withColumn("p", sigmoid("logit")), "p", "label").first()[0]}


@dataclass
class TowerFit:
    state: DataFrame
    net: Net
    log: list[tuple[int, str, float, float]]  # epoch, stage, loss, auroc


def fit(
    train: DataFrame, dim: int = 16, widths: tuple[int, ...] = (16, 8), epochs: int = 3, lr: float = 0.01, vector_lr: float = 0.1,
    seed: int = 42, scale: float = 1.0, batches: int = 1, validation: DataFrame | None = None,
) -> TowerFit:
    """Train for some epochs; an epoch takes one step on each of ``batches`` parts of the pairs (by hash)."""
    train = materialize(train.select("user_id", "product_id", "label"), "train")
    rows, stage = (validation, "val") if validation is not None else (train, "train")
    state = materialize(factors.initial_state(train, dim, seed, scale), "tower-vectors")
    net, log = initial_net(dim, list(widths), seed, scale), []
    for n in range(epochs + 1):
        for part in range(batches if n else 0):
            some = train.where(F.pmod(md5_u32(seed, "user_id", "product_id"), F.lit(batches)) == part) if batches > 1 else train
            state, net, _ = step(some, state, net, dim, lr, vector_lr)
        found = evaluate(rows, state, net)
        log.append((n, stage, found["loss"], found["auroc"]))
    return TowerFit(state, net, log)
