"""Learning user and item vectors with DataFrame steps."""

from __future__ import annotations

import math
from dataclasses import dataclass

import numpy as np
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from affinity.functions.hashing import md5_uniform
from affinity.functions.vectors import fixed_dot, sigmoid
from affinity.operators import tiles
from affinity.operators.ranking import dense_index
from affinity.session import materialize

EPSILON = 1e-8


def initial_state(pairs: DataFrame, dim: int, seed: int, scale: float = 1.0) -> DataFrame:
    """(side, id, v, acc) for every user and item of ``pairs``: keyed vectors, zero history."""
    ids = (
        pairs.select(F.lit("user").alias("side"), F.col("user_id").cast("bigint").alias("id")).distinct()
        .unionByName(
            pairs.select(F.lit("item").alias("side"), F.col("product_id").cast("bigint").alias("id")).distinct()
        )
    )
    parts = [(md5_uniform(seed, "side", "id", j) - F.lit(0.5)) * F.lit(scale) for j in range(dim)]
    return ids.select("side", "id", F.array(*parts).alias("v"), F.lit(0.0).alias("acc"))


def with_logits(pairs: DataFrame, state: DataFrame, dim: int) -> DataFrame:
    """Pairs with both vectors and their dot product."""
    users = state.where("side = 'user'").select(F.col("id").alias("user_id"), F.col("v").alias("u"))
    items = state.where("side = 'item'").select(
        F.col("id").alias("product_id"), F.col("v").alias("w")
    )
    joined = pairs.select("user_id", "product_id", "label").join(users, "user_id")
    return joined.join(items, "product_id").withColumn("logit", fixed_dot("u", "w", dim))


def logits_and_loss(u: np.ndarray, w: np.ndarray, label: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Logits of pairs, and the sum of their cross-entropies with their number."""
    logit = (u * w).sum(1)
    loss = np.maximum(logit, 0) - logit * label + np.log1p(np.exp(-np.abs(logit)))
    return logit, np.array([loss.sum(), len(logit)])


def probability(logit: np.ndarray) -> np.ndarray:
    with np.errstate(over="ignore"):
        return 1 / (1 + np.exp(-logit))


def _learn(u, w, label):
    error = (probability((u * w).sum(1)) - label)[:, None]
    return error * w, error * u, np.zeros(1)


def _score(u, w, label):
    logit, sums = logits_and_loss(u, w, label)
    return probability(logit), sums


def adagrad(lr: float):
    """Row-wise Adagrad steps of vectors."""

    def move(v, g, acc):
        acc = acc + (g**2).mean(1, keepdims=True)
        return v - (lr / (np.sqrt(acc) + EPSILON)) * g, acc

    return move


def as_state(found: DataFrame) -> DataFrame:
    """The state in the rows of a pass."""
    return tiles.vectors_of(found).select("side", "id", "v", F.col("acc")[0].alias("acc"))


def epoch(pairs: DataFrame, state: DataFrame, dim: int, lr: float) -> DataFrame:
    """One full pass: cross-entropy gradients of all vectors, then a row-wise Adagrad step.

    Pairs and vectors meet in tiles, so an id costs a few rows per tile in the shuffles, however many pairs it has.
    """
    history = state.withColumn("acc", F.array("acc"))
    return as_state(tiles.run_pass(history, dim, train=pairs, learn=_learn, move=adagrad(lr)))


class Scoring:
    """Mean loss per row and AUROC of the same pairs in several states."""

    def __init__(self, pairs: DataFrame, dim: int):
        self.pairs, self.dim = pairs, dim
        self.some, self.ranges = tiles.spread(pairs)

    def run(self, state: DataFrame, train: DataFrame | None = None, lr: float = 0.0) -> tuple[DataFrame, dict[str, float | None]]:
        """The figures in ``state``, found in one pass with the step on ``train`` that gives the next state."""

        def scored(pairs, state):
            return with_logits(pairs, state, self.dim).select(sigmoid("logit").alias("score"))

        cuts = tiles.edges(self.some, self.ranges, state, scored)
        step = {"train": train, "learn": _learn, "move": adagrad(lr)} if train is not None else {}
        history = state.withColumn("acc", F.array("acc"))
        found = materialize(tiles.run_pass(history, self.dim, rows=self.pairs, score=_score, edges=cuts, **step), "state")
        loss = next((x[0] / x[1] for _, x in tiles.sums_of(found, "scored")), None)
        return as_state(found), {"loss": loss, "auroc": tiles.area(tiles.sums_of(found, "range"))}


def evaluate(pairs: DataFrame, state: DataFrame, dim: int) -> dict[str, float | None]:
    """Mean loss per row and AUROC of ``pairs``."""
    return Scoring(pairs, dim).run(state)[1]


@dataclass
class Fit:
    state: DataFrame
    log: list[tuple[int, str, float, float]]  # epoch, stage, loss, auroc

    def vectors(self, side: str, key: str) -> DataFrame:
        return self.state.where(F.col("side") == side).select(
            F.col("id").alias(key), F.col("v").alias("embedding")
        )

    def log_table(self, spark: SparkSession) -> DataFrame:
        return spark.createDataFrame(
            self.log, "epoch int, stage string, loss double, auroc double"
        )


def fit(
    train: DataFrame,
    dim: int = 8,
    epochs: int = 3,
    lr: float = 0.1,
    seed: int = 42,
    scale: float = 1.0,
    validation: DataFrame | None = None,
    test: DataFrame | None = None,
) -> Fit:
    """Iterate ``epoch``; each epoch's vectors are a written table, so lineage stays short. A pass over
    the pairs takes an epoch's step and scores the state before it.

    The log holds the state before training, after each epoch (on the validation rows, or
    the train rows and then named so) and once on the test rows.
    """
    train = materialize(train.select("user_id", "product_id", "label"), "train")
    rows, stage = (validation, "val") if validation is not None else (train, "train")
    state = materialize(initial_state(train, dim, seed, scale), "state")
    log, scoring = [], Scoring(rows, dim)
    for n in range(epochs + 1):
        last = n == epochs
        after, found = scoring.run(state, None if last else train, lr)
        log.append((n, stage, found["loss"], found["auroc"]))
        state = state if last else after
    if test is not None:
        found = evaluate(test, state, dim)
        log.append((epochs, "test", found["loss"], found["auroc"]))
    return Fit(state, log)


def draw_trials(n: int, seed: int, dims: list[int], lr_range: tuple[float, float]) -> list[dict]:
    """Trial settings: a choice of dimension and a log-uniform learning rate."""
    import hashlib

    def uniform(*parts):
        text = "|".join(str(p) for p in (seed, *parts))
        return int(hashlib.md5(text.encode()).hexdigest()[:8], 16) / 4294967296.0

    low, high = (math.log(x) for x in lr_range)
    return [
        {
            "trial": t,
            "dim": dims[int(uniform(t, "dim") * len(dims))],
            "lr": math.exp(low + uniform(t, "lr") * (high - low)),
        }
        for t in range(n)
    ]


def search(
    train: DataFrame, validation: DataFrame, test: DataFrame, trials: list[dict], epochs: int = 1
) -> DataFrame:
    """Train every trial, select on validation loss, and report test loss for the best only."""
    spark = train.sparkSession
    results, fits = [], {}
    for t in trials:
        fitted = fit(train, t["dim"], epochs, t["lr"], validation=validation)
        fits[t["trial"]] = fitted
        results.append((t["trial"], t["dim"], t["lr"], fitted.log[-1][2]))
    best = min(results, key=lambda r: r[3])
    test_loss = evaluate(test, fits[best[0]].state, best[1])["loss"]
    rows = [(*r, r[0] == best[0], test_loss if r[0] == best[0] else None) for r in results]
    return spark.createDataFrame(
        rows, "trial int, dim int, lr double, val_loss double, best boolean, test_loss double"
    )


def als_factors(pairs: DataFrame, rank: int = 8, iterations: int = 3, seed: int = 42):
    """Implicit-feedback alternating least squares: (side, id, embedding)."""
    from pyspark.ml.recommendation import ALS

    # the library takes ids within an int, so it gets dense positions of any ids
    sides = {"user": "user_id", "item": "product_id"}
    index = {
        c: materialize(dense_index(pairs.select(c).distinct(), [c], f"_{c}"), "als-ids")
        for c in sides.values()
    }
    indexed = pairs.join(index["user_id"], "user_id").join(index["product_id"], "product_id")
    model = ALS(
        rank=rank, maxIter=iterations, implicitPrefs=True, seed=seed,
        userCol="_user_id", itemCol="_product_id", ratingCol="label",
    ).fit(indexed.select(*[F.col(f"_{c}").cast("int") for c in sides.values()],
                         F.col("label").cast("float")))
    found = {"user": model.userFactors, "item": model.itemFactors}
    user, item = (
        found[side].join(index[c], F.col("id") == F.col(f"_{c}")).select(
            F.lit(side).alias("side"), F.col(c).alias("id"), F.col("features").alias("embedding")
        )
        for side, c in sides.items()
    )
    return user.unionByName(item)
