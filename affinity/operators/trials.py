"""Trials of factor training side by side, with successive halving.

The vectors that an id has in all trials stand end to end in one array, so one pass over the tiles (``operators.tiles``) brings what every
trial needs and one job takes an epoch of all of them: its gradients are sums by id of such arrays. After each
rung the trials with the higher validation losses are dropped, and their parts of the arrays with them.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from affinity.operators import factors, tiles
from affinity.session import materialize

RESULT = "trial int, dim int, lr double, rung int, epochs int, val_loss double, kept boolean, best boolean, test_loss double"


def _cuts(trials: list[dict]) -> list[slice]:
    ends = np.cumsum([t["dim"] for t in trials])
    return [slice(int(e - t["dim"]), int(e)) for t, e in zip(trials, ends)]


def initial_state(pairs: DataFrame, trials: list[dict], seed: int, scale: float = 1.0) -> DataFrame:
    """(side, id, v, acc): each trial's vector starts with the elements that ``factors.initial_state`` gives."""
    widest = max(t["dim"] for t in trials)
    one = factors.initial_state(pairs, widest, seed, scale)
    v = F.concat(*[F.slice("v", 1, t["dim"]) for t in trials])
    return one.select("side", "id", v.alias("v"), F.array(*[F.lit(0.0)] * len(trials)).alias("acc"))


def _logits(u, w, cuts: list[slice]) -> np.ndarray:
    return np.stack([(u[:, c] * w[:, c]).sum(1) for c in cuts], axis=1)


def epoch(pairs: DataFrame, state: DataFrame, trials: list[dict]) -> DataFrame:
    """``factors.epoch`` of every trial, in one job."""
    cuts, width = _cuts(trials), sum(t["dim"] for t in trials)
    lr = np.array([t["lr"] for t in trials])
    trial = np.repeat(np.arange(len(trials)), [t["dim"] for t in trials])

    def learn(u, w, label):
        error = (factors.probability(_logits(u, w, cuts)) - label[:, None])[:, trial]
        return error * w, error * u, np.zeros(1)

    def move(v, g, acc):
        acc = acc + np.stack([(g[:, c] ** 2).mean(1) for c in cuts], axis=1)
        return v - (lr / (np.sqrt(acc) + factors.EPSILON))[:, trial] * g, acc

    return tiles.vectors_of(tiles.run_pass(state, width, train=pairs, learn=learn, move=move))


def losses(pairs: DataFrame, state: DataFrame, trials: list[dict]) -> list[float]:
    """The mean loss of each trial over the pairs whose ids are known."""
    cuts = _cuts(trials)

    def score(u, w, label):
        logit = _logits(u, w, cuts)
        loss = np.maximum(logit, 0) - logit * label[:, None] + np.log1p(np.exp(-np.abs(logit)))
        return None, np.append(loss.sum(0), len(logit))

    found = materialize(tiles.run_pass(state, sum(t["dim"] for t in trials), rows=pairs, score=score), "losses")
    sums = tiles.sums_of(found, "scored")
    return [x / sums[0][1][-1] for x in sums[0][1][:-1]] if sums else [float("nan")] * len(trials)


def keep(state: DataFrame, trials: list[dict], kept: list[int]) -> DataFrame:
    """The state with only some trials' parts."""
    cuts = _cuts(trials)
    v = F.concat(*[F.slice("v", cuts[k].start + 1, trials[k]["dim"]) for k in kept])
    return state.select("side", "id", v.alias("v"), F.array(*[F.col("acc")[k] for k in kept]).alias("acc"))


def search(
    train: DataFrame, validation: DataFrame, test: DataFrame, trials: list[dict], epochs: int = 1, keep_share: float = 0.5,
    seed: int = 42, scale: float = 1.0,
) -> DataFrame:
    """Train all trials ``epochs`` at a time, drop those with the higher validation losses, until one is left.

    A row for each trial and rung: its validation loss then, and whether it goes on; the last one is the best
    and has the test loss, computed once. Equal losses go to the trial named first.
    """
    spark = train.sparkSession
    train = materialize(train.select("user_id", "product_id", "label"), "train")
    validation = materialize(validation.select("user_id", "product_id", "label"), "validation")
    live, rows, rung = list(trials), [], 0
    state = materialize(initial_state(train, live, seed, scale), "trials")
    while True:
        rung += 1
        for _ in range(epochs):
            state = materialize(epoch(train, state, live), "trials")
        found = losses(validation, state, live)
        order = sorted(range(len(live)), key=lambda k: (found[k], k))
        going = 1 if len(live) == 1 else max(1, int(len(live) * keep_share))
        kept, last = sorted(order[:going]), len(live) == 1
        test_loss = losses(test, state, live)[0] if last else None
        for k, t in enumerate(live):
            rows.append((t["trial"], t["dim"], t["lr"], rung, rung * epochs, found[k], k in kept, last, test_loss))
        if last:
            return spark.createDataFrame(rows, RESULT)
        state, live = materialize(keep(state, live, kept), "trials"), [live[k] for k in kept]
