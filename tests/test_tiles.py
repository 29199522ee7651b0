import numpy as np
import pytest
from pyspark.sql import functions as F

from affinity.operators import factors, tiles, tower_training, trials
from affinity.session import materialize


def some_pairs(spark, n=3000):
    rng = np.random.default_rng(5)
    user, item = rng.integers(-40, 40, n) * 10**12, (rng.random(n) ** 3 * 90).astype(int)
    rows = [(int(u), int(i), int(y)) for u, i, y in zip(user, item, rng.integers(0, 2, n))]
    return materialize(spark.createDataFrame(rows, "user_id long, product_id int, label int"), "pairs")


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_pairs_carry_no_vectors(spark):
    pairs = some_pairs(spark)
    state = materialize(factors.initial_state(pairs, 4, 1), "s")
    drawn = [{"trial": 0, "dim": 4, "lr": 0.1}]
    for stepped in (
        factors.epoch(pairs, state, 4, 0.1),
        trials.epoch(pairs, trials.initial_state(pairs, drawn, 1), drawn),
    ):
        assert "Join" not in plan(stepped)


def test_a_vector_is_sent_once_for_a_tile(spark):
    pairs = some_pairs(spark)
    state = factors.initial_state(pairs, 4, 1).withColumn("acc", F.array("acc"))
    sent = tiles._vector_blocks(state, (3, 5), None).select((F.length("ids") / 8).alias("n"), "kind")
    got = {r["kind"]: r["n"] for r in sent.groupBy("kind").agg(F.sum("n").alias("n")).collect()}
    ids = {r["side"]: r["count"] for r in state.groupBy("side").count().collect()}
    assert got == {0: 5 * ids["user"], 1: 3 * ids["item"]}


@pytest.mark.parametrize("scale", [1.0, 0.0])  # without a scale all scores are equal
def test_a_pass_learns_and_scores(spark, monkeypatch, scale):
    monkeypatch.setattr(tiles, "CHUNK", 700)
    train, other = some_pairs(spark), some_pairs(spark, 500).unionByName(
        spark.createDataFrame([(10**15, 3, 1), (None, 3, 1), (0, 3, None)], "user_id long, product_id int, label int")
    )
    state = materialize(factors.initial_state(train, 4, 1, scale), "s")
    v = {(r["side"], r["id"]): np.array(r["v"]) for r in state.collect()}
    g = {k: np.zeros(4) for k in v}
    for r in train.collect():
        u, w = v["user", r["user_id"]], v["item", r["product_id"]]
        e = 1 / (1 + np.exp(-u @ w)) - r["label"]
        g["user", r["user_id"]] += e * w
        g["item", r["product_id"]] += e * u
    after, found = factors.Scoring(other, 4).run(state, train, 0.1)
    got = {(r["side"], r["id"]): r for r in after.collect()}
    assert set(got) == set(v)
    for k, r in got.items():
        acc = (g[k] ** 2).mean()
        assert np.allclose(r["v"], v[k] - 0.1 / (np.sqrt(acc) + 1e-8) * g[k]) and r["acc"] == pytest.approx(acc)
    known = [r for r in other.collect() if r["label"] is not None and ("user", r["user_id"]) in v and ("item", r["product_id"]) in v]
    x = np.array([v["user", r["user_id"]] @ v["item", r["product_id"]] for r in known])
    y = np.array([r["label"] for r in known])
    p = 1 / (1 + np.exp(-x))
    order = (p[y == 1][:, None] > p[y == 0]).mean() + (p[y == 1][:, None] == p[y == 0]).mean() / 2
    assert found["auroc"] == pytest.approx(order) and found["loss"] == pytest.approx(-np.log(np.where(y == 1, p, 1 - p)).mean())


def test_no_known_pair(spark):
    state = materialize(factors.initial_state(some_pairs(spark), 4, 1), "s")
    none = spark.createDataFrame([(1, 1, 1)], "user_id long, product_id int, label int")
    assert factors.evaluate(none, state, 4) == {"loss": None, "auroc": None}
    _, net, loss = tower_training.step(none, state, tower_training.initial_net(4, [2], 1), 4, 0.1, 0.1)
    assert loss == 0.0 and net.steps == 1
