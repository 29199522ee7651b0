import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from affinity.operators import checks, factors, features, retrieval, softmax_trees, trees, trials
from affinity.sources import shards, versions

PAIRS = "user_id bigint, product_id bigint, label int"


# ---- trials -------------------------------------------------------------------------------


@pytest.fixture(scope="module")
def pairs(spark):
    rows = [(u, i, int((u * 7 + i * 3) % 5 < 2)) for u in range(25) for i in range(20) if (u + i) % 4]
    part = lambda k: spark.createDataFrame([r for n, r in enumerate(rows) if n % 5 in k], PAIRS)
    return part({0, 1, 2}), part({3}), part({4})


def test_trials_equal_single_fits(spark, pairs):
    train, validation, test = pairs
    drawn = [{"trial": 7, "dim": 2, "lr": 0.1}, {"trial": 3, "dim": 4, "lr": 0.5}, {"trial": 5, "dim": 3, "lr": 0.02}]
    state = trials.initial_state(train, drawn, 42)
    for _ in range(2):
        state = trials.epoch(train, state, drawn)
    together = trials.losses(validation, state, drawn)
    for t, loss in zip(drawn, together):
        alone = factors.fit(train, t["dim"], 2, t["lr"], validation=validation)
        assert loss == pytest.approx(alone.log[-1][2], abs=1e-9)
    kept = trials.keep(state, drawn, [0, 2])
    assert trials.losses(validation, kept, [drawn[0], drawn[2]]) == pytest.approx([together[0], together[2]])


def test_halving_drops_the_worse_half(spark, pairs):
    drawn = [{"trial": t, "dim": 2, "lr": lr} for t, lr in enumerate((0.01, 0.3, 0.1, 0.05, 0.2))]
    rows = trials.search(*pairs, drawn, epochs=1).collect()
    by_rung = [[r for r in rows if r["rung"] == n] for n in (1, 2, 3)]
    assert [len(r) for r in by_rung] == [5, 2, 1] and len(rows) == 8
    for now, then in zip(by_rung, by_rung[1:]):
        on = [r["trial"] for r in now if r["kept"]]
        assert on == [r["trial"] for r in then]
        assert max(r["val_loss"] for r in now if r["kept"]) <= min(r["val_loss"] for r in now if not r["kept"])
    best = by_rung[2][0]
    assert best["best"] and best["test_loss"] > 0 and best["epochs"] == 3
    assert all(r["test_loss"] is None for r in rows if not r["best"])


# ---- softmax trees ------------------------------------------------------------------------


def brute_tree(x, g, h, cuts, depth, l2=1.0, least=1e-3):
    """A tree as nested (column, cut, left, right) or a leaf value, by trying every cut."""
    value = -g.sum() / (h.sum() + l2)
    best = (1e-9, None)
    if depth:
        for c in range(x.shape[1]):
            for cut in [-math.inf, *cuts[c]]:  # the lowest sends only missing values left
                left = np.isnan(x[:, c]) | (x[:, c] <= cut)
                gl, hl, gr, hr = g[left].sum(), h[left].sum(), g[~left].sum(), h[~left].sum()
                if hl >= least and hr >= least:
                    gain = round(gl**2 / (hl + l2) + gr**2 / (hr + l2) - g.sum() ** 2 / (h.sum() + l2), 9)
                    if gain > best[0]:
                        best = (gain, (c, cut, left))
    if best[1] is None:
        return value
    c, cut, left = best[1]
    return c, cut, brute_tree(x[left], g[left], h[left], cuts, depth - 1), brute_tree(x[~left], g[~left], h[~left], cuts, depth - 1)


def as_nested(tree, cuts, node=0):
    c = tree.column[node]
    if c < 0:
        return tree.value[node]
    cut = cuts[c][tree.bin[node]] if tree.bin[node] >= 0 else -math.inf
    return c, cut, as_nested(tree, cuts, 2 * node + 1), as_nested(tree, cuts, 2 * node + 2)


def close(a, b):
    if isinstance(a, tuple):
        return isinstance(b, tuple) and a[:2] == b[:2] and close(a[2], b[2]) and close(a[3], b[3])
    return not isinstance(b, tuple) and a == pytest.approx(b, abs=1e-9)


def table(spark, n=240, seed=1):
    rng = np.random.default_rng(seed)
    x = rng.normal(size=(n, 3)).round(2)
    x[rng.random(n) < 0.1, 1] = np.nan
    target = np.where(x[:, 0] > 0.4, 2, np.where(np.nan_to_num(x[:, 1], nan=-1) > 0, 1, 0))
    target = np.where(rng.random(n) < 0.1, rng.integers(0, 3, n), target)
    rows = [(int(i), float(a), None if math.isnan(b) else float(b), float(c), int(t)) for i, ((a, b, c), t) in enumerate(zip(x, target))]
    return x, target, spark.createDataFrame(rows, "id bigint, a double, b double, c double, target int")


def test_splits_equal_brute_force(spark):
    x, target, rows = table(spark)
    model = softmax_trees.fit(rows.repartition(5), ["a", "b", "c"], labels=3, max_depth=3, rounds=2, bins=6)
    cuts, scores = model.cuts, np.zeros((len(x), 3))
    bins = np.stack([np.where(np.isnan(x[:, j]), -1, np.searchsorted(cuts[j], x[:, j], side="left")) for j in range(3)], axis=1)
    for n in range(2):
        p = softmax_trees.softmax(scores)
        for k in range(3):
            want = brute_tree(x, p[:, k] - (target == k), p[:, k] * (1 - p[:, k]), cuts, 3)
            assert close(as_nested(model.rounds[n][k], cuts), want)
        scores = softmax_trees.SoftmaxTrees(model.features, cuts, model.rounds[: n + 1], 3, 0.3).scores(bins)


def test_probabilities_beat_one_tree_set_per_class(spark):
    x, target, rows = table(spark, 900, 2)
    _, truth, test = table(spark, 600, 3)
    model = softmax_trees.fit(rows, ["a", "b", "c"], labels=3, max_depth=3, rounds=8)
    got = sorted(model.predict(test.drop("target")).collect(), key=lambda r: r["id"])
    p = np.array([r["probabilities"] for r in got])
    assert np.allclose(p.sum(1), 1) and [r["prediction"] for r in got] == p.argmax(1).tolist()
    loss = -np.log(p[np.arange(len(truth)), truth]).mean()
    one_vs_rest = trees.boosted_trees(rows.fillna(-9, ["b"]), test.fillna(-9, ["b"]).drop("target"), ["a", "b", "c"], labels=3, max_depth=3, rounds=8)
    other = {r["id"]: r["prediction"] for r in one_vs_rest.collect()}
    right = np.mean([other[i] == t for i, t in enumerate(truth)])
    assert (p.argmax(1) == truth).mean() >= right - 0.01
    # the other form gives classes only: the best that a constant trust in them can reach
    hard = -(right * math.log(right) + (1 - right) * math.log((1 - right) / 2))
    assert loss < hard < math.log(3)


def test_targets_out_of_range_and_constant_columns(spark):
    rows = spark.createDataFrame([(1.0, 0), (1.0, 1), (1.0, None)], "a double, target int")
    model = softmax_trees.fit(rows, ["a"], labels=2, rounds=1)
    assert all(t.column[0] == -1 for t in model.rounds[0])  # nothing to split
    assert model.predict(rows.select("a")).where("probabilities[0] <> probabilities[1]").isEmpty()
    with pytest.raises(ValueError, match="not within"):
        softmax_trees.fit(rows, ["a"], labels=1)


# ---- shards -------------------------------------------------------------------------------

COLUMNS = {"k": "bigint", "name": "string", "x": "float", "v": "array<double>"}


@pytest.fixture
def written(spark, tmp_path):
    rows = spark.range(5000).select(
        F.col("id").cast("string").alias("k"), F.when(F.col("id") % 7 > 0, F.concat(F.lit("n"), "id")).alias("name"),
        (F.col("id") / 8).alias("x"), F.array(F.col("id"), F.lit(None)).alias("v"),
    )
    path = str(tmp_path / "shards")
    shards.write_shards(rows, path, COLUMNS, shards=3, rows_per_file=700, row_group_bytes=8 << 10)
    return path, rows


def test_any_range_is_read_through_the_index(spark, written):
    path, rows = written
    index = shards.read_index(spark, path).orderBy("first_row").collect()
    assert len(index) > 9 and sum(r["rows"] for r in index) == 5000
    assert [r["first_row"] for r in index] == np.cumsum([0] + [r["rows"] for r in index[:-1]]).tolist()
    assert all(r["offset"] < r["bytes"] for r in index)
    everything = shards.read_rows(spark, path).orderBy("position").collect()
    assert [r["position"] for r in everything] == list(range(5000))
    assert dict(shards.read_rows(spark, path).drop("position").dtypes) == COLUMNS
    want = {int(r["k"]): (r["name"], r["x"]) for r in rows.collect()}
    assert {r["k"]: (r["name"], r["x"]) for r in everything} == want
    for start, stop in ((0, 1), (699, 702), (1234, 3456), (4990, None), (10, 10), (6000, 7000)):
        got = shards.read_rows(spark, path, start, stop).orderBy("position").collect()
        assert got == everything[start:stop]


def test_damage_is_noticed(spark, written):
    path, _ = written
    assert shards.verify(spark, path).where("not intact").isEmpty()
    name = shards.read_index(spark, path).first()["file"]
    file = f"{path}/{versions.read_state(spark, path)['shards']}/{name}"
    with open(file, "r+b") as out:
        out.seek(100)
        out.write(b"\xff\x00")
    assert [r["file"] for r in shards.verify(spark, path).where("not intact").collect()] == [name]


def test_values_that_do_not_fit_are_an_error(spark, tmp_path):
    rows = spark.createDataFrame([("1",), ("one",), (None,)], "k string")
    with pytest.raises(ValueError, match="1 values don't fit"):
        shards.write_shards(rows, str(tmp_path / "s"), {"k": "int"}, 1)
    assert versions.versions(spark, str(tmp_path / "s")) == []
    shards.write_shards(rows.where("k is null or k = '1'"), str(tmp_path / "s"), {"k": "int"}, 1)
    assert sorted(r["k"] or 0 for r in shards.read_rows(spark, str(tmp_path / "s")).collect()) == [0, 1]


def test_a_write_that_fails_leaves_the_old_shards(spark, written, monkeypatch):
    path, rows = written
    with monkeypatch.context() as m:
        m.setattr(versions, "publish", lambda *a: (_ for _ in ()).throw(OSError("lost")))
        with pytest.raises(OSError):
            shards.write_shards(rows.limit(5), path, COLUMNS, 1)
    assert shards.read_rows(spark, path).count() == 5000
    shards.write_shards(rows.limit(5), path, COLUMNS, 1)
    assert shards.read_rows(spark, path).count() == 5 and shards.read_rows(spark, path, version=1).count() == 5000


# ---- small ones ---------------------------------------------------------------------------


def test_equal_vectors_score_by_their_metric(spark):
    items = spark.createDataFrame([(1, [3.0, 4.0]), (2, [3.0, 4.0]), (3, [4.0, 3.0])], "item_id bigint, embedding array<double>")
    for metric, threshold, own, other in (("dot", 1.0, 25.0, 24.0), ("l2", -9.0, 0.0, -math.sqrt(2)), ("cosine", 0.1, 1.0, 0.96)):
        found = retrieval.similar_pairs(items, threshold, metric)
        pairs = retrieval.expand_pairs(found, retrieval.vector_members(items, metric), metric=metric, items=items)
        got = {(r[0], r[1]): r[2] for r in pairs.collect()}
        assert len(got) == 6 and got[1, 2] == own and got[2, 3] == pytest.approx(other)


def test_array_lengths(spark):
    rows = spark.createDataFrame([(1, [1], [2]), (2, [1, 2], [3]), (3, None, [1])], "b int, x array<int>, y array<int>")
    assert [r["agree"] for r in checks.array_lengths(rows, ["x", "y"]).orderBy("b").collect()] == [True, False, False]
    with pytest.raises(ValueError, match="2 rows have x, y of different lengths"):
        checks.require_equal_lengths(rows, ["x", "y"])
    assert checks.require_equal_lengths(rows.where("b = 1"), ["x", "y"]).count() == 1


def test_first_batches(spark):
    rows = spark.range(100).select(F.floor(F.col("id") / 10).alias("batch"), "id")
    assert [r["id"] for r in features.first_batches(rows, 2).orderBy("id").collect()] == list(range(20))
