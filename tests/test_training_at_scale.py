from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from affinity.operators import batch_negatives as bn
from affinity.operators import factors, partials, skew, towers
from affinity.operators import tower_training as tt
from affinity.plans import stand_ins as S
from affinity.session import materialize


def small_net(seed=3, dim=4, widths=(5, 3)):
    return tt.initial_net(dim, list(widths), seed, 2.0)


def test_gradients_equal_differences():
    rng = np.random.default_rng(1)
    net, user, item = small_net(), rng.normal(size=(30, 4)), rng.normal(size=(30, 4))
    label = rng.integers(0, 2, 30).astype(float)
    loss, gu, gi, flat = tt.pair_gradients(user, item, label, net, 30)
    at = lambda u=user, i=item, w=None: tt.pair_gradients(
        u, i, label, net if w is None else tt.Net(net.unflat(w)), 30)[0]
    h = 1e-6
    for k in range(0, len(flat), 7):
        d = np.zeros(len(flat))
        d[k] = h
        assert abs((at(w=net.flat() + d) - at(w=net.flat() - d)) / (2 * h) - flat[k]) < 1e-7
    for g, x, name in ((gu, user, "u"), (gi, item, "i")):
        for r, c in ((0, 0), (7, 2), (29, 3)):
            d = np.zeros_like(x)
            d[r, c] = h
            assert abs((at(**{name: x + d}) - at(**{name: x - d})) / (2 * h) - g[r, c]) < 1e-7


def test_partial_sums_meet_across_batches():
    rng = np.random.default_rng(2)
    rows = sorted((side, int(i)) for side, n in (("item", 3), ("layers", 2), ("user", 4)) for i in rng.integers(0, n, 20))
    g, want = rng.normal(size=(len(rows), 2)), {}
    for (side, i), x in zip(rows, g):
        want[side, i] = want.get((side, i), 0) + x
    batches = [
        pa.RecordBatch.from_arrays(
            [pa.array([r[0] for r in rows[a : a + n]]), pa.array([r[1] for r in rows[a : a + n]], pa.int64()), partials.as_lists(g[a : a + n]), pa.array(np.ones(len(rows[a : a + n])))],
            names=["side", "id", "g", "loss"],
        )
        for n in (1, 3, 60) for a in range(0, len(rows), n)
    ]
    for n, count in ((1, len(rows)), (3, -(-len(rows) // 3)), (60, 1)):
        some, batches = batches[:count], batches[count:]
        got = [r for b in partials.add_up(iter(some)) for r in b.to_pylist()]
        assert [(r["side"], r["id"]) for r in got] == sorted(want)
        for r in got:
            assert np.allclose(r["g"], want[r["side"], r["id"]])
        assert sum(r["loss"] for r in got) == len(rows)


def test_net_survives_its_table(spark):
    net = small_net().adam(np.linspace(-1, 1, len(small_net().flat())), 0.1)
    again = tt.read_net(materialize(net.table(spark).repartition(3), "net"))
    assert again.steps == 1
    for a, b in ((net.flat(), again.flat()), (net.m, again.m), (net.v, again.v)):
        assert np.array_equal(a, b)


def test_steps_are_the_same_for_any_partitions(spark):
    rng = np.random.default_rng(4)
    rows = {(int(u), int(i)) for u, i in zip(rng.integers(0, 20, 200), rng.integers(0, 9, 200))}
    pairs = spark.createDataFrame([(u, i if u % 3 else 1, int((u + i) % 2)) for u, i in rows], "user_id bigint, product_id bigint, label int")
    state = materialize(factors.initial_state(pairs, 4, 1, 2.0), "s")
    found = []
    for frame in (pairs.coalesce(1), pairs.repartition(7)):
        new, net, loss = tt.step(frame, state, small_net(), 4, 0.1, 0.1)
        vectors = {(r["side"], r["id"]): r["v"] for r in new.collect()}
        found.append((vectors, net.flat(), loss))
    assert found[0][0].keys() == found[1][0].keys()
    assert all(np.allclose(found[0][0][k], found[1][0][k]) for k in found[0][0])
    assert np.allclose(found[0][1], found[1][1]) and found[0][2] == pytest.approx(found[1][2])
    assert tt.step(pairs.limit(0), state, small_net(), 4, 0.1, 0.1)[0].count() == state.count()


def test_training_lowers_the_loss(spark):
    rows = [(u, i, int((u % 3) == (i % 3))) for u in range(24) for i in range(18)]
    pairs = spark.createDataFrame(rows, "user_id bigint, product_id bigint, label int")
    fitted = tt.fit(pairs, dim=8, widths=(16, 8), epochs=3, lr=0.02, vector_lr=0.1, scale=2.0, batches=2)
    losses = [r[2] for r in fitted.log]
    assert losses[3] < losses[2] < losses[1] < losses[0] / 2 and fitted.net.steps == 6


def test_lookup_of_hot_and_unknown_keys(spark):
    rows = spark.range(9000).select(
        "id", F.when(F.col("id") % 3 == 0, 7).when(F.col("id") % 50 == 1, None).otherwise(F.col("id") % 400 + 100).cast("bigint").alias("k")
    )
    table = spark.createDataFrame([(k, [float(k)]) for k in (7, *range(100, 480))], "k bigint, v array<double>")
    for limit in (64, 2000, 1 << 20):
        left = skew.lookup(rows, table, "k", "left", row_bytes=64, limit=limit)
        assert left.columns == ["id", "k", "v"] and left.count() == 9000 and left.select("id").distinct().count() == 9000
        assert left.where("v is not null and v[0] <> k").isEmpty()
        assert left.where("v is null").count() == rows.where("k is null or k >= 480").count()
        assert skew.lookup(rows, table, "k", row_bytes=64, limit=limit).count() == left.where("v is not null").count()
    hot = skew.hot_keys(rows, "k", 20)
    assert [r["k"] for r in hot.collect()] == [7]
    cold = rows.join(hot, "k", "left_anti").groupBy("k").count().agg(F.max("count")).first()[0]
    assert cold <= 9000 / 20


def test_rows_of_a_hot_key_are_not_shuffled(spark):
    rows = materialize(spark.range(60_000).select("id", F.when(F.col("id") % 3 == 0, 7).otherwise(F.col("id")).alias("k")), "rows")
    table = materialize(spark.range(60_000).select(F.col("id").alias("k"), F.lit(1).alias("v")), "table")
    settings = {"spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.adaptive.coalescePartitions.enabled": "false"}
    before = {k: spark.conf.get(k) for k in settings}
    try:
        for k, v in settings.items():
            spark.conf.set(k, v)
        joined = skew.lookup(rows, table, "k", limit=64 * 1024)
        assert joined.where("k = 7").count() == 20_001
        share = joined.groupBy(F.spark_partition_id()).count().agg(F.max("count")).first()[0]
        assert share < 60_000 / 3
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)


def test_nth_free_position():
    for banned in ([], [0], [9], [0, 1, 2], [1, 3, 4, 8], list(range(9))):
        free = [i for i in range(10) if i not in banned]
        assert bn.nth_free(np.arange(len(free)), np.array(banned, dtype=np.int64)).tolist() == free


def test_batch_negatives_avoid_the_positives_of_their_batch(spark):
    rng = np.random.default_rng(5)
    rows = sorted({(int(u), int(i)) for u, i in zip(rng.integers(0, 300, 4000), rng.integers(0, 900, 4000))})
    pairs = spark.createDataFrame(rows, "user_id bigint, product_id bigint")
    catalogue = spark.range(1000).select(F.col("id").alias("product_id"))
    got = bn.batch_negatives(pairs, catalogue, 3, batch_rows=300).collect()
    assert Counter((r["user_id"], r["product_id"]) for r in got) == Counter({p: 3 for p in rows})
    banned = {}
    for r in got:
        banned.setdefault(r["batch"], set()).add(r["product_id"])
    assert len(banned) == -(-len(rows) // 300) and max(map(len, banned.values())) <= 400
    assert all(r["negative"] not in banned[r["batch"]] for r in got)
    again = bn.batch_negatives(pairs.repartition(5), catalogue, 3, batch_rows=300).collect()
    assert sorted(map(tuple, got)) == sorted(map(tuple, again))


def test_batch_negatives_are_uniform(spark):
    pairs = spark.range(20_000).select(F.col("id").alias("user_id"), (F.col("id") % 5).alias("product_id"))
    catalogue = spark.range(25).select(F.col("id").alias("product_id"))
    counts = bn.batch_negatives(pairs, catalogue, 2, batch_rows=1000).groupBy("negative").count().collect()
    assert sorted(r["negative"] for r in counts) == list(range(5, 25))
    expected = 40_000 / 20
    assert sum((r["count"] - expected) ** 2 / expected for r in counts) < 43.8  # 0.1 % point, 19 degrees of freedom


def test_batch_negatives_without_choice(spark):
    pairs = spark.createDataFrame([(1, 0), (2, 1), (3, 77)], "user_id bigint, product_id bigint")
    catalogue = spark.createDataFrame([(0,), (1,)], "product_id bigint")
    with pytest.raises(Exception, match="has all 2 items"):
        bn.batch_negatives(pairs, catalogue).collect()
    got = bn.batch_negatives(pairs.where("user_id <> 2"), catalogue).collect()
    assert {r["negative"] for r in got} == {1}  # an item outside the catalogue bans nothing
    assert bn.batch_negatives(pairs.limit(0), catalogue).count() == 0


def test_the_clamp_bites(spark, sf):
    import __spark_entry__ as entry

    got = entry.queries()["negatives_clamped"](spark, sf).groupBy("user_id").count()
    sizes = S.products(spark, sf).select("product_id", "size")
    bought = S.detail(spark, sf).select("user_id", "product_id").join(sizes, "product_id")
    owned = bought.groupBy("user_id").agg(F.count_distinct("size").alias("owned"))
    both = owned.join(got, "user_id", "left").fillna(0)
    assert not both.where("count < 3 * owned").isEmpty()


def test_rows_with_unknown_ids_come_back(spark):
    rows = spark.createDataFrame([(1, 1), (1, 2)], "user_id bigint, product_id bigint")
    items = spark.createDataFrame([(1, [1.0])], "product_id bigint, embedding array<double>")
    got = skew.lookup(rows, items, "product_id", "left").collect()
    assert {(r["product_id"], tuple(r["embedding"] or ())) for r in got} == {(1, (1.0,)), (2, ())}
    users = spark.createDataFrame([(1, [2.0])], "user_id bigint, embedding array<double>")
    scored = towers.score_pairs(rows, users, items, how="left").collect()
    assert {(r["product_id"], r["logit"], r["predicted_classes"]) for r in scored} == {(1, 2.0, 1), (2, None, None)}
    assert towers.score_pairs(rows, users, items).count() == 1
