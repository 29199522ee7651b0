import pytest
from pyspark.sql import functions as F

from affinity.operators import checks, sampling
from affinity.plans import stand_ins as S


def owned(spark, spec):
    rows = [(u, i, 1) for u, items in spec.items() for i in items]
    return spark.createDataFrame(rows, "user_id bigint, product_id bigint, label int")


def items(spark, n):
    return spark.range(n).withColumnRenamed("id", "product_id")


def by_user(df):
    out = {}
    for r in df.collect():
        out.setdefault(r.user_id, []).append(r.product_id)
    return out


def test_negatives_are_unseen_distinct_and_as_many(spark):
    spec = {1: [0], 2: [0, 1, 2], 3: [3, 5]}
    got = by_user(sampling.negative_samples(owned(spark, spec), items(spark, 6)))
    for user, mine in spec.items():
        assert len(got[user]) == len(set(got[user])) == len(mine)
        assert not set(got[user]) & set(mine)
    assert sorted(got[2]) == [3, 4, 5]  # exactly half: all that is left


def test_more_than_half_raises_or_clamps(spark):
    pos = owned(spark, {1: [0, 1, 2, 3], 2: [0], 3: list(range(6))})
    with pytest.raises(Exception, match="too few unseen items"):
        sampling.negative_samples(pos, items(spark, 6)).collect()
    got = by_user(sampling.negative_samples(pos, items(spark, 6), clamp=True))
    assert sorted(got[1]) == [4, 5] and len(got[2]) == 1 and 3 not in got


def test_draws_in_slots_give_the_same_negatives(spark, sf):
    pos = S.positives(spark, sf)
    shelf = pos.select("product_id").distinct()
    whole = sampling.negative_samples(pos, shelf)
    slots = sampling.negative_samples(pos.repartition(3), shelf, draws_per_task=7)
    assert whole.exceptAll(slots).isEmpty() and slots.exceptAll(whole).isEmpty()


def test_bucket_exclusion(spark):
    pos = owned(spark, {u: [u % 5] for u in range(40)})
    got = sampling.negative_samples(pos, items(spark, 50), exclude="bucket", buckets=1)
    assert got.count() == 40
    assert got.where("product_id < 5").isEmpty()


def test_several_per_positive(spark):
    got = by_user(
        sampling.negative_samples(owned(spark, {1: [0, 1]}), items(spark, 10), per_positive=3)
    )
    assert len(set(got[1])) == 6 and not set(got[1]) & {0, 1}


def test_negatives_are_spread_evenly(spark):
    pos = owned(spark, {u: [0, 1, 2, 3, 4] for u in range(2000)})
    counts = [
        r["count"]
        for r in sampling.negative_samples(pos, items(spark, 25)).groupBy("product_id").count()
        .collect()
    ]
    assert len(counts) == 20  # 10000 draws over 20 items, 500 each
    assert min(counts) > 380 and max(counts) < 620


@pytest.mark.parametrize(
    "n, want", [(1, (1, 0, 0)), (2, (1, 0, 1)), (4, (3, 0, 1)), (6, (4, 1, 1)), (10, (7, 1, 2))]
)
def test_split_rule(spark, n, want):
    split = sampling.split_per_user(owned(spark, {9: list(range(n))}))
    got = {r.group: r["count"] for r in split.groupBy("group").count().collect()}
    assert tuple(got.get(g, 0) for g in ("train", "val", "test")) == want


def test_split_does_not_depend_on_partitioning_or_salting(spark, sf):
    pos = S.positives(spark, sf)
    plain = sampling.split_per_user(pos)
    salted = sampling.split_per_user(pos.repartition(13), rows_per_task=10, max_hot=500)
    assert plain.exceptAll(salted).isEmpty() and salted.count() == pos.count()
    checks.require_train_rows(plain)


def test_split_by_label_keeps_positives_in_train(spark):
    both = owned(spark, {1: range(5)}).union(
        owned(spark, {1: range(5, 10)}).withColumn("label", F.lit(0))
    )
    split = sampling.split_per_user(both, by=["label"])
    assert split.where("`group` = 'train'").select("label").distinct().count() == 2


def test_checks_raise(spark):
    bad = spark.createDataFrame([(1, "val")], "user_id int, `group` string")
    with pytest.raises(ValueError, match="no row to train on"):
        checks.require_train_rows(bad)
    ids = spark.createDataFrame([(0,), (3,)], "id int")
    checks.require_ids_within(ids, "id", 4)
    with pytest.raises(ValueError):
        checks.require_ids_within(ids, "id", 3)
    a = spark.createDataFrame([([1.0, 2.0],)], "v array<double>")
    b = spark.createDataFrame([([1.0],)], "v array<double>")
    checks.require_equal_widths(a, a, "v")
    with pytest.raises(ValueError):
        checks.require_equal_widths(a, b, "v")


def test_holdout_and_temporal(spark):
    rows = spark.range(10).select(F.col("id").alias("k"))
    split = sampling.split_holdout(rows, ["k"], 0.3)
    assert sorted(r.k for r in split.where("`group` = 'valid'").collect()) == [7, 8, 9]
    orders = spark.createDataFrame(
        [(1, 1, "a"), (1, 2, "b"), (1, 3, "b"), (2, 4, "a")],
        "user_id int, order_id int, order_ts string",
    )
    last = sampling.split_temporal(orders).where("`group` = 'test'").collect()
    assert sorted(r.order_id for r in last) == [3, 4]


def test_shuffle_keeps_rows_and_mixes_them(spark):
    rows = spark.range(1000)
    mixed = [r.id for r in sampling.shuffle_rows(rows, ["id"], partitions=4).collect()]
    assert sorted(mixed) == list(range(1000)) and mixed != list(range(1000))


def test_draws_in_tasks_and_in_blocks_are_the_same(spark, sf, monkeypatch):
    """Users of all sizes: a task's numpy draws, with the catalogue held or joined, are those of Spark's blocks."""
    pos = S.positives(spark, sf).cache()
    odd = spark.createDataFrame([(-5, 10**6, 1), (-5, 3, 1), (None, 4, 1)], "user_id bigint, product_id bigint, label int")
    pos = pos.unionByName(odd)
    shelf = pos.where("product_id < 1000").select("product_id").distinct()
    for options in ({}, {"per_positive": 3, "clamp": True}):
        blocks = sampling.negative_samples(pos, shelf, draws_per_task=7, **options)
        tasks = sampling.negative_samples(pos, shelf, **options)
        assert "MapInArrow" in tasks._jdf.queryExecution().executedPlan().toString()
        assert tasks.exceptAll(blocks).isEmpty() and blocks.exceptAll(tasks).isEmpty()
        monkeypatch.setattr(sampling, "SHELF_BYTES", 0)
        joined = sampling.negative_samples(pos, shelf, **options)
        monkeypatch.undo()
        assert tasks.exceptAll(joined).isEmpty() and joined.count() == tasks.count()


def test_split_hashes_after_the_shuffle(spark, sf):
    pos = S.positives(spark, sf)
    plan = sampling.split_per_user(pos)._jdf.queryExecution().optimizedPlan().toString()
    assert plan.index("md5") < plan.index("RepartitionByExpression")
