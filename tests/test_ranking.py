from pyspark.sql import Window
from pyspark.sql import functions as F

from affinity.functions.hashing import TWO_32, hex_u32, md5_hex
from affinity.operators import interactions
from affinity.operators.ranking import dense_index, hot_groups, number_in_groups, running_sums


def skewed(spark, n=3000):
    user = F.when(F.col("id") < n // 3, 0).otherwise(F.col("id") % 50)
    return spark.range(n).select(user.alias("u"), F.col("id").alias("i")).withColumn(
        "h", md5_hex(1, "u", "i")
    )


def test_hot_group_numbers_equal_a_plain_window(spark):
    df = skewed(spark)
    got = number_in_groups(
        df, ["u"], hex_u32(F.col("h")) / F.lit(TWO_32), ["h", "i"], "rn", "total",
        rows_per_task=100, max_hot=20,
    )
    w = Window.partitionBy("u")
    want = df.withColumn("rn", F.row_number().over(w.orderBy("h", "i")).cast("bigint"))
    want = want.withColumn("total", F.count("*").over(w))
    cols = ["u", "i", "rn", "total"]
    assert got.select(cols).exceptAll(want.select(cols)).isEmpty()
    assert got.count() == 3000


def test_hot_groups_are_bounded(spark):
    found = hot_groups(skewed(spark), ["u"], rows_per_task=1, max_hot=10).collect()
    assert [r.u for r in found] == [0]
    assert sum(r["_buckets"] for r in found) <= 20


def test_dense_index_is_a_bijection_in_order(spark):
    df = skewed(spark).repartition(7)
    rows = dense_index(df, [F.desc("u"), "i"], "ix").orderBy("ix").collect()
    assert [r.ix for r in rows] == list(range(3000))
    assert [(r.u, r.i) for r in rows] == sorted(
        [(r.u, r.i) for r in rows], key=lambda t: (-t[0], t[1])
    )


def test_running_sums(spark):
    df = spark.range(500).select("id", (F.col("id") % 7).alias("v"))
    rows = running_sums(df.repartition(5), ["id"], {"v": "before"}).orderBy("id").collect()
    total = 0
    for r in rows:
        assert r.before == total
        total += r.v


def test_item_sets_of_a_hot_user_stay_whole_in_parts(spark):
    pairs = skewed(spark).select(F.col("u").alias("user_id"), F.col("i").alias("product_id"))
    sets = interactions.item_sets(pairs, rows_per_task=200)
    parts = sets.where("user_id = 0").collect()
    assert len(parts) > 1
    items = [p for r in parts for p in r.products]
    want = [r.product_id for r in pairs.where("user_id = 0").collect()]
    assert sorted(items) == sorted(want)
    assert all(r.n_items == len(r.products) for r in parts)


def test_parts_of_a_set_depend_on_its_group_alone(spark):
    pairs = spark.range(900).select((F.col("id") % 3).alias("user_id"), F.col("id").alias("product_id"))
    more = pairs.union(spark.range(5000, 90_000).select(F.lit(9).cast("bigint"), "id"))
    alone, among = (interactions.item_sets(p, rows_per_task=100).where("user_id < 3") for p in (pairs, more))
    assert sorted(map(tuple, alone.collect())) == sorted(map(tuple, among.collect()))
    assert alone.groupBy("user_id").count().where("count <> 3").isEmpty()
