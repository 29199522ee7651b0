"""Inputs that used to lose rows or change results without an error."""

import math

import numpy as np
import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from affinity.operators import checks, factors, features, metrics, retrieval, sampling
from affinity.streaming import incremental

VECTORS = "item_id bigint, embedding array<double>"


def pairs_stream(spark, folder):
    return incremental.file_stream(spark, folder, incremental.PAIRS)


def test_second_stream_keeps_what_the_first_stored(spark, tmp_path):
    out = str(tmp_path / "out")
    for name, rows in (("one", [(1, 1), (1, 2)]), ("two", [(2, 1), (1, 1)])):
        folder = str(tmp_path / name)
        spark.createDataFrame(rows, incremental.PAIRS).write.parquet(folder)
        incremental.sync_positives(pairs_stream(spark, folder), out, str(tmp_path / f"log-{name}"))
    got = incremental.read_positives(spark, out)
    assert sorted((r["user_id"], r["product_id"]) for r in got.collect()) == [(1, 1), (1, 2), (2, 1)]


def test_stored_table_that_cannot_be_read_is_an_error(spark, tmp_path):
    path = tmp_path / "out" / "stream=a" / "batch=0"
    path.mkdir(parents=True)
    (path / "part-0.parquet").write_text("no parquet")
    with pytest.raises(Exception, match="FAILED_READ_FILE"):
        incremental.read_positives(spark, str(tmp_path / "out")).collect()


@pytest.mark.parametrize("bad", [None, float("nan"), float("inf")])
def test_element_that_is_no_number_is_an_error(spark, bad):
    items = spark.createDataFrame([(1, [1.0, 0.0]), (2, [bad, 1.0])], VECTORS)
    queries = spark.createDataFrame([(1, [1.0, 0.0])], "query_id bigint, embedding array<double>")
    with pytest.raises(PySparkException, match="vector of 2"):
        retrieval.topk(queries, items, 2, "dot").collect()


def test_ragged_vectors_are_an_error(spark):
    items = spark.createDataFrame([(1, [1.0, 0.0, 0.0]), (2, [1.0, 0.0]), (3, [1.0])], VECTORS)
    queries = spark.createDataFrame([(1, [1.0, 0.0])], "query_id bigint, embedding array<double>")
    with pytest.raises(ValueError, match="elements in one table"):
        retrieval.topk(queries, items, 2, "dot").collect()


def test_pairs_among_equal_vectors_can_be_written_out(spark):
    items = spark.createDataFrame([(1, [1.0, 0.0]), (2, [2.0, 0.0]), (3, [1.0, 0.1]), (4, [0.0, 1.0])], VECTORS)
    pairs = retrieval.similar_pairs(items, 0.9)
    members = retrieval.vector_members(items)
    assert sorted(map(tuple, members.collect())) == [(1, 1), (1, 2), (3, 3), (4, 4)]
    got = {(r[0], r[1]) for r in retrieval.expand_pairs(pairs, members).collect()}
    assert got == {(a, b) for a in (1, 2, 3) for b in (1, 2, 3) if a != b}
    with pytest.raises(ValueError):
        retrieval.similar_pairs(items, 0.9, mode="both")


def test_positives_outside_the_catalogue_ban_nothing(spark):
    pairs = spark.createDataFrame([(1, i) for i in [0, 100, 101, 102, 103, 104]], "user_id bigint, product_id bigint")
    catalogue = spark.createDataFrame([(i,) for i in range(8)], "product_id bigint")
    got = sampling.negative_samples(pairs, catalogue).collect()
    assert len(got) == 6 and {r["product_id"] for r in got} <= set(range(1, 8))


def test_auroc_of_counts_whose_product_passes_a_bigint(spark):
    big = 4_000_000_000
    rows = spark.createDataFrame([("x", 0.1, 0, big), ("x", 0.9, big, 0)], "kind string, s double, pos bigint, neg bigint")
    area = rows.agg(metrics._area(F.when(F.col("s") > 0.5, big).otherwise(0)).alias("a")).first()["a"]
    assert math.isclose(area, 1.0)


def test_null_category_is_all_zeros(spark):
    rows = spark.createDataFrame([("a",), (None,)], "c string")
    got = [r[0] for r in rows.select(features.one_hot("c", ["a", "b"])).collect()]
    assert got == [[1.0, 0.0], [0.0, 0.0]]


def test_cosine_index_gets_unit_vectors(spark):
    index = spark.createDataFrame([(0, 1, [1.0, 0.0])], "cell int, item_id bigint, embedding array<double>")
    changes = spark.createDataFrame([(2, [3.0, 4.0], "insert")], "item_id bigint, embedding array<double>, change_type string")
    got = retrieval.sync_index(index, changes, np.array([[1.0, 0.0]]), "cosine").where("item_id = 2").first()
    assert np.allclose(got["embedding"], [0.6, 0.8])


def test_als_takes_ids_beyond_an_int(spark):
    big = 1 << 40
    pairs = spark.createDataFrame([(big + u, big * 2 + i, 1) for u in range(4) for i in range(3)], "user_id bigint, product_id bigint, label int")
    got = factors.als_factors(pairs, rank=2, iterations=1)
    assert {r["id"] for r in got.where("side = 'user'").collect()} == {big + u for u in range(4)}
    assert {r["id"] for r in got.where("side = 'item'").collect()} == {big * 2 + i for i in range(3)}


def test_failing_checks_tell_how_many(spark):
    split = spark.createDataFrame([(1, "train"), (2, "val"), (3, "test")], "user_id int, group string")
    with pytest.raises(ValueError, match="^2 users"):
        checks.require_train_rows(split)
    with pytest.raises(ValueError, match="^1 rows"):
        checks.require_ids_within(split, "user_id", 3)
    assert checks.require_ids_within(split, "user_id", 4) is split


def test_negatives_of_one_user_spread_over_the_catalogue(spark):
    """Neighbouring draws don't fall in a few windows: as many of 200 slices as random draws would hit."""
    pairs = spark.range(2).select(F.lit(1).alias("user_id"), "id").union(
        spark.range(200).select((F.col("id") % 20 + 2).cast("int"), "id")
    ).toDF("user_id", "product_id")
    catalogue = spark.range(20_000).toDF("product_id")
    got = sampling.negative_samples(pairs, catalogue, per_positive=20)
    slices = F.count_distinct(F.floor(F.col("product_id") / 100)).alias("n")
    rows = got.where("user_id > 1").groupBy("user_id").agg(slices, F.count("*").alias("draws")).collect()
    assert len(rows) == 20 and all(r["draws"] == 200 for r in rows)
    # 200 draws hit 126.6 of 200 slices on average
    assert 120 < sum(r["n"] for r in rows) / len(rows) < 133
