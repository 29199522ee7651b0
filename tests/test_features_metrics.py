import math

import pytest
from pyspark.sql import functions as F

from affinity.functions import vectors as V
from affinity.operators import features, metrics, towers
from affinity.sources import readers


def one(df):
    return df.first()[0]


def test_index_order_is_by_count_then_string(spark):
    ids = spark.createDataFrame([(i,) for i in (10, 9, 2, 2, 100, None)], "x int")
    rows = features.id_index(ids, "x").orderBy("x_index").collect()
    assert [r.x for r in rows] == [2, 10, 100, 9]


def test_index_agrees_with_string_indexer(spark, sf):
    from pyspark.ml.feature import StringIndexer

    lines = spark.read.parquet(f"{sf}/lineitem.parquet").select("l_partkey")
    fitted = StringIndexer(inputCol="l_partkey", outputCol="ix").fit(lines)
    ours = features.id_index(lines, "l_partkey").orderBy("l_partkey_index").collect()
    assert [str(r.l_partkey) for r in ours] == list(fitted.labels)


def test_jagged_keeps_id_zero_and_drops_null(spark):
    rows = spark.createDataFrame(
        [(0, 0, 0, 5, 1), (0, 1, 7, None, 0)], "batch int, row int, user int, item int, label int"
    )
    got = features.to_jagged(rows, "batch", "row", ["user", "item"], "label").first()
    assert got.user_values == [0, 7] and got.user_lengths == [1, 1]
    assert got.item_values == [5] and got.item_lengths == [1, 0]
    assert got.labels == [1, 0]


def test_binarize(spark):
    rows = spark.createDataFrame([(1.0,), (2.0,), (3.0,), (None,)], "rating double")
    got = features.binarize_by_mean(rows, "rating").collect()
    assert [r.label for r in got] == [0, 1, 1, None]


def test_item_text_nulls(spark):
    rows = spark.createDataFrame(
        [("d", None, "p")], "department string, aisle string, product_name string"
    )
    assert one(rows.select(features.item_text())) is None
    assert one(rows.select(features.item_text(skip_missing=True))) == "Department: d\nProduct: p"


def test_text_vectors(spark):
    docs = spark.createDataFrame(
        [(1, "a b c"), (2, "c  b\na"), (3, ""), (4, None), (5, "zz " * 20000)],
        "k int, text string",
    )
    got = {r.k: r.embedding for r in features.text_vectors(docs, "k", "text", 16).collect()}
    assert got[1] == got[2]
    assert sum(x * x for x in got[1]) == pytest.approx(1)
    assert got[3] == got[4] == [0.0] * 16
    assert sorted(map(abs, got[5]))[-1] == 1.0


def test_pluggable_models(spark):
    docs = spark.createDataFrame([("ab",), ("abc",)], "text string")
    got = features.embed_with(docs, "text", lambda: lambda ts: [[float(len(t))] for t in ts])
    assert [r.embedding for r in got.collect()] == [[2.0], [3.0]]
    scored = towers.predict_with(docs, ["text"], lambda: lambda d: d["text"].str.len() / 10)
    assert [round(r.prediction_prob, 3) for r in scored.collect()] == [0.2, 0.3]


def test_dense_columns(spark):
    rows = spark.createDataFrame([("x", 1.0, 5.0), ("y", 3.0, 5.0)], "c string, a double, b double")
    got = features.dense_features(rows, ["c"], ["a"], [], ["b"]).orderBy("a").collect()
    assert got[0].user_dense == [1.0, 0.0, pytest.approx(-math.sqrt(0.5))]
    assert [r.item_dense for r in got] == [[0.0], [0.0]]
    left, right = features.split_dense(F.col("user_dense"), 2)
    first = features.dense_features(rows, ["c"], ["a"], [], ["b"]).orderBy("a").select(left, right)
    assert [len(v) for v in first.first()] == [2, 1]
    with pytest.raises(ValueError):
        features.categories(rows, "a", limit=1)


def test_vector_functions(spark):
    r = spark.createDataFrame(
        [([1.0, 0.0], [1.0, 0.0], [0.0, 0.0], [1.0])],
        "a array<double>, b array<double>, z array<double>, s array<double>",
    )
    assert one(r.select(V.cosine("a", "b"))) == pytest.approx(1)
    assert one(r.select(V.cosine("a", "z"))) is None
    assert one(r.select(V.normalized("z"))) is None
    assert one(r.select(V.dot("a", "s"))) is None
    big = spark.createDataFrame([(1000.0, 0), (-1000.0, 1)], "x double, y int")
    assert [v[0] for v in big.select(V.bce_with_logits("x", "y")).collect()] == [1000.0, 1000.0]
    assert [v[0] for v in big.select(V.sigmoid("x")).collect()] == [1.0, 0.0]


def test_threshold_rules(spark):
    p = spark.createDataFrame([(0.5,), (0.51,), (0.49,)], "p double")
    assert [v[0] for v in p.select(towers.classify("p")).collect()] == [1, 1, 0]
    assert [v[0] for v in p.select(towers.round_class("p")).collect()] == [0, 1, 0]
    found = metrics.accuracy_f1(p.withColumn("y", F.lit(1)), "p", "y").first()
    assert (found.tp, found.fn) == (1, 2)


def scored(spark, rows):
    return spark.createDataFrame(rows, "s double, y int")


def test_auroc(spark):
    assert one(metrics.auroc(scored(spark, [(0.5, 0), (0.5, 1), (0.5, 1)]), "s", "y")) == 0.5
    assert one(metrics.auroc(scored(spark, [(0.1, 1), (0.2, 1)]), "s", "y")) is None
    mixed = [(0.1, 0), (0.4, 0), (0.4, 1), (0.8, 1)]
    assert one(metrics.auroc(scored(spark, mixed), "s", "y")) == pytest.approx(3.5 / 4)


def test_auroc_is_unchanged_by_a_rising_map_and_agrees_with_ml(spark, sf):
    from pyspark.ml.evaluation import BinaryClassificationEvaluator

    events = spark.read.parquet(f"{sf}/events.parquet").select(
        F.col("value").alias("s"), (F.col("event_type") == "click").cast("int").alias("y")
    )
    area = one(metrics.auroc(events.repartition(5), "s", "y"))
    squashed = events.withColumn("s", V.sigmoid(F.col("s") / 100))
    assert one(metrics.auroc(squashed, "s", "y")) == pytest.approx(area, abs=1e-9)
    ml = BinaryClassificationEvaluator(rawPredictionCol="s", labelCol="y", numBins=0)
    assert ml.evaluate(events.withColumn("y", F.col("y").cast("double"))) == pytest.approx(area)


def test_weights_must_cover_every_type(spark):
    rows = spark.createDataFrame([("a", 0.5, 1), ("b", 0.5, 0)], "kind string, p double, y int")
    some = spark.createDataFrame([("a", 2.0)], "kind string, weight double")
    with pytest.raises(Exception, match="no weight for interaction b"):
        metrics.weighted_bce(rows, some, "kind", "p", "y").collect()
    both = some.union(spark.createDataFrame([("b", 1.0)], some.schema))
    loss = one(metrics.weighted_bce(rows, both, "kind", "p", "y"))
    assert loss == pytest.approx(1.5 * math.log(2))


def test_retrieval_metrics(spark):
    predictions = spark.createDataFrame(
        [(1, 10, 1), (1, 11, 2), (1, 10, 3), (2, 20, 1), (4, 5, 1)],
        "query_id int, item_id int, rank int",
    )
    truth = spark.createDataFrame(
        [(1, 11), (1, 12), (2, 99), (3, 1)], "query_id int, item_id int"
    )
    per = metrics.retrieval_metrics(predictions, truth, 5).orderBy("query_id").collect()
    assert [r.query_id for r in per] == [1, 2, 3]
    assert per[0].precision_at_k == 0.5 and per[0].recall_at_k == 0.5
    best = 1 + 1 / math.log2(3)
    assert per[0].ndcg_at_k == pytest.approx((1 / math.log2(3)) / best)
    assert (per[2].precision_at_k, per[2].recall_at_k, per[2].ndcg_at_k) == (0, 0, 0)
    ap = metrics.average_precision(predictions, truth, 5).orderBy("query_id").collect()
    assert [r.ap for r in ap] == [0.5, 0, 0]
    rr = metrics.reciprocal_rank(predictions, truth).orderBy("query_id").collect()
    assert [r.rr for r in rr] == [0.5, 0, 0]
    means = metrics.mean_metrics(metrics.retrieval_metrics(predictions, truth, 5)).first()
    assert means.mean_recall_at_k == pytest.approx(0.5 / 3)


def test_binary_and_multiclass(spark):
    rows = spark.createDataFrame([([0.7, 0.3], 0), ([0.5, 0.5], 1)], "p array<double>, y int")
    got = metrics.multiclass_metrics(rows, "p", "y").first()
    assert got.merror == 0.5 and got.mlogloss == pytest.approx(-(math.log(0.7) + math.log(0.5)) / 2)
    binary = metrics.binary_log_metrics(scored(spark, [(0.9, 1), (0.5, 1)]), "s", "y").first()
    assert binary.error == 0.5
    by = metrics.metrics_by_type(
        spark.createDataFrame(
            [("a", 0.1, 0), ("a", 0.9, 1), ("b", 0.9, 0), ("b", 0.1, 1)],
            "k string, s double, y int",
        ),
        "k", "s", "y",
    )
    assert {r.k: r.auroc for r in by.collect()} == {"a": 1.0, "b": 0.0}


def test_filter_is_pushed_down(spark, sf):
    orders = readers.load_table(spark, f"{sf}/orders.parquet")
    plan = orders.where("o_orderstatus = 'F'").select("o_orderkey")._jdf.queryExecution()
    text = plan.executedPlan().toString()
    assert "PushedFilters: [IsNotNull(o_orderstatus), EqualTo(o_orderstatus,F)]" in text
    assert "ReadSchema: struct<o_orderkey:bigint,o_orderstatus:string>" in text


def test_split_shuffles_pairs_once(spark, sf):
    from affinity.operators import sampling

    stored = spark.read.parquet(f"{sf}/lineitem.parquet").selectExpr(
        "l_orderkey user_id", "l_linenumber product_id"
    )
    plan = sampling.split_per_user(stored)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning(user_id") == 1
