import pytest
from pyspark.sql import functions as F

from affinity.operators import factors, runs, trees
from affinity.plans import stand_ins as S
from affinity.session import materialize, scratch_path
from affinity.sources import keyed_tables, readers, synthetic, writers
from affinity.streaming import incremental


def test_typed_csv(spark, tmp_path):
    (tmp_path / "a.csv").write_text(
        "order_id,user_id,eval_set,order_number,order_dow,order_hour_of_day,days_since_prior_order\n"
        "1,2,prior,1,0,8,\n2,x,train,2,1,9,3.5\n"
    )
    rows = readers.read_csv_typed(spark, str(tmp_path / "a.csv"), readers.ORDERS).collect()
    assert rows[0].days_since_prior_order is None and rows[0].user_id == 2
    assert rows[1].user_id is None and rows[1].days_since_prior_order == 3.5


def test_csv_directory(spark, tmp_path):
    for name, n in (("prior", 1), ("train", 2)):
        body = "".join(f"{i},{i},1,0\n" for i in range(n))
        (tmp_path / f"{name}.csv").write_text("order_id,product_id,add_to_cart_order,reordered\n" + body)
    rows = readers.read_csv_dir(spark, str(tmp_path), readers.ORDER_PRODUCTS)
    assert {r.source_file: r["count"] for r in rows.groupBy("source_file").count().collect()} == {
        "prior.csv": 1, "train.csv": 2
    }


def test_namespace_and_tables(spark):
    writers.ensure_namespace(spark, "shop")
    try:
        writers.write_table(spark.range(3), "numbers")
        again = writers.write_table(spark.range(2).withColumn("x", F.lit(1)), "numbers")
        assert again.columns == ["id", "x"] and readers.load_table(spark, "numbers").count() == 2
        first = spark.createDataFrame([(1, "a"), (2, "b")], "k int, v string")
        keyed_tables.write_feature_table(spark, "feats", first, ["k"], "it's text")
        second = spark.createDataFrame([(2, "c"), (3, "d")], "k int, v string")
        merged = keyed_tables.write_feature_table(spark, "feats", second, ["k"])
        assert {r.k: r.v for r in merged.collect()} == {1: "a", 2: "c", 3: "d"}
        with pytest.raises(ValueError, match="duplicate"):
            keyed_tables.write_feature_table(spark, "feats", second.union(second), ["k"])
    finally:
        spark.sql("USE default")


def test_split_export(spark, tmp_path):
    rows = spark.createDataFrame([(1, "train"), (2, "test"), (3, "train")], "x int, `group` string")
    writers.export_splits(rows, str(tmp_path / "out"))
    got = writers.read_split(spark, str(tmp_path / "out"), "train")
    assert sorted(r.x for r in got.collect()) == [1, 3]
    assert "PartitionFilters: [isnotnull(group" in got._jdf.queryExecution().executedPlan().toString()


def test_shard_manifest(spark, tmp_path):
    import hashlib

    path = str(tmp_path / "shards")
    manifest = writers.export_shards(spark.range(100), path, shards=4, max_rows=20).collect()
    assert sum(r.rows for r in manifest) == 100 and max(r.rows for r in manifest) <= 20
    for r in manifest:
        data = (tmp_path / "shards" / r.file).read_bytes()
        assert len(data) == r.bytes and hashlib.sha1(data).hexdigest() == r.sha1


def test_snapshot_changes(spark):
    schema = "k int, v string"
    old = spark.createDataFrame([(1, "a"), (2, "b"), (3, None), (4, None)], schema)
    new = spark.createDataFrame([(1, "a"), (2, "z"), (3, "c"), (4, None), (5, "n")], schema)
    got = sorted((r.k, r.change_type, r.v) for r in
                 keyed_tables.snapshot_changes(old, new.where("k <> 1"), ["k"]).collect())
    assert got == [
        (1, "delete", "a"), (2, "update_postimage", "z"), (2, "update_preimage", "b"),
        (3, "update_postimage", "c"), (3, "update_preimage", None), (5, "insert", "n"),
    ]


def test_synthetic_is_keyed(spark):
    wide = synthetic.synth_wide(spark.range(100), "id", 5, 3, partitions=4)
    again = synthetic.synth_wide(spark.range(100).repartition(7), "id", 5, 3)
    assert wide.exceptAll(again).isEmpty() and len(wide.columns) == 7
    assert {r.target for r in wide.select("target").collect()} == {0, 1, 2}
    assert synthetic.table_path("/x/", 1, 2, 3) == "/x/synthetic_data_1_rows_2_columns_3_labels"


def test_run_log(spark, tmp_path):
    path = str(tmp_path / "runs")
    runs.append_run(spark, path, "r1", "e", 1.0, {"lr": 0.1}, {"loss": 2})
    runs.append_run(spark, path, "r2", "e", 2.0, {"lr": 0.2})
    log = spark.read.parquet(path)
    assert log.count() == 3
    assert runs.latest_run(log, "experiment", "run_id", "start_time").first().run_id == "r2"
    files = spark.createDataFrame(
        [("r", 9, "e9"), ("r", 10, "e10"), ("r", 11, "base")], "run string, epoch int, path string"
    )
    last = runs.latest_artifact(files, "run", "epoch", "path", skip=F.col("path").contains("base"))
    assert last.first().path == "e10"


@pytest.fixture(scope="module")
def parts(spark, sf):
    split = materialize(S.split(spark, sf), "split")
    return [split.where(F.col("group") == g) for g in ("train", "val", "test")]


def test_training_lowers_the_loss(spark, parts):
    train, val, test = parts
    fitted = factors.fit(train, dim=4, epochs=3, lr=0.2, test=test)
    losses = [r[2] for r in fitted.log if r[1] == "train"]
    assert losses[0] > losses[1] > losses[2] > losses[3]
    assert fitted.log[-1][1] == "test"
    assert fitted.log_table(spark).count() == 5
    assert fitted.vectors("user", "user_id").count() == train.select("user_id").distinct().count()


def test_search_selects_on_validation(spark, parts):
    trials = factors.draw_trials(2, 1, [2, 4], (1e-2, 1e-1))
    assert all(1e-2 <= t["lr"] <= 1e-1 and t["dim"] in (2, 4) for t in trials)
    rows = factors.search(*parts, trials).collect()
    best = [r for r in rows if r.best]
    assert len(best) == 1 and best[0].val_loss == min(r.val_loss for r in rows)
    assert [r.test_loss is None for r in rows] == [not r.best for r in rows]


def test_als(spark, sf):
    found = factors.als_factors(S.positives(spark, sf), rank=4, iterations=1)
    assert {r.side for r in found.select("side").distinct().collect()} == {"user", "item"}


@pytest.mark.parametrize("labels", [2, 3])
def test_trees(spark, labels):
    rows = spark.range(300).select(
        F.col("id"), (F.col("id") % 30).cast("double").alias("x"),
        F.floor((F.col("id") % 30) * labels / 30).cast("int").alias("target"),
    )
    got = trees.boosted_trees(rows, rows, ["x"], labels=labels, max_depth=2, rounds=2)
    assert got.where("prediction = target").count() > 280


def test_positives_stream_is_idempotent(spark, tmp_path):
    feed, out, log = (str(tmp_path / n) for n in ("feed", "out", "log"))
    schema = "user_id bigint, product_id bigint"
    spark.createDataFrame([(1, 1), (1, 1), (1, 2)], schema).write.parquet(feed)

    def trigger():
        stream = incremental.file_stream(spark, feed, spark.read.parquet(feed).schema)
        incremental.sync_positives(stream, out, log)
        return sorted((r.user_id, r.product_id) for r in incremental.read_positives(spark, out).collect())

    assert trigger() == [(1, 1), (1, 2)]
    assert trigger() == [(1, 1), (1, 2)]
    spark.createDataFrame([(1, 2), (2, 2)], schema).write.mode("append").parquet(feed)
    assert trigger() == [(1, 1), (1, 2), (2, 2)]
    # the whole feed replayed from nothing over the same table changes nothing
    stream = incremental.file_stream(spark, feed, spark.read.parquet(feed).schema)
    incremental.sync_positives(stream, out, str(tmp_path / "log2"))
    got = incremental.read_positives(spark, out)
    assert sorted((r.user_id, r.product_id) for r in got.collect()) == [(1, 1), (1, 2), (2, 2)]


def test_stream_equals_batch(spark, sf):
    import __spark_entry__ as entry

    queries = entry.queries()
    for stream, batch in (("index_sync_stream", "index_sync"), ("positives_stream", "positives")):
        a, b = queries[stream](spark, sf), queries[batch](spark, sf)
        assert a.exceptAll(b.select(*a.columns)).isEmpty() and a.count() == b.count()


def test_scratch_folder_is_the_configured_one(spark):
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if configured:
        assert scratch_path(spark, "x").startswith(configured.rstrip("/"))
