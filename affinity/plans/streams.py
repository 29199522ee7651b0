"""Triggered incremental jobs, each read back as a table."""

from __future__ import annotations

from pyspark.sql import functions as F

from affinity.operators import index_store, towers
from affinity.plans import retrieval as R
from affinity.plans import stand_ins as S
from affinity.plans.registry import query
from affinity.session import scratch_path
from affinity.sources import keyed_tables
from affinity.streaming import incremental


@query("positives_stream", f'with {S.POS} select user_id, product_id, 1 "label" from pos')
def positives_stream(spark, sf):
    schema = S.table(spark, sf, "lineitem").schema
    lines = incremental.file_stream(spark, sf, schema, "lineitem.parquet")
    orders = S.orders(spark, sf).select("order_id", "user_id")
    pairs = lines.select(
        F.col("l_orderkey").alias("order_id"), F.col("l_partkey").alias("product_id")
    ).join(orders, "order_id").select("user_id", "product_id")
    path = scratch_path(spark, "positives")
    incremental.sync_positives(pairs, path, scratch_path(spark, "positives-log"))
    return incremental.read_positives(spark, path)


@query("index_sync_stream", R.SYNCED)
def index_sync_stream(spark, sf):
    """Load the old vectors as inserts, then stream the changes to the new ones."""
    old, new = R.index_snapshots(spark, sf)
    feed = scratch_path(spark, "vector-changes")
    columns = ["item_id", "embedding", "change_type", "seq"]
    old.select(
        "item_id", "embedding", F.lit("insert").alias("change_type"), F.lit(0).alias("seq")
    ).write.parquet(feed)
    changes = keyed_tables.snapshot_changes(old, new, ["item_id"]).withColumn("seq", F.lit(1))
    centres, path = R.index_pivots(spark, sf), scratch_path(spark, "index")
    log = scratch_path(spark, "index-log")
    for batch in (None, changes):
        if batch is not None:
            batch.select(*columns).write.mode("append").parquet(feed)
        stream = incremental.file_stream(spark, feed, spark.read.parquet(feed).schema)
        incremental.sync_index(stream, centres, path, log)
    return incremental.read_index(spark, path).select("item_id", "cell")


@query("index_store_stream", R.STORED_SEARCH)
def index_store_stream(spark, sf):
    """A stored index of no vectors takes in the old ones and then the changes as a stream; all cells are searched."""
    old, new = R.index_snapshots(spark, sf)
    feed, path, log = (scratch_path(spark, n) for n in ("index-changes", "stored-index", "stored-index-log"))
    index_store.create(old.limit(0), path, metric="dot", centres=R.index_pivots(spark, sf))
    loads = old.select("*", F.lit("insert").alias("change_type"), F.lit(0).alias("seq"))
    changes = keyed_tables.snapshot_changes(old, new, ["item_id"]).withColumn("seq", F.lit(1))
    for rows in (loads, changes):
        rows.select(*loads.columns).write.mode("append").parquet(feed)
        incremental.sync_stored_index(incremental.file_stream(spark, feed, loads.schema), path, log)
    return R._shown(index_store.search(spark, path, R._vectors(spark, sf, "query_id"), 10, R.PIVOTS))


@query(
    "score_stream",
    f"""with {S.DETAIL}, {S.USER_VEC}, {S.ITEM_VEC} select order_id, add_to_cart_order, user_id,
      product_id, {S.r6('1/(1+exp(-list_dot_product(u.vec, i.vec)))')} prediction_prob
      from detail join user_vec u using (user_id) join item_vec i using (product_id)""",
)
def score_stream(spark, sf):
    schema = S.table(spark, sf, "lineitem").schema
    requests = incremental.file_stream(spark, sf, schema, "lineitem.parquet").select(
        F.col("l_orderkey").alias("order_id"), F.col("l_linenumber").alias("add_to_cart_order"),
        F.col("l_partkey").alias("product_id"),
    ).join(S.orders(spark, sf).select("order_id", "user_id"), "order_id")
    scored = towers.score_pairs(
        requests, S.user_vectors(spark, sf), S.item_vectors(spark, sf)
    ).select(
        "order_id", "add_to_cart_order", "user_id", "product_id",
        S.rounded("prediction_prob").alias("prediction_prob"),
    )
    path = scratch_path(spark, "scores")
    incremental.append_scores(scored, path, scratch_path(spark, "scores-log"))
    return spark.read.parquet(path)
