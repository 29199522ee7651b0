import numpy as np
import pytest
from pyspark.sql import functions as F

from affinity.operators import retrieval
from affinity.plans import retrieval as queries
from affinity.plans import stand_ins as S


@pytest.fixture(scope="module")
def vectors(spark, sf):
    """The test vectors with a third of all rows being copies of one of them."""
    rows = S.table(spark, sf, "embeddings").select("vec_id", "embedding")
    hot = rows.where("vec_id = 3").select(F.col("embedding").alias("hot"))
    copies = spark.range(1000, 1250).select(F.col("id").alias("vec_id")).join(hot)
    return rows.unionByName(copies.withColumnRenamed("hot", "embedding")).cache()


@pytest.fixture
def tiny_blocks(monkeypatch):
    monkeypatch.setattr(retrieval, "QUERIES_PER_CHUNK", 64)
    monkeypatch.setattr(retrieval, "ITEMS_PER_BLOCK", 32)
    monkeypatch.setattr(retrieval, "CHUNKS_PER_TASK", 2)


def named(df, name):
    return df.withColumnRenamed("vec_id", name)


@pytest.mark.parametrize("metric", ["dot", "cosine", "l2"])
def test_cells_agree_with_the_broadcast_form(spark, vectors, tiny_blocks, metric):
    q, i = named(vectors, "query_id"), named(vectors, "item_id")
    small = retrieval.topk(q, i, 10, metric, exclude_self=True)
    cells = retrieval.topk(q, i, 10, metric, exclude_self=True, broadcast_bytes=0, n_cells=12)
    keep = ["query_id", "item_id", "rank"]
    assert small.select(keep).exceptAll(cells.select(keep)).isEmpty()
    assert cells.count() == small.count() == 7500


def test_seen_pairs_are_replaced(spark, vectors, tiny_blocks):
    q, i = named(vectors, "query_id"), named(vectors, "item_id")
    seen = retrieval.topk(q, i, 3, "dot").select("query_id", "item_id")
    small = retrieval.topk(q, i, 5, "dot", seen=seen)
    cells = retrieval.topk(q, i, 5, "dot", seen=seen, broadcast_bytes=0, n_cells=12)
    assert small.count() == 5 * 750
    assert small.join(seen, ["query_id", "item_id"]).isEmpty()
    keep = ["query_id", "item_id", "rank"]
    assert small.select(keep).exceptAll(cells.select(keep)).isEmpty()


def test_pairs_count_copies_and_agree(spark, vectors, tiny_blocks):
    items = named(vectors, "item_id")
    small = retrieval.similar_pairs(items, 0.35)
    cells = retrieval.similar_pairs(items, 0.35, broadcast_bytes=0, n_cells=12)
    keys = ["item_id_a", "item_id_b", "copies_a", "copies_b"]
    assert small.select(keys).exceptAll(cells.select(keys)).isEmpty()
    assert small.count() == 2 * retrieval.similar_pairs(items, 0.35, mode="unordered").count()
    assert small.where("item_id_a = 3 and copies_a <> 251").isEmpty()


def test_index_recall(spark, vectors):
    q, i = named(vectors, "query_id"), named(vectors.where("vec_id < 1000"), "item_id")
    index = retrieval.build_index(i, 8, "cosine")
    exact = retrieval.topk(q, i, 10, "cosine")
    keep = ["query_id", "item_id"]
    for nprobe, low in ((6, 0.9), (8, 1.0)):
        found = retrieval.search_index(index, q, 10, nprobe).select(keep)
        assert found.join(exact, keep).count() / exact.count() >= low


def test_edge_vectors(spark):
    rows = spark.createDataFrame(
        [(0, [0.0, 0.0]), (1, [1.0, 0.0]), (2, [2.0, 0.0]), (3, [0.0, 1.0])],
        "item_id bigint, embedding array<double>",
    )
    q = rows.withColumnRenamed("item_id", "query_id")
    got = retrieval.topk(q, rows, 2, "cosine").orderBy("query_id", "rank").collect()
    assert {r.query_id for r in got} == {1, 2, 3}  # a zero vector has no direction
    assert [r.item_id for r in got if r.query_id == 2] == [1, 2]  # a tie goes to the lower id
    more = retrieval.topk(q, rows, 10, "dot").groupBy("query_id").count().collect()
    assert {r["count"] for r in more} == {4}
    with pytest.raises(ValueError):
        retrieval.topk(q, rows, 2, "hamming")


def test_bounds_hold(spark, vectors):
    x = retrieval._matrix(vectors.select("embedding").toArrow()["embedding"])
    pivots = x[:9]
    away = -retrieval._scores(x, pivots, "l2")
    cell = away.argmin(1)
    radius = np.array([away[cell == c, c].max() for c in range(9)])
    for metric in ("dot", "l2"):
        bounds = retrieval._bounds(x, pivots, radius, metric)
        scores = retrieval._scores(x, x, metric)
        for c in range(9):
            assert (scores[:, cell == c].max(1) <= bounds[:, c] + 1e-6).all()


def test_no_cartesian_product(spark, sf):
    stored = S.table(spark, sf, "embeddings")
    q, i = named(stored, "query_id"), named(stored, "item_id")
    for limit in (retrieval.BROADCAST_BYTES, 0):
        hits = retrieval.topk(q, i, 5, "dot", broadcast_bytes=limit, n_cells=8)
        plan = hits._jdf.queryExecution().executedPlan().toString()
        assert "Cartesian" not in plan and "NestedLoop" not in plan


def test_index_sync_touches_changed_ids_only(spark, sf):
    old, new = queries.index_snapshots(spark, sf)
    centres = queries.index_pivots(spark, sf)
    synced = queries.index_sync(spark, sf)
    rebuilt = retrieval.assign_cells(
        retrieval.prepared_vectors(new, "item_id", "embedding", "dot"), centres
    ).select(F.col("_id").alias("item_id"), F.col("_cell").alias("cell"))
    assert synced.exceptAll(rebuilt).isEmpty() and synced.count() == rebuilt.count()
