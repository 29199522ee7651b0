"""Similarity and retrieval queries."""

from __future__ import annotations

import numpy as np
from pyspark.sql import functions as F

from affinity.functions.vectors import cosine as cosine_of
from affinity.functions.vectors import dot as dot_of
from affinity.operators import features, index_store, retrieval, towers
from affinity.plans import stand_ins as S
from affinity.plans.encoding import ITEM_TEXT, TEXT_DIM, text_sql
from affinity.plans.registry import query
from affinity.sources import keyed_tables
from affinity.session import materialize, scratch_path

VEC = """vec as materialized (select vec_id, "label", embedding::double[] v from embeddings)"""
DOT = "list_dot_product(q.v, i.v)"
COSINE = "list_cosine_similarity(q.v, i.v)"
L2 = "-sqrt(greatest(round(list_dot_product(q.v,q.v)+list_dot_product(i.v,i.v)-2*list_dot_product(q.v,i.v),9),0.0::double))"


def topk_sql(queries, items, key_q, key_i, score, k, where="true", query_id="query_id", item_id="item_id"):
    """Subquery (query_id, item_id, score, rank)."""
    return f"""(select * from (select q.{key_q} {query_id}, i.{key_i} {item_id},
      round({score}, 9) score, row_number() over (partition by q.{key_q}
      order by round({score}, 9) desc, i.{key_i}) "rank" from {queries} q, {items} i where {where})
      where "rank" <= {k})"""


def _vectors(spark, sf, as_id):
    return S.table(spark, sf, "embeddings").select(
        F.col("vec_id").alias(as_id), "embedding", "label"
    )


def _shown(hits):
    return hits.withColumn("score", F.col("score") + F.lit(0.0))


@query(
    "cosine",
    f"""with {S.POS}, {S.USER_VEC}, {S.ITEM_VEC} select user_id, product_id,
      case when list_dot_product(u.vec,u.vec) > 0 and list_dot_product(i.vec,i.vec) > 0
        then {S.r6('list_cosine_similarity(u.vec, i.vec)')} end similarity
      from pos join user_vec u using (user_id) join item_vec i using (product_id)""",
)
def cosine(spark, sf):
    joined = towers.with_pair_vectors(
        S.positives(spark, sf), S.user_vectors(spark, sf), S.item_vectors(spark, sf)
    )
    return joined.select(
        "user_id", "product_id",
        S.rounded(cosine_of("user_vector", "item_vector")).alias("similarity"),
    )


@query(
    "dot_scores",
    f"""with {S.POS}, {S.USER_VEC}, {S.ITEM_VEC} select user_id, product_id,
      {S.r6('list_dot_product(u.vec, i.vec)')} score
      from pos join user_vec u using (user_id) join item_vec i using (product_id)""",
)
def dot_scores(spark, sf):
    joined = towers.with_pair_vectors(
        S.positives(spark, sf), S.user_vectors(spark, sf), S.item_vectors(spark, sf)
    )
    return joined.select(
        "user_id", "product_id", S.rounded(dot_of("user_vector", "item_vector")).alias("score")
    )


@query(
    "pairwise_similarity",
    f"""with g as materialized (select min(vec_id) id, count(*) n, embedding::double[] v
        from embeddings group by embedding)
      select q.id item_id_a, i.id item_id_b, round({COSINE},9)+0.0::double similarity_score,
        q.n copies_a, i.n copies_b from g q, g i
      where q.id <> i.id and round({COSINE}, 9) >= 0.3::double""",
)
def pairwise_similarity(spark, sf):
    pairs = retrieval.similar_pairs(_vectors(spark, sf, "item_id"), 0.3, "cosine")
    return pairs.withColumn("similarity_score", F.col("similarity_score") + F.lit(0.0))


@query(
    "pairwise_members",
    """select min(vec_id) over (partition by embedding) item_id_entry, vec_id item_id
      from embeddings""",
)
def pairwise_members(spark, sf):
    """The items behind the entries of ``pairwise_similarity``."""
    return retrieval.vector_members(_vectors(spark, sf, "item_id"), "cosine")


@query(
    "topk_exact",
    f"""with {VEC} select query_id, item_id, score+0.0::double score, "rank" from
      {topk_sql('vec', 'vec', 'vec_id', 'vec_id', DOT, 10, 'q.vec_id <> i.vec_id')}""",
)
def topk_exact(spark, sf):
    return _shown(
        retrieval.topk(
            _vectors(spark, sf, "query_id"), _vectors(spark, sf, "item_id"), 10, "dot",
            exclude_self=True,
        )
    )


@query(
    "topk_cells",
    f"""with {VEC} select query_id, item_id, score+0.0::double score, "rank" from
      {topk_sql('vec', 'vec', 'vec_id', 'vec_id', COSINE, 10, 'q.vec_id <> i.vec_id')}""",
)
def topk_cells(spark, sf):
    """The search for items beyond the size that tasks hold: by cells, in two rounds."""
    return _shown(retrieval.topk(
        _vectors(spark, sf, "query_id"), _vectors(spark, sf, "item_id"), 10, "cosine", exclude_self=True, broadcast_bytes=0
    ))


@query(
    "topk_cells_seen",
    f"""with {VEC} select query_id, item_id, {S.r6('score')} score, "rank" from
      {topk_sql('vec', 'vec', 'vec_id', 'vec_id', L2, 10, 'i."label" <> q."label"')}""",
)
def topk_cells_seen(spark, sf):
    """By cells, where a query has seen all items of its own label."""
    asked, items = _vectors(spark, sf, "query_id"), _vectors(spark, sf, "item_id")
    seen = retrieval.SeenGroups(asked.select("query_id", "label"), items.select("item_id", "label"), "label")
    return retrieval.topk(asked, items, 10, "l2", seen=seen, broadcast_bytes=0).withColumn("score", S.rounded("score"))


@query(
    "similar_pairs_cells",
    f"""with {VEC} select q.vec_id item_id_a, i.vec_id item_id_b, round({DOT},9)+0.0::double similarity_score,
        1::bigint copies_a, 1::bigint copies_b, row_number() over (order by q.vec_id desc, round({DOT},9) desc, i.vec_id)-1 "position"
      from vec q, vec i where q.vec_id <> i.vec_id and round({DOT}, 9) >= 0.3::double""",
)
def similar_pairs_cells(spark, sf):
    """By cells, in the order of first item and score; the test vectors have no copies."""
    pairs = retrieval.similar_pairs(_vectors(spark, sf, "item_id"), 0.3, "dot", broadcast_bytes=0)
    return retrieval.ordered_pairs(pairs.withColumn("similarity_score", F.col("similarity_score") + F.lit(0.0)))


@query(
    "topk_filtered",
    f"""with {VEC}, kept as (select * from vec where "label" <> 7)
      select query_id, item_id, score+0.0::double score, "rank" from
      {topk_sql('vec', 'kept', 'vec_id', 'vec_id', COSINE, 10, 'q.vec_id <> i.vec_id')}""",
)
def topk_filtered(spark, sf):
    items = _vectors(spark, sf, "item_id").where(F.col("label") != 7)
    return _shown(
        retrieval.topk(_vectors(spark, sf, "query_id"), items, 10, "cosine", exclude_self=True)
    )


@query(
    "topk_as_arrays",
    f"""with {VEC}, h as {topk_sql('vec', 'vec', 'vec_id', 'vec_id', L2, 5)}
      select query_id, array_to_string(list(item_id order by "rank"), ',') item_id_pred,
        {S.r6('max(score)')} best, {S.r6('min(score)')} worst from h group by 1""",
)
def topk_as_arrays(spark, sf):
    hits = retrieval.topk(
        _vectors(spark, sf, "query_id"), _vectors(spark, sf, "item_id"), 5, "l2"
    )
    return retrieval.as_arrays(hits).select(
        "query_id",
        F.array_join("item_id_pred", ",").alias("item_id_pred"),
        S.rounded(F.array_max("score_pred")).alias("best"),
        S.rounded(F.array_min("score_pred")).alias("worst"),
    )


@query(
    "similar_users",
    f"""with {S.USER_VEC}, v as materialized (select user_id, vec v from user_vec
        where list_dot_product(vec, vec) > 0)
      select user_id, similar_id, score+0.0::double score, "rank" from
      {topk_sql('v', 'v', 'user_id', 'user_id', COSINE, 5, 'q.user_id <> i.user_id', 'user_id', 'similar_id')}""",
)
def similar_users(spark, sf):
    users = materialize(S.user_vectors(spark, sf), "users")
    return _shown(
        retrieval.topk(
            users, users.withColumnRenamed("user_id", "similar_id"), 5, "cosine",
            query_id="user_id", item_id="similar_id", exclude_self=True,
        )
    )


@query(
    "similar_items",
    f"""with d as (select p_partkey product_id, {ITEM_TEXT} t from part),
      {text_sql('d', 'product_id', 't')}, v as (select product_id, vec v from tv)
      select product_id, similar_id, score+0.0::double score, "rank" from
      {topk_sql('v', 'v', 'product_id', 'product_id', COSINE, 10, 'q.product_id <> i.product_id', 'product_id', 'similar_id')}""",
)
def similar_items(spark, sf):
    described = S.products(spark, sf).select("product_id", features.item_text().alias("text"))
    vectors = materialize(
        features.text_vectors(described, "product_id", "text", TEXT_DIM), "text-vectors"
    )
    return _shown(
        retrieval.topk(
            vectors, vectors.withColumnRenamed("product_id", "similar_id"), 10, "cosine",
            query_id="product_id", item_id="similar_id", exclude_self=True,
        )
    )


@query("ivf_build")
def ivf_build(spark, sf):
    index = retrieval.build_index(_vectors(spark, sf, "item_id"), 8, "cosine")
    return index.table.select("cell", "item_id", F.size("embedding").alias("dim"))


@query("ivf_search")
def ivf_search(spark, sf):
    index = retrieval.build_index(_vectors(spark, sf, "item_id"), 8, "cosine")
    return _shown(retrieval.search_index(index, _vectors(spark, sf, "query_id"), 10, nprobe=5))


PIVOTS = 16
SYNCED = f"""with {VEC}, piv as materialized (select v, row_number() over (order by h, vec_id)-1 cell from
    (select v, vec_id, md5(concat_ws('|','7',vec_id)) h from vec) order by h, vec_id limit {PIVOTS}),
  near as (select q.vec_id, i.cell, row_number() over (partition by q.vec_id order by
    greatest(round(list_dot_product(q.v,q.v)+list_dot_product(i.v,i.v)-2*list_dot_product(q.v,i.v),9),0.0::double),
    i.cell) rn from vec q, piv i where q."label" <> 1)
  select vec_id item_id, cell::integer cell from near where rn = 1"""


def index_pivots(spark, sf) -> np.ndarray:
    """Centres for the small test index: a keyed sample of the vectors, fixed in number."""
    rows = retrieval.prepared_vectors(_vectors(spark, sf, "item_id"), "item_id", "embedding", "dot")
    return retrieval.sampled_pivots(rows, PIVOTS, 7)


def index_snapshots(spark, sf):
    """An old state of the vector table (two classes absent, one negated) and the new state."""
    now = _vectors(spark, sf, "item_id")
    flipped = F.when(F.col("label") == 3, F.transform("embedding", lambda x: -x)).otherwise(
        F.col("embedding")
    )
    old = now.where(F.col("label") < 8).select("item_id", flipped.alias("embedding"))
    new = now.where(F.col("label") != 1).select("item_id", "embedding")
    return old, new


@query("index_sync", SYNCED)
def index_sync(spark, sf):
    centres = index_pivots(spark, sf)
    old, new = index_snapshots(spark, sf)
    prepared = retrieval.prepared_vectors(old, "item_id", "embedding", "dot")
    index = retrieval.assign_cells(prepared, centres).select(
        F.col("_cell").alias("cell"), F.col("_id").alias("item_id"),
        F.col("_vec").alias("embedding"),
    )
    changes = keyed_tables.snapshot_changes(old, new, ["item_id"])
    return retrieval.sync_index(index, changes, centres).select("item_id", "cell")


def _stored_index(spark, sf, metric: str) -> str:
    """An index of the old vectors, stored and then brought up to date with the changes to the new ones."""
    old, new = index_snapshots(spark, sf)
    path = scratch_path(spark, "stored-index")
    index_store.create(old, path, PIVOTS, metric)
    index_store.sync(spark, path, keyed_tables.snapshot_changes(old, new, ["item_id"]))
    return path


STORED_SEARCH = f"""with {VEC}, kept as (select * from vec where "label" <> 1)
  select query_id, item_id, score+0.0::double score, "rank" from {topk_sql('vec', 'kept', 'vec_id', 'vec_id', DOT, 10)}"""


@query("index_store_search", STORED_SEARCH)
def index_store_search(spark, sf):
    """All cells of the synced index are probed, so the result is that of the exact search."""
    path = _stored_index(spark, sf, "dot")
    return _shown(index_store.search(spark, path, _vectors(spark, sf, "query_id"), 10, PIVOTS))


@query(
    "index_store_filtered",
    f"""with {VEC}, kept as (select * from vec where "label" <> 1 and "label" % 2 = 1)
      select query_id, item_id, score+0.0::double score, "rank" from
      {topk_sql('vec', 'kept', 'vec_id', 'vec_id', COSINE, 10,
                'q.vec_id <> i.vec_id and i.vec_id % 7 <> q.vec_id % 7')}""",
)
def index_store_filtered(spark, sf):
    """The compacted index, searched among items of odd labels, without the query's own and the seen items."""
    path = _stored_index(spark, sf, "cosine")
    index_store.compact(spark, path)
    index_store.vacuum(spark, path)
    rows = _vectors(spark, sf, "item_id")
    asked = _vectors(spark, sf, "query_id")
    seen = retrieval.SeenGroups(
        asked.select("query_id", F.pmod("query_id", F.lit(7)).alias("m")),
        rows.select("item_id", F.pmod("item_id", F.lit(7)).alias("m")), "m",
    )
    return _shown(index_store.search(
        spark, path, asked, 10, PIVOTS, allowed=rows.where("label % 2 = 1"), seen=seen, exclude_self=True,
    ))


RECALL_PROBES = 12  # of 16 cells; the vectors have no clusters, so near ones lie in many cells


@query(
    "index_store_recall",
    f"""with {VEC}, kept as (select * from vec where "label" <> 1)
      select count(distinct query_id) queries, count(*) wanted, true reached from
      {topk_sql('vec', 'kept', 'vec_id', 'vec_id', COSINE, 10)}""",
)
def index_store_recall(spark, sf):
    """Whether a search of some cells finds nine tenths of what the exact search finds."""
    path = _stored_index(spark, sf, "cosine")
    asked = _vectors(spark, sf, "query_id")
    exact = materialize(
        retrieval.topk(asked, index_snapshots(spark, sf)[1], 10, "cosine").select("query_id", "item_id"), "exact"
    )
    found = index_store.search(spark, path, asked, 10, RECALL_PROBES).select("query_id", "item_id", F.lit(1).alias("hit"))
    return exact.join(found, ["query_id", "item_id"], "left").agg(
        F.count_distinct("query_id").alias("queries"), F.count("*").alias("wanted"),
        (F.count("hit") >= 0.9 * F.count("*")).alias("reached"),
    )
