"""Negative samples, splits, the training set and its checks."""

from __future__ import annotations

from pyspark.sql import functions as F

from affinity.operators import batch_negatives as negatives
from affinity.operators import checks, features, interactions, sampling
from affinity.plans import stand_ins as S
from affinity.plans.registry import query
from affinity.session import materialize


@query(
    "negative_samples",
    f'with {S.negatives_sql()} select user_id, product_id, 0 "label" from neg',
)
def negative_samples(spark, sf):
    pos = materialize(S.positives(spark, sf), "positives")
    return sampling.negative_samples(pos, pos.select("product_id").distinct(), seed=S.SEED)


@query(
    "negatives_per_positive",
    f'with {S.negatives_sql(2, clamp=True)} select user_id, product_id, 0 "label" from neg',
)
def negatives_per_positive(spark, sf):
    pos = materialize(S.positives(spark, sf), "positives")
    return sampling.negative_samples(
        pos, pos.select("product_id").distinct(), seed=S.SEED, per_positive=2, clamp=True
    )


SIZES = S.DETAIL + """, pos as materialized (select distinct user_id, p_size product_id
  from detail join part on p_partkey = product_id)"""


@query(
    "negatives_clamped",
    f'with {S.negatives_sql(3, clamp=True, pos=SIZES)} select user_id, product_id, 0 "label" from neg',
)
def negatives_clamped(spark, sf):
    """Items are the 50 sizes of parts, of which users own so many that three times as many aren't left."""
    sizes = S.products(spark, sf).select("product_id", "size")
    bought = S.detail(spark, sf).select("user_id", "product_id").join(sizes, "product_id")
    pos = materialize(bought.select("user_id", F.col("size").alias("product_id")).distinct(), "sizes")
    return sampling.negative_samples(
        pos, pos.select("product_id").distinct(), seed=S.SEED, per_positive=3, clamp=True
    )


BATCH_ROWS = 2000


@query(
    "batch_negatives",
    f"""with {S.POS}, cat as materialized (select product_id, row_number() over (order by product_id)-1 ix
        from (select distinct product_id from pos)),
      b as materialized (select user_id, product_id, ({S.u32(S.SEED, 'user_id', 'product_id', -1)} %
        (select ceil(count(*)/{BATCH_ROWS}.0)::bigint from pos))::integer batch from pos),
      free as materialized (select batch, product_id, row_number() over (partition by batch order by product_id)-1 x
        from (select distinct batch from b) b, cat
        where not exists (select 1 from b c where c.batch = b.batch and c.product_id = cat.product_id)),
      n as (select batch, count(*) f from free group by 1),
      d as (select b.*, draw, (({S.u32(S.SEED, 'user_id', 'product_id', 'draw')} % 2147483648) * 2147483648 +
        {S.u32(S.SEED, 'user_id', 'product_id', 'draw', at=1)} % 2147483648) % f x
        from b join n using (batch), range(2) r(draw))
      select batch, d.user_id, d.product_id, draw::integer draw, free.product_id negative
      from d join free using (batch, x)""",
)
def batch_negatives(spark, sf):
    pos = materialize(S.positives(spark, sf), "positives")
    return negatives.batch_negatives(pos, pos.select("product_id"), 2, BATCH_ROWS, seed=S.SEED)


@query("training_pairs", f'with {S.PAIRS} select user_id, product_id, "label" from pairs')
def training_pairs(spark, sf):
    return S.pairs(spark, sf)


@query("label_balance", f'with {S.PAIRS} select "label", count(*) "count" from pairs group by 1')
def label_balance(spark, sf):
    return checks.label_balance(S.pairs(spark, sf))


@query(
    "split_per_user", f'with {S.SPLIT} select user_id, product_id, "label", "group" from split'
)
def split_per_user(spark, sf):
    return S.split(spark, sf)


@query(
    "rows_per_split", f'with {S.SPLIT} select "group", count(*) "count" from split group by 1'
)
def rows_per_split(spark, sf):
    return interactions.rows_per_value(S.split(spark, sf), "group")


BY_HASH = """case when {u} < 0.7::double then 'train' when {u} < 0.9::double then 'val'
  else 'test' end"""


def _hash_split(pairs):
    return sampling.split_by_hash(
        pairs, ["user_id", "product_id"], {"train": 0.7, "val": 0.2, "test": 0.1}, S.SEED
    )


@query(
    "split_hash",
    f"""with {S.POS} select user_id, product_id,
      {BY_HASH.format(u=S.uniform(S.SEED, 'user_id', 'product_id'))} "group" from pos""",
)
def split_hash(spark, sf):
    return _hash_split(S.positives(spark, sf).drop("label"))


# orders stand in for users here: with one to seven rows each, many miss a split
BASKETS = f"""b as (select distinct l_orderkey user_id, l_partkey product_id from lineitem),
  s as (select user_id, {BY_HASH.format(u=S.uniform(S.SEED, 'user_id', 'product_id'))} "group" from b)"""


def _baskets(spark, sf):
    rows = S.order_products(spark, sf).select(F.col("order_id").alias("user_id"), "product_id")
    return _hash_split(rows.distinct())


@query(
    "split_coverage",
    f"""with {BASKETS} select user_id, count(distinct "group") "count" from s
      group by 1 having count(distinct "group") < 3""",
)
def split_coverage(spark, sf):
    return checks.split_coverage(_baskets(spark, sf))


@query(
    "users_without_train",
    f"""with {BASKETS} select user_id from s
      group by 1 having count(*) filter ("group" = 'train') = 0""",
)
def users_without_train(spark, sf):
    return checks.users_without_train(_baskets(spark, sf))


@query(
    "split_holdout",
    """select o_orderkey order_id, o_custkey user_id, case when row_number() over
      (order by o_orderkey)-1 < floor((select count(*) from orders)*0.7::double) then 'train'
      else 'valid' end "group" from orders""",
)
def split_holdout(spark, sf):
    return sampling.split_holdout(
        S.orders(spark, sf).select("order_id", "user_id"), ["order_id"], 0.3
    )


@query(
    "sample_hash",
    f"""with {S.POS} select user_id, product_id from pos
      where {S.uniform(S.SEED, 'user_id', 'product_id')} < 0.1::double""",
)
def sample_hash(spark, sf):
    return sampling.sample_by_hash(
        S.positives(spark, sf).drop("label"), ["user_id", "product_id"], 0.1, S.SEED
    )


@query(
    "split_temporal",
    """select o_custkey user_id, o_orderkey order_id, case when row_number() over
      (partition by o_custkey order by o_orderdate desc, o_orderkey desc) = 1 then 'test'
      else 'train' end "group" from orders""",
)
def split_temporal(spark, sf):
    return sampling.split_temporal(S.orders(spark, sf)).select("user_id", "order_id", "group")


@query(
    "id_index",
    """select l_partkey product_id, count(*) "count",
      row_number() over (order by count(*) desc, l_partkey::varchar)-1 product_id_index
      from lineitem group by 1""",
)
def id_index(spark, sf):
    return features.id_index(S.order_products(spark, sf), "product_id")


@query(
    "fold_ids",
    f"""with {S.POS} select user_id, product_id, user_id % 1000 user_id_row,
      product_id % 1000 product_id_row from pos""",
)
def fold_ids(spark, sf):
    pairs = S.positives(spark, sf).drop("label")
    folded = features.fold_ids(pairs, "user_id", 1000, "user_id_row")
    return features.fold_ids(folded, "product_id", 1000, "product_id_row")


TRAINING = S.SPLIT + """, joined as materialized (select s.*, p_name product_name,
    p_brand aisle, p_type department, p_size size from split s join part on product_id = p_partkey),
  ux as (select user_id, row_number() over (order by count(*) desc, user_id::varchar)-1 user_id_index
    from joined group by 1),
  px as (select product_id, row_number() over (order by count(*) desc, product_id::varchar)-1
    product_id_index from joined group by 1)"""


@query(
    "training_set",
    f"""with {TRAINING} select product_id, user_id, "label", "group", aisle, department, size,
      user_id_index, product_id_index from joined join ux using (user_id)
      join px using (product_id)""",
)
def training_set(spark, sf):
    joined = materialize(
        S.split(spark, sf).join(S.products(spark, sf), ["product_id"]).drop("product_name"),
        "training",
    )
    checked = checks.require_train_rows(joined)
    indexed = features.with_index(features.with_index(checked, "user_id"), "product_id")
    return indexed.fillna(0)


@query(
    "ground_truth",
    f"""with {S.SPLIT} select user_id, 0::bigint part,
      array_to_string(list(product_id order by product_id), ',') product_id_list,
      count(*) n_items from split where "group" = 'test' and "label" = 1 group by 1""",
)
def ground_truth(spark, sf):
    test = S.split(spark, sf).where((F.col("group") == "test") & (F.col("label") == 1))
    sets = interactions.item_sets(test, out="product_id_list")
    return sets.withColumn("product_id_list", F.array_join("product_id_list", ","))


@query(
    "eval_queries",
    f"""with {S.SPLIT}, {S.USER_VEC} select user_id, product_id, "label",
      {S.r6('vec[1]')} first, {S.r6('sqrt(list_dot_product(vec, vec))')} length
      from split join user_vec using (user_id) where "group" = 'test'""",
)
def eval_queries(spark, sf):
    from affinity.functions.vectors import norm

    test = S.split(spark, sf).where(F.col("group") == "test").drop("group")
    return test.join(S.user_vectors(spark, sf), ["user_id"]).select(
        "user_id", "product_id", "label", S.rounded(F.col("embedding")[0]).alias("first"),
        S.rounded(norm("embedding")).alias("length"),
    )
