"""The test tables seen as orders, products, users and vectors, in Spark and in SQL.

The SQL fragments are written apart from the operators on purpose: they are what the
operators are checked against.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from affinity.operators import interactions, sampling, towers
from affinity.session import materialize

SEED = 42
ID_DIM = 8
TOWER = [8, 6, 4]
USER_SEED, ITEM_SEED, USER_NET, ITEM_NET = 1, 2, 11, 12


def table(spark: SparkSession, sf: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf}/{name}.parquet")


def rounded(c, digits: int = 6) -> Column:
    return F.round(F.col(c) if isinstance(c, str) else c, digits) + F.lit(0.0)


def long_form(df: DataFrame, keys: list[str], vector: str, digits: int = 6) -> DataFrame:
    """One row per vector element."""
    return df.select(*keys, F.posexplode(vector).alias("position", "value")).select(
        *keys, "position", rounded("value", digits).alias("value")
    )


def orders(spark, sf) -> DataFrame:
    o = table(spark, sf, "orders")
    eval_set = F.when(F.col("o_orderstatus") == "F", "prior").when(
        F.col("o_orderstatus") == "O", "train"
    ).otherwise("test")
    return o.select(
        F.col("o_orderkey").alias("order_id"), F.col("o_custkey").alias("user_id"),
        eval_set.alias("eval_set"), F.col("o_orderdate").alias("order_ts"),
    )


def order_products(spark, sf) -> DataFrame:
    return table(spark, sf, "lineitem").select(
        F.col("l_orderkey").alias("order_id"), F.col("l_partkey").alias("product_id"),
        F.col("l_linenumber").alias("add_to_cart_order"), F.col("l_quantity").alias("quantity"),
    )


def detail(spark, sf) -> DataFrame:
    return interactions.order_detail(order_products(spark, sf), orders(spark, sf))


def products(spark, sf) -> DataFrame:
    return table(spark, sf, "part").select(
        F.col("p_partkey").alias("product_id"), F.col("p_name").alias("product_name"),
        F.col("p_brand").alias("aisle"), F.col("p_type").alias("department"),
        F.col("p_size").alias("size"),
    )


def positives(spark, sf) -> DataFrame:
    return interactions.positives(detail(spark, sf))


def pairs(spark, sf) -> DataFrame:
    pos = materialize(positives(spark, sf), "positives")
    neg = sampling.negative_samples(pos, pos.select("product_id").distinct(), seed=SEED)
    return sampling.training_pairs(pos, neg)


def frozen_pairs(spark, sf) -> DataFrame:
    return materialize(pairs(spark, sf), "pairs")


def split(spark, sf) -> DataFrame:
    return sampling.split_per_user(frozen_pairs(spark, sf), seed=SEED)


def user_vectors(spark, sf) -> DataFrame:
    users = table(spark, sf, "customer").select(F.col("c_custkey").alias("user_id"))
    start = towers.seed_vectors(users, "user_id", ID_DIM, USER_SEED, 2.0)
    return towers.tower(start, "user_id", "embedding", towers.keyed_layers(USER_NET, TOWER, 2.0))


def item_vectors(spark, sf) -> DataFrame:
    items = table(spark, sf, "part").select(F.col("p_partkey").alias("product_id"))
    start = towers.seed_vectors(items, "product_id", ID_DIM, ITEM_SEED, 2.0)
    return towers.tower(
        start, "product_id", "embedding", towers.keyed_layers(ITEM_NET, TOWER, 2.0)
    )


# ---- SQL fragments ------------------------------------------------------------------------


def u32(seed, *parts, at: int = 0) -> str:
    listed = ",".join([f"'{seed}'", *[str(p) for p in parts]])
    return f"('0x'||substr(md5(concat_ws('|',{listed})),{1 + 8 * at},8))::bigint"


def uniform(seed, *parts) -> str:
    return f"({u32(seed, *parts)}/4294967296.0::double)"


def r6(expr: str, digits: int = 6) -> str:
    return f"(round({expr},{digits})+0.0::double)"


DETAIL = """detail as (select l_orderkey order_id, l_partkey product_id, l_linenumber add_to_cart_order,
  l_quantity quantity, o_custkey user_id,
  case o_orderstatus when 'F' then 'prior' when 'O' then 'train' else 'test' end eval_set,
  o_orderdate order_ts from lineitem join orders on l_orderkey = o_orderkey)"""

POS = DETAIL + """, pos as materialized (select distinct user_id, product_id from detail)"""


def negatives_sql(per_positive: int = 1, clamp: bool = False, seed: int = SEED, pos: str = POS) -> str:
    want = f"owned*{per_positive}"
    if clamp:
        want = f"least({want}, n-owned)"
    parts = [
        pos,
        "cat as materialized (select product_id, row_number() over (order by product_id)-1 ix "
        "from (select distinct product_id from pos))",
        f"want as (select user_id, {want} wanted, {want}+owned draws, n, "
        + ", ".join(f"{u32(seed, 'user_id', at=j)} % 2147483647 h{j}" for j in range(4))
        + " from (select user_id, count(*) owned from pos group by 1), "
        "(select count(*) n from cat))",
        "r0 as (select user_id, wanted, n, h0, h1, h2, h3, d, d x from (select *, "
        "unnest(generate_series(0, draws-1)) d from want))",
    ]
    last = len(sampling.SHUFFLE_ROUNDS)
    for r, (c, prime) in enumerate(sampling.SHUFFLE_ROUNDS):
        parts.append(
            f"r{r + 1} as (select user_id, wanted, n, h0, h1, h2, h3, d, case when "
            f"(((h2*{c}+h3) % 2147483647)*greatest(y,p)+h0) % 2147483647 % 2 = 1 then p else y "
            f"end x from (select *, ((h0*{c}+h1) % 2147483647 % n + n - y) % n p from "
            f"(select *, ({prime}::bigint % n * x + (h0*{c}+h3) % 2147483647 % n) % n y from r{r})))"
        )
    parts.append(
        "neg as materialized (select user_id, product_id from (select user_id, product_id, "
        "wanted, row_number() over (partition by user_id order by d) rn "
        f"from r{last} join cat on ix = x where not exists (select 1 from pos "
        f"where pos.user_id = r{last}.user_id and "
        "pos.product_id = cat.product_id)) where rn <= wanted)"
    )
    return ", ".join(parts)


PAIRS = negatives_sql() + (
    ", pairs as materialized (select user_id, product_id, 1 \"label\" from pos union all "
    "select user_id, product_id, 0 from neg)"
)

SPLIT = PAIRS + (
    ", split as materialized (select user_id, product_id, \"label\", case when rn = 1 then 'train' "
    "when rn/(n::double) < 0.8::double then 'train' when rn/(n::double) < 0.9::double then 'val' "
    "else 'test' end \"group\" from (select *, row_number() over (partition by user_id order by "
    f"md5(concat_ws('|','{SEED}',user_id,product_id)), product_id) rn, "
    "count(*) over (partition by user_id) n from pairs))"
)


def seed_sql(name: str, source: str, key: str, seed: int, dim: int, scale: float) -> str:
    """CTE ``name`` (key, i, v): initial vectors in long form."""
    return (
        f"{name} as (select {key}, i, ({uniform(seed, key, 'i')}-0.5)*{scale}::double v "
        f"from {source}, generate_series(0,{dim - 1}) g(i))"
    )


def layers_sql(name: str, source: str, key: str, seed: int, sizes: list[int], scale: float,
               last_relu: bool = True) -> str:
    """CTE ``name`` (key, i, v): the network applied to the long-form vectors of ``source``."""
    out, prev = [], source
    for n, (before, after) in enumerate(zip(sizes, sizes[1:])):
        last = n == len(sizes) - 2
        step = name if last else f"{name}_{n}"
        w = f"({uniform(seed, n, 'i', 'j')}-0.5)*{scale}::double"
        b = f"({uniform(seed, n, -1, 'j')}-0.5)*{scale}::double"
        value = f"sum(v*w)+any_value(b)"
        if not last or last_relu:
            value = f"greatest({value}, 0.0::double)"
        out.append(
            f"{step}_w as materialized (select i, j, {w} w, {b} b from generate_series(0,{before - 1}) a(i), "
            f"generate_series(0,{after - 1}) c(j))"
        )
        out.append(
            f"{step} as materialized (select {key}, j i, {value} v from {prev} "
            f"join {step}_w using (i) group by {key}, j)"
        )
        prev = step
    return ", ".join(out)


USER_VEC = ", ".join([
    seed_sql("u_seed", "(select c_custkey user_id from customer)", "user_id", USER_SEED, ID_DIM, 2.0),
    layers_sql("u_out", "u_seed", "user_id", USER_NET, TOWER, 2.0),
    "user_vec as materialized (select user_id, list(v order by i) vec from u_out group by 1)",
])
ITEM_VEC = ", ".join([
    seed_sql("i_seed", "(select p_partkey product_id from part)", "product_id", ITEM_SEED, ID_DIM, 2.0),
    layers_sql("i_out", "i_seed", "product_id", ITEM_NET, TOWER, 2.0),
    "item_vec as materialized (select product_id, list(v order by i) vec from i_out group by 1)",
])
