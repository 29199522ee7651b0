"""Scans, joins, aggregates, keyed tables and checks."""

from __future__ import annotations

from pyspark.sql import functions as F

from affinity.operators import checks, features, interactions, runs, sampling, towers
from affinity.plans import stand_ins as S
from affinity.plans.registry import query
from affinity.sources import bucketed, keyed_tables, readers, synthetic, writers
from affinity.session import scratch_path


@query(
    "load_table",
    "select o_orderkey, o_custkey, o_orderstatus, o_totalprice, strftime(o_orderdate,'%Y-%m-%d') "
    "o_orderdate, o_orderpriority from orders",
)
def load_table(spark, sf):
    return readers.load_table(spark, f"{sf}/orders.parquet").withColumn(
        "o_orderdate", F.date_format("o_orderdate", "yyyy-MM-dd")
    )


@query("scan_projected", "select l_orderkey, l_partkey from lineitem")
def scan_projected(spark, sf):
    return readers.scan_projected(spark, f"{sf}/lineitem.parquet", ["l_orderkey", "l_partkey"])


@query(
    "feature_upsert",
    """with new as (select o_custkey user_id, round(sum(o_totalprice),2) "value", 'orders' source
         from orders where o_orderstatus = 'F' group by 1),
       cur as (select c_custkey user_id, c_acctbal "value", 'account' source from customer)
     select * from new union all
     select * from cur where user_id not in (select user_id from new)""",
)
def feature_upsert(spark, sf):
    current = S.table(spark, sf, "customer").select(
        F.col("c_custkey").alias("user_id"), F.col("c_acctbal").alias("value"),
        F.lit("account").alias("source"),
    )
    new = (
        S.table(spark, sf, "orders").where(F.col("o_orderstatus") == "F")
        .groupBy(F.col("o_custkey").alias("user_id"))
        .agg(F.round(F.sum("o_totalprice"), 2).alias("value"))
        .withColumn("source", F.lit("orders"))
    )
    return keyed_tables.upsert(current, new, ["user_id"])


@query(
    "snapshot_changes",
    """with o as (select o_orderkey order_id, o_orderpriority priority,
           case when o_orderstatus = 'P' then null else o_totalprice end price
         from orders where o_orderdate < timestamp '1999-01-01'),
       n as (select o_orderkey order_id, o_orderpriority priority, o_totalprice price
         from orders where o_orderpriority <> '5-LOW'),
       j as (select coalesce(o.order_id, n.order_id) order_id, o.order_id oid, n.order_id nid,
           o.priority op, o.price opr, n.priority np, n.price npr
         from o full join n on o.order_id = n.order_id),
       c as (select * from j where oid is null or nid is null
         or op is distinct from np or opr is distinct from npr)
     select order_id, 'insert' change_type, np priority, npr price from c where oid is null
     union all select order_id, 'delete', op, opr from c where nid is null
     union all select order_id, 'update_preimage', op, opr from c where oid is not null and nid is not null
     union all select order_id, 'update_postimage', np, npr from c where oid is not null and nid is not null""",
)
def snapshot_changes(spark, sf):
    o = S.table(spark, sf, "orders")
    cols = [F.col("o_orderkey").alias("order_id"), F.col("o_orderpriority").alias("priority")]
    old = o.where(F.col("o_orderdate") < F.lit("1999-01-01").cast("timestamp_ntz")).select(
        *cols, F.when(F.col("o_orderstatus") != "P", F.col("o_totalprice")).alias("price")
    )
    new = o.where(F.col("o_orderpriority") != "5-LOW").select(
        *cols, F.col("o_totalprice").alias("price")
    )
    return keyed_tables.snapshot_changes(old, new, ["order_id"])


ACCOUNTS = """new as (select o_custkey user_id, round(sum(o_totalprice),2) "value", 'orders' source
      from orders where o_orderstatus = 'F' group by 1),
    cur as (select c_custkey user_id, c_acctbal "value", 'account' source from customer)"""


def _accounts(spark, sf):
    """Account balances, and the order totals that replace some of them."""
    current = S.table(spark, sf, "customer").select(
        F.col("c_custkey").alias("user_id"), F.col("c_acctbal").alias("value"), F.lit("account").alias("source")
    )
    totals = S.table(spark, sf, "orders").where(F.col("o_orderstatus") == "F").groupBy(F.col("o_custkey").alias("user_id"))
    return current, totals.agg(F.round(F.sum("o_totalprice"), 2).alias("value")).withColumn("source", F.lit("orders"))


@query(
    "feature_table_merge",
    f"""with {ACCOUNTS} select * from new where user_id % 11 <> 0 union all
      select * from cur where user_id % 5 <> 0 and user_id not in (select user_id from new where user_id % 11 <> 0)""",
)
def feature_table_merge(spark, sf):
    """A bucketed table after a merge with deletes, opened anew and read from its files."""
    current, new = _accounts(spark, sf)
    path = scratch_path(spark, "feature-table")
    table = bucketed.create(current, path, ["user_id"])
    table.merge(new.where("user_id % 11 <> 0"), delete=current.where("user_id % 5 = 0"))
    return bucketed.open_table(spark, path).read()


ACCOUNT_CHANGES = f"""with {ACCOUNTS},
    n as (select * from new where user_id % 16 = 3 union all
      select * from cur where user_id % 100 <> 7 and user_id not in (select user_id from new where user_id % 16 = 3)),
    j as (select coalesce(cur.user_id, n.user_id) user_id, cur.user_id a, n.user_id b, cur."value" v, cur.source s,
      n."value" w, n.source t from cur full join n on cur.user_id = n.user_id
      where cur."value" is distinct from n."value" or cur.source is distinct from n.source)
  select user_id, 'insert' change_type, w "value", t source from j where a is null
  union all select user_id, 'delete', v, s from j where b is null
  union all select user_id, 'update_preimage', v, s from j where a is not null and b is not null
  union all select user_id, 'update_postimage', w, t from j where a is not null and b is not null"""


@query("version_changes", ACCOUNT_CHANGES)
def version_changes(spark, sf):
    """Changes between two states of a bucketed table, read from the buckets whose digests differ."""
    current, new = _accounts(spark, sf)
    table = bucketed.create(current, scratch_path(spark, "feature-table"), ["user_id"])
    later = table.merge(new.where("user_id % 16 = 3"), delete=current.where("user_id % 100 = 7"))
    return keyed_tables.version_changes(table, later)


@query("digest_changes", ACCOUNT_CHANGES)
def digest_changes(spark, sf):
    """The same changes between two plain snapshots, of which only parts with different digests are compared."""
    current, new = _accounts(spark, sf)
    later = keyed_tables.upsert(current.where("user_id % 100 <> 7"), new.where("user_id % 16 = 3"), ["user_id"])
    return keyed_tables.digest_changes(current, later, ["user_id"])


@query(
    "synth_wide",
    "select o_orderkey id, "
    + ", ".join(
        f"({S.u32(S.SEED, 'o_orderkey', j // 4, at=j % 4)}/4294967296.0::double)::float r_{j}"
        for j in range(8)
    )
    + f""", floor({S.uniform(S.SEED, 'o_orderkey', "'target'")}*3)::integer target from orders""",
)
def synth_wide(spark, sf):
    return synthetic.synth_wide(S.table(spark, sf, "orders"), "o_orderkey", 8, 3, S.SEED)


@query(
    "embedding_sizes",
    f"""with {S.DETAIL} select count(distinct user_id) user_id_distinct,
      count(distinct product_id) product_id_distinct, max(user_id) user_id_max,
      max(product_id) product_id_max,
      greatest(count(distinct user_id), max(user_id)+1) user_id_rows,
      greatest(count(distinct product_id), max(product_id)+1) product_id_rows from detail""",
)
def embedding_sizes(spark, sf):
    return interactions.embedding_sizes(S.detail(spark, sf), ["user_id", "product_id"])


@query(
    "filter_prior",
    f"""with {S.DETAIL} select order_id, product_id, add_to_cart_order, quantity, user_id
      from detail where eval_set = 'prior'""",
)
def filter_prior(spark, sf):
    return interactions.with_eval_set(S.detail(spark, sf), "prior").drop("eval_set", "order_ts")


@query(
    "fill_zero",
    """select o_orderkey order_id, o_orderstatus status, coalesce(returned, 0.0::double) returned
     from orders left join (select l_orderkey, sum(l_quantity) returned from lineitem
       where l_returnflag = 'R' group by 1) on l_orderkey = o_orderkey""",
)
def fill_zero(spark, sf):
    returned = (
        S.table(spark, sf, "lineitem").where(F.col("l_returnflag") == "R")
        .groupBy(F.col("l_orderkey").alias("order_id"))
        .agg(F.sum("l_quantity").alias("returned"))
    )
    orders = S.table(spark, sf, "orders").select(
        F.col("o_orderkey").alias("order_id"), F.col("o_orderstatus").alias("status")
    )
    return orders.join(returned, "order_id", "left").fillna(0)


@query(
    "classify_threshold",
    """select event_id, "value"/490.02::double p, ("value"/490.02::double >= 0.5::double)::bigint
       predicted_class, round_even("value"/490.02::double, 0)::bigint rounded_class from events""",
)
def classify_threshold(spark, sf):
    p = S.table(spark, sf, "events").select(
        "event_id", (F.col("value") / F.lit(490.02)).alias("p")
    )
    return p.select(
        "event_id", "p", towers.classify("p").alias("predicted_class"),
        towers.round_class("p").alias("rounded_class"),
    )


@query(
    "item_popularity",
    'select l_partkey product_id, count(*) "count" from lineitem group by 1',
)
def item_popularity(spark, sf):
    return interactions.item_popularity(S.order_products(spark, sf))


@query(
    "order_detail",
    f"""with {S.DETAIL} select order_id, product_id, add_to_cart_order, quantity, user_id, eval_set,
      strftime(order_ts, '%Y-%m-%d') order_day from detail""",
)
def order_detail(spark, sf):
    return S.detail(spark, sf).select(
        "order_id", "product_id", "add_to_cart_order", "quantity", "user_id", "eval_set",
        F.date_format("order_ts", "yyyy-MM-dd").alias("order_day"),
    )


@query(
    "enrich_dims",
    """select c_custkey, c_name, c_mktsegment, n_name, r_name from customer
     join nation on c_nationkey = n_nationkey join region on n_regionkey = r_regionkey""",
)
def enrich_dims(spark, sf):
    customer = S.table(spark, sf, "customer").withColumnRenamed("c_nationkey", "n_nationkey")
    nation = S.table(spark, sf, "nation").withColumnRenamed("n_regionkey", "r_regionkey")
    region = S.table(spark, sf, "region")
    return interactions.enrich(
        customer, (nation, ["n_nationkey"]), (region, ["r_regionkey"])
    ).select("c_custkey", "c_name", "c_mktsegment", "n_name", "r_name")


@query("positives", f'with {S.POS} select user_id, product_id, 1 "label" from pos')
def positives(spark, sf):
    return S.positives(spark, sf)


@query(
    "interactions_per_user", f'with {S.POS} select user_id, count(*) "count" from pos group by 1'
)
def interactions_per_user(spark, sf):
    return interactions.interactions_per_user(S.positives(spark, sf))


@query(
    "user_item_sets",
    f"""with {S.POS} select user_id, 0::bigint part,
      array_to_string(list(product_id order by product_id), ',') products, count(*) n_items
      from pos group by 1""",
)
def user_item_sets(spark, sf):
    sets = interactions.item_sets(S.positives(spark, sf))
    return sets.withColumn("products", F.array_join("products", ","))


@query(
    "cardinalities",
    f"""with {S.DETAIL} select count(distinct user_id) n_user_id,
      count(distinct product_id) n_product_id, count(distinct order_id) n_order_id from detail""",
)
def cardinalities(spark, sf):
    return interactions.cardinalities(
        S.detail(spark, sf), ["user_id", "product_id", "order_id"]
    )


@query(
    "first_n_interactions",
    f"""with {S.POS} select user_id, product_id from pos
      order by user_id, product_id limit 5000""",
)
def first_n_interactions(spark, sf):
    return interactions.first_interactions(
        S.positives(spark, sf).drop("label"), 5_000, ["user_id", "product_id"]
    )


@query(
    "id_bounds",
    f"""with {S.POS} select min(user_id) min_user_id, min(product_id) min_product_id,
      max(user_id) max_user_id, max(product_id) max_product_id from pos""",
)
def id_bounds(spark, sf):
    return checks.id_bounds(S.positives(spark, sf), ["user_id", "product_id"])


@query(
    "latest_run",
    """with r as (select user_id experiment, event_id run_id, ts,
        row_number() over (partition by user_id order by ts desc, event_id desc) rn from events),
       a as (select user_id experiment, event_id epoch, event_type artifact,
        row_number() over (partition by user_id order by event_id desc) rn
        from events where event_type not like '%sign%')
     select r.experiment, r.run_id, a.epoch, a.artifact from r join a using (experiment)
     where r.rn = 1 and a.rn = 1""",
)
def latest_run(spark, sf):
    events = S.table(spark, sf, "events").select(
        F.col("user_id").alias("experiment"), F.col("event_id").alias("run_id"), "ts",
        F.col("event_id").alias("epoch"), F.col("event_type").alias("artifact"),
    )
    last = runs.latest_run(events, "experiment", "run_id", "ts").drop("ts")
    artifact = runs.latest_artifact(
        events, "experiment", "epoch", "artifact", skip=F.col("artifact").contains("sign")
    )
    return last.join(artifact, "experiment")


@query(
    "binarize_by_mean",
    f"""with {S.DETAIL} select user_id, product_id, order_id, add_to_cart_order,
      case when quantity < (select avg(quantity) from detail) then 0 else 1 end "label" from detail""",
)
def binarize_by_mean(spark, sf):
    ratings = S.detail(spark, sf).select(
        "user_id", "product_id", "order_id", "add_to_cart_order", "quantity"
    )
    return features.binarize_by_mean(ratings, "quantity")


@query(
    "export_shards",
    'select count(*) "rows" from lineitem',
)
def export_shards(spark, sf):
    """Rows in the manifest of a shard export (file names and checksums differ by run)."""
    rows = S.order_products(spark, sf)
    manifest = writers.export_shards(rows, scratch_path(spark, "shards"), shards=8)
    return manifest.agg(F.sum("rows").cast("bigint").alias("rows"))


@query("shuffle_rows", "select l_orderkey order_id, l_linenumber add_to_cart_order, l_partkey product_id from lineitem")
def shuffle_rows(spark, sf):
    rows = S.order_products(spark, sf).select("order_id", "add_to_cart_order", "product_id")
    return sampling.shuffle_rows(rows, ["order_id", "add_to_cart_order", "product_id"])
