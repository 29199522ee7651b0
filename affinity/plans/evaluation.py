"""Loss, classification and retrieval metrics."""

from __future__ import annotations

from pyspark.sql import functions as F

from affinity.functions.vectors import bce_with_logits, dot, shares, sigmoid
from affinity.operators import metrics, retrieval, towers
from affinity.plans import stand_ins as S
from affinity.plans.registry import query
from affinity.plans.retrieval import topk_sql
from affinity.session import materialize

EVENTS = """ev as (select event_type, "value", ("value"-245)/100 x,
  1/(1+exp(-("value"-245)/100)) p, (event_type = 'purchase')::integer y from events)"""
BCE = "greatest(x,0)-x*y+ln(1+exp(-abs(x)))"
BCE_P = "-(y*greatest(ln(p),-100)+(1-y)*greatest(ln(1-p),-100))"


def _events(spark, sf):
    x = (F.col("value") - 245) / 100
    return S.table(spark, sf, "events").select(
        "event_type", "value", x.alias("x"), sigmoid(x).alias("p"),
        (F.col("event_type") == "purchase").cast("int").alias("y"),
    )


@query("bce_loss", f"with {EVENTS} select {S.r6(f'avg({BCE})')} loss from ev")
def bce_loss(spark, sf):
    return metrics.mean_bce(_events(spark, sf), "x", "y").select(S.rounded("loss").alias("loss"))


# The weight of each interaction type.
WEIGHTS = [("click", 1.0), ("view", 0.5), ("purchase", 2.0), ("signup", 1.5), ("error", 0.25)]


@query(
    "weighted_bce",
    f"""with {EVENTS}, w(event_type, weight) as (values {", ".join(f"('{k}', {v}::double)" for k, v in WEIGHTS)})
      select {S.r6(f'avg(weight*({BCE_P}))')} loss from ev join w using (event_type)""",
)
def weighted_bce(spark, sf):
    weights = spark.createDataFrame(WEIGHTS, "event_type string, weight double")
    return metrics.weighted_bce(_events(spark, sf), weights, "event_type", "p", "y").select(
        S.rounded("loss").alias("loss")
    )


@query(
    "eval_loss",
    f"""with {S.SPLIT}, {S.USER_VEC}, {S.ITEM_VEC}, z as (select "group", "label" y,
        list_dot_product(u.vec, i.vec) x from split join user_vec u using (user_id)
        join item_vec i using (product_id))
      select "group", count(*) n, {S.r6(f'avg({BCE})')} loss from z group by 1""",
)
def eval_loss(spark, sf):
    scored = towers.with_pair_vectors(
        S.split(spark, sf), S.user_vectors(spark, sf), S.item_vectors(spark, sf)
    ).withColumn("logit", dot("user_vector", "item_vector"))
    return scored.groupBy("group").agg(
        F.count("*").alias("n"), S.rounded(F.avg(bce_with_logits("logit", "label"))).alias("loss")
    )


AUROC = """s as (select {key} "value" sc, sum(y) pos, count(*)-sum(y) neg from ev group by all),
  c as (select *, sum(neg) over ({part} order by sc) - neg below from s)
  select {key} {loss} round(sum(pos*(below+neg/2.0::double))/(sum(pos)::double*sum(neg)),6)+0.0::double auroc
  from c {tail}"""


@query("auroc", f"with {EVENTS}, " + AUROC.format(key="", part="", loss="", tail=""))
def auroc(spark, sf):
    return metrics.auroc(_events(spark, sf), "value", "y").select(
        S.rounded("auroc").alias("auroc")
    )


@query(
    "metrics_by_type",
    f"""with ev as (select o_orderpriority kind, o_totalprice/600000 p, o_totalprice sc,
        (o_orderstatus = 'F')::integer y from orders),
      s as (select kind, sc, sum(y) pos, count(*)-sum(y) neg from ev group by all),
      c as (select *, sum(neg) over (partition by kind order by sc) - neg below from s),
      a as (select kind, sum(pos*(below+neg/2.0::double))/(sum(pos)::double*sum(neg)) auroc from c group by 1),
      l as (select kind, count(*) n, avg({BCE_P}) loss from ev group by 1)
      select kind, n, {S.r6('loss')} loss, {S.r6('auroc')} auroc from l join a using (kind)""",
)
def metrics_by_type(spark, sf):
    rows = S.table(spark, sf, "orders").select(
        F.col("o_orderpriority").alias("kind"), (F.col("o_totalprice") / 600000).alias("p"),
        (F.col("o_orderstatus") == "F").cast("int").alias("y"),
    )
    return metrics.metrics_by_type(rows, "kind", "p", "y").select(
        "kind", "n", S.rounded("loss").alias("loss"), S.rounded("auroc").alias("auroc")
    )


@query(
    "accuracy_f1",
    f"""with {EVENTS}, c as (select count(*) filter (p > 0.5 and y = 1) tp,
        count(*) filter (p > 0.5 and y = 0) fp, count(*) filter (p <= 0.5 and y = 1) fn,
        count(*) filter (p <= 0.5 and y = 0) tn from ev)
      select tp, fp, fn, tn, {S.r6('(tp+tn)/(tp+fp+fn+tn)::double')} accuracy,
        {S.r6('2*tp/(2*tp+fp+fn)::double')} f1 from c""",
)
def accuracy_f1(spark, sf):
    return metrics.accuracy_f1(_events(spark, sf), "p", "y").select(
        "tp", "fp", "fn", "tn", S.rounded("accuracy").alias("accuracy"),
        S.rounded("f1").alias("f1"),
    )


@query(
    "multiclass_metrics",
    f"""with x as (select vec_id, "label" y, unnest(embedding[1:10])::double*5 v,
        generate_subscripts(embedding[1:10], 1)-1 c from embeddings),
      p as (select vec_id, y, c, exp(v)/sum(exp(v)) over (partition by vec_id) p from x),
      r as (select vec_id, y, arg_max(c, p) top, max(p) filter (c = y) py from p group by 1, 2)
      select {S.r6('avg(-ln(greatest(py,1e-16::double)))')} mlogloss,
        {S.r6('avg((top <> y)::integer::double)')} merror from r""",
)
def multiclass_metrics(spark, sf):
    raw = F.transform(F.slice("embedding", 1, 10), lambda v: F.exp(v.cast("double") * 5))
    rows = S.table(spark, sf, "embeddings").select("label", shares(raw).alias("probabilities"))
    return metrics.multiclass_metrics(rows, "probabilities", "label").select(
        S.rounded("mlogloss").alias("mlogloss"), S.rounded("merror").alias("merror")
    )


def predictions_sql(k: int) -> str:
    """CTEs truth (user_id, product_id) and pred (user_id, product_id, rank)."""
    hits = topk_sql("uv", "iv", "user_id", "product_id", "list_dot_product(q.v, i.v)", k,
                    query_id="user_id", item_id="product_id")
    return f"""{S.SPLIT}, {S.USER_VEC}, {S.ITEM_VEC},
      truth as materialized (select user_id, product_id from split where "group" = 'test' and "label" = 1),
      uv as (select user_id, vec v from user_vec where user_id in (select user_id from truth)),
      iv as (select product_id, vec v from item_vec),
      pred as materialized (select user_id, product_id, "rank" from {hits}),
      hit as materialized (select p.* from pred p join truth t using (user_id, product_id)),
      users as (select user_id, count(*) relevant from truth group by 1)"""


def predictions(spark, sf, k):
    """Top-k items of the users that have positive test rows, and those rows."""
    truth = materialize(
        S.split(spark, sf).where((F.col("group") == "test") & (F.col("label") == 1))
        .select("user_id", "product_id"),
        "truth",
    )
    users = S.user_vectors(spark, sf).join(truth, "user_id", "left_semi")
    hits = retrieval.topk(
        users, S.item_vectors(spark, sf), k, "dot", query_id="user_id", item_id="product_id"
    )
    return hits, truth


@query(
    "retrieval_eval",
    f"""with {predictions_sql(100)},
      got as (select user_id, count(*) retrieved from pred group by 1),
      h as (select user_id, count(*) hits, sum(1/log2("rank"+1)) dcg from hit group by 1),
      ideal as (select n, sum(1/log2(n+1)) over (order by n) best from generate_series(1,100) g(n))
      select user_id, relevant, coalesce(hits,0) hits,
        {S.r6('coalesce(hits,0)/retrieved::double')} precision_at_k,
        {S.r6('coalesce(hits,0)/relevant::double')} recall_at_k,
        {S.r6('coalesce(dcg,0)/best')} ndcg_at_k
      from users join got using (user_id) left join h using (user_id)
      join ideal on n = least(relevant, 100)""",
)
def retrieval_eval(spark, sf):
    hits, truth = predictions(spark, sf, 100)
    per_user = metrics.retrieval_metrics(hits, truth, 100, "user_id", "product_id")
    shown = [c for c in per_user.columns if c.endswith("_at_k")]
    return per_user.select(
        "user_id", "relevant", "hits", *[S.rounded(c).alias(c) for c in shown]
    ).orderBy(F.desc("recall_at_k"), "user_id")


@query(
    "map_at_k",
    f"""with {predictions_sql(25)}, pr as (select user_id,
        row_number() over (partition by user_id order by "rank")/"rank"::double p from hit),
      a as (select user_id, avg(p) ap from pr group by 1)
      select user_id, {S.r6('coalesce(ap, 0.0::double)')} ap from users left join a using (user_id)""",
)
def map_at_k(spark, sf):
    hits, truth = predictions(spark, sf, 25)
    ap = metrics.average_precision(hits, truth, 25, "user_id", "product_id")
    return ap.select("user_id", S.rounded("ap").alias("ap"))


@query(
    "mrr",
    f"""with {predictions_sql(100)}, a as (select user_id, 1/min("rank")::double rr from hit group by 1)
      select user_id, {S.r6('coalesce(rr, 0.0::double)')} rr from users left join a using (user_id)""",
)
def mrr(spark, sf):
    hits, truth = predictions(spark, sf, 100)
    rr = metrics.reciprocal_rank(hits, truth, "user_id", "product_id")
    return rr.select("user_id", S.rounded("rr").alias("rr"))


@query(
    "mean_retrieval",
    f"""with {predictions_sql(25)},
      got as (select user_id, count(*) retrieved from pred group by 1),
      h as (select user_id, count(*) hits, sum(1/log2("rank"+1)) dcg from hit group by 1),
      ideal as (select n, sum(1/log2(n+1)) over (order by n) best from generate_series(1,25) g(n))
      select {S.r6('avg(coalesce(hits,0)/retrieved::double)')} mean_precision_at_k,
        {S.r6('avg(coalesce(hits,0)/relevant::double)')} mean_recall_at_k,
        {S.r6('avg(coalesce(dcg,0)/best)')} mean_ndcg_at_k
      from users join got using (user_id) left join h using (user_id)
      join ideal on n = least(relevant, 25)""",
)
def mean_retrieval(spark, sf):
    hits, truth = predictions(spark, sf, 25)
    means = metrics.mean_metrics(metrics.retrieval_metrics(hits, truth, 25, "user_id", "product_id"))
    return means.select(*[S.rounded(c).alias(c) for c in means.columns])


@query(
    "binary_log_metrics",
    f"""with {EVENTS} select {S.r6(f'avg({BCE_P})')} logloss,
      {S.r6('avg(((p > 0.5)::integer <> y)::integer)')} error from ev""",
)
def binary_log_metrics(spark, sf):
    found = metrics.binary_log_metrics(_events(spark, sf), "p", "y")
    return found.select(*[S.rounded(c).alias(c) for c in ("logloss", "error")])
