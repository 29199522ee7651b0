"""Model inputs: jagged batches, dense features and text vectors."""

from __future__ import annotations

from pyspark.sql import functions as F

from affinity.operators import checks, features
from affinity.plans import stand_ins as S
from affinity.plans.registry import query

TEXT_DIM = 64


@query(
    "to_jagged",
    """with e as (select event_id // 512 batch, event_id, user_id,
        case when event_type <> 'error' then floor("value")::bigint end item_id,
        (event_type = 'purchase')::integer "label" from events)
     select batch, array_to_string(list(user_id order by event_id), ',') user_id_values,
       repeat('1,', count(*)-1) || '1' user_id_lengths,
       array_to_string(list(item_id order by event_id) filter (item_id is not null), ',') item_id_values,
       array_to_string(list(case when item_id is null then 0 else 1 end order by event_id), ',') item_id_lengths,
       array_to_string(list("label" order by event_id), ',') labels
     from e group by 1""",
)
def to_jagged(spark, sf):
    events = S.table(spark, sf, "events").select(
        F.floor(F.col("event_id") / 512).alias("batch"), "event_id", "user_id",
        F.when(F.col("event_type") != "error", F.floor("value")).alias("item_id"),
        (F.col("event_type") == "purchase").cast("int").alias("label"),
    )
    jagged = features.to_jagged(events, "batch", "event_id", ["user_id", "item_id"], "label")
    arrays = [c for c in jagged.columns if c != "batch"]
    return jagged.select("batch", *[F.array_join(c, ",").alias(c) for c in arrays])


@query(
    "dense_features",
    """with e as (select event_id, event_type, "value" v, hour(ts)::double h, dayofmonth(ts)::double d
        from events),
       s as (select avg(v) mv, stddev_samp(v) sv, avg(h) mh, stddev_samp(h) sh, avg(d) md,
         stddev_samp(d) sd from e),
       t as (select event_type, row_number() over (order by event_type)-1 i
         from (select distinct event_type from e)),
       nt as (select count(*) n from t),
       r as (
         select event_id, 'user' side, i position, (e.event_type = t.event_type)::integer::double "value"
           from e, t
         union all select event_id, 'user', n, (v-mv)/sv from e, s, nt
         union all select event_id, 'item', 0, (h-mh)/sh from e, s
         union all select event_id, 'item', 1, (d-md)/sd from e, s)
     select event_id, side, position::integer position, round("value",6)+0.0::double "value" from r""",
)
def dense_features(spark, sf):
    events = S.table(spark, sf, "events").select(
        "event_id", "event_type", "value", F.hour("ts").cast("double").alias("hour"),
        F.dayofmonth("ts").cast("double").alias("day"),
    )
    dense = features.dense_features(events, ["event_type"], ["value"], [], ["hour", "day"])
    sides = dense.select(
        "event_id",
        F.explode(
            F.array(
                F.struct(F.lit("user").alias("side"), F.col("user_dense").alias("v")),
                F.struct(F.lit("item").alias("side"), F.col("item_dense").alias("v")),
            )
        ).alias("s"),
    ).select("event_id", "s.side", "s.v")
    return S.long_form(sides, ["event_id", "side"], "v")


def _jagged_events(spark, sf):
    events = S.table(spark, sf, "events").select(
        F.floor(F.col("event_id") / 512).alias("batch"), "event_id", "user_id",
        F.when(F.col("event_type") != "error", F.floor("value")).alias("item_id"),
        (F.col("event_type") == "purchase").cast("int").alias("label"),
    )
    return features.to_jagged(events, "batch", "event_id", ["user_id", "item_id"], "label")


@query(
    "first_batches",
    """select event_id // 512 batch, count(*) "rows", sum((event_type = 'purchase')::integer)::bigint positives
      from events group by 1 having batch < 3""",
)
def first_batches(spark, sf):
    """Rows and positives of the first three batches."""
    first = features.first_batches(_jagged_events(spark, sf), 3)
    return first.select(
        "batch", F.size("labels").cast("bigint").alias("rows"),
        F.aggregate("labels", F.lit(0).cast("bigint"), lambda n, x: n + x).alias("positives"),
    )


@query(
    "pair_shapes",
    """select event_id // 512 batch, count(*)::integer user_id_values_n,
      (count(*) filter (event_type <> 'error' and "value" is not null))::integer item_id_values_n, count(*)::integer labels_n,
      count(*) = count(*) filter (event_type <> 'error' and "value" is not null) agree from events group by 1""",
)
def pair_shapes(spark, sf):
    """Whether the values and labels of a batch have one length; a missing item makes a batch ragged."""
    found = checks.array_lengths(_jagged_events(spark, sf), ["user_id_values", "item_id_values", "labels"])
    return found.select("batch", "user_id_values_n", "item_id_values_n", "labels_n", "agree")


@query(
    "date_features",
    """with d as (select l_orderkey, l_linenumber, (l_shipdate::date - o_orderdate::date)::double n_days,
        (dayofweek(o_orderdate)+1)::double weekday from lineitem join orders on l_orderkey = o_orderkey),
      s as (select avg(n_days) m, stddev_samp(n_days) sd from d)
      select l_orderkey, l_linenumber, round((n_days-m)/sd, 6)+0.0::double days_scaled, weekday from d, s""",
)
def date_features(spark, sf):
    """Days from order to shipment, scaled, and the weekday of the order (1: Sunday)."""
    rows = S.table(spark, sf, "lineitem").join(S.table(spark, sf, "orders"), F.col("l_orderkey") == F.col("o_orderkey")).select(
        "l_orderkey", "l_linenumber", features.days_between("l_shipdate", "o_orderdate").alias("days"),
        F.dayofweek("o_orderdate").cast("double").alias("weekday"),
    )
    scaled = features.standard_scaled(rows, ["days"])["days"]
    return rows.select("l_orderkey", "l_linenumber", S.rounded(scaled).alias("days_scaled"), "weekday")


ITEM_TEXT = "'Department: ' || p_type || chr(10) || 'Aisle: ' || p_brand || chr(10) || 'Product: ' || p_name"


@query("item_text", f"select p_partkey product_id, {ITEM_TEXT} product_desc from part")
def item_text(spark, sf):
    return S.products(spark, sf).select("product_id", features.item_text().alias("product_desc"))


def text_sql(source: str, key: str, text: str, name: str = "tv") -> str:
    """CTEs ending in ``name`` (key, vec): hashed token vectors of unit length."""
    return f"""
      tok as (select {key}, unnest(regexp_split_to_array(lower({text}), '\\s+')) t from {source}),
      pl as (select {key}, ('0x'||substr(md5(t),1,8))::bigint % {TEXT_DIM} i,
        case when ('0x'||substr(md5(t),9,8))::bigint % 2 = 0 then 1.0::double else -1.0::double end s
        from tok where t <> ''),
      sm as (select {key}, i, sum(s) v from pl group by 1, 2),
      al as (select {key}, g.i, coalesce(v, 0.0::double) v from (select {key} from {source}) k
        cross join generate_series(0,{TEXT_DIM - 1}) g(i) left join sm using ({key}, i)),
      nm as (select {key}, sqrt(sum(v*v)) n from al group by 1),
      {name}_long as (select {key}, i, case when n = 0 then v else v/n end v from al join nm using ({key})),
      {name} as materialized (select {key}, list(v order by i) vec from {name}_long group by 1)"""


@query(
    "text_embed",
    f"""with {text_sql('documents', 'doc_id', '"text"')}
      select doc_id, i::integer position, {S.r6('v')} "value" from tv_long""",
)
def text_embed(spark, sf):
    vectors = features.text_vectors(S.table(spark, sf, "documents"), "doc_id", "text", TEXT_DIM)
    return S.long_form(vectors, ["doc_id"], "embedding")
