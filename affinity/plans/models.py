"""Towers, pair scoring, factor training, search and trees."""

from __future__ import annotations

import numpy as np
from pyspark.sql import functions as F

from affinity.functions.vectors import dot
from affinity.operators import factors, features, sampling, skew, softmax_trees, tower_training, towers, trees, trials
from affinity.plans import stand_ins as S
from affinity.plans.registry import query
from affinity.session import materialize


@query(
    "tower_forward",
    f"""with x as (select vec_id, unnest(embedding)::double v,
        generate_subscripts(embedding, 1)-1 i from embeddings),
      {S.layers_sql('o', 'x', 'vec_id', 5, [64, 8, 4], 1.0)}
      select vec_id, i::integer position, {S.r6('v')} "value" from o""",
)
def tower_forward(spark, sf):
    vectors = S.table(spark, sf, "embeddings")
    out = towers.tower(vectors, "vec_id", "embedding", towers.keyed_layers(5, [64, 8, 4]))
    return S.long_form(out, ["vec_id"], "embedding")


SEGMENTS = 5  # market segments in the customer table, one-hot encoded


@query(
    "tower_forward_dense",
    f"""with {S.seed_sql('s', '(select c_custkey user_id from customer)', 'user_id', 6, 4, 1.0)},
      seg as (select c_mktsegment, row_number() over (order by c_mktsegment)-1 j
        from (select distinct c_mktsegment from customer)),
      st as (select avg(c_acctbal) m, stddev_samp(c_acctbal) d from customer),
      x as (select user_id, i, v from s
        union all select c_custkey, 4+j, (c.c_mktsegment = seg.c_mktsegment)::integer::double
          from customer c, seg
        union all select c_custkey, {4 + SEGMENTS}, (c_acctbal-m)/d from customer, st),
      {S.layers_sql('o', 'x', 'user_id', 7, [4 + SEGMENTS + 1, 6, 3], 1.0)}
      select user_id, i::integer position, {S.r6('v')} "value" from o""",
)
def tower_forward_dense(spark, sf):
    customer = S.table(spark, sf, "customer").withColumnRenamed("c_custkey", "user_id")
    dense = features.dense_features(customer, ["c_mktsegment"], ["c_acctbal"], [], ["c_acctbal"])
    seeded = towers.seed_vectors(customer, "user_id", 4, 6)
    rows = dense.select("user_id", "user_dense").join(seeded, "user_id")
    layers = towers.keyed_layers(7, [4 + SEGMENTS + 1, 6, 3])
    out = towers.tower_with_dense(rows, "user_id", "embedding", "user_dense", layers)
    return S.long_form(out, ["user_id"], "embedding")


def indexed_vectors_sql(key: str, seed: int, net: int) -> str:
    return f"""{S.POS}, ix as materialized (select {key}, row_number() over
        (order by count(*) desc, {key}::varchar)-1 ix from pos group by 1),
      {S.seed_sql('s', 'ix', 'ix', seed, S.ID_DIM, 2.0)},
      {S.layers_sql('o', 's', 'ix', net, S.TOWER, 2.0)}"""


def _indexed_vectors(spark, sf, key, seed, net):
    """Tower output per id, from the embedding row at the id's dense index."""
    index = features.id_index(S.positives(spark, sf), key, "ix").drop("count")
    start = towers.seed_vectors(index, "ix", S.ID_DIM, seed, 2.0)
    out = towers.tower(start, "ix", "embedding", towers.keyed_layers(net, S.TOWER, 2.0))
    return index.join(out, "ix").drop("ix")


@query(
    "user_embeddings",
    f"""with {indexed_vectors_sql('user_id', S.USER_SEED, S.USER_NET)}
      select user_id, i::integer position, {S.r6('v')} "value" from o join ix using (ix)""",
)
def user_embeddings(spark, sf):
    vectors = _indexed_vectors(spark, sf, "user_id", S.USER_SEED, S.USER_NET)
    return S.long_form(vectors, ["user_id"], "embedding")


@query(
    "item_embeddings",
    f"""with {indexed_vectors_sql('product_id', S.ITEM_SEED, S.ITEM_NET)}
      select product_id, p_brand aisle, p_type department, i::integer position, {S.r6('v')} "value"
      from o join ix using (ix) join part on product_id = p_partkey""",
)
def item_embeddings(spark, sf):
    vectors = _indexed_vectors(spark, sf, "product_id", S.ITEM_SEED, S.ITEM_NET)
    enriched = vectors.join(S.products(spark, sf), "product_id")
    return S.long_form(enriched, ["product_id", "aisle", "department"], "embedding")


@query(
    "score_pairs",
    f"""with {S.PAIRS}, {S.USER_VEC}, {S.ITEM_VEC}, z as (select user_id, product_id, "label",
        1/(1+exp(-list_dot_product(u.vec, i.vec))) p from pairs join user_vec u using (user_id)
        join item_vec i using (product_id))
      select user_id, product_id, "label", (p >= 0.7::double)::bigint predicted_classes,
        {S.r6('p')} prediction_prob from z""",
)
def score_pairs(spark, sf):
    scored = towers.score_pairs(
        S.pairs(spark, sf), S.user_vectors(spark, sf), S.item_vectors(spark, sf), threshold=0.7
    )
    return scored.select(
        "user_id", "product_id", "label", "predicted_classes",
        S.rounded("prediction_prob").alias("prediction_prob"),
    )


@query(
    "ranker_forward",
    f"""with {S.POS}, {S.USER_VEC}, {S.ITEM_VEC},
      x as (select user_id * 100000000 + product_id pair, unnest(u.vec || i.vec) v,
        generate_subscripts(u.vec || i.vec, 1)-1 i from pos join user_vec u using (user_id)
        join item_vec i using (product_id)),
      {S.layers_sql('o', 'x', 'pair', 13, [8, 5, 1], 2.0, last_relu=False)}
      select pair // 100000000 user_id, pair % 100000000 product_id, {S.r6('v')} logit from o""",
)
def ranker_forward(spark, sf):
    ranked = towers.rank_pairs(
        S.positives(spark, sf), S.user_vectors(spark, sf), S.item_vectors(spark, sf),
        towers.keyed_layers(13, [8, 5, 1], 2.0),
    )
    return ranked.select("user_id", "product_id", S.rounded("logit").alias("logit"))


@query(
    "score_with_model",
    f"""select o_orderkey order_id, {S.r6('1/(1+exp(-(o_totalprice/100000 - 1.5::double)))')} prediction_prob from orders""",
)
def score_with_model(spark, sf):
    """Any model over batches of rows; here one of a single price."""

    def load():
        return lambda rows: 1 / (1 + np.exp(-(rows["o_totalprice"].to_numpy() / 100000 - 1.5)))

    orders = S.table(spark, sf, "orders").select("o_orderkey", "o_totalprice")
    scored = towers.predict_with(orders, ["o_totalprice"], load)
    return scored.select(F.col("o_orderkey").alias("order_id"), S.rounded("prediction_prob").alias("prediction_prob"))


@query(
    "embed_with_model",
    """select p_partkey product_id, position::integer position, (case position when 0 then length(p_name)
        else length(p_name) - length(replace(p_name, 'e', '')) end)::double "value" from part, range(2) r(position)""",
)
def embed_with_model(spark, sf):
    """Any text model over batches; here the length of a name and its letters e."""

    def load():
        return lambda texts: np.array([[len(t), t.count("e")] for t in texts], dtype=float)

    names = S.products(spark, sf).select("product_id", "product_name")
    found = features.embed_with(names, "product_name", load)
    return S.long_form(found, ["product_id"], "embedding")


EPOCH_DIM, EPOCH_LR = 4, 0.1


def epoch_sql() -> str:
    dims = range(EPOCH_DIM)

    def start(side, key):
        cols = ", ".join(
            f"({S.uniform(S.SEED, repr(side), key, j)}-0.5) v{j}" for j in dims
        )
        return f"select {key} id, {cols} from (select distinct {key} from pairs)"

    dot = " + ".join(f"u.v{j}*w.v{j}" for j in dims)
    g = f"1/(1+exp(-({dot})))-\"label\""
    grads = {
        "user": ", ".join(f"sum(({g})*w.v{j}) g{j}" for j in dims),
        "item": ", ".join(f"sum(({g})*u.v{j}) g{j}" for j in dims),
    }
    joined = "from pairs join us u on u.id = user_id join vs w on w.id = product_id"
    square = "(" + " + ".join(f"g{j}*g{j}" for j in dims) + f")/{EPOCH_DIM}"
    rows = " union all ".join(
        f"select '{side}' side, id, {j}::integer \"position\", "
        + S.r6(f"v{j} - {EPOCH_LR}::double/(sqrt({square})+1e-8::double)*g{j}")
        + f' "value" from {state} join {side}_g using (id)'
        for side, state in (("user", "us"), ("item", "vs"))
        for j in dims
    )
    return f"""with {S.PAIRS}, us as materialized ({start('user', 'user_id')}),
      vs as materialized ({start('item', 'product_id')}),
      user_g as materialized (select user_id id, {grads['user']} {joined} group by 1),
      item_g as materialized (select product_id id, {grads['item']} {joined} group by 1)
      {rows}"""


@query("factor_epoch", epoch_sql())
def factor_epoch(spark, sf):
    pairs = S.frozen_pairs(spark, sf)
    state = factors.initial_state(pairs, EPOCH_DIM, S.SEED)
    stepped = factors.epoch(pairs, state, EPOCH_DIM, EPOCH_LR)
    return S.long_form(stepped, ["side", "id"], "v")


NET_DIM, NET_WIDTH, NET_STEPS, NET_LR, NET_VECTOR_LR = 3, 2, 2, 0.05, 0.1


def tower_steps_sql() -> str:
    """Two training steps of one-layer towers, written out element by element."""
    dims, width = range(NET_DIM), range(NET_WIDTH)
    weights = {side: [f"{side}w{i}_{j}" for i in dims for j in width] + [f"{side}b{j}" for j in width] for side in "ui"}
    every = weights["u"] + weights["i"]
    start = []
    for n, side in enumerate("ui"):
        start += [f"({S.uniform(S.SEED + n, 0, i, j)}-0.5)*2 {side}w{i}_{j}" for i in dims for j in width]
        start += [f"({S.uniform(S.SEED + n, 0, -1, j)}-0.5)*2 {side}b{j}" for j in width]
    start += [f"0.0::double {k}_{x}" for x in every for k in "mv"]
    parts = [S.PAIRS, "rows_ as (select count(*) n from pairs)", f"net0 as materialized (select {', '.join(start)})"]
    for side, name, key in (("u", "user", "user_id"), ("i", "item", "product_id")):
        cols = ", ".join(f"({S.uniform(S.SEED, repr(name), key, j)}-0.5)*2 v{j}" for j in dims)
        parts.append(f"{side}0 as materialized (select {key} id, {cols}, 0.0::double acc from (select distinct {key} from pairs))")
    for k in range(NET_STEPS):
        hidden = ", ".join(
            "greatest(" + "+".join(f"{side}.v{i}*{side}w{i}_{j}" for i in dims) + f"+{side}b{j}, 0) {side}h{j}" for side in "ui" for j in width
        )
        vectors = ", ".join(f"{side}.v{j} {side}{j}" for side in "ui" for j in dims)
        logit = "+".join(f"uh{j}*ih{j}" for j in width)
        back = ", ".join(f"case when {a}h{j} > 0 then e*{b}h{j} else 0 end {a}d{j}" for a, b in ("ui", "iu") for j in width)
        parts.append(f"""f{k} as materialized (select *, {back} from (select *, (1/(1+exp(-({logit})))-"label")/n e from
          (select user_id, product_id, "label", n, net{k}.*, {vectors}, {hidden} from pairs join u{k} u on u.id = user_id
            join i{k} i on i.id = product_id, net{k}, rows_)))""")
        sums = [f"sum({side}d{j}*{side}{i}) {side}w{i}_{j}" for side in "ui" for i in dims for j in width]
        sums += [f"sum({side}d{j}) {side}b{j}" for side in "ui" for j in width]
        parts.append(f"g{k} as materialized (select {', '.join(sums)} from f{k})")
        moments = ", ".join(f"0.9::double*n.m_{x}+0.1::double*g.{x} m_{x}, 0.999::double*n.v_{x}+0.001::double*g.{x}*g.{x} v_{x}" for x in every)
        parts.append(f"a{k} as (select {moments}, {', '.join(f'n.{x}' for x in every)} from net{k} n, g{k} g)")
        t = k + 1
        moved = ", ".join(
            f"{x}-{NET_LR}::double*(m_{x}/(1-0.9::double**{t}))/(sqrt(v_{x}/(1-0.999::double**{t}))+1e-8::double) {x}, m_{x}, v_{x}" for x in every
        )
        parts.append(f"net{t} as materialized (select {moved} from a{k})")
        for side, key in (("u", "user_id"), ("i", "product_id")):
            grads = ", ".join("sum(" + "+".join(f"{side}d{j}*{side}w{i}_{j}" for j in width) + f") g{i}" for i in dims)
            square = "(" + "+".join(f"g{i}*g{i}" for i in dims) + f")/{NET_DIM}"
            new = ", ".join(f"v{i}-{NET_VECTOR_LR}::double/(sqrt(acc+{square})+1e-8::double)*g{i} v{i}" for i in dims)
            parts.append(f"{side}g{k} as (select {key} id, {grads} from f{k} group by 1)")
            parts.append(f"{side}{t} as materialized (select id, {new}, acc+{square} acc from {side}{k} join {side}g{k} using (id))")
    last = NET_STEPS
    rows = [
        f"select '{name}' part, id, {j}::integer \"position\", {S.r6(f'v{j}')} \"value\" from {side}{last}"
        for side, name in (("u", "user"), ("i", "item")) for j in dims
    ]
    for side, name in (("u", "user layer"), ("i", "item layer")):
        places = [(i, j, f"{side}w{i}_{j}") for i in dims for j in width] + [(-1, j, f"{side}b{j}") for j in width]
        rows += [f"select '{name}', {i}::bigint, {j}::integer, {S.r6(x)} from net{last}" for i, j, x in places]
    return f"with {', '.join(parts)} {' union all '.join(rows)}"


@query("tower_steps", tower_steps_sql())
def tower_steps(spark, sf):
    """Id vectors and layers after two training steps over all pairs; the net is stored and read in between."""
    pairs = S.frozen_pairs(spark, sf)
    state = materialize(factors.initial_state(pairs, NET_DIM, S.SEED, 2.0), "tower-vectors")
    net = tower_training.initial_net(NET_DIM, [NET_WIDTH], S.SEED, 2.0)
    for _ in range(NET_STEPS):
        state, net, _ = tower_training.step(pairs, state, net, NET_DIM, NET_LR, NET_VECTOR_LR)
        net = tower_training.read_net(materialize(net.table(spark), "net"))
    vectors = S.long_form(state, ["side", "id"], "v").withColumnRenamed("side", "part")
    layers = net.table(spark).select(
        F.concat("side", F.lit(" layer")).alias("part"), F.col("row").cast("bigint").alias("id"),
        F.col("col").alias("position"), S.rounded("value").alias("value"),
    )
    return vectors.unionByName(layers)


HOT_DETAIL = S.DETAIL + """, d as materialized (select order_id, add_to_cart_order, user_id,
  case when order_id % 3 = 0 then (select min(p_partkey) from part) when order_id % 100 = 1 then -order_id else product_id end product_id
  from detail)"""


@query(
    "score_pairs_hot",
    f"""with {HOT_DETAIL}, {S.USER_VEC}, {S.ITEM_VEC} select order_id, add_to_cart_order, d.user_id, d.product_id,
      {S.r6('list_dot_product(u.vec, i.vec)')} logit
      from d left join user_vec u on u.user_id = d.user_id left join item_vec i on i.product_id = d.product_id""",
)
def score_pairs_hot(spark, sf):
    """A third of the rows have one item, some have an unknown one; every row comes back."""
    items = S.item_vectors(spark, sf)
    hot = S.products(spark, sf).agg(F.min("product_id")).first()[0]
    item = F.when(F.col("order_id") % 3 == 0, hot).when(F.col("order_id") % 100 == 1, -F.col("order_id")).otherwise(F.col("product_id"))
    rows = materialize(
        S.detail(spark, sf).select("order_id", "add_to_cart_order", "user_id", item.alias("product_id")), "hot-pairs"
    )
    vectors = [materialize(v, "vectors") for v in (S.user_vectors(spark, sf), items)]
    for key, name, v in zip(("user_id", "product_id"), ("u", "w"), vectors):
        rows = skew.lookup(rows, v.select(key, F.col("embedding").alias(name)), key, how="left")
    return rows.select("order_id", "add_to_cart_order", "user_id", "product_id", S.rounded(dot("u", "w")).alias("logit"))


def _parts(spark, sf):
    split = materialize(S.split(spark, sf), "split")
    return [split.where(F.col("group") == g) for g in ("train", "val", "test")]


@query("factor_fit")
def factor_fit(spark, sf):
    train, _, _ = _parts(spark, sf)
    fitted = factors.fit(train, dim=8, epochs=2, seed=S.SEED)
    return S.long_form(fitted.state, ["side", "id"], "v", 4)


@query("train_log")
def train_log(spark, sf):
    train, val, test = _parts(spark, sf)
    return factors.fit(
        train, dim=8, epochs=2, seed=S.SEED, validation=val, test=test
    ).log_table(spark)


@query("param_search")
def param_search(spark, sf):
    train, val, test = _parts(spark, sf)
    drawn = factors.draw_trials(2, S.SEED, [4, 8], (5e-3, 5e-1))
    return factors.search(train, val, test, drawn, epochs=1)


HALVED = [{"trial": 0, "dim": 2, "lr": 0.05}, {"trial": 1, "dim": 3, "lr": 0.2}]


def halving_sql() -> str:
    """Two epochs of each trial written out; the second rung is shown for the trial with the lower first loss."""
    parts = [S.SPLIT, """train as materialized (select * from split where "group" = 'train')""",
             """val as materialized (select * from split where "group" = 'val')""",
             """test as materialized (select * from split where "group" = 'test')"""]
    for t in HALVED:
        n, dims = t["trial"], range(t["dim"])
        dot = "+".join(f"u.v{j}*w.v{j}" for j in dims)
        for side, name, key in (("u", "user", "user_id"), ("w", "item", "product_id")):
            cols = ", ".join(f"({S.uniform(S.SEED, repr(name), key, j)}-0.5) v{j}" for j in dims)
            parts.append(f"{side}{n}_0 as materialized (select {key} id, {cols}, 0.0::double acc from (select distinct {key} from train))")
        for k in (0, 1):
            joined = f"join u{n}_{k} u on u.id = user_id join w{n}_{k} w on w.id = product_id"
            for side, key, other in (("u", "user_id", "w"), ("w", "product_id", "u")):
                grads = ", ".join(f'sum((1/(1+exp(-({dot})))-"label")*{other}.v{j}) g{j}' for j in dims)
                square = "(" + "+".join(f"g{j}*g{j}" for j in dims) + f")/{len(dims)}"
                new = ", ".join(f"v{j}-{t['lr']}::double/(sqrt(acc+{square})+1e-8::double)*g{j} v{j}" for j in dims)
                parts.append(f"{side}g{n}_{k} as materialized (select {key} id, {grads} from train {joined} group by 1)")
                parts.append(f"{side}{n}_{k + 1} as materialized (select id, {new}, acc+{square} acc from {side}{n}_{k} join {side}g{n}_{k} using (id))")
            joined = f"join u{n}_{k + 1} u on u.id = user_id join w{n}_{k + 1} w on w.id = product_id"
            loss = f'avg(greatest({dot},0.0::double)-({dot})*"label"+ln(1+exp(-abs({dot}))))'
            for rows in ("val", "test"):
                parts.append(f"{rows}{n}_{k + 1} as materialized (select {loss} l from {rows} {joined})")
    first = " union all ".join(f"select {t['trial']} trial, {t['dim']} dim, {t['lr']}::double lr, l from val{t['trial']}_1" for t in HALVED)
    second = " union all ".join(
        f"select {t['trial']} trial, {t['dim']} dim, {t['lr']}::double lr, v.l, t.l tl from val{t['trial']}_2 v, test{t['trial']}_2 t" for t in HALVED
    )
    parts.append(f"one as materialized ({first})")
    parts.append("won as (select trial from one order by l, trial limit 1)")
    return f"""with {', '.join(parts)} select trial::integer trial, dim::integer dim, lr, 1 rung, 1 epochs, {S.r6('l')} val_loss,
        trial = (select trial from won) kept, false best, null::double test_loss from one
      union all select trial::integer, dim::integer, lr, 2, 2, {S.r6('l')}, true, true, {S.r6('tl')} from ({second})
        where trial = (select trial from won)"""


@query("trials_halving", halving_sql())
def trials_halving(spark, sf):
    """Two trials train together; the one with the lower validation loss trains on and is tested."""
    found = trials.search(*_parts(spark, sf), HALVED, epochs=1, seed=S.SEED)
    return found.withColumns({c: S.rounded(c) for c in ("val_loss", "test_loss")})


@query("als_factors")
def als_factors(spark, sf):
    return factors.als_factors(S.positives(spark, sf)).select(
        "side", "id", F.size("embedding").alias("dim")
    )


TREE_CUTS = {"price": [50_000.0, 100_000.0, 150_000.0, 200_000.0], "lines": [1.0, 3.0, 5.0], "year": [1993.0, 1995.0, 1997.0]}


def stump_sql() -> str:
    """One round of stumps for three classes: the best split of each from sums at the cut points."""
    cuts = [(n, f, c) for n, f in enumerate(TREE_CUTS) for c in TREE_CUTS[f]]
    sums = " union all ".join(
        f"select k, {n} f, {c}::double c, sum(g) filter ({f} <= {c}) gl, sum(h) filter ({f} <= {c}) hl, sum(g) gt, sum(h) ht from r group by 1"
        for n, f, c in cuts
    )
    value = "case best.f " + " ".join(f"when {n} then {f}" for n, f in enumerate(TREE_CUTS)) + " end"
    return f"""with o as materialized (select o_orderkey order_id, o_totalprice price, year(o_orderdate)::double "year", count(*)::double lines,
        case any_value(o_orderstatus) when 'F' then 0 when 'O' then 1 else 2 end target
        from orders join lineitem on l_orderkey = o_orderkey group by 1, 2, 3),
      r as materialized (select *, 1/3.0::double - (target = k)::integer g, 2/9.0::double h from o, range(3) t(k)),
      sums as ({sums}),
      gains as (select *, round(gl*gl/(hl+1) + (gt-gl)*(gt-gl)/(ht-hl+1) - gt*gt/(ht+1), 9) gain from sums
        where hl >= 0.001 and ht-hl >= 0.001),
      best as (select * from (select *, row_number() over (partition by k order by gain desc, f, c) rn from gains) where rn = 1),
      s as (select order_id, o.target, best.k, 0.3::double * case when {value} <= c then -gl/(hl+1) else -(gt-gl)/(ht-hl+1) end s from o, best),
      p as (select order_id, k, exp(s) / sum(exp(s)) over (partition by order_id) p from s)
      select order_id, {', '.join(f"{S.r6(f'max(p) filter (k = {k})')} p{k}" for k in range(3))} from p group by 1"""


def _order_rows(spark, sf):
    """Order status as one of three classes, with order columns."""
    per_order = S.table(spark, sf, "lineitem").groupBy(F.col("l_orderkey").alias("order_id")).agg(
        F.count("*").alias("lines"), F.sum("l_quantity").alias("quantity"), F.avg("l_discount").alias("discount"),
    )
    status = F.when(F.col("o_orderstatus") == "F", 0).when(F.col("o_orderstatus") == "O", 1)
    orders = S.table(spark, sf, "orders").select(
        F.col("o_orderkey").alias("order_id"), F.col("o_totalprice").alias("price"),
        F.year("o_orderdate").alias("year"), status.otherwise(2).alias("target"),
    )
    return orders.join(per_order, "order_id")


@query("softmax_stumps", stump_sql())
def softmax_stumps(spark, sf):
    """Class probabilities of all orders after one round of trees with one split."""
    rows = materialize(_order_rows(spark, sf), "tree-orders")
    model = softmax_trees.fit(
        rows, list(TREE_CUTS), labels=3, max_depth=1, rounds=1, cuts=list(TREE_CUTS.values())
    )
    found = model.predict(rows.select("order_id", *TREE_CUTS))
    return found.select("order_id", *[S.rounded(F.col("probabilities")[k]).alias(f"p{k}") for k in range(3)])


@query("gbt_classify")
def gbt_classify(spark, sf):
    """Three-way order status from order columns, held-out rows."""
    per_order = S.table(spark, sf, "lineitem").groupBy(F.col("l_orderkey").alias("order_id")).agg(
        F.count("*").alias("lines"), F.sum("l_quantity").alias("quantity"),
        F.avg("l_discount").alias("discount"),
    )
    status = F.when(F.col("o_orderstatus") == "F", 0).when(F.col("o_orderstatus") == "O", 1)
    orders = S.table(spark, sf, "orders").select(
        F.col("o_orderkey").alias("order_id"), F.col("o_totalprice").alias("price"),
        F.year("o_orderdate").alias("year"), status.otherwise(2).alias("target"),
    )
    rows = materialize(
        sampling.split_by_hash(
            orders.join(per_order, "order_id"), ["order_id"], {"train": 0.7, "valid": 0.3}
        ),
        "tree-rows",
    )
    return trees.boosted_trees(
        rows.where("`group` = 'train'"),
        rows.where("`group` = 'valid'").select("order_id", "price", "year", "lines", "quantity",
                                               "discount"),
        ["price", "year", "lines", "quantity", "discount"],
        labels=3, max_depth=3, rounds=3,
    ).select("order_id", "prediction")
