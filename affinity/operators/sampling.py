"""Negative sampling and splits. All randomness is keyed by row values (see ``hashing``)."""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from affinity.functions.hashing import TWO_32, hex_u32, md5_hex, md5_uniform
from affinity.operators.ranking import dense_index, number_in_groups
from affinity.session import materialize, parallelism

# per round: a multiplier for the keys, and a prime above any catalogue size that spreads neighbours
SHUFFLE_ROUNDS = (
    (3, 2147483629), (5, 2147483587), (7, 2147483579), (11, 2147483563),
    (13, 2147483549), (17, 2147483543), (19, 2147483497), (23, 2147483489),
)
MAX_ITEMS = 2147483488
MERSENNE_31 = 2147483647
DRAWS_PER_BLOCK = 65536
SHELF_BYTES = 64 << 20  # of a catalogue that tasks hold
WHOLE = ("tinyint", "smallint", "int", "bigint")


def _round_keys(size: str) -> Column:
    """Factor, offset, shift (all in [0, size)) and multiplier of every round, from ``_h0`` .. ``_h3``."""
    p = F.lit(MERSENNE_31)
    return F.array(
        *[
            F.struct(
                (F.lit(prime).cast("bigint") % F.col(size)).alias("factor"),
                ((F.col("_h0") * c + F.col("_h3")) % p % F.col(size)).alias("offset"),
                ((F.col("_h0") * c + F.col("_h1")) % p % F.col(size)).alias("shift"),
                ((F.col("_h2") * c + F.col("_h3")) % p).alias("mul"),
            )
            for c, prime in SHUFFLE_ROUNDS
        ]
    )


def _shuffled(draw: str, size: str) -> Column:
    """The image of ``draw`` under a permutation of ``[0, size)`` keyed by ``_keys``.

    Each round first sends x to (factor * x + offset) mod size, which takes neighbours far apart;
    then, as in a swap-or-not shuffle, it pairs x with (shift - x) mod size and swaps the two when
    a keyed bit of the larger one is set. The factor comes from a prime above ``MAX_ITEMS``, so both
    steps are bijections for any size up to it: distinct draws give distinct positions and no
    de-duplication is needed.
    """
    n, p = F.col(size), F.lit(MERSENNE_31)

    def swap(before, key):
        x = (key["factor"] * before + key["offset"]) % n
        pair = (key["shift"] + n - x) % n
        bit = (key["mul"] * F.greatest(x, pair) + F.col("_h0")) % p % 2
        return F.when(bit == 1, pair).otherwise(x)

    # never null; the coalesce keeps a null check (a second evaluation) out of the join
    return F.coalesce(F.aggregate("_keys", F.col(draw), swap), F.lit(-1))


def negative_samples(
    pairs: DataFrame,
    catalogue: DataFrame,
    user: str = "user_id",
    item: str = "product_id",
    seed: int = 42,
    per_positive: int = 1,
    clamp: bool = False,
    exclude: str = "user",
    buckets: int = 64,
    draws_per_task: int = 1_000_000,
) -> DataFrame:
    """Uniform negatives without replacement: ``per_positive`` for each positive of a user.

    ``catalogue`` holds the distinct item ids. A user draws catalogue positions along a keyed
    permutation; of the first ``wanted + owned`` positions at most ``owned`` can be positives,
    so the rows that survive the anti-join always suffice and the first ``wanted`` are kept.
    The work is linear in the positives, also for users that own most of the catalogue.

    Positives outside the catalogue count for the number of negatives but ban nothing. A user
    that wants more items than it does not own raises, or takes all of them with ``clamp``.
    Users of up to ``draws_per_task`` draws are drawn for where their pairs meet, larger ones in blocks.
    ``exclude="bucket"`` rejects the items that are positive for any user in the same hash bucket
    of users instead of only those of the user; ``buckets`` should grow with the users, so that
    a bucket holds about one batch of pairs.
    """
    shelf = dense_index(catalogue.select(item), [item], "_ix")
    kinds = dict(pairs.dtypes)
    if exclude == "bucket" or kinds[user] not in (*WHOLE, "string"):
        return _draws_in_blocks(pairs, catalogue, shelf, user, item, seed, per_positive, clamp, exclude, buckets, draws_per_task)
    n_items = shelf.count()
    if n_items > MAX_ITEMS:
        raise ValueError(f"a catalogue of more than {MAX_ITEMS} items")
    owned = pairs.groupBy(user).agg(F.count("*").alias("_owned"))
    many = F.col("_owned") * (per_positive + 1) > draws_per_task
    hot = materialize(owned.where(many | F.col(user).isNull()).select(F.col(user).alias("_hot")), "hot-users")
    if hot.isEmpty():
        return _draws_in_tasks(pairs, shelf, user, item, seed, n_items, per_positive, clamp)
    is_hot = F.col(user).eqNullSafe(F.col("_hot"))
    some, others = pairs.join(hot, is_hot, "left_semi"), pairs.join(hot, is_hot, "left_anti")
    return _draws_in_tasks(others, shelf, user, item, seed, n_items, per_positive, clamp).unionByName(
        _draws_in_blocks(some, catalogue, shelf, user, item, seed, per_positive, clamp, exclude, buckets, draws_per_task)
    )


def _positions(users: list, owner: np.ndarray, draw: np.ndarray, n_items: int, seed: int) -> np.ndarray:
    """The images of draws under the permutations of their owners (places in ``users``); see ``_shuffled``."""
    p = MERSENNE_31
    digests = [hashlib.md5(f"{seed}|{u}".encode()).hexdigest() for u in users]
    h0, h1, h2, h3 = (np.array([int(d[8 * j : 8 * j + 8], 16) % p for d in digests], np.int64) for j in range(4))
    at, low = draw, h0[owner]
    for c, prime in SHUFFLE_ROUNDS:
        offset, shift, mul = (h0 * c + h3) % p % n_items, (h0 * c + h1) % p % n_items, (h2 * c + h3) % p
        at = ((prime % n_items) * at + offset[owner]) % n_items
        pair = (shift[owner] + n_items - at) % n_items
        at = np.where((mul[owner] * np.maximum(at, pair) + low) % p % 2 == 1, pair, at)
    return at


def _draws_in_tasks(
    pairs: DataFrame, shelf: DataFrame, user: str, item: str, seed: int, n_items: int, per_positive: int, clamp: bool
) -> DataFrame:
    """Negatives of users whose draws fit a task: their pairs meet in one shuffle and are drawn for in bulk.

    A catalogue within a checked size is held by every task; else joins give items their positions and back.
    """
    item_kind, user_kind = dict(shelf.dtypes)[item], dict(pairs.dtypes)[user]
    held = None
    if item_kind in WHOLE and dict(pairs.dtypes)[item] in WHOLE and 8 * n_items <= SHELF_BYTES:
        column = shelf.select(F.col(item).cast("bigint").alias("i")).toArrow()["i"]
        if column.null_count == 0:
            held = pairs.sparkSession.sparkContext.broadcast(np.sort(column.to_numpy()))
    if held is not None:
        rows = pairs.select(F.col(user).alias("u"), F.col(item).cast("bigint").alias("x"))
    else:
        rows = pairs.select(user, item).join(shelf, item, "left").select(F.col(user).alias("u"), F.col("_ix").alias("x"))

    def negatives(users: pa.Array, x: pa.Array):
        ends = np.flatnonzero(np.append(pc.not_equal(users[1:], users[:-1]).to_numpy(zero_copy_only=False), True)) + 1
        names = users.take(pa.array(ends - 1))
        owned = np.diff(np.append(0, ends))
        owner = np.repeat(np.arange(len(ends)), owned)
        inside = x.is_valid().to_numpy(zero_copy_only=False)
        at = x.fill_null(0).to_numpy()
        if held is not None and n_items:
            place = np.minimum(np.searchsorted(held.value, at), n_items - 1)
            inside &= held.value[place] == at
            at = place
        banned = np.bincount(owner[inside], minlength=len(ends))
        wanted, free = owned * per_positive, n_items - banned
        if clamp:
            wanted = np.minimum(wanted, free)
        elif (wanted > free).any():
            raise ValueError(f"too few unseen items for user {names[int((wanted > free).argmax())].as_py()}")
        draws = wanted + banned
        begin = np.cumsum(draws) - draws
        who = np.repeat(np.arange(len(ends)), draws)
        drawn = _positions(names.to_pylist(), who, np.arange(len(who)) - begin[who], n_items, seed)
        taken = np.unique(owner[inside] * n_items + at[inside])
        key = who * n_items + drawn
        unseen = np.ones(len(key), bool)
        if len(taken):
            unseen = taken[np.minimum(np.searchsorted(taken, key), len(taken) - 1)] != key
        so_far = np.cumsum(unseen)
        before = np.append(0, so_far)[begin]
        keep = unseen & (so_far - before[who] <= wanted[who])
        found = drawn[keep] if held is None else held.value[drawn[keep]]
        return pa.RecordBatch.from_arrays([names.take(pa.array(who[keep])), pa.array(found, pa.int64())], names=["u", "x"])

    def run(batches):
        users, x = None, None  # of the last user, who may go on
        for batch in batches:
            if not batch.num_rows:
                continue
            u, v = batch.column("u"), batch.column("x")
            if users is not None:
                u, v = pa.concat_arrays([users, u]), pa.concat_arrays([x, v])
            own = pc.equal(u, u[-1]).to_numpy(zero_copy_only=False)
            cut = int(own.argmax())
            if cut:
                yield negatives(u.slice(0, cut), v.slice(0, cut))
            users, x = u.slice(cut), v.slice(cut)
        if users is not None:
            yield negatives(users, x)

    dealt = rows.repartition(parallelism(pairs.sparkSession), "u").sortWithinPartitions("u")
    found = dealt.mapInArrow(run, f"u {user_kind}, x bigint")
    if held is not None:
        return found.select(F.col("u").alias(user), F.col("x").cast(item_kind).alias(item), F.lit(0).alias("label"))
    return found.join(shelf.withColumnRenamed("_ix", "x"), "x").select(F.col("u").alias(user), item, F.lit(0).alias("label"))


def _draws_in_blocks(
    pairs: DataFrame, catalogue: DataFrame, shelf: DataFrame, user: str, item: str, seed: int, per_positive: int,
    clamp: bool, exclude: str, buckets: int, draws_per_task: int,
) -> DataFrame:
    """Negatives of users of any size: blocks of draws are the unit of work, and joins find the positives among them."""
    spark = pairs.sparkSession
    n_items = shelf.agg(F.count("*").alias("n")).scalar()
    n_items = F.when(n_items <= MAX_ITEMS, n_items).otherwise(
        F.raise_error(F.lit(f"a catalogue of more than {MAX_ITEMS} items")).cast("bigint")
    )

    inside = pairs.join(catalogue.select(item), item, "left_semi")
    owned = pairs.groupBy(user).agg(F.count("*").alias("_owned"))
    if exclude == "bucket":
        bucket = F.pmod(F.conv(F.substring(md5_hex(seed, user), 1, 8), 16, 10).cast("bigint"),
                        F.lit(buckets)).alias("_scope")
        banned = inside.select(bucket, item).distinct()
        owned = owned.select("*", bucket)
    else:
        banned = inside.select(F.col(user).alias("_scope"), item)
        owned = owned.withColumn("_scope", F.col(user))
    banned_counts = banned.groupBy("_scope").agg(F.count("*").alias("_banned"))
    owned = owned.join(banned_counts, "_scope", "left").fillna(0, ["_banned"])

    wanted = F.col("_owned") * per_positive
    free = F.col("_items") - F.col("_banned")
    users = owned.withColumn("_items", n_items)
    if clamp:
        users = users.withColumn("_wanted", F.least(wanted, free))
    else:
        short = F.concat(F.lit("too few unseen items for user "), F.col(user).cast("string"))
        users = users.withColumn(
            "_wanted", F.when(wanted <= free, wanted).otherwise(F.raise_error(short))
        )
    users = users.withColumn("_draws", F.col("_wanted") + F.col("_banned"))

    # a block of draws is the unit of work, so a user with very many spreads over the tasks
    blocks = (
        users.where(F.col("_draws") > 0)
        .withColumn(
            "_first",
            F.explode(F.sequence(F.lit(0), F.col("_draws") - 1, F.lit(DRAWS_PER_BLOCK))),
        )
        .withColumn("_last", F.least(F.col("_first") + DRAWS_PER_BLOCK, F.col("_draws")) - 1)
        .repartition(parallelism(spark), user, "_first")
        .withColumn("_digest", md5_hex(seed, user))
        .withColumns({f"_h{j}": hex_u32(F.col("_digest"), j) % MERSENNE_31 for j in range(4)})
        .withColumn("_keys", _round_keys("_items"))
    )
    drawn = blocks.withColumn("_draw", F.explode(F.sequence("_first", "_last"))).select(
        user, "_scope", "_wanted", "_draws", "_draw", _shuffled("_draw", "_items").alias("_ix")
    )
    unseen = drawn.join(shelf, "_ix").join(banned, ["_scope", item], "left_anti")
    return _first_draws(unseen, user, draws_per_task).select(
        user, item, F.lit(0).alias("label")
    )


def _first_draws(unseen: DataFrame, user: str, draws_per_task: int) -> DataFrame:
    """The first ``_wanted`` rows of each user by ``_draw``, in slots of ``draws_per_task``."""
    slot = [user, "_slot"]
    slotted = unseen.withColumn("_slot", F.floor(F.col("_draw") / draws_per_task))
    in_slot = Window.partitionBy(*slot)
    numbered = slotted.repartition(*slot).withColumn(
        "_nth", F.row_number().over(in_slot.orderBy("_draw"))
    )
    earlier = Window.partitionBy(user).orderBy("_slot").rowsBetween(
        Window.unboundedPreceding, -1
    )
    offsets = (
        slotted.where(F.col("_draws") > draws_per_task)
        .groupBy(*slot)
        .agg(F.count("*").alias("_n"))
        .withColumn("_before", F.sum("_n").over(earlier))
        .drop("_n")
    )
    return numbered.join(offsets, slot, "left").where(
        F.col("_nth") + F.coalesce("_before", F.lit(0)) <= F.col("_wanted")
    )


def training_pairs(positive: DataFrame, negative: DataFrame) -> DataFrame:
    return positive.unionByName(negative)


def split_group(number: Column, total: Column) -> Column:
    """train for the first row or a fraction under 0.8, val under 0.9, else test."""
    fraction = number / total
    return (
        F.when(number == 1, "train")
        .when(fraction < 0.8, "train")
        .when(fraction < 0.9, "val")
        .otherwise("test")
    )


def split_per_user(
    pairs: DataFrame,
    user: str = "user_id",
    item: str = "product_id",
    seed: int = 42,
    by: list[str] | None = None,
    **limits,
) -> DataFrame:
    """``pairs`` with a ``group`` column, each user's rows in keyed random order.

    ``by`` adds columns to the stratum (``["label"]`` splits positives and negatives apart).
    """
    numbered = number_in_groups(
        pairs,
        [user, *(by or [])],
        hex_u32(F.col("_hash")) / F.lit(TWO_32),
        ["_hash", item],
        "_number",
        "_total",
        derived={"_hash": md5_hex(seed, user, item)},
        **limits,
    )
    return numbered.withColumn("group", split_group(F.col("_number"), F.col("_total"))).drop(
        "_hash", "_number", "_total"
    )


def split_by_hash(
    df: DataFrame, key: list[str], weights: dict[str, float], seed: int = 42, out: str = "group"
) -> DataFrame:
    """Random split by a row key: the same row lands in the same group however it is read."""
    u = md5_uniform(seed, *key)
    names = list(weights)
    total = sum(weights.values())
    edge, choice = 0.0, None
    for name in names[:-1]:
        edge += weights[name] / total
        rule = u < F.lit(round(edge, 12))
        choice = F.when(rule, name) if choice is None else choice.when(rule, name)
    last = F.lit(names[-1])
    return df.withColumn(out, last if choice is None else choice.otherwise(last))


def sample_by_hash(df: DataFrame, key: list[str], fraction: float, seed: int = 42) -> DataFrame:
    return df.where(md5_uniform(seed, *key) < F.lit(fraction))


def split_holdout(df: DataFrame, key: list[str], test_size: float = 0.3) -> DataFrame:
    """The last ``test_size`` of the rows in key order are ``valid``, the others ``train``.

    The split point is a position, so keys alone are indexed and joined back.
    """
    keys = dense_index(df.select(*key), list(key), "_position")
    rows = keys.agg(F.count("*").alias("n")).scalar()
    first_valid = F.floor(rows * F.lit(1.0 - test_size))
    marked = keys.select(
        *key, F.when(F.col("_position") < first_valid, "train").otherwise("valid").alias("group")
    )
    return df.join(marked, list(key))


def split_temporal(orders: DataFrame, user: str = "user_id", order=("order_ts", "order_id")):
    """The last order of every user is ``test``, earlier ones ``train``.

    The last order is a partial aggregate (``max`` of a struct), not a window over the user.
    """
    last = orders.groupBy(user).agg(F.max(F.struct(*order)).alias("_last")).select(
        user, F.col(f"_last.{order[-1]}").alias("_last_id")
    )
    return (
        orders.join(last, user)
        .withColumn(
            "group", F.when(F.col(order[-1]) == F.col("_last_id"), "test").otherwise("train")
        )
        .drop("_last_id")
    )


def shuffle_rows(df: DataFrame, key: list[str], seed: int = 42, partitions: int | None = None):
    """Rows in keyed random order: random range of the hash per partition, sorted inside it."""
    order = md5_hex(seed, *key)
    mixed = (
        df.repartitionByRange(partitions, order) if partitions else df.repartitionByRange(order)
    )
    return mixed.sortWithinPartitions(order)
