"""Orders, their details and the implicit-feedback positives drawn from them."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from affinity.functions.hashing import TWO_32, hex_u32, md5_hex
from affinity.session import materialize


def order_detail(order_products: DataFrame, orders: DataFrame) -> DataFrame:
    """Every order line with the columns of its order."""
    return order_products.join(orders, ["order_id"])


def with_eval_set(df: DataFrame, eval_set: str) -> DataFrame:
    """Rows of one evaluation set; the equality reaches the Parquet scan."""
    return df.where(F.col("eval_set") == eval_set)


def enrich(facts: DataFrame, *dimensions: tuple[DataFrame, list[str]]) -> DataFrame:
    """Chained inner joins with dimension tables; Catalyst broadcasts those it knows are small."""
    for dimension, on in dimensions:
        facts = facts.join(dimension, on)
    return facts


def positives(detail: DataFrame, user: str = "user_id", item: str = "product_id") -> DataFrame:
    """Distinct (user, item) pairs with label 1."""
    return detail.select(user, item).distinct().withColumn("label", F.lit(1))


def interactions_per_user(pairs: DataFrame, user: str = "user_id") -> DataFrame:
    return pairs.groupBy(user).agg(F.count("*").alias("count")).orderBy(F.desc("count"), user)


def item_sets(
    pairs: DataFrame,
    group: str = "user_id",
    item: str = "product_id",
    out: str = "products",
    rows_per_task: int = 1_000_000,
) -> DataFrame:
    """The set of items of each group as sorted arrays, with the part number and size.

    A group of up to ``rows_per_task`` items is one row with ``part`` 0. A larger one is spread over as many
    parts as its size asks for, by a hash of the item, so its set stays whole and no row is unbounded.
    The parts of a group depend on that group alone, not on the rest of the table.
    """
    distinct = materialize(pairs.select(group, item).distinct(), "sets")
    sizes = distinct.groupBy(group).agg(F.count("*").alias("_rows")).where(F.col("_rows") > rows_per_task)
    hot = materialize(sizes.select(group, F.ceil(F.col("_rows") / rows_per_task).alias("_buckets")), "hot")
    if hot.isEmpty():
        parted = distinct.withColumn("part", F.lit(0).cast("bigint"))
    else:
        share = hex_u32(md5_hex(0, item)) / F.lit(TWO_32)
        parted = distinct.join(hot, [group], "left").withColumn(
            "part", F.coalesce(F.floor(share * F.col("_buckets")), F.lit(0)).cast("bigint")
        )
    return (
        parted.groupBy(group, "part")
        .agg(F.array_sort(F.collect_list(item)).alias(out))
        .withColumn("n_items", F.size(out).cast("bigint"))
    )


def item_popularity(pairs: DataFrame, item: str = "product_id") -> DataFrame:
    return pairs.groupBy(item).agg(F.count("*").alias("count"))


def popularity_of(pairs: DataFrame, item_id: int, item: str = "product_id") -> DataFrame:
    """Popularity of one item: the filter runs before the aggregate, so no sort is paid for."""
    return item_popularity(pairs.where(F.col(item) == item_id), item)


def rows_per_value(df: DataFrame, column: str) -> DataFrame:
    return df.groupBy(column).agg(F.count("*").alias("count")).orderBy("count", column)


def first_interactions(df: DataFrame, n: int, order: list[str]) -> DataFrame:
    """The first ``n`` rows of a total order (top-n per task, then one merge of n-row lists)."""
    return df.orderBy(*order).limit(n)


def cardinalities(df: DataFrame, columns: list[str], approximate: bool = False) -> DataFrame:
    """Distinct values of each column in one row.

    The exact form counts ``distinct`` rows per column, each its own shuffle with map-side
    de-duplication, so no task sees all values of a column.
    """
    if approximate:
        return df.agg(*[F.approx_count_distinct(c).alias(f"n_{c}") for c in columns])
    return df.select(*columns).agg(*[F.countDistinct(c).alias(f"n_{c}") for c in columns])


def embedding_sizes(df: DataFrame, columns: list[str]) -> DataFrame:
    """Per id column the distinct count, the largest id and the table size that holds both."""
    return df.agg(
        *[F.countDistinct(c).cast("bigint").alias(f"{c}_distinct") for c in columns],
        *[F.max(c).cast("bigint").alias(f"{c}_max") for c in columns],
    ).select(
        "*",
        *[
            F.greatest(F.col(f"{c}_distinct"), F.col(f"{c}_max") + 1).alias(f"{c}_rows")
            for c in columns
        ],
    )
