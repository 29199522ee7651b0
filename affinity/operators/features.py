"""Id indexes, jagged and dense model inputs, and text features."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from affinity.functions.hashing import hex_u32
from affinity.functions.vectors import normalized
from affinity.operators.ranking import dense_index

MAX_CATEGORIES = 1000


def id_index(df: DataFrame, column: str, index: str | None = None) -> DataFrame:
    """Dense index of a column by falling frequency, ties in string order (``StringIndexer``'s
    default order), as a table joined where needed instead of a label list on the driver."""
    index = index or f"{column}_index"
    counts = df.where(F.col(column).isNotNull()).groupBy(column).agg(F.count("*").alias("count"))
    return dense_index(counts, [F.desc("count"), F.col(column).cast("string")], index)


def with_index(df: DataFrame, column: str, index: str | None = None) -> DataFrame:
    index = index or f"{column}_index"
    return df.join(id_index(df, column, index).drop("count"), [column])


def fold_ids(df: DataFrame, column: str, size: int, out: str) -> DataFrame:
    """``column`` modulo a table size; ids at or above ``size`` share rows with others."""
    return df.withColumn(out, F.pmod(F.col(column), F.lit(size)))


def to_jagged(df: DataFrame, batch: str, row: str, keys: list[str], label: str) -> DataFrame:
    """One row per batch with flat values and per-row lengths of every key, in row order.

    Only null is missing (length 0); id 0 is a value. The caller's ``batch`` bounds the rows
    gathered in one array.
    """
    rows = F.array_sort(F.collect_list(F.struct(row, *keys, label)))
    out = df.groupBy(batch).agg(rows.alias("_rows"))
    for key in keys:
        out = out.withColumns(
            {
                f"{key}_values": F.filter(F.col("_rows")[key], lambda x: x.isNotNull()),
                f"{key}_lengths": F.transform(
                    F.col("_rows")[key], lambda x: F.when(x.isNull(), 0).otherwise(1)
                ),
            }
        )
    return out.withColumn("labels", F.col("_rows")[label]).drop("_rows")


def first_batches(batches: DataFrame, n: int, batch: str = "batch") -> DataFrame:
    """The rows of the first ``n`` batches, for a quick evaluation."""
    first = batches.select(batch).distinct().orderBy(batch).limit(n)
    return batches.join(F.broadcast(first), batch, "left_semi")


def days_between(later: str, earlier: str) -> Column:
    """Whole days from one timestamp to another, as a double; negative when ``later`` is the earlier one."""
    return F.datediff(later, earlier).cast("double")


def categories(df: DataFrame, column: str, limit: int = MAX_CATEGORIES) -> list:
    """Sorted distinct values of a categorical column; an error beyond ``limit`` of them."""
    found = [r[0] for r in df.select(column).distinct().limit(limit + 1).collect()]
    if len(found) > limit:
        raise ValueError(f"{column} has more than {limit} categories; index it instead")
    return sorted(v for v in found if v is not None)


def one_hot(column: str, values: list) -> Column:
    """A 0/1 element for each value; a null category is all zeros."""
    same = [F.coalesce(F.col(column) == F.lit(v), F.lit(False)) for v in values]
    return F.array(*[x.cast("double") for x in same])


def standard_scaled(df: DataFrame, columns: list[str]) -> dict[str, Column]:
    """(x - mean) / sample standard deviation per column; 0 where the deviation is 0."""
    out = {}
    for c in columns:
        stats = df.agg(
            F.struct(F.avg(c).alias("mean"), F.stddev_samp(c).alias("dev")).alias("s")
        ).scalar()
        centred = F.col(c) - stats["mean"]
        out[c] = F.coalesce(centred / F.nullif(stats["dev"], F.lit(0.0)), F.lit(0.0))
    return out


def dense_features(
    df: DataFrame,
    user_onehot: list[str],
    user_scaled: list[str],
    item_onehot: list[str],
    item_scaled: list[str],
) -> DataFrame:
    """``user_dense`` and ``item_dense``: one-hot blocks, then scaled numerics, per side."""
    scaled = standard_scaled(df, [*user_scaled, *item_scaled])

    def side(onehot, numeric):
        blocks = [one_hot(c, categories(df, c)) for c in onehot]
        if numeric:
            blocks.append(F.array(*[scaled[c] for c in numeric]))
        return F.concat(*blocks)

    return df.withColumns(
        {"user_dense": side(user_onehot, user_scaled), "item_dense": side(item_onehot, item_scaled)}
    )


def split_dense(dense: Column, at: int) -> tuple[Column, Column]:
    """The part of a dense vector before position ``at`` and the part from it on."""
    return F.slice(dense, 1, at), F.slice(dense, at + 1, F.size(dense) - at)


def binarize_by_mean(df: DataFrame, rating: str, label: str = "label") -> DataFrame:
    """0 below the mean of all ratings, else 1; a null rating has a null label."""
    mean = df.agg(F.avg(rating).alias("mean")).scalar()
    return df.withColumn(
        label, F.when(F.col(rating) < mean, 0).when(F.col(rating).isNotNull(), 1)
    ).drop(*([rating] if rating != label else []))


def item_text(skip_missing: bool = False) -> Column:
    """Department, aisle and product lines; null if a part is null unless ``skip_missing``."""
    lines = [
        F.concat(F.lit("Department: "), F.col("department")),
        F.concat(F.lit("Aisle: "), F.col("aisle")),
        F.concat(F.lit("Product: "), F.col("product_name")),
    ]
    if skip_missing:
        return F.concat_ws("\n", *lines)
    return F.concat(lines[0], F.lit("\n"), lines[1], F.lit("\n"), lines[2])


def text_vectors(
    df: DataFrame, key: str, text: str, dim: int = 64, out: str = "embedding"
) -> DataFrame:
    """Hashed bag-of-words vectors of unit length, from every token of the text.

    A token adds +1 or -1 at one of ``dim`` places, both taken from its md5. The sums per
    (text, place) are partial aggregates: at most ``dim`` rows per text are shuffled, whatever
    its length. A text without tokens has the zero vector.
    """
    tokens = df.select(key, F.explode_outer(F.split(F.lower(text), r"\s+")).alias("_token"))
    hashed = tokens.select(key, "_token", F.md5("_token").alias("_digest"))
    even = F.substring("_digest", 16, 1).isin("0", "2", "4", "6", "8", "a", "c", "e")
    sums = (
        hashed.select(
            key,
            F.when(F.col("_token") != "", hex_u32(F.col("_digest")) % dim).alias("_place"),
            F.when(even, 1.0).otherwise(-1.0).alias("_sign"),
        )
        .groupBy(key, "_place")
        .agg(F.sum("_sign").alias("_sum"))
    )
    held = F.when(F.col("_place").isNotNull(), F.struct("_place", "_sum"))
    raw = sums.groupBy(key).agg(F.map_from_entries(F.collect_list(held)).alias("_sums")).select(
        key,
        F.transform(
            F.sequence(F.lit(0).cast("bigint"), F.lit(dim - 1).cast("bigint")),
            lambda j: F.coalesce(F.try_element_at("_sums", j), F.lit(0.0)),
        ).alias("_raw"),
    )
    return raw.select(key, F.coalesce(normalized("_raw"), F.col("_raw")).alias(out))


def embed_with(
    df: DataFrame, text: str, load_model: Callable[[], Callable], out: str = "embedding"
) -> DataFrame:
    """Vectors from any model: ``load_model`` runs once per task and returns a function from
    a list of texts to a list of vectors."""

    @F.pandas_udf("array<float>")
    def embed(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        model = load_model()
        for texts in batches:
            yield pd.Series(list(model(texts.tolist())))

    return df.withColumn(out, embed(F.col(text)))
