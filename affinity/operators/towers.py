"""Forward passes of small dense networks over id vectors, and pair scoring."""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from affinity.functions.hashing import md5_uniform
from affinity.functions.vectors import as_doubles, dot, sigmoid
from affinity.operators import pair_scores

Layer = tuple[np.ndarray, np.ndarray]


def keyed_layers(seed: int, sizes: list[int], scale: float = 1.0) -> list[Layer]:
    """Weights in [-scale/2, scale/2) from md5 of (seed, layer, row, column): a repeatable
    initialisation of a network with the given widths. Bias ``j`` is row -1, column ``j``."""

    def weight(layer, i, j):
        digest = hashlib.md5(f"{seed}|{layer}|{i}|{j}".encode()).hexdigest()
        return (int(digest[:8], 16) / 4294967296.0 - 0.5) * scale

    return [
        (
            np.array([[weight(n, i, j) for j in range(after)] for i in range(before)]),
            np.array([weight(n, -1, j) for j in range(after)]),
        )
        for n, (before, after) in enumerate(zip(sizes, sizes[1:]))
    ]


def seed_vectors(df: DataFrame, key: str, dim: int, seed: int, scale: float = 1.0) -> DataFrame:
    """An initial vector per id, a pure function of the id."""
    parts = [(md5_uniform(seed, key, j) - F.lit(0.5)) * F.lit(scale) for j in range(dim)]
    return df.select(key, F.array(*parts).alias("embedding"))


def forward(
    df: DataFrame, vector: str, layers: list[Layer], out: str, last_relu: bool = True
) -> DataFrame:
    """``df`` with ``out``, the output of the layers for ``vector``.

    Every layer is followed by a relu; ``last_relu=False`` leaves the last one linear. The
    weights travel with the task (their size is fixed by the network, not by the data).
    """
    schema = T.StructType([*df.schema.fields, T.StructField(out, T.ArrayType(T.DoubleType()))])
    width = layers[0][0].shape[0]

    def run(batches):
        for batch in batches:
            flat = batch.column(vector).flatten().to_numpy(zero_copy_only=False)
            x = flat.astype(np.float64).reshape(batch.num_rows, width)
            for n, (w, b) in enumerate(layers):
                x = x @ w + b
                if last_relu or n < len(layers) - 1:
                    x = np.maximum(x, 0.0)
            offsets = pa.array(np.arange(batch.num_rows + 1, dtype=np.int32) * x.shape[1])
            yield batch.append_column(out, pa.ListArray.from_arrays(offsets, pa.array(x.ravel())))

    return df.mapInArrow(run, schema)


def tower(df: DataFrame, key: str, vector: str, layers: list[Layer]) -> DataFrame:
    """Tower output per id."""
    return forward(df.select(key, vector), vector, layers, "tower").select(
        key, F.col("tower").alias("embedding")
    )


def tower_with_dense(
    df: DataFrame, key: str, vector: str, dense: str, layers: list[Layer]
) -> DataFrame:
    """Tower output for the id vector followed by the dense features of the row."""
    joined = df.select(key, F.concat(as_doubles(vector), as_doubles(dense)).alias("_in"))
    return forward(joined, "_in", layers, "tower").select(
        key, F.col("tower").alias("embedding")
    )


def with_pair_vectors(
    pairs: DataFrame, users: DataFrame, items: DataFrame, user="user_id", item="product_id", how="inner"
) -> DataFrame:
    """Pairs joined to both vector tables; pairs with an unknown id are dropped, or kept with nulls (``left``).

    Pairs and vectors meet in tiles, and vectors stand in the rows only as these leave a task. Streams, ids that aren't
    whole numbers and vectors that aren't doubles are joined.
    """
    names = ("user_vector", "item_vector")
    kinds = {dict(v.dtypes)["embedding"] for v in (users, items)}
    if kinds == {"array<double>"} and pair_scores.fits(pairs, users, items, user, item, how):
        return pair_scores.with_vectors(pairs, users, items, user, item, how, names)
    return pairs.join(users.select(user, F.col("embedding").alias("user_vector")), [user], how).join(
        items.select(item, F.col("embedding").alias("item_vector")), [item], how
    )


def score_pairs(pairs, users, items, user="user_id", item="product_id", threshold=0.5, how="inner"):
    """Pairs with logit, probability and class (probability at or above ``threshold``).

    With ``how="left"`` every pair comes back, those with an unknown id with nulls. Pairs and vectors meet in
    tiles; streams and ids that aren't whole numbers are joined.
    """
    if pair_scores.fits(pairs, users, items, user, item, how):
        scored = pair_scores.score(pairs, users, items, user, item, how, "logit")
    else:
        joined = with_pair_vectors(pairs, users, items, user, item, how)
        scored = joined.withColumn("logit", dot("user_vector", "item_vector")).drop("user_vector", "item_vector")
    return (
        scored.withColumn("prediction_prob", sigmoid("logit"))
        .withColumn("predicted_classes", classify("prediction_prob", threshold))
    )


def classify(probability: str, threshold: float = 0.5):
    return (F.col(probability) >= F.lit(threshold)).cast("bigint")


def round_class(probability: str):
    """Class by rounding half to even, so exactly 0.5 is class 0."""
    return F.bround(F.col(probability)).cast("bigint")


def rank_pairs(pairs, users, items, layers, user="user_id", item="product_id") -> DataFrame:
    """Logit of a network over the user vector followed by the item vector."""
    joined = with_pair_vectors(pairs, users, items, user, item).withColumn(
        "_in", F.concat(as_doubles("user_vector"), as_doubles("item_vector"))
    )
    kept = joined.drop("user_vector", "item_vector")
    return (
        forward(kept, "_in", layers, "_out", last_relu=False)
        .withColumn("logit", F.col("_out")[0])
        .drop("_in", "_out")
    )


def predict_with(
    df: DataFrame,
    inputs: list[str],
    load_model: Callable[[], Callable[[pd.DataFrame], np.ndarray]],
    out: str = "prediction_prob",
    batch_size: int = 500,
) -> DataFrame:
    """Score rows with any model: loaded once per task, called on ``batch_size`` rows."""

    @F.pandas_udf("double")
    def predict(batches: Iterator[pd.DataFrame]) -> Iterator[pd.Series]:
        model = load_model()
        for rows in batches:
            parts = [
                np.asarray(model(rows.iloc[lo : lo + batch_size]), dtype=float)
                for lo in range(0, len(rows), batch_size)
            ]
            yield pd.Series(np.concatenate(parts) if parts else np.zeros(0))

    return df.withColumn(out, predict(F.struct(*inputs)))
