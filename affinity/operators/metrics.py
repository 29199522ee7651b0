"""Classification and ranking metrics."""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from affinity.functions.vectors import bce_of_probability, bce_with_logits
from affinity.operators.ranking import running_sums


def mean_bce(df: DataFrame, logit: str, label: str) -> DataFrame:
    """Mean cross-entropy per row (not per batch)."""
    return df.agg(F.avg(bce_with_logits(logit, label)).alias("loss"))


def weighted_bce(
    df: DataFrame, weights: DataFrame, kind: str, probability: str, label: str
) -> DataFrame:
    """Mean over rows of weight times cross-entropy; divides by the rows, not the weights.

    ``weights`` is (kind, weight). A kind without a weight is an error, not a dropped row.
    """
    missing = F.raise_error(F.concat(F.lit("no weight for interaction "), F.col(kind)))
    weight = F.when(F.col("weight").isNull(), missing).otherwise(F.col("weight"))
    return df.join(weights, [kind], "left").agg(
        F.avg(weight * bce_of_probability(probability, label)).alias("loss")
    )


def _by_score(df: DataFrame, keys: list[str], score: str, label: str) -> DataFrame:
    return df.groupBy(*keys, score).agg(
        F.sum(F.col(label).cast("bigint")).alias("pos"),
        F.sum(1 - F.col(label).cast("bigint")).alias("neg"),
    )


def _area(below: Column) -> Column:
    won = F.sum(F.col("pos") * (below + F.col("neg") / 2.0))
    # the product of two counts may pass the range of a bigint
    return won / F.nullif(F.sum("pos").cast("double") * F.sum("neg").cast("double"), F.lit(0.0))


def auroc(df: DataFrame, score: str, label: str) -> DataFrame:
    """Exact area under the ROC curve; tied scores count half, one class alone gives null.

    Rows are first grouped by score, then negatives are summed along the score order over
    range partitions, so neither a common score nor the whole order lands in one task.
    """
    ordered = running_sums(_by_score(df, [], score, label), [score], {"neg": "below"})
    return ordered.agg(_area(F.col("below")).alias("auroc"))


def metrics_by_type(df: DataFrame, kind: str, score: str, label: str) -> DataFrame:
    """Rows, mean cross-entropy and AUROC for each interaction type."""
    ordered = running_sums(_by_score(df, [kind], score, label), [kind, score], {"neg": "below"})
    start = ordered.groupBy(kind).agg(F.min("below").alias("start"))
    area = ordered.join(start, kind).groupBy(kind).agg(
        _area(F.col("below") - F.col("start")).alias("auroc")
    )
    loss = df.groupBy(kind).agg(
        F.count("*").alias("n"), F.avg(bce_of_probability(score, label)).alias("loss")
    )
    return loss.join(area, kind)


def accuracy_f1(df: DataFrame, probability: str, label: str) -> DataFrame:
    """Confusion counts, accuracy and F1; a row is positive above 0.5. F1 is 0 when undefined."""
    p, y = F.col(probability) > 0.5, F.col(label) == 1
    counted = df.agg(
        F.count_if(p & y).alias("tp"), F.count_if(p & ~y).alias("fp"),
        F.count_if(~p & y).alias("fn"), F.count_if(~p & ~y).alias("tn"),
    )
    total = F.col("tp") + F.col("fp") + F.col("fn") + F.col("tn")
    wrong = F.col("fp") + F.col("fn")
    return counted.select(
        "*",
        ((F.col("tp") + F.col("tn")) / total).alias("accuracy"),
        F.coalesce(
            2.0 * F.col("tp") / F.nullif(2 * F.col("tp") + wrong, F.lit(0)), F.lit(0.0)
        ).alias("f1"),
    )


def multiclass_metrics(df: DataFrame, probabilities: str, label: str) -> DataFrame:
    """mlogloss and merror from an array of class probabilities; ties go to the lower class."""
    p = F.element_at(F.col(probabilities), F.col(label).cast("int") + 1)
    top = F.array_position(F.col(probabilities), F.array_max(probabilities)) - 1
    return df.agg(
        F.avg(-F.ln(F.greatest(p, F.lit(1e-16)))).alias("mlogloss"),
        F.avg((top != F.col(label)).cast("double")).alias("merror"),
    )


def binary_log_metrics(df: DataFrame, probability: str, label: str) -> DataFrame:
    """logloss and error (wrong side of 0.5)."""
    wrong = (F.col(probability) > 0.5).cast("int") != F.col(label).cast("int")
    return df.agg(
        F.avg(bce_of_probability(probability, label)).alias("logloss"),
        F.avg(wrong.cast("double")).alias("error"),
    )


def _first_hits(predictions: DataFrame, query: str, item: str) -> DataFrame:
    # an item listed twice counts once, at its better rank
    return predictions.groupBy(query, item).agg(F.min("rank").alias("rank"))


def retrieval_metrics(
    predictions: DataFrame, truth: DataFrame, k: int, query="query_id", item="item_id"
) -> DataFrame:
    """precision, recall and NDCG at ``k`` for each query of ``truth``.

    precision = hits / retrieved (0 when nothing was retrieved); recall = hits / relevant;
    NDCG has gain 1 for a hit and discount log2(rank + 1), over the best DCG that
    min(k, relevant) hits could reach. ``predictions`` is (query, item, rank from 1).
    """
    listed = _first_hits(predictions.where(F.col("rank") <= k), query, item)
    relevant = truth.select(query, item).distinct()
    marked = listed.join(relevant.withColumn("_hit", F.lit(1)), [query, item], "left")
    gain = F.when(F.col("_hit") == 1, 1.0 / F.log2(F.col("rank") + 1))
    per_query = marked.groupBy(query).agg(
        F.count("*").alias("retrieved"), F.count("_hit").alias("hits"), F.sum(gain).alias("dcg")
    )
    ideal, best = 0.0, []
    for rank in range(1, k + 1):
        ideal += 1.0 / math.log2(rank + 1)
        best.append(ideal)
    best_dcg = F.array(*[F.lit(b) for b in best])
    counts = relevant.groupBy(query).agg(F.count("*").alias("relevant"))
    joined = counts.join(per_query, query, "left").fillna(
        {"retrieved": 0, "hits": 0, "dcg": 0.0}
    )
    at = F.least(F.col("relevant"), F.lit(k)).cast("int")
    return joined.select(
        query,
        "relevant",
        "hits",
        F.coalesce(F.col("hits") / F.nullif("retrieved", F.lit(0)), F.lit(0.0)).alias(
            "precision_at_k"
        ),
        (F.col("hits") / F.col("relevant")).alias("recall_at_k"),
        (F.col("dcg") / F.element_at(best_dcg, at)).alias("ndcg_at_k"),
    )


def mean_metrics(per_query: DataFrame) -> DataFrame:
    columns = [c for c in per_query.columns if c.endswith("_at_k")]
    return per_query.agg(*[F.avg(c).alias(f"mean_{c}") for c in columns])


def average_precision(
    predictions: DataFrame, truth: DataFrame, k: int, query="query_id", item="item_id"
) -> DataFrame:
    """AP at ``k`` per query of ``truth``: the mean, over the hits in the first ``k`` ranks,
    of the precision at each hit; 0 without a hit."""
    listed = _first_hits(predictions.where(F.col("rank") <= k), query, item)
    relevant = truth.select(query, item).distinct()
    w = Window.partitionBy(query).orderBy("rank")  # at most k rows per query
    hits = listed.join(relevant, [query, item], "left_semi").withColumn(
        "_precision", F.row_number().over(w) / F.col("rank")
    )
    ap = hits.groupBy(query).agg(F.avg("_precision").alias("ap"))
    return relevant.select(query).distinct().join(ap, query, "left").fillna({"ap": 0.0})


def reciprocal_rank(predictions: DataFrame, truth: DataFrame, query="query_id", item="item_id"):
    """1 / rank of the first hit for each query of ``truth``; 0 without a hit."""
    relevant = truth.select(query, item).distinct()
    first = (
        predictions.join(relevant, [query, item], "left_semi")
        .groupBy(query)
        .agg((1.0 / F.min("rank")).alias("rr"))
    )
    return relevant.select(query).distinct().join(first, query, "left").fillna({"rr": 0.0})
