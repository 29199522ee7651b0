"""Boosted-tree classification over numeric columns."""

from __future__ import annotations

from pyspark.ml.classification import GBTClassifier, OneVsRest
from pyspark.ml.feature import VectorAssembler
from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def boosted_trees(
    train: DataFrame,
    test: DataFrame,
    features: list[str],
    target: str = "target",
    labels: int = 2,
    max_depth: int = 5,
    rounds: int = 10,
    seed: int = 42,
) -> DataFrame:
    """``test`` with ``prediction``: one ensemble for two labels, one per label beyond."""
    assemble = VectorAssembler(inputCols=features, outputCol="_features")
    trees = GBTClassifier(
        featuresCol="_features", labelCol="_target", maxDepth=max_depth, maxIter=rounds, seed=seed
    )
    if labels > 2:
        trees = OneVsRest(classifier=trees, featuresCol="_features", labelCol="_target")
    rows = assemble.transform(train).withColumn("_target", F.col(target).cast("double"))
    model = trees.fit(rows)
    scored = model.transform(assemble.transform(test))
    return scored.select(*test.columns, F.col("prediction").cast("int").alias("prediction"))
