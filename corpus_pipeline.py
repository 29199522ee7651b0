"""A corpus pipeline: quality rules, near duplicates, benchmark leaks, secrets, tokens.

Each stage takes the documents that the one before it kept and returns a DataFrame with their columns;
the last returns the ids of tokens. Every stage's result is written as Parquet and read again, so a
stage starts from files that outlive executors.

Empty tables pass through all stages. Nulls: a document without text fails the quality rules.
"""

from __future__ import annotations

import os
import sys

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

import public_tokenizers  # noqa: E402

from affinity.llm import bpe, decontaminate, jaccard_join, quality_rules, secret_scan  # noqa: E402
from affinity.llm.text import table  # noqa: E402
from affinity.plans.registry import query  # noqa: E402
from affinity.session import materialize  # noqa: E402


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality rules reject go."""
    return quality_rules.keep_good(docs, table(spark, sf_dir, "labels"))


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates stays: five words, a similarity of 0.8 or more."""
    return jaccard_join.keep_one(docs, n=5, num=80, den=100)


def benchmark_leaks(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold benchmark items go."""
    return decontaminate.clean(docs, table(spark, sf_dir, "benchmark"))


def secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Secrets in the texts are replaced by a mark; n_chars follows the text where it did before."""
    p = "__before"
    redacted = secret_scan.redact(docs.withColumn(p, F.length("text")))
    if "n_chars" in docs.columns:
        follows = F.col("n_chars") == F.col(p)
        redacted = redacted.withColumn("n_chars", F.when(follows, F.length("text").cast("bigint")).otherwise(F.col("n_chars")))
    return redacted.select(*docs.columns)


def tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """doc_id, the number and ids of its tokens, and the digest of the text they decode to."""
    coded = bpe.encode_decode(docs, public_tokenizers.path("word_bpe_49k.json"))
    return coded.select("doc_id", F.size("ids").cast("bigint").alias("n_tokens"), "ids", F.sha2("decoded", 256).alias("decoded_sha256"))


STAGES = [
    ("quality_rules", quality),
    ("jaccard_join", near_duplicates),
    ("decontaminate", benchmark_leaks),
    ("secret_scan", secrets),
    ("bpe", tokens),
]

#: Thresholds from exact binomial bounds, components of similar texts and a trained forest have no SQL
#: form; the pipeline is tested against a brute-force version.
ORACLE_SQL = None


@query("pipeline", ORACLE_SQL)
def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = materialize(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return docs
