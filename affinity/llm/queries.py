"""The registered queries: one for each operator, over its whole table."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import functions as F

from affinity.llm import (
    bpe, decontaminate, hard_negatives, jaccard_join, language_id, license_scan, lm_scoring, quality_rules, secret_scan, sql,
    suffix_dedup, token_alignment, topk_products, url_filter,
)
from affinity.llm.text import table
from affinity.plans.registry import query


@query("op8_url_filter")
def op8(spark, sf):
    return url_filter.judge(table(spark, sf, "pages"), url_filter.labelled_urls(spark))


@query("op9_quality_rules", sql.QUALITY_RULES)
def op9(spark, sf):
    judged = quality_rules.judge(table(spark, sf, "documents"), table(spark, sf, "labels"))
    return judged.drop("n_lines")


@query("op2_license_scan", sql.LICENSE_SCAN)
def op2(spark, sf):
    return license_scan.scan(table(spark, sf, "documents"))


@query("op5_language_id")
def op5(spark, sf):
    return language_id.identify(table(spark, sf, "documents"))


@query("op6_bpe")
def op6(spark, sf, vocabulary=None):
    vocabulary = vocabulary or public_tokenizers.path("word_bpe_49k.json")
    coded = bpe.encode_decode(table(spark, sf, "documents"), vocabulary)
    return coded.select(
        "doc_id",
        F.size("ids").cast("bigint").alias("n_tokens"),
        F.sha2(F.array_join(F.col("ids").cast("array<string>"), " "), 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
    )


@query("op10_jaccard_join", sql.JACCARD_JOIN)
def op10(spark, sf):
    return jaccard_join.join(table(spark, sf, "documents"), n=3, num=90, den=100)


@query("op7_decontaminate")
def op7(spark, sf):
    return decontaminate.leaks(table(spark, sf, "documents"), table(spark, sf, "benchmark"))


@query("op3_secret_scan")
def op3(spark, sf):
    return secret_scan.findings(table(spark, sf, "documents"))


@query("op4_lm_scoring")
def op4(spark, sf):
    target = table(spark, sf, "conversations").where("role = 'assistant'").select("text")
    return lm_scoring.cross_entropy_difference(table(spark, sf, "documents"), target)


@query("op1_suffix_dedup", sql.SUFFIX_DEDUP)
def op1(spark, sf):
    out = suffix_dedup.dedup(table(spark, sf, "documents"))
    return out.select("doc_id", "n_bytes", "n_removed", "n_spans", F.sha2("kept", 256).alias("kept_sha256"))


@query("op11_topk_products", sql.TOPK_PRODUCTS)
def op11(spark, sf):
    vectors = table(spark, sf, "embeddings")
    return topk_products.search(vectors, vectors.where(F.col("vec_id") % 50 == 0), k=5)


@query("op12_hard_negatives", sql.HARD_NEGATIVES)
def op12(spark, sf):
    label = F.col("label").cast("bigint")
    vectors = table(spark, sf, "embeddings").withColumn("label", F.when(F.col("vec_id") % 7 == 0, (label + 1) % 10).otherwise(label))
    return hard_negatives.mine(vectors, F.col("vec_id") % 100 == 0)


@query("op13_token_alignment")
def op13(spark, sf, a=None, b=None):
    a, b = a or public_tokenizers.path("byte_bpe_50k.json"), b or public_tokenizers.path("piece_bpe_32k.model")
    return token_alignment.align(table(spark, sf, "documents"), a, b)
