"""Quality rules whose cutoffs carry a guarantee on false rejection.

Each rule compares one figure of a text with a cutoff; a text is rejected if any rule rejects it. Cutoffs move
together along a fixed path from loose to strict. For each stratum (language) the labelled good documents
tell how many of them each step of the path rejects, and the exact binomial test (Clopper-Pearson) asks whether
that few could be expected if the step rejected more than ``risk`` of all good ones. Steps are tested in the order
of the path up to the first that fails, so the order alone corrects for their number; the level ``delta`` is
divided by the number of strata that have labels enough to pass at all (Bonferroni). So with probability
``1 - delta`` no stratum loses more than ``risk`` of its good documents. The last step that passes is used; a
stratum with too few labelled documents has none and rejects by the base rules alone.

Defined cases. Null text: no words, all figures 0, base failed. Null language: a stratum of its own.
A document labelled more than once is good only if every label says so; labels of unknown documents
count for nothing. Repeated rows are judged each. Empty tables give empty results. Columns of the
input beyond doc_id, text and lang play no part.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from affinity.llm.text import let, space_words
from affinity.session import materialize

RISK = 0.02
DELTA = 0.05
#: Figure of a text, and the cutoffs that are tried; a text is rejected above its cutoff.
GRIDS = {
    "symbols_per_word": [0.02, 0.05, 0.1, 0.2, 0.3, 0.5, 0.75, 1.0, 1.5, 2.0, 3.0],
    "dup_line_share": [0.02, 0.05, 0.1, 0.15, 0.2, 0.3, 0.4, 0.5, 0.6, 0.8],
    "repeat_share": [0.02, 0.05, 0.1, 0.15, 0.2, 0.25, 0.3, 0.35, 0.4, 0.45],
    "long_words": [6.0, 7.0, 8.0, 9.0, 10.0, 12.0, 15.0, 20.0, 30.0],
    "short_words": [-6.0, -5.0, -4.5, -4.0, -3.5, -3.0, -2.5, -2.0, -1.5],
}
#: Steps of the path; a rule with fewer cutoffs stays at its loosest one first.
STEPS = max(map(len, GRIDS.values()))
FIGURES = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_lines"]


def _repeat_words(words: Column) -> Column:
    """Words that lie in 3-word windows found twice or more in the text."""

    def hashed(w):
        window = lambda i: F.xxhash64(F.get(w, i), F.get(w, i + 1), F.get(w, i + 2))
        return F.transform(F.sequence(F.lit(0), F.size(w) - 3), window)

    def covered(h):
        pair = lambda x, i: F.struct(x.alias("h"), i.alias("i"))
        same = lambda s, i, j: F.coalesce(F.get(s, i)["h"] == F.get(s, j)["h"], F.lit(False))
        twice = let(
            F.sort_array(F.transform(h, pair)),
            lambda s: F.transform(
                F.filter(
                    F.transform(s, lambda x, i: F.struct(x["i"].alias("p"), (same(s, i, i - 1) | same(s, i, i + 1)).alias("d"))),
                    lambda x: x["d"],
                ),
                lambda x: F.array(x["p"], x["p"] + 1, x["p"] + 2),
            ),
        )
        return F.size(F.array_distinct(F.flatten(twice)))

    some = lambda h: F.when(F.size(F.array_distinct(h)) == F.size(h), 0).otherwise(covered(h))
    return let(words, lambda w: F.when(F.size(w) < 3, 0).otherwise(let(hashed(w), some)))


def with_figures(docs: DataFrame, prefix: str = "") -> DataFrame:
    """``docs`` and the figures of its texts, as columns named ``prefix`` and the figure."""
    p, words, lines = prefix, f"{prefix}__words", f"{prefix}__lines"
    text = F.coalesce(F.col("text"), F.lit(""))
    full = F.filter(F.split(text, "\n"), lambda x: x.rlike(r"[^\x20\x09-\x0D]"))
    return (
        docs.withColumn(words, space_words(F.col("text")))
        .withColumn(lines, full)
        .withColumns(
            {
                f"{p}n_words": F.size(words).cast("bigint"),
                f"{p}word_chars": F.length(F.array_join(words, "")).cast("bigint"),
                f"{p}n_symbols": F.regexp_count(text, F.lit(r"[#*$%&|<>]")).cast("bigint"),
                f"{p}n_dup_lines": (F.size(lines) - F.size(F.array_distinct(lines))).cast("bigint"),
                f"{p}n_repeat_words": _repeat_words(F.col(words)).cast("bigint"),
                f"{p}n_lines": F.size(lines).cast("bigint"),
            }
        )
        .drop(words, lines)
    )


def base_failed(prefix: str = "") -> Column:
    n, repeats = F.col(f"{prefix}n_words"), F.col(f"{prefix}n_repeat_words")
    return (n < 50) | (100 * repeats > 50 * n)


def _figures(prefix: str = "") -> dict[str, Column]:
    c = lambda name: F.col(f"{prefix}{name}")
    words, lines = F.greatest(c("n_words"), F.lit(1)), F.greatest(c("n_lines"), F.lit(1))
    length = c("word_chars") / words
    return {
        "symbols_per_word": c("n_symbols") / words,
        "dup_line_share": c("n_dup_lines") / lines,
        "repeat_share": c("n_repeat_words") / words,
        "long_words": length,
        "short_words": -length,
    }


def binomial_tail(k: Column, n: Column, p: float) -> Column:
    """P(X <= k) for X ~ Binomial(n, p), and 1 where k is above the mean (no bound can hold there)."""
    first = n * F.log1p(F.lit(-p))
    odds = F.log(F.lit(p / (1 - p)))
    step = lambda a, i: F.struct(
        (a["t"] + F.log((n - i + 1) / i) + odds).alias("t"),
        (a["s"] + F.exp(a["t"] + F.log((n - i + 1) / i) + odds)).alias("s"),
    )
    total = F.aggregate(
        F.sequence(F.lit(1).cast("bigint"), k),
        F.struct(first.alias("t"), F.exp(first).alias("s")),
        step,
        lambda a: a["s"],
    )
    return F.when(k > n * p, 1.0).when(k == 0, F.exp(first)).otherwise(total)


def path(rule: str) -> list[float]:
    """The cutoff of a rule at each step."""
    loose_first = sorted(GRIDS[rule], reverse=True)
    return [loose_first[max(0, j - (STEPS - len(loose_first)))] for j in range(STEPS)]


def first_step(prefix: str = "") -> Column:
    """The first step of the path that rejects a text with the figures, or the number of steps."""
    by_rule = [
        F.coalesce(*[F.when(figure > cut, F.lit(j)) for j, cut in enumerate(path(rule))], F.lit(STEPS))
        for rule, figure in _figures(prefix).items()
    ]
    return F.least(*by_rule)


def cutoffs(figures: DataFrame, labels: DataFrame, risk: float = RISK, delta: float = DELTA) -> DataFrame:
    """Per stratum (``stratum``) its good labelled documents ``n`` and the last admitted ``step``; null where none is.

    ``figures`` has doc_id, stratum and the figures. The result has one row per stratum.
    """
    good = (
        labels.where(F.col("doc_id").isNotNull() & F.col("quality").isNotNull())
        .groupBy("doc_id").agg(F.min("quality").alias("quality")).where("quality = 1")
    )
    counts = (
        figures.where(~base_failed())
        .join(good, "doc_id", "left_semi")
        .withColumn("first", first_step())
        .groupBy("stratum")
        .agg(F.count("*").alias("n"), *[F.count(F.when(F.col("first") <= j, 1)).alias(f"k{j}") for j in range(STEPS)])
    )
    counts = materialize(counts, "quality-holdout")
    enough = math.ceil(math.log(delta) / math.log1p(-risk))  # with fewer even no rejection at all doesn't pass
    level = F.lit(delta) / F.greatest(F.lit(1), F.lit(counts.where(F.col("n") >= enough).count()))
    failed = [F.when(binomial_tail(F.col(f"k{j}"), F.col("n"), risk) > level, F.lit(j)) for j in range(STEPS)]
    step = F.coalesce(*failed, F.lit(STEPS)) - 1
    return counts.select("stratum", "n", F.when(step >= 0, step).alias("step"))


def stratum(docs: DataFrame) -> Column:
    return F.coalesce(F.col("lang"), F.lit("(none)"))


def kept(prefix: str = "") -> Column:
    """The verdict on a row that has the figures and its stratum's step."""
    return ~base_failed(prefix) & ~F.coalesce(first_step(prefix) <= F.col(f"{prefix}step"), F.lit(False))


def judge(docs: DataFrame, labels: DataFrame, risk: float = RISK, delta: float = DELTA) -> DataFrame:
    """doc_id, the figures, base_failed and kept for every row of ``docs``.

    The texts are read once; figures (a few numbers for each document) are frozen before the labelled
    ones are joined and counted.
    """
    rows = with_figures(docs.select("doc_id", "text", "lang")).withColumn("stratum", stratum(docs))
    figures = materialize(rows.select("doc_id", "stratum", *FIGURES), "quality-figures")
    cuts = materialize(cutoffs(figures, labels, risk, delta).drop("n"), "quality-cutoffs")
    return (
        figures.join(cuts, "stratum", "left")
        .withColumns({"base_failed": base_failed(), "kept": kept()})
        .select("doc_id", *FIGURES, "base_failed", "kept")
    )


def keep_good(docs: DataFrame, labels: DataFrame, risk: float = RISK, delta: float = DELTA) -> DataFrame:
    """The rows of ``docs`` that pass, with its own columns.

    Figures are computed a second time beside the texts, which costs less than a shuffle of all texts.
    """
    p = "__quality_"
    figures = with_figures(docs.select("doc_id", "text", "lang")).withColumn("stratum", stratum(docs))
    figures = materialize(figures.select("doc_id", "stratum", *FIGURES), "quality-figures")
    cuts = cutoffs(figures, labels, risk, delta).drop("n")
    cuts = materialize(cuts.select(*[F.col(c).alias(f"{p}{c}") for c in cuts.columns]), "quality-cutoffs")
    rows = with_figures(docs, p).withColumn(f"{p}stratum", stratum(docs))
    return rows.join(cuts, f"{p}stratum", "left").where(kept(p)).select(*docs.columns)
