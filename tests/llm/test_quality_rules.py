import math
import re
from collections import Counter

import pytest
from pyspark.sql import functions as F

from affinity.llm import quality_rules as q


def brute(text):
    text = text or ""
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    grams = [tuple(words[i : i + 3]) for i in range(len(words) - 2)]
    counts = Counter(grams)
    covered = {i + k for i, g in enumerate(grams) if counts[g] > 1 for k in range(3)}
    lines = [x for x in text.split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
    n = len(words)
    failed = n < 50 or 100 * len(covered) > 50 * n
    return n, sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text)), len(lines) - len(set(lines)), len(covered), failed


ROWS = [
    (1, None, "en"), (2, "", None), (3, " \t\n", "en"), (4, "a b c a b c", "en"), (5, "x\x0by\x85z w", "de"), (6, "a a a a", "de"),
    (7, "line one\n\nline one\nline one\r\n  \n", "fr"), (8, "## $ |x| <b>\n" * 9, "en"), (9, "ab " * 60, "en"), (9, "ab " * 60, "en"),
    (10, "\U0001f600 é " * 30, None),
]


def labels(spark, rows=()):
    return spark.createDataFrame(list(rows), "doc_id bigint, quality int, toxic int")


def test_figures_equal_brute_force(spark, sf):
    rows = ROWS + [(r["doc_id"] + 100, r["text"], r["lang"]) for r in spark.read.parquet(f"{sf}/documents.parquet").collect()]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, lang string").selectExpr("*", "true as kept", "1 as stratum")
    got = q.judge(docs, labels(spark)).collect()
    columns = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed"]
    assert sorted((r["doc_id"], *(r[c] for c in columns)) for r in got) == sorted((d, *brute(t)) for d, t, _ in rows)
    # with nothing labelled no cutoff is admitted
    assert all(r["kept"] == (not r["base_failed"]) for r in got)


@pytest.mark.parametrize("k, n, p", [(0, 10, 0.1), (3, 400, 0.02), (1, 20_000, 0.004), (40, 20_000, 0.004), (9, 100, 0.01)])
def test_binomial_tail(spark, k, n, p):
    got = spark.range(1).select(q.binomial_tail(F.lit(k).cast("bigint"), F.lit(n).cast("bigint"), p)).first()[0]
    logs = [math.lgamma(n + 1) - math.lgamma(i + 1) - math.lgamma(n - i + 1) + i * math.log(p) + (n - i) * math.log1p(-p) for i in range(k + 1)]
    want = 1.0 if k > n * p else sum(map(math.exp, logs))
    assert math.isclose(got, want, rel_tol=1e-9)


def test_cutoffs_keep_good_documents(spark):
    """Junk goes, and of the good no more than the risk; a stratum without enough labels has no cutoff."""
    good = spark.range(4000).selectExpr("id doc_id", "concat(repeat(concat('w', id, ' '), 1), array_join(transform(sequence(1, 80), i -> concat('a', i)), ' ')) text", "'en' lang", "1 quality")
    junk = spark.range(4000, 4100).selectExpr("id doc_id", "array_join(transform(sequence(1, 80), i -> concat('a', i, '$$$$')), ' ') text", "if(id % 2 = 0, 'en', 'xx') lang", "0 quality")
    docs = good.union(junk)
    marks = docs.selectExpr("doc_id", "quality", "0 toxic")
    got = {r["doc_id"]: r["kept"] for r in q.judge(docs, marks).collect()}
    assert all(got[d] for d in range(4000))
    assert not any(got[d] for d in range(4000, 4100, 2)) and all(got[d] for d in range(4001, 4100, 2))
    kept = q.keep_good(docs, marks)
    assert kept.columns == docs.columns and kept.count() == 4050


def test_steps_equal_brute_force_and_reject_junk(spark):
    """Each stratum's step is the last of the path before the first failed test; some of the labelled junk goes."""
    docs = spark.read.parquet("/root/testdata/sf0.1/documents.parquet")
    marks = spark.read.parquet("/root/testdata/sf0.1/labels.parquet")
    figures = q.with_figures(docs.select("doc_id", "text", "lang")).withColumn("stratum", q.stratum(docs)).select("doc_id", "stratum", *q.FIGURES)
    figures = q.materialize(figures, "test-figures")
    rows = {r["doc_id"]: r for r in figures.collect()}
    quality = {r["doc_id"]: r["quality"] for r in marks.collect()}

    def values(r):
        w, n = max(r["n_words"], 1), max(r["n_lines"], 1)
        return {"symbols_per_word": r["n_symbols"] / w, "dup_line_share": r["n_dup_lines"] / n, "repeat_share": r["n_repeat_words"] / w,
                "long_words": r["word_chars"] / w, "short_words": -(r["word_chars"] / w)}

    def rejected(r, step):
        return any(v > q.path(rule)[step] for rule, v in values(r).items())

    passed = {d: r for d, r in rows.items() if r["n_words"] >= 50 and 100 * r["n_repeat_words"] <= 50 * r["n_words"]}
    good = {}
    for d, r in passed.items():
        if quality.get(d) == 1:
            good.setdefault(r["stratum"], []).append(r)
    testable = sum((1 - q.RISK) ** len(g) <= q.DELTA for g in good.values())
    want = {}
    for st, g in good.items():
        want[st], n = None, len(g)
        for step in range(q.STEPS):
            k = sum(rejected(r, step) for r in g)
            p = sum(math.exp(math.lgamma(n + 1) - math.lgamma(i + 1) - math.lgamma(n - i + 1) + i * math.log(q.RISK) + (n - i) * math.log1p(-q.RISK)) for i in range(k + 1))
            if k > n * q.RISK or p > q.DELTA / testable:
                break
            want[st] = step
    assert {r["stratum"]: r["step"] for r in q.cutoffs(figures, marks).collect()} == want
    assert testable == 4 and all(s is not None for s in want.values())
    junk = [r for d, r in passed.items() if quality.get(d) == 0]
    assert junk and sum(rejected(r, want[r["stratum"]]) for r in junk) > 0.9 * len(junk)


def test_chosen_cutoffs_hold_their_bound(spark, sf):
    docs = spark.read.parquet("/root/testdata/sf0.1/documents.parquet")
    marks = spark.read.parquet("/root/testdata/sf0.1/labels.parquet")
    judged = q.judge(docs, marks).join(docs.select("doc_id", "lang"), "doc_id").join(marks, "doc_id")
    rows = judged.where("quality = 1 and not base_failed").groupBy("lang").agg(F.avg((~F.col("kept")).cast("int")).alias("lost")).collect()
    assert rows and all(r["lost"] <= q.RISK for r in rows)


def test_empty(spark):
    docs = spark.createDataFrame([], "doc_id bigint, text string, lang string")
    assert q.judge(docs, labels(spark)).count() == 0 and q.keep_good(docs, labels(spark)).count() == 0
