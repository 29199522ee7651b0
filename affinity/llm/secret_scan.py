"""Secrets in text, with a random forest against false positives.

Candidates are strings of at least 16 characters of ``A-Za-z0-9_+/=-`` with a digit, within the words
between white space. For each the forest sees its length, how its characters follow one another
(changes of class, rare pairs), how far frequent letter groups of the corpus cover it, whether it
looks like a path, and what words stand beside it. It is trained on labelled findings: given ones, or
those of ``labelled_findings``, which writes secrets of known kinds and usual false positives around
words drawn from the corpus. A finding is kept where the forest's probability is over one half.
All of it runs in the JVM.

Defined cases. Null or empty text: no candidate. Every occurrence is a finding; equal rows give equal
findings; a text is read whole. Empty tables give empty results. Columns beyond doc_id and text play no
part, but ``redact`` returns them; it knows rows without a doc_id by a 64-bit hash of their text. A corpus without words has no frequent letter groups (cover 0).
"""

from __future__ import annotations

from pyspark.ml.classification import RandomForestClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from affinity.llm.graph import join_sized
from affinity.llm.text import id_or_text_hash, let, space_words
from affinity.session import materialize

CANDIDATE = r"[A-Za-z0-9_+/=\-]{16,}"
GROUPS = 2_000  # frequent letter groups that make the dictionary
TRAINING = 4_000  # labelled findings that are made, at most
TREES, DEPTH, SEED = 20, 6, 7
MARK = "[SECRET]"
#: Words beside a secret.
HINTS = "token|secret|password|passwd|pwd|api|apikey|key|auth|bearer|credential|access|private"
FEATURES = [
    "length", "digits", "uppers", "letters", "symbols", "changes", "distinct", "runs", "hex",
    "cover", "slashes", "dots", "assigned", "quoted", "hinted",
]


def candidates(docs: DataFrame) -> DataFrame:
    """doc_id, word (its number), candidate, and the words around it, for every place."""
    words = docs.select("doc_id", space_words(F.col("text")).alias("words"))
    each = words.select("doc_id", "words", F.posexplode("words").alias("word", "written"))
    some = (F.octet_length("written") >= 16) & F.col("written").rlike(r"[0-9]") & F.col("written").rlike(CANDIDATE)
    at = lambda d: F.coalesce(F.get("words", F.col("word") + d), F.lit(""))
    found = each.where(some).select(
        "doc_id", "word", "written",
        F.concat_ws(" ", at(-2), at(-1)).alias("left"), at(1).alias("right"),
        F.explode(F.regexp_extract_all("written", F.lit(CANDIDATE), F.lit(0))).alias("candidate"),
    )
    return found.where(F.col("candidate").rlike("[0-9]"))


def letter_groups(docs: DataFrame, groups: int = GROUPS) -> DataFrame:
    """The most frequent letter triples (``triple``) of the corpus's words, counted over all texts."""
    words = docs.select(F.explode(space_words(F.lower(F.col("text")))).alias("w")).groupBy("w").agg(F.count("*").alias("n"))
    triples = words.where(F.col("w").rlike("^[a-z]{3,30}$")).select(
        F.explode(F.transform(F.sequence(F.lit(1), F.length("w") - 2), lambda i: F.substring("w", i, F.lit(3)))).alias("triple"), "n"
    )
    return triples.groupBy("triple").agg(F.sum("n").alias("n")).orderBy(F.desc("n"), "triple").limit(groups).select("triple")


def with_features(found: DataFrame, groups: DataFrame) -> DataFrame:
    """The figures of each candidate. ``groups`` is bounded (``letter_groups``), so it becomes a constant."""
    known = F.split(F.lit(" ".join(sorted(r["triple"] for r in groups.collect()))), " ")
    c = F.col("candidate")
    n = F.length(c).cast("double")
    share = lambda pattern: F.regexp_count(c, F.lit(pattern)) / n
    classes = F.regexp_replace(F.regexp_replace(F.regexp_replace(c, "[a-z]", "a"), "[A-Z]", "A"), "[0-9]", "0")
    changes = let(
        classes,
        lambda k: F.size(F.filter(F.sequence(F.lit(2), F.greatest(F.lit(2), F.length(k))), lambda i: F.substring(k, i, F.lit(1)) != F.substring(k, i - 1, F.lit(1)))),
    )
    low = F.lower(c)
    triples = F.array_distinct(F.transform(F.sequence(F.lit(1), F.length(c) - 2), lambda i: F.substring(low, i, F.lit(3))))
    around = F.lower(F.concat_ws(" ", "left", F.call_function("substring_index", F.col("written"), c, F.lit(1))))
    flag = lambda x: F.coalesce(x, F.lit(False)).cast("double")
    return found.withColumns(
        {
            "length": n,
            "digits": share("[0-9]"), "uppers": share("[A-Z]"), "letters": share("[A-Za-z]"), "symbols": share(r"[_+/=\-]"),
            "changes": changes / n,
            "distinct": F.size(F.array_distinct(F.split(c, ""))) / n,
            "runs": share(r"(.)\1"),
            "hex": flag(c.rlike("^[0-9a-fA-F]+$")),
            "cover": F.size(F.array_intersect(triples, known)) / F.size(triples),
            "slashes": F.regexp_count(c, F.lit("/")).cast("double"),
            "dots": F.regexp_count("written", F.lit(r"\.")).cast("double"),
            "assigned": flag(around.rlike(r"[=:]\W*$")),
            "quoted": flag(F.col("written").rlike("[\"'`]")),
            "hinted": flag(around.rlike(rf"(^|[^a-z])({HINTS})[^a-z]*$")),
        }
    )


def labelled_findings(docs: DataFrame, at_most: int = TRAINING) -> DataFrame:
    """Labelled findings (``label`` 1: a secret) around words of the corpus, at most ``at_most``.

    Secrets are digests in the forms of usual keys behind an assignment; the others are identifiers,
    paths, dates, numbers, placeholders and digests that name content, where no secret is meant.
    """
    words = docs.select(F.explode(F.slice(space_words(F.col("text")), 1, 50)).alias("w")).where(F.col("w").rlike("^[A-Za-z]{2,20}$"))
    some = words.distinct().orderBy(F.xxhash64("w"), "w").limit(max(1, at_most // 11))
    w, digest = F.col("w"), lambda salt: F.sha2(F.concat(F.lit(salt), "w"), 256)
    b64 = lambda salt: F.regexp_replace(F.base64(F.unhex(digest(salt))), r"\s", "")
    upper = lambda salt: F.upper(F.conv(F.substring(digest(salt), 1, 15), 16, 36))
    number = lambda salt: F.substring(F.regexp_replace(digest(salt), "[a-f]", ""), 1, 16)
    kinds = [
        (1, "token =", F.concat(F.lit('"'), F.substring(digest("a"), 1, 40), F.lit('"'))),
        (1, "api key:", F.concat(F.lit("AKIA"), upper("b"), upper("c"))),
        (1, "password =", F.concat(F.lit("'"), F.substring(b64("d"), 1, 28), F.lit("'"))),
        (1, "secret", F.concat(F.lit("key="), F.substring(b64("e"), 1, 40))),
        (0, "see", F.concat(w, F.lit("/"), F.lower(w), F.lit("/2024/01/"), w, F.lit("/page1.html"))),
        (0, "the", F.concat(F.lower(w), F.lit("_"), F.lower(w), F.lit("_version_2"))),
        (0, "token =", F.concat(F.lit('"your_token_here_'), F.repeat(F.lit("0"), 12), F.lit('"'))),
        (0, "the", number("f")),
        (0, "of", F.concat(number("g"), F.lit("!!"))),
        (0, "commit", F.substring(digest("h"), 1, 40)),
        (0, "of", F.concat(F.lower(w), F.lit("-"), F.lower(w), F.lit("-2024-01-31"))),
    ]
    rows = None
    for label, left, written in kinds:
        row = some.select(
            F.lit(label).alias("label"), F.concat_ws(" ", w, F.lit(left)).alias("left"), written.alias("written"), w.alias("right")
        )
        rows = row if rows is None else rows.union(row)
    return rows.withColumn("candidate", F.explode(F.regexp_extract_all("written", F.lit(CANDIDATE), F.lit(0))))


def fit(labelled: DataFrame, groups: DataFrame):
    """A forest from ``candidate``, ``written``, ``left``, ``right`` and ``label``; None without both labels."""
    rows = materialize(with_features(labelled, groups).select(*FEATURES, F.col("label").cast("double")), "secret-training")
    if rows.select("label").distinct().count() < 2:
        return None
    rows = VectorAssembler(inputCols=FEATURES, outputCol="__features").transform(rows)
    forest = RandomForestClassifier(featuresCol="__features", labelCol="label", numTrees=TREES, maxDepth=DEPTH, seed=SEED)
    return forest.fit(rows)


def scan(docs: DataFrame, labelled: DataFrame | None = None, groups: int = GROUPS) -> DataFrame:
    """All candidates: doc_id, word, candidate, score, secret (boolean)."""
    known = materialize(letter_groups(docs, groups), "secret-triples")
    labelled = materialize(labelled_findings(docs), "secret-labelled") if labelled is None else labelled
    model = fit(labelled, known)
    found = with_features(candidates(docs), known)
    if model is None:
        return found.select("doc_id", "word", "candidate", F.lit(0.0).alias("score"), F.lit(False).alias("secret"))
    found = VectorAssembler(inputCols=FEATURES, outputCol="__features").transform(found)
    scored = model.transform(found).withColumn("score", F.get(vector_to_array("probability"), F.lit(1)))
    return scored.select("doc_id", "word", "candidate", "score", (F.col("score") > 0.5).alias("secret"))


def findings(docs: DataFrame, labelled: DataFrame | None = None) -> DataFrame:
    """The candidates that the forest takes for secrets; each is told by its digest, not itself."""
    found = scan(docs, labelled).where("secret")
    return found.select(
        "doc_id", F.col("word").cast("bigint").alias("word"), F.length("candidate").cast("bigint").alias("length"),
        F.sha2("candidate", 256).alias("candidate_sha256"), "score",
    )


def redact(docs: DataFrame, labelled: DataFrame | None = None) -> DataFrame:
    """``docs`` with every secret replaced by a mark in its text; all rows and columns stay."""
    key = id_or_text_hash()
    found = scan(docs.select(key.alias("doc_id"), "text"), labelled).where("secret")
    found = found.groupBy(F.col("doc_id").alias("__key")).agg(F.collect_set("candidate").alias("__secrets"))
    found = materialize(found, "secret-found")
    # longer ones first, so that none is cut by a shorter one within it
    ordered = F.transform(
        F.sort_array(F.transform("__secrets", lambda s: F.struct(F.length(s).alias("n"), s.alias("s"))), asc=False), lambda x: x["s"]
    )
    replaced = F.aggregate(ordered, F.col("text"), lambda text, s: F.replace(text, s, F.lit(MARK)))
    rows = join_sized(docs.withColumn("__key", key), found, "__key", "left", row_bytes=512)
    return rows.withColumn("text", F.when(F.col("__secrets").isNull(), F.col("text")).otherwise(replaced)).select(*docs.columns)
