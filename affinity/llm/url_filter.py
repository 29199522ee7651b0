"""URL filter: host and path rules first, then a logistic regression on hashed character n-grams.

A url is cut at its first ``://``: the host ends at ``/``, ``?``, ``#`` or the end and is lower-cased
in A-Z; the path runs from there to ``?``, ``#`` or the end. The longest fitting rule decides. Where
none fits, a logistic regression judges, fitted on a small labelled table of urls by hashed character
n-grams of host and path (host and path n-grams are kept apart by a mark). All of it runs in the JVM.

Defined cases. Null url or no ``://``: host and path are empty, and the model judges the empty text,
which has no n-gram and gets the intercept's verdict. Repeated rows are judged each; an empty table
gives an empty result; columns beyond page_id and url play no part. Equally long fitting rules: the
alphabetically first.
"""

from __future__ import annotations

from pyspark.ml.classification import LogisticRegression
from pyspark.ml.feature import HashingTF
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: The host and path rules.
RULES = [
    ("net/", "block"),
    ("example.net/en/", "allow"),
    ("example.com/de/", "block"),
    ("org/fr/", "allow"),
]
N_GRAMS = (3, 4, 5)
BUCKETS = 1 << 16
#: The labelled table is made of these words, each in the forms below.
UNWANTED = (
    "casino poker roulette jackpot slots betting bets gambling lottery pills viagra cialis pharmacy "
    "payday loans forex xxx porn adult escort cheap-watches replica free-money win-cash get-rich "
    "hot-singles cheap-meds casino-win free-bets cheap-pills click-bonus"
).split()
WANTED = (
    "news blog wiki docs library school university science history recipes garden travel weather "
    "museum health sports music books maps forum archive research journal city museum-guide "
    "open-data math physics biology chemistry language grammar poetry film theatre radio"
).split()
FORMS = [
    "https://{w}.example.com/en/{n}", "http://www.{w}.example.org/de/{n}.html",
    "https://m.{w}.example.com/fr/{n}/", "http://blog.{w}.example.net/es/{n}?page=2",
    "https://site.example.com/{w}/{n}", "https://www.{w}-{n}.example.org/en/",
]


def host(url: Column) -> Column:
    found = F.regexp_extract(F.coalesce(url, F.lit("")), r"(?s)^.*?://([^/?#]*)", 1)
    return F.translate(found, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def path(url: Column) -> Column:
    return F.regexp_extract(F.coalesce(url, F.lit("")), r"(?s)^.*?://[^/?#]*(/[^?#]*)", 1)


def rule_for(host: Column, path: Column, rules=RULES) -> Column:
    """The longest rule that fits, else null."""
    out = F.lit(None).cast("string")
    for rule, _ in sorted(rules, key=lambda r: (len(r[0]), [-ord(c) for c in r[0]])):
        name, slash, rest = rule.partition("/")
        fits = ((host == name) | host.endswith("." + name)) & path.startswith(slash + rest)
        out = F.when(fits, F.lit(rule)).otherwise(out)
    return out


def labelled_urls(spark: SparkSession) -> DataFrame:
    """The small labelled table: ``url`` and ``label`` (1: unwanted)."""
    words = [(w, 1) for w in UNWANTED] + [(w, 0) for w in WANTED]
    plain = ["thth", "onen", "ering", "leau", "verein", "ciones", "hasti", "andre", "tionst", "enle"]
    words += [(w, 0) for w in plain]
    rows = [
        (form.format(w=w, n=1000 + (131 * i + 977 * k) % 9000), label)
        for i, (w, label) in enumerate(words) for k, form in enumerate(FORMS)
    ]
    return spark.createDataFrame(rows, "url string, label int")


def _grams(text: Column, mark: str) -> Column:
    """Character n-grams of a text with ends marked, each with the part's mark before it."""

    def of(n):
        padded = F.concat(F.lit("^"), text, F.lit("$"))
        return F.when(F.length(text) == 0, F.array().cast("array<string>")).otherwise(
            F.transform(
                F.sequence(F.lit(1), F.greatest(F.lit(1), F.length(padded) - n + 1)),
                lambda i: F.concat(F.lit(mark), F.substring(padded, i, F.lit(n))),
            )
        )

    return F.flatten(F.array(*[of(n) for n in N_GRAMS]))


def _features(df: DataFrame, out: str) -> DataFrame:
    grams = F.concat(_grams(F.col("host"), "h:"), _grams(F.col("path"), "p:"))
    tf = HashingTF(numFeatures=BUCKETS, binary=True, inputCol="__grams", outputCol=out)
    return tf.transform(df.withColumn("__grams", grams)).drop("__grams")


def fit(labelled: DataFrame, reg: float = 0.01):
    """The model from ``url`` and ``label`` (0 or 1); the table is small by contract."""
    rows = labelled.where("label is not null").select(
        host(F.col("url")).alias("host"), path(F.col("url")).alias("path"), F.col("label").cast("double").alias("label")
    )
    lr = LogisticRegression(featuresCol="__features", labelCol="label", regParam=reg, maxIter=60)
    return lr.fit(_features(rows.coalesce(1), "__features"))


def judge(pages: DataFrame, labelled: DataFrame, rules=RULES, reg: float = 0.01) -> DataFrame:
    """page_id, host, path, rule, score (the model's probability of unwanted) and verdict."""
    url = pages.select("page_id", host(F.col("url")).alias("host"), path(F.col("url")).alias("path"))
    scored = fit(labelled, reg).transform(_features(url, "__features"))
    verdicts = F.create_map(*[F.lit(x) for pair in rules for x in pair])
    score = F.get(vector_to_array("probability"), F.lit(1))
    by_model = F.when(score > 0.5, "block").otherwise("allow")
    return (
        scored.withColumn("rule", rule_for(F.col("host"), F.col("path"), rules))
        .select("page_id", "host", "path", "rule", score.alias("score"),
                F.when(F.col("rule").isNotNull(), F.element_at(verdicts, F.col("rule"))).otherwise(by_model).alias("verdict"))
    )
