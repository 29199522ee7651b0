"""License notices by diagonal voting.

Every word k-gram of every text is hashed and joined with the positions at which the templates have
the same k-gram. A match at word p of the text and word t of the template votes for the diagonal
p - t. Votes are counted for each diagonal; neighbouring diagonals (a word more or less inside the
notice) are merged; a merged run is a notice if the windows that voted cover enough of the template.
Each vote is checked word by word, so equal hashes of different words don't count.

The templates are a fixed small table, so they are broadcast; the words of a text are unfolded,
hashed, joined and filtered inside one stage, and only matches leave it.

Defined cases. Words are runs of bytes other than U+0000-002F, U+003A-0060 and U+007B-007F after
A-Z is lower-cased. Null or empty text: no words, null positions, empty labels, score 0. Every input
row is judged by itself, so repeated rows give repeated results; an empty table gives none. Columns
beyond doc_id and text play no part. A text of any length is taken whole.
"""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from affinity.session import materialize

K = 3
MIN_COVER = 0.8
MAX_DRIFT = 2
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
#: Words before lower-casing: A-Z are letters, all else as in the class above.
WORD_RE = r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"
#: Phrases whose words must stand consecutively, and their labels.
PHRASES = [("mit license", "mit"), ("apache license", "apache"), ("general public license", "gpl")]
#: Usual wordings of public notices and the label of each.
TEMPLATES = [
    ("mit", "released under the MIT License"),
    ("mit", "licensed under the MIT License"),
    ("mit", "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files"),
    ("apache", "Licensed under the Apache License, Version 2.0"),
    ("apache", "you may not use this file except in compliance with the License"),
    ("gpl", "licensed under the GNU General Public License, version"),
    ("gpl", "under the terms of the GNU General Public License as published by the Free Software Foundation"),
    ("lgpl", "under the terms of the GNU Lesser General Public License as published by"),
    ("bsd", "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met"),
    ("mpl", "This Source Code Form is subject to the terms of the Mozilla Public License"),
    ("isc", "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted"),
    ("cc-by-nc", "Licensed under CC BY-NC 4.0"),
    ("cc-by-sa", "Licensed under CC BY-SA 4.0"),
    ("cc-by", "licensed under a Creative Commons Attribution"),
    ("cc0", "dedicated to the public domain under CC0"),
    ("reserved", "all rights reserved no part of this publication may be reproduced"),
]


def template_words(text: str) -> list[str]:
    return re.findall(WORD_RE.replace(r"\x3A-\x40\x5B-\x60", r"\x3A-\x60"), text.translate(str.maketrans(UPPER, LOWER)))


def _positions(spark: SparkSession, templates) -> DataFrame:
    """One row for each k-gram of the templates (``gram``: its hash) with all places where it stands."""
    rows = []
    for t, (label, text) in enumerate(templates):
        words = template_words(text)
        rows += [(t, label, len(words), p, words[p : p + K]) for p in range(len(words) - K + 1)]
    table = spark.createDataFrame(rows, "template int, label string, length int, at int, words array<string>")
    gram = F.xxhash64(*[F.get("words", F.lit(i)) for i in range(K)])
    return table.groupBy(gram.alias("gram")).agg(F.collect_list(F.struct("template", "label", "length", "at", "words")).alias("places"))


def _plain(word: Column) -> Column:
    return F.translate(word, UPPER, LOWER)


def _phrase_label(words: Column, at: Column) -> Column:
    out = F.lit(None).cast("string")
    for phrase, label in PHRASES:
        same = F.lit(True)
        for i, w in enumerate(phrase.split()):
            word = F.get(words, at + i)
            same = same & (F.lower(word) == w) & (_plain(word) == w)
        out = F.when(same, F.lit(label)).otherwise(out)
    return out


def matches(docs: DataFrame, templates=TEMPLATES) -> DataFrame:
    """What is found in the texts, frozen: ``row`` (a number of the input row), doc_id, and either
    ``n_words`` (one such row for each text), or ``at`` with a phrase's label or template places."""
    spark = docs.sparkSession
    words = F.regexp_extract_all(F.coalesce(F.col("text"), F.lit("")), F.lit(WORD_RE), F.lit(0))
    texts = docs.select("doc_id", words.alias("words")).withColumn("row", F.monotonically_increasing_id())
    with_end = F.concat("words", F.array(F.lit(None).cast("string")))  # its place tells the number of words
    unfolded = texts.select("row", "doc_id", "words", F.posexplode(with_end).alias("at", "word"))
    lowered = [F.lower(F.get("words", F.col("at") + i)) for i in range(K)]
    joined = unfolded.withColumn("gram", F.xxhash64(*lowered)).join(
        F.broadcast(_positions(spark, templates)), "gram", "left"
    )
    phrase = _phrase_label(F.col("words"), F.col("at"))
    first = F.lower("word").isin(sorted({p.split()[0] for p, _ in PHRASES}))
    end = F.col("word").isNull()
    here = F.transform(F.slice("words", F.col("at") + 1, K), _plain)
    places = F.filter("places", lambda p: p["words"] == here)
    return materialize(
        joined.where(end | first | F.col("places").isNotNull())
        .select(
            "row", "doc_id", "at",
            F.when(end, F.col("at")).alias("n_words"),
            F.when(first, phrase).alias("phrase"),
            F.when(~end, places).alias("places"),
        ),
        "license-matches",
    )


def spans(found: DataFrame, min_cover: float = MIN_COVER) -> DataFrame:
    """Verified notices: row, label, first and last word, and the share of the template that is there."""
    votes = (
        found.where(F.size("places") > 0)
        .select("row", "at", F.explode("places").alias("p"))
        .select("row", F.col("p.template").alias("template"), F.col("p.label").alias("label"),
                F.col("p.length").alias("length"), F.col("p.at").alias("t"), (F.col("at") - F.col("p.at")).alias("diagonal"))
    )
    key = ["row", "template", "label", "length"]
    diagonals = votes.groupBy(*key, "diagonal").agg(F.collect_set("t").alias("ts"))
    w = Window.partitionBy(*key).orderBy("diagonal")
    apart = F.coalesce(F.col("diagonal") - F.lag("diagonal").over(w) > MAX_DRIFT, F.lit(True))
    runs = diagonals.withColumn("run", F.sum(F.when(apart, 1).otherwise(0)).over(w))
    windows = F.array_distinct(F.flatten(F.collect_list("ts")))
    covered = F.size(F.array_distinct(F.flatten(F.transform("windows", lambda t: F.sequence(t, t + (K - 1))))))
    return (
        runs.groupBy(*key, "run")
        .agg(windows.alias("windows"), F.min(F.col("diagonal") + F.array_min("ts")).alias("first_word"),
             F.max(F.col("diagonal") + F.array_max("ts") + (K - 1)).alias("last_word"))
        .withColumn("cover", covered / F.col("length"))
        .where((F.col("cover") >= min_cover) & (F.col("last_word") - F.col("first_word") < 2 * F.col("length")))
        .select("row", "label", "first_word", "last_word", "cover")
    )


def merged(notices: DataFrame) -> DataFrame:
    """Notices of one label that overlap, as wordings with common words do, as one: row, label, cover (the greatest)."""
    w = Window.partitionBy("row", "label").orderBy("first_word", "last_word")
    reach = F.max("last_word").over(w.rowsBetween(Window.unboundedPreceding, -1))
    runs = notices.withColumn("new", F.when(F.col("first_word") <= reach, 0).otherwise(1)).withColumn("run", F.sum("new").over(w))
    return runs.groupBy("row", "label", "run").agg(F.max("cover").alias("cover"))


def scan(docs: DataFrame, templates=TEMPLATES) -> DataFrame:
    """For every row: n_words, places of the base phrases and their labels, labels of both kinds, score."""
    found = matches(docs, templates)
    start = F.when(F.col("phrase").isNotNull(), F.col("at"))
    texts = found.groupBy("row", "doc_id").agg(
        F.max("n_words").cast("bigint").alias("n_words"),
        F.count("phrase").alias("n_base"),
        F.min(start).cast("bigint").alias("first_word"),
        F.max(start).cast("bigint").alias("last_word"),
        F.collect_set("phrase").alias("base"),
    )
    notices = merged(spans(found)).groupBy("row").agg(
        F.collect_set("label").alias("more"), F.max("cover").alias("cover"), F.count("*").alias("n_notices")
    )
    none = F.array().cast("array<string>")
    listed = lambda a: F.array_join(F.sort_array(a), ",")
    return texts.join(notices, "row", "left").select(
        "doc_id", "n_words", "n_base", "first_word", "last_word",
        listed(F.col("base")).alias("base_labels"),
        listed(F.array_union("base", F.coalesce("more", none))).alias("labels"),
        F.when(F.col("n_base") > 0, 1.0).otherwise(F.coalesce("cover", F.lit(0.0))).alias("score"),
        F.coalesce("n_notices", F.lit(0)).cast("bigint").alias("n_notices"),
    )
