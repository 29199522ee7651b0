import re

from affinity.llm import license_scan

COLUMNS = ["doc_id", "n_words", "n_base", "first_word", "last_word", "base_labels"]


def brute(text):
    lowered = (text or "").translate(str.maketrans(license_scan.UPPER, license_scan.LOWER))
    words = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", lowered)
    places, labels = [], set()
    for phrase, label in license_scan.PHRASES:
        p = phrase.split()
        found = [i for i in range(len(words)) if words[i : i + len(p)] == p]
        places += found
        labels |= {label} if found else set()
    return len(words), len(places), min(places, default=None), max(places, default=None), ",".join(sorted(labels))


ROWS = [
    (1, None), (2, ""), (3, "MIT License mit license"), (4, "mit-license; Apache. LICENSE general public license"),
    (5, "The general public licenses mit licensKe"), (6, "x " * 500 + "Released under the MIT License. " * 3),
    (7, "Licensed under CC BY-NC 4.0."), (8, "Licensed under the fine CC BY-NC 4.0"), (9, "licensed under nothing"),
    (10, "you may not use this file except in strict compliance with the License"), (11, "lİcense mıt license"), (3, "again"),
]


def test_base_equals_brute_force(spark, sf):
    rows = ROWS + [(r["doc_id"] + 100, r["text"]) for r in spark.read.parquet(f"{sf}/documents.parquet").collect()]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string").selectExpr("*", "1 as words", "2 as n_words")
    got = sorted((tuple(r[c] for c in COLUMNS) for r in license_scan.scan(docs).collect()), key=str)
    assert got == sorted(((d, *brute(t)) for d, t in rows), key=str)


def test_notices(spark):
    docs = spark.createDataFrame(ROWS, "doc_id bigint, text string")
    got = {r["doc_id"]: r for r in license_scan.scan(docs).collect()}
    assert got[6]["labels"] == "mit" and got[6]["n_notices"] == 3
    assert got[7]["labels"] == "cc-by-nc" and got[7]["score"] == 1.0 and got[7]["base_labels"] == ""
    assert got[8]["labels"] == ""  # two windows of five are left: less than the cover asked for
    # a word more: all words of the wording are there, on two neighbouring diagonals
    assert got[10]["labels"] == "apache" and got[10]["score"] == 1.0 and got[10]["n_notices"] == 1
    assert got[9]["labels"] == "" and got[1]["score"] == 0


def test_empty(spark):
    assert license_scan.scan(spark.createDataFrame([], "doc_id bigint, text string")).count() == 0
