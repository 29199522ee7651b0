import hashlib

from affinity.llm import secret_scan

HEX = hashlib.sha1(b"x").hexdigest()
WORDS = "the and thereon ering onthe with tionly that hening " * 12


def docs(spark):
    rows = [
        (1, f'{WORDS} token = "{HEX}" {WORDS}'), (2, f"{WORDS} 4929348385146306 {WORDS}"), (3, None), (4, ""),
        (5, f"see archive/2024/01/archive/page1.html {WORDS}"), (6, f'token = "{HEX}" and again token = "{HEX}"'),
        (6, f'token = "{HEX}" and again token = "{HEX}"'), (7, f"{WORDS} the_thing_version_2 {WORDS}"), (None, WORDS),
    ]
    return spark.createDataFrame(rows, "doc_id bigint, text string").selectExpr("*", "1 as length", "'x' as candidate")


def test_findings(spark):
    got = sorted((r["doc_id"], r["length"], r["candidate_sha256"]) for r in secret_scan.findings(docs(spark)).collect())
    digest = hashlib.sha256(HEX.encode()).hexdigest()
    assert got == [(1, 40, digest)] + [(6, 40, digest)] * 4


def test_candidates_are_all_places(spark):
    got = sorted((r["doc_id"], r["word"], r["candidate"]) for r in secret_scan.candidates(docs(spark)).collect())
    assert [g[0] for g in got] == [1, 2, 5, 6, 6, 6, 6, 7]
    assert got[0][2] == HEX and got[0][1] == len(WORDS.split()) + 2


def test_redact_keeps_all_else(spark):
    before, after = docs(spark), secret_scan.redact(docs(spark))
    assert after.columns == before.columns and after.count() == before.count()
    texts = {r["doc_id"]: r["text"] for r in after.collect()}
    for r in before.collect():
        want = r["text"] and r["text"].replace(HEX, secret_scan.MARK)
        assert texts[r["doc_id"]] == want


def test_given_labels_are_learned(spark):
    labelled = spark.createDataFrame(
        [(int(i % 2), "key =" if i % 2 else "see", f"{hashlib.md5(str(i).encode()).hexdigest()}", "x") for i in range(60)],
        "label int, left string, written string, right string",
    ).withColumnRenamed("label", "label").selectExpr("*", "written candidate")
    rows = spark.createDataFrame([(1, f"a key = {HEX} b"), (2, f"a b see {HEX} c")], "doc_id bigint, text string")
    got = {r["doc_id"]: r["secret"] for r in secret_scan.scan(rows, labelled).collect()}
    assert got == {1: True, 2: False}


def test_planted_lines_of_the_test_documents(spark):
    rows = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    planted = {r["doc_id"] for r in rows.where("contains(text, 'token = \"')").collect()}
    assert planted and {r["doc_id"] for r in secret_scan.findings(rows).collect()} == planted


def test_empty(spark):
    none = spark.createDataFrame([], "doc_id bigint, text string")
    assert secret_scan.findings(none).count() == 0 and secret_scan.redact(none).count() == 0


def test_rows_without_doc_id_are_redacted(spark):
    rows = docs(spark).where("doc_id is not null").union(docs(spark).where("doc_id = 1").selectExpr("cast(null as bigint)", "text", "length", "candidate"))
    rows = rows.union(docs(spark).where("doc_id is null"))
    after = secret_scan.redact(rows)
    texts = [r["text"] for r in after.where("doc_id is null").collect()]
    assert after.columns == rows.columns and after.count() == rows.count()
    assert sorted(texts) == sorted([WORDS, f'{WORDS} token = "{secret_scan.MARK}" {WORDS}'])
