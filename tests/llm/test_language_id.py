import zlib
from collections import Counter

from affinity.llm import language_id as lang


def counts(text):
    words = "".join(c if c.isalpha() else " " for c in text.lower()).split()
    out = Counter()
    for w in words:
        padded = f" {w} "
        out.update(w)
        out.update(padded[i : i + 2] for i in range(len(padded) - 1))
        out.update(padded[i : i + 3] for i in range(len(padded) - 2))
    return out


def profile(counter, size):
    return [g for g, _ in sorted(counter.items(), key=lambda x: (-x[1], x[0]))[:size]]


def brute(rows, size):
    learned = {}
    for d, text, language in rows:
        if text is not None and language is not None and d is not None and zlib.crc32(str(d).encode()) % 5:
            learned.setdefault(language, Counter()).update(counts(text))
    learned = {k: {g: i for i, g in enumerate(profile(v, size))} for k, v in sorted(learned.items())}
    out = []
    for d, text, _ in rows:
        own = profile(counts(text or ""), size)
        held = d is None or zlib.crc32(str(d).encode()) % 5 == 0
        if not own or not learned:
            out.append((d, held, "und", 0.0))
            continue
        far = {k: sum(abs(p[g] - i) if g in p else size for i, g in enumerate(own)) for k, p in learned.items()}
        best = min(far, key=lambda k: (far[k], k))
        out.append((d, held, best, round(1 - far[best] / (len(own) * size), 9)))
    return sorted(out, key=str)


def got(frame):
    return sorted(((r["doc_id"], r["held_out"], r["lang_pred"], round(r["score"], 9)) for r in frame.collect()), key=str)


def test_equal_brute_force(spark, sf):
    rows = [(r["doc_id"], r["text"], r["lang"]) for r in spark.read.parquet(f"{sf}/documents.parquet").collect()]
    rows += [(9000, None, "en"), (9001, "", "en"), (9002, "12 !?", None), (9003, "中文 字 中文", "zh"), (9004, "中文", None), (9004, "中文", None),
             (None, "the thing", "en"), (9005, "x", "en"), (9006, "\U00010400\U00010428 b", "zz"), (9007, "İzmir Σίσυφος", "tr")]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, lang string").selectExpr("*", "1 as score", "2 as gram")
    for size in (20, lang.SIZE):
        assert got(lang.identify(docs.repartition(3), size)) == brute(rows, size)


def test_order_and_partitions_change_nothing(spark, sf):
    docs = spark.read.parquet(f"{sf}/documents.parquet").unionByName(
        spark.createDataFrame([(9000, "abc", "en"), (9001, "xyz.", "en"), (9002, "..", "en"), (9003, "de", "fr")], "doc_id bigint, text string, lang string"),
        allowMissingColumns=True,
    )
    one, many = docs.coalesce(1).orderBy("doc_id"), docs.repartition(7).sortWithinPartitions("text")
    assert got(lang.identify(one)) == got(lang.identify(many))


def test_a_text_has_its_own_ngrams_only():
    both = lang.Grams(["abc", "xyz.", "", "d"], lang.np.arange(4))
    for i, text in enumerate(["abc", "xyz.", "", "d"]):
        mine = both.group == i
        assert dict(zip(both.strings(both.gram[mine]), both.count[mine].tolist())) == counts(text)


def test_accuracy_on_held_out_documents(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    found = lang.identify(docs).join(docs.select("doc_id", "lang"), "doc_id").where("held_out")
    assert found.selectExpr("avg(int(lang = lang_pred))").first()[0] > 0.97


def test_nothing_learned_and_empty(spark):
    docs = spark.createDataFrame([(1, "word", None)], "doc_id bigint, text string, lang string")
    assert got(lang.identify(docs))[0][2:] == ("und", 0.0)
    assert lang.identify(docs.limit(0)).count() == 0
