import random
import re

import numpy as np
import pytest

from affinity.llm import jaccard_join
from affinity.llm.graph import components

UPPER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def brute(rows, n, num, den):
    sets = []
    for _, text in rows:
        words = re.findall(r"[^\x20\x09-\x0D]+", (text or "").translate(UPPER))
        grams = {tuple(words[i : i + n]) for i in range(len(words) - n + 1)}
        sets.append(grams or ({tuple(words)} if words else set()))
    root = list(range(len(rows)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for i in range(len(rows)):
        for j in range(i):
            both = len(sets[i] & sets[j])
            if sets[i] and sets[j] and den * both >= num * len(sets[i] | sets[j]):
                root[find(i)] = find(j)
    least = {}
    for i, (d, _) in enumerate(rows):
        if d is not None:
            least[find(i)] = min(d, least.get(find(i), d))
    return sorted((d, len(sets[i]), least.get(find(i), d)) for i, (d, _) in enumerate(rows) if d is not None)


def family(seed=3, docs=260):
    """Random texts, with chains of near copies of all sizes, exact copies and a passage in a third."""
    rng = random.Random(seed)
    word = lambda: "".join(rng.choice("abcdefgh") for _ in range(rng.randrange(1, 5)))
    passage = " ".join(word() for _ in range(40))
    rows, texts = [], []
    for d in range(docs):
        kind = rng.random()
        if kind < 0.6 and texts:
            words = rng.choice(texts).split()
            for _ in range(rng.randrange(0, 4)):
                if words:
                    words[rng.randrange(len(words))] = word()
            text = " ".join(words)
        else:
            text = " ".join(word() for _ in range(rng.choice([0, 1, 2, 3, 5, 8, 13, 30, 60, 120, 240])))
            if rng.random() < 0.33:
                text += " " + passage
        texts.append(text)
        rows.append((d * 7 % docs, text))
    return rows + [(docs, None), (docs + 1, ""), (docs + 2, " \t\n"), rows[0], (None, rows[1][1])]


@pytest.mark.parametrize("n, num, den, region", [(3, 90, 100, 4000), (5, 80, 100, 4000), (2, 80, 100, 12), (1, 70, 100, 6)])
def test_components_equal_brute_force(spark, n, num, den, region):
    rows = family()
    docs = spark.createDataFrame(rows, "doc_id bigint, text string").selectExpr("*", "1 as entity", "2 as region")
    got = jaccard_join.join(docs.repartition(3), n, num, den, region).where("doc_id is not null").collect()
    assert sorted(map(tuple, got)) == brute(rows, n, num, den)


def test_over_test_documents(spark, sf):
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    rows = [tuple(r) for r in docs.select("doc_id", "text").collect()]
    got = jaccard_join.join(docs, 3, 90, 100).collect()
    assert sorted(map(tuple, got)) == brute(rows, 3, 90, 100)


def test_keep_one(spark):
    rows = family()
    docs = spark.createDataFrame(rows, "doc_id bigint, text string").selectExpr("*", "'x' as rows")
    kept = jaccard_join.keep_one(docs, 5, 80, 100)
    assert kept.columns == docs.columns
    want = {c for d, _, c in brute(rows, 5, 80, 100)}
    got = [r["doc_id"] for r in kept.where("doc_id is not null").collect()]
    assert sorted(got) == sorted(want)


def test_a_row_without_an_id_connects_others(spark):
    words = [f"w{i}" for i in range(60)]
    text = lambda a, b: " ".join(words[a:b])
    rows = [(1, text(0, 44)), (None, text(4, 48)), (2, text(8, 52)), (3, text(30, 60)), (None, "alone")]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string")
    got = sorted(tuple(r) for r in jaccard_join.join(docs, 3, 80, 100).where("doc_id is not null").collect())
    assert got == brute(rows, 3, 80, 100) == [(1, 42, 1), (2, 42, 1), (3, 28, 3)]


def test_empty(spark):
    docs = spark.createDataFrame([], "doc_id bigint, text string")
    assert jaccard_join.join(docs, 3, 90, 100).count() == 0
    assert jaccard_join.keep_one(docs).count() == 0


def test_components_of_a_long_path_and_a_star(spark):
    edges = [(i, i + 1) for i in range(300)] + [(1000, i) for i in range(1001, 1200)] + [(5000, 5000)]
    got = {tuple(r) for r in components(spark.createDataFrame(edges, "a bigint, b bigint")).collect()}
    assert got == {(i, 0) for i in range(301)} | {(i, 1000) for i in range(1000, 1200)}


def passages(seed=5, docs=60):
    """Texts that are a third or more one passage, each with near copies of its own, fewer than ten."""
    rng = random.Random(seed)
    word = lambda: "".join(rng.choice("abcdefgh") for _ in range(4))
    passage = [word() for _ in range(60)]
    rows = []
    for _ in range(docs):
        own = [word() for _ in range(rng.choice([50, 70, 90]))]
        for _ in range(rng.randrange(1, 8)):
            words = own + passage
            for _ in range(rng.randrange(0, 3)):
                words[rng.randrange(len(words))] = word()
            rows.append((len(rows), " ".join(words)))
    return rows


@pytest.mark.parametrize("most", [20_000, 3])
def test_a_region_of_a_shared_passage_is_cut_without_copies_of_its_sets(spark, monkeypatch, most):
    """A large region's sets went to nearly all of its pivots, as they are as far from any of them. Lists of more
    than ``most`` sets are connected without comparison, after which pivots may be needed."""
    rows = passages()
    docs = spark.createDataFrame(rows, "doc_id bigint, text string")
    cells = components(jaccard_join._candidates(docs, 2, 80, 100)).groupBy("root").count()
    assert cells.agg({"count": "max"}).first()[0] > 100
    monkeypatch.setattr(jaccard_join, "LIST", most)
    if most > 3:
        monkeypatch.setattr(jaccard_join, "_split", lambda *a: pytest.fail("pivots"))
    got = jaccard_join.join(docs.union(docs.limit(3)).repartition(3), 2, 80, 100, 12).dropDuplicates(["doc_id"])
    assert sorted(map(tuple, got.collect())) == brute(rows, 2, 80, 100)


def test_sets_that_link_share_a_rare_n_gram_and_have_near_marks():
    rng = np.random.default_rng(2)
    counts = rng.integers(0, 50, jaccard_join.BUCKETS)
    for size in (1, 5, 60, 64, 65, 130, 500, 1100, 20_000):
        for _ in range(20):
            whole = np.unique(rng.integers(0, 1 << 64, size, dtype=np.uint64))
            lost = rng.permutation(whole)[: int(rng.integers(0, max(1, size // 4) + 1))]
            a, b = whole, np.union1d(np.setdiff1d(whole, lost), rng.integers(0, 1 << 64, int(rng.integers(0, size // 8 + 1)), dtype=np.uint64))
            if not len(b):
                continue
            a, b = sorted((a, b), key=len)
            both, either = len(np.intersect1d(a, b)), len(np.union1d(a, b))
            marked = jaccard_join.Marked([0, 1], np.array([len(a), len(b)]), np.concatenate((jaccard_join.mark(a), jaccard_join.mark(b))))
            assert marked.differ(0, np.array([1]))[0] <= either - both
            found = []
            marked.edges(80, 100, lambda x: x, lambda x, y: found.append((x, y)))
            if 100 * both >= 80 * either:
                assert found == [(0, 1)]
                assert len(np.intersect1d(*[jaccard_join.rarest(s, counts, 80, 100) for s in (a, b)]))
    far = [np.unique(rng.integers(0, 1 << 64, 900, dtype=np.uint64)) for _ in range(2)]
    marked = jaccard_join.Marked([0, 1], np.array([900, 900]), np.concatenate([jaccard_join.mark(s) for s in far]))
    assert marked.differ(0, np.array([1]))[0] > 300
