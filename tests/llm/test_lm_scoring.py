import math
from collections import Counter

from affinity.llm import lm_scoring as lm

UPPER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def words(text):
    return [w for w in "".join(" " if c in " \t\n\x0b\x0c\r" else c for c in (text or "").translate(UPPER)).split(" ") if w]


def frequent(counter, size):
    """Entries with the least count, or more, that at most ``size`` entries have."""
    fits = [n for n in counter.values() if sum(m >= n for m in counter.values()) <= size]
    return {x for x, n in counter.items() if fits and n >= min(fits)}


def brute(rows, target, size, bigrams):
    texts = {"t": [words(t) for t in target], "b": [words(t) for _, t in rows]}
    total = Counter(w for ts in texts.values() for t in ts for w in t)
    kept = sorted(frequent(total, size), key=lambda w: (-total[w], w))
    number = {w: i + 1 for i, w in enumerate(kept)}
    n = len(kept) + 1
    pairs = {}
    for m, ts in texts.items():
        pairs[m] = Counter()
        for t in ts:
            ids = [0] + [number.get(w, 0) for w in t]
            pairs[m].update(zip(ids, ids[1:]))
    both = pairs["t"] + pairs["b"]
    known = frequent(both, bigrams)
    out = []
    for d, text in rows:
        ids = [0] + [number.get(w, 0) for w in words(text)]
        means = []
        for m, own in (("t", 0), ("b", 1)):
            unigrams, firsts = Counter(), Counter()
            for (u, v), c in pairs[m].items():
                unigrams[v] += c
                firsts[u] += c
            loss = 0.0
            for u, v in zip(ids, ids[1:]):
                plain = (max(unigrams[v] - own, 0) + 1) / (sum(unigrams.values()) - own + n)
                seen = firsts[u] - own
                pair = max(pairs[m][u, v] - own, 0) if (u, v) in known else 0
                loss -= math.log(lm.MIX * pair / max(seen, 1) + (1 - lm.MIX) * plain if seen > 0 else plain)
            means.append(loss / max(1, len(ids) - 1))
        out.append((d, len(ids) - 1, round(means[1] - means[0], 9) + 0.0))
    return sorted(out)


def test_scores_equal_brute_force(spark):
    rows = [(1, "the cat sat on the mat"), (2, "The dog sat"), (3, None), (4, ""), (5, "é zz zz zz"), (5, "é zz zz zz"), (6, "the cat\tsat " * 30)]
    target = ["the cat sat", "the cat ran", None]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string").selectExpr("*", "1 as score", "'x' as word").repartition(2)
    aims = spark.createDataFrame([(t,) for t in target], "text string")
    for size, bigrams in ((100, 1000), (3, 4), (0, 0)):
        got = lm.cross_entropy_difference(docs, aims, size, bigrams).collect()
        assert sorted((r["doc_id"], r["n_tokens"], round(r["score"], 9) + 0.0) for r in got) == brute(rows, target, size, bigrams)


def test_target_like_documents_score_higher(spark):
    rows = [(i, " ".join(f"a{(i * j) % 7}" for j in range(60))) for i in range(40)]
    rows += [(100 + i, " ".join(f"b{(i + j * j) % 9}" for j in range(60))) for i in range(40)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string")
    aims = docs.where("doc_id < 20").select("text")
    got = {r["doc_id"]: r["score"] for r in lm.cross_entropy_difference(docs, aims).collect()}
    assert min(got[i] for i in range(20, 40)) > max(got[i] for i in range(100, 140))


def test_empty(spark):
    docs = spark.createDataFrame([], "doc_id bigint, text string")
    assert lm.cross_entropy_difference(docs, docs.select("text")).count() == 0
    some = spark.createDataFrame([(1, "a b")], "doc_id bigint, text string")
    assert lm.cross_entropy_difference(some, docs.select("text")).count() == 1


def test_nothing_is_cut_unless_asked(spark):
    """More equally frequent words than any fixed vocabulary (50,000 before, and then none was known):
    all words and pairs count, and two texts of other words of the target are told apart."""
    n = 60_000
    half = " ".join(f"w{i}" for i in range(n // 2))
    rest = " ".join(f"w{i}" for i in range(n // 2, n))
    rows = [(1, half), (2, rest), (2, rest), (None, "w1 w2 w1"), (None, None)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string").repartition(3)
    aims = spark.createDataFrame([(half,)], "text string")
    got = lm.cross_entropy_difference(docs, aims).collect()
    scores = {r["doc_id"]: r["score"] for r in got if r["n_tokens"] > 3}
    assert sorted(r["n_tokens"] for r in got) == [0, 3, n // 2, n // 2, n // 2] and scores[1] > 1 > 0 > scores[2]


def test_without_limits_equals_brute_force(spark, sf):
    rows = [(r["doc_id"], r["text"]) for r in spark.read.parquet(f"{sf}/documents.parquet").limit(40).collect()]
    target = [r["text"] for r in spark.read.parquet(f"{sf}/conversations.parquet").where("role = 'assistant'").limit(60).collect()]
    got = lm.cross_entropy_difference(
        spark.createDataFrame(rows, "doc_id bigint, text string").repartition(3), spark.createDataFrame([(t,) for t in target], "text string")
    ).collect()
    vocabulary = {w for t in [*target, *(t for _, t in rows)] for w in words(t)}
    want = brute_without_limits(rows, target, len(vocabulary) + 1)
    assert len(got) == len(want)
    for r in got:
        assert math.isclose(r["score"], want[r["doc_id"]], abs_tol=1e-9)


def brute_without_limits(rows, target, n):
    counted = {}
    for m, texts in (("t", target), ("b", [t for _, t in rows])):
        pairs, unigrams, firsts = Counter(), Counter(), Counter()
        for t in texts:
            ids = [None, *words(t)]
            pairs.update(zip(ids, ids[1:]))
            unigrams.update(ids[1:])
            firsts.update(ids[:-1])
        counted[m] = pairs, unigrams, firsts, sum(unigrams.values())
    out = {}
    for d, text in rows:
        ids, means = [None, *words(text)], []
        for m, own in (("t", 0), ("b", 1)):
            pairs, unigrams, firsts, total = counted[m]
            loss = 0.0
            for u, v in zip(ids, ids[1:]):
                plain, seen = (max(unigrams[v] - own, 0) + 1) / (total - own + n), firsts[u] - own
                loss -= math.log(lm.MIX * max(pairs[u, v] - own, 0) / seen + (1 - lm.MIX) * plain if seen > 0 else plain)
            means.append(loss / max(1, len(ids) - 1))
        out[d] = means[1] - means[0]
    return out


def test_few_known_words_give_the_same_scores(spark, sf, monkeypatch):
    """Words that tasks don't hold, and their pairs, take the other way; both give exact scores."""
    rows = [(r["doc_id"], r["text"]) for r in spark.read.parquet(f"{sf}/documents.parquet").limit(40).collect()]
    target = [r["text"] for r in spark.read.parquet(f"{sf}/conversations.parquet").where("role = 'assistant'").limit(60).collect()]
    rows += [(-1, ""), (-2, None), (-3, target[0])]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string").repartition(3)
    aims = spark.createDataFrame([(t,) for t in target], "text string")
    vocabulary = {w for t in [*target, *(t for _, t in rows)] for w in words(t)}
    want = brute_without_limits(rows, target, len(vocabulary) + 1)
    for known, hot, per_tile in ((1, 1_000, 6_000_000), (40, 3, 2_000), (4_000_000, 1, 500)):
        monkeypatch.setattr(lm, "KNOWN", known)
        monkeypatch.setattr(lm, "HOT", hot)
        monkeypatch.setattr(lm, "PER_TILE", per_tile)
        got = lm.cross_entropy_difference(docs, aims).collect()
        assert sorted(r["doc_id"] for r in got) == sorted(want)
        for r in got:
            assert math.isclose(r["score"], want[r["doc_id"]], abs_tol=1e-9), (known, r)


def test_a_token_is_a_few_bytes(spark, sf, monkeypatch):
    """Words and pairs went through shuffles as rows of their own, twice (over 40 bytes a token)."""
    docs = spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text")
    sent, packed = [], lm._packed

    def spied(rows, known, tiles, aim):
        out = packed(rows, known, tiles, aim)
        sent.append(out.selectExpr("count(*) n", "sum(length(a) + length(b)) bytes").first())
        return out

    monkeypatch.setattr(lm, "_packed", spied)
    tokens = sum(r["n_tokens"] for r in lm.cross_entropy_difference(docs, docs.select("text").limit(5)).collect())
    assert sent[0]["n"] < 1_000 and sent[0]["bytes"] < 8 * tokens
