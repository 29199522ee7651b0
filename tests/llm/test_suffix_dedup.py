import hashlib
import random

import numpy as np
import pytest

from affinity.llm import suffix_dedup

W = suffix_dedup.WIDTH


def brute(rows):
    """doc_id -> (bytes, removed, spans, digest of the rest), for rows with distinct ids."""
    seen, out = set(), []
    for d, text in sorted((r for r in rows if r[0] is not None), key=lambda r: r[0]):
        data = (text or "").encode()
        gone = np.zeros(len(data), dtype=bool)
        for i in range(len(data) - W + 1):
            window = data[i : i + W]
            if window in seen:
                gone[i : i + W] = True
            seen.add(window)
        out.append((d, *figures(data, gone)))
    return sorted(out)


def figures(data, gone):
    kept = bytes(b for b, g in zip(data, gone) if not g)
    runs = int((np.diff(np.concatenate(([0], gone.astype(int)))) == 1).sum())
    return len(data), int(gone.sum()), runs, hashlib.sha256(kept).hexdigest()


def corpus(seed=5, docs=80):
    rng = random.Random(seed)
    word = lambda: "".join(rng.choice("abcdeé") for _ in range(rng.randrange(1, 6)))
    prose = lambda n: " ".join(word() for _ in range(n))
    passages = [prose(n) for n in (18, 30, 60)]
    rows, texts = [], []
    for d in range(docs):
        kind = rng.randrange(8)
        if kind == 0 and texts:
            text = rng.choice(texts)
        elif kind == 1 and texts:
            old = rng.choice(texts)
            at = rng.randrange(len(old) + 1)
            text = old[:at] + word() + old[at:]
        elif kind == 2:
            text = rng.choice(["Of ", "x", "ab\n"]) * rng.randrange(1, 200)
        elif kind < 6:
            text = prose(rng.randrange(0, 60)) + rng.choice(passages) + prose(rng.randrange(0, 60))
        else:
            text = prose(rng.choice([0, 3, 20, 100, 300]))
        texts.append(text)
        rows.append((1000 - d * 3, text))
    return rows + [(-1, None), (-2, "")]


def got(docs, hot=suffix_dedup.HOT):
    rows = suffix_dedup.dedup(docs, hot).collect()
    return sorted((r["doc_id"], r["n_bytes"], r["n_removed"], r["n_spans"], hashlib.sha256(bytes(r["kept"])).hexdigest()) for r in rows)


@pytest.mark.parametrize("seed, hot, held", [(5, 20_000, True), (6, 2, True), (7, 20_000, False)])
def test_equal_brute_force(spark, monkeypatch, seed, hot, held):
    if not held:  # anchors are joined where tasks can't hold them
        monkeypatch.setattr(suffix_dedup, "MAX_HELD", 0)
    rows = corpus(seed)
    docs = spark.createDataFrame(rows, "doc_id bigint, text string").selectExpr("*", "1 as gram", "2 as start")
    assert got(docs.repartition(3), hot) == brute(rows)


def test_null_id_and_repeated_rows(spark):
    text = " ".join(str(i) for i in range(100))
    rows = [(1, text), (1, text), (2, text), (None, text)]
    found = sorted((r["doc_id"] or 0, r["n_removed"]) for r in suffix_dedup.dedup(spark.createDataFrame(rows, "doc_id bigint, text string")).collect())
    assert found == [(0, 0), (1, 0), (1, 0), (2, len(text))]


def test_empty(spark):
    assert got(spark.createDataFrame([], "doc_id bigint, text string")) == []


def test_columns_find_what_equal_windows_are():
    rng = np.random.default_rng(1)
    base = rng.integers(97, 99, 40).astype(np.uint8)
    pieces = [base, base[5:], np.concatenate((base[:30], base[:10])), base[3:38], rng.integers(97, 99, 30).astype(np.uint8)]
    place = np.array([20, 15, 20, 17, 12])
    group, rank = np.array([0, 0, 0, 0, 1]), np.array([3, 1, 0, 2, 4])
    ends = np.concatenate(([0], np.cumsum([len(p) for p in pieces])))
    which, at = suffix_dedup.repeats(np.concatenate(pieces), ends, group, place, rank, width=12)
    want = set()
    for i, p in enumerate(pieces):
        for a in range(len(p) - 11):
            for j, q in enumerate(pieces):
                b = a - place[i] + place[j]
                if group[i] == group[j] and rank[j] < rank[i] and 0 <= b <= len(q) - 12 and bytes(q[b : b + 12]) == bytes(p[a : a + 12]):
                    want.add((i, a))
    assert set(zip(which.tolist(), at.tolist())) == want


def test_texts_under_one_doc_id_are_judged_by_themselves(spark):
    import xxhash

    rng = random.Random(8)
    prose = lambda n: "".join(rng.choice("abcdefgh ") for _ in range(n))
    shared, other = prose(300), prose(400)
    rows = [(1, shared + prose(50)), (2, prose(500)), (2, prose(80) + shared + prose(60)), (2, other), (2, other), (2, None), (3, other + prose(9)), (None, other)]
    place = lambda r: (r[0], xxhash.xxh64_intdigest(r[1] or "", seed=42) - (1 << 64 if xxhash.xxh64_intdigest(r[1] or "", seed=42) >> 63 else 0) if r[1] is not None else 42)
    order = {k: i for i, k in enumerate(sorted({place(r) for r in rows if r[0] is not None}))}
    want = {r[0]: r[1:] for r in brute([(order[place(r)], r[1]) for r in {r: 0 for r in rows} if r[0] is not None])}
    expected = [(r[0], *want[order[place(r)]]) for r in rows if r[0] is not None]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string")
    found = suffix_dedup.dedup(docs).collect()
    figures_ = [(r["doc_id"], r["n_bytes"], r["n_removed"], r["n_spans"], hashlib.sha256(bytes(r["kept"])).hexdigest()) for r in found]
    assert sorted(f for f in figures_ if f[0] is not None) == sorted(expected)
    assert [f[2] for f in figures_ if f[0] is None] == [0]
    assert [f[2] for f in figures_ if f[0] == 2 and f[1] == 500] == [0]
