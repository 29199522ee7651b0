import math

import numpy as np
import pytest

from affinity.llm import topk_products
from affinity.llm.vectors import first_of_rows, whole_numbers

SCHEMA = "vec_id bigint, embedding array<double>, rank string, _v int"


def whole(rows):
    """Least vector of each id, in whole numbers."""
    out = {}
    for i, v in rows:
        if i is not None and v is not None and all(x is not None and math.isfinite(x) for x in v):
            v = [math.floor(256 * x) for x in v]
            out[i] = min(out.get(i, v), v)
    return out


def product(a, b):
    return sum(x * y for x, y in zip(a, b))


def brute(rows, queries, k):
    items, asked, out = whole(rows), whole(queries), []
    for q, a in asked.items():
        best = sorted((-product(a, b), i) for i, b in items.items() if i != q)[:k]
        out += [(q, r, i, -s) for r, (s, i) in enumerate(best, 1)]
    return sorted(out)


def frame(spark, rows):
    return spark.createDataFrame([(i, v, "x", 1) for i, v in rows], SCHEMA)


def check(spark, rows, queries, k, **kwargs):
    got = topk_products.search(frame(spark, rows), frame(spark, queries), k, **kwargs).collect()
    assert sorted(map(tuple, got)) == brute(rows, queries, k)


def clustered(n, width, seed=5, centres=9, noise=0.15, spread=1.5):
    """Directions around a few centres, lengths over orders of magnitude."""
    rng = np.random.default_rng(seed)
    v = rng.normal(size=(centres, width))[rng.integers(centres, size=n)] + noise * rng.normal(size=(n, width))
    v *= rng.lognormal(0, spread, n)[:, None] / np.linalg.norm(v, axis=1)[:, None]
    return [(int(i), list(map(float, x))) for i, x in enumerate(v)]


def test_defined_cases(spark):
    rows = clustered(300, 6) + [
        (None, [1.0] * 6), (1000, None), (1001, [1.0, None]), (1002, [float("nan")] * 6), (1003, [float("inf"), 1.0]),
        (1004, []), (1005, [2.0]), (1006, [0.0] * 6), (1007, [9.0] * 9), (-50, [-1.0] * 6),
        (1010, [3.0] * 6), (1010, [3.0] * 6), (1010, [-3.0] * 6),
    ] + [(i, [0.5] * 6) for i in range(2000, 2200)]
    queries = [r for r in rows if r[0] is not None and r[0] % 50 == 0] + [(1004, []), (1006, [0.0] * 6), (1010, [3.0] * 6)]
    check(spark, rows, queries, 5, per_group=40, per_chunk=4)


def test_fewer_candidates_than_k_and_empty_tables(spark):
    rows = [(0, [1.0, 0.0]), (50, [0.0, 1.0]), (7, [-1.0, -1.0])]
    check(spark, rows, rows[:2], 5)
    check(spark, rows[:1], rows[:1], 5)
    check(spark, [], [], 5)
    check(spark, [], rows[:1], 5)
    check(spark, rows, [], 5)


@pytest.mark.parametrize("longest", [2**3, 2**16, 2**22])  # products as 4- and 8-byte floats and as whole numbers
def test_products_are_exact_in_every_number_type(spark, longest):
    rows = clustered(200, 8)
    most = max(math.hypot(*v) for _, v in rows)
    rows = [(i, [x * longest / most for x in v]) for i, v in rows]
    check(spark, rows, rows[::40], 7)


def test_too_long_vectors_are_named(spark):
    with pytest.raises(Exception, match="vector of 3 is too long"):
        topk_products.search(frame(spark, [(3, [1e30])]), frame(spark, []), 5).collect()


@pytest.mark.parametrize("width", [4, 16])
def test_both_prunings_are_chosen_and_exact(width, monkeypatch):
    monkeypatch.setattr(topk_products, "BUCKET", 512)
    rows = whole(clustered(5000, width, centres=40, noise=0.05, spread=0.02) + [(i + 5000, v) for i, v in clustered(1000, width, noise=1, spread=0.02)])
    ids, p = np.array(list(rows)), np.array(list(rows.values()))
    asked, chosen = ids % 50 == 0, {}
    norm2 = (p * p).sum(1)
    floor = np.full(int(asked.sum()), np.iinfo(np.int64).min)
    best = topk_products.search_cell(ids[asked], p[asked], norm2[asked], floor, ids, p, norm2, 5, chosen)
    scores = p[asked] @ p.T
    scores[ids[asked][:, None] == ids[None, :]] = -(2**60)
    for r in range(len(scores)):
        want = np.lexsort((ids, -scores[r]))[:5]
        assert best.id[best.row == r].tolist() == ids[want].tolist()
    assert chosen["coordinate"] > 10 and chosen["length"] > 10, chosen
    assert chosen["coordinate"] + chosen["length"] < len(scores) * -(-len(ids) // 512)  # some buckets can't matter


def test_intervals_hold_all_vectors_of_a_cosine():
    rng = np.random.default_rng(1)
    a, b = (x / np.linalg.norm(x, axis=1)[:, None] for x in rng.normal(size=(2, 5000, 3)))
    low, high = topk_products.intervals(a, (a * b).sum(1)[:, None])
    assert (low <= b).all() and (b <= high).all()


def test_ties_go_to_the_first_columns():
    scores = np.array([[5, 5, 5, 1], [1, 2, 2, 2], [0, 0, 9, 0]])
    rows, cols = first_of_rows(scores, 2, np.array([0, 2, 1]))
    assert list(zip(rows, cols)) == [(0, 0), (0, 1), (1, 1), (1, 2), (2, 2)]


def test_whole_numbers(spark):
    rows = [(1, [0.5, -0.001]), (2, []), (3, [-1.0, 255 / 256])]
    got = {r["_id"]: r for r in whole_numbers(frame(spark, rows), "vec_id", "embedding").collect()}
    assert [(got[i]["_v"], got[i]["_norm2"], got[i]["_bits"]) for i in (1, 2, 3)] == [
        ([128, -1], 16385, 9), ([], 0, 1), ([-256, 255], 65536 + 65025, 9)
    ]
