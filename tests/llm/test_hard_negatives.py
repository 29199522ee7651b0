import math
import random

import numpy as np
from pyspark.sql import functions as F

from affinity.llm import hard_negatives

SCHEMA = "vec_id bigint, label int, embedding array<double>, rank string, _planes string"


def brute(rows, step, n_positives=5, n_negatives=10, low=30, high=90):
    items = {}
    for i, label, v in rows:
        if i is not None and label is not None and v is not None and all(x is not None and math.isfinite(x) for x in v):
            x = (label, [math.floor(256 * x) for x in v])
            items[i] = min(items.get(i, x), x)
    out = []
    for a, (label, v) in items.items():
        if a % step == 0:
            scored = sorted((-sum(x * y for x, y in zip(v, w)), i, m) for i, (m, w) in items.items() if i != a)
            for p, positive in [(-s, i) for s, i, m in scored if m == label][:n_positives]:
                band = [(-s, i) for s, i, m in scored if m != label and low * p <= -100 * s <= high * p][:n_negatives]
                out += [(a, positive, r, i, p, s) for r, (s, i) in enumerate(band, 1)]
    return sorted(out)


def check(spark, rows, step, **kwargs):
    frame = spark.createDataFrame([(*r, "x", "y") for r in rows], SCHEMA)
    got = hard_negatives.mine(frame, F.col("vec_id") % step == 0, **kwargs).collect()
    want = brute(rows, step)
    assert sorted(map(tuple, got)) == want
    return want


def vectors(n, width, labels=4, seed=3):
    rng = random.Random(seed)
    return [(i, rng.randrange(labels), [rng.gauss(0.3, 0.5) for _ in range(width)]) for i in range(n)]


def test_equal_brute_force(spark):
    hot = [(1000 + i, 1, [0.25] * 13) for i in range(150)]  # a third of the rows
    rows = vectors(300, 13) + hot + [
        (None, 1, [1.0] * 13), (900, None, [1.0] * 13), (901, 1, None), (902, 1, [None] * 13), (903, 2, [float("nan")] * 13),
        (904, 2, [float("-inf")] * 13), (905, 3, []), (906, 3, [1.0]), (20, 2, [0.0] * 13), (907, 2, [1.5] * 20), (40, 99, [1.0] * 13),
        (908, 1, [1.0] * 13), (908, 1, [1.0] * 13), (908, 0, [0.5] * 13), (-20, 1, [-1.0] * 13),
    ]
    assert len(check(spark, rows, 20, per_group=50, per_chunk=3)) > 300


def test_large_values_and_empty_tables(spark):
    assert check(spark, [(i, m, [x * 1e5 for x in v]) for i, m, v in vectors(120, 9)], 10)
    assert not check(spark, [], 10)
    assert not check(spark, [(10, 1, [1.0]), (11, 2, [1.0])], 10)  # no positive


def test_lookups_equal_products():
    rng = np.random.default_rng(2)
    for width, bits in ((1, 1), (8, 4), (21, 9), (64, 12)):
        v = rng.integers(-(1 << (bits - 1)), 1 << (bits - 1), size=(50, width))
        anchors = rng.integers(-300, 300, size=(7, width))
        scores = hard_negatives.lookup_scores(hard_negatives.subset_sums(anchors, np.int32), hard_negatives.bit_planes(v, bits))
        assert (scores == v @ anchors.T).all()


def test_band_is_exact_for_large_scores():
    p = np.array([0, 1, 7, 199, -5, 2**62 - 1, -(2**62)])
    for share in (30, 90):
        assert hard_negatives._percent(p, share).tolist() == [int(x) * share // 100 for x in p]
