"""Vector arithmetic on array columns, in double precision and without Python."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F


def _col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def as_doubles(v) -> Column:
    return _col(v).cast("array<double>")


def dot(a, b) -> Column:
    """Dot product; null when the lengths differ (the shorter side pads with null)."""
    products = F.zip_with(as_doubles(a), as_doubles(b), lambda x, y: x * y)
    return F.aggregate(products, F.lit(0.0), lambda acc, x: acc + x)


def norm(v) -> Column:
    return F.sqrt(F.aggregate(as_doubles(v), F.lit(0.0), lambda acc, x: acc + x * x))


def cosine(a, b) -> Column:
    """Cosine similarity; null for a zero vector."""
    return F.try_divide(dot(a, b), norm(a) * norm(b))


def scaled_by(v, total) -> Column:
    """``v`` divided by ``total(sum of squares, sum)``; null where that is 0.

    The sums are bound once by the fold: an outer expression used inside ``transform`` would
    be evaluated again for every element.
    """
    v = as_doubles(v)
    zero = F.struct(F.lit(0.0).alias("squares"), F.lit(0.0).alias("sum"))

    def add(acc, x):
        return F.struct((acc["squares"] + x * x).alias("squares"), (acc["sum"] + x).alias("sum"))

    def divide(acc):
        by = total(acc["squares"], acc["sum"])
        return F.when(by != 0, F.transform(v, lambda x: x / by))

    return F.aggregate(v, zero, add, divide)


def normalized(v) -> Column:
    """``v`` scaled to length one; null for a zero vector."""
    return scaled_by(v, lambda squares, _: F.sqrt(squares))


def shares(v) -> Column:
    """``v`` scaled to sum one (class weights to probabilities)."""
    return scaled_by(v, lambda _, total: total)


def fixed_dot(a, b, dim: int) -> Column:
    """Dot product of two ``dim``-wide arrays, unrolled so it stays in generated code."""
    a, b = _col(a), _col(b)
    return reduce(lambda s, t: s + t, [a[i] * b[i] for i in range(dim)])


def sigmoid(x) -> Column:
    return F.lit(1.0) / (F.lit(1.0) + F.exp(-_col(x)))


def bce_with_logits(logit, label) -> Column:
    """Binary cross-entropy of a logit; stable for large logits of either sign."""
    x, y = _col(logit), _col(label).cast("double")
    return F.greatest(x, F.lit(0.0)) - x * y + F.log1p(F.exp(-F.abs(x)))


def bce_of_probability(p, label) -> Column:
    """Binary cross-entropy of a probability; each log is held at -100 or above."""
    p, y = _col(p), _col(label).cast("double")

    def log(q):
        return F.when(q > 0, F.greatest(F.ln(q), F.lit(-100.0))).otherwise(F.lit(-100.0))

    return -(y * log(p) + (F.lit(1.0) - y) * log(F.lit(1.0) - p))
