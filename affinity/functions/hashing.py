"""Keyed randomness: pure functions of the row key, so a recomputed task repeats its draws."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

TWO_32 = 4294967296.0


def _text(part) -> Column:
    if isinstance(part, Column):
        return part.cast("string")
    if isinstance(part, str):
        return F.col(part).cast("string")
    return F.lit(str(part))


def md5_hex(seed: int, *parts) -> Column:
    """md5 of ``seed|part|part...``; strings name columns, numbers are constants."""
    return F.md5(F.concat_ws("|", F.lit(str(seed)), *[_text(p) for p in parts]))


def hex_u32(digest: Column, at: int = 0) -> Column:
    """The ``at``-th group of 8 hex digits of a digest as a bigint in [0, 2^32)."""
    return F.conv(F.substring(digest, 1 + 8 * at, 8), 16, 10).cast("bigint")


def md5_u32(seed: int, *parts) -> Column:
    return hex_u32(md5_hex(seed, *parts))


def md5_uniform(seed: int, *parts) -> Column:
    """A double in [0, 1)."""
    return md5_u32(seed, *parts) / F.lit(TWO_32)
