"""Joins of rows with a table of one row per key, where few keys may hold most of the rows."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from affinity.session import materialize

BROADCAST_BYTES = 64 << 20
MAX_HOT = 100_000


def hot_keys(rows: DataFrame, key: str, most: int) -> DataFrame:
    """Keys with more than ``rows / most`` rows; there can't be more than ``most`` of them."""
    counts = materialize(rows.where(F.col(key).isNotNull()).groupBy(key).agg(F.count("*").alias("_n")), "key-counts")
    total = counts.agg(F.coalesce(F.sum("_n"), F.lit(0))).first()[0]
    return counts.where(F.col("_n") > total / most).select(key)


def lookup(
    rows: DataFrame, table: DataFrame, key: str, how: str = "inner", row_bytes: int = 1024, limit: int = BROADCAST_BYTES
) -> DataFrame:
    """``rows`` with the columns of ``table`` for their ``key``.

    The table's rows for hot keys, as many as ``limit`` holds at ``row_bytes`` each, are sent to all tasks, and
    rows with these keys stay where they are. The others are shuffled; none of their keys has more than a
    share of 1 / (limit / row_bytes) of the rows, so no task depends on one key. ``how="left"`` keeps
    rows whose key is null or unknown, with nulls.
    """
    if how not in ("inner", "left"):
        raise ValueError("how must be inner or left")
    most = max(1, min(MAX_HOT, limit // row_bytes))
    hot = materialize(hot_keys(rows, key, most), "hot-keys")
    columns = [*rows.columns, *[c for c in table.columns if c != key]]
    known = F.broadcast(table.join(F.broadcast(hot), key, "left_semi").select(*table.columns))
    near = rows.join(F.broadcast(hot), key, "left_semi").join(known, key, how)
    far = rows.join(F.broadcast(hot), key, "left_anti").join(table, key, how)
    return near.select(*columns).unionByName(far.select(*columns))
