"""Whole-number vectors, and the blocks in which a stated query set meets all of them.

Items are range-partitioned in groups of bounded size and queries are hashed in chunks of bounded size. A
query goes to the groups it has business with, every group to the chunks, and the pairs of a (group, chunk)
cell are scored in one call: the memory of a task is bounded by two parameters, whatever the tables hold.
"""

from __future__ import annotations

from collections.abc import Callable

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from affinity.operators.ranking import dense_index
from affinity.session import parallelism

SCALE = 256
ITEMS_PER_GROUP = 65_536
LEAST_PER_GROUP = 512  # a group answers each query with its best rows, so small ones cost more than they spread
QUERIES_PER_CHUNK = 16_384
LARGEST = 2.0**62  # of a squared length: products of two vectors within it fit a long


def _usable(column) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Rows of a list column that have only finite elements, their elements end to end, and their widths."""
    starts, ends = column.offsets.to_numpy()[:-1], column.offsets.to_numpy()[1:]
    flat = column.values.to_numpy(zero_copy_only=False).astype(np.float64)  # null becomes NaN
    bad = np.concatenate(([0], np.cumsum(~np.isfinite(flat))))
    valid = column.is_valid().to_numpy(zero_copy_only=False) & (bad[ends] == bad[starts])
    rows = np.flatnonzero(valid)
    widths = (ends - starts)[rows]
    at = np.repeat(starts[rows] - (np.cumsum(widths) - widths), widths) + np.arange(int(widths.sum()))
    return rows, flat[at], widths


def whole_numbers(rows: DataFrame, key: str, vector: str, *keep: str) -> DataFrame:
    """``_id``, the ``keep`` columns, ``_v`` (each element x as floor(256 * x)), ``_norm2`` and ``_bits``, one row per id.

    Rows with a null key or ``keep`` column, a null vector, or a null or non-finite element take no part. Of
    several rows with one key the one with the least (keep columns, vector) counts. A vector whose squared
    length reaches 2^62 is an error that names its key.
    """
    fields = ", ".join(f"`{c}` long" for c in keep)
    schema = f"_id long, {fields + ', ' if fields else ''}_norm2 long, _bits int, _v array<long>"

    def convert(batches):
        for batch in batches:
            column = batch.column(len(keep) + 1)
            used, flat, widths = _usable(column)
            values = np.floor(SCALE * flat)
            edge = np.concatenate(([0], np.cumsum(widths)))
            squares = np.concatenate(([0.0], np.cumsum(values * values)))
            norm2 = squares[edge[1:]] - squares[edge[:-1]]
            if len(used) and (not np.isfinite(squares[-1]) or norm2.max() >= LARGEST):
                worst = batch.column(0)[int(used[int(np.nanargmax(np.where(np.isfinite(norm2), norm2, np.inf)))])]
                raise ValueError(f"the vector of {worst} is too long for exact products")
            whole = values.astype(np.int64)
            squares = np.concatenate(([0], np.cumsum(whole * whole)))  # modulo 2^64, like the difference
            magnitude = np.where(whole < 0, -(whole + 1), whole)
            top = np.zeros(len(used), dtype=np.int64)
            full = widths > 0
            if full.any():
                top[full] = np.maximum.reduceat(magnitude, edge[:-1][full])
            bits = np.where(top > 0, np.floor(np.log2(np.maximum(top, 1).astype(np.float64))) + 1, 0).astype(np.int32) + 1
            yield pa.RecordBatch.from_arrays(
                [batch.column(c).take(pa.array(used)) for c in range(len(keep) + 1)]
                + [
                    pa.array(squares[edge[1:]] - squares[edge[:-1]]), pa.array(bits),
                    pa.ListArray.from_arrays(pa.array(edge, pa.int32()), pa.array(whole)),
                ],
                names=["_id", *keep, "_norm2", "_bits", "_v"],
            )

    given = [F.col(key).cast("bigint").alias("_id"), *[F.col(c).cast("bigint").alias(c) for c in keep]]
    present = rows.select(*given, F.col(vector).alias("_vector")).dropna(subset=["_id", *keep])
    least = F.min(F.struct(*keep, "_v", "_norm2", "_bits")).alias("_least")
    return present.mapInArrow(convert, schema).groupBy("_id").agg(least).select("_id", *[f"_least.{c}" for c in (*keep, "_norm2", "_bits", "_v")])


def grouped(items: DataFrame, order: list[Column | str], n_items: int, per_group: int = ITEMS_PER_GROUP) -> DataFrame:
    """``items`` with ``_group``: ranges of ``order``, which must tell all rows apart, of ``per_group`` rows at most."""
    share = -(-n_items // parallelism(items.sparkSession))
    rows = min(per_group, max(LEAST_PER_GROUP, share))
    placed = dense_index(items, order, "_place")
    return placed.withColumn("_group", F.floor(F.col("_place") / rows).cast("int")).drop("_place")


def meet(queries: DataFrame, items: DataFrame, score: Callable, schema: str, per_chunk: int = QUERIES_PER_CHUNK) -> DataFrame:
    """``score(item table, query table)`` for each cell; ``queries`` name the groups to go to in ``_groups``."""
    chunks = max(1, -(-queries.count() // per_chunk))
    asked = queries.withColumn("_chunk", F.pmod(F.xxhash64("_id"), F.lit(chunks))).withColumn("_group", F.explode("_groups")).drop("_groups")
    held = items.withColumn("_chunk", F.explode(F.sequence(F.lit(0).cast("bigint"), F.lit(chunks - 1).cast("bigint"))))
    # cells cost far more to score than their bytes tell, so the number of partitions is given
    cell, n = ["_group", "_chunk"], parallelism(items.sparkSession)
    return (
        held.repartition(n, *cell).groupBy(*cell).cogroup(asked.repartition(n, *cell).groupBy(*cell))
        .applyInArrow(lambda left, right: score(left, right) if left.num_rows and right.num_rows else empty(schema), schema)
    )


def empty(schema: str) -> pa.Table:
    return pa.table({c.split()[0]: pa.array([], pa.int64()) for c in schema.split(",")})


# ---- numpy helpers, run inside tasks -------------------------------------------------


def matrix(column, width: int) -> np.ndarray:
    """A list column as a matrix; shorter vectors end in zeros."""
    column = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    if not len(column):
        return np.zeros((0, width), dtype=np.int64)
    edge = column.offsets.to_numpy()
    flat = column.values.to_numpy(zero_copy_only=False)
    sizes = np.diff(edge)
    if (sizes == width).all():
        return flat[edge[0] : edge[-1]].reshape(len(column), width)
    out = np.zeros((len(column), width), dtype=np.int64)
    rows = np.repeat(np.arange(len(column)), sizes)
    out[rows, np.arange(edge[0], edge[-1]) - np.repeat(edge[:-1], sizes)] = flat[edge[0] : edge[-1]]
    return out


def first_of_rows(scores: np.ndarray, k: int, floor: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Row and column of each row's ``k`` highest scores at or above its floor; of equal ones the first columns."""
    n = scores.shape[1]
    if n <= k:
        return np.nonzero(scores >= floor[:, None])
    cut = np.partition(scores, n - k, axis=1)[:, n - k]
    cut = np.maximum(cut, floor)
    rows, cols = np.nonzero(scores >= cut[:, None])
    if len(rows) <= k * len(scores):
        nth = np.arange(len(rows)) - np.searchsorted(rows, rows)
        if not len(rows) or nth.max() < k:
            return rows, cols
    tied = scores[rows, cols] == cut[rows]
    above = np.bincount(rows[~tied], minlength=len(scores))
    order = np.cumsum(tied) - tied  # ties so far, in the order of rows and columns
    begin = np.searchsorted(rows, np.arange(len(scores)))
    order = order - order[np.minimum(begin, len(order) - 1)][rows]
    keep = ~tied | (order < k - above[rows])
    return rows[keep], cols[keep]


def first_of_groups(group: np.ndarray, score: np.ndarray, key: np.ndarray, k: int) -> np.ndarray:
    """Positions of the first ``k`` entries of each group by (score falling, key rising), in that order."""
    order = np.lexsort((key, -score, group))
    sorted_group = group[order]
    nth = np.arange(len(order)) - np.searchsorted(sorted_group, sorted_group)
    return order[nth < k]
