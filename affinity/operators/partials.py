"""Sums of vectors by id: partial sums of Arrow batches, and their sums in the order of a shuffle."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from affinity.session import parallelism

PARTIAL = "side string, id long, g array<double>, loss double"


def summed(partial: DataFrame) -> DataFrame:
    """Sums of ``PARTIAL`` rows by side and id: one shuffle of what tasks have added up for each batch."""
    dealt = partial.repartition(parallelism(partial.sparkSession), "side", "id").sortWithinPartitions("side", "id")
    return dealt.mapInArrow(add_up, PARTIAL)


def as_lists(x: np.ndarray) -> pa.ListArray:
    return pa.ListArray.from_arrays(pa.array(np.arange(len(x) + 1, dtype=np.int32) * x.shape[1]), pa.array(x.ravel()))


def as_matrix(column) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(len(column), -1)


def partial_rows(side: str, ids: np.ndarray, g: np.ndarray, loss: float = 0.0) -> pa.RecordBatch:
    n = len(ids)
    columns = [pa.array([side] * n), pa.array(ids, pa.int64()), as_lists(g), pa.array(np.full(n, loss))]
    return pa.RecordBatch.from_arrays(columns, names=["side", "id", "g", "loss"])


def add_up(batches):
    """Sums of neighbouring rows of one side and id; rows come in order."""
    held: dict[str, tuple[int, np.ndarray, float]] = {}
    for batch in batches:
        if not batch.num_rows:
            continue
        sides = batch.column("side").to_numpy(zero_copy_only=False)
        for lo, hi in _runs(sides):
            side, ids = sides[lo], batch.column("id").slice(lo, hi - lo).to_numpy()
            g, loss = as_matrix(batch.column("g").slice(lo, hi - lo)), batch.column("loss").slice(lo, hi - lo).to_numpy()
            first = np.flatnonzero(np.concatenate(([True], ids[1:] != ids[:-1])))
            ids, g, loss = ids[first], np.add.reduceat(g, first), np.add.reduceat(loss, first)
            if held and (side not in held or held[side][0] != ids[0]):
                yield from _let_go(held)
            if side in held:
                _, before, lost = held.pop(side)
                g[0], loss[0] = g[0] + before, loss[0] + lost
            held[side] = (ids[-1], g[-1], loss[-1])
            if len(ids) > 1:
                out = partial_rows(side, ids[:-1], g[:-1])
                yield out.set_column(3, "loss", pa.array(loss[:-1]))
    yield from _let_go(held)


def _runs(values) -> list[tuple[int, int]]:
    at = np.flatnonzero(np.concatenate(([True], values[1:] != values[:-1], [True])))
    return list(zip(at[:-1].tolist(), at[1:].tolist()))


def _let_go(held):
    for side, (i, g, loss) in list(held.items()):
        del held[side]
        yield partial_rows(side, np.array([i]), g[None, :], loss)
