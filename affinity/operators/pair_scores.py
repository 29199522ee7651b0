"""Scores of pairs whose vectors meet in tiles.

A tile is a group of users and a group of items, by hashes of their ids (see ``tiles``). A vector goes to each tile of
its row or column of the grid once; a pair goes to one tile, packed with others and without a vector. So pairs are
shuffled once and aren't sorted, and no row carries a vector.
"""

from __future__ import annotations

import math
from collections.abc import Callable

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from affinity.operators.tiles import CHUNK, TILE_BYTES, _cut, _place
from affinity.session import materialize

WHOLE = ("tinyint", "smallint", "int", "bigint")
BLOCK = "part int, kind int, data binary"
PAIRS = 2  # after the vectors of both sides
ROW_BYTES = 16 << 20  # of pairs with their vectors at a time


def fits(pairs: DataFrame, users: DataFrame, items: DataFrame, user: str, item: str, how: str) -> bool:
    """Whether ids are whole numbers, rows a table and the join one that tiles make."""
    kinds = [dict(df.dtypes).get(c) for df, c in ((pairs, user), (pairs, item), (users, user), (items, item))]
    plain = not any(df.isStreaming for df in (pairs, users, items))
    return plain and how in ("inner", "left") and all(k in WHOLE for k in kinds)


def _stored(batch: pa.RecordBatch) -> bytes:
    out = pa.BufferOutputStream()
    with pa.ipc.new_stream(out, batch.schema) as writer:
        writer.write_batch(batch)
    return out.getvalue().to_pybytes()


def _read(data: bytes) -> pa.RecordBatch:
    with pa.ipc.open_stream(data) as reader:
        return reader.read_next_batch()


def _ids(column) -> np.ndarray:
    return pc.fill_null(column.cast(pa.int64()), 0).to_numpy(zero_copy_only=False)


def _blocks(rows: list[tuple[int, int, bytes]]) -> pa.RecordBatch:
    arrays = [pa.array(c, k) for c, k in zip(zip(*rows), (pa.int32(), pa.int32(), pa.binary()))]
    return pa.RecordBatch.from_arrays(arrays, names=["part", "kind", "data"])


def _vector_blocks(vectors: DataFrame, side: int, size: tuple[int, int]) -> DataFrame:
    """Vectors (id, v) for each tile of their row or column."""

    def run(batches):
        for batch in batches:
            rows = []
            for place, at in _cut(_place(_ids(batch.column("id")), size[side])):
                data = _stored(batch.take(pa.array(at)))
                for other in range(size[1 - side]):
                    rows.append((place * size[1] + other if side == 0 else other * size[1] + place, side, data))
            if rows:
                yield _blocks(rows)

    return vectors.mapInArrow(run, BLOCK)


def _pair_blocks(pairs: DataFrame, user: str, item: str, size: tuple[int, int]) -> DataFrame:
    def pack(held):
        table = pa.Table.from_batches(held).combine_chunks()
        batch = table.to_batches()[0]
        users, items = _ids(batch.column(user)), _ids(batch.column(item))
        tile = _place(users, size[0]) * size[1] + _place(items, size[1])
        return _blocks([(place, PAIRS, _stored(batch.take(pa.array(at)))) for place, at in _cut(tile)])

    def run(batches):
        held, n = [], 0
        for batch in batches:
            if batch.num_rows:
                held.append(batch)
                n += batch.num_rows
            if n >= CHUNK:
                yield pack(held)
                held, n = [], 0
        if n:
            yield pack(held)

    return pairs.mapInArrow(run, BLOCK)


class _Vectors:
    """Vectors in the order of their ids. ``width`` is -1 where a vector is null or holds a null."""

    def __init__(self, blocks: list[pa.RecordBatch]):
        kind = pa.schema([("id", pa.int64()), ("v", pa.list_(pa.float64()))])
        table = pa.concat_tables([pa.Table.from_batches([b]) for b in blocks]) if blocks else kind.empty_table()
        ids = table["id"].to_numpy()
        order = np.argsort(ids, kind="stable")
        self.ids = ids[order]
        lists = table["v"].combine_chunks().cast(pa.list_(pa.float64())).take(pa.array(order))
        lists = lists.combine_chunks() if isinstance(lists, pa.ChunkedArray) else lists
        width = pc.fill_null(pc.list_value_length(lists), 0).to_numpy(zero_copy_only=False).astype(np.int64)
        values, owner = lists.flatten(), np.repeat(np.arange(len(ids)), width)
        holes = values.is_null().to_numpy(zero_copy_only=False)
        self.lists = lists
        self.x = np.zeros((len(ids), int(width.max(initial=0))))
        self.x[owner, np.arange(len(owner)) - np.repeat(np.cumsum(width) - width, width)] = pc.fill_null(values, 0.0).to_numpy(zero_copy_only=False)
        self.width = np.where(lists.is_null().to_numpy(zero_copy_only=False), -1, width)
        self.width[owner[holes]] = -1

    def join(self, ids, left: bool) -> tuple[np.ndarray, np.ndarray]:
        """Places in ``ids`` and here of the rows of a join; -1 here for an unknown or null id (``left``)."""
        values = _ids(ids)
        lo, hi = (np.searchsorted(self.ids, values, side=s) for s in ("left", "right"))
        n = np.where(ids.is_null().to_numpy(zero_copy_only=False), 0, hi - lo)
        known = n > 0
        if left:
            n = np.maximum(n, 1)
        row = np.repeat(np.arange(len(values)), n)
        here = np.repeat(lo, n) + np.arange(len(row)) - np.repeat(np.cumsum(n) - n, n)
        return row, np.where(known[row], here, -1)


def dot(u: np.ndarray, w: np.ndarray) -> np.ndarray:
    """Inner products, summed in the order of the elements."""
    out = np.zeros(len(u))
    for j in range(u.shape[1]):
        out += u[:, j] * w[:, j]
    return out


def score(
    pairs: DataFrame, users: DataFrame, items: DataFrame, user: str, item: str, how: str, name: str,
    scored: Callable[[np.ndarray, np.ndarray], np.ndarray] = dot, same_width: bool = True,
) -> DataFrame:
    """Pairs with ``name``, the score of their users' and items' vectors (column ``embedding``); rows and columns are
    those of two joins. The score is null where a vector is missing, null or holds a null and, with ``same_width``,
    where widths differ."""

    def add(batch, sides, u, w):
        right = (u >= 0) & (w >= 0)
        right[right] = (sides[0].width[u[right]] >= 0) & (sides[1].width[w[right]] >= 0)
        if same_width:
            right[right] = sides[0].width[u[right]] == sides[1].width[w[right]]
        out = np.zeros(len(u))
        if right.any():
            x = [sides[0].x[u[right]], sides[1].x[w[right]]]
            if same_width:
                x = [a[:, : min(x[0].shape[1], x[1].shape[1])] for a in x]
            out[right] = scored(*x)
        yield batch.append_column(name, pa.array(out, mask=~right))

    return _met(pairs, users, items, user, item, how, [T.StructField(name, T.DoubleType())], add)


def with_vectors(
    pairs: DataFrame, users: DataFrame, items: DataFrame, user: str, item: str, how: str, names: tuple[str, str]
) -> DataFrame:
    """Pairs with the vectors (column ``embedding``) of both ids; rows and columns are those of two joins."""

    def add(batch, sides, u, w):
        wide = 64 + 8 * sum(s.x.shape[1] for s in sides)
        step = max(1, ROW_BYTES // wide)  # vectors are many times the pairs
        for lo in range(0, len(u), step):
            part = batch.slice(lo, step)
            for side, at, name in zip(sides, (u, w), names):
                at = at[lo : lo + step]
                part = part.append_column(name, side.lists.take(pa.array(np.maximum(at, 0), mask=at < 0)))
            yield part

    return _met(pairs, users, items, user, item, how, [T.StructField(n, T.ArrayType(T.DoubleType())) for n in names], add)


def _met(
    pairs: DataFrame, users: DataFrame, items: DataFrame, user: str, item: str, how: str, fields: list[T.StructField], add: Callable
) -> DataFrame:
    """Pairs with more ``fields``: ``add(batch, sides, u, w)`` makes them where pairs meet the places of their vectors."""
    frozen = [
        materialize(df.where(F.col(c).isNotNull()).select(F.col(c).cast("bigint").alias("id"), F.col("embedding").cast("array<double>").alias("v")), "pair-vectors")
        for df, c in ((users, user), (items, item))
    ]
    least = math.ceil(math.sqrt(3 * pairs.sparkSession.sparkContext.defaultParallelism))  # so that cores end together
    sizes = [df.agg(F.coalesce(F.sum(8 * (2 + F.greatest(F.size("v"), F.lit(0)))), F.lit(0))).first()[0] for df in frozen]
    size = tuple(max(least, math.ceil(s / TILE_BYTES)) for s in sizes)
    pairs = pairs.select(item, user, *[c for c in pairs.columns if c not in (user, item)])
    schema = T.StructType([*pairs.schema.fields, *fields])
    left = how == "left"

    def work(sides, batch):
        row, u = sides[0].join(batch.column(user), left)
        batch = batch.take(pa.array(row))
        row, w = sides[1].join(batch.column(item), left)
        yield from add(batch.take(pa.array(row)), sides, u[row], w)

    def meet(batches):
        packed, sides = ([], []), None
        for batch in batches:
            for kind, data in zip(batch.column("kind").to_pylist(), batch.column("data")):
                block = _read(data.as_buffer())
                if kind < PAIRS:
                    packed[kind].append(block)
                    continue
                if sides is None:
                    sides, packed = [_Vectors(p) for p in packed], None
                yield from work(sides, block)

    blocks = _pair_blocks(pairs, user, item, size)
    for side in (0, 1):
        blocks = blocks.unionByName(_vector_blocks(frozen[side], side, size))
    met = blocks.repartitionById(size[0] * size[1], F.col("part")).sortWithinPartitions("kind")
    return met.mapInArrow(meet, schema)
