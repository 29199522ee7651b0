"""Exact top-k by inner product: vectors in buckets of like length, pruned by local cosine thresholds.

Items are ordered by falling length and cut in buckets. A query first takes scores from the bucket of the
longest vectors; its k-th best score there is a threshold that only grows. A bucket is visited if its
longest vector could reach the threshold; within it, threshold / (query length x greatest length) is a
cosine that a vector must reach. From these cosines each bucket chooses between

* lengths: products with the vectors that are long enough, a prefix of the bucket;
* coordinates: a vector with that cosine has each unit coordinate within an interval around the query's own.
  Sorted lists of the query's largest coordinates give the candidates, and products verify them.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from affinity.llm import vectors as V
from affinity.operators.ranking import best_per_group
from affinity.session import materialize

BUCKET = 4096
FOCUS = 3  # coordinates of a query whose lists are looked up
LEAST_COSINE = 0.5  # below it no interval of a coordinate excludes much
COORDINATE_COST = 4  # of a candidate of the lists, in rows of a matrix product
TILE = 1 << 20
SLACK = 1e-7
FOUND = "query_id long, vec_id long, score long"


def _kind(bound: float):
    """The number type in which products up to ``bound`` are exact, sums of them included."""
    return np.float32 if bound < 2**24 else np.float64 if bound < 2**53 else np.int64


class Best:
    """The best pairs so far of each query of a cell, and the score a further pair has to reach."""

    def __init__(self, floor: np.ndarray, k: int):
        self.floor, self.k = floor, k
        self.row, self.id, self.score = (np.zeros(0, dtype=np.int64) for _ in range(3))

    def add(self, row, ids, score) -> None:
        if not len(row):
            return
        row, ids, score = (np.concatenate(x) for x in ((self.row, row), (self.id, ids), (self.score, score)))
        keep = V.first_of_groups(row, score, ids, self.k)
        self.row, self.id, self.score = row[keep], ids[keep], score[keep]
        full = np.flatnonzero(np.bincount(self.row, minlength=len(self.floor)) == self.k)
        last = np.searchsorted(self.row, full, side="right") - 1
        self.floor[full] = np.maximum(self.floor[full], self.score[last])


def by_length(best: Best, rows, q_ids, q, q_norm, ids, p, norm) -> None:
    """Products of ``rows`` with the vectors of a bucket that are long enough for them."""
    reach = best.floor[rows] / np.maximum(q_norm[rows], 1)
    prefix = np.where(best.floor[rows] > 0, np.searchsorted(-norm, -reach * (1 - SLACK), side="right"), len(norm))
    kind = _kind(float(q_norm[rows].max() * norm[0]))
    least = np.iinfo(np.int64).min if kind is np.int64 else -np.inf
    rows, prefix = rows[np.argsort(-prefix, kind="stable")], np.sort(prefix)[::-1]
    by_id = np.argsort(ids, kind="stable")  # columns in the order of ties
    norm, all_ids, columns = norm[by_id], ids[by_id], p[by_id].T.astype(kind)
    shortest = np.sort(norm)[::-1]
    step = max(1, TILE // len(ids))
    found = []
    for lo in range(0, len(rows), step):
        some, n = rows[lo : lo + step], int(prefix[lo])
        if not n:
            break
        part = slice(None) if n == len(norm) else norm >= shortest[n - 1]
        scores, named = q[some].astype(kind) @ columns[:, part], all_ids[part]
        own = np.flatnonzero(np.isin(named, q_ids[some]))
        scores[:, own] = np.where(named[own][None, :] == q_ids[some][:, None], least, scores[:, own])
        row, col = V.first_of_rows(scores, best.k, best.floor[some].astype(kind))
        got = scores[row, col]
        real = got > least
        found.append((some[row[real]], named[col[real]], got[real].astype(np.int64)))
    if found:
        best.add(*(np.concatenate(x) for x in zip(*found)))


def intervals(unit_q: np.ndarray, cosine: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The least and greatest unit coordinate of vectors within ``cosine`` of a query with ``unit_q`` there."""
    own, most = np.arccos(np.clip(unit_q, -1, 1)), np.arccos(np.clip(cosine, -1, 1))
    return np.cos(np.minimum(own + most, np.pi)) - SLACK, np.cos(np.maximum(own - most, 0)) + SLACK


def by_coordinate(best: Best, rows, cosine, q_ids, q, q_norm, ids, p, norm) -> np.ndarray:
    """Scores the candidates of ``rows`` from sorted coordinate lists; gives back the rows whose lists are too long."""
    unit = p / np.maximum(norm, 1e-300)[:, None]
    unit_q = q[rows] / q_norm[rows][:, None]
    focus = np.argsort(-np.abs(unit_q), axis=1, kind="stable")[:, :FOCUS]
    low, high = intervals(np.take_along_axis(unit_q, focus, 1), cosine[:, None])
    begin, end, orders = np.zeros_like(focus), np.zeros_like(focus), {}
    for c in np.unique(focus):
        orders[c] = np.argsort(unit[:, c], kind="stable")
        values, at = unit[orders[c], c], focus == c
        begin[at], end[at] = np.searchsorted(values, low[at], side="left"), np.searchsorted(values, high[at], side="right")
    which = (end - begin).argmin(1)[:, None]
    begin, end, column = (np.take_along_axis(x, which, 1)[:, 0] for x in (begin, end, focus))
    long = (end - begin) * COORDINATE_COST > len(ids)
    short = np.flatnonzero(~long)
    lists = np.stack([orders[c] for c in sorted(orders)])
    at, found = 0, []
    while at < len(short):
        sizes = np.cumsum((end - begin)[short[at:]])
        step = max(1, int(np.searchsorted(sizes, TILE, side="right")))
        some = short[at : at + step]
        size = (end - begin)[some]
        who = np.repeat(some, size)
        place = np.repeat(begin[some] - (np.cumsum(size) - size), size) + np.arange(int(size.sum()))
        item = lists[np.searchsorted(sorted(orders), column[who]), place]
        for f in range(focus.shape[1]):
            value = unit[item, focus[who, f]]
            keep = (value >= low[who, f]) & (value <= high[who, f])
            who, item = who[keep], item[keep]
        keep = ids[item] != q_ids[rows[who]]
        who, item = who[keep], item[keep]
        score = (q[rows[who]] * p[item]).sum(1)
        enough = score >= best.floor[rows[who]]
        found.append((rows[who[enough]], ids[item[enough]], score[enough]))
        at += step
    if found:
        best.add(*(np.concatenate(x) for x in zip(*found)))
    return rows[long]


def search_cell(q_ids, q, q_norm2, floor, ids, p, norm2, k: int, chosen: dict | None = None) -> Best:
    """The ``k`` best of each query among the items of a cell, from the longest bucket to the shortest."""
    best, q_norm = Best(floor.copy(), k), np.sqrt(q_norm2.astype(np.float64))
    order = np.argsort(-norm2, kind="stable")
    for at in range(0, len(order), BUCKET):
        take = order[at : at + BUCKET]
        norm = np.sqrt(norm2[take].astype(np.float64))
        possible = q_norm * norm[0]
        rows = np.flatnonzero(possible * (1 + SLACK) >= best.floor)
        cosine = best.floor[rows] / np.maximum(possible[rows], 1)  # a length that isn't 0 is 1 or more
        near = cosine >= LEAST_COSINE
        plain = rows[~near]
        if near.any():
            late = by_coordinate(best, rows[near], cosine[near], q_ids, q, q_norm, ids[take], p[take], norm)
            plain = np.concatenate((plain, late))
        if chosen is not None:
            chosen["length"] = chosen.get("length", 0) + len(plain)
            chosen["coordinate"] = chosen.get("coordinate", 0) + len(rows) - len(plain)
        if len(plain):
            by_length(best, plain, q_ids, q, q_norm, ids[take], p[take], norm)
    return best


# ---- the operator ---------------------------------------------------------------------


def search(
    items: DataFrame, queries: DataFrame, k: int = 5, key: str = "vec_id", vector: str = "embedding",
    per_group: int = V.ITEMS_PER_GROUP, per_chunk: int = V.QUERIES_PER_CHUNK,
) -> DataFrame:
    """Each query's ``k`` highest inner products with items of another key: query_id, rank (int, from 1), vec_id, score.

    Vectors are taken as whole numbers (``vectors.whole_numbers``: floor(256 * x); null keys, null vectors
    and vectors with a null or non-finite element take no part, one row counts per key, vectors of a squared length of 2^62
    are an error). Shorter vectors count as if zeros followed, an empty one scores 0 with all. Scores are
    exact; ties go to the smaller id, all candidates are listed where there are fewer than ``k``, and a
    query without any has no row. Empty tables give no rows; other columns are ignored.
    """
    item_rows = materialize(V.whole_numbers(items, key, vector), "items")
    query_rows = materialize(V.whole_numbers(queries, key, vector).drop("_bits"), "queries")
    figures = [F.count("*").alias("n"), F.coalesce(F.max(F.size("_v")), F.lit(0)).alias("width")]
    n, width = item_rows.agg(*figures).first()
    width = max(width, query_rows.agg(*figures).first()["width"])

    by_norm = [F.desc("_norm2"), F.asc("_id")]
    placed = V.grouped(item_rows.drop("_bits"), by_norm, n, per_group)
    longest = placed.orderBy(*by_norm).limit(BUCKET).select("_id", "_norm2", "_v").toArrow()
    lengths = placed.groupBy("_group").agg(F.max("_norm2").alias("m")).toArrow()  # a row for each group
    shared = query_rows.sparkSession.sparkContext.broadcast((longest, lengths))

    def route(batches):
        longest, lengths = shared.value
        ids, norm2, p = longest["_id"].to_numpy(), longest["_norm2"].to_numpy(), V.matrix(longest["_v"], width)
        groups, most = lengths["_group"].to_numpy(), np.sqrt(lengths["m"].to_numpy().astype(np.float64))
        for batch in batches:
            if not batch.num_rows:
                continue
            q_norm2 = batch.column("_norm2").to_numpy()
            floor = np.full(batch.num_rows, np.iinfo(np.int64).min)
            q = V.matrix(batch.column("_v"), width)
            best = search_cell(batch.column("_id").to_numpy(), q, q_norm2, floor, ids, p, norm2, k)
            visits = [
                groups[length * most * (1 + SLACK) >= least].astype(np.int32)
                for length, least in zip(np.sqrt(q_norm2.astype(np.float64)), best.floor)
            ]
            yield batch.append_column("_floor", pa.array(best.floor)).append_column("_groups", pa.array(visits, pa.list_(pa.int32())))

    def score(held: pa.Table, asked: pa.Table) -> pa.Table:
        q_ids = asked["_id"].to_numpy()
        best = search_cell(
            q_ids, V.matrix(asked["_v"], width), asked["_norm2"].to_numpy(), asked["_floor"].to_numpy(),
            held["_id"].to_numpy(), V.matrix(held["_v"], width), held["_norm2"].to_numpy(), k,
        )
        return pa.table({"query_id": q_ids[best.row], "vec_id": best.id, "score": best.score})

    routed = materialize(
        query_rows.mapInArrow(route, "_id long, _norm2 long, _v array<long>, _floor long, _groups array<int>"), "routed"
    )
    found = V.meet(routed, placed, score, FOUND, per_chunk)
    ranked = best_per_group(found, ["query_id"], [F.desc("score"), F.asc("vec_id")], k, "rank")
    return ranked.select("query_id", F.col("rank").cast("int").alias("rank"), "vec_id", "score")
