"""Hard negatives by exact scores from subset-sum tables (the method of four Russians).

Items are kept as bit planes: bit b of eight neighbouring elements is one byte. For each eight elements of
an anchor a table holds the sums of all 256 subsets, so a byte looks up what its bit adds to the score
without a multiplication; the planes' sums are shifted and added from the highest to the lowest, the sign
plane negatively. Tables of a block of anchors are looked up together.

Two passes: the best items of an anchor's own label are its positives; then items of other labels are kept
that score within a band of a positive's score. Items are dealt by label, so the first pass goes only to
groups that hold the label and the second leaves out groups that hold nothing else.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from affinity.llm import vectors as V
from affinity.operators.ranking import best_per_group
from affinity.session import materialize

ANCHORS_PER_TABLE = 128
ITEMS_PER_TILE = 8192
POSITIVES = "anchor_id long, label long, positive_id long, positive_score long"
NEGATIVES = "anchor_id long, positive_id long, negative_id long, positive_score long, negative_score long"


def bit_planes(v: np.ndarray, bits: int) -> np.ndarray:
    """Two's complement planes (items, bits, bytes): bit b of eight elements is a byte, the first its lowest bit."""
    shifts = np.arange(bits, dtype=np.int64)[None, :, None]
    return np.packbits(((v[:, None, :] >> shifts) & 1).astype(np.uint8), axis=2, bitorder="little")


def subset_sums(anchors: np.ndarray, kind) -> np.ndarray:
    """(bytes, 256, anchors): the sum of the elements of each eight that a byte names."""
    width = -(-anchors.shape[1] // 8) * 8
    padded = np.zeros((len(anchors), width), dtype=kind)
    padded[:, : anchors.shape[1]] = anchors
    out = np.zeros((width // 8, 256, len(anchors)), dtype=kind)
    for j in range(8):
        out[:, 1 << j : 2 << j] = out[:, : 1 << j] + padded[:, j::8].T[:, None, :]
    return out


def lookup_scores(tables: np.ndarray, planes: np.ndarray) -> np.ndarray:
    """Scores (items, anchors). Sums may wrap on the way; the result is right wherever it fits its type."""
    out = np.zeros((len(planes), tables.shape[2]), dtype=tables.dtype)
    bits = planes.shape[1]
    for b in range(bits - 1, -1, -1):
        if b < bits - 1:
            out <<= 1
        for g, table in enumerate(tables):
            if b == bits - 1:
                out -= table[planes[:, b, g]]
            else:
                out += table[planes[:, b, g]]
    return out


def _planes(column, bits: int) -> np.ndarray:
    column = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    data = np.frombuffer(b"".join(column.to_pylist()), dtype=np.uint8)
    return data.reshape(len(column), bits, -1)


def _scored(held: pa.Table, anchors: np.ndarray, longest: float, bits: int, pairs):
    """Calls ``pairs(anchor rows, item rows, scores by anchor)`` for each block of anchors and tile of items."""
    planes = _planes(held["_planes"], bits)
    reach = np.sqrt((anchors.astype(np.float64) ** 2).sum(1)).max(initial=0) * longest
    kind = np.int32 if reach < 2**31 else np.int64
    for lo in range(0, len(anchors), ANCHORS_PER_TABLE):
        rows = np.arange(lo, min(lo + ANCHORS_PER_TABLE, len(anchors)))
        tables = subset_sums(anchors[rows], kind)
        for at in range(0, len(planes), ITEMS_PER_TILE):
            tile = np.arange(at, min(at + ITEMS_PER_TILE, len(planes)))
            pairs(rows, tile, np.ascontiguousarray(lookup_scores(tables, planes[tile]).T))


class _Kept:
    """The best ``k`` entries of each slot (an anchor, or an anchor and positive)."""

    def __init__(self, slots: int, k: int):
        self.k, self.slot, self.id, self.score = k, *(np.zeros(0, dtype=np.int64) for _ in range(3))
        self.floor = np.full(slots, np.iinfo(np.int64).min)

    def add(self, slot, ids, score) -> None:
        if not len(slot):
            return
        slot, ids, score = (np.concatenate(x) for x in ((self.slot, slot), (self.id, ids), (self.score, score)))
        keep = V.first_of_groups(slot, score, ids, self.k)
        self.slot, self.id, self.score = slot[keep], ids[keep], score[keep]
        full = np.flatnonzero(np.bincount(self.slot, minlength=len(self.floor)) == self.k)
        self.floor[full] = self.score[np.searchsorted(self.slot, full, side="right") - 1]


def _percent(x: np.ndarray, share: int) -> np.ndarray:
    """share * x / 100 rounded down, without a product that could wrap."""
    return x // 100 * share + x % 100 * share // 100


def _best_within(scores, allowed, low, high, k):
    """Row, column and score of each row's best allowed entries between ``low`` and ``high``; tied first columns."""
    inside = allowed & (scores >= low[:, None]) & (scores <= high[:, None])
    rows = np.flatnonzero(inside.any(1))
    if not len(rows):
        return rows, rows, rows
    least = np.iinfo(scores.dtype).min  # no score reaches it
    masked = np.full((len(rows), scores.shape[1]), least, dtype=scores.dtype)
    np.copyto(masked, scores[rows], where=inside[rows])
    row, col = V.first_of_rows(masked, k, np.full(len(rows), least + 1, dtype=scores.dtype))
    return rows[row], col, masked[row, col]


def positives_of_cell(held: pa.Table, asked: pa.Table, width: int, longest: float, bits: int, k: int) -> pa.Table:
    """The ``k`` best other items of its label for each anchor of a cell."""
    order = np.argsort(held["_id"].to_numpy(), kind="stable")  # columns in the order of ties
    held = held.take(pa.array(order))
    ids, labels = held["_id"].to_numpy(), held["label"].to_numpy()
    a_ids, a_labels = asked["_id"].to_numpy(), asked["label"].to_numpy()
    kept, top = _Kept(len(a_ids), k), np.iinfo(np.int64).max

    def pairs(rows, tile, scores):
        allowed = (labels[tile][None, :] == a_labels[rows][:, None]) & (ids[tile][None, :] != a_ids[rows][:, None])
        row, col, score = _best_within(scores, allowed, kept.floor[rows], np.full(len(rows), top), k)
        kept.add(rows[row], ids[tile[col]], score.astype(np.int64))

    anchors = V.matrix(asked["_v"], width)
    for label in np.intersect1d(labels, a_labels):  # only pairs of one label are scored
        some, mine = np.flatnonzero(labels == label), np.flatnonzero(a_labels == label)
        _scored(held.take(pa.array(some)), anchors[mine], longest, bits, lambda r, t, s: pairs(mine[r], some[t], s))  # noqa: B023
    return pa.table(
        {"anchor_id": a_ids[kept.slot], "label": a_labels[kept.slot], "positive_id": kept.id, "positive_score": kept.score}
    )


def negatives_of_cell(
    held: pa.Table, asked: pa.Table, width: int, longest: float, bits: int, k: int, low: int, high: int
) -> pa.Table:
    """The ``k`` best items of other labels within the band of each positive of each anchor of a cell."""
    held = held.take(pa.array(np.argsort(held["_id"].to_numpy(), kind="stable")))
    ids, labels = held["_id"].to_numpy(), held["label"].to_numpy()
    a_ids, a_labels = asked["_id"].to_numpy(), asked["label"].to_numpy()
    lists = asked["_positives"].combine_chunks()
    edge, flat = lists.offsets.to_numpy(), lists.values
    p_ids, p_scores = flat.field("positive_id").to_numpy(), flat.field("positive_score").to_numpy()
    least, most = -_percent(-p_scores, low), _percent(p_scores, high)
    kept, counts = _Kept(len(p_ids), k), np.diff(edge)

    def pairs(rows, tile, scores):
        allowed = labels[tile][None, :] != a_labels[rows][:, None]
        found = []
        for nth in range(int(counts[rows].max(initial=0))):
            some = np.flatnonzero(counts[rows] > nth)
            slot = edge[rows[some]] + nth
            row, col, score = _best_within(
                scores[some], allowed[some], np.maximum(least[slot], kept.floor[slot]), most[slot], k
            )
            found.append((slot[row], ids[tile[col]], score.astype(np.int64)))
        if found:
            kept.add(*(np.concatenate(x) for x in zip(*found)))

    _scored(held, V.matrix(asked["_v"], width), longest, bits, pairs)
    anchor = np.repeat(np.arange(len(a_ids)), counts)
    return pa.table({
        "anchor_id": a_ids[anchor[kept.slot - edge[0]]], "positive_id": p_ids[kept.slot], "negative_id": kept.id,
        "positive_score": p_scores[kept.slot], "negative_score": kept.score,
    })


def mine(
    items: DataFrame, is_anchor: Column, n_positives: int = 5, n_negatives: int = 10, low: int = 30, high: int = 90,
    key: str = "vec_id", label: str = "label", vector: str = "embedding",
    per_group: int = V.ITEMS_PER_GROUP, per_chunk: int = V.QUERIES_PER_CHUNK,
) -> DataFrame:
    """anchor_id, positive_id, rank (int, from 1), negative_id, positive_score, negative_score.

    Scores are exact inner products with the anchor of whole-number vectors (``vectors.whole_numbers``: rows with a
    null key, label or vector or a null or non-finite element take no part; of several rows with one key the one with
    the least (label, vector) counts; shorter vectors count as if zeros followed). Higher scores come first, ties by
    smaller id. The positives of an anchor (rows for which ``is_anchor``, an expression of the key, holds) are
    its first ``n_positives`` other items of its label; for each of them the first ``n_negatives`` items of other
    labels with ``low * positive <= 100 * negative <= high * positive`` are returned, all if there are fewer.
    A positive score below 0 has an empty band. Empty tables give no rows; other columns are ignored.
    """
    rows = items.select(F.col(key).alias("_key"), F.col(label).alias("label"), F.col(vector).alias("_vector"), is_anchor.alias("_anchor"))
    rows = rows.withColumn("_anchor", F.coalesce(F.col("_anchor"), F.lit(False)).cast("bigint"))
    whole = materialize(V.whole_numbers(rows, "_key", "_vector", "label", "_anchor"), "items")
    n, width, bits, norm2 = whole.agg(
        F.count("*"), F.coalesce(F.max(F.size("_v")), F.lit(0)), F.coalesce(F.max("_bits"), F.lit(1)), F.coalesce(F.max("_norm2"), F.lit(0))
    ).first()
    longest = float(np.sqrt(float(norm2)))

    def pack(batches):
        for batch in batches:
            planes = bit_planes(V.matrix(batch.column("_v"), width), bits)
            packed = [x.tobytes() for x in planes]
            yield pa.RecordBatch.from_arrays(
                [batch.column("_id"), batch.column("label"), pa.array(packed, pa.binary())], names=["_id", "label", "_planes"]
            )

    packed = whole.select("_id", "label", "_v").mapInArrow(pack, "_id long, label long, _planes binary")
    placed = V.grouped(packed, [F.asc("label"), F.asc("_id")], n, per_group)
    ranges = placed.groupBy("_group").agg(F.min("label").alias("a"), F.max("label").alias("z")).toArrow()  # a row for each group
    shared = items.sparkSession.sparkContext.broadcast(ranges)

    def route(own: bool):
        def add(batches):
            groups, a, z = (shared.value[c].to_numpy() for c in ("_group", "a", "z"))
            for batch in batches:
                labels = batch.column("label").to_numpy()
                visits = [groups[(a <= x) & (x <= z)] if own else groups[(a != x) | (z != x)] for x in labels]
                yield batch.append_column("_groups", pa.array(visits, pa.list_(pa.int32())))

        return add

    anchors = materialize(whole.where("_anchor = 1").select("_id", "label", "_v"), "anchors")
    first = V.meet(
        anchors.mapInArrow(route(True), "_id long, label long, _v array<long>, _groups array<int>"), placed,
        lambda held, asked: positives_of_cell(held, asked, width, longest, bits, n_positives), POSITIVES, per_chunk,
    )
    first = best_per_group(first, ["anchor_id"], [F.desc("positive_score"), F.asc("positive_id")], n_positives, "_nth")
    lists = first.groupBy(F.col("anchor_id").alias("_id")).agg(
        F.collect_list(F.struct("positive_id", "positive_score")).alias("_positives")  # n_positives at most
    )
    asked = materialize(anchors.join(lists, "_id"), "positives")
    second = V.meet(
        asked.mapInArrow(
            route(False),
            "_id long, label long, _v array<long>, _positives array<struct<positive_id: long, positive_score: long>>, _groups array<int>",
        ),
        placed, lambda held, asked: negatives_of_cell(held, asked, width, longest, bits, n_negatives, low, high), NEGATIVES, per_chunk,
    )
    ranked = best_per_group(second, ["anchor_id", "positive_id"], [F.desc("negative_score"), F.asc("negative_id")], n_negatives, "rank")
    return ranked.select(
        "anchor_id", "positive_id", F.col("rank").cast("int").alias("rank"), "negative_id", "positive_score", "negative_score"
    )
