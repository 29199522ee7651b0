"""Removal of repeated strings by a column-wise Burrows-Wheeler construction over many documents.

A byte goes if it lies in a string of ``WIDTH`` bytes that also starts earlier (in a document with a
smaller doc_id, or earlier in its own). The construction of Bauer, Cox and Rosone inserts one symbol
of every document each round, from the right, and updates the order of suffixes and their common
prefixes from those of the round before. Whole documents would need as many rounds as the longest one
has bytes, and all documents together. So the collection is cut first:

1. Anchors. In each window of ``WIDTH`` bytes the k-gram with the least hash (the leftmost on a tie) is
   the anchor. Neighbouring windows share anchors; the bytes of a run of windows with one anchor are a
   piece. Equal windows have equal anchors at equal places, so only pieces whose anchors have equal
   hashes need be compared. Anchors that occur once in the corpus are dropped before any text moves.
2. Pieces. Equal pieces are collapsed to their first occurrence; at all others every byte goes. Bytes
   are moved only for anchors that have different pieces.
3. Columns. Pieces of an anchor are aligned at it and read column by column from the right. Each round
   inserts a symbol of every piece: a stable sort of the last order by the new symbols gives the new
   segment of the transform, and common prefixes grow by one within a symbol (the least of those
   between) or fall to zero. Suffixes of one column are only ever compared with each other, so the
   rounds need the last segment alone; the method's sequential files are the sorted, spillable shuffle
   in which pieces arrive. Runs of common prefixes of ``WIDTH`` or more are equal windows; all but the
   first are repeats.
4. Anchors with more than ``HOT`` different pieces don't go to one task: their windows are grouped by
   Spark one by one.

Hashes have 64 bits; pieces are grouped by two of them, windows compared byte by byte (grouped whole
in 4). Defined cases. Null and empty texts have no bytes, texts shorter than ``WIDTH`` lose none. Rows
that repeat a doc_id and its text are taken as one document: they don't remove each other's bytes. Other
texts under one doc_id are documents of their own, in the order of their hashes. Rows without doc_id
neither lose bytes nor cause losses. An empty table gives an empty result. Columns beyond doc_id
and text play no part.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from affinity.llm.graph import join_sized
from affinity.llm.text import _BYTE_CODES, hash_spans, mix, slices, text_bytes
from affinity.operators.ranking import dense_index
from affinity.session import materialize

WIDTH = 100
K = 20
HOT = 20_000
CHUNK = 1_000_000
RUN_BYTES = 6_000_000
MAX_HELD = 4_000_000  # hashes of repeated anchors that tasks hold; beyond it they are joined
SEEN = 200_000
_BASE = 0x9E3779B97F4A7C15


def _rolled(data: np.ndarray, k: int) -> np.ndarray:
    """A hash of the k bytes from each place, by doubling lengths."""
    power = lambda n: np.uint64(pow(_BASE, n, 1 << 64))
    whole, span, out, have = _BYTE_CODES[data], 1, None, 0
    while True:
        if k & span:
            out = whole if out is None else out[: len(whole) - have] + whole[have:] * power(have)
            have += span
        if span * 2 > k:
            break
        whole = whole[: len(whole) - span] + whole[span:] * power(span)
        span *= 2
    return mix(out[: max(0, len(data) - k + 1)])


def _least(x: np.ndarray, n: int) -> np.ndarray:
    """The least of each n values in a row."""
    span = 1
    while span * 2 <= n:
        x = np.minimum(x[: len(x) - span], x[span:])
        span *= 2
    return np.minimum(x[: len(x) - (n - span)], x[n - span :]) if n > span else x


class Anchors:
    """Anchors of the texts of an Arrow column: ``gram`` (hash), ``row``, ``start`` (first window) and
    ``count`` (windows), ``place`` (of the anchor behind the start)."""

    def __init__(self, texts, width: int = WIDTH, k: int = K):
        self.data, offsets = text_bytes(texts)
        lengths = np.diff(offsets) - 1  # without the line feed behind each text
        windows = np.maximum(lengths - width + 1, 0)
        empty = np.zeros(0, dtype=np.int64)
        self.gram, self.row, self.start, self.count, self.place = empty.view(np.uint64), empty, empty, empty, empty
        self.offsets = offsets
        if not windows.any():
            return
        grams = _rolled(self.data, k)
        low = np.uint64((1 << int(len(grams)).bit_length()) - 1)
        ordered = (grams & ~low) | np.arange(len(grams), dtype=np.uint64)
        best = _least(ordered, width - k + 1)
        first = np.cumsum(windows) - windows
        at = np.repeat(offsets[:-1] - first, windows) + np.arange(int(windows.sum()))
        best = best[at]
        new = np.flatnonzero(np.concatenate(([True], best[1:] != best[:-1])))
        anchor = (best[new] & low).astype(np.int64)
        start = at[new]
        self.row = np.searchsorted(offsets, start, side="right") - 1
        self.gram, self.start = grams[anchor], start - offsets[self.row]
        self.count, self.place = np.diff(np.append(new, len(best))), anchor - start

    def keep(self, which: np.ndarray) -> None:
        for name in ("gram", "row", "start", "count", "place"):
            setattr(self, name, getattr(self, name)[which])

    def pieces(self, width: int = WIDTH) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """All pieces' bytes in a row, their ends, and a hash of each."""
        size = self.count + width - 1
        ends = np.cumsum(size)
        first = ends - size
        at = np.repeat(self.offsets[self.row] + self.start - first, size) + np.arange(int(size.sum()))
        joined = self.data[at]
        return joined, np.concatenate(([0], ends)), hash_spans(joined, first, size)


ANCHOR = "gram bigint, doc_id bigint, start bigint"
PLACE = "gram bigint, content bigint, doc_id bigint, start bigint, count bigint, place bigint"
PIECE = PLACE + ", piece binary"


def _anchors(docs: DataFrame) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for a, b in slices(batch.column("text"), CHUNK):
                found = Anchors(batch.column("text")[a:b])
                ids = batch.column("doc_id")[a:b].take(pa.array(found.row))
                yield pa.RecordBatch.from_arrays([pa.array(found.gram.view(np.int64)), ids, pa.array(found.start)], names=["gram", "doc_id", "start"])

    return docs.mapInArrow(run, ANCHOR)


def _repeated(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Of rows in the order of grams, each gram that occurs twice or more, once; and the first and last
    of the partition, as their rows may go on in another."""
    last = None
    for batch in batches:
        if not batch.num_rows:
            continue
        g = batch.column("gram").to_numpy()
        again = np.concatenate(([g[0] == last], g[1:] == g[:-1]))
        out = np.unique(g[again])
        if last is None:
            out = np.append(out, g[0])
        last = g[-1]
        yield pa.RecordBatch.from_arrays([pa.array(out)], names=["gram"])
    if last is not None:
        yield pa.RecordBatch.from_arrays([pa.array(np.array([last]))], names=["gram"])


def repeated_anchors(docs: DataFrame) -> DataFrame:
    """``gram`` of anchors that may occur more than once, each once."""
    # by place too, so that a very frequent anchor is spread over tasks
    ordered = _anchors(docs).repartitionByRange("gram", "doc_id", "start").sortWithinPartitions("gram")
    return materialize(ordered.mapInArrow(_repeated, "gram bigint").distinct(), "suffix-anchors")


def _cut(found: Anchors, ids, seen: set | None) -> pa.RecordBatch:
    """Rows of pieces; without ``seen`` they have no bytes."""
    joined, ends, content = found.pieces()
    columns = [found.gram.view(np.int64), content.view(np.int64), None, found.start, found.count, found.place]
    arrays = [pa.array(c) if c is not None else ids.take(pa.array(found.row)) for c in columns]
    if seen is None:
        return pa.RecordBatch.from_arrays(arrays, names=["gram", "content", "doc_id", "start", "count", "place"])
    keys = list(zip(found.gram.tolist(), content.tolist()))
    fresh = np.zeros(len(keys), dtype=bool)
    for i, key in enumerate(keys):
        if key not in seen:
            fresh[i] = True
            if len(seen) < SEEN:
                seen.add(key)
    # bytes of pieces that this task has sent before are left out
    size = np.where(fresh, np.diff(ends), 0)
    kept = joined[np.repeat(fresh, np.diff(ends))]
    offsets = np.concatenate(([0], np.cumsum(size))).astype(np.int32)
    valid = pa.array(fresh).buffers()[1]
    piece = pa.Array.from_buffers(pa.binary(), len(fresh), [valid, pa.py_buffer(offsets), pa.py_buffer(kept.tobytes())])
    return pa.RecordBatch.from_arrays([*arrays, piece], names=["gram", "content", "doc_id", "start", "count", "place", "piece"])


def _pieces(docs: DataFrame, repeated: DataFrame, bytes_: bool) -> DataFrame:
    """The pieces of repeated anchors, with or without their bytes; a task sends the bytes of equal pieces
    once where it can."""
    held = None
    if repeated.limit(MAX_HELD + 1).count() <= MAX_HELD:
        grams = repeated.toArrow()["gram"].to_numpy().view(np.uint64)
        held = docs.sparkSession.sparkContext.broadcast(np.sort(grams))
    else:
        wanted = _anchors(docs).join(repeated, "gram").groupBy("doc_id").agg(F.collect_set("start").alias("starts"))
        docs = docs.join(wanted, "doc_id")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: set | None = set() if bytes_ else None
        for batch in batches:
            for a, b in slices(batch.column("text"), CHUNK):
                part = batch.slice(a, b - a)
                found = Anchors(part.column("text"))
                if held is not None:
                    grams = held.value
                    at = np.minimum(np.searchsorted(grams, found.gram), max(0, len(grams) - 1))
                    found.keep(grams[at] == found.gram if len(grams) else np.zeros(len(found.gram), dtype=bool))
                else:
                    starts = part.column("starts")
                    base = len(found.data) + 1
                    known = np.repeat(np.arange(len(starts)), pa.compute.list_value_length(starts).to_numpy()) * base
                    known = np.sort(known + starts.flatten().to_numpy())
                    found.keep(np.isin(found.row * base + found.start, known))
                if len(found.gram):
                    yield _cut(found, part.column("doc_id"), seen)

    return docs.mapInArrow(run, PIECE if bytes_ else PLACE)


# ---- columns --------------------------------------------------------------------------------


def repeats(data: np.ndarray, ends: np.ndarray, group: np.ndarray, place: np.ndarray, rank: np.ndarray, width: int = WIDTH):
    """Windows that are repeats: the piece and the window's start in it.

    Pieces lie one after another in ``data``; those of one ``group`` are aligned at ``place``. Of equal
    windows the one of the piece with the least ``rank`` is the first.
    """
    m = len(group)
    start = ends[:-1]
    left, right = place, np.diff(ends) - place
    order = np.lexsort((rank, group))
    prefix = np.zeros(m, dtype=np.int64)  # common with the one before in the order
    pieces, columns = [], []
    for column in range(int(right.max()) - 1, -int(left.max()) - 1, -1):
        inside = (column >= -left[order]) & (column < right[order])
        symbol = np.zeros(m, dtype=np.int64)
        which = order[inside]
        symbol[inside] = data[start[which] + place[which] + column] + np.int64(1)
        key = group[order] * 257 + symbol
        turn = np.argsort(key, kind="stable")
        key = key[turn]
        same = np.flatnonzero((key[1:] == key[:-1]) & (symbol[turn[1:]] > 0)) + 1
        grown = np.zeros(m, dtype=np.int64)
        if len(same):
            grown[same] = 1 + _least_between(prefix, turn[same - 1] + 1, turn[same])
        order, prefix = order[turn], grown
        if (prefix >= width).any():
            first = np.flatnonzero(prefix < width)
            ranks = rank[order]
            least = np.repeat(np.minimum.reduceat(ranks, first), np.diff(np.append(first, m)))
            late = order[ranks != least]
            pieces.append(late)
            columns.append(column + place[late])
    if not pieces:
        return np.zeros(0, dtype=np.int64), np.zeros(0, dtype=np.int64)
    return np.concatenate(pieces), np.concatenate(columns)


def _least_between(x: np.ndarray, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """The least of x[a..b], ends included, for each pair."""
    span = b - a + 1
    level = np.zeros(len(a), dtype=np.int64)
    longest = int(span.max())
    out = np.empty(len(a), dtype=x.dtype)
    table, size, k = x, 1, 0
    level = np.floor(np.log2(span)).astype(np.int64)
    while True:
        now = level == k
        if now.any():
            out[now] = np.minimum(table[a[now]], table[b[now] - size + 1])
        if size * 2 > longest:
            return out
        table = np.minimum(table[: len(table) - size], table[size:])
        size, k = size * 2, k + 1


def _in_columns(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Repeats among pieces that arrive in the order of their anchors: doc_id, and the bytes' range."""
    held: list[pa.RecordBatch] = []
    size = 0
    for batch in batches:
        for a in range(0, batch.num_rows, 4096):
            held.append(batch.slice(a, 4096))
            size += held[-1].column("piece").nbytes
            if size > RUN_BYTES:
                rows = pa.Table.from_batches(held).combine_chunks().to_batches()[0]
                gram = rows.column("gram").to_numpy()
                cut = int(np.flatnonzero(gram != gram[-1])[-1]) + 1 if gram[0] != gram[-1] else 0
                if cut:
                    yield _late(rows.slice(0, cut))
                    held = [rows.slice(cut)]
                    size = held[0].column("piece").nbytes
    if held:
        yield _late(pa.Table.from_batches(held).combine_chunks().to_batches()[0])


def _late(rows: pa.RecordBatch) -> pa.RecordBatch:
    gram = rows.column("gram").to_numpy()
    group = np.cumsum(np.concatenate(([0], gram[1:] != gram[:-1])))
    several = np.bincount(group)[group] > 1
    rows = rows.filter(pa.array(several))
    if not rows.num_rows:
        return _ranges(rows.column("doc_id"), np.zeros(0, dtype=np.int64), np.zeros(0, dtype=np.int64))
    piece = rows.column("piece")
    ends = np.frombuffer(piece.buffers()[1], dtype=np.int32)[piece.offset : piece.offset + len(piece) + 1].astype(np.int64)
    data = np.frombuffer(piece.buffers()[2], dtype=np.uint8)[ends[0] : ends[-1]]
    doc, start, place = (rows.column(c).to_numpy() for c in ("doc_id", "start", "place"))
    order = np.lexsort((start + place, doc))
    rank = np.empty(len(order), dtype=np.int64)
    rank[order] = np.arange(len(order))
    which, at = repeats(data, ends - ends[0], group[several], place, rank)
    order = np.lexsort((at, which))
    which, at = which[order], at[order]
    new = np.flatnonzero(np.concatenate(([True], (which[1:] != which[:-1]) | (at[1:] != at[:-1] + 1)))) if len(at) else at
    last = np.append(new[1:], len(at)) - 1 if len(at) else at
    return _ranges(rows.column("doc_id").take(pa.array(which[new])), start[which[new]] + at[new], start[which[new]] + at[last] + WIDTH)


def _ranges(ids, begin, end) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([ids, pa.array(begin), pa.array(end)], names=["doc_id", "begin", "end"])


def repeated_spans(docs: DataFrame, hot: int = HOT) -> DataFrame:
    """The maximal runs of repeated bytes: doc_id, begin and end (bytes from 0, end not included)."""
    docs = docs.select("doc_id", "text").where("doc_id is not null and octet_length(text) >= 100")
    pieces = materialize(_pieces(docs, repeated_anchors(docs), False), "suffix-pieces")
    found = F.min(F.struct("doc_id", "start", "count", "place")).alias("f")
    firsts = pieces.groupBy("gram", "content").agg(found, F.count("*").alias("n"))
    firsts = materialize(firsts.select("gram", "content", "f.*", "n"), "suffix-firsts")
    range_ = ["doc_id", F.col("start").alias("begin"), (F.col("start") + F.col("count") + (WIDTH - 1)).alias("end")]
    # every occurrence of a piece but the first goes as a whole
    first = firsts.where("n > 1").select("gram", "content", F.col("doc_id").alias("first_id"), F.col("start").alias("first_start"))
    copies = pieces.select("gram", "content", "doc_id", "start", "count").join(first, ["gram", "content"])
    ranges = copies.where("doc_id <> first_id or start <> first_start").select(*range_)
    groups = materialize(firsts.groupBy("gram").agg(F.count("*").alias("pieces")).where("pieces > 1"), "suffix-groups")
    # only anchors with different pieces need bytes, which are cut in a second pass over the texts
    bodies = _pieces(docs, groups.select("gram"), True).groupBy("gram", "content").agg(F.first("piece", ignorenulls=True).alias("piece"))
    several = firsts.drop("n").join(groups, "gram").join(bodies, ["gram", "content"])
    normal = several.where(F.col("pieces") <= hot).select("gram", "doc_id", "start", "place", "piece")
    sorted_ = normal.repartition("gram").sortWithinPartitions("gram")
    ranges = ranges.union(sorted_.mapInArrow(_in_columns, "doc_id bigint, begin bigint, end bigint"))
    if not groups.where(F.col("pieces") > hot).isEmpty():
        ranges = ranges.union(_window_by_window(several.where(F.col("pieces") > hot)))
    w = Window.partitionBy("doc_id").orderBy("begin", "end")
    reach = F.max("end").over(w.rowsBetween(Window.unboundedPreceding, -1))
    parts = ranges.withColumn("new", F.when(F.col("begin") <= reach, 0).otherwise(1)).withColumn("part", F.sum("new").over(w))
    spans = parts.groupBy("doc_id", "part").agg(F.min("begin").alias("begin"), F.max("end").alias("end"))
    return materialize(spans.select("doc_id", "begin", "end"), "suffix-spans")


def _window_by_window(firsts: DataFrame) -> DataFrame:
    each = firsts.select("doc_id", "start", "piece", F.explode(F.sequence(F.lit(0), F.col("count").cast("int") - 1)).alias("at"))
    windows = each.select("doc_id", (F.col("start") + F.col("at")).alias("begin"), F.substring("piece", F.col("at") + 1, F.lit(WIDTH)).alias("window"))
    first = windows.groupBy("window").agg(F.min(F.struct("doc_id", "begin")).alias("f"), F.count("*").alias("n")).where("n > 1")
    late = windows.join(first, "window").where((F.col("doc_id") != F.col("f.doc_id")) | (F.col("begin") != F.col("f.begin")))
    return late.select("doc_id", "begin", (F.col("begin") + WIDTH).alias("end"))


def remove(docs: DataFrame, spans: DataFrame) -> DataFrame:
    """Every row of ``docs``: doc_id, n_bytes, n_removed, n_spans and ``kept``, the bytes that are left."""
    listed = spans.groupBy("doc_id").agg(F.sort_array(F.collect_list(F.struct("begin", "end"))).alias("spans"))
    listed = materialize(listed, "suffix-listed")
    rows = join_sized(docs.select("doc_id", "text"), listed, "doc_id", "left", row_bytes=256)
    content = F.coalesce(F.col("text"), F.lit("")).cast("binary")
    size = F.octet_length(content)
    inside = F.filter("spans", lambda s: s["end"] <= size)
    start = F.struct(F.lit(0).cast("bigint").alias("at"), F.lit("").cast("binary").alias("kept"))
    piece = lambda a, b: F.substring(content, (a + 1).cast("int"), (b - a).cast("int"))
    walk = lambda acc, s: F.struct(s["end"].alias("at"), F.concat(acc["kept"], piece(acc["at"], s["begin"])).alias("kept"))
    kept = F.aggregate(inside, start, walk, lambda acc: F.concat(acc["kept"], piece(acc["at"], size.cast("bigint"))))
    return rows.select(
        "doc_id",
        size.cast("bigint").alias("n_bytes"),
        F.coalesce(F.aggregate(inside, F.lit(0).cast("bigint"), lambda n, s: n + s["end"] - s["begin"]), F.lit(0)).cast("bigint").alias("n_removed"),
        F.coalesce(F.when(F.col("spans").isNotNull(), F.size(inside)), F.lit(0)).cast("bigint").alias("n_spans"),
        F.coalesce(kept, content).alias("kept"),
    )


def _texts_of_own(docs: DataFrame) -> DataFrame | None:
    """Where one doc_id has several texts: doc_id and hash of each of its texts, and a number ``place`` in the
    order of both for all documents; None where no doc_id has."""
    several = docs.where("doc_id is not null").groupBy("doc_id").count().where("count > 1").select("doc_id")
    several = materialize(several, "suffix-several")
    if several.isEmpty():
        return None
    texts = docs.where("doc_id is not null").select("doc_id", F.xxhash64("text").alias("text_hash")).distinct()
    if join_sized(texts, several, "doc_id", "left_semi").groupBy("doc_id").count().where("count > 1").isEmpty():
        return None
    return dense_index(texts, ["doc_id", "text_hash"], "place")


def dedup(docs: DataFrame, hot: int = HOT) -> DataFrame:
    """Every row of ``docs`` without what repeats. Rows with one doc_id and one text are one document; several
    texts under one doc_id are documents of their own, in the order of their hashes."""
    docs = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), "text")
    places = _texts_of_own(docs)
    if places is None:
        return remove(docs, repeated_spans(docs, hot))
    hashed = docs.withColumn("text_hash", F.xxhash64("text"))
    named = materialize(
        hashed.join(places, ["doc_id", "text_hash"], "left").select(F.col("place").alias("doc_id"), "text", F.col("doc_id").alias("given")), "suffix-named"
    )
    out = remove(named, repeated_spans(named, hot))
    back = places.select("place", F.col("doc_id").alias("given"))
    return out.join(back, F.col("doc_id") == F.col("place"), "left").select(F.col("given").alias("doc_id"), *[c for c in out.columns if c != "doc_id"])
