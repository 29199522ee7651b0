"""Exact similarity join of documents by the Jaccard distance of their word n-gram sets.

Two documents link when their sets' Jaccard similarity reaches a threshold; the result is every
document's component under links.

Jaccard distance is a metric, so a region around a pivot has to be compared only with documents whose
distance to that pivot comes within reach by the triangle inequality. Over a whole corpus that alone
separates nothing: nearly all distances are 1, from any pivot. So the recursion starts with cells.

1. Cells. Documents with equal sets are one entity. Sizes fall in levels such that a link joins equal
   or neighbouring levels, and a level bounds the symmetric difference of a link by some D. The hash
   space is cut in more than D parts; two linked sets agree on a part that isn't empty, so the content
   of each part is a key (pigeonhole; empty parts are allowed for, and sets with more empty parts than
   allowed meet by their prefixes). A passage that many documents share doesn't bring them together,
   as a part's content must be equal as a whole. Keys are range-partitioned with the entities, so a
   key that is very frequent is spread over tasks too.
2. Regions. Entities connected by keys form regions, and all links lie within one. A large region is
   cut finer without moving its sets: two sets that link share one of their rarest n-grams, and their
   marks (a bit for each place of a hash space, the parity of the n-grams there) differ in no more bits
   than the sets may in n-grams. Sets that share one and whose marks are that near are connected, and
   what they connect are its regions. A region that is still large is
   split by pivots: everyone is measured against the pivots and goes to the nearest one's Voronoi
   region, and also to every region whose pivot is less than 2 r farther (r: the greatest distance of
   a link), as a partner may live there. Pivots are done then, and so are regions whose members all
   link with their pivot. This repeats; what pivots can't split is cut in blocks that are joined by
   pairs. So no task holds more than a bounded region, whatever the groups.
3. Within a region pivots connect large families; of the rest, sets that share one of their rarest
   n-grams are measured exactly, unless they are connected already.

Words and sets go through 64-bit hashes. Defined cases: null text, or no word: an empty set, linked
with nothing; fewer words than n: the whole sequence is the one n-gram. Repeated rows are equal sets
and so one component. Rows without a doc_id link and connect others like any row; a component's id is the
least id that isn't null. Empty table: empty result. Columns beyond doc_id and text play no part.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from affinity.llm.graph import components, join_sized
from affinity.llm.text import hash_spans, id_or_text_hash, lower_table, mix, rolling, slices, space_table, text_bytes, word_spans
from affinity.operators.ranking import best_per_group
from affinity.session import materialize

CHUNK = 2_000_000
REGION = 30_000  # entities that one task compares
AT_A_TIME = 1_000_000  # n-grams of a comparison that are looked up together
PIVOTS = 8
ROUNDS = 4
SEEN = 1_000_000  # entities a task remembers so as not to send equal sets twice
BUCKETS = 1 << 16  # of n-grams by hash, counted to tell rare ones from frequent ones
LIST = 20_000  # sets with one of their rarest n-grams in common that a task compares by their marks
MARK_WORDS = 256  # of 64 bits; a set of more n-grams than bits is told apart less well


def shingle_sets(texts, n: int) -> list[np.ndarray]:
    """The sorted distinct n-gram hashes of each text of an Arrow column."""
    data, offsets = text_bytes(texts)
    data = lower_table()[data]
    start, length = word_spans(data, space_table())
    words = hash_spans(data, start, length)
    first = np.searchsorted(start, offsets)
    grams = rolling(words, n)
    out = []
    for a, b in zip(first[:-1].tolist(), first[1:].tolist()):
        if b - a >= n:
            out.append(np.unique(grams[a : b - n + 1]))
        elif b > a:
            out.append(mix(rolling(words[a:b], b - a) + np.uint64(b - a)))
        else:
            out.append(np.zeros(0, dtype=np.uint64))
    return out


def entity(s: np.ndarray) -> int:
    """A 64-bit name of a set's content."""
    total = mix(s ^ np.uint64(0x5851F42D4C957F2D)).sum(dtype=np.uint64)
    named = (int(total) + len(s) * 0x9E3779B97F4A7C15) & 0xFFFFFFFFFFFFFFFF
    return int(mix(np.array([named], dtype=np.uint64)).view(np.int64)[0])


class Levels:
    """Levels of set sizes for a threshold of ``num / den``, and the parts of each."""

    def __init__(self, num: int, den: int):
        self.num, self.den = num, den
        self.low = [1]
        self.plans: dict[int, tuple[int, int]] = {}
        self.cuts: dict[int, np.ndarray] = {}

    def level(self, size: int) -> int:
        while self.low[-1] <= size:
            self.low.append(self.low[-1] * self.den // self.num + 1)
        return int(np.searchsorted(self.low, size, side="right")) - 1

    def plan(self, level: int) -> tuple[int, int]:
        """Number of parts, and how many of them may be empty."""
        if level not in self.plans:
            while len(self.low) < level + 2:
                self.low.append(self.low[-1] * self.den // self.num + 1)
            most = self.low[level + 1] - 1
            differ = (self.den - self.num) * 2 * most // (self.den + self.num)
            slack = 0
            if differ:
                least = max(1, self.low[level] * self.num // self.den)
                for _ in range(2):
                    parts = differ + 1 + slack
                    mean = parts * math.exp(-least / parts)  # of empty parts
                    slack = math.ceil(mean + 2 * math.sqrt(mean))
            self.plans[level] = (differ + 1 + slack, slack)
        return self.plans[level]

    def edges(self, parts: int) -> np.ndarray:
        if parts not in self.cuts:
            self.cuts[parts] = np.array([i * (1 << 64) // parts for i in range(parts)], dtype=np.uint64)
        return self.cuts[parts]

    def keys(self, s: np.ndarray) -> np.ndarray:
        """The keys of a set, at its own level and at the next one, where larger partners are."""
        out = []
        own = self.level(len(s))
        sums = np.concatenate((np.zeros(1, dtype=np.uint64), np.cumsum(mix(s + np.uint64(0x2545F4914F6CDD1D)), dtype=np.uint64)))
        for level in (own, own + 1):
            parts, allowed = self.plan(level)
            edges = self.edges(parts)
            at = np.append(np.searchsorted(s, edges), len(s))
            full = np.flatnonzero(at[1:] > at[:-1])
            tag = mix(full.astype(np.uint64) + np.uint64((level << 32) + 1))
            out.append(mix((sums[at[full + 1]] - sums[at[full]]) ^ tag))
            if parts - len(full) > allowed:
                need = -(-self.num * len(s) // self.den)
                out.append(mix(s[: len(s) - need + 1] ^ np.uint64(0xD6E8FEB86659FD93 + level)))
        return np.unique(np.concatenate(out))


def _entities(docs: DataFrame, n: int) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for a, b in slices(batch.column("text"), CHUNK):
                sets = shingle_sets(batch.column("text")[a:b], n)
                sizes = [len(s) for s in sets]
                names = [entity(s) if len(s) else None for s in sets]
                yield pa.RecordBatch.from_arrays(
                    [batch.column("doc_id")[a:b], batch.column("key")[a:b], pa.array(sizes, pa.int64()), pa.array(names, pa.int64())],
                    names=["doc_id", "key", "n_shingles", "entity"],
                )

    return docs.select("doc_id", id_or_text_hash().alias("key"), "text").mapInArrow(run, "doc_id bigint, key bigint, n_shingles bigint, entity bigint")


def _keys(docs: DataFrame, n: int, num: int, den: int) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        levels, seen = Levels(num, den), set()
        for batch in batches:
            for a, b in slices(batch.column("text"), CHUNK):
                keys, names = [], []
                for s in shingle_sets(batch.column("text")[a:b], n):
                    if len(s) and (name := entity(s)) not in seen:
                        if len(seen) < SEEN:
                            seen.add(name)
                        found = levels.keys(s)
                        keys.append(found.view(np.int64))
                        names.append(np.full(len(found), name, dtype=np.int64))
                if keys:
                    yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(keys)), pa.array(np.concatenate(names))], names=["key", "entity"])

    return docs.mapInArrow(run, "key bigint, entity bigint")


def _connected(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Of rows in the order of key and entity: an edge from each key's first entity to its others, and,
    marked as open, the first and the last row, as their keys may go on in other partitions."""
    key, head, end = None, None, None
    for batch in batches:
        if not batch.num_rows:
            continue
        k, e = batch.column("key").to_numpy(), batch.column("entity").to_numpy()
        a, b, opened = [], [], []
        if key is None:
            a, b, opened = [k[:1]], [e[:1]], [np.ones(1, dtype=bool)]
        start = np.flatnonzero(np.concatenate(([key is None or k[0] != key], k[1:] != k[:-1])))
        first = np.repeat(e[start], np.diff(np.append(start, len(k))))
        if len(first) < len(k):
            first = np.concatenate((np.full(len(k) - len(first), head), first))
        other = first != e
        edges = np.unique(np.stack((first[other], e[other])), axis=1)
        key, head, end = k[-1], first[-1], (k[-1:], e[-1:])
        a, b, opened = [*a, edges[0]], [*b, edges[1]], [*opened, np.zeros(edges.shape[1], dtype=bool)]
        yield _edge_batch(a, b, opened)
    if end is not None:
        yield _edge_batch([end[0]], [end[1]], [np.ones(1, dtype=bool)])


def _edge_batch(a, b, opened) -> pa.RecordBatch:
    arrays = [pa.array(np.concatenate(a)), pa.array(np.concatenate(b)), pa.array(np.concatenate(opened))]
    return pa.RecordBatch.from_arrays(arrays, names=["a", "b", "open"])


def _candidates(docs: DataFrame, n: int, num: int, den: int) -> DataFrame:
    """Edges between entities such that all links lie within the components they make."""
    keys = _keys(docs, n, num, den).repartitionByRange("key", "entity").sortWithinPartitions("key", "entity")
    found = materialize(keys.mapInArrow(_connected, "a bigint, b bigint, open boolean"), "jaccard-cells")
    opened = found.where("open").select(F.col("a").alias("key"), F.col("b").alias("entity"))
    across = opened.join(opened.groupBy("key").agg(F.min("entity").alias("head")), "key").where("entity <> head")
    return found.where("not open").select("a", "b").union(across.select("head", "entity"))


# ---- comparison -----------------------------------------------------------------------------


class Region:
    """The sets of one region, as places in its own vocabulary."""

    def __init__(self, names: np.ndarray, sets: list[np.ndarray]):
        self.names = names
        self.sizes = np.array([len(s) for s in sets], dtype=np.int64)
        every = np.concatenate(sets)
        in_order = np.sort(every)
        # n-grams of one set alone can't be shared; only their number counts
        self.vocabulary = np.unique(in_order[1:][in_order[1:] == in_order[:-1]])
        del in_order
        at = np.searchsorted(self.vocabulary, every)
        known = np.zeros(len(every), dtype=bool)
        if len(self.vocabulary):
            known = self.vocabulary[np.minimum(at, len(self.vocabulary) - 1)] == every
        self.places = at[known].astype(np.int32)
        ends = np.cumsum(self.sizes)
        before = np.concatenate(([0], np.cumsum(known)))
        self.common = before[ends] - before[ends - self.sizes]
        self.start = np.cumsum(self.common) - self.common
        self.root = np.arange(len(sets))

    def shared(self, i: int, with_: np.ndarray) -> np.ndarray:
        """Sizes of the intersections of set ``i`` with the sets ``with_``."""
        mark = np.zeros(len(self.vocabulary), dtype=np.uint8)
        mark[self.places[self.start[i] : self.start[i] + self.common[i]]] = 1
        out, ends, lo = np.empty(len(with_), dtype=np.int64), np.cumsum(self.common[with_]), 0
        while lo < len(with_):  # a bounded number of n-grams at a time
            hi = max(lo + 1, int(np.searchsorted(ends, (ends[lo - 1] if lo else 0) + AT_A_TIME, side="right")))
            sizes = self.common[with_[lo:hi]]
            first = np.cumsum(sizes) - sizes
            at = np.repeat(self.start[with_[lo:hi]] - first, sizes) + np.arange(int(sizes.sum()))
            sums = np.concatenate(([0], np.cumsum(mark[self.places[at]], dtype=np.int64)))
            out[lo:hi] = sums[first + sizes] - sums[first]
            lo = hi
        return out

    def find(self, i: int) -> int:
        while self.root[i] != i:
            self.root[i] = self.root[self.root[i]]
            i = self.root[i]
        return i

    def join(self, i: int, others: np.ndarray, num: int, den: int, edges: list) -> None:
        """Measures set ``i`` against others and connects it with those it links with."""
        shared = self.shared(i, others)
        union = self.sizes[i] + self.sizes[others] - shared
        for j in others[shared * den >= num * union].tolist():
            a, b = self.find(i), self.find(j)
            if a != b:
                self.root[b] = a
                edges.append((int(self.names[i]), int(self.names[j])))

    def links(self, num: int, den: int, pivots: int = PIVOTS) -> list[tuple[int, int]]:
        """Edges of a forest that connects what links connect.

        Pivots are measured against all first, which connects large families. Then sets that share one
        of their rarest n-grams are measured, if they aren't connected yet: of two sets that link, the
        first ``size - need + 1`` n-grams in the order of their frequency here share one.
        """
        count, edges = len(self.names), []
        everyone, used = np.arange(count), set()
        for i in range(count):
            if len(used) == pivots:
                break
            if self.find(i) not in used:
                self.join(i, everyone, num, den, edges)
                used.add(self.find(i))
        frequency = np.bincount(self.places, minlength=1).astype(np.int32)[self.places]
        owner = np.repeat(everyone.astype(np.int32), self.common)
        order = np.lexsort((self.places, frequency, owner))
        del frequency
        # the place among a set's n-grams; those of the set alone are its rarest
        rank = np.empty(len(order), dtype=np.int64)
        rank[order] = np.arange(len(order)) - np.repeat(self.start - (self.sizes - self.common), self.common)
        need = -(-num * self.sizes // den)
        first = np.flatnonzero(rank < np.repeat(self.sizes - need + 1, self.common))
        first = first[np.argsort(self.places[first], kind="stable")]
        place, docs = self.places[first], owner[first]
        del owner, order, rank
        # of each entry of the lists by n-gram, where its list ends; a set meets the later ones of all its lists at once
        ends = np.searchsorted(place, place, side="right")
        by_set = np.argsort(docs, kind="stable")
        bounds = np.searchsorted(docs[by_set], np.arange(count + 1))
        for i in range(count):
            entries = by_set[bounds[i] : bounds[i + 1]]
            entries = entries[ends[entries] > entries + 1]
            if not len(entries):
                continue
            later = np.unique(np.concatenate([docs[e + 1 : ends[e]] for e in entries.tolist()]))
            fit = (self.sizes[later] * den >= num * self.sizes[i]) & (self.sizes[i] * den >= num * self.sizes[later])
            later = later[fit]
            later = later[self.roots(later) != self.find(i)]
            if len(later):
                self.join(i, later, num, den, edges)
        return edges

    def roots(self, of: np.ndarray) -> np.ndarray:
        root = self.root[of]
        while (self.root[root] != root).any():
            root = self.root[root]
        return root


def _lists(column) -> list[np.ndarray]:
    flat, ends = column.flatten().to_numpy(), column.offsets.to_numpy()
    ends = ends - ends[0]
    return [flat[a:b].view(np.uint64) for a, b in zip(ends[:-1].tolist(), ends[1:].tolist())]


def _linked(num: int, den: int):
    def flush(names, sets, out):
        if len(names) > 1:
            out += Region(np.array(names), sets).links(num, den)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        region, names, sets = None, [], []
        for batch in batches:
            edges: list[tuple[int, int]] = []
            rows = zip(batch.column("region").to_pylist(), batch.column("entity").to_pylist(), _lists(batch.column("shingles")))
            for r, e, s in rows:
                if r != region:
                    flush(names, sets, edges)
                    region, names, sets = r, [], []
                if not names or names[-1] != e:  # rows are in the order of entities
                    names.append(e)
                    sets.append(s)
            yield _links_batch(edges)
        edges = []
        flush(names, sets, edges)
        yield _links_batch(edges)

    return run


def _links_batch(edges) -> pa.RecordBatch:
    both = np.array(edges, dtype=np.int64).reshape(-1, 2)
    return pa.RecordBatch.from_arrays([pa.array(both[:, 0]), pa.array(both[:, 1])], names=["a", "b"])


SETS = "region bigint, entity bigint, shingles array<bigint>"


def _wanted_sets(batches: Iterator[pa.RecordBatch], n: int) -> Iterator[tuple[pa.RecordBatch, list[np.ndarray]]]:
    """Of texts beside the entity wanted from them: the rows that have it, and their sets."""
    for batch in batches:
        for a, b in slices(batch.column("text"), CHUNK):
            part = batch.slice(a, b - a)
            sets = shingle_sets(part.column("text"), n)
            expected = part.column("entity").to_pylist()
            right = [i for i, s in enumerate(sets) if len(s) and entity(s) == expected[i]]
            if right:
                yield part.drop_columns(["text"]).take(pa.array(right, pa.int64())), [sets[i] for i in right]


def _texts(docs: DataFrame, wanted: DataFrame) -> DataFrame:
    return join_sized(docs.withColumn("key", id_or_text_hash()), wanted, "key").select("region", "entity", "text")


def _region_sets(docs: DataFrame, wanted: DataFrame, n: int) -> DataFrame:
    """region, entity and the set of each wanted entity, from the text of one of its documents."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows, sets in _wanted_sets(batches, n):
            lists = pa.array([s.view(np.int64) for s in sets], pa.list_(pa.int64()))
            yield pa.RecordBatch.from_arrays([*rows.select(["region", "entity"]).columns, lists], names=["region", "entity", "shingles"])

    return _texts(docs, wanted).mapInArrow(run, SETS)


# ---- finer regions --------------------------------------------------------------------------


def _bucket(s: np.ndarray) -> np.ndarray:
    return (s >> np.uint64(48)).astype(np.int64) % BUCKETS


def _bucket_counts(texts: DataFrame, n: int) -> np.ndarray:
    """How many n-grams of sets fall in each bucket: a fixed number, so the driver may hold them."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = np.zeros(BUCKETS, dtype=np.int64)
        for _, sets in _wanted_sets(batches, n):
            counts += np.bincount(_bucket(np.concatenate(sets)), minlength=BUCKETS)
        some = np.flatnonzero(counts)
        yield pa.RecordBatch.from_arrays([pa.array(some.astype(np.int32)), pa.array(counts[some])], names=["bucket", "n"])

    found = texts.mapInArrow(run, "bucket int, n bigint").groupBy("bucket").agg(F.sum("n").alias("n")).toArrow()
    counts = np.zeros(BUCKETS, dtype=np.int64)
    counts[found["bucket"].to_numpy()] = found["n"].to_numpy()
    return counts


def rarest(s: np.ndarray, counts: np.ndarray, num: int, den: int) -> np.ndarray:
    """Those n-grams of a set, rare ones first, of which it shares one with every set it links with."""
    need = -(-num * len(s) // den)
    return s[np.lexsort((s, counts[_bucket(s)]))[: len(s) - need + 1]]


def mark(s: np.ndarray) -> np.ndarray:
    """The parity of a set's n-grams in each place of a hash space of about as many places."""
    words = min(MARK_WORDS, 1 << max(0, (len(s) - 1) // 64).bit_length())
    odd = np.bincount((s & np.uint64(64 * words - 1)).astype(np.int64), minlength=64 * words) & 1
    return np.packbits(odd.astype(np.uint8)).view(np.uint64)


def _whole_lists(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.Table]:
    """Of rows in the order of ``gram``: tables whose last n-gram doesn't go on in the next one."""
    held: list[pa.RecordBatch] = []
    for batch in batches:
        if not batch.num_rows:
            continue
        gram = batch.column("gram").to_numpy()
        cut = int(np.searchsorted(gram, gram[-1]))
        if cut or (held and held[-1].column("gram")[-1].as_py() != gram[0]):
            yield pa.Table.from_batches([*held, batch.slice(0, cut)])
            held = []
        held.append(batch.slice(cut))
    if held:
        yield pa.Table.from_batches(held)


def _shared(most: int):
    """Of rows in the order of gram and entity, once each: those whose n-gram others have too. Where more than
    ``most`` have it they are connected as they are: ``head`` is the first of them."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table in _whole_lists(batches):
            gram, name = table["gram"].to_numpy(), table["entity"].to_numpy()
            once = np.concatenate(([True], (gram[1:] != gram[:-1]) | (name[1:] != name[:-1])))
            gram, name = gram[once], name[once]
            start = np.flatnonzero(np.concatenate(([True], gram[1:] != gram[:-1])))
            rows = np.diff(np.append(start, len(gram)))
            rows, head = np.repeat(rows, rows), np.repeat(name[start], rows)
            keep = rows > 1
            heads = pa.array(head[keep], pa.int64(), mask=rows[keep] <= most)
            yield pa.RecordBatch.from_arrays([pa.array(gram[keep]), pa.array(name[keep]), heads], names=["gram", "entity", "head"])

    return run


class Marked:
    """Sets with an n-gram in common, in the order of their sizes."""

    def __init__(self, names: list[int], sizes: np.ndarray, marks: np.ndarray):
        self.names, self.sizes, self.marks = names, sizes, marks
        self.words = np.minimum(MARK_WORDS, [1 << max(0, (x - 1) // 64).bit_length() for x in sizes.tolist()])
        self.start = np.cumsum(self.words) - self.words

    def differ(self, i: int, others: np.ndarray) -> np.ndarray:
        """So many n-grams at least are in set ``i`` or one of the others (none smaller) but not in both."""
        mine = self.marks[self.start[i] : self.start[i] + self.words[i]]
        out, words = np.empty(len(others), dtype=np.int64), self.words[others]
        for wide in np.unique(words).tolist():
            at = np.flatnonzero(words == wide)
            theirs = self.marks[self.start[others[at]][:, None] + np.arange(wide)].reshape(len(at), -1, len(mine))
            out[at] = np.bitwise_count(np.bitwise_xor.reduce(theirs, axis=1) ^ mine).sum(axis=1, dtype=np.int64)
        return out

    def edges(self, num: int, den: int, find, connect) -> None:
        """Connects sets that may link, unless they are connected."""
        root = np.array([find(x) for x in self.names])
        until = np.searchsorted(self.sizes, self.sizes * den // num, side="right")
        for i in range(len(self.names) - 1):
            if (root == root[0]).all():
                return
            others = i + 1 + np.flatnonzero(root[i + 1 : until[i]] != root[i])
            if not len(others):
                continue
            may = self.differ(i, others) * (den + num) <= (self.sizes[i] + self.sizes[others]) * (den - num)
            for j in others[may].tolist():
                if root[j] != root[i]:
                    connect(self.names[i], self.names[j])
                    root[root == root[j]] = root[i]


def _near(num: int, den: int):
    """Of rows in the order of gram, size and entity: edges between sets that may link."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        parent: dict[int, int] = {}

        def find(x: int) -> int:
            while (up := parent.get(x, x)) != x:
                parent[x] = parent.get(up, up)
                x = up
            return x

        for table in _whole_lists(batches):
            edges: list[tuple[int, int]] = []

            def connect(a: int, b: int) -> None:
                edges.append((a, b))
                parent[find(b)] = find(a)

            if len(parent) > SEEN:
                parent.clear()
            gram, names, sizes = table["gram"].to_numpy(), table["entity"].to_pylist(), table["size"].to_numpy()
            ends = np.append(np.flatnonzero(gram[1:] != gram[:-1]) + 1, len(gram)).tolist()
            column = table["mark"]
            for a, b in zip([0, *ends], ends):
                marks = np.frombuffer(b"".join(column.slice(a, b - a).to_pylist()), dtype=np.uint64)
                Marked(names[a:b], sizes[a:b], marks).edges(num, den, find, connect)
            yield _links_batch(edges)

    return run


def _finer(docs: DataFrame, wanted: DataFrame, n: int, num: int, den: int) -> DataFrame:
    """Edges between wanted entities such that all links lie within the components they make."""
    texts = _texts(docs, wanted)
    shared = texts.sparkSession.sparkContext.broadcast(_bucket_counts(texts, n))

    def grams(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows, sets in _wanted_sets(batches, n):
            found = [rarest(s, shared.value, num, den) for s in sets]
            names = np.repeat(rows.column("entity").to_numpy(), [len(f) for f in found])
            yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(found).view(np.int64)), pa.array(names)], names=["gram", "entity"])

    def marks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows, sets in _wanted_sets(batches, n):
            sizes = pa.array([len(s) for s in sets], pa.int64())
            yield pa.RecordBatch.from_arrays(
                [rows.column("entity"), sizes, pa.array([mark(s).tobytes() for s in sets], pa.binary())], names=["entity", "size", "mark"]
            )

    by_gram = texts.mapInArrow(grams, "gram bigint, entity bigint").repartition("gram").sortWithinPartitions("gram", "entity")
    lists = materialize(by_gram.mapInArrow(_shared(LIST), "gram bigint, entity bigint, head bigint"), "jaccard-lists")
    marked = texts.mapInArrow(marks, "entity bigint, size bigint, mark binary").dropDuplicates(["entity"])
    met = lists.where("head is null").select("gram", "entity").join(materialize(marked, "jaccard-marks"), "entity")
    met = met.repartition("gram").sortWithinPartitions("gram", "size", "entity")
    near = met.mapInArrow(_near(num, den), "a bigint, b bigint")
    return near.union(lists.where("head is not null and head <> entity").select("head", "entity"))


def _measured(num: int, den: int):
    """Against each row's pivots: links with them, and the regions the row goes to."""
    reach = 1 - num / den + 1e-9

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = {"region": [], "entity": [], "shingles": [], "pivot": [], "linked": [], "home": []}
            names = batch.column("entity").to_pylist()
            for i, s in enumerate(_lists(batch.column("shingles"))):
                region = batch.column("region")[i].as_py()
                pivots = batch.column("pivots")[i].as_py()
                theirs = [np.array(p["shingles"], dtype=np.int64).view(np.uint64) for p in pivots]
                shared = np.array([len(np.intersect1d(s, p, assume_unique=True)) for p in theirs])
                union = np.array([len(p) for p in theirs]) + len(s) - shared
                far = 1 - shared / union
                is_pivot = names[i] in [p["entity"] for p in pivots]
                home = int(far.argmin())
                for j, p in enumerate(pivots):
                    linked = bool(shared[j] * den >= num * union[j])
                    near = not is_pivot and far[j] <= far[home] + 2 * reach
                    if linked or near:
                        out["region"].append(int(mix(np.array([region, p["entity"]], dtype=np.int64).view(np.uint64)).sum(dtype=np.uint64).astype(np.int64)))
                        out["entity"].append(names[i])
                        out["shingles"].append(s.view(np.int64) if near else None)
                        out["pivot"].append(p["entity"])
                        out["linked"].append(linked)
                        out["home"].append(j == home)
            kinds = [pa.int64(), pa.int64(), pa.list_(pa.int64()), pa.int64(), pa.bool_(), pa.bool_()]
            yield pa.RecordBatch.from_arrays([pa.array(v, k) for v, k in zip(out.values(), kinds)], names=list(out))

    return run


def _split(sets: DataFrame, num: int, den: int) -> tuple[DataFrame, DataFrame]:
    """One round of pivots over large regions: links found, and the sets by their new regions."""
    pivots = best_per_group(sets, ["region"], [F.xxhash64("entity"), F.col("entity")], PIVOTS, "nth")
    pivots = materialize(pivots.groupBy("region").agg(F.collect_list(F.struct("entity", "shingles")).alias("pivots")), "jaccard-pivots")
    measured = join_sized(sets, pivots, "region", row_bytes=PIVOTS * 16_000).mapInArrow(
        _measured(num, den), SETS + ", pivot bigint, linked boolean, home boolean"
    )
    measured = materialize(measured, "jaccard-measured")
    links = measured.where("linked and entity <> pivot").select(F.col("entity").alias("a"), F.col("pivot").alias("b"))
    placed = measured.where("shingles is not null")
    done = placed.groupBy("region").agg(F.min("linked").alias("all"), F.max("home").alias("lived")).where("not `all` and lived")
    return links, materialize(join_sized(placed, materialize(done.select("region"), "jaccard-open"), "region").select("region", "entity", "shingles"), "jaccard-regions")


def _by_size(sets: DataFrame, region: int) -> tuple[DataFrame, DataFrame, bool]:
    sizes = sets.groupBy("region").agg(F.count("*").alias("rows"))
    large = materialize(sizes.where(F.col("rows") > region), "jaccard-large")
    if large.isEmpty():
        return sets, sets.limit(0), False
    small = join_sized(sets, large.select("region"), "region", "left_anti")
    return small, join_sized(sets, large, "region"), True


def _blocks(sets: DataFrame, region: int) -> DataFrame:
    """Large regions as pairs of blocks, each pair a region of its own."""
    half = F.lit(max(1, region // 2))
    n = F.ceil(F.col("rows") / half).cast("bigint")
    cut = sets.withColumn("n", n).withColumn("i", F.pmod(F.xxhash64("entity"), F.col("n")))
    paired = cut.withColumn("j", F.explode(F.sequence(F.lit(0).cast("bigint"), F.col("n") - 1)))
    key = F.xxhash64("region", F.least("i", "j"), F.greatest("i", "j"))
    return paired.select(key.alias("region"), "entity", "shingles")


def links(docs: DataFrame, entities: DataFrame, n: int, num: int, den: int, region: int = REGION) -> DataFrame:
    """Edges (a, b) between entities that connect what links connect."""
    regions = components(_candidates(docs, n, num, den))
    wanted = materialize(
        entities.join(regions, entities["entity"] == regions["node"]).groupBy("entity")
        .agg(F.min("key").alias("key"), F.first("root").alias("region")),
        "jaccard-wanted",
    )
    small, large, some = _by_size(wanted, region)
    if some:
        large = materialize(large.drop("rows", "region").withColumn("region", F.lit(0).cast("bigint")), "jaccard-unsplit")
        finer = materialize(components(_finer(docs, large, n, num, den)), "jaccard-finer")
        large = large.join(finer, F.col("entity") == F.col("node")).select("entity", "key", F.col("root").alias("region"))
        wanted = materialize(small.select("entity", "key", "region").union(large), "jaccard-wanted")
    sets = materialize(_region_sets(docs, wanted, n), "jaccard-sets")
    found = []
    for _ in range(ROUNDS):
        small, large, some = _by_size(sets, region)
        if not some:
            break
        new, large = _split(large.drop("rows"), num, den)
        found.append(new)
        sets = materialize(small.union(large), "jaccard-sets")
    else:
        small, large, some = _by_size(sets, region)
        sets = small.union(_blocks(large, region)) if some else small
    grouped = sets.repartition("region").sortWithinPartitions("region", "entity")
    out = grouped.mapInArrow(_linked(num, den), "a bigint, b bigint")
    for new in found:
        out = out.union(new)
    return out


def join(docs: DataFrame, n: int = 5, num: int = 80, den: int = 100, region: int = REGION) -> DataFrame:
    """doc_id, n_shingles and component_id for every row of ``docs``; a link has a similarity of at
    least ``num / den``."""
    docs = docs.select("doc_id", "text")
    entities = materialize(_entities(docs, n), "jaccard-entities")
    roots = materialize(components(links(docs, entities, n, num, den, region)), "jaccard-roots")
    named = join_sized(entities, roots, F.col("entity") == F.col("node"), "left").withColumn("root", F.coalesce("root", "entity"))
    named = materialize(named.select("doc_id", "n_shingles", "root"), "jaccard-named")
    least = named.where("root is not null").groupBy("root").agg(F.min("doc_id").alias("component_id"))
    return named.join(least, "root", "left").select("doc_id", "n_shingles", F.coalesce("component_id", "doc_id").alias("component_id"))


def keep_one(docs: DataFrame, n: int = 5, num: int = 80, den: int = 100) -> DataFrame:
    """One document of each component, the one with the least doc_id, once; its own columns only.

    Rows without a doc_id stay.
    """
    joined = join(docs, n, num, den)
    dropped = materialize(joined.where("doc_id <> component_id").select("doc_id").distinct(), "jaccard-dropped")
    again = joined.where("doc_id = component_id").groupBy("doc_id").agg(F.count("*").alias("rows")).where("rows > 1")
    again = materialize(again.select("doc_id"), "jaccard-again")
    rows = join_sized(docs, dropped, "doc_id", "left_anti")
    if again.isEmpty():
        return rows
    once = join_sized(rows, again, "doc_id", "left_semi").dropDuplicates(["doc_id"])
    return join_sized(rows, again, "doc_id", "left_anti").union(once)
