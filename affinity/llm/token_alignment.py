"""Alignment of two tokenizers over a corpus: which tokens cover the same bytes, and how often.

Both tokenize one byte string, so token ends are byte offsets. Offsets where both end cut a text into groups; a
link is a stretch between neighbouring ends of either, which lies in exactly one token of each. Most groups
are one token on each side with the same bytes. An array from A's ids to the B id of the same bytes (the
identity map) names those links by A's id alone: they are counted in vectors as long as the vocabulary and
looked up in them. Only links of other groups become pair rows, counted per document before the shuffle.
"""

from __future__ import annotations

import hashlib
import json
import os
import re
from collections import defaultdict
from itertools import chain, count, islice

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from affinity.llm.text import slices
from affinity.session import materialize

SLICE_BYTES = 1 << 20
HOT_PAIRS = 100_000  # the most frequent irregular pairs, which tasks hold; the others are joined by a shuffle
MEMO, MEMO_LETTERS = 500_000, 12_000_000  # pieces whose ids a task remembers, and their characters
SHIFT = 24  # a pair is one number: A's id, and B's id in the lower bits


# ---- vocabularies ---------------------------------------------------------------------


def _byte_letters() -> dict[str, int]:
    """The letters that stand for bytes in byte-level vocabularies: printable ones are themselves, the others follow 255."""
    plain = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    others = [b for b in range(256) if b not in set(plain)]
    return {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(others)}


def byte_level_tokens(vocabulary: str) -> list[bytes]:
    """Bytes of each id of a byte-level vocabulary (its JSON text); an id without an entry has none."""
    letters, entries = _byte_letters(), json.loads(vocabulary)["model"]["vocab"]
    out = [b""] * (1 + max(entries.values(), default=-1))
    for token, i in entries.items():
        out[i] = bytes(letters[c] for c in token)
    return out


def piece_tokens(model: bytes) -> list[bytes]:
    """Bytes of each id of a piece model: UTF-8 with U+2581 as space, and <0xHH> as the byte HH."""
    import sentencepiece

    pieces = sentencepiece.SentencePieceProcessor(model_proto=model)
    out = []
    for i in range(pieces.vocab_size()):
        piece = pieces.id_to_piece(i)
        out.append(bytes([int(piece[3:5], 16)]) if pieces.is_byte(i) else piece.replace("▁", " ").encode())
    return out


def identity_map(a: list[bytes], b: list[bytes]) -> np.ndarray:
    """For each A id the B id of the same bytes, or -1; of several the last, as whole pieces follow single bytes."""
    by_bytes = {token: i for i, token in enumerate(b) if token}
    return np.array([by_bytes.get(token, -1) if token else -1 for token in a], dtype=np.int64)


class _Ids:
    """Lists of ids by number, end to end."""

    def __init__(self):
        self.data, self.start, self.size = (np.zeros(0, dtype=np.int64) for _ in range(3))
        self.used = 0

    def add(self, flat: np.ndarray, size: np.ndarray) -> None:
        until = self.used + len(flat)
        if until > len(self.data):
            self.data = np.concatenate((self.data[: self.used], np.empty(2 * until - self.used, dtype=np.int64)))
        self.data[self.used : until] = flat
        self.start = np.concatenate((self.start, self.used + np.cumsum(size) - size))
        self.size, self.used = np.concatenate((self.size, size)), until

    def join(self, which: np.ndarray) -> np.ndarray:
        size = self.size[which]
        at = np.repeat(self.start[which] - (np.cumsum(size) - size), size)
        return self.data[at + np.arange(len(at))]


class _Spans:
    """Byte strings by number, end to end."""

    def __init__(self, strings: list[bytes]):
        self.size = np.array([len(s) for s in strings], dtype=np.int64)
        self.start = np.cumsum(self.size) - self.size
        self.data = np.frombuffer(b"".join(strings), dtype=np.uint8)

    def join(self, which: np.ndarray, gap: int = 0) -> np.ndarray:
        """The named strings end to end, with ``gap`` bytes of 0 behind each."""
        size = self.size[which]
        ends = np.cumsum(size + gap)
        out = np.zeros(int(ends[-1]) if len(ends) else 0, dtype=np.uint8)
        total = int(size.sum())
        nth = np.arange(total) - np.repeat(np.cumsum(size) - size, size)
        source = self.data[np.repeat(self.start[which], size) + nth]
        if gap:
            out[np.repeat(ends - size - gap, size) + nth] = source
            return out
        return source


# ---- one batch of texts ---------------------------------------------------------------


def _flat(lists: list[list[int]]) -> tuple[np.ndarray, np.ndarray]:
    counts = np.fromiter(map(len, lists), dtype=np.int64, count=len(lists))
    return np.fromiter(chain.from_iterable(lists), dtype=np.int64, count=int(counts.sum())), counts


#: A single space between characters that no version of Unicode takes for white space.
CUT = re.compile(r"(?<=[!-~\w]) (?=[!-~\w])")
"""Pieces between such spaces can be encoded apart, each with the space before it: a pre-tokenizer that takes a
space only before a run of other characters, and a piece vocabulary with U+2581 only at the start of a
piece, both have a token end there."""


def _doc_sums(values: np.ndarray, counts: np.ndarray) -> np.ndarray:
    edge, sums = np.concatenate(([0], np.cumsum(counts))), np.concatenate(([0], np.cumsum(values)))
    return sums[edge[1:]] - sums[edge[:-1]]


def faithful(texts: list[bytes], a, a_counts, b, b_counts, a_spans: _Spans, b_spans: _Spans) -> np.ndarray:
    """Which texts (space first) both tokenizers' bytes give back whole."""
    sizes = np.fromiter(map(len, texts), dtype=np.int64, count=len(texts))
    good = (sizes > 1) & (_doc_sums(a_spans.size[a], a_counts) == sizes) & (_doc_sums(b_spans.size[b], b_counts) == sizes)
    want = np.frombuffer(b"".join(t for t, g in zip(texts, good) if g), dtype=np.uint8)
    for ids, counts, spans in ((a, a_counts, a_spans), (b, b_counts, b_spans)):
        differs = spans.join(ids[np.repeat(good, counts)]) != want
        same = _doc_sums(differs, sizes[good]) == 0
        if not same.all():
            again = good.copy()
            again[np.flatnonzero(good)[~same]] = False
            want = want[np.repeat(same, sizes[good])]
            good = again
    return good


class Groups:
    """Groups and links of faithful texts: ids and counts by text of both tokenizers, and the tokens' sizes."""

    def __init__(self, a, a_counts, b, b_counts, a_size, b_size, same: np.ndarray):
        self.a, self.b = a, b
        total = int(a_size.sum())
        a_end, b_end = np.zeros(total, dtype=bool), np.zeros(total, dtype=bool)
        a_end[np.cumsum(a_size) - 1] = True
        b_end[np.cumsum(b_size) - 1] = True
        both = a_end & b_end
        group = np.cumsum(both) - both  # of each byte
        self.a_group, self.b_group = group[np.flatnonzero(a_end)], group[np.flatnonzero(b_end)]
        n = int(both.sum())
        self.a_in, self.b_in = np.bincount(self.a_group, minlength=n), np.bincount(self.b_group, minlength=n)
        doc_end = np.cumsum(_doc_sums(a_size, a_counts))
        ends = np.flatnonzero(both)
        self.group_doc = np.searchsorted(doc_end, ends, side="right")
        self.group_counts = np.bincount(self.group_doc, minlength=len(a_counts))
        link = np.flatnonzero(a_end | b_end)
        link_a, link_b = a[(np.cumsum(a_end) - a_end)[link]], b[(np.cumsum(b_end) - b_end)[link]]
        link_doc = self.group_doc[group[link]]
        plain = (self.a_in == 1)[group[link]] & (self.b_in == 1)[group[link]] & (same[link_a] == link_b)
        self.link_counts = np.bincount(link_doc, minlength=len(a_counts))
        self.same_doc, self.same_id = link_doc[plain], link_a[plain]
        self.pair_doc, self.pair = link_doc[~plain], (link_a[~plain] << SHIFT) | link_b[~plain]

    def text(self, numbers: _Spans) -> tuple[np.ndarray, np.ndarray]:
        """``a1,a2|b1;a3|b2`` of each text, end to end, and where each ends (a ``;`` stands behind the last group)."""
        a_until, b_until = np.cumsum(self.a_in), np.cumsum(self.b_in)
        a_at = np.arange(len(self.a)) + (b_until - self.b_in)[self.a_group]
        b_at = np.arange(len(self.b)) + a_until[self.b_group]
        ids = np.empty(len(self.a) + len(self.b), dtype=np.int64)
        mark = np.full(len(ids), ord(","), dtype=np.uint8)
        ids[a_at], ids[b_at] = self.a, self.b
        mark[a_at[a_until - 1]], mark[b_at[b_until - 1]] = ord("|"), ord(";")
        ends = np.cumsum(numbers.size[ids] + 1)
        out = numbers.join(ids, gap=1)
        out[ends - 1] = mark
        last = np.cumsum(self.group_counts) - 1  # of the groups of a text
        return out, ends[b_at[b_until - 1]][last]


def _per_doc(doc: np.ndarray, key: np.ndarray, n_docs: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Edges by document, and its distinct keys with their counts."""
    order = np.lexsort((key, doc))
    doc, key = doc[order], key[order]
    new = np.flatnonzero(np.concatenate(([True], (doc[1:] != doc[:-1]) | (key[1:] != key[:-1])))) if len(doc) else np.zeros(0, dtype=np.int64)
    n = np.diff(np.concatenate((new, [len(doc)])))
    return np.searchsorted(doc[new], np.arange(n_docs + 1)), key[new], n


FIELDS = (
    "n_a long, n_b long, n_groups long, n_links long, groups_sha256 string, "
    "_same array<int>, _same_n array<int>, _pairs array<long>, _pairs_n array<int>"
)


def _lists(edge, values, kind) -> pa.ListArray:
    return pa.ListArray.from_arrays(pa.array(edge, pa.int32()), pa.array(values, kind))


class Aligner:
    """Both tokenizers, their tables, and the figures of a list of texts."""

    def __init__(self, vocabulary: str, model: bytes):
        import sentencepiece
        from tokenizers import Tokenizer

        self.first = Tokenizer.from_str(vocabulary)
        self.first.encode_special_tokens = True
        self.first.no_padding()
        self.first.no_truncation()
        self.second = sentencepiece.SentencePieceProcessor(model_proto=model)
        a, b = byte_level_tokens(vocabulary), piece_tokens(model)
        kind = json.loads(vocabulary)
        before = kind["pre_tokenizer"] or {}
        splits = kind["normalizer"] is None and before.get("type") == "ByteLevel" and before.get("use_regex", True)
        splits = splits and all(b" " not in token.lstrip(b" ") for token in b)
        self.cut = CUT.split if splits else lambda text: [text]
        self._forget()
        self.same = identity_map(a, b)
        self.a, self.b = _Spans(a), _Spans(b)
        self.numbers = _Spans([str(i).encode() for i in range(max(len(a), len(b)))])

    def _forget(self) -> None:
        self.known: defaultdict[str, int] = defaultdict(count().__next__)  # numbers a piece when it is first asked for
        self.letters, self.ids = 0, (_Ids(), _Ids())
        # of each piece: tokens of A and B, groups, links and whether it is faithful; its groups' text, and its links
        self.counts = np.zeros((0, 5), dtype=np.int64)
        self.groups: list[bytes] = []
        self.links = (_Ids(), _Ids())

    def _judge(self, texts: list[bytes], a, a_counts, b, b_counts) -> None:
        """Groups and links of further pieces."""
        good = faithful(texts, a, a_counts, b, b_counts, self.a, self.b)
        a, b = a[np.repeat(good, a_counts)], b[np.repeat(good, b_counts)]
        a_counts, b_counts, rows = a_counts[good], b_counts[good], np.flatnonzero(good)
        found = Groups(a, a_counts, b, b_counts, self.a.size[a], self.b.size[b], self.same)
        counts = np.zeros((len(texts), 5), dtype=np.int64)
        counts[rows] = np.stack((a_counts, b_counts, found.group_counts, found.link_counts, np.ones_like(a_counts)), axis=1)
        groups = [b""] * len(texts)
        if len(rows):
            data, ends = found.text(self.numbers)
            data, at = data.tobytes(), 0
            for row, end in zip(rows.tolist(), ends.tolist()):
                groups[row] = data[at : end - 1]
                at = end
        self.counts = np.concatenate((self.counts, counts))
        self.groups += groups
        for links, doc, key in zip(self.links, (found.same_doc, found.pair_doc), (found.same_id, found.pair)):
            links.add(key, np.bincount(rows[doc], minlength=len(texts)))

    def _pieces(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """The numbers of the texts' pieces end to end, and how many each has; a piece is worked out once while it is remembered."""
        if len(self.groups) > MEMO or self.letters > MEMO_LETTERS:
            self._forget()
        cut = [self.cut(t) for t in texts]
        n_pieces, before = np.fromiter(map(len, cut), dtype=np.int64, count=len(cut)), len(self.known)
        which = np.fromiter(map(self.known.__getitem__, chain.from_iterable(cut)), dtype=np.int64, count=int(n_pieces.sum()))
        fresh = list(islice(reversed(self.known), len(self.known) - before))[::-1]
        if fresh:
            self.letters += sum(map(len, fresh))
            spaced = [" " + p for p in fresh]
            a = _flat([e.ids for e in self.first.encode_batch_fast(spaced, add_special_tokens=False)])
            b = _flat(self.second.encode(fresh, num_threads=1))
            self.ids[0].add(*a)
            self.ids[1].add(*b)
            self._judge([p.encode() for p in spaced], *a, *b)
        return which, n_pieces

    def _ids_of(self, which: np.ndarray, n_pieces: np.ndarray):
        out = []
        for ids in self.ids:
            out += [ids.join(which), _doc_sums(ids.size[which], n_pieces)]
        return out

    def encode(self, texts: list[str]):
        """Ids end to end and their number by text, of both tokenizers."""
        return self._ids_of(*self._pieces(texts))

    def _whole(self, texts: list[str], which: np.ndarray, n_pieces: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Texts with a piece that isn't faithful by itself are judged as one piece."""
        whole = (n_pieces > 1) & (_doc_sums(self.counts[which, 4] == 0, n_pieces) > 0)
        if not whole.any():
            return which, n_pieces
        apart = np.repeat(whole, n_pieces)
        number, some = len(self.groups), [texts[i] for i in np.flatnonzero(whole)]
        self._judge([b" " + t.encode() for t in some], *self._ids_of(which[apart], n_pieces[whole]))
        for ids in self.ids:
            ids.add(np.zeros(0, dtype=np.int64), np.zeros(len(some), dtype=np.int64))
        self.known.default_factory = count(len(self.groups)).__next__
        self.letters += sum(map(len, some))
        n = np.where(whole, 1, n_pieces)
        out, one = np.empty(int(n.sum()), dtype=np.int64), np.repeat(whole, n)
        out[one], out[~one] = np.arange(number, len(self.groups)), which[~apart]
        return out, n

    def figures(self, texts: list[str | None]) -> pa.RecordBatch:
        """A row of ``FIELDS`` for each text."""
        given = np.array([i for i, t in enumerate(texts) if t], dtype=np.int64)
        some = [texts[i] for i in given]
        which, n = self._whole(some, *self._pieces(some))
        counts = [_doc_sums(self.counts[which, c], n) for c in range(4)]

        digests = np.full(len(texts), "", dtype=object)
        groups = list(map(self.groups.__getitem__, which.tolist()))
        ends = np.cumsum(n)
        for row, lo, hi, found in zip(given.tolist(), (ends - n).tolist(), ends.tolist(), counts[2].tolist()):
            if found:
                digests[row] = hashlib.sha256(b";".join(groups[lo:hi])).hexdigest()

        def spread(values):
            out = np.zeros(len(texts), dtype=np.int64)
            out[given] = values
            return pa.array(out)

        columns = [spread(x) for x in counts]
        columns.append(pa.array(digests, pa.string()))
        for links, kind in zip(self.links, (pa.int32(), pa.int64())):
            doc = np.repeat(given, _doc_sums(links.size[which], n))
            edge, keys, times = _per_doc(doc, links.join(which), len(texts))
            columns += [_lists(edge, keys, kind), _lists(edge, times, pa.int32())]
        return pa.RecordBatch.from_arrays(columns, names=[f.split()[0] for f in FIELDS.split(", ")])


# ---- the corpus -----------------------------------------------------------------------


def align(documents: DataFrame, vocabulary: str, model: str, hot_pairs: int = HOT_PAIRS) -> DataFrame:
    """One row per document: doc_id, n_a, n_b, n_groups, n_links, n_best, count_sum and groups_sha256.

    ``vocabulary`` is the file of a byte-level vocabulary (A, which gets a space before the text) and ``model`` that
    of a piece model (B, which adds it). Special tokens in texts are ordinary text. A link's count is how many
    links of all documents join its two ids; n_best counts links whose count is the highest of their B id,
    count_sum adds the counts up. Texts that are null, empty, or not given back whole by both tokenizers have
    no tokens: zeros and an empty digest. Repeated rows, doc_ids and null doc_ids are rows of their own
    and count each time. An empty table gives no rows; other columns are ignored.
    """
    spark = documents.sparkSession
    with open(vocabulary, encoding="utf-8") as file:
        first = file.read()
    with open(model, "rb") as file:
        second = file.read()
    files = spark.sparkContext.broadcast((first, second))

    def tokenize(batches):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # a task has one core
        aligner = Aligner(*files.value)
        for batch in batches:
            texts = batch.column("text")
            for lo, hi in slices(texts, SLICE_BYTES):
                part = aligner.figures(texts.slice(lo, hi - lo).to_pylist())
                ids = batch.column("doc_id").slice(lo, hi - lo)
                yield pa.RecordBatch.from_arrays([ids, *part.columns], names=["doc_id", *part.schema.names])

    given = documents.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.col("text").cast("string").alias("text"))
    coded = given.mapInArrow(tokenize, f"doc_id long, {FIELDS}").withColumn("_row", F.monotonically_increasing_id())
    coded = materialize(coded, "coded")

    same = identity_map(byte_level_tokens(first), piece_tokens(second))

    def count_same(batches):
        counts = np.zeros(len(same), dtype=np.int64)
        for batch in batches:
            ids, n = batch.column("_same").flatten().to_numpy(), batch.column("_same_n").flatten().to_numpy()
            np.add.at(counts, ids, n)
        ids = np.flatnonzero(counts)
        yield pa.RecordBatch.from_arrays([pa.array((ids << SHIFT) | same[ids]), pa.array(counts[ids])], names=["pair", "n"])

    plain = coded.select("_same", "_same_n").mapInArrow(count_same, "pair long, n long").groupBy("pair").agg(F.sum("n").alias("n"))
    plain = materialize(plain, "identity-counts")  # the vocabulary bounds it
    rows = coded.select(F.explode(F.arrays_zip("_pairs", "_pairs_n")).alias("p")).select(
        F.col("p._pairs").alias("pair"), F.col("p._pairs_n").cast("bigint").alias("n")
    )
    irregular = rows.groupBy("pair").agg(F.sum("n").alias("n"))
    counts = irregular.withColumn("irregular", F.lit(1)).unionByName(plain.withColumn("irregular", F.lit(0)))
    counts = counts.groupBy("pair").agg(F.sum("n").alias("n"), F.max("irregular").alias("irregular"))
    counts = materialize(counts.withColumn("b", F.col("pair").bitwiseAND(F.lit((1 << SHIFT) - 1)).cast("int")), "pair-counts")
    highest = counts.groupBy("b").agg(F.max("n").alias("most"))  # the vocabulary bounds it
    counts = materialize(
        counts.join(F.broadcast(highest), "b").select("pair", "n", (F.col("n") == F.col("most")).alias("best"), "irregular"), "best-counts"
    )

    whole = counts.join(F.broadcast(plain.select("pair")), "pair", "left_semi").select("pair", "n", "best").toArrow()
    hot = counts.where("irregular = 1").orderBy(F.desc("n"), "pair").limit(hot_pairs).select("pair", "n", "best").toArrow()
    shared = spark.sparkContext.broadcast((whole, hot.sort_by("pair")))

    def look_up(batches):
        whole, hot = shared.value
        total, best = np.zeros(len(same), dtype=np.int64), np.zeros(len(same), dtype=bool)
        at = whole["pair"].to_numpy() >> SHIFT
        total[at], best[at] = whole["n"].to_numpy(), whole["best"].to_numpy()
        keys, hot_n, hot_best = hot["pair"].to_numpy(), hot["n"].to_numpy(), hot["best"].to_numpy()
        for batch in batches:
            out = {}
            ids, n = batch.column("_same").flatten().to_numpy(), batch.column("_same_n").flatten().to_numpy().astype(np.int64)
            sizes = pc.list_value_length(batch.column("_same")).to_numpy()
            out["_best"], out["_sum"] = _doc_sums(n * best[ids], sizes), _doc_sums(n * total[ids], sizes)
            ids, n = batch.column("_pairs").flatten().to_numpy(), batch.column("_pairs_n").flatten().to_numpy().astype(np.int64)
            sizes = pc.list_value_length(batch.column("_pairs")).to_numpy()
            place = np.minimum(np.searchsorted(keys, ids), max(len(keys) - 1, 0))
            known = keys[place] == ids if len(keys) else np.zeros(len(ids), dtype=bool)
            held = np.where(known, n, 0)
            if len(keys):
                out["_best"] += _doc_sums(held * hot_best[place], sizes)
                out["_sum"] += _doc_sums(held * hot_n[place], sizes)
            edge = np.concatenate(([0], np.cumsum(_doc_sums(~known, sizes))))
            keep = ["doc_id", "_row", "n_a", "n_b", "n_groups", "n_links", "groups_sha256"]
            yield pa.RecordBatch.from_arrays(
                [*[batch.column(c) for c in keep], pa.array(out["_best"]), pa.array(out["_sum"]),
                 _lists(edge, ids[~known], pa.int64()), _lists(edge, n[~known], pa.int32())],
                names=[*keep, "_best", "_sum", "_rest", "_rest_n"],
            )

    schema = (
        "doc_id long, _row long, n_a long, n_b long, n_groups long, n_links long, groups_sha256 string, "
        "_best long, _sum long, _rest array<long>, _rest_n array<int>"
    )
    known = materialize(coded.mapInArrow(look_up, schema), "looked-up")
    rare = (
        known.select("_row", F.explode(F.arrays_zip("_rest", "_rest_n")).alias("p"))
        .select("_row", F.col("p._rest").alias("pair"), F.col("p._rest_n").alias("links"))
        .join(counts.select("pair", "n", "best"), "pair")
        .groupBy("_row")
        .agg(F.sum(F.col("links") * F.col("n")).alias("more_sum"), F.sum(F.when(F.col("best"), F.col("links")).otherwise(0)).alias("more_best"))
    )
    zero = F.lit(0).cast("bigint")
    return known.join(rare, "_row", "left").select(
        "doc_id", "n_a", "n_b", "n_groups", "n_links",
        (F.col("_best") + F.coalesce("more_best", zero)).alias("n_best"),
        (F.col("_sum") + F.coalesce("more_sum", zero)).alias("count_sum"),
        "groups_sha256",
    )
