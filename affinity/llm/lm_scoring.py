"""Cross-entropy difference (Moore and Lewis, 2010): how much a text looks like a target corpus.

Two models of the same form are counted, one on target texts and one on the background: bigrams with
interpolated unigrams over one shared vocabulary. A document's score is the mean over its tokens of the
background's loss less the target's; above zero it is more like the target.

The background holds the scored documents themselves, so each of their tokens is left out of the
background's counts when it is scored; else the two losses wouldn't be comparable.

All words and pairs of all texts are in the models, however rare. The loss of a token is a part for its
word, a part for the word before it, and a part for the pair, which is zero where no model has seen the
pair but in the token itself. Words are counted first. Tasks hold the counts of the ``KNOWN`` most
frequent words; a word that is there once in all texts needs none, as its losses are the same for all
such words. Pairs of known words then go to tiles by their hash, packed as numbers with the place of their
document. A tile holds all occurrences of its pairs, so it counts and scores them at once, and sends back
a sum for each of its documents. Very frequent pairs are counted with the words and scored where their
text is. If more than ``KNOWN`` words are there twice, the tokens of all others (and their pairs) take a
plain join with tables of losses by key, so nothing is cut.

A caller may limit the vocabulary or the pairs (``size``, ``bigrams``) to the words or pairs with the
least count, or more, that at most so many have; other words are then one unknown word, and other pairs
fall back to unigrams; losses are then one table by key, joined with each document's words and pairs. No
limit is set unless it is given.

Defined cases. Tokens are what is between white space, lower-cased; words and pairs are told apart by
64-bit hashes. Null or empty texts have no token and score 0. Repeated rows count and are scored each.
Without target texts both models are smoothed alike and scores are those of the smoothing. An empty
table gives an empty result. Texts are read whole; columns beyond doc_id and text play no part.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from affinity.llm.text import hash_spans, lower_table, mix, slices, space_table, space_words, text_bytes, word_spans
from affinity.session import materialize

CHUNK = 1_500_000
MIX = 0.7  # weight of the bigram where its first word was seen
NONE, ANY = 0, 1  # in place of a word's hash: the unknown word and what stands before the first; all words
KNOWN = 4_000_000  # words whose counts a task holds
HOT = 1_000  # very frequent pairs, which are counted with the words
SAMPLED = 1_000  # texts that very frequent pairs are chosen from; any choice gives the same scores
PER_TILE = 3_000_000  # tokens
HEAD, AIM, TOKEN, SUMS, RARE = range(5)  # what a packed row holds
PACKED = "slice bigint, kind int, n int, a binary, b binary"
PAIR = 0x5851F42D4C957F2D  # tells the key of a pair whose first is ``NONE`` from its word's


def _lower(text):
    return F.translate(text, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def word_counts(texts: DataFrame) -> DataFrame:
    """word, n over all texts."""
    words = texts.select(F.explode(space_words(F.col("text"))).alias("w")).groupBy("w").agg(F.count("*").alias("n"))
    return words.groupBy(_lower(F.col("w")).alias("word")).agg(F.sum("n").alias("n"))


def most_frequent(counts: DataFrame, size: int) -> DataFrame:
    """The rows of a frozen table with the least ``n``, or more, that at most ``size`` rows have.

    A whole count goes in or stays out, so nothing has to be ranked.
    """
    have = counts.groupBy("n").agg(F.count("*").alias("rows")).orderBy(F.desc("n")).limit(size + 1).toArrow()
    within = np.cumsum(have["rows"].to_numpy()) <= size
    return counts.where(F.col("n") >= int(have["n"].to_numpy()[within].min())) if within.any() else counts.limit(0)


class Tokens:
    """The words of texts as hashes; with a vocabulary given, other words are ``NONE``."""

    def __init__(self, words: list[str] | None = None):
        self.known = None
        if words is not None:
            data = np.frombuffer("\n".join(words).encode(), dtype=np.uint8)
            self.known = np.sort(hash_spans(data, *word_spans(data, space_table())))

    def read(self, texts) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """The tokens of all texts, for each the one before it in its text, and for each text where its
        own begin (and one end more)."""
        data, offsets = text_bytes(texts)
        start, length = word_spans(data, space_table())
        tokens = hash_spans(lower_table()[data], start, length)
        first = np.searchsorted(start, offsets)
        if self.known is not None:
            at = np.minimum(np.searchsorted(self.known, tokens), max(0, len(self.known) - 1))
            tokens = np.where(self.known[at] == tokens, tokens, np.uint64(NONE)) if len(self.known) else np.zeros_like(tokens)
        before = np.concatenate((np.zeros(1, dtype=np.uint64), tokens))[: len(tokens)]
        before[first[:-1][first[:-1] < first[1:]]] = NONE
        return tokens, before, first


def _pair_keys(before: np.ndarray, tokens: np.ndarray) -> np.ndarray:
    return ((before << np.uint64(17)) | (before >> np.uint64(47))) ^ tokens ^ np.uint64(PAIR)


def _pair_key(before: Column, token: Column) -> Column:
    """``_pair_keys`` as an expression."""
    return F.shiftleft(before, 17).bitwiseOR(F.shiftrightunsigned(before, 47)).bitwiseXOR(token).bitwiseXOR(F.lit(PAIR))


def pair_counts(texts: DataFrame, words: list[str] | None = None) -> DataFrame:
    """u, v (hashes of a token and of the one before it), n; summed in part. With ``ANY`` as u, n is of
    the token v behind whatever word, with ``ANY`` as v, of u before whatever word."""
    shared = texts.sparkSession.sparkContext.broadcast(words)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        reader = Tokens(shared.value)
        for batch in batches:
            for a, b in slices(batch.column("text"), 4 * CHUNK):
                tokens, before, _ = reader.read(batch.column("text")[a:b])
                _, at, n = np.unique(_pair_keys(before, tokens), return_index=True, return_counts=True)
                v, of_v = np.unique(tokens, return_counts=True)
                u, of_u = np.unique(before, return_counts=True)
                columns = [
                    np.concatenate((before[at], np.full(len(v), ANY, dtype=np.uint64), u)).view(np.int64),
                    np.concatenate((tokens[at], v, np.full(len(u), ANY, dtype=np.uint64))).view(np.int64),
                    np.concatenate((n, of_v, of_u)).astype(np.int64),
                ]
                yield pa.RecordBatch.from_arrays([*map(pa.array, columns)], names=["u", "v", "n"])

    return texts.select("text").mapInArrow(run, "u bigint, v bigint, n bigint")


def losses(target: DataFrame, background: DataFrame, size: int | None = None, bigrams: int | None = None):
    """The vocabulary (None without a limit), the losses and those of what stands before a first word.

    The losses are a table: key, t and b (to be added for each time the word or pair is there), and
    t_first and b_first (for each time the word stands before another), for target and background.
    """
    words = None
    if size is not None:
        both = materialize(word_counts(target.select("text").union(background.select("text"))), "lm-words")
        words = most_frequent(both, size).toArrow()["word"].to_pylist()
    zero = F.lit(0).cast("bigint")
    counts = pair_counts(background, words).select("u", "v", zero.alias("t"), F.col("n").alias("b")).union(
        pair_counts(target, words).select("u", "v", F.col("n").alias("t"), zero.alias("b"))
    )
    counts = counts.groupBy("u", "v").agg(F.sum("t").alias("t"), F.sum("b").alias("b"))
    margin = (F.col("u") == ANY) | (F.col("v") == ANY)
    if bigrams is None:
        # a pair that is nowhere but in the token scored adds nothing, nor does one that no document has
        counts = counts.where(margin | ((F.col("b") > 0) & (F.col("t") + F.col("b") > 1)))
    counts = materialize(counts, "lm-counts")

    tokens = counts.where(F.col("u") == ANY)
    total = tokens.agg(F.count("*"), *[F.coalesce(F.sum(m), zero) for m in ("t", "b")]).first()
    places = 1 + (total[0] if words is None else len(words))
    own = {"t": 0, "b": 1}
    plain = {  # the probability of a word by itself
        m: (F.greatest(F.col(m) - own[m], zero) + 1) / F.lit(float(max(1, n - own[m] + places))) for m, n in (("t", total[1]), ("b", total[2]))
    }
    seen = {m: F.greatest(F.col(m) - own[m], zero) for m in own}
    of_word = tokens.select(F.col("v").alias("w"), *[plain[m].alias(f"plain_{m}") for m in own])
    of_first = counts.where(F.col("v") == ANY).select(F.col("u").alias("w"), *[seen[m].alias(f"seen_{m}") for m in own])
    by_word = materialize(of_word.join(of_first, "w", "full"), "lm-vocabulary")

    backed_off = {m: F.when(F.col(f"seen_{m}") > 0, F.lit(-np.log(1 - MIX))).otherwise(0.0) for m in own}
    of_words = by_word.where("plain_t is not null").select(
        F.col("w").alias("key"), *[(-F.log(f"plain_{m}")).alias(m) for m in own], *[backed_off[m].alias(f"{m}_first") for m in own]
    )
    pairs = counts.where(~margin)
    if bigrams is not None:
        pairs = most_frequent(pairs.withColumn("n", F.col("t") + F.col("b")), bigrams)
    gain = {
        m: F.when((F.col(f"seen_{m}") > 0) & (seen[m] > 0), -F.log1p(seen[m] * MIX / ((1 - MIX) * F.col(f"seen_{m}") * F.col(f"plain_{m}")))).otherwise(0.0)
        for m in own
    }
    of_pairs = (
        pairs.join(by_word.select(F.col("w").alias("v"), "plain_t", "plain_b"), "v")
        .join(by_word.where("seen_t is not null").select(F.col("w").alias("u"), "seen_t", "seen_b"), "u")
        .select(_pair_key(F.col("u"), F.col("v")).alias("key"), *[gain[m].alias(m) for m in own], *[F.lit(0.0).alias(f"{m}_first") for m in own])
        .where("t <> 0 or b <> 0")
    )
    table = materialize(of_words.union(of_pairs), "lm-losses")
    begin = by_word.where(F.col("w") == NONE).select(*[backed_off[m] for m in own]).first() or (0.0, 0.0)
    return words, table, begin


def _counted(owner: np.ndarray, keys: np.ndarray, inner: np.ndarray) -> tuple[np.ndarray, ...]:
    """Each key of each owner, how often it is there, and how often with ``inner`` set."""
    order = np.lexsort((keys, owner))
    owner, keys = owner[order], keys[order]
    new = np.flatnonzero(np.concatenate(([True], (owner[1:] != owner[:-1]) | (keys[1:] != keys[:-1]))))
    return owner[new], keys[new], np.diff(np.append(new, len(keys))), np.add.reduceat(inner[order].astype(np.int64), new)


def document_counts(docs: DataFrame, words: list[str] | None = None) -> DataFrame:
    """For each row of ``docs`` (numbered, ``row``) its words and pairs: key, n, and n_first, how often a
    word stands before another. One more line, with ``head`` set, has doc_id and the number of tokens
    as n; its key is the row's own and in no model."""
    shared = docs.sparkSession.sparkContext.broadcast(words)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        reader, row = Tokens(shared.value), TaskContext.get().partitionId() << 33
        for batch in batches:
            for a, b in slices(batch.column("text"), CHUNK):
                tokens, before, first = reader.read(batch.column("text")[a:b])
                count = np.diff(first)
                rows = row + np.arange(b - a)
                row += b - a
                parts = [(rows, mix(rows.astype(np.uint64) + np.uint64(2)), count, np.zeros(b - a, dtype=np.int64))]
                if len(tokens):
                    owner = np.repeat(rows, count)
                    inner = np.ones(len(tokens), dtype=bool)
                    inner[first[1:][count > 0] - 1] = False
                    parts.append(_counted(owner, tokens, inner))
                    parts.append(_counted(owner, _pair_keys(before, tokens), np.zeros(len(tokens), dtype=bool)))
                of_row, key, n, n_first = (np.concatenate(x) for x in zip(*parts))
                rest = len(of_row) - (b - a)
                doc_id = pa.concat_arrays([batch.column("doc_id")[a:b].cast(pa.int64()), pa.nulls(rest, pa.int64())])
                columns = [
                    pa.array(of_row.astype(np.int64)), doc_id, pa.array(np.arange(len(of_row)) < b - a), pa.array(key.view(np.int64)),
                    pa.array(n.astype(np.int32)), pa.array(n_first.astype(np.int32)),
                ]
                yield pa.RecordBatch.from_arrays(columns, names=["row", "doc_id", "head", "key", "n", "n_first"])

    return docs.select("doc_id", "text").mapInArrow(run, "row bigint, doc_id bigint, head boolean, key bigint, n int, n_first int")


# ---- without limits ------------------------------------------------------------------------


def _frequent_pairs(docs: DataFrame) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of pairs (of a first, of a second) that some of the texts often have."""
    some = docs.select("text").sample(min(1.0, SAMPLED / max(1, docs.count())), 42)
    counts = pair_counts(some).where((F.col("u") != ANY) & (F.col("v") != ANY)).groupBy("u", "v").agg(F.sum("n").alias("n"))
    top = counts.orderBy(F.desc("n"), "u", "v").limit(HOT).toArrow()
    return top["u"].to_numpy().view(np.uint64), top["v"].to_numpy().view(np.uint64)


def _margins(texts: DataFrame, pairs: tuple[np.ndarray, np.ndarray]) -> DataFrame:
    """Counts to be summed: w (a word's hash), n, and n_first, how often it stands before another; with
    ``pair`` set, w is a place in ``pairs``."""
    shared = texts.sparkSession.sparkContext.broadcast(pairs)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        reader, keys = Tokens(), _pair_keys(*shared.value)
        order = np.argsort(keys)
        for batch in batches:
            for a, b in slices(batch.column("text"), 2 * CHUNK):
                tokens, before, first = reader.read(batch.column("text")[a:b])
                if not len(tokens):
                    continue
                words, n = np.unique(tokens, return_counts=True)
                last = tokens[first[1:][np.diff(first) > 0] - 1]
                ends, n_ends = np.unique(last, return_counts=True)
                n_first = n.copy()
                n_first[np.searchsorted(words, ends)] -= n_ends
                found = _pair_keys(before, tokens)
                at = np.minimum(np.searchsorted(keys, found, sorter=order), max(0, len(keys) - 1))
                hit = order[at[keys[order[at]] == found]] if len(keys) else at[:0]
                pairs_n = np.bincount(hit, minlength=len(keys)).astype(np.int64)
                zeros = np.zeros(len(keys), dtype=np.int64)
                columns = [
                    np.concatenate(([NONE], words.view(np.int64), np.arange(len(keys)))), np.concatenate(([0], n, pairs_n)),
                    np.concatenate(([len(last)], n_first, zeros)), np.arange(1 + len(words) + len(keys)) > len(words),
                ]
                yield pa.RecordBatch.from_arrays([*map(pa.array, columns)], names=["w", "n", "n_first", "pair"])

    return texts.select("text").mapInArrow(run, "w bigint, n bigint, n_first bigint, pair boolean")


def _least(x: np.ndarray) -> np.ndarray:
    return x.astype(np.uint32) if not len(x) or x.max() < 1 << 32 else x


class Known:
    """What a task holds: the counts of known words by number, and of very frequent pairs."""

    def __init__(self, words: pa.Table, totals: tuple[int, int, int], whole: bool, pairs: tuple[np.ndarray, ...]):
        """``words``: w and counts; ``totals``: tokens of both models and places of the vocabulary;
        ``whole``: other words are there once; ``pairs``: hashes and counts."""
        words = words.sort_by([("n", "descending"), ("w", "ascending")])  # small numbers for frequent words
        names = words["w"].to_numpy().view(np.uint64)
        self.number = np.argsort(names).astype(np.int32)
        self.names = names[self.number]
        self.counts = {c: _least(words[c].to_numpy()) for c in ("t", "b", "t_first", "b_first")}
        self.totals, self.whole, self.pairs = totals, whole, pairs

    def find(self, names: np.ndarray) -> np.ndarray:
        """Numbers of words, -1 for those that aren't known."""
        if not len(self.names):
            return np.full(len(names), -1, dtype=np.int64)
        at = np.minimum(np.searchsorted(self.names, names), len(self.names) - 1)
        return np.where(self.names[at] == names, self.number[at], -1).astype(np.int64)

    def plain(self, m: str, count) -> np.ndarray:
        """The probability of words by themselves, less the token scored in the background."""
        own = int(m == "b")
        n = self.totals[own]
        return (np.maximum(count - float(own), 0) + 1) / max(1, n - own + self.totals[2])

    def seen(self, m: str, count) -> np.ndarray:
        return np.maximum(count - float(m == "b"), 0)

    def of_words(self, m: str, number: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """For words by number (-1: not known) their losses and what they add as the word before."""
        rest = float(-np.log(self.plain(m, np.array([1.0 if m == "b" else 0.0])))[0]) if self.whole else 0.0
        plain, first = np.full(len(number), rest), np.zeros(len(number))
        here = number >= 0
        at = number[here]
        plain[here] = -np.log(self.plain(m, self.counts[m][at]))
        first[here] = np.where(self.seen(m, self.counts[f"{m}_first"][at]) > 0, -np.log(1 - MIX), 0.0)
        return plain, first

    def gain(self, m: str, codes: np.ndarray, count: np.ndarray) -> np.ndarray:
        """What is added to the losses of pairs with these counts."""
        out = np.zeros(len(codes))
        some = np.flatnonzero(self.seen(m, count) > 0)
        first, word = np.divmod(codes[some].astype(np.int64), max(1, len(self.names)))
        seen = self.seen(m, self.counts[f"{m}_first"][first])
        share = self.seen(m, count[some]) * MIX / ((1 - MIX) * np.maximum(seen, 1) * self.plain(m, self.counts[m][word]))
        out[some] = np.where(seen > 0, -np.log1p(share), 0.0)
        return out

    def codes(self, first: np.ndarray, word: np.ndarray) -> np.ndarray:
        return (first * len(self.names) + word).astype(np.uint64)

    def frequent(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Codes in order and gains in both models of very frequent pairs."""
        u, v, t, b = self.pairs
        first, word = self.find(u), self.find(v)
        both = (first >= 0) & (word >= 0)
        codes = self.codes(first[both], word[both])
        order = np.argsort(codes)
        return codes[order], self.gain("t", codes, t[both])[order], self.gain("b", codes, b[both])[order]


def _planes(x: np.ndarray) -> bytes:
    """Whole numbers as planes of bytes, as many as the largest needs."""
    width = max(1, (int(x.max()).bit_length() + 7) // 8)
    return np.ascontiguousarray(x.astype("<u8").view(np.uint8).reshape(-1, 8)[:, :width].T).tobytes()


def _numbers(data: bytes, n: int) -> np.ndarray:
    planes = np.frombuffer(data, np.uint8).reshape(-1, n)
    out = np.zeros((n, 8), dtype=np.uint8)
    out[:, : len(planes)] = planes.T
    return out.view("<u8").ravel()


def _packed_batch(rows: list[tuple], tiles: bool) -> pa.RecordBatch:
    kinds = [pa.int64(), pa.int32(), pa.int32(), pa.binary(), pa.binary()] + [pa.int32()] * tiles
    columns = zip(*rows) if rows else [()] * len(kinds)
    names = ["slice", "kind", "n", "a", "b"] + ["tile"] * tiles
    return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)], names=names)


def _unpacked(batch: pa.RecordBatch):
    return zip(*(batch.column(c).to_pylist() for c in ("slice", "kind", "n", "a", "b")))


def _packed(texts: DataFrame, known, tiles: int, aim: bool) -> DataFrame:
    """Pairs of known words, packed by tile. Texts of documents (``aim`` not set) have a head as well, with
    doc_id, the number of tokens and what of both losses needs no pair, and, if words are left that are
    neither known nor there once, rows of those and their pairs."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, reader, row = known.value, Tokens(), TaskContext.get().partitionId() << 33
        none = held.find(np.array([NONE], dtype=np.uint64))
        hot, *hot_gain = held.frequent()
        for batch in batches:
            for a, b in slices(batch.column("text"), 2 * CHUNK):
                tokens, before, first = reader.read(batch.column("text")[a:b])
                rows, count, n = [], np.diff(first), b - a
                names, at = np.unique(tokens, return_inverse=True)
                number = held.find(names)
                word = number[at]
                ahead = np.concatenate((np.zeros(1, dtype=np.int64), word))[: len(word)]
                ahead[first[:-1][count > 0]] = none[0]
                owner = np.repeat(np.arange(n), count)
                both = (word >= 0) & (ahead >= 0)
                codes, docs = held.codes(ahead[both], word[both]), owner[both]
                if len(hot):
                    place = np.minimum(np.searchsorted(hot, codes), len(hot) - 1)
                    found = hot[place] == codes
                else:
                    place, found = np.zeros(len(codes), dtype=np.int64), np.zeros(len(codes), dtype=bool)
                if not aim:
                    sums = []
                    for m, gain in zip(("t", "b"), hot_gain):
                        plain, back = held.of_words(m, number)
                        loss = plain[at]
                        loss[1:] += back[at[:-1]]
                        begin = first[:-1][count > 0]
                        loss[begin] = plain[at[begin]] + held.of_words(m, none)[1]
                        sums.append(np.bincount(owner, loss, n))
                        sums[-1] += np.bincount(docs[found], gain[place[found]], n)
                    doc_id = batch.column("doc_id")[a:b].cast(pa.int64())
                    ids, null = doc_id.fill_null(0).to_numpy(zero_copy_only=False), doc_id.is_null().to_numpy(zero_copy_only=False)
                    head = np.stack([ids, null, count]).astype(np.int64).tobytes()
                    rows.append((row, HEAD, n, head, np.stack(sums).tobytes(), row % tiles))
                    if not held.whole:
                        inner = np.ones(len(tokens), dtype=bool)
                        inner[first[1:][count > 0] - 1] = False
                        rest = [_counted(owner[word < 0], tokens[word < 0], inner[word < 0])] if (word < 0).any() else []
                        if not both.all():
                            few = _counted(owner[~both], _pair_keys(before, tokens)[~both], np.zeros((~both).sum(), dtype=bool))
                            rest.append((*few[:3], np.full(len(few[0]), -1)))
                        if rest:
                            of, key, many, n_first = (np.concatenate(x) for x in zip(*rest))
                            rows.append((row, RARE, len(of), key.tobytes(), np.stack([of, many, n_first]).astype(np.int64).tobytes(), row % tiles))
                codes, docs = codes[~found], docs[~found]
                tile = mix(codes) % np.uint64(tiles)
                order = np.argsort((tile << np.uint64(44)) | codes)
                codes, docs, tile = codes[order], docs[order], tile[order]
                edge = np.append(np.flatnonzero(np.diff(tile, prepend=np.uint64(tiles))), len(tile))
                for lo, hi in zip(edge[:-1].tolist(), edge[1:].tolist()):
                    gaps = np.diff(codes[lo:hi], prepend=np.uint64(0))
                    rows.append((row, AIM if aim else TOKEN, hi - lo, _planes(gaps), b"" if aim else _planes(docs[lo:hi]), int(tile[lo])))
                row += n
                yield _packed_batch(rows, True)

    return texts.select(*([] if aim else ["doc_id"]), "text").mapInArrow(run, PACKED + ", tile int")


def _scored(known):
    """Of the rows of a tile: for each slice the sums that its pairs add to its documents; the others as they are."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, own, aims, heads = known.value, [], [np.zeros(0, dtype=np.uint64)], []
        for batch in batches:
            for row, kind, n, a, b in _unpacked(batch):
                if kind == TOKEN:
                    own.append((row, np.cumsum(_numbers(a, n), dtype=np.uint64), _numbers(b, n).astype(np.uint32)))
                elif kind == AIM:
                    aims.append(np.cumsum(_numbers(a, n), dtype=np.uint64))
                else:
                    heads.append((row, kind, n, a, b))
            if heads:
                yield _packed_batch(heads, False)
                heads = []
        if not own:
            return
        pairs, place, count = np.unique(np.concatenate([x[1] for x in own]), return_inverse=True, return_counts=True)
        own = [(row, docs) for row, _, docs in own]
        target, n_target = np.unique(np.concatenate(aims), return_counts=True)
        in_target = np.zeros(len(pairs), dtype=np.int64)
        if len(target):
            at = np.minimum(np.searchsorted(target, pairs), len(target) - 1)
            in_target = np.where(target[at] == pairs, n_target[at], 0)
        gain = [held.gain("t", pairs, in_target), held.gain("b", pairs, count)]
        lo = 0
        for row, docs in own:
            at, lo = place[lo : lo + len(docs)], lo + len(docs)
            sums = np.stack([np.bincount(docs, g[at]) for g in gain])
            some = np.flatnonzero(sums.any(axis=0))
            if len(some):
                yield _packed_batch([(row, SUMS, len(some), _planes(some), sums[:, some].tobytes())], False)

    return run


def _summed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Each document's sums, of rows in the order of slices with the heads first."""

    def out():
        return pa.RecordBatch.from_arrays(
            [pa.array(row + np.arange(len(count))), pa.array(ids, mask=null.astype(bool)), pa.array(count), pa.array(sums[0]), pa.array(sums[1])],
            names=["row", "doc_id", "n_tokens", "t", "b"],
        )

    row = None
    for batch in batches:
        for this, kind, n, a, b in _unpacked(batch):
            if kind == HEAD:
                if row is not None:
                    yield out()
                row, (ids, null, count), sums = this, np.frombuffer(a, np.int64).reshape(3, n), np.frombuffer(b).reshape(2, n).copy()
            elif kind == SUMS:
                sums[:, _numbers(a, n).astype(np.int64)] += np.frombuffer(b).reshape(2, n)
    if row is not None:
        yield out()


def _rare_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for row, _, n, a, b in _unpacked(batch):
            of, many, n_first = np.frombuffer(b, np.int64).reshape(3, n)
            yield pa.RecordBatch.from_arrays(
                [pa.array(row + of), pa.array(np.frombuffer(a, np.int64)), pa.array(many), pa.array(n_first)], names=["row", "key", "n", "n_first"]
            )


def _rare_sums(rows: DataFrame, by_word: DataFrame, known, target: DataFrame, docs: DataFrame) -> DataFrame:
    """row, t and b: what words that aren't known and their pairs add."""
    totals = known.value.totals

    def touching(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            u, v = (batch.column(c).to_numpy().view(np.uint64) for c in ("u", "v"))
            here = (u != ANY) & (v != ANY) & ((known.value.find(u) < 0) | (known.value.find(v) < 0))
            yield batch.filter(pa.array(here))

    zero = F.lit(0).cast("bigint")
    kind = "u bigint, v bigint, n bigint"
    counts = pair_counts(docs).mapInArrow(touching, kind).select("u", "v", zero.alias("t"), F.col("n").alias("b")).union(
        pair_counts(target).mapInArrow(touching, kind).select("u", "v", F.col("n").alias("t"), zero.alias("b"))
    )
    counts = counts.groupBy("u", "v").agg(F.sum("t").alias("t"), F.sum("b").alias("b")).where("b > 0 and t + b > 1")
    own = {"t": 0, "b": 1}
    less = {m: lambda c, m=m: F.greatest(F.col(c) - own[m], zero) for m in own}
    plain = {m: (less[m](m) + 1) / F.lit(float(max(1, n - own[m] + totals[2]))) for m, n in zip(own, totals)}
    of_word = by_word.where(F.col("w") != NONE).select(F.col("w").alias("v"), *[plain[m].alias(f"plain_{m}") for m in own])
    of_first = by_word.select(F.col("w").alias("u"), *[less[m](f"{m}_first").alias(f"seen_{m}") for m in own])
    share = {m: less[m](m) * MIX / ((1 - MIX) * F.col(f"seen_{m}") * F.col(f"plain_{m}")) for m in own}
    gain = {m: F.when((F.col(f"seen_{m}") > 0) & (less[m](m) > 0), -F.log1p(share[m])).otherwise(0.0) for m in own}
    of_pairs = counts.join(of_word, "v").join(of_first, "u").select(
        _pair_key(F.col("u"), F.col("v")).alias("key"), *[gain[m].alias(m) for m in own], *[F.lit(0.0).alias(f"{m}_first") for m in own]
    )
    back = {m: F.when(less[m](f"{m}_first") > 0, F.lit(-np.log(1 - MIX))).otherwise(0.0) for m in own}
    of_words = by_word.select(F.col("w").alias("key"), *[(-F.log(plain[m])).alias(m) for m in own], *[back[m].alias(f"{m}_first") for m in own])
    part = {m: F.col("n") * F.col(m) + F.greatest("n_first", zero) * F.col(f"{m}_first") for m in own}
    return rows.join(of_words.union(of_pairs), "key").groupBy("row").agg(*[F.sum(part[m]).alias(f"more_{m}") for m in own])


def _whole(docs: DataFrame, target: DataFrame, size: int) -> DataFrame:
    """doc_id, n_tokens, t and b (sums of losses) of models without limits; tasks hold ``size`` words."""
    spark = docs.sparkSession
    zero = F.lit(0).cast("bigint")
    pairs = _frequent_pairs(docs)
    counts = _margins(docs, pairs).select("w", "pair", zero.alias("t"), F.col("n").alias("b"), zero.alias("t_first"), F.col("n_first").alias("b_first")).union(
        _margins(target, pairs).select("w", "pair", F.col("n").alias("t"), zero.alias("b"), F.col("n_first").alias("t_first"), zero.alias("b_first"))
    )
    four = ("t", "b", "t_first", "b_first")
    counts = materialize(counts.groupBy("w", "pair").agg(*[F.sum(c).alias(c) for c in four]), "lm-words")
    by_word = counts.where("not pair").drop("pair")
    # what stands before a first word is always known
    n = F.when(F.col("w") == NONE, F.lit(1 << 62)).otherwise(F.col("t") + F.col("b"))
    often = by_word.withColumn("n", n).where("n > 1")
    words = most_frequent(often, size).toArrow()
    found = by_word.where(F.col("w") != NONE).agg(F.count("*"), *[F.coalesce(F.sum(m), zero) for m in ("t", "b")]).first()
    of_pairs = counts.where("pair").orderBy("w").toArrow()
    frequent = tuple(x[of_pairs["w"].to_numpy()] for x in pairs)
    frequent += tuple(of_pairs[m].to_numpy() for m in ("t", "b"))
    whole = often.count() == len(words)
    known = spark.sparkContext.broadcast(Known(words, (found[1], found[2], 1 + found[0]), whole, frequent))

    tiles = max(2 * spark.sparkContext.defaultParallelism, math.ceil((found[1] + found[2]) / PER_TILE))
    rows = _packed(docs, known, tiles, False).unionByName(_packed(target, known, tiles, True))
    out = rows.repartitionById(tiles, F.col("tile")).drop("tile").mapInArrow(_scored(known), PACKED)
    if not whole:
        out = materialize(out, "lm-sums")
    by_slice = out.where(F.col("kind") != RARE).repartition("slice").sortWithinPartitions("slice", "kind")
    summed = by_slice.mapInArrow(_summed, "row bigint, doc_id bigint, n_tokens bigint, t double, b double")
    if whole:
        return summed
    rare = out.where(F.col("kind") == RARE).mapInArrow(_rare_rows, "row bigint, key bigint, n bigint, n_first bigint")
    more = summed.join(_rare_sums(rare, by_word, known, target, docs), "row", "left")
    return more.select("doc_id", "n_tokens", *[(F.col(m) + F.coalesce(f"more_{m}", F.lit(0.0))).alias(m) for m in ("t", "b")])


def cross_entropy_difference(docs: DataFrame, target: DataFrame, size: int | None = None, bigrams: int | None = None) -> DataFrame:
    """doc_id, n_tokens, target_loss, background_loss (means per token) and score, their difference, with
    models from ``target`` (text) and all of ``docs``."""
    if size is None and bigrams is None:
        return _means(_whole(docs, target, KNOWN), (0.0, 0.0))
    words, table, begin = losses(target, docs, size, bigrams)
    part = {m: F.when(~F.col("head"), F.col("n") * F.col(m) + F.col("n_first") * F.col(f"{m}_first")) for m in ("t", "b")}
    summed = (
        document_counts(docs, words).join(table, "key", "left")
        .where(F.col("head") | F.col("t").isNotNull())
        .groupBy("row")
        .agg(
            F.max("doc_id").alias("doc_id"), F.max(F.when(F.col("head"), F.col("n"))).cast("bigint").alias("n_tokens"),
            *[F.coalesce(F.sum(part[m]), F.lit(0.0)).alias(m) for m in part],
        )
    )
    return _means(summed, begin)


def _means(summed: DataFrame, begin: tuple[float, float]) -> DataFrame:
    mean = {m: F.when(F.col("n_tokens") > 0, (F.col(m) + F.lit(float(x))) / F.col("n_tokens")).otherwise(0.0) for m, x in zip(("t", "b"), begin)}
    return summed.select("doc_id", "n_tokens", mean["t"].alias("target_loss"), mean["b"].alias("background_loss")).withColumn(
        "score", F.col("background_loss") - F.col("target_loss")
    )
