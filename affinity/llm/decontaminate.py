"""Benchmark decontamination by templates.

Numbers, names and units of a text are replaced by typed placeholders, so that a question with other
parameters has the same template. All windows of words of every text are hashed and joined with the
windows of the benchmark items. Matching windows on one diagonal make a run; the values behind its
placeholders are its slots, which are consistent if an item's value stands for one value throughout.

The words as written, lower-cased, are matched beside the templates, so that a copy is found whatever
its capitals, lines and sentence ends make of its names. Where a run's slots aren't consistent, its
template windows are dropped and its verbatim ones stay. A document is contaminated by an item if the
windows that stay cover ``MIN_WORDS`` of its words, or those of consistent runs ``MIN_SHARE`` of them.

A template window needs as many literal words as slots, so tables of numbers or lists of names are evidence
only where they are copied as written.

A number is a word with a digit or a number word; a unit is a unit word behind a number; a name is a
word with one capital, the first letter, that doesn't begin a sentence.

Windows are made in bulk over byte buffers. While the items have at most ``MAX_FILTER`` windows, tasks
hold their hashes and drop other windows before the join; with more, all windows take part in it.

Defined cases. Words are runs of ASCII letters and digits and of all other characters beyond ASCII.
Null or empty texts have no words. An item of fewer than ``SHORTEST`` words proves nothing and is left
out; one shorter than a window is one window as a whole. Rows that repeat a doc_id or an item_id are
taken together, in ``leaks`` also those without one; ``clean`` judges rows without a doc_id by their own
text. Empty tables give empty results. Texts are read whole; other columns play no part.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from affinity.llm.graph import join_sized
from affinity.llm.text import hash_spans, id_or_text_hash, lower_table, rolling, slices, text_bytes, word_spans
from affinity.session import materialize

WINDOW = 8
SHORTEST = 5
MIN_WORDS = 13
MIN_SHARE = 0.6
MAX_FILTER = 2_000_000
CHUNK = 1_500_000
#: Words that are numbers, and units.
NUMBER_WORDS = (
    "two three four five six seven eight nine ten eleven twelve thirteen fourteen fifteen sixteen "
    "seventeen eighteen nineteen twenty thirty forty fifty sixty seventy eighty ninety hundred "
    "thousand million billion"
).split()
UNIT_WORDS = (
    "mm cm m km kg g mg l ml s ms h min second seconds minute minutes hour hours day days week weeks "
    "month months year years inch inches foot feet yard yards mile miles ounce ounces pound pounds "
    "meter meters metre metres kilometer kilometers kilometre kilometres gram grams kilogram kilograms "
    "liter liters litre litres percent dollar dollars euro euros cent cents degree degrees"
).split()
NUMBER, UNIT, NAME = (np.uint64(x) for x in (0x6E756D, 0x756E6974, 0x6E616D65))


def _breaks() -> np.ndarray:
    out = np.ones(256, dtype=bool)
    out[48:58] = out[65:91] = out[97:123] = out[128:] = False
    return out


def _hashes(words: list[str]) -> np.ndarray:
    data = np.frombuffer(" ".join(words).encode(), dtype=np.uint8)
    return np.sort(hash_spans(data, *word_spans(data, _breaks())))


def _among(x: np.ndarray, known: np.ndarray) -> np.ndarray:
    return known[np.minimum(np.searchsorted(known, x), len(known) - 1)] == x


class Templates:
    """The words of some texts: hashes of what is written and of the template, and whose they are."""

    def __init__(self, texts):
        data, offsets = text_bytes(texts)
        start, length = word_spans(data, _breaks())
        self.written = hash_spans(lower_table()[data], start, length)
        self.owner = np.searchsorted(offsets, start, side="right") - 1
        self.first = np.searchsorted(start, offsets)
        count = len(start)
        self.at = np.arange(count) - self.first[self.owner] if count else np.zeros(0, dtype=np.int64)
        if not count:
            self.template, self.slot = self.written, np.zeros(0, dtype=bool)
            return

        def within(kind):
            sums = np.concatenate(([0], np.cumsum(kind, dtype=np.int32)))
            return sums[start + length] - sums[start], sums

        digits, _ = within((data >= 48) & (data < 58))
        capitals, _ = within((data >= 65) & (data < 91))
        _, stops = within(np.isin(data, np.frombuffer(b".!?:\n\"", dtype=np.uint8)))
        ends = np.concatenate(([0], (start + length)[:-1]))
        begins = (stops[start] - stops[ends] > 0) | (self.at == 0)
        number = (digits > 0) | ((length < 10) & _among(self.written, _hashes(NUMBER_WORDS)))
        behind = np.concatenate(([False], number[:-1])) & (self.at > 0)
        unit = behind & _among(self.written, _hashes(UNIT_WORDS))
        name = (capitals == 1) & (data[start] < 91) & (data[start] >= 65) & (length > 1) & ~begins & ~number
        self.template = np.where(number, NUMBER, np.where(unit, UNIT, np.where(name, NAME, self.written)))
        self.slot = number | unit | name

    def windows(self, size: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Places (in all words) where windows within one text begin, the windows' hashes, and whether
        they are of what is written; of the template there are those with a slot (others are the same)
        whose slots are half of their words at most: a row of numbers is like any other."""
        written, template = rolling(self.written, size), rolling(self.template, size)
        inside = self.owner[: len(written)] == self.owner[size - 1 : size - 1 + len(written)]
        at = np.flatnonzero(inside)
        slots = np.concatenate(([0], np.cumsum(self.slot)))
        typed = slots[at + size] - slots[at]
        typed = at[(typed > 0) & (2 * typed <= size)]
        return np.concatenate((at, typed)), np.concatenate((written[at], template[typed])), np.arange(len(at) + len(typed)) < len(at)

    def rows(self, at: np.ndarray, hashes: np.ndarray, verbatim: np.ndarray, size: int, ids) -> list:
        """Arrow columns: id, window, at, size and the slots (place in the window, written word), of which
        a window of what is written has none."""
        slot = self.slot[at[:, None] + np.arange(size)] & ~verbatim[:, None] if len(at) else np.zeros((0, size), dtype=bool)
        row, place = np.nonzero(slot)
        ends = np.concatenate(([0], np.cumsum(slot.sum(axis=1)))).astype(np.int32)
        slots = pa.StructArray.from_arrays(
            [pa.array(place.astype(np.int32)), pa.array(self.written[at[row] + place].view(np.int64) if len(row) else np.zeros(0, dtype=np.int64))],
            names=["place", "value"],
        )
        return [
            ids.take(pa.array(self.owner[at])), pa.array(hashes.view(np.int64)), pa.array(self.at[at].astype(np.int32)),
            pa.array(np.full(len(at), size, dtype=np.int32)), pa.ListArray.from_arrays(pa.array(ends), slots),
        ]


SLOTS = "array<struct<place: int, value: bigint>>"
NAMES = ["id", "gram", "at", "size", "slots"]
WINDOWS = f"id bigint, gram bigint, at int, size int, slots {SLOTS}"


def item_windows(items: DataFrame, window: int = WINDOW) -> DataFrame:
    """The windows of benchmark items (item_id, text), with the item's number of words."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for a, b in slices(batch.column("text"), CHUNK):
                found = Templates(batch.column("text")[a:b])
                sizes = np.diff(found.first)
                for size in sorted({min(window, int(s)) for s in sizes if s >= SHORTEST}):
                    at, hashes, verbatim = found.windows(size)
                    words = sizes[found.owner[at]]
                    right = np.minimum(words, window) == size
                    columns = found.rows(at[right], hashes[right], verbatim[right], size, batch.column("item_id")[a:b])
                    yield pa.RecordBatch.from_arrays([*columns, pa.array(words[right].astype(np.int32))], names=[*NAMES, "words"])

    return items.select("item_id", "text").mapInArrow(run, WINDOWS + ", words int")


def document_windows(docs: DataFrame, sizes: list[int], only: np.ndarray | None = None) -> DataFrame:
    """The windows of documents, or of these those whose hash is in ``only``."""
    shared = docs.sparkSession.sparkContext.broadcast(only)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        only = shared.value
        if only is not None:
            coarse = np.zeros(1 << 22, dtype=bool)
            coarse[only & np.uint64((1 << 22) - 1)] = True
        for batch in batches:
            for a, b in slices(batch.column("text"), CHUNK):
                found = Templates(batch.column("text")[a:b])
                for size in sizes:
                    at, hashes, verbatim = found.windows(size)
                    if only is not None:
                        near = np.flatnonzero(coarse[hashes & np.uint64((1 << 22) - 1)])
                        near = near[_among(hashes[near], only)]
                        at, hashes, verbatim = at[near], hashes[near], verbatim[near]
                    if len(at):
                        yield pa.RecordBatch.from_arrays(found.rows(at, hashes, verbatim, size, batch.column("doc_id")[a:b]), names=NAMES)

    return docs.select("doc_id", "text").mapInArrow(run, WINDOWS)


def leaks(docs: DataFrame, items: DataFrame, window: int = WINDOW, min_words: int = MIN_WORDS, min_share: float = MIN_SHARE) -> DataFrame:
    """Contaminated pairs: doc_id, item_id, words of the item that are covered, their share, the first
    word of the document in question, and the number of slots whose value differs from the item's."""
    theirs = materialize(item_windows(items, window), "benchmark-windows")
    sizes = [r["size"] for r in theirs.select("size").distinct().orderBy("size").collect()]
    grams = theirs.select("gram").distinct()
    only = None
    if grams.limit(MAX_FILTER + 1).count() <= MAX_FILTER:
        only = np.sort(grams.toArrow()["gram"].to_numpy().view(np.uint64))
    if only is not None and not len(only):
        only, sizes = None, []
    item = theirs.select(
        F.col("id").alias("item_id"), "gram", "size", F.col("at").alias("item_at"), F.col("slots").alias("item_slots"), "words"
    )
    ours = document_windows(docs, sizes, only).withColumnRenamed("id", "doc_id")
    matched = materialize(ours.join(item, ["gram", "size"]), "benchmark-matches")
    run = ["doc_id", "item_id", "words", (F.col("at") - F.col("item_at")).alias("diagonal")]
    pairs = F.transform(
        F.arrays_zip("item_slots", "slots"), lambda z: F.struct(z["item_slots"]["value"].alias("theirs"), z["slots"]["value"].alias("ours"))
    )
    verbatim, stretch = F.size("slots") == 0, F.sequence(F.col("item_at"), F.col("item_at") + F.col("size") - 1)
    runs = matched.groupBy(*run).agg(
        F.array_distinct(F.flatten(F.collect_set(stretch))).alias("places"),
        F.array_distinct(F.flatten(F.collect_set(F.when(verbatim, stretch)))).alias("copied"),
        F.array_distinct(F.flatten(F.collect_set(pairs))).alias("values"),
        F.min("at").alias("first_word"),
        F.min(F.when(verbatim, F.col("at"))).alias("first_copied"),
    )
    consistent = F.size("values") == F.size(F.array_distinct(F.transform("values", lambda v: v["theirs"])))
    words = lambda places: F.size(F.array_distinct(F.flatten(F.collect_list(places))))
    changed = F.size(F.filter("values", lambda v: v["theirs"] != v["ours"]))
    return (
        runs.withColumn("consistent", consistent)
        .where(F.col("consistent") | (F.size("copied") > 0))
        .groupBy("doc_id", "item_id", "words")
        .agg(
            words(F.when(F.col("consistent"), F.col("places")).otherwise(F.col("copied"))).alias("n_covered"),
            words(F.when(F.col("consistent"), F.col("places"))).alias("n_consistent"),
            F.min(F.when(F.col("consistent"), F.col("first_word")).otherwise(F.col("first_copied"))).alias("first_word"),
            F.max(changed).alias("n_changed"),
        )
        .withColumn("share", F.col("n_covered") / F.col("words"))
        .where((F.col("n_covered") >= min_words) | (F.col("n_consistent") / F.col("words") >= min_share))
        .groupBy("doc_id", "item_id")
        .agg(*[F.max(c).cast("bigint").alias(c) for c in ("n_covered", "first_word", "n_changed")], F.max("share").alias("share"))
    )


def clean(docs: DataFrame, items: DataFrame) -> DataFrame:
    """The documents that no item contaminates, with their own columns."""
    key = id_or_text_hash()
    found = leaks(docs.select(key.alias("doc_id"), "text"), items)
    found = materialize(found.select(F.col("doc_id").alias("__key")).distinct(), "benchmark-leaks")
    return join_sized(docs.withColumn("__key", key), found, "__key", "left_anti").select(*docs.columns)
