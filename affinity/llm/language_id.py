"""Language identification by rank-order profiles of character n-grams.

A profile lists the most frequent n-grams (one to three characters, words padded with a blank) of a
language in order of frequency, ties in the order of the n-grams. A text gets a profile of its own; its
distance to a language is the sum, over the text's n-grams, of how far out of place each is, and the
greatest distance where the language's profile lacks it. The nearest language wins, the alphabetically
first on a tie. The score is one less the distance as a share of the greatest possible.

Counts for the profiles are summed within each task and then by Spark over all training rows; what
reaches the driver is ``size`` n-grams for each language.

Defined cases. Letters are what Unicode calls letters; all else separates words. ``und`` with score 0
where the text is null, has no letter, or nothing was learned. Repeated rows count each time; a text
is read whole; columns beyond those named play no part. Languages and texts of any script are handled
alike. More than ``MAX_LANGUAGES`` languages are refused, as profiles are held by every task.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from affinity.llm.text import slices
from affinity.operators.ranking import best_per_group

SIZE = 300
MAX_LANGUAGES = 5_000
CHUNK = 1_000_000
UNKNOWN = "und"
BLANK = 32


@lru_cache(maxsize=1)
def _letter() -> np.ndarray:
    every = [chr(c).isalpha() for c in range(0x110000)]
    return np.array(every, dtype=bool)


class Grams:
    """The n-grams of some texts, counted by group (the text's number, or its language's).

    ``alphabet`` are the code points that occur, in order, from place 1; place 0 means no character.
    An n-gram is a number with one alphabet place for each character, so numbers are in string order.
    """

    def __init__(self, texts: list[str], groups: np.ndarray):
        joined = " ".join(["", *[t.lower() for t in texts], ""])
        points = np.frombuffer(joined.encode("utf-32-le", "replace"), dtype=np.uint32)
        lengths = np.array([len(t.lower()) + 1 for t in texts], dtype=np.int64)
        letter = _letter()[points]
        keep = letter.copy()
        keep[1:] |= letter[:-1]  # one blank behind each word
        owner = np.concatenate(([0], np.repeat(np.arange(len(texts)), lengths)))  # the blank behind a text is its own
        # the first place is the blank before the first word of all
        points, owner = np.where(letter, points, BLANK)[keep], owner[keep]
        points, owner = np.concatenate(([BLANK], points)), np.concatenate((owner[:1], owner))
        present = np.zeros(0x110000, dtype=bool)
        present[points] = True
        present[BLANK] = True
        self.alphabet = np.flatnonzero(present)
        place = np.zeros(0x110000, dtype=np.int64)
        place[self.alphabet] = np.arange(1, len(self.alphabet) + 1)
        self.place, self.bits = place, max(1, int(len(self.alphabet)).bit_length())
        self.blank = int(place[BLANK])
        c = place[points]
        b = self.bits
        if len(c) < 2 or not letter.any():
            self.group, self.gram, self.count = (np.zeros(0, dtype=np.int64) for _ in range(3))
            return
        # every trigram that ends at a character, with the character's text; blanks at a text's edge close
        # the word before, so a trigram that reaches over it has its blank in the middle and is dropped
        before = np.concatenate(([0], c[:-2]))
        tri = (before << (2 * b)) | (c[:-1] << b) | c[1:]
        group = groups[owner[1:]].astype(np.int64)
        group, tri, n = self._counted(group, tri, None)
        mask = (1 << b) - 1
        first, mid, last = tri >> (2 * b), (tri >> b) & mask, tri & mask
        whole = (mid != self.blank) & (first != 0)
        two = self._counted(group, (mid << (2 * b)) | (last << b), n)
        one = last != self.blank
        one = self._counted(group[one], last[one] << (2 * b), n[one])
        self.group = np.concatenate((group[whole], two[0], one[0]))
        self.gram = np.concatenate((tri[whole], two[1], one[1]))
        self.count = np.concatenate((n[whole], two[2], one[2]))

    def _counted(self, group, gram, n):
        """Distinct (group, gram) with their counts (or sums of ``n``), in order."""
        width = 3 * self.bits
        if int(group.max(initial=0)).bit_length() + width > 62:
            order = np.lexsort((gram, group))
            group, gram = group[order], gram[order]
            new = np.concatenate(([True], (group[1:] != group[:-1]) | (gram[1:] != gram[:-1])))
            n = n[order] if n is not None else np.ones(len(gram), dtype=np.int64)
        else:
            key = (group << width) | gram
            if n is None:
                key.sort()
                n = None
            else:
                order = np.argsort(key)
                key, n = key[order], n[order]
            new = np.concatenate(([True], key[1:] != key[:-1]))
            group, gram = key >> width, key & ((1 << width) - 1)
        at = np.flatnonzero(new)
        sums = np.diff(np.append(at, len(gram))) if n is None else np.add.reduceat(n, at)
        return group[at], gram[at], sums

    def strings(self, gram: np.ndarray) -> list[str]:
        mask, b = (1 << self.bits) - 1, self.bits
        names = ["", *map(chr, self.alphabet)]
        return [names[g >> (2 * b)] + names[(g >> b) & mask] + names[g & mask] for g in gram.tolist()]

    def numbers(self, grams: list[str]) -> np.ndarray:
        """The numbers of n-grams given as strings, -1 for those that can't occur here."""
        out = np.zeros(len(grams), dtype=np.int64)
        for i in range(3):
            at = self.place[[ord(g[i]) if len(g) > i else BLANK for g in grams]]
            absent = np.array([len(g) <= i for g in grams], dtype=bool)
            out = np.where((out < 0) | (~absent & (at == 0)), -1, (out << self.bits) | np.where(absent, 0, at))
        return out

    def ranked(self, size: int):
        """The ``size`` most frequent n-grams of each group: group, gram, rank from 0."""
        width, most = 3 * self.bits, int(self.count.max(initial=1))
        bits = most.bit_length()
        if int(self.group.max(initial=0)).bit_length() + bits + width <= 62:
            key = np.sort((((self.group << bits) | (most - self.count)) << width) | self.gram)
            group, gram = key >> (bits + width), key & ((1 << width) - 1)
        else:
            order = np.lexsort((self.gram, -self.count, self.group))
            group, gram = self.group[order], self.gram[order]
        start = np.flatnonzero(np.concatenate(([True], group[1:] != group[:-1]))) if len(group) else np.zeros(0, dtype=np.int64)
        rank = np.arange(len(group)) - np.repeat(start, np.diff(np.append(start, len(group))))
        top = rank < size
        return group[top], gram[top], rank[top]


def profiles(training: DataFrame, size: int = SIZE) -> DataFrame:
    """lang, gram, rank (from 1) from ``text`` and ``lang``; rows with a null in either don't count."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: dict[tuple[str, str], int] = {}
        for batch in batches:
            for a, b in slices(batch.column("text"), CHUNK):
                langs = batch.column("lang")[a:b].to_pylist()
                names = sorted(set(langs))
                number = {x: i for i, x in enumerate(names)}
                found = Grams(batch.column("text")[a:b].to_pylist(), np.array([number[x] for x in langs]))
                for g, s, n in zip(found.group.tolist(), found.strings(found.gram), found.count.tolist()):
                    key = names[g], s
                    sums[key] = sums.get(key, 0) + n
            if len(sums) > 500_000:  # what is summed here may be given out in parts
                yield _rows(sums)
                sums = {}
        if sums:
            yield _rows(sums)

    rows = training.where("text is not null and lang is not null").select("text", "lang")
    counts = rows.mapInArrow(count, "lang string, gram string, n bigint").groupBy("lang", "gram").agg(F.sum("n").alias("n"))
    return best_per_group(counts, ["lang"], [F.desc("n"), F.asc("gram")], size, "rank").select("lang", "gram", "rank")


def _rows(sums) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays(
        [pa.array([k[0] for k in sums], pa.string()), pa.array([k[1] for k in sums], pa.string()), pa.array(list(sums.values()), pa.int64())],
        names=["lang", "gram", "n"],
    )


def predict(docs: DataFrame, learned: DataFrame, size: int = SIZE) -> DataFrame:
    """doc_id, lang_pred and score for every row of ``docs``, from its text alone."""
    learned_rows = learned.orderBy("lang", "rank").limit(MAX_LANGUAGES * size + 1).collect()
    if len(learned_rows) > MAX_LANGUAGES * size:
        raise ValueError(f"more than {MAX_LANGUAGES} languages")
    langs = sorted({r["lang"] for r in learned_rows})
    grams = sorted({r["gram"] for r in learned_rows})
    place = {g: i for i, g in enumerate(grams)}
    number = {x: i for i, x in enumerate(langs)}
    ranks = np.full((len(langs), len(grams)), -1, dtype=np.int32)
    for r in learned_rows:
        ranks[number[r["lang"]], place[r["gram"]]] = r["rank"] - 1
    shared = docs.sparkSession.sparkContext.broadcast((langs, grams, ranks))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        langs, grams, ranks = shared.value
        for batch in batches:
            for a, b in slices(batch.column("text"), CHUNK):
                texts = [t or "" for t in batch.column("text")[a:b].to_pylist()]
                best, score = _nearest(texts, langs, grams, ranks, size)
                yield pa.RecordBatch.from_arrays(
                    [batch.column("doc_id")[a:b], pa.array(best, pa.string()), pa.array(score, pa.float64())],
                    names=["doc_id", "lang_pred", "score"],
                )

    return docs.select("doc_id", "text").mapInArrow(run, "doc_id bigint, lang_pred string, score double")


def _nearest(texts, langs, grams, ranks, size):
    found = Grams(texts, np.arange(len(texts)))
    group, gram, rank = found.ranked(size)
    best, score = np.array([UNKNOWN] * len(texts), dtype=object), np.zeros(len(texts))
    if not len(group) or not langs:
        return best, score
    numbers = found.numbers(grams)
    order = np.argsort(numbers, kind="stable")
    known = numbers[order]
    at = np.minimum(np.searchsorted(known, gram), len(known) - 1)
    hit = known[at] == gram
    column = order[at]
    start = np.flatnonzero(np.concatenate(([True], group[1:] != group[:-1])))
    owners, sizes = group[start], np.diff(np.append(start, len(group)))
    distances = np.empty((len(langs), len(start)), dtype=np.int64)
    for i in range(len(langs)):
        theirs = np.where(hit, ranks[i, column], -1)
        distances[i] = np.add.reduceat(np.where(theirs < 0, size, np.abs(theirs - rank)), start)
    nearest = distances.argmin(axis=0)
    best[owners] = np.array(langs, dtype=object)[nearest]
    score[owners] = 1 - distances[nearest, np.arange(len(start))] / (sizes * size)
    return best, score


def held_out(doc_id: Column) -> Column:
    """Whether a document is kept for testing: crc32 of its id as text is divisible by 5. A null id is."""
    return F.coalesce(F.crc32(doc_id.cast("string")) % 5 == 0, F.lit(True))


def identify(docs: DataFrame, size: int = SIZE) -> DataFrame:
    """Profiles from the rows that aren't held out, predictions for all."""
    rows = docs.select("doc_id", "text", "lang")
    learned = profiles(rows.where(~held_out(F.col("doc_id"))), size)
    out = predict(rows, learned, size)
    return out.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "lang_pred", "score")
