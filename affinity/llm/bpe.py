"""Byte-pair encoding by a tokenization automaton.

The merges are compiled, in order, into a deterministic automaton whose arcs carry tokens: a state is
the token just read, and an arc q -> t exists exactly if t may follow q in a correct encoding. It
starts with all base symbols following each other. The gadget of merge (u, v) -> w takes away the arc
u -> v, gives w the arcs that lead into u (as they are after that) and those that leave v (as they
were before). Rows and columns taken over by a gadget aren't copied but linked with the time of the
gadget, so the whole automaton is a few arrays of the size of the vocabulary; an arc is looked up by
following the links back to a removal or to two base symbols.

A word is read from left to right: at each place the last token is the longest vocabulary entry that
ends there and has an arc from the last token before its start. Exactly one fits, as correct encodings
are unique. All new words of a batch are read in step by array operations; frequent words are kept in
a bounded table. Decoding emits the labels of the arcs.

Texts are normalised and split as the vocabulary file says (NFC, lower case, words by its pattern);
the strings of its added tokens are taken out of the raw text first.

Defined cases. Null and empty texts have no tokens. Repeated rows are encoded each; an empty table
gives an empty result; a text of any length is encoded whole. Columns beyond doc_id and text stay out.
"""

from __future__ import annotations

import json
import re
import sys
import unicodedata
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from tokenizers import Regex
from tokenizers.pre_tokenizers import Split

from affinity.llm.text import slices

KEPT_WORDS = 300_000
IN_STEP = 48  # longer words are read one by one
END = "</w>"
NONE = -1
#: The contractions of the splitting pattern, and white space as it is defined there.
CONTRACTIONS = "'s|'t|'re|'ve|'m|'ll|'d"
WHITE = r"\t-\r \x85\xa0  -     　"


def byte_letters() -> list[str]:
    """The printable letter that stands for each byte: printable Latin-1 stands for itself, the other
    bytes for the letters from U+0100 on."""
    shown = [*range(33, 127), *range(161, 173), *range(174, 256)]
    other = iter(range(256, 512))
    return [chr(b) if b in shown else chr(next(other)) for b in range(256)]


class Automaton:
    """The compiled merges. Tokens have their ids; arcs are looked up for arrays of tokens at once."""

    def __init__(self, vocabulary: dict[str, int], merges: list[tuple[str, str]], suffix: str = END):
        n = max(vocabulary.values(), default=-1) + 1
        letters = byte_letters()
        self.labels = [""] * n
        for token, i in vocabulary.items():
            self.labels[i] = token
        self.plain = np.array([vocabulary[c] for c in letters], dtype=np.int64)
        self.final = np.array([vocabulary[c + suffix] for c in letters], dtype=np.int64)
        self.born = np.full(n, NONE, dtype=np.int64)  # gadget that made the token; base symbols: none
        self.left, self.right = np.full(n, NONE, dtype=np.int64), np.full(n, NONE, dtype=np.int64)
        self.length = np.zeros(n, dtype=np.int64)
        self.length[self.plain] = self.length[self.final] = 1
        removed = {}
        for time, (u, v) in enumerate(merges):
            self._gadget(time, vocabulary[u], vocabulary[v], vocabulary[u + v], removed)
        self.n = n
        keys = np.fromiter(removed.keys(), dtype=np.int64, count=len(removed))
        order = np.argsort(keys)
        self.removed, self.removed_at = keys[order], np.fromiter(removed.values(), dtype=np.int64, count=len(removed))[order]
        self._index(vocabulary, suffix, letters)

    def _gadget(self, time: int, u: int, v: int, w: int, removed: dict[int, int]) -> None:
        removed.setdefault(u * len(self.born) + v, time)
        if self.born[w] == NONE and self.length[w] == 0:
            self.born[w], self.left[w], self.right[w] = time, u, v
            self.length[w] = self.length[u] + self.length[v]

    def _index(self, vocabulary, suffix, letters) -> None:
        """Tokens by the hash of their base symbols, for reading a word."""
        number = {c: i for i, c in enumerate(letters)}
        self.longest = int(self.length.max(initial=1))
        entries = {}
        for token, i in vocabulary.items():
            if self.length[i]:
                body, last = (token[: -len(suffix)], 256) if token.endswith(suffix) and len(token) > len(suffix) else (token, 0)
                symbols = [number[c] for c in body]
                symbols[-1] += last
                entries[self.key(symbols)] = i
        self.entries, self.seen = entries, {}
        # a table with open places: an entry lies at its own place or one of the next few
        self.slots = 1 << (8 * max(1, len(entries))).bit_length()
        self.keys, self.ids = np.zeros(self.slots, dtype=np.uint64), np.full(self.slots, NONE, dtype=np.int64)
        for key, i in entries.items():
            at = self._slot(key)
            while self.ids[at] != NONE:
                at = (at + 1) & (self.slots - 1)
            self.keys[at], self.ids[at] = key, i

    def _slot(self, key: int) -> int:
        return ((key * 0x9E3779B97F4A7C15) & 0xFFFFFFFFFFFFFFFF) >> (65 - self.slots.bit_length())

    def _lookup(self, key: np.ndarray) -> np.ndarray:
        """The token with each key, else none."""
        at = ((key * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(65 - self.slots.bit_length())).astype(np.int64)
        ids, same = self.ids[at], self.keys[at] == key
        out = np.where(same, ids, NONE)
        more = np.flatnonzero(~same & (ids != NONE))
        while len(more):
            at[more] = (at[more] + 1) & (self.slots - 1)
            ids, same = self.ids[at[more]], self.keys[at[more]] == key[more]
            out[more] = np.where(same, ids, NONE)
            more = more[~same & (ids != NONE)]
        return out

    @staticmethod
    def key(symbols) -> int:
        out = 0
        for s in symbols:
            out = (out * 0x100000001B3 + int(s) + 1) & 0xFFFFFFFFFFFFFFFF
        return out

    def arcs(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """Whether token ``b`` may follow token ``a``, for each pair."""
        out = np.ones(len(a), dtype=bool)
        live = np.arange(len(a))
        a, b = a.copy(), b.copy()
        until = np.full(len(a), np.iinfo(np.int64).max)
        while len(live):
            pair = a * self.n + b
            at = np.minimum(np.searchsorted(self.removed, pair), len(self.removed) - 1) if len(self.removed) else None
            gone = (self.removed[at] == pair) & (self.removed_at[at] < until) if at is not None else np.zeros(len(a), dtype=bool)
            out[live[gone]] = False
            ta, tb = self.born[a], self.born[b]
            go = ~gone & ((ta != NONE) | (tb != NONE))
            live, a, b, ta, tb = live[go], a[go], b[go], ta[go], tb[go]
            row, both = ta > tb, ta == tb  # the younger token's row or column was taken over
            a, b, until = (
                np.where(row | both, self.right[a], a),
                np.where(row, b, self.left[b]),
                np.where(row | both, ta, tb + 1),
            )
        return out

    def arc(self, a: int, b: int) -> bool:
        """Whether token ``b`` may follow token ``a``."""
        if (a, b) not in self.seen:
            if len(self.seen) > 1_000_000:
                self.seen.clear()
            self.seen[a, b] = bool(self.arcs(np.array([a]), np.array([b]))[0])
        return self.seen[a, b]

    def read(self, words: list[bytes]) -> list[list[int]]:
        """The tokens of each word (not empty)."""
        short = [w for w in words if len(w) <= IN_STEP]
        found = iter(self._read_in_step(short))
        return [next(found) if len(w) <= IN_STEP else self._read_long(w) for w in words]

    def _read_long(self, word: bytes) -> list[int]:
        symbols = [b + 1 for b in word]
        symbols[-1] += 256
        last: list[int] = []
        for p in range(len(symbols)):
            key, power, fit = 0, 1, NONE
            for k in range(min(p + 1, self.longest)):
                key = (key + symbols[p - k] * power) & 0xFFFFFFFFFFFFFFFF
                power = (power * 0x100000001B3) & 0xFFFFFFFFFFFFFFFF
                token = self.entries.get(key, NONE)
                if token != NONE and (k == p or (last[p - k - 1] != NONE and self.arc(last[p - k - 1], token))):
                    fit = token
            last.append(fit)
        p, ids = len(symbols) - 1, []
        while p >= 0:
            ids.append(last[p])
            p -= int(self.length[last[p]])
        return ids[::-1]

    def _read_in_step(self, words: list[bytes]) -> list[list[int]]:
        if not words:
            return []
        size = np.array([len(w) for w in words])
        order = np.argsort(-size, kind="stable")
        size = size[order]
        width, count = int(size[0]), len(words)
        symbols = np.zeros((width, count), dtype=np.uint64)
        data = np.frombuffer(b"".join(words[i] for i in order), dtype=np.uint8)
        start = np.cumsum(size) - size
        for p in range(width):
            live = int(np.searchsorted(-size, -p))  # words longer than p
            symbols[p, :live] = data[start[:live] + p] + np.uint64(1)
            symbols[p, :live] += np.where(size[:live] == p + 1, np.uint64(256), np.uint64(0))
        last = np.full((width, count), NONE, dtype=np.int64)
        for p in range(width):
            live = int(np.searchsorted(-size, -p))
            # keys of all spans that end here, from the shortest; the longest that fits is wanted
            reach = min(p + 1, self.longest)
            tokens = np.full((reach, live), NONE, dtype=np.int64)
            key, power = np.zeros(live, dtype=np.uint64), 1
            for k in range(reach):
                key = key + symbols[p - k, :live] * np.uint64(power)
                power = (power * 0x100000001B3) & 0xFFFFFFFFFFFFFFFF
                tokens[k] = self._lookup(key)
            for k in range(reach - 1, -1, -1):
                open_ = np.flatnonzero((last[p, :live] == NONE) & (tokens[k] != NONE))
                if k < p:
                    before = last[p - k - 1, open_]
                    some = before != NONE
                    open_, before = open_[some], before[some]
                    fits = self.arcs(before, tokens[k, open_])
                    open_ = open_[fits]
                last[p, open_] = tokens[k, open_]
        # back from the end of each word, all words in step
        steps, at = [], size.astype(np.int64) - 1
        live = np.arange(count)
        while len(live):
            token = last[at[live], live]
            steps.append((live, token))
            at[live] -= self.length[token]
            live = live[at[live] >= 0]
        owner = np.concatenate([x for x, _ in steps[::-1]])
        order_ = np.argsort(owner, kind="stable")
        tokens = np.concatenate([t for _, t in steps[::-1]])[order_].tolist()
        ends = np.cumsum(np.bincount(owner, minlength=count)).tolist()
        out: list = [None] * count
        begin = 0
        for i, end in zip(order.tolist(), ends):
            out[i] = tokens[begin:end]
            begin = end
        return out


@lru_cache(maxsize=4)
def _class(general: str, end: int = sys.maxunicode + 1) -> str:
    """All code points of a general category, as ranges for a character class of ``re``. The Unicode
    tables are those of the library that defines the vocabulary format, not the running Python's."""
    every = "".join(map(chr, [c for c in range(end) if not 0xD800 <= c < 0xE000]))
    runs = Split(Regex(rf"\p{{{general}}}+"), "removed", invert=True).pre_tokenize_str(every)
    return "".join(f"\\U{ord(r[0]):08x}-\\U{ord(r[-1]):08x}" for r, _ in runs)


class Tokenizer:
    """Text to ids and back, from the content of a vocabulary file of word-end BPE."""

    def __init__(self, content: str):
        spec = json.loads(content)
        model = spec["model"]
        merges = [tuple(m.split(" ")) if isinstance(m, str) else tuple(m) for m in model["merges"]]
        self.automaton = Automaton(model["vocab"], merges, model["end_of_word_suffix"])
        self.added = {t["content"]: t["id"] for t in spec["added_tokens"]}
        self.labels = dict(enumerate(self.automaton.labels)) | {i: c for c, i in self.added.items()}
        # contractions start with no letter, so words may be tried first
        pattern = "[{0}]+|{2}|[{1}]|[^{3}{0}{1}]+"
        self.split = re.compile(pattern.format(_class("L"), _class("N"), CONTRACTIONS, WHITE))
        self.split_latin = re.compile(pattern.format(_class("L", 256), _class("N", 256), CONTRACTIONS, WHITE[:WHITE.index("\\xa0") + 4]))
        self.cut = re.compile("(" + "|".join(map(re.escape, sorted(self.added, key=len, reverse=True))) + ")") if self.added else None
        self.known: dict[str, list[int]] = {}

    def words(self, text: str) -> list[str]:
        """The pieces of a text; an added token's string stands for itself."""
        if not self.cut or not self.cut.search(text):
            return self._pieces(text)
        out = []
        for part in self.cut.split(text):
            out += [part] if part in self.added else self._pieces(part)
        return out

    def _pieces(self, text: str) -> list[str]:
        text = self._normal(text)
        try:
            text.encode("latin-1")
        except UnicodeEncodeError:
            return self.split.findall(text)
        return self.split_latin.findall(text)

    @staticmethod
    def _normal(text: str) -> str:
        text = unicodedata.normalize("NFC", text)
        if "Σ" in text:  # lower case is taken letter by letter: no final form
            text = text.replace("Σ", "σ")
        return text.lower()

    def encode(self, texts: list[str]) -> list[list[int]]:
        """The ids of each text."""
        split = [self.words(t) for t in texts]
        new = list({w for ws in split for w in ws}.difference(self.known))
        known = self.known
        plain = [w for w in new if w not in self.added]
        known.update(zip(plain, self.automaton.read([w.encode() for w in plain])))
        known.update({w: [self.added[w]] for w in new if w in self.added})
        out = []
        for ws in split:
            ids: list[int] = []
            for w in ws:
                ids += known[w]
            out.append(ids)
        if len(known) > KEPT_WORDS:
            known.clear()
        return out

    def decode(self, ids) -> str:
        labels = self.labels
        return " ".join([labels[i] for i in ids])


def _table(spark: SparkSession, vocabulary: str):
    """The file's content, read by Spark, so that it may lie wherever Spark can read; its size is that
    of one vocabulary (a few MB) whatever the corpus."""
    local = vocabulary if "://" in vocabulary else f"file://{vocabulary}"
    content = spark.read.text(local, wholetext=True).head()[0]
    return spark.sparkContext.broadcast(content)


_tokenizers: dict[int, Tokenizer] = {}


def _tokenizer(shared) -> Tokenizer:
    key = hash(shared.value)
    if key not in _tokenizers:
        _tokenizers.clear()
        _tokenizers[key] = Tokenizer(shared.value)
    return _tokenizers[key]


def encode(docs: DataFrame, vocabulary: str, batch_bytes: int = 2_000_000) -> DataFrame:
    """doc_id and ``ids`` (array of int) for every row."""
    return _coded(docs, vocabulary, batch_bytes, False)


def encode_decode(docs: DataFrame, vocabulary: str, batch_bytes: int = 2_000_000) -> DataFrame:
    """doc_id, ``ids`` and ``decoded``, the text that the ids give back, for every row."""
    return _coded(docs, vocabulary, batch_bytes, True)


def _coded(docs: DataFrame, vocabulary: str, batch_bytes: int, back: bool) -> DataFrame:
    shared = _table(docs.sparkSession, vocabulary)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokenizer = _tokenizer(shared)
        for batch in batches:
            for a, b in slices(batch.column("text"), batch_bytes):
                part = batch.slice(a, b - a)
                ids = tokenizer.encode([t or "" for t in part.column("text").to_pylist()])
                flat = np.fromiter((i for x in ids for i in x), dtype=np.int32, count=sum(map(len, ids)))
                ends = np.cumsum([0, *map(len, ids)], dtype=np.int32)
                columns = [part.column("doc_id"), pa.ListArray.from_arrays(pa.array(ends), pa.array(flat))]
                if back:
                    columns.append(pa.array([tokenizer.decode(x) for x in ids], pa.string()))
                yield pa.RecordBatch.from_arrays(columns, names=["doc_id", "ids", "decoded"][: len(columns)])

    schema = "doc_id bigint, ids array<int>" + (", decoded string" if back else "")
    return docs.select("doc_id", "text").mapInArrow(run, schema)


def decode(encoded: DataFrame, vocabulary: str) -> DataFrame:
    """doc_id and ``decoded`` from doc_id and ``ids``; null ids give an empty text."""
    shared = _table(encoded.sparkSession, vocabulary)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokenizer = _tokenizer(shared)
        for batch in batches:
            texts = [tokenizer.decode(x or []) for x in batch.column("ids").to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(texts, pa.string())], names=["doc_id", "decoded"])

    return encoded.select("doc_id", "ids").mapInArrow(run, "doc_id bigint, decoded string")
