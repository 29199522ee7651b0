"""What the operators share: reading a table, native word splits, and word hashes over byte buffers."""

from __future__ import annotations

import numpy as np
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

SPACE = " \t\n\x0b\x0c\r"  # U+0020 and U+0009 to U+000D
SPACE_RE = r"[\x20\x09-\x0D]+"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def let(value: Column, body) -> Column:
    """``body(value)`` with ``value`` computed once for each row, however often it is used."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def id_or_text_hash() -> Column:
    """doc_id, or in rows without one a hash of their text: a key that such rows can be joined by."""
    return F.coalesce(F.col("doc_id").cast("bigint"), F.xxhash64("text"))


def space_words(text: Column) -> Column:
    """The words between white space, as an array; null has none."""
    trimmed = F.btrim(F.coalesce(text, F.lit("")), F.lit(SPACE))
    none = F.array().cast("array<string>")
    return F.when(trimmed == "", none).otherwise(F.split(trimmed, SPACE_RE))


# ---- numpy kernels -------------------------------------------------------------------------

_MULTIPLIER = np.uint64(0x9E3779B97F4A7C15)


def mix(x: np.ndarray) -> np.ndarray:
    """A bijective 64-bit finaliser."""
    x = x.astype(np.uint64, copy=True)
    x ^= x >> np.uint64(30)
    x *= np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x


_BYTE_CODES = mix(np.arange(1, 257, dtype=np.uint64))
_POWERS = np.cumprod(np.full(4096, _MULTIPLIER, dtype=np.uint64))


def space_table() -> np.ndarray:
    """True for bytes that end a word: U+0020 and U+0009 to U+000D."""
    out = np.zeros(256, dtype=bool)
    out[[9, 10, 11, 12, 13, 32]] = True
    return out


def lower_table() -> np.ndarray:
    """Byte to byte with A-Z lower-cased."""
    out = np.arange(256, dtype=np.uint8)
    out[65:91] += 32
    return out


def hash_spans(data: np.ndarray, start: np.ndarray, length: np.ndarray) -> np.ndarray:
    """A 64-bit hash of each span of ``data``; spans are ordered, not empty and don't overlap."""
    if not len(start):
        return np.zeros(0, dtype=np.uint64)
    total = int(length.sum())
    first = np.cumsum(length) - length
    within = np.arange(total) - np.repeat(first, length)
    codes = _BYTE_CODES[data[np.repeat(start, length) + within]]
    codes *= _POWERS[within & 4095]
    if int(length.max()) > 4096:
        codes ^= mix((within >> 12).astype(np.uint64) + np.uint64(7))
    return mix(np.add.reduceat(codes, first) + length.astype(np.uint64))


def word_spans(data: np.ndarray, breaks: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Start and length of each maximal run of bytes that aren't breaks (``breaks``: bool by byte)."""
    gap = breaks[data]
    edge = np.flatnonzero(gap[1:] != gap[:-1]) + 1
    bounds = np.concatenate(([0], edge, [len(data)])) if len(data) else np.zeros(1, dtype=np.int64)
    start, end = bounds[:-1], bounds[1:]
    keep = ~gap[start] if len(start) else np.zeros(0, dtype=bool)
    return start[keep], (end - start)[keep]


def rolling(words: np.ndarray, n: int) -> np.ndarray:
    """Hash of each window of ``n`` words (a window begins at each but the last n - 1)."""
    count = len(words) - n + 1
    if count <= 0:
        return np.zeros(0, dtype=np.uint64)
    out = np.zeros(count, dtype=np.uint64)
    for k in range(n):
        out += words[k : k + count] * _POWERS[k]
    return mix(out + np.uint64(n))


def text_bytes(column) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of an Arrow string column, each text followed by a line feed, and the texts' starts
    with one end more; null counts as empty."""
    import pyarrow as pa
    import pyarrow.compute as pc

    column = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    large = pa.large_string()
    column = pc.fill_null(column.cast(large), "")
    column = pc.binary_join_element_wise(column, pa.scalar("", large), pa.scalar("\n", large))
    offsets = np.frombuffer(column.buffers()[1], dtype=np.int64)[column.offset : column.offset + len(column) + 1]
    if not len(column) or column.buffers()[2] is None:
        return np.zeros(0, dtype=np.uint8), np.zeros(len(column) + 1, dtype=np.int64)
    data = np.frombuffer(column.buffers()[2], dtype=np.uint8)[offsets[0] : offsets[-1]]
    return data, offsets - offsets[0]


def slices(column, limit: int):
    """Row ranges of an Arrow string column with about ``limit`` bytes each, whole texts only."""
    import pyarrow.compute as pc

    sizes = np.cumsum(pc.fill_null(pc.binary_length(column), 0).to_numpy(zero_copy_only=False).astype(np.int64) + 1)
    at = 0
    while at < len(sizes):
        base = sizes[at - 1] if at else 0
        end = max(at + 1, int(np.searchsorted(sizes, base + limit, side="right")))
        yield at, end
        at = end
