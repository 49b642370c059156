"""Byte-level text kernels shared by the operators: whole Arrow slices of texts as one byte array.

A *slice* is a run of rows whose texts together hold about ``SLICE_BYTES``
(one longer text is a slice of its own), so the arrays built over it are
bounded whatever the batch or table size.  All hashes are 64-bit polynomial
hashes read off prefix sums, hence one vectorised pass per slice.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

SLICE_BYTES = 1 << 21
_U = np.uint64
_BASE = _U(0x9E3779B97F4A7C15 | 1)
_INV = _U(pow(int(_BASE), -1, 1 << 64))
_pow: dict[str, np.ndarray] = {"b": np.ones(1, np.uint64), "i": np.ones(1, np.uint64)}

LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32
#: words of the Jaccard join and the quality rules: runs of bytes outside ASCII white space
NOT_SPACE = np.ones(256, bool)
NOT_SPACE[[32, 9, 10, 11, 12, 13]] = False
#: words of the decontamination (after lower-casing): ASCII letters and digits, all non-ASCII
ALNUM = np.zeros(256, bool)
ALNUM[48:58] = ALNUM[65:91] = ALNUM[97:123] = ALNUM[128:] = True


def mix(x: np.ndarray) -> np.ndarray:
    """Finalizer of a 64-bit hash: every input bit reaches every output bit."""
    x = (x ^ (x >> _U(30))) * _U(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> _U(27))) * _U(0x94D049BB133111EB)
    return x ^ (x >> _U(31))


_TABLE = mix(np.arange(1, 257, dtype=np.uint64))


def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    if len(_pow["b"]) < n:
        m = max(n, SLICE_BYTES + 1)
        for name, base in (("b", _BASE), ("i", _INV)):
            p = np.full(m, base, np.uint64)
            p[0] = 1
            _pow[name] = np.cumprod(p)
    return _pow["b"][:n], _pow["i"][:n]


def row_slices(batches: Iterator[pa.RecordBatch], text: str = "text") -> Iterator[tuple[pa.RecordBatch, np.ndarray, np.ndarray]]:
    """``(rows, bytes, offsets)``: text ``r`` of ``rows`` is ``bytes[offsets[r]:offsets[r + 1]]`` (null: empty)."""
    for batch in batches:
        col = batch.column(batch.schema.get_field_index(text)).cast(pa.large_string())
        col = col.fill_null("")
        n = len(col)
        if not n:
            continue
        _, offs, data = col.buffers()
        off = np.frombuffer(offs, np.int64)[col.offset:col.offset + n + 1]
        raw = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
        a = 0
        while a < n:
            b = max(a + 1, int(np.searchsorted(off, off[a] + SLICE_BYTES, "right")) - 1)
            b = min(b, n)
            yield batch.slice(a, b - a), raw[off[a]:off[b]], off[a:b + 1] - off[a]
            a = b


def prefix_hash(data: np.ndarray, table: np.ndarray = _TABLE) -> np.ndarray:
    """Prefix sums of which :func:`span_hash` reads the hash of any byte span."""
    out = np.zeros(len(data) + 1, np.uint64)
    np.cumsum(table[data] * _powers(len(data))[0], out=out[1:])
    return out


def span_hash(prefix: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """Hash of ``data[start:end]``, for arrays of starts and ends; equal bytes, equal hash."""
    inverse = _powers(len(prefix))[1]
    return mix((prefix[end] - prefix[start]) * inverse[start] + (end - start).astype(np.uint64))


def words(data: np.ndarray, offsets: np.ndarray, is_word: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """``(start, end, row)`` of every maximal run of word bytes inside a text."""
    mask = np.zeros(len(data) + 2, bool)
    mask[1:-1] = is_word[data]
    first = mask[1:-1] & ~mask[:-2]
    last = mask[1:-1] & ~mask[2:]
    cut = offsets[1:-1]
    cut = cut[(cut > 0) & (cut < len(data))]
    first[cut] |= mask[1:-1][cut]
    last[cut - 1] |= mask[1:-1][cut - 1]
    start, end = np.flatnonzero(first), np.flatnonzero(last) + 1
    return start, end, np.searchsorted(offsets, start, "right") - 1


def word_hashes(data: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """Hash of each lower-cased word."""
    return span_hash(prefix_hash(LOWER[data]), start, end)


def gram_hashes(word: np.ndarray, k: int) -> np.ndarray:
    """Hash of the ``k`` consecutive entries from each position on (``len - k + 1`` of them)."""
    n = len(word) - k + 1
    if n <= 0:
        return np.zeros(0, np.uint64)
    out = np.zeros(n, np.uint64)
    for j in range(k):
        out = out * _BASE + word[j:j + n]
    return mix(out + _U(k))


def sliding_min(x: np.ndarray, w: int) -> np.ndarray:
    """Minimum of each window of ``w`` entries, by doubling."""
    out, have = x, 1
    while have < w:
        step = min(have, w - have)
        out = np.minimum(out[:len(out) - step], out[step:])
        have += step
    return out


def winnow(h: np.ndarray, w: int) -> np.ndarray:
    """Mask of the positions that are the minimum of some window of ``w`` entries (all entries that
    tie for it); with fewer than ``w`` entries, the minimum of them all.  Whether a window selects a
    position depends on the window's content alone, so equal windows select alike."""
    if not len(h):
        return np.zeros(0, bool)
    if len(h) <= w:
        return h == h.min()
    low = sliding_min(h, w)
    pad = np.zeros(w - 1, h.dtype)
    top = ~sliding_min(~np.concatenate([pad, low, pad]), w)  # largest window minimum over each entry
    return h == top


def row_key(doc: Column | str, text: Column | str) -> Column:
    """A join key that exists for null ids too: rows equal in id and text are one document."""
    doc, text = (F.col(c) if isinstance(c, str) else c for c in (doc, text))
    return F.concat_ws(":", F.coalesce(doc.cast("string"), F.lit("null")), F.md5(F.coalesce(text, F.lit("\0null")).cast("binary")))


def spread(df: DataFrame) -> DataFrame:
    """The scan as it is; nothing is shuffled when it already has a split per task slot."""
    slots = df.sparkSession.sparkContext.defaultParallelism
    return df.repartition(slots) if df.rdd.getNumPartitions() < slots else df
