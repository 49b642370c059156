"""Symbol strings in Arrow batches: merges, IDs and pieces of many rows at a time, inside the tasks.

A function here is a column built on an ``arrow_udf`` over strings and lists; it sees a batch of rows and cuts it into
slices of ``SLICE`` bytes, so its memory does not grow with the batch.  A merge list is folded over the *distinct* segments
of a slice, joined to one string: a segment is what no merge spans, so a word that stands in a slice a thousand times is
folded once, and each merge is one ``str.replace``.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

from toksmith.functions.symbols import CHUNK_SEP, SURROGATE_SPAN, SURROGATE_START, sym
from toksmith.model import Model

SLICE = 1 << 22  # bytes of text that are worked on together
MAP = 1 << 22  # bits of the map of symbol pairs
CUT = chr(0x10FFF9)  # between segments; never part of a text or a merge
_STEP = 0x9E3779B1


def _slices(texts: pa.Array) -> Iterator[pa.Array]:
    """The rows in slices of about ``SLICE`` bytes, a longer row alone."""
    ends = np.cumsum(pc.fill_null(pc.binary_length(texts), 0).to_numpy(zero_copy_only=False).astype(np.int64))
    start = 0
    while start < len(texts):
        before = int(ends[start - 1]) if start else 0
        end = max(start + 1, int(np.searchsorted(ends, before + SLICE, side="right")))
        yield texts.slice(start, end - start)
        start = end


def _whole(parts: list[pa.Array], kind: pa.DataType) -> pa.Array:
    return pa.concat_arrays(parts) if parts else pa.array([], kind)


def _list(counts: np.ndarray, nulls: np.ndarray, values: pa.Array) -> pa.ListArray:
    offsets = np.concatenate(([0], np.cumsum(counts))).astype(np.int32)
    return pa.ListArray.from_arrays(pa.array(offsets, mask=np.append(nulls, False)), values)


def _nulls(a: pa.Array) -> np.ndarray:
    return a.is_null().to_numpy(zero_copy_only=False)


# -- merges -------------------------------------------------------------------------

def _places(left: np.ndarray, right: np.ndarray) -> np.ndarray:
    """Places of symbol pairs in the map; two pairs that share one only leave a longer segment."""
    return (left * np.uint32(_STEP) ^ right * np.uint32(40503)) & np.uint32(MAP - 1)


def _spanned(model: Model) -> tuple[np.ndarray, np.ndarray]:
    """The adjacent symbols that some merge may join, whatever merges were made before: the last symbols that a merge's left token
    may end in, by the first ones of its right token."""
    first: dict[int, set[int]] = {}
    last: dict[int, set[int]] = {}
    pairs: set[tuple[int, int]] = set()
    for m in model.merges:
        ends, starts = last.get(m.left_id, {m.left_id}), first.get(m.right_id, {m.right_id})
        pairs.update((x, y) for x in ends for y in starts)
        first[m.new_id] = first.get(m.new_id, set()) | first.get(m.left_id, {m.left_id}) | {m.new_id}
        last[m.new_id] = last.get(m.new_id, set()) | last.get(m.right_id, {m.right_id}) | {m.new_id}
    code = lambda ids: np.array([ord(sym(i)) for i in ids], dtype=np.uint32)
    return code(x for x, _ in pairs), code(y for _, y in pairs)


def _segments(texts: pa.Array, spanned: np.ndarray) -> tuple[np.ndarray, pa.Array]:
    """Segments of texts without separators: how many a row has, and all of them."""
    text = "".join(texts.drop_null().to_pylist())
    if not text:
        return np.zeros(len(texts), np.int64), pa.array([], pa.string())
    codes = np.frombuffer(text.encode("utf-32-le"), dtype=np.uint32)
    ends = np.cumsum(pc.fill_null(pc.utf8_length(texts), 0).to_numpy(zero_copy_only=False).astype(np.int64))
    closes = np.ones(len(codes), dtype=bool)  # a segment ends with this symbol
    closes[:-1] = ~spanned[_places(codes[:-1], codes[1:])]
    closes[ends[ends > 0] - 1] = True
    upto = np.cumsum(closes)
    marked = np.full(len(codes) + int(upto[-1]), ord(CUT), dtype=np.uint32)
    marked[np.arange(len(codes)) + upto - closes] = codes
    segments = pc.split_pattern(pa.array([marked[:-1].tobytes().decode("utf-32-le")], pa.string()), CUT).flatten()
    reached = np.where(ends > 0, upto[np.maximum(ends, 1) - 1], 0)
    return np.diff(reached, prepend=0), segments


def _replaced(segments: pa.Array, merges: list[tuple[str, str]], between: str) -> pa.Array:
    """Every segment with all merges made in rank order."""
    coded = segments.dictionary_encode()
    text = between.join(coded.dictionary.to_pylist())
    for pair, new in merges:
        text = text.replace(pair, new)
    return pa.array(text.split(between), pa.string()).take(coded.indices) if len(segments) else segments


def fold(s: Column, model: Model, joined: bool = False) -> Column:
    """All merges of a model in rank order on symbol strings.  ``joined``: the strings are chunks joined by separators, which go."""
    model.check()
    merges = [(sym(m.left_id) + sym(m.right_id), sym(m.new_id)) for m in model.merges]
    pairs = None if joined else _spanned(model)

    @F.arrow_udf(T.StringType())
    def folded(texts: pa.Array) -> pa.Array:
        spanned = np.zeros(MAP, dtype=bool)
        if pairs is not None:
            spanned[_places(*pairs)] = True
        out = []
        for rows in _slices(texts):
            nulls = _nulls(rows)
            if joined:
                cut = pc.split_pattern(rows, CHUNK_SEP)
                counts, segments = pc.fill_null(pc.list_value_length(cut), 0).to_numpy(zero_copy_only=False), cut.flatten()
            else:
                counts, segments = _segments(rows, spanned)
            made = _replaced(segments, merges, CHUNK_SEP if joined else CUT)
            out.append(pc.binary_join(_list(counts, nulls, made), ""))
        return _whole(out, pa.string())

    return folded(s)


def fold_some(s: Column, ranks: Column, model: Model) -> Column:
    """The merges at some (1-based, ascending) places of the merge list, other ones in each row (BPE-dropout)."""
    model.check()
    merges = [(sym(m.left_id) + sym(m.right_id), sym(m.new_id)) for m in model.merges]

    @F.arrow_udf(T.StringType())
    def folded(texts: pa.Array, chosen: pa.Array) -> pa.Array:
        out = []
        for text, places in zip(texts, chosen, strict=True):
            text = text.as_py()
            if text is not None:
                for k in places.as_py():
                    text = text.replace(*merges[k - 1])
            out.append(text)
        return pa.array(out, pa.string())

    return folded(s, ranks)


# -- IDs and pieces --------------------------------------------------------------------

@F.arrow_udf(T.ArrayType(T.IntegerType()))
def symbols_ids(texts: pa.Array) -> pa.Array:
    """Symbol strings -> their token IDs."""
    out = []
    for rows in _slices(texts):
        codes = np.frombuffer("".join(rows.drop_null().to_pylist()).encode("utf-32-le"), dtype=np.uint32).astype(np.int32)
        ids = np.where(codes < SURROGATE_START, codes, codes - np.int32(SURROGATE_SPAN))
        counts = pc.fill_null(pc.utf8_length(rows), 0).to_numpy(zero_copy_only=False)
        out.append(_list(counts, _nulls(rows), pa.array(ids, pa.int32())))
    return _whole(out, pa.list_(pa.int32()))


def piece_bytes(ids: Column, model: Model, unknown: bytes | None = b"", dropped: tuple[str, ...] = ()) -> Column:
    """Concatenated bytes of the IDs' pieces.  An ID without a piece gives ``unknown``; with None, its row gives NULL.
    Pieces in ``dropped`` give nothing, and the byte pieces of a model with byte fallback give their byte."""
    model.check()
    table = {i: p if isinstance(p, bytes) else p.encode("utf-8") for i, p in model.pieces().items()}
    gone = {p.encode("utf-8") for p in dropped}
    top = max(table, default=-1)
    known = [table.get(i) or unknown for i in range(top + 1)] + [unknown]
    for i in range(top + 1):
        if known[i] in gone and i in table:
            known[i] = b""
        elif model.byte_fallback and not model.byte_level and (byte := re.fullmatch(rb"<0x([0-9A-F]{2})>", table.get(i, b""))):
            known[i] = bytes.fromhex(byte[1].decode())

    @F.arrow_udf(T.BinaryType())
    def joined(rows: pa.Array) -> pa.Array:
        pieces = pa.array(known, pa.binary())
        out, step = [], 1024
        for start in range(0, len(rows), step):
            part = rows.slice(start, step)
            flat = pc.fill_null(part.flatten().cast(pa.int64()), -1).to_numpy(zero_copy_only=False)
            at = np.where((flat >= 0) & (flat <= top), flat, top + 1)
            counts = pc.fill_null(pc.list_value_length(part), 0).to_numpy(zero_copy_only=False)
            out.append(pc.binary_join(_list(counts, _nulls(part), pieces.take(pa.array(at))), b""))
        return _whole(out, pa.binary())

    return joined(ids)
