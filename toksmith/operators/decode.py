"""Decoding ID arrays back to text, inline (the pieces go with the tasks, no join)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from toksmith.functions import patterns
from toksmith.functions.symbols import valid_utf8
from toksmith.model import Model
from toksmith.operators.batches import piece_bytes

# Python's str.strip() removes Unicode whitespace plus the separators U+001C..U+001F.
_STRIP = r"(?U)^[\s\x{1c}-\x{1f}]+|[\s\x{1c}-\x{1f}]+\z"


def _c(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def _piece(pieces: Column, i: Column) -> Column:
    return F.when(i >= 0, F.nullif(F.try_element_at(pieces, i + 1), F.lit("")))


def unknown_ids(ids, model: Model) -> Column:
    """IDs of the array that the vocabulary does not hold."""
    pieces = model.piece_array()
    return F.filter(_c(ids), lambda i: _piece(pieces, i).isNull())


def piece_symbols(ids, model: Model) -> Column:
    """Concatenated piece bytes, one symbol a byte; unknown IDs contribute nothing."""
    return F.decode(decode_bytes_column(ids, model), "ISO-8859-1")


def decode_bytes_column(ids, model: Model) -> Column:
    """Concatenated piece bytes (BINARY); unknown IDs contribute nothing."""
    return piece_bytes(_c(ids), model)


def decode_column(ids, model: Model, on_unknown: str | None = None) -> Column:
    """Text of an ID array.

    Byte models: pieces concatenated, invalid UTF-8 → U+FFFD; unknown IDs raise
    (``on_unknown='error'``, default) or are skipped (``'skip'``).
    Char models: unknown IDs read as ``<unk>``; pieces spelled ``<s>``/``</s>``
    are dropped; ``▁`` → space; surrounding whitespace stripped.
    """
    ids = _c(ids)
    if model.kind == "char":
        return _decode_char(ids, model)
    if (on_unknown or "error") != "error":
        return valid_utf8(decode_bytes_column(ids, model))
    known = piece_bytes(ids, model, None)  # NULL where an ID is unknown
    return F.when(ids.isNotNull() & known.isNull(), F.raise_error(F.lit("invalid token id"))).otherwise(valid_utf8(known))


def _decode_char(ids: Column, model: Model) -> Column:
    # byte tokens stand as they are among the other pieces' bytes, so a run of them forms characters again
    joined = valid_utf8(piece_bytes(ids, model, b"<unk>", ("<s>", "</s>")))
    return F.regexp_replace(F.replace(joined, F.lit(patterns.SPACE_MARK), F.lit(" ")), _STRIP, "")


def decode(df: DataFrame, model: Model, ids_col: str = "ids", id_col: str = "doc_id",
           on_unknown: str | None = None) -> DataFrame:
    return df.select(F.col(id_col).alias("doc_id"), decode_column(ids_col, model, on_unknown).alias("text"))
