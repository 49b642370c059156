"""Token sequences as symbol strings.

A sequence of token IDs is held as a string with one code point per ID, so
that merging a pair is the native ``replace`` (left to right, no overlap) and
counting pairs is a split of the string.  IDs below U+D800 are their own code
point; larger IDs skip the surrogate block.  A byte string becomes symbols by
reading its UTF-8 bytes as ISO-8859-1 (one char per byte, code point = byte).
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

SURROGATE_START = 0xD800
SURROGATE_SPAN = 0x800
# The top 16 code points are reserved as separators and placeholders.
RESERVED_START = 0x10FFF0
MAX_ID = RESERVED_START - 1 - SURROGATE_SPAN
LIST_SEP = chr(0x10FFFD)  # separates the items of a constant list literal
CHUNK_SEP = chr(0x10FFFC)  # separates chunks inside one row's symbol string
OOV_MARK = chr(0x10FFFB)  # placeholder for characters outside a char alphabet


def const_list(items: list[str]):
    """A constant ``array<string>`` built as ``split(literal, sep)`` (folded once by Catalyst)."""
    from pyspark.sql import functions as F

    if not items:
        return F.array().cast("array<string>")
    return F.split(F.lit(LIST_SEP.join(items)), LIST_SEP)


def id_to_cp(i: int) -> int:
    if i < 0 or i > MAX_ID:
        raise ValueError(f"token id {i} outside the symbol range")
    return i if i < SURROGATE_START else i + SURROGATE_SPAN


def cp_to_id(cp: int) -> int:
    return cp if cp < SURROGATE_START else cp - SURROGATE_SPAN


def sym(i: int) -> str:
    """Python-side symbol of one ID (used for literals built from small model tables)."""
    return chr(id_to_cp(i))


def syms(ids) -> str:
    return "".join(sym(i) for i in ids)


def _col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def cp_char(cp) -> Column:
    """Code point → one-character string (UTF-32 decode of the 4-byte value)."""
    return F.decode(F.unhex(F.lpad(F.hex(_col(cp)), 8, "0")), "UTF-32")


def id_char(i) -> Column:
    i = _col(i)
    return cp_char(F.when(i < SURROGATE_START, i).otherwise(i + SURROGATE_SPAN))


def char_id(c) -> Column:
    cp = F.ascii(_col(c))
    return F.when(cp < SURROGATE_START, cp).otherwise(cp - SURROGATE_SPAN)


def byte_symbols(text) -> Column:
    """UTF-8 bytes of a text, one symbol per byte."""
    return F.decode(F.encode(_col(text), "UTF-8"), "ISO-8859-1")


def symbols_bytes(s) -> Column:
    """Byte-level symbol string → BINARY."""
    return F.encode(_col(s), "ISO-8859-1")


def valid_utf8(binary) -> Column:
    """BINARY → STRING, invalid sequences replaced by U+FFFD (Python ``errors='replace'``)."""
    return F.make_valid_utf8(_col(binary).cast("string"))


def chars(s) -> Column:
    """String → array of code points as one-char strings; empty string → []."""
    s = _col(s)
    return F.when(F.length(s) == 0, F.array().cast("array<string>")).otherwise(F.split(s, ""))


def symbols_ids(s) -> Column:
    return F.transform(chars(s), char_id)


def ids_symbols(ids) -> Column:
    return F.array_join(F.transform(_col(ids), id_char), "")


# One regex pass: at each code point, capture it and the next one (look-ahead) and
# consume one code point, so overlapping pairs come out in order, never
# starting inside a surrogate pair.
_PAIR_RE = "(?s)(?=(..))."


def adjacent_pairs(s) -> Column:
    """Array of the two-symbol strings at offsets 0..n-2 (overlapping)."""
    return F.regexp_extract_all(_col(s), F.lit(_PAIR_RE), 1)


def pair_left(p) -> Column:
    return char_id(F.substring(_col(p), 1, 1))


def pair_right(p) -> Column:
    return char_id(F.substring(_col(p), 2, 1))
