"""Quality rules by repetition coverage.

Rolling hashes of several n-gram lengths (numpy, one pass per slice of whole
texts) find the n-grams and lines that a text repeats; the characters inside
them, as a share of the text's word characters, decide.

Defined cases: a null text counts as empty; a text without words has zero
counts and fails the base rule (fewer than ``MIN_WORDS`` words); every input
row gives one output row, repeated rows and null ids included; an empty table
gives an empty result; columns other than the id and the text are not read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from toksmith.llm import blocks

MIN_WORDS = 50
#: n-gram length -> largest share of word characters inside n-grams equal to an earlier one
GRAM_SHARE = {5: 0.15, 6: 0.14, 7: 0.13, 8: 0.12, 9: 0.11, 10: 0.10}
#: largest share of word characters inside lines equal to an earlier line
LINE_SHARE = 0.20
SYMBOLS = b"#*$%&|<>"

_IS_SYMBOL = np.zeros(256, bool)
_IS_SYMBOL[list(SYMBOLS)] = True
_LEAD = np.ones(256, np.int64)  # bytes that start a code point
_LEAD[128:192] = 0

COUNTS = "n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long"


def _per_row(flags: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    total = np.concatenate([[0], np.cumsum(flags, dtype=np.int64)])
    return total[offsets[1:]] - total[offsets[:-1]]


def _repeated(gram: np.ndarray, row: np.ndarray, first: bool) -> np.ndarray:
    """Mask of the entries whose value occurs twice or more within their row, the first of them
    included or not."""
    key = blocks.mix(gram ^ blocks.mix(row.astype(np.uint64)))
    _, at, where, n = np.unique(key, return_index=True, return_inverse=True, return_counts=True)
    out = n[where] > 1
    if not first:
        out[at] = False
    return out


def _covered(hashes: np.ndarray, row: np.ndarray, k: int, first: bool) -> np.ndarray:
    """Mask of the words inside a k-word window that its text holds twice or more."""
    edge = np.zeros(len(hashes) + 1, np.int64)
    if len(hashes) >= k:
        inside = np.flatnonzero(row[k - 1:] == row[:len(row) - k + 1])
        hit = inside[_repeated(blocks.gram_hashes(hashes, k)[inside], row[inside], first)]
        np.add.at(edge, hit, 1)
        np.add.at(edge, hit + k, -1)
    return np.cumsum(edge[:-1]) > 0


def _measure(data: np.ndarray, offsets: np.ndarray) -> dict[str, np.ndarray]:
    n = len(offsets) - 1
    per = lambda row, weight=None: np.bincount(row, weight, n).astype(np.int64)
    start, end, row = blocks.words(data, offsets, blocks.NOT_SPACE)
    points = np.concatenate([[0], np.cumsum(_LEAD[data])])
    width = points[end] - points[start]
    prefix = blocks.prefix_hash(data)
    hashes = blocks.span_hash(prefix, start, end)
    out = {"n_words": per(row), "word_chars": per(row, width), "n_symbols": _per_row(_IS_SYMBOL[data], offsets)}

    is_line = np.ones(256, bool)
    is_line[10] = False
    ls, le, lrow = blocks.words(data, offsets, is_line)
    spaces = np.concatenate([[0], np.cumsum(blocks.NOT_SPACE[data])])
    keep = spaces[le] > spaces[ls]
    ls, le, lrow = ls[keep], le[keep], lrow[keep]
    key = blocks.mix(blocks.span_hash(prefix, ls, le) ^ blocks.mix(lrow.astype(np.uint64)))
    first = np.zeros(len(key), bool)
    first[np.unique(key, return_index=True)[1]] = True
    out["n_dup_lines"] = per(lrow[~first])
    chars_at = np.zeros(len(data) + 1, np.int64)  # word characters before each byte
    chars_at[1:] = np.cumsum(_LEAD[data] * blocks.NOT_SPACE[data])
    out["dup_line_chars"] = per(lrow[~first], (chars_at[le] - chars_at[ls])[~first])

    out["n_repeat_words"] = per(row[_covered(hashes, row, 3, True)])
    for k in GRAM_SHARE:
        hit = _covered(hashes, row, k, False)
        out[f"dup_chars_{k}"] = per(row[hit], width[hit])
    return out


def measure(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """``(doc_id, counts…, dup_line_chars, dup_chars_<n>…)`` of every whole text."""
    schema = f"doc_id {docs.schema[doc_id].dataType.simpleString()}, {COUNTS}, dup_line_chars long, " + ", ".join(f"dup_chars_{k} long" for k in GRAM_SHARE)
    names = [c.split()[0] for c in schema.split(", ")]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows, data, offsets in blocks.row_slices(batches):
            got = _measure(data, offsets)
            yield pa.RecordBatch.from_arrays([rows.column(0), *(pa.array(got[c]) for c in names[1:])], names=names)

    return docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text")).mapInArrow(run, schema)


def quality(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """:func:`measure` with ``base_failed`` and the verdict ``kept``."""
    total = F.greatest(F.col("word_chars"), F.lit(1))
    too_much = F.col("dup_line_chars") > LINE_SHARE * total
    for k, share in GRAM_SHARE.items():
        too_much = too_much | (F.col(f"dup_chars_{k}") > share * total)
    failed = (F.col("n_words") < MIN_WORDS) | (100 * F.col("n_repeat_words") > 50 * F.col("n_words"))
    return measure(docs, doc_id, text).withColumn("base_failed", failed).withColumn("kept", ~F.col("base_failed") & ~too_much)


def op9_quality_rules(spark, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    return quality(docs).select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept")
