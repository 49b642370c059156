"""Benchmark decontamination by winnowing.

Of each sliding window of ``WINDOW`` k-gram hashes the minimum is kept as a
fingerprint, so any shared span of ``SPAN = GRAM + WINDOW - 1`` words holds a
fingerprint kept on both sides.  Training fingerprints are joined with those of
the benchmark; a hit is extended to every ``SPAN``-word window around it and
compared with the benchmark's windows by a second, independent 64-bit hash.
An item of fewer words is one window of its own length.

Up to ``SMALL_WINDOWS`` benchmark windows (counted first) go to the tasks as
sorted arrays and the documents are read once, without a shuffle; a larger
benchmark is joined by shuffles on fingerprints and on windows.  Both ways
return the same rows.

Defined cases: a null text has no words; a null item id is the empty string;
rows equal in id and text are treated alike, each giving one row; an empty
document or benchmark table gives an empty result or no hits; other columns are
not read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from toksmith.llm import blocks

SPAN = 10
GRAM = 6
WINDOW = SPAN - GRAM + 1
SMALL_WINDOWS = 2_000_000
_TABLE_B = blocks.mix(np.arange(1001, 1257, dtype=np.uint64))


class _Words:
    """Words of a slice, with the hashes that the windows need."""

    def __init__(self, data: np.ndarray, offsets: np.ndarray):
        self.data = data
        self.start, self.end, self.row = blocks.words(data, offsets, blocks.ALNUM)
        self.hash = blocks.word_hashes(data, self.start, self.end)
        self.per_row = np.bincount(self.row, minlength=len(offsets) - 1)
        self._second = None

    def at(self, m: int) -> np.ndarray:
        """Positions at which ``m`` words of one text begin."""
        n = len(self.row) - m + 1
        return np.flatnonzero(self.row[m - 1:] == self.row[:n]) if n > 0 else np.zeros(0, np.int64)

    def first(self, m: int, where: np.ndarray) -> np.ndarray:
        return blocks.gram_hashes(self.hash, m)[where]

    def second(self, m: int, where: np.ndarray) -> np.ndarray:
        if self._second is None:
            self._second = blocks.span_hash(blocks.prefix_hash(blocks.LOWER[self.data], _TABLE_B), self.start, self.end)
        return blocks.gram_hashes(self._second, m)[where]

    def grams(self) -> tuple[np.ndarray, np.ndarray]:
        """Hash of the k-gram at each word (the largest value where the text ends before it does), and
        the mask of the winnowed ones."""
        out = np.full(len(self.row), ~np.uint64(0))
        inside = self.at(GRAM)
        out[inside] = self.first(GRAM, inside)
        kept = np.zeros(len(out), bool)
        kept[inside] = blocks.winnow(out, WINDOW)[inside]
        return out, kept

    def around(self, hits: np.ndarray) -> np.ndarray:
        """Starts of the ``SPAN``-word windows that hold the k-gram at a hit."""
        starts = np.unique((hits[:, None] - np.arange(WINDOW)).ravel())
        return np.intersect1d(starts, self.at(SPAN), assume_unique=True)


def _windows(w: _Words) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """``(length, starts, fingerprint of each)`` of all windows of a slice of items."""
    starts = w.at(SPAN)
    if len(starts):
        gram, _ = w.grams()
        yield SPAN, starts, blocks.sliding_min(gram, WINDOW)[starts]
    begin = np.cumsum(w.per_row) - w.per_row
    for m in range(1, SPAN):
        short = begin[w.per_row == m]
        if len(short):
            yield m, short, w.first(m, short)


def benchmark_windows(items: DataFrame, item_id: str = "item_id", text: str = "text") -> DataFrame:
    """``(m, fp, a, b, item)``: length, fingerprint, both hashes and item of each benchmark window."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows, data, offsets in blocks.row_slices(batches):
            w = _Words(data, offsets)
            ids = rows.column(0)
            for m, starts, fp in _windows(w):
                cols = [pa.array(np.full(len(starts), m, np.int32)), *(pa.array(x.view(np.int64)) for x in (fp, w.first(m, starts), w.second(m, starts)))]
                yield pa.RecordBatch.from_arrays([*cols, ids.take(pa.array(w.row[starts]))], names=["m", "fp", "a", "b", "item"])

    one = items.select(F.coalesce(F.col(item_id).cast("string"), F.lit("")).alias("item"), F.col(text).alias("text"))
    return one.mapInArrow(run, "m int, fp long, a long, b long, item string").distinct()


class _Index:
    """A small benchmark: its fingerprints, and per window length the sorted hashes with their items."""

    def __init__(self, table: pa.Table):
        col = {c: table.column(c).to_numpy() for c in ("m", "fp", "a", "b")}
        self.items, item = np.unique(np.array(table.column("item").to_pylist(), object).astype(str), return_inverse=True)
        self.fp = np.unique(col["fp"][col["m"] == SPAN].view(np.uint64))
        self.by_length = {}
        for m in np.unique(col["m"]):
            own = np.flatnonzero(col["m"] == m)
            own = own[np.lexsort((col["b"][own].view(np.uint64), col["a"][own].view(np.uint64)))]
            self.by_length[int(m)] = (col["a"][own].view(np.uint64), col["b"][own].view(np.uint64), item[own])

    def match(self, w: _Words) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """``(start, length, item)`` of the windows of a slice that are the benchmark's."""
        found = [np.zeros((3, 0), np.int64)]
        for m, (a, b, item) in self.by_length.items():
            if m == SPAN:
                gram, kept = w.grams()
                hits = np.flatnonzero(kept)
                starts = w.around(hits[np.isin(gram[hits], self.fp)])
            else:
                starts = w.at(m)
            if not len(starts):
                continue
            h = w.first(m, starts)
            lo, hi = np.searchsorted(a, h, "left"), np.searchsorted(a, h, "right")
            there = np.flatnonzero(hi > lo)
            if not len(there):
                continue
            n = hi[there] - lo[there]
            which = np.repeat(there, n)
            entry = np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n) + np.repeat(lo[there], n)
            same = w.second(m, starts[which]) == b[entry]
            found.append(np.stack([starts[which[same]], np.full(same.sum(), m), item[entry[same]]]))
        return tuple(np.concatenate(found, 1))


def _covered(n: int, start: np.ndarray, length: np.ndarray) -> np.ndarray:
    edge = np.zeros(n + 1, np.int64)
    np.add.at(edge, start, 1)
    np.add.at(edge, start + length, -1)
    return np.cumsum(edge[:-1]) > 0


def _small(docs: DataFrame, index: _Index) -> DataFrame:
    shared = docs.sparkSession.sparkContext.broadcast(index)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        idx = shared.value
        for rows, data, offsets in blocks.row_slices(batches):
            w = _Words(data, offsets)
            start, length, item = idx.match(w)
            n = len(offsets) - 1
            hit = np.bincount(w.row[_covered(len(w.row), start, length)], minlength=n)
            pairs = np.unique(np.stack([w.row[start], item]), axis=1) if len(start) else np.zeros((2, 0), np.int64)
            at = np.searchsorted(pairs[0], np.arange(n + 1))
            names = pa.ListArray.from_arrays(pa.array(at.astype(np.int32)), pa.array(idx.items[pairs[1]].tolist(), pa.string()))
            yield pa.RecordBatch.from_arrays([rows.column(0), pa.array(w.per_row.astype(np.int64)), pa.array(hit.astype(np.int64)), names],
                                             names=["doc_id", "n_words", "n_hit", "items"])

    return docs.mapInArrow(run, f"doc_id {docs.schema['doc_id'].dataType.simpleString()}, n_words long, n_hit long, items array<string>")


def _large(docs: DataFrame, windows: DataFrame) -> DataFrame:
    """The same by shuffles: fingerprints, then the windows around the hits, then one row per document."""
    docs = docs.withColumn("rid", blocks.row_key("doc_id", "text"))
    lengths = [r["m"] for r in windows.select("m").distinct().collect()]  # at most SPAN values

    def prints(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows, data, offsets in blocks.row_slices(batches):
            w = _Words(data, offsets)
            for m in lengths:
                if m == SPAN:
                    gram, kept = w.grams()
                    starts, fp = np.flatnonzero(kept), gram[kept]
                else:
                    starts = w.at(m)
                    fp = w.first(m, starts)
                _, at = np.unique(np.stack([w.row[starts].astype(np.uint64), fp]), axis=1, return_index=True)
                yield pa.RecordBatch.from_arrays([rows.column(0).take(pa.array(w.row[starts[at]])), pa.array(np.full(len(at), m, np.int32)),
                                                  pa.array(fp[at].view(np.int64))], names=["rid", "m", "fp"])

    def extend(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows, data, offsets in blocks.row_slices(batches):
            w = _Words(data, offsets)
            hits = rows.column(2)
            known = {m: [np.array([h["fp"] for h in one or () if h["m"] == m], np.int64).view(np.uint64) for one in hits.to_pylist()] for m in lengths}
            base = np.cumsum(w.per_row) - w.per_row
            for m in lengths:
                gram, kept = w.grams() if m == SPAN else (None, None)
                for r in np.flatnonzero([len(x) > 0 for x in known[m]]):
                    own = slice(base[r], base[r] + w.per_row[r])
                    if m == SPAN:
                        at = base[r] + np.flatnonzero(kept[own] & np.isin(gram[own], known[m][r]))
                        starts = w.around(at)
                    else:
                        starts = np.intersect1d(w.at(m), np.arange(own.start, own.stop))
                        starts = starts[np.isin(w.first(m, starts), known[m][r])]
                    starts = starts[w.row[starts] == r]
                    n = len(starts)
                    yield pa.RecordBatch.from_arrays([rows.column(0).take(pa.array(np.full(n, r))), pa.array(starts - base[r]), pa.array(np.full(n, m, np.int32)),
                                                      *(pa.array(x.view(np.int64)) for x in (w.first(m, starts), w.second(m, starts)))],
                                                     names=["rid", "s", "m", "a", "b"])

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows, data, offsets in blocks.row_slices(batches):
            yield pa.RecordBatch.from_arrays([rows.column(0), rows.column(1), pa.array(_Words(data, offsets).per_row.astype(np.int64))], names=["rid", "doc_id", "n_words"])

    kind = docs.schema["doc_id"].dataType.simpleString()
    one = docs.dropDuplicates(["rid"]).select("rid", "text")
    hits = docs.select("rid", "text").mapInArrow(prints, "rid string, m int, fp long").distinct().join(
        windows.select("m", "fp").distinct(), ["m", "fp"], "left_semi").groupBy("rid").agg(F.collect_list(F.struct("m", "fp")).alias("hits"))
    found = one.join(hits, "rid").select("rid", "text", "hits").mapInArrow(extend, "rid string, s long, m int, a long, b long").join(
        windows.select("m", "a", "b", "item"), ["m", "a", "b"]).groupBy("rid").agg(
        F.size(F.array_distinct(F.flatten(F.transform(F.collect_set(F.struct("s", "m")), lambda x: F.sequence(x["s"], x["s"] + x["m"] - 1))))).cast("long").alias("n_hit"),
        F.collect_set("item").alias("items"))
    return docs.select("rid", "doc_id", "text").mapInArrow(count, f"rid string, doc_id {kind}, n_words long").join(found, "rid", "left").select(
        "doc_id", "n_words", F.coalesce("n_hit", F.lit(0).cast("long")).alias("n_hit"), F.coalesce("items", F.array().cast("array<string>")).alias("items"))


def contaminated(docs: DataFrame, items: DataFrame, doc_id: str = "doc_id", text: str = "text", item_id: str = "item_id", item_text: str = "text",
                 small_windows: int = SMALL_WINDOWS) -> DataFrame:
    """``(doc_id, n_words, n_hit, items)`` per document: words, words inside a shared window, items shared."""
    docs = docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text"))
    windows = benchmark_windows(items, item_id, item_text)
    some = windows.limit(small_windows + 1).toArrow()
    return _small(docs, _Index(some)) if some.num_rows <= small_windows else _large(docs, windows)


def op4_decontamination(spark, sf_dir: str) -> DataFrame:
    docs, items = (spark.read.parquet(f"{sf_dir}/{t}.parquet") for t in ("documents", "benchmark"))
    return contaminated(docs, items).select(
        "doc_id", "n_words", "n_hit", F.size("items").cast("long").alias("n_items"),
        F.sha2(F.concat_ws(",", F.array_sort("items")), 256).alias("items_sha256"), (F.col("n_hit") > 0).alias("contaminated"))
