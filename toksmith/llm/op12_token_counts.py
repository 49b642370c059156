"""Token counts by a map-side two-tier lookup of pre-token lengths.

A text (with the model's dummy space in front) falls into *pre-tokens*: a run of spaces with what
follows it up to the next space or line feed, and each line feed by itself.  No piece of the
vocabulary spans such a cut (:func:`load` checks it), so merges never do and the counts of a
text's pre-tokens add up to its count.

* Tier 1: the lengths of the ``TABLE`` most frequent pre-tokens as two sorted arrays (64-bit
  hash, length), broadcast.  They are found in a scan over all rows in which every task keeps a bounded
  summary (it forgets the rarest when full); only those summaries, at most ``SUMMARY`` rows a
  task, are shuffled and added up, never pre-tokens.  The table decides speed, not results.
* Tier 2: pre-tokens outside the table are looked up in a cache that a Python worker keeps over
  its tasks (two generations of ``CACHE`` entries); what that lacks is encoded by the library.

Pre-tokens are told apart by a 64-bit hash: among ``d`` distinct ones, about ``d * TABLE / 2**64``
take a wrong length from the table (3.6e-5 for 1e10 of them) and ``CACHE * d / 2**64`` from a cache.

Defined cases: a null text counts as empty (0 bytes, 0 tokens); every input row gives one output
row, repeated rows and null ids included; a text of any length is worked in parts cut between
pre-tokens (one pre-token is never cut); an empty table gives an empty result; other columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from toksmith.llm import blocks

LIMIT = 4096
TABLE = 1 << 16  # pre-tokens in the broadcast table
SUMMARY = 1 << 14  # pre-tokens a task reports; it keeps twice as many
CACHE = 1 << 20  # entries of a generation of a worker's cache
SHORT = 64  # bytes; longer pre-tokens are no candidates for the table
_SPACE, _LINE = 32, 10
_MARK = "▁"


def model_path(name: str = "piece_bpe_32k.model") -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def load(path: str):
    """The library's encoder, after a check that the cuts are right for this model."""
    import sentencepiece

    sp = sentencepiece.SentencePieceProcessor(model_file=path)
    pieces = [sp.id_to_piece(i) for i in range(sp.get_piece_size()) if not (sp.is_control(i) or sp.is_unknown(i) or sp.is_byte(i))]
    if any("\n" in p or " " in p or _MARK in p.lstrip(_MARK) for p in pieces):
        raise ValueError("a piece of the model spans two pre-tokens")
    probe = "".join(sp.id_to_piece(i) for i in sp.encode("  a  b"))
    if probe != f"{_MARK * 3}a{_MARK * 2}b" or sp.encode("ﬁ", out_type=str)[-1] == "i":
        raise ValueError("the model normalises its text or has no dummy space")
    return sp


class _Worker:
    """The encoder and the cache of one Python worker."""

    here: dict[str, _Worker] = {}

    def __init__(self, path: str):
        self.sp, self.new, self.old = load(path), {}, {}
        self.base = len(self.sp.encode("\n"))

    @classmethod
    def of(cls, path: str) -> _Worker:
        if path not in cls.here:
            cls.here[path] = cls(path)
        return cls.here[path]

    def lengths(self, texts: list[str]) -> list[int]:
        # the line feed in front takes the dummy space and shares no piece with the pre-token
        return [len(ids) - self.base for ids in self.sp.encode(["\n" + t for t in texts], num_threads=1)]

    def look_up(self, keys: np.ndarray, data: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        names = keys.tolist()
        found = [self.new.get(k) for k in names]
        lost = []
        for i, n in enumerate(found):
            if n is None:
                n = self.old.get(names[i])
                if n is None:
                    lost.append(i)
                    continue
                found[i] = self.new[names[i]] = n
        if lost:
            sizes = self.lengths([data[start[i]:end[i]].tobytes().decode() for i in lost])
            for i, n in zip(lost, sizes, strict=True):
                found[i] = self.new[names[i]] = n
        if len(self.new) > CACHE:
            self.new, self.old = {}, self.new
        return np.array(found, np.int64)


def _pad(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The texts with a space in front of each that is not empty."""
    full = offsets[1:] > offsets[:-1]
    return np.insert(data, offsets[:-1][full], _SPACE), offsets + np.concatenate([[0], np.cumsum(full)])


def _starts(data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """Positions at which pre-tokens start."""
    space = data == _SPACE
    mark = np.flatnonzero((data[:-2] == 0xE2) & (data[1:-1] == 0x96) & (data[2:] == 0x81))  # U+2581 is a space to the model
    for k in range(3):
        space[mark + k] = True
    line = data == _LINE
    start = line.copy()
    start[1:] |= line[:-1]
    start[1:] |= space[1:] & ~space[:-1]
    start[offsets[:-1][offsets[:-1] < len(data)]] = True
    return np.flatnonzero(start)


def _pre_tokens(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[pa.RecordBatch | None, np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]]:
    """``(rows, bytes a row, data, start, end, row)`` by parts of bounded size; rows are given with their last part."""
    for rows, raw, raw_off in blocks.row_slices(batches):
        data, offsets = _pad(raw, raw_off)
        start = _starts(data, offsets)
        end = np.append(start[1:], len(data))
        row = np.searchsorted(offsets, start, "right") - 1
        a = 0
        while True:
            b = len(start) if len(data) <= 2 * blocks.SLICE_BYTES else max(a + 1, int(np.searchsorted(end, start[a] + blocks.SLICE_BYTES, "right")))
            part = data[start[a]:end[b - 1]] if b else data
            base = start[a] if b else 0
            yield rows if b == len(start) else None, np.diff(raw_off), part, start[a:b] - base, end[a:b] - base, row[a:b]
            a = b
            if a == len(start):
                break


def _hashes(data: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    return blocks.span_hash(blocks.prefix_hash(data), start, end)


def frequent(docs: DataFrame, path: str, size: int = TABLE, text: str = "text") -> tuple[np.ndarray, np.ndarray]:
    """Hashes (sorted) and lengths of the most frequent pre-tokens of all texts; at most ``size`` of them."""
    def summarise(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        keys, counts, names = np.zeros(0, np.uint64), np.zeros(0, np.int64), np.zeros(0, object)
        for _, _, data, start, end, _ in _pre_tokens(batches):
            short = end - start <= SHORT
            start, end = start[short], end[short]
            key, at, n = np.unique(_hashes(data, start, end), return_index=True, return_counts=True)
            where = np.searchsorted(keys, key)
            known = where < len(keys)
            known[known] = keys[where[known]] == key[known]
            counts[where[known]] += n[known]
            fresh = np.flatnonzero(~known)
            fresh = fresh[np.argsort(-n[fresh], kind="stable")[:2 * SUMMARY]]
            text_of = np.array([data[start[at[i]]:end[at[i]]].tobytes() for i in fresh], object)
            keys, counts, names = np.concatenate([keys, key[fresh]]), np.concatenate([counts, n[fresh]]), np.concatenate([names, text_of])
            if len(keys) > 2 * SUMMARY:
                top = np.argsort(-counts, kind="stable")[:2 * SUMMARY]
                keys, counts, names = keys[top], counts[top], names[top]
            order = np.argsort(keys)
            keys, counts, names = keys[order], counts[order], names[order]
        top = np.argsort(-counts, kind="stable")[:SUMMARY]
        yield pa.RecordBatch.from_arrays([pa.array(names[top].tolist(), pa.binary()), pa.array(counts[top], pa.int64())], names=["token", "n"])

    def measure(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        worker = _Worker.of(path)
        for batch in batches:
            tokens = batch.column(0).to_pylist()
            if tokens:
                data = np.frombuffer(b"".join(tokens), np.uint8)
                cut = np.concatenate([[0], np.cumsum([len(t) for t in tokens])])
                key = _hashes(data, cut[:-1], cut[1:])
                yield pa.RecordBatch.from_arrays([pa.array(key.view(np.int64)), pa.array(worker.lengths([t.decode() for t in tokens]), pa.int64())], names=["key", "length"])

    reported = docs.select(F.col(text).alias("text")).mapInArrow(summarise, "token binary, n long")
    top = reported.groupBy("token").agg(F.sum("n").alias("n")).orderBy(F.col("n").desc(), "token").limit(size)
    rows = top.select("token").mapInArrow(measure, "key long, length long").collect()  # at most ``size`` pairs of numbers
    keys = np.array([r["key"] for r in rows], np.int64).view(np.uint64)
    order = np.argsort(keys)
    return keys[order], np.array([r["length"] for r in rows], np.int64)[order]


def count_tokens(docs: DataFrame, path: str | None = None, limit: int = LIMIT, doc_id: str = "doc_id", text: str = "text", table: int = TABLE) -> DataFrame:
    """``(doc_id, n_bytes, n_tokens, over_limit)`` of every whole text, without begin, end or other added tokens."""
    path = path or model_path()
    load(path)  # a model with other cuts fails here, not in a task
    source = blocks.spread(docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text")))
    known = docs.sparkSession.sparkContext.broadcast(frequent(source, path, table))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        worker, (keys, lengths) = _Worker.of(path), known.value
        total = None
        for rows, n_bytes, data, start, end, row in _pre_tokens(batches):
            total = np.zeros(len(n_bytes), np.int64) if total is None else total
            if len(start):
                key, at, where = np.unique(_hashes(data, start, end), return_index=True, return_inverse=True)
                place = np.minimum(np.searchsorted(keys, key), max(0, len(keys) - 1))
                hit = keys[place] == key if len(keys) else np.zeros(len(key), bool)
                size = np.zeros(len(key), np.int64)
                size[hit] = lengths[place[hit]] if len(keys) else 0
                miss = np.flatnonzero(~hit)
                size[miss] = worker.look_up(key[miss], data, start[at[miss]], end[at[miss]])
                total += np.bincount(row, size[where], len(total)).astype(np.int64)
            if rows is not None:
                yield pa.RecordBatch.from_arrays([rows.column(0), pa.array(n_bytes, pa.int64()), pa.array(total), pa.array(total > limit)],
                                                 names=["doc_id", "n_bytes", "n_tokens", "over_limit"])
                total = None

    schema = f"doc_id {docs.schema[doc_id].dataType.simpleString()}, n_bytes long, n_tokens long, over_limit boolean"
    return source.mapInArrow(run, schema)


def op12_token_counts(spark, sf_dir: str) -> DataFrame:
    return count_tokens(spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text"))
