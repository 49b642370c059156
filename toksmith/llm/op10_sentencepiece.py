"""SentencePiece encoding and decoding over a relational lattice.

The text is normalised as the model does (spaces become U+2581, one in front) and
falls into *words* at places that no piece spans: before a run of U+2581 and around
line feeds.  Each distinct word is encoded once:

* its substrings of bounded length are exploded (from each start, the lengths that pieces with the same first
  characters have) and equi-joined to the piece table (broadcast; bounded by the vocabulary, at most ``MAX_PIECES``),
* the edges found meet in the word's bucket, and
* Viterbi runs over a bucket's edges by their end, for all its words at once.

The best path has the largest sum of piece scores; of equal sums the one whose
last piece starts first.  A character without a piece costs ``UNKNOWN`` less than the
lowest score and becomes its UTF-8 bytes' pieces.  This is the library's rule
for unigram models; for a model trained by merges it is the best-scoring
segmentation of the same pieces, not the merge order's.

Documents lie in blocks of about ``BLOCK_BYTES``, packed for the shuffle; a block sends each of its distinct words
once to the word's bucket and gets ids back in the same order, so frequent words cost a
row per block and no occurrence is shuffled.  A word longer than ``NAME`` is one fold over its edges, linear in its length.

Defined cases: a null text has null ids; an empty one has none; rows keep their
other columns (``ids`` and ``n_tokens`` are replaced); repeated rows are rows of their
own; an empty table gives an empty result; U+2581 in a text decodes to a space.
"""

from __future__ import annotations

import json
import re
import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

MODEL = "/opt/tokenizers/piece_bpe_32k.model"
SPACE = "▁"
UNKNOWN = 10.0
MAX_PIECES = (1 << 20) - 1
_ID = (1 << 20) - 1
BLOCK_BYTES = 16 << 20
BUCKET_BYTES = 2 << 20  # of text for each bucket of words; a bucket's edges are sorted in memory
NAME = 40  # characters of a word that is not folded alone; below 64, as a sort key has 6 bits for its ends
SEGMENT = 256  # characters of a word whose substrings one row makes
SLOTS = 1 << 16  # of the table of piece lengths by first characters
_MAX_LEN = (1 << 11) - 1  # of a piece in characters
_WORDS = re.compile(f"{SPACE}+[^{SPACE}\n]*|\n|[^{SPACE}\n]+")


@dataclass
class Pieces:
    """The tables of a model: normal pieces with id and score, byte pieces, and all texts by id."""

    pieces: list[tuple[str, int, float]]
    byte_ids: list[int]
    by_id: list[bytes]

    @property
    def longest(self) -> int:
        return max((len(p) for p, _, _ in self.pieces), default=1)

    @property
    def unknown_score(self) -> float:
        return min((s for _, _, s in self.pieces), default=0.0) - UNKNOWN


def load(path: str = MODEL) -> Pieces:
    """Pieces of a model file with byte fallback."""
    import sentencepiece

    sp = sentencepiece.SentencePieceProcessor(model_file=path)
    if sp.get_piece_size() > MAX_PIECES:
        raise ValueError("vocabulary too large to broadcast")
    pieces, byte_ids, by_id = [], [0] * 256, []
    for i in range(sp.get_piece_size()):
        p = sp.id_to_piece(i)
        if sp.is_byte(i):
            byte_ids[int(p[1:-1], 16)] = i
            by_id.append(bytes([int(p[1:-1], 16)]))
        elif sp.is_control(i) or sp.is_unknown(i) or sp.is_unused(i):
            by_id.append(b"")
        else:
            pieces.append((p, i, sp.get_score(i)))
            by_id.append(p.replace(SPACE, " ").encode())
    if any("\n" in p or SPACE in p.lstrip(SPACE) for p, _, _ in pieces):
        raise ValueError("a piece spans words")
    return Pieces(pieces, byte_ids, by_id)


def split(text: str) -> list[str]:
    return _WORDS.findall(SPACE + text.replace(" ", SPACE)) if text else []


def _lengths(model: Pieces) -> Column:
    """A constant: by the slot of three characters, the lengths of the pieces that start with them.  One
    and two characters are always looked up; slots that characters share only add candidates."""
    lengths = [{1, 2} for _ in range(SLOTS)]
    for p, _, _ in model.pieces:
        if len(p) > 2:
            lengths[zlib.crc32(p[:3].encode()) % SLOTS].add(len(p))
    return F.from_json(F.lit(json.dumps([sorted(x) for x in lengths])), "array<array<int>>")


def _scores(model: Pieces) -> list[float]:
    """The score by id + 1; 0 stands for an unknown character."""
    scores = [model.unknown_score] + [0.0] * len(model.by_id)
    for _, i, score in model.pieces:
        scores[i + 1] = score
    return scores


def lattice(words: DataFrame, model: Pieces, spark: SparkSession) -> DataFrame:
    """``(bucket, word)`` distinct -> ``(bucket, id, edge, word)``, a row an edge.  An edge is one
    number: its end (31 bits), ``_MAX_LEN`` minus its length (12), and its id + 1 (20; 0: unknown character).
    A substring is made only if its length is that of some piece with the same first three characters.
    ``id`` numbers the words of a partition; only a word's first edge carries the word."""
    longest = model.longest
    if longest > _MAX_LEN:
        raise ValueError("a piece is too long to pack")
    table = spark.createDataFrame([(p, i) for p, i, _ in model.pieces], "piece string, id int")
    lengths = _lengths(model)
    numbered = words.select("bucket", "word", F.monotonically_increasing_id().alias("word_id"))
    parts = numbered.select("*", F.explode(F.sequence(F.lit(0), F.floor((F.length("word") - 1) / SEGMENT).cast("int"))).alias("part"))
    parts = parts.select("bucket", "word", "word_id", (F.col("part") * SEGMENT).alias("base"), F.substring("word", F.col("part") * SEGMENT + 1, F.lit(SEGMENT + longest - 1)).alias("seg"))
    starts = parts.select("*", F.explode(F.sequence(F.lit(0), F.least(F.length("seg"), F.lit(SEGMENT)) - 1)).alias("s"))
    slot = F.crc32(F.substring("seg", F.col("s") + 1, F.lit(3)).cast("binary")).bitwiseAND(SLOTS - 1).cast("int")
    fits = starts.select("*", F.explode(F.get(lengths, slot)).alias("k")).where(F.col("s") + F.col("k") <= F.length("seg"))
    key = F.shiftleft((F.col("base") + F.col("s") + F.col("k")).cast("long"), 32) + F.shiftleft((F.lit(_MAX_LEN) - F.col("k")).cast("long"), 20)
    first = F.when((F.col("base") + F.col("s") == 0) & (F.col("k") == 1), F.col("word"))
    subs = fits.select("bucket", "word_id", "k", key.alias("key"), first.alias("word"), F.substring("seg", F.col("s") + 1, F.col("k")).alias("sub"))
    found = subs.join(F.broadcast(table), F.col("sub") == F.col("piece"), "left").where("piece is not null or k = 1")
    return found.select("bucket", F.col("word_id").alias("id"), (F.col("key") + F.coalesce(F.col("id") + 1, F.lit(0))).alias("edge"), "word")


# -- inside tasks ------------------------------------------------------------------

def _fold(edges: list[int], size: int, scores: list[float]) -> list[int]:
    """By end position: the last piece of the best path to each place (length, and id + 1 in
    the lower 20 bits), from one word's edges sorted by end, longer ones first."""
    score, pointers = [0.0] * (size + 1), [0] * size
    for e in edges:
        end, length, id1 = e >> 32, _MAX_LEN - (e >> 20 & _MAX_LEN), e & _ID
        total = score[end - length] + scores[id1]
        if not pointers[end - 1] or total > score[end]:
            score[end] = total
            pointers[end - 1] = length << 20 | id1
    return pointers


def _viterbi(word: np.ndarray, edges: np.ndarray, n: int, scores: np.ndarray) -> np.ndarray:
    """:func:`_fold` for the edges of ``n`` short words at once, end after end: ``[end, word]`` -> pointer."""
    end, length = edges >> 32, _MAX_LEN - (edges >> 20 & _MAX_LEN)
    keys = np.sort(end << 52 | word << 26 | (63 - length) << 20 | edges & _ID)
    end = keys >> 52
    longest = int(end[-1]) if len(end) else 0
    cuts = np.searchsorted(end, np.arange(1, longest + 2))
    score, pointers = np.zeros((longest + 1, n)), np.zeros((longest + 1, n), np.int32)
    for e in range(1, longest + 1):
        here = keys[cuts[e - 1]:cuts[e]]
        w, length, id1 = here >> 26 & (1 << 26) - 1, 63 - (here >> 20 & 63), here & _ID
        total = score[e - length, w] + scores[id1]
        new = np.concatenate(([True], w[1:] != w[:-1]))
        begin = np.flatnonzero(new)
        best = np.maximum.reduceat(total, begin)
        group = np.cumsum(new) - 1
        hit = np.flatnonzero(total == best[group])
        hit = hit[np.concatenate(([True], group[hit][1:] != group[hit][:-1]))]  # of equal sums the longest
        score[e, w[begin]] = best
        pointers[e, w[hit]] = length[hit] << 20 | id1[hit]
    return pointers


def _paths(known: pa.Table, scores: np.ndarray, byte_ids: list[int], mark: int) -> dict[str, bytes]:
    """The edges of a bucket -> the ids of each of its words, ended by ``mark``."""
    ids, edges = (known.column(c).to_numpy() for c in ("id", "edge"))
    first = known.column("word").is_valid().to_numpy()
    words = known.column("word").drop_null().to_pylist()
    if not words:
        return {}
    low = int(ids.min())
    place = np.zeros(int(ids.max()) - low + 1, np.int64)
    sizes = np.array([len(w) for w in words], np.int64)
    order = np.argsort(sizes > NAME, kind="stable")  # short words first
    short = int((sizes <= NAME).sum())
    words, sizes = [words[k] for k in order.tolist()], sizes[order]
    place[ids[first][order] - low] = np.arange(len(words))
    word = place[ids - low]
    table: dict[str, bytes] = {}
    own = word < short
    pointers = _viterbi(word[own], edges[own], short, scores)
    at, every, steps = sizes[:short].copy(), np.arange(short), []
    unknown = np.zeros(short, bool)
    while len(every):
        p = pointers[at[every], every]
        unknown[every[p & _ID == 0]] = True
        steps.append((every, (p & _ID) - 1))
        at[every] -= p >> 20
        every = every[at[every] > 0]
    counts = np.zeros(short, np.int64)
    for w, _ in steps:
        counts[w] += 1
    ends = np.cumsum(counts + 1)
    flat = np.full(int(ends[-1]) if short else 0, mark, np.int64)
    for k, (w, i) in enumerate(steps):  # from the last token back
        flat[ends[w] - 2 - k] = i
    width = np.dtype(_id_type(mark)).itemsize
    raw, begin = flat.astype(_id_type(mark)).tobytes(), 0
    for w, e in zip(words[:short], (ends * width).tolist(), strict=True):
        table[w] = raw[begin:e]
        begin = e
    for k in np.flatnonzero(unknown).tolist():
        table[words[k]] = _ended(_trace(words[k], pointers[1:, k].tolist(), byte_ids), mark)
    if short < len(words):
        rest = np.flatnonzero(~own)
        rest = rest[np.lexsort((edges[rest], word[rest]))]
        cuts = np.searchsorted(word[rest], np.arange(short, len(words) + 1))
        listed = scores.tolist()
        for k, w in enumerate(words[short:]):
            table[w] = _ended(_trace(w, _fold(edges[rest[cuts[k]:cuts[k + 1]]].tolist(), len(w), listed), byte_ids), mark)
    return table


def _ended(ids: list[int], mark: int) -> bytes:
    return np.array([*ids, mark], _id_type(mark)).tobytes()


def _pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows ``(block, row, text)`` -> ``(block, data)``: a block's rows of a batch as one compressed Arrow stream."""
    options = pa.ipc.IpcWriteOptions(compression=pa.Codec("zstd"))
    for b in batches:
        block = b.column("block").to_numpy()
        order = np.argsort(block, kind="stable")
        rows = b.select(["row", "text"])
        cuts = [0, *(np.flatnonzero(np.diff(block[order])) + 1).tolist(), len(order)]
        for start, end in zip(cuts, cuts[1:], strict=False):
            if start < end:
                sink = pa.BufferOutputStream()
                with pa.ipc.new_stream(sink, rows.schema, options=options) as out:
                    out.write_batch(rows.take(pa.array(order[start:end])))
                yield pa.RecordBatch.from_arrays([pa.array([block[order[start]]], pa.int64()), pa.array([sink.getvalue().to_pybytes()], pa.binary())], names=["block", "data"])


def _unpacked(packed: pa.Table, only_text: bool = False) -> Iterator[pa.Table]:
    options = pa.ipc.IpcReadOptions(included_fields=[1] if only_text else None)
    for data in packed.column("data"):
        yield pa.ipc.open_stream(data.as_buffer(), options=options).read_all()


def _trace(word: str, pointers: list[int], byte_ids: list[int]) -> list[int]:
    out, at = [], len(word)
    while at:
        p = pointers[at - 1]
        if p & _ID:
            out.append((p & _ID) - 1)
        else:
            out.extend(byte_ids[b] for b in reversed(word[at - 1].encode()))
        at -= p >> 20
    return out[::-1]


def _bucket_words(packed: pa.Table, buckets: int) -> dict[int, list[str]]:
    """The distinct words of a block by bucket, in order."""
    distinct: set[str] = set()
    for piece in _unpacked(packed, only_text=True):
        for t in piece.column("text").to_pylist():
            if t:
                distinct.update(split(t))
    distinct.discard("\n")
    out: dict[int, list[str]] = {}
    for w in distinct:
        out.setdefault(_bucket(w, buckets), []).append(w)
    for own in out.values():
        own.sort()
    return out


def _bucket(word: str, buckets: int) -> int:
    return zlib.crc32(word.encode()) % buckets


def _send(buckets: int):
    def run(key: tuple[pa.Scalar, ...], table: pa.Table) -> pa.Table:
        own = _bucket_words(table, buckets)
        return pa.table({"bucket": pa.array(list(own), pa.int64()), "block": pa.array([key[0].as_py()] * len(own), pa.int64()),
                         "words": pa.array(["\n".join(w) for w in own.values()], pa.string())})

    return run


def _id_type(mark: int) -> type:
    return np.uint16 if mark < 1 << 16 else np.int32


def _answer(scores: list[float], byte_ids: list[int], mark: int):
    def run(sent: pa.Table, known: pa.Table) -> pa.Table:
        """To each block the ids of its words, in the order in which it sent them, each word's ended by ``mark``."""
        table = _paths(known, np.array(scores), byte_ids, mark)
        out = [b"".join([table[w] for w in words.split("\n")]) for words in sent.column("words").to_pylist()]
        return pa.table({"block": sent.column("block").cast(pa.int64()), "bucket": sent.column("bucket").cast(pa.int64()),
                         "ids": pa.array(out, pa.binary())})

    return run


def _write(buckets: int, newline: bytes, mark: int, schema: pa.Schema):
    def run(docs: pa.Table, answer: pa.Table) -> pa.Table:
        own = _bucket_words(docs, buckets)
        table = {"\n": newline}
        for bucket, sent in zip(*(answer.column(c).to_pylist() for c in ("bucket", "ids")), strict=True):
            ids = np.frombuffer(sent, _id_type(mark)).astype(np.int32)
            raw, begin = ids.tobytes(), 0
            for w, end in zip(own[bucket], (np.flatnonzero(ids == mark) * 4).tolist(), strict=True):
                table[w] = raw[begin:end]
                begin = end + 4
        out = []
        for piece in _unpacked(docs):
            texts = piece.column("text").to_pylist()
            raw = [b"".join([table[w] for w in split(t)]) if t else b"" for t in texts]
            sizes = np.array([len(x) // 4 for x in raw], np.int64)
            offsets = pa.array(np.concatenate([[0], np.cumsum(sizes)]).astype(np.int32), mask=np.array([t is None for t in texts] + [False]))
            ids = pa.ListArray.from_arrays(offsets, pa.array(np.frombuffer(b"".join(raw), np.int32)))
            out.append(pa.table({"row": piece.column("row"), "text": piece.column("text"), "ids": ids}))
        return pa.concat_tables(out) if out else schema.empty_table()

    return run


def encode(docs: DataFrame, model: Pieces, text: str = "text") -> DataFrame:
    """``docs`` with ``ids`` and ``n_tokens``."""
    from pyspark.sql.pandas.types import to_arrow_schema

    spark = docs.sparkSession
    kept = [c for c in docs.columns if c not in ("ids", "n_tokens")]
    rest = [F.col(f"`{c}`") for c in kept if c != text]
    rows = docs.select(F.struct(F.lit(0).alias("_"), *rest).alias("row"), F.col(text).alias("text"))
    total = rows.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    slots = max(int(spark.conf.get("spark.sql.shuffle.partitions")), spark.sparkContext.defaultParallelism)
    n_blocks = max(1, -(-total // BLOCK_BYTES))
    buckets = max(slots, int(-(-total // BUCKET_BYTES)))
    block = F.pmod(F.xxhash64("row", "text"), F.lit(n_blocks)).alias("block")
    dealt = rows.select(block, "row", "text").mapInArrow(_pack, "block long, data binary").repartition(max(slots, int(n_blocks)), "block")
    sent = dealt.groupBy("block").applyInArrow(_send(buckets), "bucket long, block long, words string")
    by_bucket = sent.repartition(buckets, "bucket")
    # the words are taken by way of their block: with the same columns both branches read one exchange, and so
    # the documents are shuffled once for the two cogroups
    own = F.when(F.col("block") >= 0, F.col("words"))
    words = by_bucket.select("bucket", F.explode(F.split(own, "\n")).alias("word")).groupBy("bucket", "word").agg(F.lit(1).alias("_")).select("bucket", "word")
    known = lattice(words, model, spark).select(F.col("bucket").alias("to"), "id", "edge", "word")
    mark = len(model.by_id)
    answer = by_bucket.groupBy("bucket").cogroup(known.groupBy("to")).applyInArrow(_answer(_scores(model), model.byte_ids, mark), "block long, bucket long, ids binary")
    newline = np.array([model.byte_ids[10]], np.int32).tobytes()
    shape = T.StructType([rows.schema["row"], T.StructField("text", rows.schema["text"].dataType), T.StructField("ids", T.ArrayType(T.IntegerType()))])
    out = dealt.groupBy("block").cogroup(answer.groupBy("block")).applyInArrow(_write(buckets, newline, mark, to_arrow_schema(shape)), shape)
    size = F.when(F.col("ids").isNotNull(), F.size("ids").cast("long")).alias("n_tokens")
    return out.select(*((F.col("text") if c == text else F.col("row").getField(c)).alias(c) for c in kept), "ids", size)


def decode(ids: Column, model: Pieces) -> Column:
    """Text of an id array: the pieces' bytes joined, the space in front of the text left out.
    Ids of control pieces add nothing; bytes that are not UTF-8 become U+FFFD."""
    table = F.split(F.lit(",".join(b.hex() for b in model.by_id)), ",")
    joined = F.unhex(F.array_join(F.transform(ids, lambda i: F.get(table, i)), ""))
    text = F.make_valid_utf8(joined.cast("string"))
    return F.when(F.startswith(text, F.lit(" ")), F.substring(text, 2, F.length(text))).otherwise(text)


def op10_sentencepiece(spark, sf_dir: str) -> DataFrame:
    model = load()
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    out = encode(docs, model)
    return out.select("doc_id", "n_tokens", "ids", (decode(F.col("ids"), model) == F.replace(F.col("text"), F.lit(SPACE), F.lit(" "))).alias("round_trip"))
