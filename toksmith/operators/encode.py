"""Encoding corpora with a trained model.

Merges are applied as one ascending fold over the model's merge list, each
a replacement in the symbol string (:func:`batches.fold`).  A merge of
rank r only creates pairs containing its new ID, whose ranks exceed r, so one
ascending pass equals the "repeat the lowest-rank pair" loop.

Two plans, same result; the caller picks one (``strategy``):

* ``inline`` — the pre-split chunks of a row are joined with a separator
  symbol that no merge contains, and the fold runs over the distinct chunks of
  an Arrow batch: no shuffle at all, cost ∝ bytes + merges × bytes of distinct
  chunks.  For small models and streams.
* ``dictionary`` — for vocabularies of any size.  Texts fall into *segments*
  that no merge spans (pre-split chunks; for whole-text and char models, cuts
  between two base symbols that are adjacent in no piece).  Each distinct
  segment is folded once over the merges whose piece occurs in it and joined
  back (frequent segments through a bounded broadcast, the rest by a shuffle
  join).  Texts lie in blocks, each with its distinct segments, and are rebuilt in
  their block: a segment is sent once a block, not once an occurrence, and
  repeated or NULL ids cannot mix rows.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import StorageLevel, TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from toksmith.functions import patterns
from toksmith.functions.symbols import CHUNK_SEP, OOV_MARK, byte_symbols, const_list, sym
from toksmith.model import Model
from toksmith.operators import batches
from toksmith.operators import pretokenize as PT
from toksmith.operators.batches import symbols_ids
from toksmith.operators.joins import hot_cold_join
from toksmith.session import arrow_rows, write_once

SLICE = 256  # symbols of a segment whose substrings one row makes
NAME = 48  # longer segments are named by a digest
SLICE_BYTES = 1 << 20  # of text that is cut at once
BATCH_ROWS = 512  # of texts on their way into the tasks
BLOCK = 1 << 23  # bytes of joined segments in a block of texts
ROW = 16  # bytes that a row counts besides its text
PART = 1 << 18  # bytes of texts in a row of a block
SEP = CHUNK_SEP  # chunk separator inside a row's symbol string; never part of a merge
DONE = chr(0x10FFFA)  # before a segment that is final (a special token)
_OOV = OOV_MARK  # placeholder for characters outside a char model's alphabet


def _c(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def fold(s, model: Model) -> Column:
    """Apply all merges of ``model`` in rank order to symbol string ``s``."""
    return batches.fold(_c(s), model) if model.merges else _c(s)


# -- byte models ----------------------------------------------------------------

def _base(text: Column, model: Model) -> Column:
    """The symbols that the merges start from; the chunks of a regex model are joined with a separator."""
    if model.kind == "basic":
        return byte_symbols(text)
    return F.array_join(F.transform(PT.split_column(text, model.pattern), lambda c: byte_symbols(c)), SEP)


def _folded(base: Column, model: Model) -> Column:
    if model.kind == "basic":
        return fold(base, model)
    return batches.fold(base, model, joined=True) if model.merges else F.replace(base, F.lit(SEP), F.lit(""))


def ordinary_symbols(text, model: Model) -> Column:
    """Encoded symbol string of a text without special-token handling."""
    return _folded(_base(_c(text), model), model)


def _special_case(seg: Column, specials: dict[str, int]) -> Column:
    out = None
    for tok, i in sorted(specials.items(), key=lambda x: (-len(x[0]), x[0])):
        out = (F.when(seg == tok, F.lit(sym(i))) if out is None else out.when(seg == tok, F.lit(sym(i))))
    return out


_POLICIES = {"all": True, "none": False, "none_raise": False}


def allowed_specials(model: Model, allowed_special="none_raise") -> dict[str, int]:
    """The special tokens that a policy name or a collection of tokens lets through."""
    if isinstance(allowed_special, str):
        if allowed_special not in _POLICIES:
            raise ValueError(f"allowed_special: one of {', '.join(_POLICIES)} or a collection of tokens, not {allowed_special!r}")
        chosen = model.specials.keys() if _POLICIES[allowed_special] else ()
    else:
        chosen = allowed_special
    return {token: model.specials[token] for token in chosen if token in model.specials}


def contains_special(text, tokens) -> Column:
    """True when the text contains any of the (literal) tokens."""
    text = _c(text)
    if not tokens:
        return F.lit(False)
    return text.rlike(patterns.special_alternation(list(tokens)))


def text_symbols(text, model: Model, allowed_special="none_raise") -> Column:
    """Encoded symbol string with the special-token policy.

    ``none_raise`` raises (``raise_error``) on rows that contain a registered
    special token; use :func:`special_policy_split` to quarantine them instead.
    """
    text = _c(text)
    if model.kind == "char":
        return char_symbols(text, model)
    if not model.specials:
        return ordinary_symbols(text, model)
    special = allowed_specials(model, allowed_special)
    if allowed_special == "none_raise":
        return F.when(
            contains_special(text, model.specials),
            F.raise_error(F.lit("special token found in text; pass allowed_special='all' or a set")),
        ).otherwise(ordinary_symbols(text, model))
    if not special:
        return ordinary_symbols(text, model)
    segs = F.regexp_extract_all(text, F.lit(patterns.segment_pattern(list(special))), 0)
    parts = F.transform(segs, lambda g: F.coalesce(_special_case(g, special), _base(g, model)))
    # no merge holds a special token's symbol, so the fold leaves it and joins nothing across it
    joined = F.array_join(parts, "" if model.kind == "basic" else SEP)
    return _folded(F.when(contains_special(text, special), joined).otherwise(_base(text, model)), model)


# -- char models --------------------------------------------------------------------

def _char_class(alphabet: str) -> str:
    cps = sorted(ord(c) for c in alphabet)
    ranges, i = [], 0
    while i < len(cps):
        j = i
        while j + 1 < len(cps) and cps[j + 1] == cps[j] + 1:
            j += 1
        ranges.append(f"\\x{{{cps[i]:x}}}" + (f"-\\x{{{cps[j]:x}}}" if j > i else ""))
        i = j + 1
    return "".join(ranges)


def char_base_symbols(text, model: Model) -> Column:
    """space → ▁, each character → its ID symbol, unknown characters → <unk>."""
    norm = F.replace(_c(text), F.lit(" "), F.lit(patterns.SPACE_MARK))
    if model.alphabet:
        norm = F.regexp_replace(norm, f"[^{_char_class(model.alphabet)}]", _OOV)
    else:
        norm = F.regexp_replace(norm, "(?s).", _OOV)
    if model.byte_fallback:
        return _with_fallback(F.replace(_c(text), F.lit(" "), F.lit(patterns.SPACE_MARK)), model)
    # translate() deletes characters mapped to U+0000, so <unk> (ID 0) is set afterwards
    dst = "".join(sym(len(patterns.SP_SPECIALS) + j) for j in range(len(model.alphabet)))
    return F.replace(F.translate(norm, model.alphabet, dst), F.lit(_OOV), F.lit(sym(patterns.SP_UNK)))


def _with_fallback(norm: Column, model: Model) -> Column:
    """Runs of alphabet characters as their symbols, every other character as one symbol for each of its UTF-8 bytes."""
    first = len(patterns.SP_SPECIALS)
    dst = "".join(sym(first + j) for j in range(len(model.alphabet)))
    known = f"[{_char_class(model.alphabet)}]+|" if model.alphabet else ""
    runs = F.regexp_extract_all(norm, F.lit(f"(?s){known}."), 0)
    byte_symbols_of = const_list([sym(model.first_byte_id + b) for b in range(256)])

    def spelled(run: Column) -> Column:
        codes = F.transform(F.regexp_extract_all(F.hex(F.encode(run, "UTF-8")), F.lit(".."), 0), lambda h: F.conv(h, 16, 10).cast("int"))
        return F.array_join(F.transform(codes, lambda b: F.element_at(byte_symbols_of, b + 1)), "")

    if not model.alphabet:
        return F.array_join(F.transform(runs, spelled), "")
    inside = lambda run: run.rlike(f"^[{_char_class(model.alphabet)}]")
    return F.array_join(F.transform(runs, lambda run: F.when(inside(run), F.translate(run, model.alphabet, dst)).otherwise(spelled(run))), "")


def char_symbols(text, model: Model) -> Column:
    """Char-model encoding with optional BOS/EOS."""
    s = fold(char_base_symbols(text, model), model)
    if model.add_bos:
        s = F.concat(F.lit(sym(patterns.SP_BOS)), s)
    if model.add_eos:
        s = F.concat(s, F.lit(sym(patterns.SP_EOS)))
    return s


# -- corpus jobs -------------------------------------------------------------------

def encode_column(text, model: Model, allowed_special="none_raise") -> Column:
    """``ARRAY<INT>`` of token IDs for a text column (inline plan)."""
    return symbols_ids(text_symbols(text, model, allowed_special))


def each(ids="ids") -> Column:
    """An array column as the input of ``explode``.  Of a bare column Spark infers that it is not empty, and pushes that filter down to the
    scan: the whole encoding would run once more for it, in the few tasks of the scan."""
    return F.coalesce(_c(ids), F.array().cast("array<int>"))


def encode(
    df: DataFrame, model: Model, text_col: str = "text", id_col: str = "doc_id",
    allowed_special="none_raise", strategy: str = "inline", keep: tuple = (),
) -> DataFrame:
    """Encoded corpus ``(doc_id, ids, n_tokens)`` (+ ``keep`` columns); NULL texts give NULL."""
    s = encode_symbols(df, model, text_col, id_col, allowed_special, keep, strategy)
    names = [c for c in s.columns if c not in ("sym", "n_tokens")]
    return s.select(*names, symbols_ids(F.col("sym")).alias("ids"), "n_tokens")


def encode_symbols(df: DataFrame, model: Model, text_col: str = "text", id_col: str = "doc_id",
                   allowed_special="none_raise", keep: tuple = (), strategy: str = "inline") -> DataFrame:
    """Encoded corpus as symbol strings ``(doc_id, …keep, sym, n_tokens)``: the
    compact form for token statistics (one char per token, no per-token arrays)."""
    if strategy == "dictionary":
        return _by_dictionary(df, model, text_col, id_col, allowed_special, keep)
    if strategy != "inline":
        raise ValueError(f"unknown strategy {strategy!r}")
    s = text_symbols(F.col(text_col), model, allowed_special)
    return df.select(F.col(id_col).alias("doc_id"), *keep, s.alias("sym")).withColumn("n_tokens", F.length("sym"))


def expansions(model: Model) -> dict[int, str]:
    """Base symbols of every merge's piece."""
    out: dict[int, str] = {}
    for m in model.merges:
        out[m.new_id] = "".join(out[i] if i in out else sym(i) for i in (m.left_id, m.right_id))
    return out


def _adjacent(model: Model) -> tuple[np.ndarray, np.ndarray]:
    """The base symbols that stand side by side in some piece; no merge spans a place between two others."""
    pairs = sorted({xy for piece in expansions(model).values() for xy in zip(piece, piece[1:], strict=False)})
    return tuple(np.array([ord(xy[k]) for xy in pairs], dtype=np.uint32) for k in (0, 1))


def _joined(text: Column, model: Model, allowed: dict[str, int]) -> Column:
    """Base symbols of a text, its chunks (regex models) and its special tokens, which are final, between separators."""
    plain = (lambda t: char_base_symbols(t, model)) if model.kind == "char" else (lambda t: _base(t, model))
    if not allowed:
        return plain(text)
    runs = F.regexp_extract_all(text, F.lit(patterns.segment_pattern(list(allowed))), 0)
    return F.array_join(F.transform(runs, lambda g: F.coalesce(F.concat(F.lit(DONE), _special_case(g, allowed)), plain(g))), SEP)


def candidate_fold(segments: DataFrame, model: Model) -> DataFrame:
    """``(seg)`` distinct base-symbol strings -> ``(seg, sym)``, folding only the merges that can
    apply: a merge applies inside a string only if its piece occurs there, so every substring up to the
    longest piece is equi-joined with the piece table (bounded by the model) and the matching merges
    are folded in rank order.  Exact; the work per segment does not grow with the number of
    merges.  Short segments stay in the task that holds them; of a long one a row holds a slice and its name, so it is linear
    in its length."""
    if not model.merges:
        return segments.select("seg", F.col("seg").alias("sym"))
    model.check()
    exp = expansions(model)
    longest = max(map(len, exp.values()))
    pieces = F.broadcast(segments.sparkSession.createDataFrame([(exp[m.new_id], m.rank) for m in model.merges], "piece STRING, rank INT"))
    pairs, news = model.merge_arrays()
    at = {m.rank: i + 1 for i, m in enumerate(model.merges)}
    place = (lambda r: r + 1) if all(r + 1 == i for r, i in at.items()) else (lambda r: F.array_position(F.array(*map(F.lit, at)), r).cast("int"))
    merged = lambda ranks: F.aggregate(ranks, F.col("seg"), lambda acc, r: F.replace(acc, F.element_at(pairs, place(r)), F.element_at(news, place(r))))

    def substrings(part: str) -> Column:
        starts = F.sequence(F.lit(0), F.least(F.length(part), F.lit(SLICE)) - 1)
        sizes = lambda s: F.filter(F.sequence(F.lit(2), F.lit(max(2, longest))), lambda k: k <= F.length(part) - s)
        return F.flatten(F.transform(starts, lambda s: F.transform(sizes(s), lambda k: F.substring(F.col(part), s + 1, k))))

    def found(rows: DataFrame, key: str, part: str) -> DataFrame:
        cut = rows.select(key, F.explode_outer(F.array_distinct(substrings(part))).alias("piece")).join(pieces, "piece", "left")
        return cut.groupBy(key).agg(F.array_sort(F.collect_set("rank")).alias("ranks"))  # at most the merges

    n = F.length("seg")
    short = found(segments.where((n >= 2) & (n <= NAME)), "seg", "seg").select("seg", merged(F.col("ranks")).alias("sym"))
    single = segments.where(n < 2).select("seg", F.col("seg").alias("sym"))
    named = segments.where(n > NAME).select("seg", F.md5(F.col("seg").cast("binary")).alias("name"))
    slices = named.select("name", F.explode(F.transform(
        F.sequence(F.lit(0), F.floor((n - 2) / SLICE).cast("int")),
        lambda k: F.substring(F.col("seg"), k * SLICE + 1, F.lit(SLICE + longest - 1)))).alias("part"))
    long = named.join(found(slices, "name", "part"), "name").select("seg", merged(F.col("ranks")).alias("sym"))
    return short.unionByName(single).unionByName(long)


# -- inside tasks ------------------------------------------------------------------

def _cut(texts: pa.Array, inside: np.ndarray) -> pa.Array:
    """Texts with a separator more at each place that no merge spans; ``inside``: the map of the symbol pairs that some piece has."""
    rows = texts.to_pylist()
    codes = np.frombuffer("".join(t for t in rows if t).encode("utf-32-le"), dtype=np.uint32)
    if len(codes) < 2:
        return texts
    apart = codes == ord(SEP)
    cut = ~(inside[batches._places(codes[:-1], codes[1:])] | apart[:-1] | apart[1:] | (codes[:-1] == ord(DONE)))
    place = np.arange(len(codes) + 1)
    place[1:-1] += np.cumsum(cut)
    place[-1] = place[-2] + 1
    marked = np.full(place[-1], ord(SEP), dtype=np.uint32)
    marked[place[:-1]] = codes
    whole = marked.tobytes().decode("utf-32-le")
    out, at = [], 0
    for t in rows:
        out.append(whole[place[at]:place[at + len(t) - 1] + 1] if t else t)
        at += len(t or "")
    return pa.array(out, pa.string())


def _blocks(schema: pa.Schema, pairs: tuple[np.ndarray, np.ndarray] | None = None):
    """Rows ``(row, text)``, segments joined by a separator -> blocks ``(block, rows, segs, texts)``: the distinct segments
    once, and the texts as their places in them.  A block's first row has the segments, and each row a part of the texts, so that no
    value is as large as the block (writers and readers of tables and shuffles keep buffers of the largest value).  ``pairs``: the symbols between which texts are not cut into segments (none: no more cuts)."""
    def slices(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        inside = np.zeros(batches.MAP, dtype=bool)
        if pairs is not None:
            inside[batches._places(*pairs)] = True
        for b in parts:
            ends = np.cumsum(pc.fill_null(pc.binary_length(b.column("text")), 0).to_numpy(zero_copy_only=False).astype(np.int64))
            start = 0
            while start < b.num_rows:
                end = max(start + 1, int(np.searchsorted(ends, (int(ends[start - 1]) if start else 0) + SLICE_BYTES, side="right")))
                part = b.slice(start, end - start)
                start = end
                yield part if pairs is None else pa.RecordBatch.from_arrays([part.column("row"), _cut(part.column("text"), inside)], names=["row", "text"])

    def packed(block: int, waiting: list[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = pa.Table.from_batches(waiting).combine_chunks()
        rows, texts = (_whole(table.column(c)) for c in ("row", "text"))
        cut = pc.split_pattern(texts, SEP)
        coded = cut.flatten().dictionary_encode()
        counts = pc.fill_null(pc.list_value_length(cut), 0).to_numpy()
        ends, nulls = np.cumsum(counts), texts.is_null().to_numpy(zero_copy_only=False)
        segs, places = SEP.join(coded.dictionary.to_pylist()), coded.indices.cast(pa.int32())
        sizes = np.cumsum(pc.fill_null(pc.binary_length(texts), 0).to_numpy(zero_copy_only=False).astype(np.int64) + ROW)
        start = 0
        while start < table.num_rows:
            end = max(start + 1, int(np.searchsorted(sizes, (int(sizes[start - 1]) if start else 0) + PART, side="right")))
            first = int(ends[start - 1]) if start else 0
            offsets = pa.array(np.concatenate(([0], ends[start:end] - first)).astype(np.int32), mask=np.append(nulls[start:end], False))
            own = pa.ListArray.from_arrays(offsets, places.slice(first, int(ends[end - 1]) - first))
            one = lambda values, n=end - start: pa.ListArray.from_arrays(pa.array([0, n], pa.int32()), values)
            out = [pa.array([block], pa.int64()), one(rows.slice(start, end - start)), pa.array([None if start else segs], pa.string()), one(own)]
            yield pa.RecordBatch.from_arrays([c.cast(f.type) for c, f in zip(out, schema, strict=True)], schema=schema)
            start = end

    def run(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        block = TaskContext.get().partitionId() << 32  # numbers hold for the one table they are written to
        waiting: list[pa.RecordBatch] = []
        size = 0
        for b in slices(parts):
            ends = np.cumsum(pc.fill_null(pc.binary_length(b.column("text")), 0).to_numpy().astype(np.int64) + ROW)
            start = 0
            while start < b.num_rows:
                before = int(ends[start - 1]) if start else 0
                end = min(int(np.searchsorted(ends, before + BLOCK - size)) + 1, b.num_rows)
                waiting.append(b.slice(start, end - start))
                size += int(ends[end - 1]) - before
                start = end
                if size >= BLOCK:
                    yield from packed(block, waiting)
                    block, waiting, size = block + 1, [], 0
        if waiting:
            yield from packed(block, waiting)

    return run


def _whole(column: pa.ChunkedArray) -> pa.Array:
    array = column.combine_chunks()
    return pa.concat_arrays(array.chunks) if isinstance(array, pa.ChunkedArray) else array


def _rebuilt(schema: pa.Schema):
    """A block and the symbols of its segments, by place -> the rows of its texts."""
    def run(blocks: pa.Table, answers: pa.Table) -> pa.Table:
        rows, segs, texts = (_whole(blocks.column(c)) for c in ("rows", "segs", "texts"))
        known = [s[1:] if s.startswith(DONE) else "" for s in segs.drop_null()[0].as_py().split(SEP)]
        for at, symbols in zip(answers.column("at").to_pylist(), answers.column("sym").to_pylist(), strict=True):
            known[at] = symbols
        cut = texts.flatten()
        parts = pa.array(known, pa.string()).take(cut.flatten())
        counts = pc.fill_null(pc.list_value_length(cut), 0).to_numpy()
        offsets = pa.array(np.concatenate(([0], np.cumsum(counts))).astype(np.int32), mask=np.append(cut.is_null().to_numpy(zero_copy_only=False), False))
        symbols = pc.binary_join(pa.ListArray.from_arrays(offsets, parts), "")
        return pa.table([rows.flatten().cast(schema.field(0).type), symbols.cast(schema.field(1).type)], schema=schema)

    return run


def _by_dictionary(df, model, text_col, id_col, allowed_special, keep) -> DataFrame:
    from pyspark.sql.pandas.types import to_arrow_schema

    spark, text = df.sparkSession, F.col(text_col)
    if allowed_special == "none_raise" and model.specials and model.kind != "char":
        text = F.when(contains_special(text, model.specials), F.raise_error(
            F.lit("special token found in text; pass allowed_special='all' or a set"))).otherwise(text)
    allowed = allowed_specials(model, allowed_special) if model.kind != "char" else {}
    rows = df.select(F.struct(F.col(id_col).alias("doc_id"), *keep).alias("row"), _joined(text, model, allowed).alias("text"))
    row, ids = rows.schema["row"].dataType, T.ArrayType(T.IntegerType())
    shape = T.StructType([T.StructField("block", T.LongType()), T.StructField("rows", T.ArrayType(row)), T.StructField("segs", T.StringType()), T.StructField("texts", T.ArrayType(ids))])
    with arrow_rows(spark, BATCH_ROWS):
        blocks = write_once(rows.mapInArrow(_blocks(to_arrow_schema(shape), None if model.kind == "regex" else _adjacent(model)), shape), large_rows=True)
    n = max(spark.sparkContext.defaultParallelism, blocks.where(F.col("segs").isNotNull()).count())
    words = blocks.select(F.col("block").alias("to"), F.posexplode(F.split("segs", SEP)).alias("at", "seg")).where(~F.col("seg").startswith(DONE) & (F.col("seg") != ""))
    dealt = words.repartition(n, "seg")
    counts = words.select("seg").repartition(n, "seg").groupBy("seg").agg(F.count(F.lit(1)).alias("n")).persist(StorageLevel.MEMORY_AND_DISK)
    folded = candidate_fold(counts.select("seg"), model).persist(StorageLevel.MEMORY_AND_DISK)
    known = hot_cold_join(dealt, folded, "seg", counts=counts).select("to", "at", "sym")
    whole = T.StructType([T.StructField("row", row), T.StructField("sym", T.StringType())])
    out = blocks.repartition(n, "block").groupBy("block").cogroup(known.repartition(n, "to").groupBy("to")).applyInArrow(_rebuilt(to_arrow_schema(whole)), whole)
    symbols = F.col("sym")
    if model.kind == "char" and model.add_bos:
        symbols = F.concat(F.lit(sym(patterns.SP_BOS)), symbols)
    if model.kind == "char" and model.add_eos:
        symbols = F.concat(symbols, F.lit(sym(patterns.SP_EOS)))
    return out.select("row.*", symbols.alias("sym")).withColumn("n_tokens", F.length("sym"))
