"""BPE training by differences.

The state between two rounds is a pair table ``{pair: n}`` on the driver and the distinct sequences, packed into *blocks*:
sequences of one weight and one partition, joined by a separator.  A round takes the best pairs, replaces them in the blocks that
hold one (a ``mapInArrow`` over numpy arrays) and moves the table by the difference of the pairs beside the replaced places, so no
row is made per symbol and no sequence is sorted or shuffled in a round.

* **Blocks.** They are written to the shared ``spark.checkpoint.dir`` and read again, with the merges made since put in first;
  every ``rebuild_every`` merges they are written anew.  A lost executor replays part of one round.
* **Ties.** A pair's first position ``(doc_id, chunk_pos, offset)`` is looked up only where its count ties with another
  candidate's: the blocks keep their sequences in corpus order.
* **Batches.** A round accepts the longest prefix of ranked pairs that share no token.  This gives exactly the merges of
  one-merge-per-round training: a merge only lowers counts of pairs that share a token with it, and every pair it
  creates is at most as frequent (and not earlier) than such a pair, which ranks after the accepted prefix.
  A self-pair ``(a, a)`` may be accepted but closes the batch.

On the driver are the merges and the pairs that occur at least ``floor`` times, at most ``MAX_KEPT``.  A pair below the floor
can only lose occurrences (new pairs hold a new symbol), so it is not missed before the table is empty; then pairs are counted anew.
"""

from __future__ import annotations

import heapq
from collections import defaultdict
from collections.abc import Iterator
from dataclasses import dataclass, field
from itertools import groupby

import numpy as np
import pyarrow as pa
from pyspark import StorageLevel
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from toksmith.functions import patterns
from toksmith.functions.symbols import CHUNK_SEP, byte_symbols, chars, cp_to_id, sym, syms
from toksmith.model import MAX_MODEL_ROWS, Merge, Model
from toksmith.operators import pretokenize as PT
from toksmith.session import Scratch
from toksmith.sources.corpus import widen

MAX_KEPT = 100_000  # pairs in the driver's table
FLOOR_SHARE = 1024  # the first floor: this part of the best pair's count
FLOOR_STEP = 8
BLOCK = 1 << 20  # symbols of a block
PART = 1 << 21  # symbols of a partition of blocks: a round over few symbols has few tasks
BINS = 1 << 22  # counters of a direct count
FEW = 32  # pairs that are searched one by one; tasks whose changes the driver sums
TOTAL = ""  # the pair table's row for the number of tokens
READ = "\n"  # the row for the number of sequences read


def select_batch(top: list[tuple[str, int]]) -> list[tuple[str, int]]:
    """Longest prefix of ranked ``(pair, count)`` with pairwise disjoint tokens."""
    used: set[str] = set()
    out = []
    for row in top:
        a, b = row[0]
        if a in used or b in used:
            break
        out.append(row)
        if a == b:
            break
        used.update((a, b))
    return out


def _chain(s: Column, merges: list[Merge]) -> Column:
    """``s`` brought up to date by some merges, in rank order."""
    from toksmith.operators.encode import fold

    return fold(s, Model("basic", merges))


# -- inside tasks ------------------------------------------------------------------

def _pack(batches: Iterator[pa.RecordBatch], schema: pa.Schema) -> Iterator[pa.RecordBatch]:
    """Rows ``(n, sym, doc_id, chunk_pos)`` sorted by weight and position -> blocks ``(n, text, doc_ids, chunk_poss)``."""
    for b in batches:
        weights, texts = b.column("n").to_pylist(), b.column("sym").to_pylist()
        start = 0
        while start < len(texts):
            end, size = start, 0
            while end < len(texts) and weights[end] == weights[start] and size < BLOCK:
                size += len(texts[end]) + 1
                end += 1
            places = [pa.ListArray.from_arrays(pa.array([0, end - start], pa.int32()), b.column(c).slice(start, end - start)).cast(schema.field(k).type)
                      for c, k in (("doc_id", "doc_ids"), ("chunk_pos", "chunk_poss"))]
            text = CHUNK_SEP + CHUNK_SEP.join(texts[start:end]) + CHUNK_SEP
            yield pa.RecordBatch.from_arrays([pa.array([weights[start]], pa.int64()), pa.array([text], schema.field("text").type), *places], schema=schema)
            start = end


def _codes(text: str) -> np.ndarray:
    return np.frombuffer(text.encode("utf-32-le"), dtype=np.uint32)


def _updated(text: str, behind: list[tuple[str, str]]) -> str:
    for pair, new in behind:
        text = text.replace(pair, new)
    return text


def _counted(left: np.ndarray, right: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Distinct pairs of two symbol arrays and their counts."""
    if not len(left):
        return left, right, np.zeros(0, np.int64)
    top = int(max(left.max(), right.max())) + 1
    keys = left.astype(np.int64) * top + right
    if top * top <= BINS and len(keys) * 8 > top * top:
        counts = np.bincount(keys, minlength=1)
        found = np.flatnonzero(counts)
        counts = counts[found]
    else:
        found, counts = np.unique(keys, return_counts=True)
    return found // top, found % top, counts


def _pairs_of(text: str) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    codes, sep = _codes(text), ord(CHUNK_SEP)
    both = np.flatnonzero((codes[:-1] != sep) & (codes[1:] != sep))
    return both, codes[both], codes[both + 1]


def _differences(text: str, pair: str, new: str, weight: int, change: dict[str, int]) -> None:
    """Adds to ``change`` what replacing ``pair`` in ``text`` does to the pair counts and to the number of tokens."""
    a, b, sep, codes = ord(pair[0]), ord(pair[1]), ord(CHUNK_SEP), _codes(text)

    def beside(symbols: np.ndarray, left: bool) -> None:
        found, n = np.unique(symbols[symbols != sep], return_counts=True)
        old, made = (pair[0], new) if left else (pair[1], new)
        for c, k in zip(map(chr, found.tolist()), n.tolist(), strict=True):
            change[c + old if left else old + c] -= k * weight
            change[c + made if left else made + c] += k * weight

    if a != b:
        at = np.flatnonzero((codes[:-1] == a) & (codes[1:] == b))
        joined = np.diff(at) == 2  # an occurrence followed by the next
        twice = int(joined.sum())
        beside(codes[at[np.concatenate(([True], ~joined))] - 1], True)
        beside(codes[at[np.concatenate((~joined, [True]))] + 2], False)
        change[pair] -= len(at) * weight
        change[pair[1] + pair[0]] -= twice * weight
        change[new + new] += twice * weight
        change[TOTAL] -= len(at) * weight
        return
    same = codes == a
    begin, end = np.flatnonzero(same[1:] & ~same[:-1]) + 1, np.flatnonzero(same[:-1] & ~same[1:]) + 1
    several = end - begin > 1
    begin, end = begin[several], end[several]
    length = end - begin
    half, odd = length // 2, length % 2 == 1
    beside(codes[begin - 1], True)
    beside(codes[end[~odd]], False)
    change[pair] -= int((length - 1).sum()) * weight
    change[new + new] += int((half - 1).sum()) * weight
    change[new + pair[0]] += int(odd.sum()) * weight
    change[TOTAL] -= int(half.sum()) * weight


def _counts(behind: list[tuple[str, str]]):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts: dict[str, int] = defaultdict(int)
        for b in batches:
            for weight, text in zip(b.column("n").to_pylist(), b.column("text").to_pylist(), strict=True):
                text = _updated(text, behind)
                for x, y, n in zip(*(v.tolist() for v in _counted(*_pairs_of(text)[1:])), strict=True):
                    counts[chr(x) + chr(y)] += n * weight
                counts[TOTAL] += (len(text) - text.count(CHUNK_SEP)) * weight
        yield _rows(counts)

    return run


def _rows(counts: dict[str, int]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(list(counts), pa.string()), pa.array(list(counts.values()), pa.int64())], names=["pair", "n"])


def _changes(behind: list[tuple[str, str]], accepted: list[tuple[str, str]], known: set[str], read: bool):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        change: dict[str, int] = defaultdict(int)
        for b in batches:
            for weight, text in zip(b.column("n").to_pylist(), b.column("text").to_pylist(), strict=True):
                text = _updated(text, behind)
                if read:
                    change[READ] += sum(any(pair in s for pair, _ in accepted) for s in text.split(CHUNK_SEP))
                for pair, new in accepted:
                    if pair in text:
                        _differences(text, pair, new, weight, change)
                        text = text.replace(pair, new)
        made = {new for _, new in accepted}
        yield _rows({p: n for p, n in change.items() if n and (p in (TOTAL, READ) or p in known or not made.isdisjoint(p))})

    return run


def _firsts(behind: list[tuple[str, str]], pairs: set[str] | None, schema: pa.Schema):
    """Per block, the first position of each of the pairs (None: of all) and its weighted count there."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for i, (weight, text) in enumerate(zip(b.column("n").to_pylist(), b.column("text").to_pylist(), strict=True)):
                text = _updated(text, behind)
                if pairs is not None and len(pairs) <= FEW:
                    found = {p: (text.find(p), 0) for p in pairs if p in text}
                else:
                    at, left, right = _pairs_of(text)
                    keys, first, n = np.unique(left.astype(np.int64) << 21 | right, return_index=True, return_counts=True)
                    named = (chr(k >> 21) + chr(k & 0x1FFFFF) for k in keys.tolist())
                    found = {p: (k, m) for p, k, m in zip(named, at[first].tolist(), n.tolist(), strict=True) if pairs is None or p in pairs}
                if not found:
                    continue
                starts = np.flatnonzero(_codes(text) == ord(CHUNK_SEP))
                offsets = np.array([k for k, _ in found.values()], dtype=np.int64)
                which = np.searchsorted(starts, offsets) - 1
                take = pa.array(which, pa.int64())
                yield pa.RecordBatch.from_arrays(
                    [pa.array(list(found), schema.field("pair").type), pa.array([m * weight for _, m in found.values()], pa.int64()),
                     b.column("doc_ids")[i].values.take(take), b.column("chunk_poss")[i].values.take(take), pa.array(offsets - starts[which] - 1, pa.int64())], schema=schema)

    return run


# -- rounds ---------------------------------------------------------------------------

@dataclass
class Rounds:
    """State of a training: the pair table, the blocks, and the merges that the blocks do not have yet."""

    scratch: Scratch
    base: DataFrame  # (sym, n, first)
    first_new_id: int
    merges: list[Merge] = field(default_factory=list)

    def __post_init__(self) -> None:
        rows = self.base.select("n", "sym", F.col("first.doc_id").alias("doc_id"), F.col("first.chunk_pos").cast("long").alias("chunk_pos"))
        self.id_type = rows.schema["doc_id"].dataType.simpleString()
        size = rows.agg(F.sum(F.length("sym"))).first()[0] or 0
        self.parts = 1 + size // PART
        rows = rows.where(F.length("sym") > 0).repartition(self.parts, "sym").sortWithinPartitions("n", "doc_id", "chunk_pos", "sym")
        out = f"n BIGINT, text STRING, doc_ids ARRAY<{self.id_type}>, chunk_poss ARRAY<BIGINT>"
        schema = self._arrow(out)
        self.blocks = self.scratch.write(rows.mapInArrow(lambda it: _pack(it, schema), out))
        self.start = 0  # merges that the blocks have
        self.read = 0

    def _arrow(self, ddl: str) -> pa.Schema:
        from pyspark.sql.pandas.types import to_arrow_schema
        from pyspark.sql.types import StructType

        return to_arrow_schema(StructType.fromDDL(ddl))

    def behind(self) -> list[tuple[str, str]]:
        return [(sym(m.left_id) + sym(m.right_id), sym(m.new_id)) for m in self.merges[self.start:]]

    def rebuild(self) -> None:
        """The blocks written anew with all merges so far."""
        behind = self.behind()

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for b in batches:
                at = b.schema.get_field_index("text")
                yield b.set_column(at, b.schema.field(at), pa.array([_updated(t, behind) for t in b.column(at).to_pylist()], b.schema.field(at).type))

        self.blocks = self.scratch.write(self.blocks.mapInArrow(run, self.blocks.schema))
        self.start = len(self.merges)

    def count(self, floor: int | None) -> None:
        """The pair table from the blocks: pairs of at least ``floor`` occurrences, the most frequent ones if they are too many."""
        counts = self.blocks.select("n", "text").mapInArrow(_counts(self.behind()), "pair STRING, n BIGINT").groupBy("pair").agg(F.sum("n").alias("n"))
        best = counts.orderBy((F.col("pair") == TOTAL).desc(), F.col("n").desc()).limit(MAX_KEPT + 2).collect()
        self.pairs = {r["pair"]: r["n"] for r in best}
        self.total = self.pairs.pop(TOTAL, 0)
        most = max(self.pairs.values(), default=0)
        self.floor = 1 if not most else min(most, floor or max(1, most // FLOOR_SHARE))
        full = len(self.pairs) > MAX_KEPT
        self._bound()
        if full and not self.pairs:  # too many pairs share the highest count: the first of them alone
            first = self._positions(None).where(F.col("n") == most).orderBy("at").first()
            self.pairs = {first["pair"]: most}

    def _bound(self) -> None:
        if len(self.pairs) > MAX_KEPT:
            self.floor = max(self.floor, heapq.nlargest(MAX_KEPT + 1, self.pairs.values())[-1] + 1)
        self.pairs = {p: n for p, n in self.pairs.items() if n >= self.floor}

    def _positions(self, pairs: set[str] | None) -> DataFrame:
        """``(pair, n, at)``: first positions of some pairs."""
        out = f"pair STRING, n BIGINT, doc_id {self.id_type}, chunk_pos BIGINT, offset BIGINT"
        rows = self.blocks.mapInArrow(_firsts(self.behind(), pairs, self._arrow(out)), out)
        return rows.groupBy("pair").agg(F.sum("n").alias("n"), F.min(F.struct("doc_id", "chunk_pos", "offset")).alias("at"))

    def best(self, k: int) -> list[tuple[str, int]]:
        """Up to ``k`` best pairs that share no token, in exact order."""
        lowest = heapq.nlargest(k, self.pairs.values())[-1]
        near = sorted(((p, n) for p, n in self.pairs.items() if n >= lowest), key=lambda x: -x[1])
        chosen: list[tuple[str, int]] = []
        for _, tied in groupby(near, key=lambda x: x[1]):
            tied = list(tied)
            if len(tied) > 1:
                at = {r["pair"]: tuple(r["at"]) for r in self._positions({p for p, _ in tied}).collect()}
                tied.sort(key=lambda x: (_order(at[x[0]]), x[0]))
            if len(select_batch([*chosen, *tied])) < len(chosen) + len(tied) or len(chosen) + len(tied) >= k:
                return select_batch([*chosen, *tied])[:k]
            chosen += tied
        return chosen

    def apply(self, accepted: list[tuple[str, str]], read: bool = False) -> None:
        """Move the pair table by what replacing the accepted pairs changes."""
        tokens = {c for pair, _ in accepted for c in pair}
        known = {p for p in self.pairs if not tokens.isdisjoint(p)}
        change = self.blocks.select("n", "text").mapInArrow(_changes(self.behind(), accepted, known, read), "pair STRING, n BIGINT")
        if self.parts > FEW:
            change = change.groupBy("pair").agg(F.sum("n").alias("n")).where((F.col("n") < 0) | (F.col("n") >= self.floor) | (F.col("pair") == READ))
        moved: dict[str, int] = defaultdict(int)
        for r in change.collect():  # pairs beside an accepted one, from a few tasks or summed
            moved[r["pair"]] += r["n"]
        self.total += moved.pop(TOTAL, 0)
        self.read = moved.pop(READ, 0)
        for pair, n in moved.items():
            if pair in self.pairs:
                self.pairs[pair] += n
            elif n >= self.floor:
                self.pairs[pair] = n
        self._bound()


def _order(pos: tuple) -> tuple:
    """Sort key of a position; null ids first."""
    return (pos[0] is not None, pos[0] if pos[0] is not None else 0, *pos[1:])


def train_rounds(
    d: DataFrame,
    n_merges: int,
    first_new_id: int,
    batch: int = 64,
    rebuild_every: int = 32,
    floor: int | None = None,
    log: list | None = None,
    verbose: bool = False,
) -> tuple[list[Merge], DataFrame]:
    """Learn up to ``n_merges`` merges over ``d(sym, n, first)``.

    Returns the merges (bounded by ``n_merges``) and the final dictionary
    ``(sym, n, first)`` whose symbols are the training corpus's encoding.  ``floor`` is the first count below which
    pairs stay off the driver (default: from the best pair's count); ``rebuild_every`` bounds the merges by which the
    blocks may be behind; a ``log`` list receives, per round, the merges made, all sequences, and those rewritten.
    """
    if n_merges > MAX_MODEL_ROWS:
        raise ValueError("too many merges")
    base = widen(d.select("sym", "n", "first"), "sym").persist(StorageLevel.MEMORY_AND_DISK)
    merges: list[Merge] = []
    if n_merges > 0:
        with Scratch(d.sparkSession) as scratch:
            state = Rounds(scratch, base, first_new_id, merges)
            sequences = base.where(F.length("sym") > 1).count() if log is not None else None
            state.count(floor)
            while len(merges) < n_merges:
                if merges and merges[-1].total_tokens is None:
                    merges[-1].total_tokens = state.total
                if not state.pairs:
                    if state.floor <= 1:
                        break
                    state.count(max(1, state.floor // FLOOR_STEP))
                    continue
                if len(merges) - state.start >= rebuild_every:
                    state.rebuild()
                total, accepted, made = state.total, [], []
                for pair, n in state.best(min(batch, n_merges - len(merges))):
                    new_id = first_new_id + len(merges) + len(made)
                    a, b = pair
                    accepted.append((pair, sym(new_id)))
                    total -= n
                    made.append(Merge(new_id - first_new_id, cp_to_id(ord(a)), cp_to_id(ord(b)), new_id, n, None if a == b else total))
                    if verbose:
                        print(f"merge {new_id - first_new_id + 1}/{n_merges} ({made[-1].left_id}, {made[-1].right_id}) -> {new_id} freq={n}")
                state.apply(accepted, log is not None)
                merges.extend(made)
                if log is not None:
                    log.append({"merges": len(made), "sequences": sequences, "read": state.read})
            if merges and merges[-1].total_tokens is None:
                merges[-1].total_tokens = state.total
    final = base.select("sym", "n", "first")
    if merges:
        final = base.select(_chain(F.col("sym"), merges).alias("sym"), "n", "first")
    base.unpersist()
    return merges, final


# -- the three model kinds ---------------------------------------------------

def train_regex(
    docs: DataFrame, vocab_size: int, pattern: str | None = "gpt4", text_col: str = "text",
    id_col: str = "doc_id", **kw,
) -> tuple[Model, DataFrame]:
    """Pre-split byte BPE; pair counts are summed over all chunks, weighted by frequency."""
    if vocab_size < 256:
        raise ValueError("vocab_size must be at least 256")
    d = PT.chunk_dictionary(PT.split_chunks(docs, pattern, text_col, id_col))
    d = d.select("chunk", "n", "first", byte_symbols("chunk").alias("sym"))
    merges, final = train_rounds(d, vocab_size - 256, 256, **kw)
    return Model("regex", merges, pattern=patterns.resolve(pattern)), final


def balance_weights(sizes: DataFrame) -> DataFrame:
    """``(_group, k)`` chunk counts -> ``(_group, weight)``: weights in thousandths that give every group the same share."""
    from pyspark.sql import Window

    everyone = Window.partitionBy()  # one row a group
    share = F.round(F.lit(1000.0) * F.sum("k").over(everyone) / F.count(F.lit(1)).over(everyone) / F.col("k"))
    return sizes.select("_group", F.greatest(F.lit(1), share).cast("long").alias("weight"))


def train_balanced(
    docs: DataFrame, vocab_size: int, group: str, weights: DataFrame | None = None, pattern: str | None = "gpt4", text_col: str = "text",
    id_col: str = "doc_id", **kw,
) -> tuple[Model, DataFrame]:
    """:func:`train_regex` on weighted chunk counts (T6): an occurrence counts as its group's weight, in thousandths (whole numbers, so
    counts stay exact and independent of the order of addition), and so do ``freq`` and ``total_tokens``.
    ``weights(group, weight)`` is a row a group; default: equal shares for all groups.  Rows of a group without weight do not count."""
    if vocab_size < 256:
        raise ValueError("vocab_size must be at least 256")
    pieces = docs.select(F.col(id_col).alias("doc_id"), F.col(group).alias("_group"), F.posexplode(PT.split_column(text_col, pattern)).alias("chunk_pos", "chunk"))
    # counted by (chunk, group) first: the weights meet the dictionary, not the corpus
    first = F.min(F.struct("doc_id", "chunk_pos")).alias("first")
    counted = pieces.groupBy("chunk", "_group").agg(F.count(F.lit(1)).alias("k"), first).persist(StorageLevel.MEMORY_AND_DISK)
    if weights is None:
        weights = balance_weights(counted.groupBy("_group").agg(F.sum("k").alias("k")))
    else:
        weights = weights.select(F.col(group).alias("_group"), "weight")
    d = counted.join(weights.withColumnRenamed("_group", "_g"), F.col("_group").eqNullSafe(F.col("_g"))).groupBy("chunk").agg(F.sum(F.col("k") * F.col("weight")).alias("n"), F.min("first").alias("first"))
    merges, final = train_rounds(d.select("chunk", "n", "first", byte_symbols("chunk").alias("sym")), vocab_size - 256, 256, **kw)
    counted.unpersist()
    return Model("regex", merges, pattern=patterns.resolve(pattern)), final


def train_basic(
    docs: DataFrame, vocab_size: int, text_col: str = "text", id_col: str = "doc_id", **kw
) -> tuple[Model, DataFrame]:
    """Byte BPE on whole texts (one text = one sequence; pairs never cross rows)."""
    if vocab_size < 256:
        raise ValueError("vocab_size must be at least 256")
    d = PT.text_dictionary(docs, text_col, id_col)
    d = d.select("chunk", "n", "first", byte_symbols("chunk").alias("sym"))
    merges, final = train_rounds(d, vocab_size - 256, 256, **kw)
    return Model("basic", merges), final


def corpus_alphabet(texts: DataFrame, col: str = "chunk") -> DataFrame:
    """Distinct characters (A5); at most the size of Unicode."""
    return texts.select(F.explode(chars(F.col(col))).alias("c")).distinct()


def char_translation(alphabet: str, first_id: int = len(patterns.SP_SPECIALS)) -> tuple[str, str]:
    """(alphabet, symbols of IDs first_id..): arguments of ``translate``."""
    return alphabet, syms(range(first_id, first_id + len(alphabet)))


def train_char(
    docs: DataFrame, vocab_size: int, text_col: str = "text", id_col: str = "doc_id",
    add_bos: bool = False, add_eos: bool = False, **kw,
) -> tuple[Model, DataFrame]:
    """Character BPE on whole texts after space → ▁; IDs 0-2 specials, then the
    alphabet in code-point order, then merges."""
    norm = docs.select(F.col(id_col), F.replace(F.col(text_col), F.lit(" "), F.lit(patterns.SPACE_MARK)).alias("text"))
    d = PT.text_dictionary(norm, "text", id_col).persist(StorageLevel.MEMORY_AND_DISK)
    letters = sorted(r["c"] for r in corpus_alphabet(d).collect())
    if len(letters) > MAX_MODEL_ROWS:
        raise ValueError("alphabet too large")
    alphabet = "".join(letters)
    src, dst = char_translation(alphabet)
    d2 = d.select("chunk", "n", "first", F.translate("chunk", src, dst).alias("sym"))
    first_new = len(patterns.SP_SPECIALS) + len(alphabet)
    n_merges = vocab_size - first_new
    if n_merges <= 0:
        merges, final = [], d2
    else:
        merges, final = train_rounds(d2, n_merges, first_new, **kw)
    d.unpersist()
    return Model("char", merges, alphabet=alphabet, add_bos=add_bos, add_eos=add_eos), final


def merge_log(spark, model: Model) -> DataFrame:
    """Per-merge log (T4): rank, pair, new ID, piece, frequency, tokens after the merge."""
    return model.merges_df(spark)
