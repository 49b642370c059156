"""Prefix trie of conversations from padded turn-id matrices.

A conversation is a row of 128-bit turn ids (MD5 of role and text).  Rows are range-dealt by their first ``WIDTH`` ids,
so a shard holds a run of the trie in order, and a frequent first turn or a group of equal conversations spreads over
shards.  In a shard the rows are padded to a matrix, ``WIDTH`` turns at a time, and ordered by ``lexsort``; a mask of the
places where a column differs from the row above, OR-accumulated over the columns, marks the node starts of every
depth, and ``reduceat`` over them gives each node's members; sums over subtrees run from the deepest depth up.
Rows alone in their node leave the matrix: the rest of such a row is a chain of its own, written without a matrix.

A node lies in several shards only if it is on the path of a shard's first or last row; such *border* nodes
(at most ``2 * (WIDTH + 1)`` a shard) are recombined by one aggregation.  All their figures add up, as each shard counts only what
is its own: a node counts as a child and for its text in its first shard, as a leaf in its last.  Below a ``WIDTH``-turn prefix that
itself crosses a border, rows go to another round of the same job, whose nodes hang below that prefix; there are as many
rounds as such prefixes are deep.  The ids of members that end at a border node in several shards are streamed through the hash in order.

What reaches the driver: each shard's first and last prefix.  A conversation's own turn ids (32 bytes a turn) are one row.

Defined cases: a null role or text is empty; turns with null numbers come first; turns with one number are ordered by
their ids; repeated rows are turns of their own; rows without a conversation id belong to no conversation;
``c % 20`` keeps the sign of ``c``; an empty table gives no node, not even the root; other columns are not read.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from toksmith.llm.blocks import mix
from toksmith.session import cut_lineage, write_once

WIDTH = 16  # turns of a block of columns, and of the keys that deal the rows
ROOT = bytes(16)
NOTHING = hashlib.sha256(b"").hexdigest()
NODES = ("border boolean, key binary, parent_key binary, depth long, conv_id long, parent_conv_id long, n_convs long, n_children long, "
         "n_leaves long, saved_tokens long, ends_sha256 string")
_U = np.uint64


def rebuilt(conversations: DataFrame) -> DataFrame:
    """``(conv_id, ids, words)``: the turn ids and word counts of every rebuilt conversation."""
    role, text = F.coalesce("role", F.lit("")), F.coalesce("text", F.lit(""))
    name = F.unhex(F.md5(F.concat_ws(":", F.length(role).cast("string"), role, text).cast("binary")))
    n = F.regexp_count(text, F.lit(r"[^\x20\x09-\x0D]+")).cast("long")
    turn = F.struct(F.col("turn").isNotNull().alias("numbered"), F.col("turn"), name.alias("id"), n.alias("words"))
    own = conversations.where(F.col("conv_id").isNotNull()).select(F.col("conv_id").cast("long").alias("conv_id"), turn.alias("t"))
    own = own.groupBy("conv_id").agg(F.array_sort(F.collect_list("t")).alias("own"))
    donor = F.col("conv_id") - F.col("conv_id") % 20
    heads = own.where(F.col("conv_id") == donor).select(F.col("conv_id").alias("donor"), F.slice("own", 1, 3).alias("head"))
    h = (F.crc32(F.col("conv_id").cast("string").cast("binary")) % 4).cast("int")
    none = F.array().cast(own.schema["own"].dataType)
    both = own.withColumn("donor", donor).join(heads, "donor", "left").withColumn(
        "turns", F.concat(F.slice(F.coalesce("head", none), F.lit(1), h), F.slice("own", h + 1, F.size("own"))))
    return both.select("conv_id", F.col("turns.id").alias("ids"), F.col("turns.words").alias("words"))


# -- one shard ----------------------------------------------------------------------------------

def _child_key(a: np.ndarray, b: np.ndarray, hi: np.ndarray, lo: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Two lanes that name a node by its parent's lanes and its last turn."""
    return mix(mix(a + hi) ^ lo), mix(mix(b ^ (lo * _U(0x9E3779B97F4A7C15))) + hi + _U(1))


def _pack(a: np.ndarray, b: np.ndarray) -> list[bytes]:
    raw = np.stack([a, b], 1).astype(">u8").tobytes()
    return [raw[i:i + 16] for i in range(0, len(raw), 16)]


def path_keys(top: bytes, head: list[bytes]) -> list[bytes]:
    """Keys of the nodes from ``top`` down along the turns of ``head``."""
    out = [top]
    for turn in head:
        lanes = [np.frombuffer(x, ">u8").astype(np.uint64) for x in (out[-1], turn)]
        out += _pack(*_child_key(lanes[0][:1], lanes[0][1:], lanes[1][:1], lanes[1][1:]))
    return out


@dataclass
class Shard:
    """Rows of a shard: two lanes of the top node and the member id a row, and turns ``off[r]:off[r + 1]`` of the flat arrays."""

    top: np.ndarray
    conv: np.ndarray
    off: np.ndarray
    ids: np.ndarray
    words: np.ndarray
    length: np.ndarray = field(init=False)

    def __post_init__(self):
        self.length = np.diff(self.off)

    @classmethod
    def of(cls, table: pa.Table) -> Shard:
        table = table.combine_chunks()
        one = lambda c: table.column(c).chunk(0)
        lanes = lambda x: np.frombuffer(x.cast(pa.binary(16)).buffers()[1], ">u8").reshape(-1, 2).astype(np.uint64) if len(x) else np.zeros((0, 2), np.uint64)
        ids = one("ids")
        off = ids.offsets.to_numpy().astype(np.int64)
        return cls(lanes(one("top")), one("conv_id").to_numpy(), off - off[0], lanes(ids.flatten()), one("words").flatten().to_numpy())

    def columns(self, rows: np.ndarray, base: int, width: int) -> np.ndarray:
        """Padded matrix of the lanes of turns ``base``… of some rows (padding: 0)."""
        j = base + np.arange(width)
        there = j < self.length[rows, None]
        at = np.where(there, self.off[rows, None] + j, 0)
        return np.where(there[..., None], self.ids[at] if len(self.ids) else np.zeros((*at.shape, 2), np.uint64), _U(0))


@dataclass
class Depth:
    """Nodes of one depth: rows ``first``..``last`` of its ordering, members, and what their subtrees add up to."""

    depth: int
    low: np.ndarray
    n: np.ndarray
    ended: np.ndarray
    parent: np.ndarray
    key: tuple[np.ndarray, np.ndarray]
    words: np.ndarray
    before: np.ndarray  # also in the shard before
    beyond: np.ndarray  # also in the next one
    ends: list
    children: np.ndarray = field(init=False)
    leaves: np.ndarray = field(init=False)
    saved: np.ndarray = field(init=False)

    def __post_init__(self):
        self.children = np.zeros(len(self.n), np.int64)
        self.leaves = ((self.ended == self.n) & ~self.beyond).astype(np.int64)
        self.saved = (self.n - ~self.before) * self.words


def _ends(conv: np.ndarray) -> str:
    return hashlib.sha256(",".join(map(str, conv.tolist())).encode()).hexdigest()


def _shared(a: list[bytes], b: list[bytes]) -> int:
    n = 0
    while n < min(len(a), len(b)) and a[n] == b[n]:
        n += 1
    return n


def trie(shard: Shard, width: int, before: tuple | None, after: tuple | None, split_ends: set, split_deep: set) -> tuple[list[Depth], dict[str, np.ndarray]]:
    """The depths' nodes of a shard whose neighbours' nearest prefixes ``(top, head, deeper)`` are given, and its chains."""
    depths: list[Depth] = []
    chains: list[tuple[np.ndarray, np.ndarray, int]] = []  # rows, their node, depth
    rows, node, base = np.arange(len(shard.conv)), None, 0
    while len(rows):
        span = int(min(width, shard.length[rows].max() - base))
        cells = shard.columns(rows, base, span)
        keys = [shard.conv[rows]] + [cells[:, j, lane] for j in range(span - 1, -1, -1) for lane in (1, 0)]
        order = np.lexsort(keys + ([shard.top[rows, 1], shard.top[rows, 0]] if node is None else [node]))
        rows, cells = rows[order], cells[order]
        node = None if node is None else node[order]
        conv, length = shard.conv[rows], shard.length[rows]
        anew = np.ones(len(rows), bool)
        above = shard.top[rows] if node is None else node[:, None]
        anew[1:] = (above[1:] != above[:-1]).any(1)
        change = np.ones((len(rows), span + 1), bool)
        change[:, 0] = anew
        change[1:, 1:] = (cells[1:] != cells[:-1]).any(2)
        np.logical_or.accumulate(change, axis=1, out=change)
        shared = [-1, -1]
        if base == 0:
            for side, (row, other) in enumerate(((0, before), (len(rows) - 1, after))):
                if other is not None and other[0] == _pack(*shard.top[rows[row:row + 1]].T)[0]:
                    mine = _pack(*cells[row, :min(length[row], span)].T)
                    shared[side] = _shared(mine, other[1])
        if node is None:
            node = np.cumsum(anew) - 1
        for j in range(0 if base == 0 else 1, span + 1):
            depth = base + j
            live = np.flatnonzero(length >= depth)
            if not len(live):
                break
            start = change[live, j]
            start[0] = True
            at = np.flatnonzero(start)
            n = np.diff(np.append(at, len(live)))
            ended = length[live] == depth
            first, last = live[at], live[at + n - 1]
            if depth == 0:
                key = tuple(shard.top[rows[first]].T)
                parent, words = np.zeros(len(at), np.int64), np.zeros(len(at), np.int64)
            else:
                parent = node[first]
                key = _child_key(*(lane[parent] for lane in depths[-1].key), cells[first, j - 1, 0], cells[first, j - 1, 1])
                words = shard.words[shard.off[rows[first]] + depth - 1]
            sums = np.add.reduceat(ended.astype(np.int64), at)
            ends = [None] * len(at)
            closing = np.flatnonzero(sums)
            enders, cut = conv[live[ended]], np.concatenate([[0], np.cumsum(sums[closing])])
            for k, i in enumerate(closing):
                ends[i] = _ends(enders[cut[k]:cut[k + 1]])
            in_before, in_after = (first == 0) & (depth <= shared[0]), (last == len(rows) - 1) & (depth <= shared[1])
            if base == 0:
                for row, i in ((0, 0), (len(rows) - 1, len(at) - 1)):  # ids that end here in several shards are hashed elsewhere
                    if sums[i] and length[row] >= depth and _prefix(shard, rows[row], depth) in split_ends:
                        ends[i] = None
            depths.append(Depth(depth, np.minimum.reduceat(conv[live], at), n, sums, parent, key, words, in_before, in_after, ends))
            node = np.full(len(rows), -1)
            node[live] = np.cumsum(start) - 1
        more = np.flatnonzero(length > base + span)
        if base == 0 and span == width:
            for row in (0, len(rows) - 1):  # below a prefix that crosses a border: another round
                if length[row] >= width and _prefix(shard, rows[row], width) in split_deep:
                    more = more[node[more] != node[row]]
        if not len(more):
            break
        alone = depths[-1].n[node[more]] == 1
        chains.append((rows[more[alone]], node[more[alone]], len(depths) - 1))
        rows, node, base = rows[more[~alone]], node[more[~alone]], base + span
    for lone, at, k in chains:
        depths[k].children += np.bincount(at, minlength=len(depths[k].n))
        depths[k].leaves += np.bincount(at, minlength=len(depths[k].n))
    for d, up in zip(depths[:0:-1], depths[-2::-1], strict=True):
        size = len(up.n)
        up.children += np.bincount(d.parent, ~d.before, size).astype(np.int64)
        up.leaves += np.bincount(d.parent, d.leaves, size).astype(np.int64)
        np.add.at(up.saved, d.parent, d.saved)
    return depths, _chain_nodes(shard, depths, chains)


def _prefix(shard: Shard, row: int, depth: int) -> tuple[bytes, tuple[bytes, ...]]:
    """Top and first turns of a row, as the driver names prefixes."""
    return _pack(*shard.top[row:row + 1].T)[0], tuple(_pack(*shard.ids[shard.off[row]:shard.off[row] + depth].T))


def _chain_nodes(shard: Shard, depths: list[Depth], chains: list) -> dict[str, np.ndarray]:
    """Nodes below the last shared one of rows that are alone: ``row``, ``depth``, and for the first its parent's place."""
    row, depth, parent, level = [], [], [], []
    for rows, at, k in chains:
        n = shard.length[rows] - depths[k].depth
        row.append(np.repeat(rows, n))
        first = np.cumsum(n) - n
        step = np.arange(int(n.sum())) - np.repeat(first, n)
        depth.append(depths[k].depth + 1 + step)
        parent.append(np.where(step == 0, np.repeat(at, n), -1))
        level.append(np.full(int(n.sum()), k))
    whole = lambda x: np.concatenate(x) if x else np.zeros(0, np.int64)
    return {"row": whole(row), "depth": whole(depth), "parent": whole(parent), "level": whole(level)}


def _emit(shard: Shard, depths: list[Depth], chain: dict, base: int, above: dict[bytes, list[bytes]]) -> Iterator[pa.RecordBatch]:
    names = [c.split()[0] for c in NODES.split(", ")]
    schema = pa.schema([("border", pa.bool_()), ("key", pa.binary()), ("parent_key", pa.binary()), *((c, pa.int64()) for c in names[3:10]), ("ends_sha256", pa.string())])

    def batch(border, key, parent_key, depth, conv, parent_conv, n, children, leaves, saved, ends):
        nulls = lambda x, mask=None: pa.array(x, pa.int64(), mask=mask)
        return pa.RecordBatch.from_arrays([pa.array(border, pa.bool_()), pa.array(key, pa.binary()), pa.array(parent_key, pa.binary()), nulls(depth), conv,
                                           parent_conv, nulls(n), nulls(children), nulls(leaves), nulls(saved), pa.array(ends, pa.string())], schema=schema)

    up = None
    for d in depths:
        border = d.before | d.beyond
        size = len(d.n)
        if d.depth == 0 and base:  # the top itself belongs to the round before; its subtree's sums go to it and the nodes above it
            none = pa.nulls(1, pa.int64())
            for i, top in enumerate(_pack(*d.key)):
                saved = d.saved[i]  # the words of a top count in its own round
                for k, key in enumerate([top, *above[top]]):
                    yield batch([True], [key], [None], [-1], none, none, [0], [d.children[i] if k == 0 else 0], [d.leaves[i]], [saved], [None])
            up = (np.ones(size, bool), _pack(*d.key), d.low)
            continue
        keys = _pack(*d.key)
        if up is None:
            parent_border, parent_key, parent_low = np.zeros(size, bool), [None] * size, np.zeros(size, np.int64)
            rootless = np.ones(size, bool)
        else:
            parent_border, parent_low, rootless = up[0][d.parent], up[2][d.parent], np.zeros(size, bool)
            parent_key = [up[1][p] if e else None for p, e in zip(d.parent, parent_border, strict=True)]
        # a border node's parent is a border node
        yield batch(border, [k if e else None for k, e in zip(keys, border, strict=True)], parent_key, np.full(size, base + d.depth), pa.array(d.low),
                    pa.array(parent_low, pa.int64(), mask=rootless | parent_border), d.n, d.children, d.leaves, d.saved, d.ends)
        up = (border, keys, d.low)
    row = chain["row"]
    if len(row):
        conv = shard.conv[row]
        end = shard.length[row] == chain["depth"]
        top = chain["parent"] >= 0
        parent_conv, parent_key, lost = conv.copy(), [None] * len(row), np.zeros(len(row), bool)
        for i in np.flatnonzero(top):
            d, p = depths[chain["level"][i]], chain["parent"][i]
            parent_conv[i] = d.low[p]
            if d.before[p] | d.beyond[p] | (d.depth == 0 and base > 0):
                parent_key[i], lost[i] = _pack(d.key[0][p:p + 1], d.key[1][p:p + 1])[0], True
        one = np.ones(len(row), np.int64)
        ends = [hashlib.sha256(str(c).encode()).hexdigest() if e else None for c, e in zip(conv.tolist(), end, strict=True)]
        yield batch(np.zeros(len(row), bool), [None] * len(row), parent_key, base + chain["depth"], pa.array(conv), pa.array(parent_conv, mask=lost), one, one - end, one, one * 0, ends)


def _hash_ids(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """SHA-256 of each key's ids, comma-joined, streamed in order."""
    keys, sums, now, digest = [], [], None, None
    for batch in batches:
        for key, conv in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
            if key != now:
                if digest is not None:
                    keys.append(now)
                    sums.append(digest.hexdigest())
                now, digest = key, hashlib.sha256(str(conv).encode())
            else:
                digest.update(f",{conv}".encode())
    if digest is not None:
        keys.append(now)
        sums.append(digest.hexdigest())
    yield pa.RecordBatch.from_arrays([pa.array(keys, pa.binary()), pa.array(sums, pa.string())], names=["key", "ends"])


# -- the job ------------------------------------------------------------------------------------

def nodes(sequences: DataFrame, width: int = WIDTH, shards: int | None = None) -> DataFrame:
    """Trie nodes of ``(conv_id, ids, words)``, one row a conversation."""
    spark = sequences.sparkSession
    rows = sequences.select(F.lit(ROOT).alias("top"), "conv_id", "ids", "words")
    above: dict[bytes, list[bytes]] = {}  # keys above the tops of a round
    found, streamed, base = [], [], 0
    while rows is not None:
        deeper = F.size("ids") > width
        keyed = rows.withColumn("head", F.slice("ids", 1, width)).withColumn("deeper", deeper)
        order = [F.col("top"), F.col("head"), F.col("deeper"), F.when(F.col("deeper"), F.xxhash64("ids")), F.col("conv_id")]
        dealt = keyed.repartitionByRange(shards, *order) if shards else keyed.repartitionByRange(*order)
        dealt = cut_lineage(dealt.withColumn("part", F.spark_partition_id()))  # written once: a row's shard is the same for all readers
        side = F.struct("top", "head", "deeper")
        sides = sorted(dealt.groupBy("part").agg(F.min(side).alias("low"), F.max(side).alias("high")).collect(), key=lambda r: r["part"])  # two prefixes a shard
        plain = lambda s: (bytes(s["top"]), [bytes(x) for x in s["head"]], s["deeper"])
        ranges = [(r["part"], plain(r["low"]), plain(r["high"])) for r in sides]
        near = {p: (ranges[i - 1][2] if i else None, ranges[i + 1][1] if i + 1 < len(ranges) else None) for i, (p, _, _) in enumerate(ranges)}
        crossing = [a[2] for a, b in zip(ranges, ranges[1:], strict=False) if a[2] == b[1]]
        split_ends = {(t, tuple(h)) for t, h, deep in crossing if not deep}
        split_deep = {(t, tuple(h)) for t, h, deep in crossing if deep}

        def run(batches: Iterator[pa.RecordBatch], near=near, split_ends=split_ends, split_deep=split_deep, base=base, above=above) -> Iterator[pa.RecordBatch]:
            batches = [b for b in batches if b.num_rows]
            if batches:
                table = pa.Table.from_batches(batches)
                shard = Shard.of(table)
                depths, chain = trie(shard, width, *near[table.column("part")[0].as_py()], split_ends, split_deep)
                yield from _emit(shard, depths, chain, base, above)

        found.append(write_once(dealt.select("part", "top", "conv_id", "ids", "words").mapInArrow(run, NODES)))
        if split_ends:
            named = [(t, list(h), path_keys(t, list(h))[-1]) for t, h in split_ends]  # at most one a shard
            names = spark.createDataFrame([(bytearray(t), [bytearray(x) for x in h], bytearray(k)) for t, h, k in named], "top binary, head array<binary>, key binary")
            ending = dealt.where("not deeper").join(F.broadcast(names), ["top", "head"]).select("key", "conv_id")
            streamed.append(ending.repartition("key").sortWithinPartitions("key", "conv_id").mapInArrow(_hash_ids, "key binary, ends string"))
        rows = None
        if split_deep:
            paths = [(t, list(h), path_keys(t, list(h))) for t, h in split_deep]  # at most one a shard
            names = spark.createDataFrame([(bytearray(t), [bytearray(x) for x in h], bytearray(p[-1])) for t, h, p in paths], "top binary, head array<binary>, below binary")
            rows = dealt.where("deeper").join(F.broadcast(names), ["top", "head"]).select(
                F.col("below").alias("top"), "conv_id", F.slice("ids", width + 1, F.size("ids")).alias("ids"), F.slice("words", width + 1, F.size("words")).alias("words"))
            above = {p[-1]: [*p[-2::-1], *above.get(t, [])] for t, _, p in paths}
            base += width
    every = found[0]
    for f in found[1:]:
        every = every.unionByName(f)
    sums = [F.sum(c).alias(c) for c in ("n_convs", "n_children", "n_leaves", "saved_tokens")]
    border = every.where("border").groupBy("key").agg(F.max("parent_key").alias("parent_key"), F.max("depth").alias("depth"), F.min("conv_id").alias("conv_id"),
                                                      *sums, F.max("ends_sha256").alias("ends_sha256"))
    if streamed:
        hashes = streamed[0]
        for s in streamed[1:]:
            hashes = hashes.unionByName(s)
        border = border.join(hashes, "key", "left").withColumn("ends_sha256", F.coalesce("ends", "ends_sha256")).drop("ends")
    border = cut_lineage(border)
    parents = border.select(F.col("key").alias("parent_key"), F.col("conv_id").alias("parent_conv_id"))
    inner = every.where("not border")
    below = inner.where(F.col("parent_key").isNotNull()).drop("parent_conv_id", "border", "key").unionByName(border.drop("key"))
    columns = ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", F.coalesce("ends_sha256", F.lit(NOTHING)).alias("ends_sha256")]
    return inner.where(F.col("parent_key").isNull()).select(*columns).unionByName(below.join(parents, "parent_key", "left").select(*columns))


def op13_prefix_trie(spark, sf_dir: str) -> DataFrame:
    return nodes(rebuilt(spark.read.parquet(f"{sf_dir}/conversations.parquet").select("conv_id", "turn", "role", "text")))
