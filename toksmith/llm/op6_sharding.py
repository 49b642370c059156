"""Sharding by a consistent-hash ring with virtual nodes and bounded loads.

The ring has ``CELLS`` cells; every shard has ``VNODES`` virtual nodes on it and
a key belongs to the first node clockwise from the cell of its hash.  Loads are
bounded by capacities that differ by one row at most and sum to the row count
(law ``rows``): a full shard's overflow continues clockwise to the next shard
with room, so counts end at most one apart and all other rows stay at home.

Only the row counts of the cells (``CELLS`` numbers) meet on the driver, which
turns them into segments "ranks up to r of this cell go to shard s"; rows find
their rank in a window over (cell, sub-bucket), so no task holds more than a
small share of the rows, and a segment table of ``CELLS * SUBS`` rows at most is
broadcast.

Defined cases: a null text has size 1 and the checksum of the empty text; null
ids share a cell and are dealt out by text; repeated rows are rows of their own;
an empty table gives an empty result; input columns named ``shard`` or ``slot``
are replaced, all others pass through.
"""

from __future__ import annotations

import json

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

SHARDS = 8
VNODES = 64
CELLS = 4096
SUBS = 32


def ring_nodes(spark: SparkSession, shards: int, vnodes: int = VNODES) -> list[tuple[int, int]]:
    """``(cell, shard)`` of the virtual nodes in ring order; a node depends on its own shard alone."""
    nodes = spark.range(shards * vnodes).select((F.col("id") % shards).alias("s"), F.expr(f"id div {shards}").alias("v"))
    rows = nodes.select(F.pmod(F.xxhash64(F.lit("node"), "s", "v"), F.lit(CELLS)).alias("c"), F.xxhash64("s", "v", F.lit("tie")).alias("t"), "s").collect()
    return [(r["c"], r["s"]) for r in sorted(rows, key=lambda r: (r["c"], r["t"]))]


def clockwise(nodes: list[tuple[int, int]]) -> list[list[int]]:
    """For each cell the shards in the order in which a key meets them."""
    out: list[list[int]] = []
    for cell in range(CELLS):
        first = next((i for i, (c, _) in enumerate(nodes) if c >= cell), 0)
        out.append(list(dict.fromkeys(nodes[(first + i) % len(nodes)][1] for i in range(len(nodes)))))
    return out


def fill(counts: dict[int, int], order: list[list[int]], shards: int) -> list[dict]:
    """Segments of each cell.  All keys try their own shard first; what a full shard cannot take
    moves on to the next one clockwise."""
    total = sum(counts.values())
    room = [total // shards + (s < total % shards) for s in range(shards)]
    left = dict(sorted(counts.items()))
    taken: dict[int, list[tuple[int, int]]] = {c: [] for c in left}
    for turn in range(shards):
        for cell, n in left.items():
            shard = order[cell][turn]
            if (take := min(n, room[shard])):
                taken[cell].append((shard, take))
                left[cell] -= take
                room[shard] -= take
    used = [0] * shards
    out = []
    for cell, parts in taken.items():
        done = 0
        for shard, n in parts:
            out.append({"cell": cell, "upto": done + n, "shard": shard, "base": used[shard] - done})
            done += n
            used[shard] += n
    return out


def shard(docs: DataFrame, shards: int = SHARDS, doc_id: str = "doc_id", text: str = "text", keep: list[str | Column] | None = None) -> DataFrame:
    """``docs`` (or the columns ``keep``) with ``shard`` and ``slot`` (gapless from 0 within a shard)."""
    spark = docs.sparkSession
    kept = keep if keep is not None else [F.col(f"`{c}`") for c in docs.columns if c not in ("shard", "slot")]
    tie = F.xxhash64(F.col(doc_id).cast("string"), text)
    rows = docs.select(F.struct(*kept).alias("row"), F.pmod(F.xxhash64(F.col(doc_id).cast("string")), F.lit(CELLS)).cast("int").alias("cell"),
                       F.pmod(F.shiftrightunsigned(tie, 7), F.lit(SUBS)).cast("int").alias("sub"), tie.alias("tie"))
    counts = rows.groupBy("cell", "sub").agg(F.count(F.lit(1)).alias("n"))
    per_cell = {r["cell"]: r["n"] for r in counts.groupBy("cell").agg(F.sum("n").alias("n")).collect()}  # at most CELLS rows
    parts = fill(per_cell, clockwise(ring_nodes(spark, shards)), shards)
    segments = spark.range(1).select(F.explode(F.from_json(F.lit(json.dumps(parts)), "array<struct<cell:int,upto:long,shard:int,base:long>>")).alias("s")).groupBy(
        F.col("s.cell").alias("cell")).agg(F.sort_array(F.collect_list(F.struct("s.upto", "s.shard", "s.base"))).alias("segs"))
    before = F.sum("n").over(Window.partitionBy("cell").orderBy("sub").rowsBetween(Window.unboundedPreceding, -1))
    table = counts.select("cell", "sub", F.coalesce(before, F.lit(0)).alias("before")).join(F.broadcast(segments), "cell")
    nth = F.row_number().over(Window.partitionBy("cell", "sub").orderBy("tie", "whole"))  # ties left are equal rows
    ranked = rows.withColumn("whole", F.xxhash64("row")).withColumn("nth", nth)
    placed = ranked.join(F.broadcast(table), ["cell", "sub"]).withColumn("at", F.col("before") + F.col("nth") - 1).withColumn(
        "seg", F.filter("segs", lambda x: F.col("at") < x["upto"])[0])
    return placed.select("row.*", F.col("seg.shard").alias("shard"), (F.col("seg.base") + F.col("at")).alias("slot"))


def op6_sharding(spark, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    size = (F.coalesce(F.octet_length("text"), F.lit(0)) + 1).cast("long").alias("size")
    crc = F.crc32(F.coalesce("text", F.lit("")).cast("binary")).alias("text_crc32")
    return shard(docs, keep=["doc_id", size, crc]).select(
        "doc_id", "size", "text_crc32", F.lit("rows").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard"))
