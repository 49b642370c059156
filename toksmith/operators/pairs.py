"""Adjacent-pair statistics over symbol strings (all overlapping occurrences count)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from toksmith.functions.symbols import adjacent_pairs, pair_left, pair_right


def pair_stats(d: DataFrame, sym: str = "sym", n: str = "n", first: str = "first") -> DataFrame:
    """``(pair, n, pos)``: weighted pair counts and the first occurrence of each pair.

    ``pos = (doc_id, chunk_pos, offset)`` of the earliest occurrence: the
    earliest occurrence of a pair inside the earliest occurrence of a chunk.
    """
    ex = d.select(
        F.col(n).alias("w"),
        F.col(first).alias("f"),
        F.posexplode(adjacent_pairs(F.col(sym))).alias("offset", "pair"),
    )
    return ex.groupBy("pair").agg(
        F.sum("w").alias("n"),
        F.min(F.struct(F.col("f.doc_id").alias("doc_id"), F.col("f.chunk_pos").alias("chunk_pos"),
                       F.col("offset"))).alias("pos"),
    )


def pair_stats_with_total(d: DataFrame, sym: str = "sym", n: str = "n", first: str = "first") -> DataFrame:
    """:func:`pair_stats` plus one row with the empty pair ``''`` whose count is the
    total number of pair occurrences, ranked before every real pair, so that
    one top-k job returns both the best pairs and the total."""
    ex = d.select(
        F.col(n).alias("w"),
        F.col(first).alias("f"),
        F.posexplode(adjacent_pairs(F.col(sym))).alias("offset", "pair"),
    ).select("pair", "w", F.struct(F.col("f.doc_id").cast("long").alias("doc_id"),
                                   F.col("f.chunk_pos").cast("long").alias("chunk_pos"),
                                   F.col("offset").cast("long").alias("offset")).alias("pos"))
    tot = d.select(F.lit("").alias("pair"), (F.col(n) * (F.length(sym) - 1)).alias("w"),
                   F.struct(F.lit(-1).cast("long").alias("doc_id"), F.lit(-1).cast("long").alias("chunk_pos"),
                            F.lit(-1).cast("long").alias("offset")).alias("pos"))
    return ex.unionByName(tot).groupBy("pair").agg(F.sum("w").alias("n"), F.min("pos").alias("pos"))


def ranked(stats: DataFrame) -> DataFrame:
    """Most frequent first; ties → first seen in corpus order."""
    return stats.orderBy(F.col("n").desc(), F.col("pos").asc())


def top_pairs(stats: DataFrame, k: int) -> DataFrame:
    """Top-k pairs (TakeOrderedAndProject: k rows per task, k rows to the driver)."""
    return ranked(stats).limit(k)


def with_ids(stats: DataFrame) -> DataFrame:
    return stats.select(
        pair_left("pair").alias("left_id"), pair_right("pair").alias("right_id"), "n", "pos"
    )


def sequence_pair_counts(df: DataFrame, ids: str = "ids") -> DataFrame:
    """Adjacent pairs of ID arrays (e.g. an encoded corpus): ``(left_id, right_id, n)``."""
    ex = df.select(F.explode(id_pairs(F.col(ids))).alias("p"))
    return ex.groupBy(F.col("p.l").alias("left_id"), F.col("p.r").alias("right_id")).agg(
        F.count(F.lit(1)).alias("n")
    )


def id_pairs(a):
    """Array of ``struct(l, r)`` for adjacent IDs of an ID array."""
    m = F.greatest(F.size(a) - 1, F.lit(0))
    return F.zip_with(F.slice(a, 1, m), F.slice(a, 2, m),
                      lambda x, y: F.struct(x.alias("l"), y.alias("r")))
