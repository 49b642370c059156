"""Skew-safe joins.

A value that holds a large share of all rows (a frequent chunk, a frequent
token) must not land in one task.  ``hot_cold_join`` splits the build side
into the keys that are frequent on the probe side — at most ``1/min_share``
of them, a proven bound — which are broadcast, and the rest, which are
shuffle-joined; no key of the rest holds more than ``min_share`` of the rows.
"""

from __future__ import annotations

import math

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

MIN_SHARE = 1e-4  # a key with ≥ 0.01 % of the probe rows is "hot": at most 10,000 such keys


def hot_keys(probe: DataFrame, key: str, min_share: float = MIN_SHARE, counts: DataFrame | None = None) -> DataFrame:
    """Keys holding at least ``min_share`` of the probe rows (≤ 1/min_share keys).
    ``counts(key, n)`` — e.g. an already cached dictionary — saves a pass over the probe."""
    if counts is None:
        counts = probe.groupBy(key).agg(F.count(F.lit(1)).alias("n"))
    total = counts.agg(F.sum("n")).first()[0] or 0
    return counts.where(F.col("n") >= F.lit(max(1, math.ceil(total * min_share)))).select(key)


def hot_cold_join(probe: DataFrame, build: DataFrame, key: str, min_share: float = MIN_SHARE,
                  counts: DataFrame | None = None) -> DataFrame:
    """Inner equi-join ``probe ⋈ build`` on ``key``; ``build`` is unique per key."""
    hot = F.broadcast(build.join(F.broadcast(hot_keys(probe, key, min_share, counts)), key, "left_semi"))
    marked = probe.join(hot.select(key, F.lit(True).alias("_hot")), key, "left")
    hot_part = marked.where(F.col("_hot")).drop("_hot").join(hot, key)
    cold_part = marked.where(F.col("_hot").isNull()).drop("_hot").join(build, key)
    return hot_part.unionByName(cold_part)
