"""Token windows, budgets and packing.

A corpus-wide running sum (packing documents into fixed contexts) must not
put the whole table into one window partition.  :func:`running_offsets`
splits the ordering key into balanced ranges at approximate quantiles, runs
the window inside each range, and adds each range's offset, computed over at
most ``buckets`` rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def token_windows(enc: DataFrame, size: int, overlap: int = 0, ids: str = "ids") -> DataFrame:
    """Fixed windows of ``size`` tokens, consecutive windows sharing ``overlap``;
    windows never split a token.  ``(doc_id, window, start, ids)``."""
    step = size - overlap
    if step <= 0:
        raise ValueError("overlap must be smaller than size")
    a = F.col(ids)
    starts = F.when(F.size(a) > 0, F.sequence(F.lit(0), F.size(a) - 1, F.lit(step))).otherwise(
        F.array().cast("array<int>"))
    ex = enc.select("doc_id", a.alias("_a"), F.posexplode(starts).alias("window", "start"))
    return ex.select("doc_id", "window", "start", F.slice("_a", F.col("start") + 1, size).alias("ids"))


def running_offsets(df: DataFrame, order_col: str, len_col: str, buckets: int | None = None) -> DataFrame:
    """Exclusive running sum of ``len_col`` in ``order_col`` order (unique keys), as ``offset``.

    The key range is cut at approximate quantiles into ``buckets`` ranges (default: twice the
    task slots, at least 64); ``Bucketizer`` assigns ranges by binary search, each range runs
    its own window, and range offsets come from a window over at most ``buckets`` rows."""
    from pyspark.ml.feature import Bucketizer

    spark = df.sparkSession
    b = buckets or max(64, 2 * spark.sparkContext.defaultParallelism)
    bounds = sorted(set(df.approxQuantile(order_col, [i / b for i in range(1, b)], 0.001))) if b > 1 else []
    splits = [float("-inf")] + [float(x) for x in bounds] + [float("inf")]
    x = df.withColumn("_key", F.col(order_col).cast("double"))
    if bounds:  # NULL keys come first, in a range of their own
        x = Bucketizer(splits=splits, inputCol="_key", outputCol="_bucket", handleInvalid="keep").transform(x)
        x = x.withColumn("_bucket", F.when(F.col("_key").isNull(), -1.0).otherwise(F.col("_bucket"))).drop("_key")
    else:
        x = x.withColumn("_bucket", F.when(F.col("_key").isNull(), -1.0).otherwise(0.0)).drop("_key")
    w = Window.partitionBy("_bucket").orderBy(order_col).rowsBetween(Window.unboundedPreceding, -1)
    x = x.withColumn("_within", F.coalesce(F.sum(len_col).over(w), F.lit(0)))
    tot = x.groupBy("_bucket").agg(F.sum(len_col).alias("_t"))  # ≤ buckets rows
    wb = Window.orderBy("_bucket").rowsBetween(Window.unboundedPreceding, -1)
    tot = tot.select("_bucket", F.coalesce(F.sum("_t").over(wb), F.lit(0)).alias("_base"))
    return x.join(F.broadcast(tot), "_bucket").withColumn("offset", F.col("_base") + F.col("_within")) \
        .drop("_bucket", "_within", "_base")


def pack(enc: DataFrame, context: int, n_col: str = "n_tokens", order_col: str = "doc_id", eot: bool = True,
         buckets: int | None = None) -> DataFrame:
    """Documents (each followed by an end-of-text token) laid end to end and cut
    into contexts of ``context`` tokens: ``(doc_id, offset, length, first_context, last_context)``.
    The narrow (key, length) table is persisted so that the encoding runs once for
    both the in-range windows and the range totals."""
    from pyspark import StorageLevel

    x = enc.select(order_col, (F.col(n_col) + (1 if eot else 0)).alias("length")).persist(StorageLevel.MEMORY_AND_DISK)
    x = running_offsets(x, order_col, "length", buckets)
    return x.select(order_col, F.col("offset").cast("bigint"), F.col("length").cast("bigint"),
                    F.floor(F.col("offset") / context).cast("bigint").alias("first_context"),
                    F.floor((F.col("offset") + F.col("length") - 1) / context).cast("bigint").alias("last_context"))


def budget(df: DataFrame, group: str, order: str, n_col: str, limit: int, span: int = 4096) -> DataFrame:
    """Running token total per group in ``order`` (an integer position such as a turn
    number); ``fits`` while within ``limit``.

    A group may hold a large share of all rows, so it is cut into ranges of ``span``
    positions: each (group, range) runs its own window, and the range totals — at most
    (positions / span) rows per group — give each range its offset.  No group is ever
    handled by a single task."""
    x = df.withColumn("_r", F.floor(F.col(order) / span))
    w = Window.partitionBy(group, "_r").orderBy(order).rowsBetween(Window.unboundedPreceding, 0)
    x = x.withColumn("_within", F.sum(n_col).over(w))
    tot = x.groupBy(group, "_r").agg(F.sum(n_col).alias("_t"))
    wr = Window.partitionBy(group).orderBy("_r").rowsBetween(Window.unboundedPreceding, -1)
    tot = tot.select(group, "_r", F.coalesce(F.sum("_t").over(wr), F.lit(0)).alias("_base"))
    out = x.join(tot, [group, "_r"]).withColumn("cum_tokens", (F.col("_base") + F.col("_within")).cast("bigint"))
    return out.drop("_r", "_within", "_base").withColumn("fits", F.col("cum_tokens") <= limit)


def truncate(ids, k: int) -> Column:
    """Keep the first ``k`` tokens."""
    return F.slice(F.col(ids) if isinstance(ids, str) else ids, 1, k)


def context_rows(enc: DataFrame, context: int, eot_id: int, order_col: str = "doc_id", buckets: int | None = None) -> DataFrame:
    """The packed contexts themselves, ``(context_id, ids)``: documents in ``order_col`` order, each followed by the
    end-of-text ID, laid end to end; every context but the last has ``context`` tokens.

    ``enc(order_col, ids)``; rows with null IDs are no documents.  A document is cut at context borders in its own
    row, so what is shuffled are pieces of at most ``context`` tokens, and a context is put together from those
    that hold its ``context`` tokens: neither a long document nor a frequent one meets in one task."""
    from pyspark import StorageLevel

    rows = enc.select(order_col, F.concat("ids", F.array(F.lit(eot_id))).alias("ids"))
    rows = rows.persist(StorageLevel.MEMORY_AND_DISK)  # read by the quantiles, the windows and the cuts
    rows = rows.where(F.col("ids").isNotNull())  # behind the stored rows: before them, the encoding would run for the filter too
    placed = running_offsets(rows.select(order_col, "ids", F.size("ids").cast("long").alias("_len")), order_col, "_len", buckets)
    first, last = F.floor(F.col("offset") / context), F.floor((F.col("offset") + F.col("_len") - 1) / context)
    pieces = placed.select("ids", "offset", F.explode(F.sequence(first, last)).alias("context_id"))
    start = F.greatest(F.col("context_id") * context - F.col("offset"), F.lit(0))  # first token of the document in this context
    at = F.col("offset") + start - F.col("context_id") * context
    pieces = pieces.select("context_id", F.struct(at.cast("int").alias("at"), F.slice("ids", (start + 1).cast("int"), (F.lit(context) - at).cast("int")).alias("ids")).alias("piece"))
    dealt = pieces.repartitionByRange("context_id")
    return dealt.groupBy("context_id").agg(F.flatten(F.transform(F.array_sort(F.collect_list("piece")), lambda p: p["ids"])).alias("ids"))


def utf8_edges(symbols: Column) -> tuple[Column, Column]:
    """Whether a byte run (one symbol a byte) starts, and whether it ends, inside a UTF-8 character.

    The state carried over the bytes is how many a character still lacks: a run that starts with a continuation byte
    began with some lacking, and one whose last lead byte is followed by fewer bytes than it announces ends so."""
    starts = symbols.rlike(r"^[\x{80}-\x{bf}]")
    ends = symbols.rlike(r"[\x{c2}-\x{df}]\z|[\x{e0}-\x{ef}][\x{80}-\x{bf}]{0,1}\z|[\x{f0}-\x{f4}][\x{80}-\x{bf}]{0,2}\z")
    # a run of continuation bytes alone may end a character or not; only the bytes before it could tell, so it counts as a start
    return starts, ends


def chunk_rows(enc: DataFrame, model, size: int, overlap: int = 0) -> DataFrame:
    """Retrieval chunks ``(doc_id, window, start, ids, text, starts_inside, ends_inside)`` of a byte-level model's encoding;
    the text has U+FFFD where a chunk border cuts a character, and the flags say at which end."""
    from toksmith.functions.symbols import valid_utf8
    from toksmith.operators.decode import decode_bytes_column

    w = token_windows(enc, size, overlap).withColumn("_bytes", decode_bytes_column(F.col("ids"), model))
    starts, ends = utf8_edges(F.decode("_bytes", "ISO-8859-1"))
    return w.select("doc_id", "window", "start", "ids", valid_utf8(F.col("_bytes")).alias("text"),
                    starts.alias("starts_inside"), ends.alias("ends_inside"))
