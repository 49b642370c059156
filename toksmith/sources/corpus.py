"""Corpus scans (IO1): only the needed columns reach the parquet reader."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession


def table(spark: SparkSession, sf_dir: str, name: str, *cols: str) -> DataFrame:
    df = spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")
    df = df.select(*cols) if cols else df
    return spread(df, cols[0] if cols else df.columns[0])


def spread(df: DataFrame, key: str) -> DataFrame:
    """Text work is CPU-bound per row.  When a *scan* yields fewer splits than
    the cluster has task slots (a few large row groups), hash-distribute the
    rows; a scan over many files already has enough splits and is untouched.
    (Only for plans without a shuffle: probing the partition count of an
    adaptive plan would execute it.)"""
    slots = df.sparkSession.sparkContext.defaultParallelism
    if df.rdd.getNumPartitions() < slots:
        return df.repartition(slots, key)
    return df


def widen(df: DataFrame, key: str) -> DataFrame:
    """After an aggregation that adaptive execution may have coalesced into a few
    partitions, hash-partition by ``key`` over at least all task slots: one shuffle
    of the (small) aggregate, so that later per-row work runs on every core."""
    spark = df.sparkSession
    n = max(spark.sparkContext.defaultParallelism, int(spark.conf.get("spark.sql.shuffle.partitions")))
    return df.repartition(n, key)


def documents(spark, sf_dir, *cols) -> DataFrame:
    return table(spark, sf_dir, "documents", *(cols or ("doc_id", "text", "lang", "source")))


def conversations(spark, sf_dir, *cols) -> DataFrame:
    return table(spark, sf_dir, "conversations", *(cols or ("conv_id", "turn", "role", "text")))


def text_files(spark: SparkSession, path: str, whole: bool = True) -> DataFrame:
    """Plain UTF-8 files as a corpus ``(doc_id, text)``; one file = one text when ``whole``."""
    from pyspark.sql import functions as F

    df = spark.read.text(path, wholetext=whole).withColumnRenamed("value", "text")
    return df.select(F.xxhash64(F.input_file_name(), F.col("text")).alias("doc_id"), "text")


def write_tokens(enc: DataFrame, path: str, partition_by: tuple = ("lang",), mode: str = "overwrite") -> None:
    """IO6: the encoded corpus ``(doc_id, ids, n_tokens, …)`` as a Parquet table,
    partitioned (e.g. by model and language) so later scans prune partitions."""
    enc.write.mode(mode).partitionBy(*partition_by).parquet(path)
