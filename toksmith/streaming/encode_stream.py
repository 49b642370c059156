"""Tokenize a stream of texts: ``readStream`` → encode → ``writeStream``.

Encoding is a per-row expression with the model as a constant, so it needs
no state, no watermark and no shuffle; the checkpoint location of the sink
gives exactly-once output with replayable sources.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery

from toksmith.model import Model
from toksmith.operators import encode as EN


def encode_stream(src: DataFrame, model: Model, text_col: str = "text", id_col: str = "doc_id",
                  allowed_special="none_raise") -> DataFrame:
    if not src.isStreaming:
        raise ValueError("expected a streaming DataFrame")
    return EN.encode(src, model, text_col, id_col, allowed_special)


def start_parquet_sink(spark: SparkSession, enc: DataFrame, path: str, checkpoint: str) -> StreamingQuery:
    """Append encoded rows to a Parquet table; ``checkpoint`` must be a shared folder."""
    return enc.writeStream.format("parquet").option("path", path).option("checkpointLocation", checkpoint) \
        .outputMode("append").start()
