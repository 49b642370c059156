"""Regex pre-split and the chunk dictionary.

Merges never cross a chunk boundary, so training and encoding only need each
*distinct* chunk once, with its frequency and its first position in corpus
order (ascending ``doc_id``, then chunk position) for exact tie-breaking.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import IntegralType

from toksmith.functions import patterns
from toksmith.functions.symbols import byte_symbols


def split_column(text, pattern: str | None = None):
    """``regexp_extract_all`` with the (Unicode-flagged) split pattern."""
    text = F.col(text) if isinstance(text, str) else text
    return F.regexp_extract_all(text, F.lit(patterns.java_pattern(pattern)), 0)


def split_chunks(
    df: DataFrame, pattern: str | None = None, text_col: str = "text", id_col: str = "doc_id"
) -> DataFrame:
    """``(doc_id, chunk_pos, chunk)``: one row per pre-split chunk; chunk_pos is 0-based."""
    return df.select(
        F.col(id_col).alias("doc_id"),
        F.posexplode(split_column(text_col, pattern)).alias("chunk_pos", "chunk"),
    )


_SPAN = 1 << 31  # chunk positions of a document
_NULL_ID = -(1 << 63) - 1  # stands for a null id: before all others


def _counted(rows: DataFrame) -> DataFrame:
    """``(chunk, n, first)`` of rows ``(doc_id, chunk, chunk_pos)``.  The smallest ``(doc_id, chunk_pos)`` of whole-number ids
    is taken as one decimal: a struct has no fixed width, and Spark would sort all rows for its minimum."""
    n, kind = F.count(F.lit(1)).alias("n"), rows.schema["doc_id"].dataType
    if not isinstance(kind, IntegralType):
        return rows.groupBy("chunk").agg(n, F.min(F.struct("doc_id", "chunk_pos")).alias("first"))
    span = F.lit(_SPAN).cast("decimal(10,0)")
    key = F.coalesce(F.col("doc_id").cast("decimal(20,0)"), F.lit(str(_NULL_ID)).cast("decimal(20,0)")) * span + F.col("chunk_pos").cast("decimal(10,0)")
    d = rows.select("chunk", key.alias("key")).groupBy("chunk").agg(n, F.min("key").alias("key"))
    d = d.withColumn("pos", F.pmod("key", span)).withColumn("id", ((F.col("key") - F.col("pos")) / span).cast("decimal(20,0)"))
    doc = F.when(F.col("id") != F.lit(str(_NULL_ID)).cast("decimal(20,0)"), F.col("id")).cast(kind)
    return d.select("chunk", "n", F.struct(doc.alias("doc_id"), F.col("pos").cast("int").alias("chunk_pos")).alias("first"))


def chunk_dictionary(chunks: DataFrame) -> DataFrame:
    """``(chunk, n, first)``: distinct chunks with count and first occurrence.

    A partial (map-side) hash aggregate runs before the shuffle, so a chunk
    that holds a large share of all rows (" the") costs one row per map task.
    """
    return _counted(chunks)


def text_dictionary(df: DataFrame, text_col: str = "text", id_col: str = "doc_id") -> DataFrame:
    """Whole texts as one chunk each (no pre-split): identical texts are merged."""
    rows = df.where(F.col(text_col).isNotNull())
    return _counted(rows.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("chunk"), F.lit(0).alias("chunk_pos")))


def with_byte_symbols(d: DataFrame, col: str = "chunk") -> DataFrame:
    return d.withColumn("sym", byte_symbols(col))
