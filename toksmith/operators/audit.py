"""Audits of a tokenizer against a corpus and of a vocabulary."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from toksmith.functions import patterns
from toksmith.functions.symbols import valid_utf8
from toksmith.model import Model
from toksmith.operators import decode as DE
from toksmith.operators import encode as EN
from toksmith.operators import metrics as MX


def roundtrip(df: DataFrame, model: Model, by: str = "lang", text_col: str = "text",
              id_col: str = "doc_id") -> DataFrame:
    """Q1: decode(encode(text)) = text, counted per group; mismatches are kept, not dropped."""
    s = EN.encode_column(F.col(text_col), model, "all" if model.specials else "none_raise")
    back = DE.decode_column(s, model, "skip")
    return df.select(by, (back == F.col(text_col)).alias("ok")).groupBy(by).agg(
        F.count(F.lit(1)).alias("n_docs"),
        F.sum(F.col("ok").cast("int")).cast("bigint").alias("n_ok"),
    )


def vocab_table(spark: SparkSession, model: Model) -> DataFrame:
    """(id, piece_hex, kind) of every vocabulary entry."""
    return model.vocab_df(spark).select(F.col("id").cast("bigint"), F.hex("piece").alias("piece_hex"), "kind")


def render_piece(piece: Column) -> Column:
    """Printable form of a piece: UTF-8 with U+FFFD; control, separator and
    the four whitespace characters written as ``\\xNN`` of the code point."""
    chars = F.split(valid_utf8(piece), "")
    esc = F.transform(chars, lambda c: F.when(
        c.rlike(r"^[\p{C}\p{Z}]$"), F.format_string("\\x%02x", F.ascii(c))).otherwise(c))
    return F.array_join(esc, "")


def vocab_listing(spark: SparkSession, model: Model) -> DataFrame:
    """IO5: ``[%6d] token`` lines in ID order (write with ``.write.text``)."""
    v = model.vocab_df(spark)
    return v.select("id", F.format_string("[%6d] %s", "id", render_piece(F.col("piece"))).alias("line"))


def unknown_ids(enc: DataFrame, model: Model) -> DataFrame:
    """(doc_id, id) for IDs that the vocabulary does not hold."""
    return enc.select("doc_id", F.explode(DE.unknown_ids("ids", model)).alias("id"))


def usage(freq: DataFrame, vocab: DataFrame) -> DataFrame:
    """Every vocabulary entry with its corpus count (0 when unused)."""
    return vocab.join(freq, "id", "left").select(vocab["*"], F.coalesce(freq["n"], F.lit(0)).alias("n"))


def rare_tokens(freq: DataFrame, vocab: DataFrame, below: int = 100) -> DataFrame:
    """Q7: vocabulary entries seen fewer than ``below`` times."""
    return usage(freq, vocab).where(F.col("n") < below)


def unused_tokens(freq: DataFrame, vocab: DataFrame) -> DataFrame:
    """Vocabulary entries never produced on the corpus (anti-join)."""
    return vocab.join(freq, "id", "left_anti")


def mixed_letter_digit(vocab: DataFrame) -> DataFrame:
    """Q14: pieces that contain both a letter and a digit (must be empty for pre-split models)."""
    text = valid_utf8(F.col("piece"))
    return vocab.where(text.rlike(r"\p{L}.*\p{N}|\p{N}.*\p{L}"))


def oov_rate(df: DataFrame, model: Model, by: str = "lang", text_col: str = "text") -> DataFrame:
    """Q19: share of characters outside a char model's alphabet, by group."""
    base = EN.char_base_symbols(F.col(text_col), model)
    unk = patterns.SP_UNK
    x = df.select(by, F.length(base).alias("n"),
                  (F.length(base) - F.length(F.replace(base, F.lit(chr(unk)), F.lit("")))).alias("u"))
    return x.groupBy(by).agg(F.sum("n").cast("bigint").alias("n_chars"), F.sum("u").cast("bigint").alias("n_unk")) \
        .withColumn("oov_rate", MX.r6(F.col("n_unk") / F.col("n_chars")))


def oov_chars(df: DataFrame, model: Model, text_col: str = "text") -> DataFrame:
    """Q19: characters outside the alphabet with their counts."""
    alpha = set(model.alphabet) | {" "}
    ex = df.select(F.explode(F.split(F.col(text_col), "")).alias("ch")).where(F.col("ch") != "")
    cls = EN._char_class(model.alphabet + " ") if model.alphabet else None
    ex = ex.where(~F.col("ch").rlike(f"^[{cls}]$")) if cls else ex
    del alpha
    return ex.groupBy("ch").agg(F.count(F.lit(1)).alias("n"))
