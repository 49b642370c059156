"""Special tokens: registration, segmentation, policy and screening."""

from __future__ import annotations

from dataclasses import replace as dc_replace

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from toksmith.functions import patterns
from toksmith.model import Model
from toksmith.operators import encode as EN


def register_specials(model: Model, specials: dict[str, int]) -> Model:
    """A model with this set of special tokens (replaces the previous set).
    Rejects an ID that is already a byte/merge ID or used twice, and empty tokens."""
    ids = list(specials.values())
    if len(set(ids)) != len(ids):
        raise ValueError("two special tokens share an ID")
    if any(not t for t in specials):
        raise ValueError("empty special token")
    m = dc_replace(model, specials=dict(specials))
    m.check()
    return m


def segments(df: DataFrame, tokens, text_col: str = "text", id_col: str = "doc_id") -> DataFrame:
    """P10: ``(doc_id, seg_pos, segment, is_special)``; longest token first (L2)."""
    pat = patterns.segment_pattern(list(tokens))
    ex = df.select(F.col(id_col).alias("doc_id"),
                   F.posexplode(F.regexp_extract_all(F.col(text_col), F.lit(pat), 0)).alias("seg_pos", "segment"))
    return ex.withColumn("is_special", F.col("segment").isin(list(tokens)))


def policy_split(df: DataFrame, model: Model, text_col: str = "text") -> tuple[DataFrame, DataFrame]:
    """P11 ``none_raise`` for bulk jobs: (clean rows, rejected rows) instead of an exception."""
    bad = EN.contains_special(F.col(text_col), model.specials)
    return df.where(~bad | F.col(text_col).isNull()), df.where(bad)


def screen(df: DataFrame, tokens, text_col: str = "text", id_col: str = "doc_id") -> DataFrame:
    """Occurrences of special-token strings in user text: ``(doc_id, token, n)``."""
    alt = patterns.special_alternation(list(tokens))
    ex = df.select(F.col(id_col).alias("doc_id"), F.explode(F.regexp_extract_all(F.col(text_col), F.lit(alt), 0)).alias("token"))
    return ex.groupBy("doc_id", "token").agg(F.count(F.lit(1)).alias("n"))


def strip(text, tokens):
    """X16 option: remove special-token strings from text, those that a removal makes included: it is
    repeated until none is left (each pass takes a token out, which bounds the passes)."""
    text = F.col(text) if isinstance(text, str) else text
    alt = patterns.special_alternation(list(tokens))
    once = F.regexp_replace(text, alt, "")
    passes = F.sequence(F.lit(0), F.floor(F.length(text) / min(map(len, tokens))).cast("int"))
    rest = F.aggregate(passes, once, lambda acc, _: F.when(acc.rlike(alt), F.regexp_replace(acc, alt, "")).otherwise(acc))
    return F.when(once.rlike(alt), rest).otherwise(once)
