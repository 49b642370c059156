"""Model sinks and sources (IO2, IO3): four Parquet tables plus a JSON interchange file.

JSON form: ``{"pattern"?: str, "merges": [[[left, right], new_id], ...],
"special_tokens": {token: id}, "kind": str, "alphabet"?: str, "add_bos"?: bool,
"add_eos"?: bool}``; the array position of a merge is its rank.  Files without
``kind`` are regex models if they have a pattern.
"""

from __future__ import annotations

import json

from pyspark.sql import SparkSession
from pyspark.sql import functions as F

from toksmith.functions import patterns
from toksmith.model import MAX_MODEL_ROWS, Merge, Model


def save(spark: SparkSession, model: Model, path: str, mode: str = "overwrite") -> None:
    """Write ``merges``, ``vocab``, ``specials`` and ``model_meta`` tables under ``path``."""
    model.merges_df(spark).coalesce(1).write.mode(mode).parquet(f"{path}/merges")
    model.vocab_df(spark).coalesce(1).write.mode(mode).parquet(f"{path}/vocab")
    model.specials_df(spark).coalesce(1).write.mode(mode).parquet(f"{path}/specials")
    model.meta_df(spark).coalesce(1).write.mode(mode).parquet(f"{path}/model_meta")


def load(spark: SparkSession, path: str) -> Model:
    """Read a saved model (tables are bounded by the vocabulary size)."""
    meta = spark.read.parquet(f"{path}/model_meta").first()
    merges = spark.read.parquet(f"{path}/merges").orderBy("rank").limit(MAX_MODEL_ROWS + 1).collect()
    if len(merges) > MAX_MODEL_ROWS:
        raise ValueError("model too large")
    sp = spark.read.parquet(f"{path}/specials").collect()
    m = Model(meta["kind"], [Merge(r["rank"], r["left_id"], r["right_id"], r["new_id"], r["freq"], r["total_tokens"])
                             for r in merges],
              pattern=meta["pattern"], alphabet=meta["alphabet"] or "", add_bos=meta["add_bos"],
              add_eos=meta["add_eos"])
    if m.byte_level:
        m.specials = {r["token"]: r["id"] for r in sp}
    return m


def to_json(model: Model) -> str:
    d = {}
    if model.kind == "regex":
        d["pattern"] = model.pattern
    d["merges"] = [[[m.left_id, m.right_id], m.new_id] for m in model.merges]
    d["special_tokens"] = dict(model.specials)
    d["kind"] = model.kind
    if model.kind == "char":
        d |= {"alphabet": model.alphabet, "add_bos": model.add_bos, "add_eos": model.add_eos}
    return json.dumps(d)


def save_json(spark: SparkSession, model: Model, path: str) -> None:
    """JSON interchange file, written by Spark as one text part."""
    spark.createDataFrame([(to_json(model),)], "value STRING").coalesce(1).write.mode("overwrite").text(path)


def load_json(spark: SparkSession, path: str, kind: str | None = None) -> Model:
    """Read the JSON form: ``from_json`` + ``posexplode(merges)`` (position = rank).  ``kind`` speaks for
    files that name none; a regex model without a pattern has the GPT-4 pattern."""
    schema = ("pattern STRING, merges ARRAY<ARRAY<STRING>>, special_tokens MAP<STRING, INT>, kind STRING, alphabet STRING, "
              "add_bos BOOLEAN, add_eos BOOLEAN")
    raw = spark.read.text(path, wholetext=True).select(F.from_json("value", schema).alias("j"))
    ms = raw.select(F.posexplode("j.merges").alias("rank", "m")).select(
        "rank", F.from_json(F.col("m")[0], "array<int>").alias("pair"), F.col("m")[1].cast("int").alias("new_id"))
    rows = ms.orderBy("rank").limit(MAX_MODEL_ROWS + 1).collect()
    if len(rows) > MAX_MODEL_ROWS:
        raise ValueError("model too large")
    j = raw.select("j.pattern", "j.special_tokens", "j.kind", "j.alphabet", "j.add_bos", "j.add_eos").first()
    kind = j["kind"] or kind or "regex"
    if kind == "char" and j["alphabet"] is None:
        raise ValueError("a char model needs its alphabet")
    pattern = (j["pattern"] or patterns.GPT4_SPLIT_PATTERN) if kind == "regex" else None
    return Model(kind, [Merge(r["rank"], r["pair"][0], r["pair"][1], r["new_id"], 0) for r in rows], pattern=pattern,
                 specials=dict(j["special_tokens"] or {}), alphabet=j["alphabet"] or "", add_bos=bool(j["add_bos"]), add_eos=bool(j["add_eos"]))
