"""Merges, IDs and pieces in Arrow batches equal a plain loop, and a repeated word is folded once."""

import random

import pytest
from pyspark.sql import functions as F

from toksmith.functions.symbols import CHUNK_SEP, cp_to_id, sym, syms
from toksmith.model import Merge, Model
from toksmith.operators import batches as B
from toksmith.operators import decode as DE
from toksmith.operators import encode as EN
from toksmith.operators import metrics as MX
from toksmith.operators import regularize as RG

MERGES = [(97, 98), (99, 99), (256, 99), (257, 257), (97, 97), (258, 260), (32, 97), (262, 98)]
MODEL = Model("basic", [Merge(i, a, b, 256 + i, 1) for i, (a, b) in enumerate(MERGES)])


def looped(text, model=MODEL):
    for m in model.merges:
        text = text.replace(sym(m.left_id) + sym(m.right_id), sym(m.new_id))
    return text


def texts():
    r = random.Random(5)
    rows = ["".join(r.choice("aabbcc  é") for _ in range(r.choice([0, 1, 2, 7, 300]))) for _ in range(200)]
    return [None, "", *rows, None, "abc" * 4000, ""]


def test_fold_equals_the_loop(spark):
    rows = list(enumerate(texts()))
    df = spark.createDataFrame(rows, "i long, s string").coalesce(1)
    got = dict(df.select("i", B.fold(F.col("s"), MODEL)).collect())
    assert got == {i: None if t is None else looped(t) for i, t in rows}
    half = Model("basic", MODEL.merges[:3])  # folding on from symbols that were merged before
    rest = Model("basic", MODEL.merges[3:])
    assert dict(df.select("i", B.fold(B.fold(F.col("s"), half), rest)).collect()) == got
    chunks = dict(df.select("i", B.fold(F.replace("s", F.lit(" "), F.lit(CHUNK_SEP)), MODEL, joined=True)).collect())
    assert chunks == {i: None if t is None else "".join(looped(c) for c in t.split(" ")) for i, t in rows}


def test_slices_and_borders():
    import pyarrow as pa

    rows = pa.array(["a" * 10, None, "", "b" * (B.SLICE + 5), "c", "d" * B.SLICE])
    parts = list(B._slices(rows))
    assert pa.concat_arrays(parts).to_pylist() == rows.to_pylist() and len(parts) > 2
    assert all(len(p) == 1 or sum(len(t or "") for t in p.to_pylist()) <= B.SLICE for p in parts)


def test_a_repeated_word_is_folded_once():
    import pyarrow as pa

    seen = []
    words = pa.array(["ab ", "cc ", "ab "] * 10_000)

    class Between(str):
        def join(self, parts):
            parts = list(parts)
            seen.append(parts)
            return str(self).join(parts)

    out = B._replaced(words, [("ab", "X")], Between(CHUNK_SEP))
    assert seen == [["ab ", "cc "]] and out.to_pylist() == ["X ", "cc ", "X "] * 10_000


def test_ids_and_pieces(spark):
    df = spark.createDataFrame([(0, None), (1, ""), (2, syms([5, 0xD7FF, 0xD800, 70_000]))], "i long, s string")
    assert dict(df.select("i", B.symbols_ids(F.col("s"))).collect()) == {0: None, 1: [], 2: [5, 0xD7FF, 0xD800, 70_000]}
    ids = spark.createDataFrame([(0, None), (1, []), (2, [97, 256, None, 999, -1, 258])], "i long, ids array<int>")
    skipped = dict(ids.select("i", DE.decode_bytes_column("ids", MODEL)).collect())
    assert skipped == {0: None, 1: b"", 2: b"aababc"}
    with pytest.raises(Exception, match="invalid token id"):
        ids.select(DE.decode_column("ids", MODEL)).collect()
    char = Model("char", [], alphabet="a<0x>4", byte_fallback=True)
    assert cp_to_id(ord(sym(3))) == 3
    back = spark.createDataFrame([([3, char.first_byte_id + 0xC3, char.first_byte_id + 0xA9, 1, 0, 99_999],)], "ids array<int>")
    assert back.select(DE.decode_column("ids", char)).first()[0] == "aé<unk><unk>"


def test_special_tokens_stand_between_the_chunks(spark):
    m = Model("regex", [Merge(0, 97, 98, 256, 1)], pattern="gpt4", specials={"<|x|>": 400})
    df = spark.createDataFrame([(0, "ab<|x|>ab ab"), (1, "<|x|><|x|>"), (2, None), (3, "a")], "doc_id long, text string")
    got = {r.doc_id: r.ids for r in EN.encode(df, m, allowed_special="all").collect()}
    assert got == {0: [256, 400, 256, 32, 256], 1: [400, 400], 2: None, 3: [97]}


def test_dropout_skips_merges_by_row(spark):
    m = Model("regex", MODEL.merges, pattern="gpt4")
    rows = [(k, "abcc abcc ccc") for k in range(40)] + [(None, "abcc"), (7, None)]
    got = spark.createDataFrame(rows, "k long, t string").select("k", "t", RG.dropout_symbols(F.col("t"), F.col("k"), m, 0.4, 3).alias("s")).collect()

    def one(k, t):
        kept = [x for i, x in enumerate(m.merges, 1) if k is None or (k * RG.HASH_MULT + i * RG.HASH_STEP + 3) % RG.HASH_MOD >= int(0.4 * RG.HASH_MOD)]
        return "".join(looped(c, Model("basic", kept)) for c in (["abcc", " abcc", " ccc"] if " " in t else [t]))

    assert all(r.s == (None if r.t is None else one(r.k, r.t)) for r in got)


def test_perplexity_with_null_pieces_and_logprobs(spark):
    rows = [("m", b"a", -1.0), ("m", b"a", None), ("m", None, -2.0), ("m", b"\xc3\xa9", -0.5), ("n", b"\xa9", None)]
    got = {r.model: r for r in MX.perplexity_by_model(spark.createDataFrame(rows, "model string, piece binary, logprob double")).collect()}
    assert got["m"].n_tokens == 3 and abs(got["m"].perplexity - 2.718281828 ** (3.5 / 3)) < 1e-5
    bits = 3.5 / 0.6931471805599453
    assert abs(got["m"].bits_per_char - bits / 3) < 1e-5 and abs(got["m"].bits_per_byte - bits / 4) < 1e-5
    assert got["n"].n_tokens == 0 and got["n"].perplexity is None


def encodings(df):
    """How often the plan folds merges."""
    return df._jdf.queryExecution().optimizedPlan().toString().count("ArrowEvalPython [")


def test_the_encoding_runs_once_for_what_is_read_from_it(spark):
    from toksmith.operators import windows as WN
    from toksmith.plans import catalog, results

    df = spark.createDataFrame([(1, "abcc abcc", "x"), (2, None, "x"), (3, "", "y"), (4, "cc", None)], "doc_id long, text string, lang string")
    enc = EN.encode(df, MODEL, keep=("lang",))
    assert encodings(enc.select("doc_id", F.posexplode(EN.each()))) == 1
    assert [tuple(r) for r in enc.select("doc_id", F.posexplode(EN.each())).orderBy("doc_id", "pos").collect()] == [
        tuple(r) for r in enc.select("doc_id", F.posexplode("ids")).orderBy("doc_id", "pos").collect()]
    packed = WN.context_rows(enc.select("doc_id", "ids"), 4, 400, buckets=1)
    stored = packed._jdf.queryExecution().executedPlan().toString().split("InMemoryRelation")[1:]
    assert stored and all(p.count("ArrowEvalPython [") == 1 for p in stored)
    catalog._MODELS[("regex", "no table", catalog.REGEX_VOCAB)] = Model("regex", MODEL.merges, pattern="gpt4")
    whole = catalog._docs
    try:
        catalog._docs = lambda *_: df.withColumn("source", F.lit("s"))
        assert encodings(results.logprob_table(spark, "no table")) == 2  # the shares, and the tokens
    finally:
        catalog._docs = whole
        del catalog._MODELS[("regex", "no table", catalog.REGEX_VOCAB)]
