"""Special tokens, model persistence, windows and streaming."""

import os
import tempfile

import pytest
from pyspark.sql import functions as F

from support import texts_df
from toksmith.operators import decode as DE
from toksmith.operators import encode as EN
from toksmith.streaming.encode_stream import encode_stream
from toksmith.operators import specials as SP
from toksmith.operators import train as TR
from toksmith.operators import windows as WN
from toksmith.sources import model_io

SPECIALS = {"<|endoftext|>": 400, "<|pad|>": 401}


@pytest.fixture(scope="module")
def model(spark, corpus_df):
    return SP.register_specials(TR.train_regex(corpus_df, 300)[0], SPECIALS)


def test_specials_all_and_roundtrip(spark, model):
    df = texts_df(spark, ["hello <|endoftext|> world", "<|pad|><|endoftext|>x"])
    r = EN.encode(df, model, allowed_special="all").orderBy("doc_id").collect()
    assert 400 in r[0].ids and r[1].ids[:2] == [401, 400]
    back = DE.decode(EN.encode(df, model, allowed_special="all"), model).orderBy("doc_id").collect()
    assert [x.text for x in back] == ["hello <|endoftext|> world", "<|pad|><|endoftext|>x"]


def test_specials_none_encodes_as_text_and_none_raise_raises(spark, model):
    df = texts_df(spark, ["hello <|endoftext|> world"])
    r = EN.encode(df, model, allowed_special="none").first()
    assert 400 not in r.ids
    with pytest.raises(Exception):
        EN.encode(df, model).collect()
    with pytest.raises(ValueError):
        EN.allowed_specials(model, "bogus")
    subset = EN.encode(df, model, allowed_special={"<|pad|>"}).first()
    assert 400 not in subset.ids


def test_prefix_specials_longest_first(spark, model):
    m = SP.register_specials(model, {"<a>": 500, "<a><b>": 501})
    r = EN.encode(texts_df(spark, ["x<a><b>y<a>"]), m, allowed_special="all").first()
    assert 501 in r.ids and 500 in r.ids
    seg = SP.segments(texts_df(spark, ["x<a><b>y<a>"]), ["<a>", "<a><b>"]).orderBy("seg_pos").collect()
    assert [s.segment for s in seg] == ["x", "<a><b>", "y", "<a>"]


def test_policy_split(spark, model):
    df = texts_df(spark, ["ok text", "bad <|pad|>"])
    clean, rej = SP.policy_split(df, model)
    assert [r.doc_id for r in clean.collect()] == [0] and [r.doc_id for r in rej.collect()] == [1]


def test_special_collision_rejected(model):
    with pytest.raises(ValueError):
        SP.register_specials(model, {"<x>": 256})


def test_model_save_load_parquet_and_json(spark, model):
    d = tempfile.mkdtemp(prefix="toksmith-model-")
    model_io.save(spark, model, os.path.join(d, "m"))
    back = model_io.load(spark, os.path.join(d, "m"))
    assert [(m.left_id, m.right_id, m.new_id) for m in back.merges] == [(m.left_id, m.right_id, m.new_id) for m in model.merges]
    assert back.specials == model.specials and back.pattern == model.pattern
    model_io.save_json(spark, model, os.path.join(d, "j"))
    j = model_io.load_json(spark, os.path.join(d, "j"))
    assert [(m.left_id, m.right_id, m.new_id) for m in j.merges] == [(m.left_id, m.right_id, m.new_id) for m in model.merges]
    df = texts_df(spark, ["the quick brown fox"])
    assert EN.encode(df, j).first().ids == EN.encode(df, model).first().ids


def test_windows_and_packing(spark):
    df = spark.createDataFrame([(0, list(range(10))), (1, [])], "doc_id long, ids array<int>")
    w = WN.token_windows(df, 4, 1).orderBy("doc_id", "window").collect()
    assert [list(x.ids) for x in w] == [[0, 1, 2, 3], [3, 4, 5, 6], [6, 7, 8, 9], [9]]
    e = spark.createDataFrame([(i, n) for i, n in enumerate([5, 0, 7, 3])], "doc_id long, n_tokens int")
    p = WN.pack(e, 8, buckets=3).orderBy("doc_id").collect()
    assert [x.offset for x in p] == [0, 6, 7, 15] and [x.first_context for x in p] == [0, 0, 0, 1]


def test_streaming_encode_smoke(spark, model):
    d = tempfile.mkdtemp(prefix="toksmith-stream-")
    texts_df(spark, ["hello world", "the fox"]).write.parquet(os.path.join(d, "in"))
    src = spark.readStream.schema("doc_id long, text string").parquet(os.path.join(d, "in"))
    q = (encode_stream(src, model).writeStream.format("memory").queryName("enc_stream")
         .option("checkpointLocation", os.path.join(d, "ck")).start())
    q.processAllAvailable()
    q.stop()
    got = spark.sql("select * from enc_stream").orderBy("doc_id").collect()
    assert [list(r.ids) for r in got] == [list(r.ids) for r in EN.encode(texts_df(spark, ["hello world", "the fox"]), model).orderBy("doc_id").collect()]


def test_strip_specials_and_token_sink(spark, model):
    df = texts_df(spark, ["a<|pad|>b<|endoftext|>"])
    assert df.select(SP.strip(F.col("text"), list(SPECIALS)).alias("t")).first().t == "ab"
    from toksmith.sources import corpus
    d = tempfile.mkdtemp(prefix="toksmith-tokens-")
    enc = EN.encode(texts_df(spark, ["x y", "z"]).withColumn("lang", F.lit("en")), model, keep=(F.col("lang"),))
    corpus.write_tokens(enc, os.path.join(d, "t"))
    back = spark.read.parquet(os.path.join(d, "t")).where(F.col("lang") == "en")
    assert back.count() == 2


def test_budget_splits_hot_group_exactly(spark):
    rows = [(0, t, (t * 7) % 5) for t in range(50)] + [(1, t, 3) for t in range(4)]
    df = spark.createDataFrame(rows, "conv_id long, turn long, n_tokens long")
    got = {(r.conv_id, r.turn): (r.cum_tokens, r.fits) for r in WN.budget(df, "conv_id", "turn", "n_tokens", 40, span=8).collect()}
    want, acc = {}, {}
    for c, t, n in rows:
        acc[c] = acc.get(c, 0) + n
        want[(c, t)] = (acc[c], acc[c] <= 40)
    assert got == want


def test_packing_many_buckets_equals_running_sum(spark):
    import random
    rng = random.Random(4)
    ids = rng.sample(range(10_000), 300)
    lens = {i: rng.randint(0, 50) for i in ids}
    e = spark.createDataFrame([(i, n) for i, n in lens.items()], "doc_id long, n_tokens int")
    got = {r.doc_id: (r.offset, r.first_context, r.last_context) for r in WN.pack(e, 64, buckets=16).collect()}
    acc, want = 0, {}
    for i in sorted(ids):
        ln = lens[i] + 1
        want[i] = (acc, acc // 64, (acc + ln - 1) // 64)
        acc += ln
    assert got == want


def test_oov_rate_and_chars(spark):
    from toksmith.model import Model
    from toksmith.operators import audit as AU
    m = Model("char", [], alphabet="ab▁")
    df = spark.createDataFrame([("x", "ab cd"), ("x", "ba")], "lang string, text string")
    r = AU.oov_rate(df, m).first()
    assert (r.n_chars, r.n_unk) == (7, 2)
    assert {x.ch: x.n for x in AU.oov_chars(df, m).collect()} == {"c": 1, "d": 1}


def test_json_without_pattern_defaults_to_gpt4(spark):
    from toksmith.functions import patterns
    d = tempfile.mkdtemp(prefix="toksmith-json-")
    spark.createDataFrame([('{"merges": [[[116, 104], 256]], "special_tokens": {}}',)], "value string") \
        .coalesce(1).write.text(os.path.join(d, "m"))
    m = model_io.load_json(spark, os.path.join(d, "m"))
    assert m.pattern == patterns.GPT4_SPLIT_PATTERN and [(x.left_id, x.right_id, x.new_id) for x in m.merges] == [(116, 104, 256)]
    assert EN.encode(texts_df(spark, ["the"]), m).first().ids == [256, 101]


def test_hot_cold_join_equals_plain_join_with_a_hot_key(spark):
    from toksmith.operators.joins import hot_cold_join
    probe = spark.createDataFrame([(i, "hot" if i % 3 == 0 else f"k{i % 50}") for i in range(3000)], "doc_id long, chunk string")
    build = spark.createDataFrame([("hot", 1)] + [(f"k{i}", i) for i in range(50)], "chunk string, v int")
    counts = probe.groupBy("chunk").count().withColumnRenamed("count", "n")
    for c in (None, counts):
        got = sorted(tuple(r) for r in hot_cold_join(probe, build, "chunk", min_share=0.2, counts=c).select("doc_id", "chunk", "v").collect())
        want = sorted(tuple(r) for r in probe.join(build, "chunk").select("doc_id", "chunk", "v").collect())
        assert got == want


def test_hot_keys_are_few_on_small_probes(spark):
    """Below ``1 / min_share`` rows a share is less than a row; a key must still hold a whole one."""
    from toksmith.operators.joins import hot_keys

    probe = spark.range(15).selectExpr("cast(id as string) as chunk")
    assert hot_keys(probe, "chunk", min_share=0.1).count() == 0  # 1.5 rows: no key of one row
    assert hot_keys(probe.unionAll(probe.where("chunk < '2'")), "chunk", min_share=0.1).count() <= 10
