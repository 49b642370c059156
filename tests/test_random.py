"""Randomised differential tests: encode equals the single-process loop, decode∘encode = identity."""

import random

import bruteforce as BF
from support import CORPUS, texts_df
from toksmith.operators import decode as DE
from toksmith.operators import encode as EN
from toksmith.operators import train as TR

ALPHABET = ("abcdefghij ABC 0123456789 .,!?'\n\r\t" "éüßçñ" "世界こんにちは" "😊👩‍👧" " 　‍́\x00\x1c")


def random_texts(n, seed):
    rng = random.Random(seed)
    return ["".join(rng.choice(ALPHABET) for _ in range(rng.randint(0, 60))) for _ in range(n)]


def test_random_strings_roundtrip_and_match_loop(spark):
    texts = random_texts(300, 11)
    train_df = texts_df(spark, texts[:150] + [CORPUS])
    m, _ = TR.train_regex(train_df, 320)
    merges = [(x.left_id, x.right_id, x.new_id, x.freq) for x in m.merges]
    assert merges == BF.train_regex(texts[:150] + [CORPUS], 320)
    df = texts_df(spark, texts)
    enc = EN.encode(df, m).orderBy("doc_id").collect()
    assert [list(r.ids) for r in enc] == [BF.encode_regex(t, merges) for t in texts]
    back = DE.decode(EN.encode(df, m), m).orderBy("doc_id").collect()
    assert [r.text for r in back] == texts


def test_candidate_fold_equals_full_fold(spark):
    texts = random_texts(200, 5) + [CORPUS]
    m, _ = TR.train_regex(texts_df(spark, texts), 340)
    df = texts_df(spark, texts)
    a = EN.encode(df, m, strategy="dictionary").orderBy("doc_id").collect()
    b = EN.encode(df, m, strategy="inline").orderBy("doc_id").collect()
    assert [list(r.ids) for r in a] == [list(r.ids) for r in b]


def test_candidate_fold_whole_text_model(spark):
    texts = random_texts(80, 9) + [CORPUS, "", None]
    m, _ = TR.train_basic(texts_df(spark, [t for t in texts if t is not None]), 300)
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "doc_id long, text string")
    a = EN.encode(df, m, strategy="dictionary").orderBy("doc_id").collect()
    b = EN.encode(df, m, strategy="inline").orderBy("doc_id").collect()
    assert [r.ids for r in a] == [r.ids for r in b]


def test_candidate_fold_char_model(spark):
    texts = random_texts(60, 3) + [CORPUS, ""]
    train = [CORPUS] + texts[:20]
    alphabet = set("".join(t.replace(" ", "▁") for t in train))
    m, _ = TR.train_char(texts_df(spark, train), 3 + len(alphabet) + 30, add_bos=True, add_eos=True)
    df = texts_df(spark, texts + ["ZZZ unseen ✓ chars"])
    a = EN.encode(df, m, strategy="dictionary").orderBy("doc_id").collect()
    b = EN.encode(df, m, strategy="inline").orderBy("doc_id").collect()
    assert [list(r.ids) for r in a] == [list(r.ids) for r in b]
