"""Operators that return whole rows, against plain loops."""

import math
import random

import pytest
from pyspark.sql import functions as F

import bruteforce as BF
from support import CORPUS, texts_df
from toksmith.functions.symbols import cp_to_id, syms
from toksmith.model import Merge, Model
from toksmith.operators import decode as DE
from toksmith.operators import encode as EN
from toksmith.operators import metrics as MX
from toksmith.operators import pretokenize as PT
from toksmith.operators import train as TR
from toksmith.operators import unigram as UG
from toksmith.operators import vocabulary as VO
from toksmith.operators import windows as WN


def byte_model(*pairs, kind="basic"):
    return Model(kind, [Merge(i, a, b, 256 + i, 1) for i, (a, b) in enumerate(pairs)])


@pytest.mark.parametrize("buckets", [None, 3])
def test_packed_contexts_with_a_long_document(spark, buckets):
    rng = random.Random(2)
    docs = {i: [rng.randrange(50) for _ in range(rng.choice([0, 1, 3, 7, 8]))] for i in range(40)} | {17: list(range(1000)), 5: None, -3: [9]}
    df = spark.createDataFrame(list(docs.items()), "doc_id long, ids array<int>").repartition(5)
    got = {r.context_id: list(r.ids) for r in WN.context_rows(df, 8, 99, buckets=buckets).collect()}
    flat = [t for d in sorted(docs) if docs[d] is not None for t in [*docs[d], 99]]
    assert got == {i: flat[i * 8:i * 8 + 8] for i in range(math.ceil(len(flat) / 8))}
    empty = spark.createDataFrame([], "doc_id long, ids array<int>")
    assert WN.context_rows(empty, 8, 99).count() == 0


def test_chunk_rows_flag_cut_characters(spark):
    m = byte_model((0xC3, 0xA9), (0xE6, 0x97), (0xF0, 0x9F))  # é as one token, 日 as two, an emoji as three
    texts = ["é日🙂aé", "日日", "", None, "plain", "🙂", "́é"]
    got = WN.chunk_rows(EN.encode(texts_df(spark, texts), m), m, 2, 1).collect()
    pieces = m.pieces()
    assert got
    for r in got:
        raw = texts[r.doc_id].encode()
        ids = [list(x.ids) for x in EN.encode(texts_df(spark, [texts[r.doc_id]]), m).collect()][0]
        a = sum(len(pieces[i]) for i in ids[:r.start])
        b = a + sum(len(pieces[i]) for i in r.ids)
        whole = lambda at: at in (0, len(raw)) or raw[at] & 0xC0 != 0x80
        assert (r.starts_inside, r.ends_inside) == (not whole(a), not whole(b)), (texts[r.doc_id], r)
        if whole(a) and whole(b):
            assert r.text == raw[a:b].decode()


def test_healing_lists(spark):
    m = byte_model((97, 98), (256, 99), (97, 99), (256, 256), (120, 121))
    prompts = spark.createDataFrame([(1, [97]), (2, [120, 256]), (3, [257]), (4, []), (5, None), (1, [97]), (6, [121])], "item long, ids array<int>")
    got = sorted((r.item, r.last_id, r.extension_id, bytes.fromhex(r.extension_hex)) for r in VO.healing(prompts, m, "item").collect())
    p = m.pieces()
    want = sorted((k, ids[-1], j, q) for k, ids in [(1, [97]), (2, [256]), (3, [257]), (1, [97]), (6, [121])] for j, q in p.items() if q.startswith(p[ids[-1]]) and len(q) > len(p[ids[-1]]))
    assert got == want and len(want) >= 8


def test_ngrams_and_greedy_rewriting(spark):
    m = byte_model((97, 98))
    seqs = ["abcabcabcab", "xyxyxyx", "abab", "", "aXb" * 4]
    enc = EN.encode_symbols(texts_df(spark, seqs), m)
    rows = VO.frequent_ngrams(enc, m, 5, 3).collect()
    assert all(len(r.gram) > 1 and r.saving == r.n * (len(r.gram) - 1) for r in rows)
    counted = {}
    for r in enc.collect():
        for k in (2, 3):
            for i in range(len(r.sym) - k + 1):
                counted[r.sym[i:i + k]] = counted.get(r.sym[i:i + k], 0) + 1
    pieces = set(m.pieces().values())
    spelled = lambda g: b"".join(m.pieces()[cp_to_id(ord(c))] for c in g)
    best = sorted(((-n * (len(g) - 1), g) for g, n in counted.items() if spelled(g) not in pieces))[:5]
    assert [(r.gram, r.saving) for r in rows] == [(g, -s) for s, g in best]
    new = VO.expanded([r.gram for r in rows], m)
    assert min(new.values()) == 257
    back = {i: g for g, i in new.items()}
    for r in enc.select("sym", VO.rewrite(F.col("sym"), new).alias("new")).collect():
        out, i = "", 0
        while i < len(r.sym):
            g = next((g for g in sorted(new, key=len, reverse=True) if r.sym.startswith(g, i)), r.sym[i])
            out += syms([new[g]]) if g in new else g
            i += len(g)
        assert r.new == out and "".join(back.get(cp_to_id(ord(c)), c) for c in out) == r.sym


def test_byte_fallback_round_trip(spark):
    m = Model("char", [Merge(0, 3, 4, 6, 1)], alphabet="ab▁", byte_fallback=True)
    texts = ["ab ba", "aéb", "日本 ab🙂🙂", "", None, "a\x00b", "é" * 300, "<0x41>", "\x1cab"]
    e = EN.encode(texts_df(spark, texts), m).orderBy("doc_id").collect()
    assert m.first_byte_id == 7 and m.vocab_size == 7 + 256
    assert list(e[1].ids) == [3, 7 + 0xC3, 7 + 0xA9, 4] and e[4].ids is None and list(e[3].ids) == []
    back = [r.text for r in DE.decode(EN.encode(texts_df(spark, texts), m), m).orderBy("doc_id").collect()]
    assert back == [t if t is None else t.strip() for t in texts]
    broken = spark.createDataFrame([(0, [3, 7 + 0xC3, 4])], "doc_id long, ids array<int>")
    assert DE.decode(broken, m).first().text == "a�b"
    for strategy in ("inline", "dictionary"):
        got = {r.doc_id: r.ids for r in EN.encode(texts_df(spark, texts), m, strategy=strategy).collect()}
        assert got == {r.doc_id: r.ids for r in e}


def test_pruning_closure_and_encoding(spark):
    m = byte_model((97, 98), (256, 99), (257, 257), (100, 101), (258, 100), (259, 101))
    merges = m.merges_df(spark).select(F.col("new_id").cast("long").alias("id"), "left_id", "right_id")
    gone = {r.id: r.rare for r in VO.pruned_ids(merges, spark.createDataFrame([(257,)], "id long")).collect()}
    assert gone == {257: True, 258: False, 260: False}
    small = VO.pruned_model(m, VO.pruned_ids(merges, spark.createDataFrame([(257,)], "id long")))
    text = "abcabcabdee"
    want = BF.encode_basic(text, [(x.left_id, x.right_id, x.new_id, 1) for x in small.merges])
    assert list(EN.encode(texts_df(spark, [text]), small).first().ids) == want
    assert VO.pruned_ids(merges, spark.createDataFrame([], "id long")).count() == 0


def test_seeds_and_size_of_the_unigram_vocabulary(spark):
    d = spark.createDataFrame([("abc", 3), ("abd", 2), ("x", 1)], "chunk string, n long")
    got = {r.piece: r.f for r in UG.seeds(d, 2, 3).collect()}
    assert got == {"a": 5, "b": 5, "c": 3, "d": 2, "x": 1, "ab": 5, "bc": 3, "abc": 3}  # the second count and its ties
    df = texts_df(spark, [CORPUS])
    assert UG.train(df, 120, max_len=5, em_iters=1, shrink=0.5).count() == 120
    with pytest.raises(ValueError, match="fewer than the 32000"):
        UG.train(df, 32000, max_len=3)


def test_occurrences_are_drawn_apart_and_again_alike(spark):
    v = spark.createDataFrame([(p, math.log(f)) for p, f in [("a", .2), ("b", .2), ("ab", .3), ("ba", .2), ("aba", .1)]], "piece string, logp double")
    chunks = spark.createDataFrame([(d, p, "abab" if p else "ba") for d in range(200) for p in range(3)], "doc_id long, chunk_pos int, chunk string")
    a, b = ({(r.doc_id, r.pos): tuple(r.ends) for r in UG.sample_occurrences(chunks.repartition(k), v, 3, seed=1).collect()} for k in (2, 7))
    assert a == b and len(a) == 600 and all(e[-1] == (4 if p else 2) for (_, p), e in a.items())
    twos = [e for (_, p), e in a.items() if not p]
    share = twos.count((2,)) / len(twos)  # P(ba) = .2 against .2 * .2 for b, a
    assert abs(share - .2 / .24) < .1 and len({e for (_, p), e in a.items() if p}) >= 4


def test_balanced_training_equals_a_loop_over_weighted_counts(spark):
    rows = [(i, t, g) for i, (t, g) in enumerate([("aab aab aab", "x"), ("bcbc bc", "y"), ("bcb", "y"), ("zz zz", None), (None, "x")])]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    weights = spark.createDataFrame([("x", 1000), ("y", 2500)], "lang string, weight long")
    m, _ = TR.train_balanced(docs, 260, "lang", weights)
    import regex
    from toksmith.functions import patterns
    seqs = [([*c.encode()], {"x": 1000, "y": 2500}[g]) for _, t, g in rows if t and g for c in regex.findall(patterns.resolve("gpt4"), t)]
    for merge in m.merges:
        count, first = {}, {}
        for k, (ids, w) in enumerate(seqs):
            for j, pair in enumerate(zip(ids, ids[1:], strict=False)):
                count[pair] = count.get(pair, 0) + w
                first.setdefault(pair, (k, j))
        pair = min(count, key=lambda p: (-count[p], first[p]))
        assert (merge.left_id, merge.right_id, merge.freq) == (*pair, count[pair])
        for ids, _ in seqs:
            i = 0
            while i < len(ids) - 1:
                if tuple(ids[i:i + 2]) == pair:
                    ids[i:i + 2] = [merge.new_id]
                i += 1
    equal, _ = TR.train_balanced(docs.where("lang is not null"), 258, "lang")
    assert len(equal.merges) == 2


def test_numbers_over_chunks_and_logprob_tables(spark):
    m = byte_model((49, 50), kind="regex")
    m.pattern = None
    chunks = PT.split_chunks(texts_df(spark, ["a 1234567 and 12 1234567", "12345", "١٢٣٤", None]), "gpt4")
    got = {r.number: (r.n_chunks, r.n_tokens, r.pieces, r.n_occurrences) for r in MX.number_spans(chunks, m).collect()}
    assert got["1234567"] == (3, 6, "256 51|52 53 54|55", 2) and got["12345"] == (2, 4, "256 51|52 53", 1)
    assert set(got) == {"1234567", "12345", "١٢٣٤"}
    lp = spark.createDataFrame([("m", 0, i, bytearray(p), math.log(q)) for i, (p, q) in enumerate([(b"a", .5), (b"\xc3", .25), (b"\xa9b", .25)])] + [("n", 0, 0, bytearray(b"x"), -1.0)],
                               "model string, doc_id long, pos int, piece binary, logprob double")
    r = {x.model: x for x in MX.perplexity_by_model(lp).collect()}
    assert r["m"].n_tokens == 3 and abs(r["m"].bits_per_char - 5 / 3) < 1e-6 and abs(r["m"].bits_per_byte - 5 / 4) < 1e-6 and abs(r["m"].perplexity - 2 ** (5 / 3)) < 1e-5
    assert abs(r["n"].perplexity - math.e) < 1e-5


def test_lookups_take_the_largest_id(spark):
    m = byte_model((97, 98), (98, 99), (256, 99), (97, 257))  # 258 and 259 both spell abc
    rows = spark.createDataFrame([("abc", 1), ("a", 2), ("zz", 3), (None, 4), ("abc", 5)], "token string, k int")
    got = {r.k: r.id for r in VO.token_to_id(rows, m).collect()}
    assert got == {1: 259, 2: 97, 3: None, 4: None, 5: 259}
    ids = spark.createDataFrame([(258,), (259,), (9999,), (None,)], "id int")
    assert sorted((str(r.id), r.piece and bytes(r.piece)) for r in VO.id_to_token(ids, m).collect()) == [("258", b"abc"), ("259", b"abc"), ("9999", None), ("None", None)]
