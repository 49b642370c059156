import math

import bruteforce as BF
from toksmith.operators import unigram as UG


def test_viterbi_matches_loop(spark):
    pieces = {"a": 0.1, "b": 0.2, "ab": 0.3, "abc": 0.05, "c": 0.2, "bc": 0.15}
    total = sum(pieces.values())
    logp = {k: math.log(v / total) for k, v in pieces.items()}
    vocab = spark.createDataFrame(list(logp.items()), "piece string, logp double")
    words = ["abc", "abcabc", "cab", "xa", "a", "bbbb", "abcx"]
    got = {r.chunk: (r.score, list(r.pieces)) for r in
           UG.segment(spark.createDataFrame([(w,) for w in words], "chunk string"), vocab, 3).collect()}
    unk = min(logp.values()) - UG.UNK_PENALTY
    for w in words:
        score, segs = BF.viterbi(w, logp, 3, unk)
        assert got[w][1] == segs and abs(got[w][0] - score) < 1e-9


def test_unigram_training_and_sampling(spark):
    from support import CORPUS, texts_df
    df = texts_df(spark, [CORPUS])
    v = UG.train(df, 60, max_len=4, em_iters=1, shrink=0.3)
    rows = v.collect()
    singles = {r.piece for r in rows if len(r.piece) == 1}
    assert set(CORPUS) <= singles  # every character survives pruning
    assert len(rows) == 60
    assert abs(sum(math.exp(r.logp) for r in rows) - 1.0) < 1e-6
    from pyspark.sql import functions as F
    w = spark.createDataFrame([("quickly",), ("wizards",)], "chunk string")
    s = UG.sample(w, v, 6, F.col("chunk")).collect()
    assert all("".join(r.pieces) == r.chunk for r in s)


def test_training_ends_with_more_characters_than_pieces(spark):
    from support import texts_df
    v = UG.train(texts_df(spark, ["abcdefghijklmnopq abc abd qq"]), 5, max_len=3, em_iters=1, shrink=0.2)  # more characters than pieces asked for
    assert {len(r.piece) for r in v.collect()} == {1} and v.count() == 18
