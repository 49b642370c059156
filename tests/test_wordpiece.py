import regex

import bruteforce as BF
from support import CORPUS, texts_df
from toksmith.operators import wordpiece as WP


def test_wordpiece_train_and_encode_match_loop(spark):
    texts = [CORPUS, "unbelievable unbelievably believer", "zebra zebras"]
    df = texts_df(spark, texts)
    m = WP.train(df, 25)
    words = [w for t in texts for w in regex.findall(r"\p{L}+", t)]
    alpha, merges, pieces = BF.train_wordpiece(words, 25)
    assert m.alphabet == alpha and m.merges == merges and m.pieces == pieces
    probe = ["quick", "quickly", "zebras", "xylophone", "boxing", "q"]
    got = {r.word: list(r.ids) for r in WP.encode_words(spark.createDataFrame([(w,) for w in probe], "word string"), m).collect()}
    v = m.vocab()
    assert got == {w: BF.wordpiece_encode(w, v) for w in probe}
