"""Training on blocks: the differences equal a recount, a round over few symbols is one job, and no step sorts a row per symbol."""

import random
from collections import Counter, defaultdict

import bruteforce as BF
from support import texts_df
from toksmith.functions.symbols import CHUNK_SEP
from toksmith.operators import train as TR


def test_differences_equal_a_recount():
    rng = random.Random(3)

    def counts(text):
        c = Counter(x + y for x, y in zip(text, text[1:], strict=False) if CHUNK_SEP not in (x, y))
        c[TR.TOTAL] = len(text) - text.count(CHUNK_SEP)
        return c

    for _ in range(300):
        text = CHUNK_SEP + "".join(rng.choice("aab" + CHUNK_SEP) for _ in range(rng.randint(1, 30))) + CHUNK_SEP
        for pair in ("ab", "aa", "ba"):
            if pair not in text:
                continue
            change = defaultdict(int)
            TR._differences(text, pair, "é", 3, change)
            after, before = counts(text.replace(pair, "é")), counts(text)
            want = {p: 3 * (after[p] - before[p]) for p in after | before if after[p] != before[p]}
            assert {p: n for p, n in change.items() if n} == want


def test_a_round_is_one_job(spark):
    rng = random.Random(5)
    texts = [" ".join(rng.choice(["alpha", "beta", "gamma", "delta"])[:rng.randint(1, 5)] for _ in range(40)) for _ in range(60)]
    spark.sparkContext.setJobGroup("rounds", "training")
    log = []
    try:
        got, _ = TR.train_char(texts_df(spark, texts), 60, log=log)
    finally:
        spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
    assert [(m.left_id, m.right_id, m.new_id, m.freq) for m in got.merges] == BF.train_char(texts, 60)[0]
    jobs = len(spark.sparkContext.statusTracker().getJobIdsForGroup("rounds"))
    assert jobs < 2 * len(log) + 30, (jobs, len(log))


def test_rows_of_one_place_train_alike(spark):
    rows = [(None, "abcabd"), (None, "bcbcab"), (5, "cabbd"), (5, "abab"), (7, None)]
    df = lambda r: spark.createDataFrame(r, "doc_id LONG, text STRING")
    m = [TR.train_basic(df(r), 262)[0].merges for r in (rows, rows[::-1])]
    assert m[0] == m[1]
