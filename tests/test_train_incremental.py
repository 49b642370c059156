"""Training by differences: equal to the plain loop, whatever the cuts, and reading only the sequences it rewrites."""

import random

import pytest

import bruteforce as BF
from support import CORPUS, texts_df
from toksmith.operators import train as TR


def merges_of(m):
    return [(x.left_id, x.right_id, x.new_id, x.freq) for x in m.merges]


TEXTS = [CORPUS[i:i + 41] for i in range(0, 1600, 41)]


def test_rounds_read_only_sequences_that_hold_a_chosen_pair(spark):
    log = []
    m, _ = TR.train_regex(texts_df(spark, TEXTS), 256 + 20, floor=1, log=log)
    assert merges_of(m) == BF.train_regex(TEXTS, 256 + 20)
    import regex
    from toksmith.functions import patterns
    chunks = {c for t in TEXTS for c in regex.findall(patterns.resolve("gpt4"), t)}
    state = {c: list(c.encode()) for c in chunks if len(c.encode()) > 1}  # no cuts: sequences are the distinct chunks
    k = 0
    for step in log:
        batch = m.merges[k:k + step["merges"]]
        k += step["merges"]
        held = 0
        for c, ids in state.items():
            pairs = set(zip(ids, ids[1:], strict=False))
            held += any((x.left_id, x.right_id) in pairs for x in batch)
            for x in batch:
                out, i = [], 0
                while i < len(ids):
                    if ids[i:i + 2] == [x.left_id, x.right_id]:
                        out.append(x.new_id)
                        i += 2
                    else:
                        out.append(ids[i])
                        i += 1
                ids = out
            state[c] = ids
        assert step["read"] == held
    assert k == 20 and sum(s["read"] for s in log) < len(log) * log[0]["sequences"] / 2


@pytest.mark.parametrize(("floor", "rebuild"), [(None, 64), (3, 5), (10**9, 64)])
def test_cuts_and_rebuilds_do_not_change_the_merges(spark, floor, rebuild):
    rng = random.Random(11)
    texts = ["".join(rng.choice("aabc dé") for _ in range(rng.randint(0, 60))) for _ in range(40)] + ["a" * 300 + "b", None, ""]
    got, _ = TR.train_basic(texts_df(spark, texts), 256 + 12, floor=floor, rebuild_every=rebuild)
    assert merges_of(got) == BF.train_basic([t for t in texts if t is not None], 256 + 12)
    totals = [x.total_tokens for x in got.merges]
    assert totals == sorted(totals, reverse=True) and None not in totals


def test_a_full_pair_table_raises_the_floor(spark, monkeypatch):
    monkeypatch.setattr(TR, "MAX_KEPT", 12)
    got, _ = TR.train_basic(texts_df(spark, TEXTS), 256 + 8)
    assert merges_of(got) == BF.train_basic(TEXTS, 256 + 8)


def test_training_ends_when_no_pair_is_left(spark):
    got, final = TR.train_basic(texts_df(spark, ["abab", "x", ""]), 259)
    assert merges_of(got) == BF.train_basic(["abab", "x", ""], 259)
    assert TR.train_basic(texts_df(spark, ["x", None]), 300)[0].merges == []
