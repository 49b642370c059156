"""The large-vocabulary plan: equal to the plain loop, linear in text length, keyed per text."""

import random
import time

import bruteforce as BF
import pytest

from toksmith.model import Merge, Model
from toksmith.operators import encode as EN


def chained_model(kind, n_words=1200, seed=1):
    """Merges that build random words from left to right (a few thousand of them)."""
    r = random.Random(seed)
    words = ["".join(r.choice("abcdefghij") for _ in range(r.randint(3, 8))) for _ in range(n_words)]
    alphabet = "".join(sorted(set("".join(words)) | {"▁"}))
    ids = {c: (3 + i) for i, c in enumerate(alphabet)} if kind == "char" else {c: ord(c) for c in alphabet if ord(c) < 256}
    new = 3 + len(alphabet) if kind == "char" else 256
    known, merges = {}, []
    for w in words:
        left = ids[w[0]]
        for c in w[1:]:
            if (left, ids[c]) not in known:
                known[left, ids[c]] = new
                merges.append(Merge(len(merges), left, ids[c], new, 1))
                new += 1
            left = known[left, ids[c]]
    return Model(kind, merges, pattern=BF.GPT4 if kind == "regex" else None, alphabet=alphabet if kind == "char" else ""), words, ids


@pytest.mark.parametrize("kind", ["basic", "regex", "char"])
def test_thousands_of_merges_and_a_long_text(spark, kind):
    model, words, ids = chained_model(kind, 1900)
    assert len(model.merges) >= 5000
    r = random.Random(2)
    long = " ".join(r.choice(words) for _ in range(160_000))
    assert len(long) >= 1_000_000
    texts = ["", "abc" * 50, " ".join(words[:40]), "x9 " + words[5] + "é", long]
    started = time.time()
    rows = EN.encode(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string"), model, strategy="dictionary").collect()
    assert time.time() - started < 120
    flat = [(m.left_id, m.right_id, m.new_id) for m in model.merges]
    for row in rows:
        t = texts[row["doc_id"]]
        if kind == "regex":
            want = BF.encode_regex(t, flat)
        elif kind == "basic":
            want = BF.encode_basic(t, flat)
        else:
            want = BF.apply_merges([ids.get(c, 0) for c in t.replace(" ", "▁")], flat)
        assert list(row["ids"]) == want and row["n_tokens"] == len(want)


def test_repeated_ids_and_null_texts(spark):
    model, words, _ = chained_model("regex", 50)
    rows = [(1, words[0] + " " + words[1], "a"), (1, "xx " + words[2], "b"), (None, words[3], "c"), (2, None, "d"), (1, words[0] + " " + words[1], "e")]
    df = spark.createDataFrame(rows, "doc_id long, text string, tag string")
    a, b = (sorted(map(tuple, EN.encode(df, model, strategy=s, keep=("tag",)).select("tag", "doc_id", "ids", "n_tokens").collect())) for s in ("inline", "dictionary"))
    assert a == b and a[3][2] is None


def test_allowed_specials(spark):
    model, words, _ = chained_model("regex", 50)
    model = Model("regex", model.merges, pattern=model.pattern, specials={"<|a|>": 90000, "<|a|>b": 90001})
    texts = [f"{words[0]}<|a|>b{words[1]}<|a|>", "<|a|>", words[2], "", None]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    for policy in ("all", "none", {"<|a|>"}, set()):
        a, b = (sorted(map(tuple, EN.encode(df, model, allowed_special=policy, strategy=s).collect())) for s in ("inline", "dictionary"))
        assert a == b
    with pytest.raises(ValueError):
        EN.allowed_specials(model, "some")
    for s in ("inline", "dictionary"):
        with pytest.raises(Exception, match="special token found"):
            EN.encode(df, model, strategy=s).collect()
