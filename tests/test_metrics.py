"""Metric formulas against direct Python computation on small fixtures."""

import math
from collections import Counter

from toksmith.functions.symbols import syms
from toksmith.operators import metrics as MX


def test_mutual_information_and_entropy(spark):
    seqs = [[1, 2, 3, 1, 2], [2, 2, 2], [3, 1], [5]]
    df = spark.createDataFrame([(i, syms(s)) for i, s in enumerate(seqs)], "doc_id long, sym string")
    r = MX.mutual_information(df).first()
    joint = Counter(p for s in seqs for p in zip(s, s[1:]))
    T = sum(joint.values())
    la = Counter()
    rb = Counter()
    for (a, b), n in joint.items():
        la[a] += n
        rb[b] += n
    mi = sum(n / T * math.log2(n * T / (la[a] * rb[b])) for (a, b), n in joint.items())
    h_ab = -sum(n / T * math.log2(n / T) for n in joint.values())
    h_a = -sum(n / T * math.log2(n / T) for n in la.values())
    assert r.n_pairs == T
    assert abs(r.mutual_info - round(mi, 6)) < 1e-6 and abs(r.joint_entropy - round(h_ab, 6)) < 1e-6
    assert abs(r.cond_entropy - round(h_ab - h_a, 6)) < 1e-6

    freq = MX.token_freq(df)
    counts = Counter(t for s in seqs for t in s)
    assert {x.id: x.n for x in freq.collect()} == dict(counts)
    z = MX.zipf(freq).orderBy("rank").collect()
    assert [x.id for x in z] == sorted(counts, key=lambda k: (-counts[k], k))
    assert abs(z[-1].cum_share - 1.0) < 1e-9


def test_words_match_python_split(spark):
    texts = ["a  b\tc\n", "  lead", "", "x　y z\x1cw", "one"]
    df = spark.createDataFrame([(t,) for t in texts], "text string")
    got = [r.n for r in df.select(MX.n_words("text").alias("n")).collect()]
    assert got == [len(t.split()) for t in texts]
