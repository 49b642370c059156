import collections
import hashlib
import random
import zlib

import brute
import pyarrow as pa
import pyarrow.compute as pc
import pytest

from toksmith.llm import op1_language_id as op1
from toksmith.llm import op2_jaccard_join as op2
from toksmith.llm import op4_decontamination as op4
from toksmith.llm import op8_suffix_dedup as op8
from toksmith.llm import op9_quality_rules as op9
from toksmith.llm import op10_sentencepiece as op10

EDGE = [None, "", " ", "\n\n", "a", "A b c d", "one two three four five six", "é😊 x", "x" * 5000, "- - -\t-"]


def table(spark, sf, name):
    return spark.read.parquet(f"{sf}/{name}.parquet")


def near_copies(seed=3, base=60, copies=40):
    """Texts with a hot group of near copies around one centre, chains, small documents and copies."""
    r = random.Random(seed)
    word = lambda: "".join(r.choice("abcdefgh") for _ in range(r.randint(1, 6)))
    centre = [word() for _ in range(base)]
    texts = [" ".join(centre)]
    for _ in range(copies):
        w = list(centre)
        for _ in range(r.randint(0, 4)):
            w[r.randrange(len(w))] = word()
        texts.append(" ".join(w))
    chain = [word() for _ in range(80)]
    for _ in range(15):
        chain = chain[3:] + [word() for _ in range(3)]
        texts.append(" ".join(chain))
    shared = " ".join(word() for _ in range(14))
    texts += [shared + " " + " ".join(word() for _ in range(r.randint(3, 60))) for _ in range(30)]
    texts += [" ".join(word() for _ in range(r.randint(0, 6))) for _ in range(20)]
    return texts + texts[:5] + EDGE


def test_jaccard_equals_brute_force(make):
    texts = near_copies()
    want = brute.jaccard_components(list(enumerate(texts)))
    got = {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in op2.join(make(texts)).collect()}
    assert got == dict(enumerate(want))


def test_jaccard_recursion_with_small_leaves(make, monkeypatch):
    monkeypatch.setattr(op2, "LEAF", 2)
    monkeypatch.setattr(op2, "LOCAL_DF", 10**9)  # no frequency order: shared passages make large regions
    texts = near_copies(seed=5, base=30, copies=30)
    got = {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in op2.join(make(texts)).collect()}
    assert got == dict(enumerate(brute.jaccard_components(list(enumerate(texts)))))


def test_jaccard_null_ids_repeated_rows_and_empty_table(make):
    texts = ["a b c d e f g", "a b c d e f g", "x y", None, "a b c d e f g"]
    got = sorted((r["doc_id"] is None, r["doc_id"], r["n_shingles"], r["component_id"]) for r in op2.join(make(texts, ids=[5, None, None, 9, 5])).collect())
    assert [g[1:] for g in got if g[1] == 5] == [(5, 3, 5)] * 2
    assert (None, 3, 5) in [g[1:] for g in got] and (None, 1, None) in [g[1:] for g in got] and (9, 0, 9) in [g[1:] for g in got]
    assert op2.join(make([])).count() == 0


def test_sketch_bounds_the_symmetric_difference():
    import numpy as np
    import pandas as pd

    r = np.random.default_rng(0)
    for _ in range(20):
        x, y = (np.unique(r.integers(0, 60, r.integers(1, 60)).astype(np.uint64)) for _ in range(2))
        a, b = (op2._sketch(np.zeros(len(s), np.int64), s, 1)[0].as_py() for s in (x, y))
        assert op2._differ(pd.Series([a]), pd.Series([b]))[0] <= len(np.setxor1d(x, y))


def test_contamination_both_ways(spark, make):
    r = random.Random(1)
    word = lambda: r.choice("alpha beta gamma delta eps zeta eta é42 x".split())
    items = [(i, " ".join(word() for _ in range(n))) for i, n in enumerate([30, 12, 10, 9, 4, 1, 0])] + [(None, "q w e r t y u i o p a"), (7, None), (2, "own words only")]
    texts = [" ".join(word() for _ in range(r.randint(0, 60))) for _ in range(40)]
    texts += ["See: " + items[0][1].upper().replace(" ", ", "), "q w e r t y u i o p a", "own WORDS only!"] + EDGE + [items[1][1]] * 2
    docs = make(texts)
    bench = spark.createDataFrame(items, "item_id long, text string")
    want = brute.contamination(list(enumerate(texts)), items)
    for limit in (op4.SMALL_WINDOWS, 3):
        got = {x["doc_id"]: (x["n_words"], x["n_hit"], sorted(x["items"])) for x in op4.contaminated(docs, bench, small_windows=limit).collect()}
        assert got == dict(enumerate(want))
    assert op4.contaminated(make([]), bench).count() == 0
    assert {x["n_hit"] for x in op4.contaminated(docs, bench.limit(0)).collect()} == {0}
    again = op4.contaminated(make(["own words only"] * 3, ids=[1, 1, None]), bench, small_windows=1).collect()
    assert [x["n_hit"] for x in again] == [3, 3, 3]


@pytest.mark.parametrize("small", [False, True])
def test_suffix_dedup_equals_brute_force(make, monkeypatch, small):
    if small:
        for name, value in (("BLOCK_BYTES", 2000), ("BUCKET_ANCHORS", 100), ("CHUNK", 500), ("RUN", 7)):
            monkeypatch.setattr(op8, name, value)
    r = random.Random(2)
    passage = ["".join(r.choice("abcé \n") for _ in range(n)) for n in (49, 50, 51, 120, 400)]
    texts = ["".join(r.choice([*passage, "".join(r.choice("xyz ") for _ in range(r.randint(1, 90)))]) for _ in range(r.randint(0, 6))) for _ in range(60)]
    texts += EDGE + ["ab" * 300, "ab" * 200, "x" * 4000, texts[3]]
    rows = list(enumerate(texts))
    got = sorted(tuple(x) for x in op8.remove_repeats(make(texts), with_text=False).collect())
    assert got == sorted(brute.remove_repeats(rows))


def test_suffix_dedup_cases(make):
    a = "".join(chr(97 + i % 23) for i in range(80))
    texts, ids = [a, a, a, a + "!", None], [4, 4, None, 9, 1]
    got = sorted((x["doc_id"] is not None, x["doc_id"], x["n_removed"]) for x in op8.remove_repeats(make(texts, ids)).collect())
    assert [g[1:] for g in got] == [(None, 0), (1, 0), (4, 80), (4, 80), (9, 80)]
    kept = {x["doc_id"]: bytes(x["kept"]) for x in op8.remove_repeats(make(texts, ids)).collect()}
    assert kept[9] == b"!" and hashlib.sha256(kept[9]).hexdigest() in {x["kept_sha256"] for x in op8.remove_repeats(make(texts, ids)).collect()}
    assert op8.remove_repeats(make([])).count() == 0


def test_suffix_dedup_splits_a_hot_anchor(monkeypatch):
    """A phrase in all documents, each in a context of its own: no transform and no bucket takes the whole group."""
    monkeypatch.setattr(op8, "CHUNK", 4000)
    r, longest, taken = random.Random(5), [], collections.Counter()
    own = lambda n: "".join(chr(r.randrange(97, 123)) for _ in range(n))
    phrase, passage = own(35), own(200)
    docs = [(i, own(60) + (phrase if i % 3 else passage) + own(r.choice([2, 60]))) for i in range(600)]
    docs += [(i + 600, t[20:]) for i, (_, t) in enumerate(docs[::40])] + [(None, docs[7][1]), (3, docs[9][1])]
    transform = op8.bwt.first_owner
    monkeypatch.setattr(op8.bwt, "first_owner", lambda t, b, n, *x: (longest.append(n.sum()), transform(t, b, n, *x))[1])

    def by(key, tables):
        rows = pa.concat_tables(tables)
        return {k: rows.filter(pc.equal(rows["block" if key == "block" else "bucket"], k)) for k in sorted(set(rows[key].to_pylist()))}

    dealt = {k: pa.table({"block": pa.array([k] * len(docs[k::3]), pa.int64()), "doc_id": pa.array([d for d, _ in docs[k::3]], pa.int64()), "text": [t for _, t in docs[k::3]]}) for k in range(3)}
    answer = by("block", [op8._shared(t) for t in by("bucket", [op8._anchors(16)((pa.scalar(k),), t) for k, t in dealt.items()]).values()])
    runs = by("bucket", [op8._runs_out(16)(t, answer[k]) for k, t in dealt.items()])
    for k, t in runs.items():
        taken[k] = t.nbytes
    firsts = by("block", [op8._firsts(t) for t in runs.values()])
    out = [op8._remove(pa.int64())(t, firsts[k]).drop_columns(["kept"]) for k, t in dealt.items()]
    key = lambda x: (x[0] is not None, x)
    assert sorted((tuple(x.values()) for t in out for x in t.to_pylist()), key=key) == sorted(brute.remove_repeats(docs), key=key)
    assert max(longest) <= 2 * op8.CHUNK
    assert max(taken.values()) <= 3 * sum(taken.values()) / 16


def test_quality_counts_and_verdict(spark, make, sf):
    docs = table(spark, sf, "documents")
    texts = EDGE + ["a b c " * 40, "w " * 60, "same line here\n" * 30] + [r["text"] for r in docs.select("text").collect()]
    got = {x["doc_id"]: x for x in op9.quality(make(texts)).collect()}
    for i, t in enumerate(texts):
        want = brute.quality(t)
        assert tuple(got[i][c] for c in ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")) == want
        assert got[i]["base_failed"] == (want[0] < 50 or 100 * want[4] > 50 * want[0])
    words = [f"w{i}" for i in range(200)]
    lines = ["\n".join(" ".join(words[k:k + 10]) for k in range(0, 200, 10))]
    lines.append(lines[0] + "\n" + "\n".join(" ".join(words[k:k + 10]) for k in range(0, 80, 10)))
    assert [x["kept"] for x in op9.quality(make(lines)).orderBy("doc_id").collect()] == [True, False]
    assert op9.quality(make([])).count() == 0


def test_language_id_held_out_accuracy(spark, sf):
    docs = table(spark, "/root/testdata/sf0.01", "documents")
    model = op1.learn(docs.where(~op1.held_out()))
    assert sorted(n for n, _ in model) == ["de", "en", "es", "fr"] and all(len(c) <= op1.DICT_BYTES for _, c in model)
    rows = op1.predict(docs.select("doc_id", "lang", "text", op1.held_out().alias("h")), model).collect()
    assert {r["doc_id"] for r in rows if r["h"]} == {r["doc_id"] for r in rows if brute.held_out(r["doc_id"])}
    test = [r for r in rows if r["h"]]
    assert sum(r["lang"] == r["lang_pred"] for r in test) >= 0.98 * len(test)
    assert sum(r["accepted"] for r in rows) >= 0.99 * len(rows)


def test_language_id_cases(make):
    train = make(["the house and the garden are here", "das Haus und der Garten sind hier", None, "", "1 2"], langs=["en", "de", "en", "de", None])
    model = op1.learn(train)
    assert sorted(n for n, _ in model) == ["de", "en"]
    texts = [None, "", "12 + 3", "The house and the garden", "der Garten und das Haus", "the garden " * 20000]
    got = [(r["lang_pred"], r["accepted"]) for r in op1.predict(make(texts), model).orderBy("doc_id").collect()]
    assert [g[0] for g in got] == ["und", "und", "und", "en", "de", "en"] and not any(g[1] for g in got[:3])
    assert {r["lang_pred"] for r in op1.predict(make(texts), []).collect()} == {"und"}
    both = [("a", b"same same same"), ("b", b"same same same")]
    assert [r["accepted"] for r in op1.predict(make(["abcdef ghijkl " * 20]), both).collect()] == [False]  # no margin at all
    assert op1.predict(make([]), model).count() == 0
    signs = op1.predict(make(["²", "½ ①", "Ⅷ ٣"]), model).collect()  # numerals are no letters
    assert {(r["lang_pred"], r["score"], r["accepted"]) for r in signs} == {("und", 0.0, False)}
    held = make(["a", "a", "b"], ids=[None, None, 3]).select("doc_id", op1.held_out().alias("h")).collect()
    assert [r["h"] for r in held] == [True, True, zlib.crc32(b"3") % 5 == 0]  # null ids: as the empty text


def test_language_id_equals_a_plain_loop(make):
    """Predictions, scores and rejections against a loop over plain zstandard compressors; null ids, repeated rows and clashing columns."""
    content = {"en": "the house and the garden are here and the cat sleeps in the sun ", "de": "das Haus und der Garten sind hier und die Katze liegt in der Sonne "}
    model = [(name, (x.lower() * 20).encode()) for name, x in content.items()]
    r = random.Random(8)
    texts = [" ".join(r.choice((content["en"] + content["de"]).split()) for _ in range(n)) for n in (1, 1, 2, 2, 3, 5, 9, 40, 400, 9000)] * 2 + ["x", "zq", "2", None]
    docs = make(texts, ids=[None, None, *range(len(texts) - 2)]).withColumnsRenamed({"block": "lang_pred", "shard": "_p"})
    got = op1.predict(docs, model).collect()
    assert len(got) == len(texts) and all(x["_p"] == 7 for x in got)
    want = {t: brute.language(t, model, op1.LEVEL, op1.BLOCK_BYTES, op1.MIN_MARGIN) for t in texts}
    assert [(x["lang_pred"], x["accepted"]) for x in got] == [want[x["text"]][:2] for x in got]
    assert all(abs(x["score"] - want[x["text"]][2]) < 1e-12 for x in got)
    assert {a for _, a, _ in want.values()} == {True, False} and not want["zq"][1]  # short texts are rejected too


def test_sentencepiece_paths_and_round_trip(spark, make, sf):
    model = op10.load()
    pieces = {p: (i, s) for p, i, s in model.pieces}
    texts = EDGE + ["  two  spaces ", "a\nb\n", "0123456789abcdef" * 40 + "z" * 900] + [r["text"] for r in table(spark, sf, "documents").limit(40).collect()]
    rows = op10.encode(make(texts), model)
    got = {r["doc_id"]: r for r in rows.withColumn("back", op10.decode(rows["ids"], model)).collect()}
    cache = {}
    for i, t in enumerate(texts):
        if t is None:
            assert got[i]["ids"] is None and got[i]["n_tokens"] is None
            continue
        want = []
        for w in op10.split(t):
            if w not in cache:
                cache[w] = [x for p, k in brute.segment(w, pieces, model.longest, model.unknown_score) for x in ([k] if k >= 0 else [model.byte_ids[b] for b in p.encode()])]
            want += cache[w]
        assert list(got[i]["ids"]) == want and got[i]["back"] == t and got[i]["n_tokens"] == len(want)
    assert op10.encode(make([]), model).count() == 0
    assert got[0]["block"] == "b" and got[0]["shard"] == 7


def test_sentencepiece_agrees_with_a_unigram_library(spark, make, sf):
    from tokenizers import Tokenizer, models, pre_tokenizers

    model = op10.load()
    unigram = Tokenizer(models.Unigram([("<unk>", model.unknown_score)] + [(p, s) for p, _, s in model.pieces], unk_id=0))
    unigram.pre_tokenizer = pre_tokenizers.Metaspace(replacement=op10.SPACE, prepend_scheme="always")
    score = {p: s for p, _, s in model.pieces}
    texts = [r["text"] for r in table(spark, sf, "documents").limit(20).collect()]
    for r in op10.encode(make(texts), model).collect():
        words = r["text"].replace("\n", " ").split(" ")
        mine = brute.segment(op10.SPACE + words[0], {p: (i, s) for p, i, s in model.pieces}, model.longest, model.unknown_score)
        theirs = unigram.encode(words[0]).tokens
        assert sum(score.get(p, model.unknown_score) for p, _ in mine) == pytest.approx(sum(score.get(p, model.unknown_score) for p in theirs))
