import importlib
import os

import brute
import numpy as np

from toksmith.llm import blocks, bwt, op5_line_dedup


def test_first_owner_equals_brute_force():
    rng = np.random.default_rng(1)
    for _ in range(200):
        k, sigma, depth = int(rng.integers(1, 8)), int(rng.integers(1, 4)), int(rng.integers(1, 9))
        texts = [rng.integers(97, 97 + sigma, rng.integers(0, 30)).astype(np.uint8) for _ in range(k)]
        owner, size = rng.integers(0, 5, k), np.array([len(t) for t in texts])
        low = {}
        for t, o in zip(texts, owner, strict=True):
            for i in range(len(t) - depth + 1):
                low[bytes(t[i:i + depth])] = min(low.get(bytes(t[i:i + depth]), 9), o)
        got = bwt.first_owner(np.concatenate(texts), np.cumsum(size) - size, size, owner, depth)
        assert list(got) == [low[bytes(t[i:i + depth])] for t in texts for i in range(len(t) - depth + 1)]


def test_winnowing_keeps_a_minimum_of_every_window():
    rng = np.random.default_rng(2)
    for n in (0, 1, 3, 5, 40, 200):
        for w in (1, 2, 5):
            h = rng.integers(0, 9, n).astype(np.uint64)
            kept = blocks.winnow(h, w)
            for i in range(n - w + 1):
                window = h[i:i + w]
                assert kept[i:i + w][window == window.min()].all()


def test_pipeline_stages(spark, sf):
    p = importlib.import_module("corpus_pipeline")
    raw = spark.read.parquet(f"{sf}/documents.parquet").toPandas()
    docs, seen = spark.read.parquet(f"{sf}/documents.parquet"), []
    for name, stage in p.STAGES:
        docs = stage(spark, docs, sf).cache()
        seen.append((name, docs.toPandas()))
        if name != p.STAGES[-1][0]:
            assert docs.columns == list(p.COLUMNS)
    after = dict(seen)
    first = after["language_id"]
    assert len(first) >= 0.98 * len(raw)
    kept = brute.line_dedup(list(zip(first.doc_id, first.text, strict=True)), op5_line_dedup.MIN_LINES, op5_line_dedup.LONG_WORDS)
    lines = after["line_dedup"]
    assert dict(zip(lines.doc_id, lines.text, strict=True)) == {d: t for d, t in kept.items() if t == dict(zip(first.doc_id, first.text, strict=True))[d] or t.split()}
    groups = brute.jaccard_components(list(zip(lines.doc_id, lines.text, strict=True)))
    assert sorted(after["jaccard_join"].doc_id) == sorted(d for d, (_, c) in zip(lines.doc_id, groups, strict=True) if d == c)
    near = after["jaccard_join"]
    bench = spark.read.parquet(f"{sf}/benchmark.parquet").toPandas()
    hits = brute.contamination(list(zip(near.doc_id, near.text, strict=True)), list(zip(bench.item_id, bench.text, strict=True)))
    assert sorted(after["decontamination"].doc_id) == sorted(d for d, h in zip(near.doc_id, hits, strict=True) if not h[1])
    last = after["sentencepiece"]
    assert sorted(last.doc_id) == sorted(after["decontamination"].doc_id) and last.round_trip.all()
    assert sorted(map(tuple, p.run(spark, sf).select("doc_id", "n_tokens").collect())) == sorted(zip(last.doc_id, last.n_tokens, strict=True))


def test_pipeline_cases(make, spark, sf):
    p = importlib.import_module("corpus_pipeline")
    texts = [None, "", "the house and the garden are here now", "the house and the garden are here now", "12 34"]
    docs = make(texts, ids=[1, 2, 3, 3, None], langs=["en", None, "en", "en", None])
    for _, stage in p.STAGES:
        docs = stage(spark, docs, sf)
    assert [r["doc_id"] for r in docs.collect()] == [3]
    docs = make([])
    for _, stage in p.STAGES:
        docs = stage(spark, docs, sf)
    assert docs.count() == 0


def test_pipeline_jaccard_join_keeps_rows_not_ids(make, spark, sf):
    """Null and equal ids with different texts: one row of each group of near copies stays, and all the others."""
    p = importlib.import_module("corpus_pipeline")
    own = [" ".join(f"{w}{k}" for k in range(30)) for w in "abcdefgh"]
    rows = [(None, own[0]), (None, own[1]), (None, own[1]), (None, own[2]), (None, own[3] + " x"), (4, own[3]),  # the row with an id stays
            (5, own[4]), (5, own[5]), (5, own[5]), (5, own[6] + " x"), (2, own[6]),  # a clean and a near text under one id
            (6, own[7]), (7, own[7]), (None, own[7]), (None, None), (8, "")]
    got = p.jaccard_join(spark, make([t for _, t in rows], ids=[d for d, _ in rows]), sf).select("doc_id", "text").collect()
    want = [(None, own[0]), (None, own[1]), (None, own[2]), (4, own[3]), (5, own[4]), (5, own[5]), (2, own[6]), (6, own[7]), (None, None), (8, "")]
    assert sorted(map(repr, map(tuple, got))) == sorted(map(repr, want))


def test_entry_without_the_subpackage(tmp_path):
    """The queries of the library stay when the folder and the pipeline are not there."""
    import shutil
    import subprocess
    import sys

    root = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
    shutil.copytree(os.path.join(root, "toksmith"), tmp_path / "toksmith", ignore=shutil.ignore_patterns("llm", "__pycache__"))
    shutil.copy(os.path.join(root, "__spark_entry__.py"), tmp_path)
    code = "import __spark_entry__ as e; q = e.queries(); print(len(q), any(k.startswith('op') and k[2].isdigit() for k in q), 'pipeline' in q)"
    out = subprocess.run([sys.executable, "-c", code], cwd=tmp_path, env={k: v for k, v in os.environ.items() if k != "PYTHONPATH"}, capture_output=True, text=True, check=True).stdout.split()
    assert int(out[0]) > 50 and out[1:] == ["False", "False"]
