"""op12 against the library on whole texts."""

import random

import numpy as np

from toksmith.llm import op12_token_counts as C


def plain(texts):
    sp = C.load(C.model_path())
    return [(len((t or "").encode()), len(sp.encode(t or ""))) for t in texts]


TEXTS = [None, "", " ", "  ", "\n", "\n\n", "a", " a", "a ", "a  b", "a\nb", "\n a\n", "▁a", "a▁b ▁ c", "<s> x </s>", "<0x41> <unk>", "\x00a", "　x",
         "é é", "日本語 テキスト", "🙂🙃 👩‍👩‍👧", "tab\tand\r\nlines  \r", "x" * 500, "word " * 5000, "12 345 6.7", "a" * 63 + " " + "b" * 64 + " " + "c" * 65]


def test_equals_the_library_on_edge_texts(make):
    ids = [None, 3, 3] + list(range(100, 100 + len(TEXTS) - 3))  # null and repeated ids
    got = sorted(map(tuple, C.count_tokens(make(TEXTS, ids)).collect()), key=str)
    want = sorted(((i, b, n, n > 4096) for i, (b, n) in zip(ids, plain(TEXTS), strict=True)), key=str)
    assert got == want and any(w[3] for w in want)


def test_random_texts_repeated_rows_and_a_small_table(make, monkeypatch):
    rng = random.Random(5)
    bits = ["the", " of", "  ", "\n", "▁", "é", "zx", "🙂", " ", "-", "Q"]
    texts = ["".join(rng.choice(bits) for _ in range(rng.randrange(60))) for _ in range(300)]
    texts += texts[:50]
    want = [n for _, n in plain(texts)]
    for table in (3, 1 << 16):
        got = {r.doc_id: r.n_tokens for r in C.count_tokens(make(texts), table=table).collect()}
        assert [got[i] for i in range(len(texts))] == want


def test_long_text_is_worked_in_parts(make, monkeypatch):
    rng = random.Random(1)
    words = ["".join(rng.choice("abcdefgh") for _ in range(rng.randrange(1, 9))) for _ in range(5000)]
    long = " ".join(rng.choice(words) for _ in range(900_000))  # over 4 MB
    assert len(long) > 2 * C.blocks.SLICE_BYTES
    got = {r.doc_id: (r.n_bytes, r.n_tokens) for r in C.count_tokens(make([long, "short one", None])).collect()}
    assert [got[i] for i in range(3)] == plain([long, "short one", None])


def test_empty_table(make):
    out = C.count_tokens(make([]))
    assert out.columns == ["doc_id", "n_bytes", "n_tokens", "over_limit"] and out.count() == 0


def test_cache_generations():
    worker = C._Worker(C.model_path())
    data = np.frombuffer(b" one two three", np.uint8)
    start = np.array([0, 4, 8])
    end = np.array([4, 8, 14])
    keys = C._hashes(data, start, end)
    first = worker.look_up(keys, data, start, end)
    worker.new, worker.old = {}, worker.new
    assert first.tolist() == worker.look_up(keys, data, start, end).tolist() == worker.lengths([" one", " two", " three"])
