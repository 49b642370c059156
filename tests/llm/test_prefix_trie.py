"""op13 against a dictionary of prefixes."""

import hashlib
import random
import re
import zlib

import pytest

from toksmith.llm import op13_prefix_trie as T

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def plain(rows):
    turn_id = lambda r, t: hashlib.md5(f"{len(r)}:{r}:{t}".encode()).digest()
    own = {}
    for conv, turn, role, text in rows:
        if conv is not None:
            own.setdefault(conv, []).append((turn is not None, turn or 0, turn_id(role or "", text or ""), role or "", text or ""))
    own = {c: [t[3:] for t in sorted(v)] for c, v in own.items()}
    members, ends = {}, {}
    for c, turns in own.items():
        h = zlib.crc32(str(c).encode()) % 4
        seq = tuple(own.get(c - (c % 20 if c >= 0 else -(-c % 20)), [])[:h] + turns[h:])
        for d in range(len(seq) + 1):
            members.setdefault(seq[:d], []).append(c)
        ends.setdefault(seq, []).append(c)
    children = {}
    for p in members:
        if p:
            children.setdefault(p[:-1], []).append(p)
    leaves, saved = {}, {}
    for p in sorted(members, key=len, reverse=True):
        kids = children.get(p, [])
        leaves[p] = sum(leaves[k] for k in kids) or 1
        saved[p] = sum(saved[k] for k in kids) + (len(members[p]) - 1) * (len(WORD.findall(p[-1][1])) if p else 0)
    sha = lambda p: hashlib.sha256(",".join(map(str, sorted(ends.get(p, [])))).encode()).hexdigest()
    return sorted(((min(m), len(p), min(members[p[:-1]]) if p else None, len(m), len(children.get(p, [])), leaves[p], saved[p], sha(p)) for p, m in members.items()), key=str)


def table(spark, rows):
    return spark.createDataFrame([(*r, 5, b"k", True) for r in rows], "conv_id long, turn long, role string, text string, depth int, key binary, border boolean")


def run(spark, rows, **kw):
    return sorted(map(tuple, T.nodes(T.rebuilt(table(spark, rows)), **kw).collect()), key=str)


def rand_rows(seed, convs, longest, words="ab"):
    rng = random.Random(seed)
    rows = [(c, rng.choice([t, t, t, None]), rng.choice(["user", "assistant", None]), rng.choice([*words, None, "two words ", " ", "x\ty z"])) for c in convs for t in range(rng.randrange(1, longest))]
    rng.shuffle(rows)
    return rows


@pytest.mark.parametrize(("width", "shards"), [(16, None), (16, 5), (2, 6), (1, 4), (3, 1)])
def test_random_conversations(spark, width, shards):
    rows = rand_rows(1, [-45, -3, *range(60), 10**12], 9) + [(None, 0, "user", "nobody's")] * 5
    rows += rows[:30]  # repeated rows
    assert run(spark, rows, width=width, shards=shards) == plain(rows)


@pytest.mark.parametrize(("width", "shards"), [(2, 7), (4, 3), (16, 9)])
def test_copies_and_shared_openings_over_many_shards(spark, width, shards):
    """A third are equal conversations, a third share a long opening, and one is far longer than the rest."""
    rows = [(c, t, "user", f"copy {t}") for c in range(0, 2000, 20) for t in range(7)]
    rows += [(c, t, "user", f"open {t}" if t < 5 else f"own {c % 7} {c if t > 6 else ''}") for c in range(2001, 4000, 20) for t in range(9)]
    rows += [(5001, t, "assistant", f"long {t}") for t in range(300)] + rand_rows(3, range(6000, 6050), 6)
    assert run(spark, rows, width=width, shards=shards) == plain(rows)


def test_very_long_text_turnless_conversation_and_empty_table(spark):
    turnless = next(c for c in range(21, 2000) if zlib.crc32(str(c).encode()) % 4 == 3 and c % 20)
    rows = [(turnless, 0, "user", "w " * 1_500_000), (turnless, 1, "user", "")]
    got = run(spark, rows)
    assert got == plain(rows) == [(turnless, 0, None, 1, 0, 1, 0, hashlib.sha256(str(turnless).encode()).hexdigest())]
    assert run(spark, [(0, 0, "user", "w " * 1_500_000), (20, 0, "user", "w " * 1_500_000)]) == plain([(0, 0, "user", "w " * 1_500_000), (20, 0, "user", "w " * 1_500_000)])
    assert run(spark, []) == []


def test_table_of_the_small_set(spark, sf):
    rows = [tuple(r) for r in spark.read.parquet(f"{sf}/conversations.parquet").select("conv_id", "turn", "role", "text").collect()]
    assert sorted(map(tuple, T.op13_prefix_trie(spark, sf).collect()), key=str) == plain(rows)
