"""op11 against a plain dynamic programme and an exhaustive enumeration."""

import hashlib
import itertools
import random
import re
import zlib

import pytest

from toksmith.llm import op11_conversation_repair as R

WORD = re.compile(r"[^\x20\x09-\x0D]")
GOOD = re.compile(r"(s?(ua)+)?")


def plain_damage(rows):
    out = []
    for conv, turn, role, text in rows:
        kind = zlib.crc32(f"{' ' if conv is None else conv}:{' ' if turn is None else turn}".encode()) % 20
        role, text = " " if role is None else role, " " if text is None else text
        if kind == 0:
            continue
        text = "" if kind == 1 else re.sub("[.!?]", "", text) if kind == 2 else text
        out += [(conv, turn, "user" if kind == 4 else role, text)] * (2 if kind == 3 else 1)
    return out


def in_order(rows):
    digest = lambda r: hashlib.md5(f"{len(r[2])}:{r[2]}:{r[3]}".encode()).hexdigest()
    return sorted(rows, key=lambda r: (r[1] is not None, r[1] or 0, r[2], digest(r)))


def cheapest(turns):
    """Forward programme over (turns done, legal prefix state), all edits relaxed until nothing changes."""
    step = {"": "su", "s": "u", "u": "a", "a": "u"}
    layer = {"": (0, "")}
    for i in range(len(turns) + 1):
        changed = True
        while changed:
            changed = False
            for s, (c, a) in list(layer.items()):
                to = "a" if s == "u" else "u"
                new = (c + 2, a + "I")
                if to not in layer or new < layer[to]:
                    layer[to], changed = new, True
        if i == len(turns):
            break
        initial, kind = turns[i]
        after = {}
        for s, (c, a) in layer.items():
            options = [(s, c + 3, a + "D")]
            if kind != "forced":
                more = kind == "truncated"
                if not initial or initial in step[s]:
                    options.append((initial or s, c + more, a + "K"))
                options.append(("a" if s == "u" else "u", c + 2 + more, a + "R"))
            for to, cost, audit in options:
                if to not in after or (cost, audit) < after[to]:
                    after[to] = (cost, audit)
        layer = after
    return min(layer[s] for s in ("", "a") if s in layer)


def plain(rows):
    """Result of one conversation's ordered rows."""
    seen, faults = set(), []
    for _, _, role, text in rows:
        f = "" if WORD.search(text) else "blank"
        f = f or ("duplicate" if (role, text) in seen else "")
        seen.add((role, text))
        f = f or ("truncated" if WORD.findall(text)[-1] not in ".!?" else "")
        faults.append(f)
    turns = [r[1] for r in rows if r[1] is not None]
    pairs = [a[2][:1] + b[2][:1] for a, b in zip(rows, rows[1:], strict=False)]
    kinds = [(r[2][:1], "forced" if f in ("blank", "duplicate") else f) for r, f in zip(rows, faults, strict=True)]
    cost, audit = cheapest(kinds)
    done, rest, state = [], list(rows), ""
    for e in audit:
        r = rest.pop(0) if e != "I" else None
        if e == "D":
            continue
        forced = "assistant" if state == "u" else "user"
        role, text = (r[2], r[3]) if e == "K" else (forced, r[3] if r else "")
        state = role[:1] or state
        done.append((role, text))
    assert GOOD.fullmatch("".join(r[:1] for r, _ in done))
    sha = hashlib.sha256("\n".join(f"{r}:{t}" for r, t in done).encode()).hexdigest()
    return (max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0, faults.count("blank"), faults.count("duplicate"), faults.count("truncated"),
            sum(p not in ("su", "ua", "au") for p in pairs), cost, audit, sha), done


def expected(rows):
    out = {}
    for c in {r[0] for r in rows}:
        out[c] = plain(in_order([r for r in plain_damage(rows) if r[0] == c]))[0]
    return out


def table(spark, rows):
    return spark.createDataFrame([(*r, 1, "x", True) for r in rows], "conv_id long, turn long, role string, text string, part int, key string, blank boolean")


def run(spark, rows, **kw):
    got = R.repair(R.damage(table(spark, rows)), **kw).collect()
    assert len({r["conv_id"] for r in got}) == len(got)
    return {r["conv_id"]: tuple(r)[1:9] for r in got}


def rand_rows(seed, convs, longest, roles=("user", "assistant", "system")):
    rng = random.Random(seed)
    rows = []
    for c in convs:
        for t in range(rng.randrange(longest)):
            text = rng.choice(["Hi.", "Yes!", "no end", "", "  ", "Why?", "a b. ", f"turn {t}.", f"open {t}"])
            rows.append((c, rng.choice([t, t, t, t + 1, None]), rng.choice(roles), rng.choice([text, text, text, None])))
    return rows


def test_search_against_the_programme_and_all_edit_strings():
    rng = random.Random(3)
    kinds = {R.FORCED: "forced", R.CUT: "truncated", R.SOUND: ""}
    for n in [0, 1, 2, 3, 4, 5, 6, 8, 12, 30] * 40:
        turns = [(rng.choice("suauau" + "t"), rng.choice([0, 0, 0, 1, 2])) for _ in range(n)]
        want = cheapest([(i, kinds[k]) for i, k in turns])
        assert R.search(turns) == want
        for size in (1, 2, 5):
            cost, way = R.chain([R.tables(turns[i:i + size]) for i in range(0, n, size)])
            assert (cost, "".join(a for _, a in way)) == want
    price = {"K": 0, "R": 2, "D": 3, "I": 2}
    for turns in itertools.product([("u", 0), ("a", 1), ("s", 0), ("u", 2)], repeat=3):  # all strings of up to 3 turns and 3 inserts
        best = None
        for n in range(3, 7):
            for audit in itertools.product("DIKR", repeat=n):
                if sum(e != "I" for e in audit) != 3:
                    continue
                state, cost, left, ok = "", 0, list(turns), True
                for e in audit:
                    initial, kind = left.pop(0) if e != "I" else ("", 0)
                    cost += price[e] + (kind == 1 and e in "KR")
                    if e == "D":
                        continue
                    to = initial if e == "K" else "a" if state == "u" else "u"
                    ok = ok and kind != 2 and to in {"": "su", "s": "u", "u": "a", "a": "u"}[state]
                    state = to
                if ok and state in ("", "a") and (best is None or (cost, "".join(audit)) < best):
                    best = (cost, "".join(audit))
        assert R.search(list(turns)) == best


@pytest.mark.parametrize("ranges", [None, 7])
def test_random_conversations(spark, ranges):
    rows = rand_rows(1, [None, 0, 1, 2, 3, 10**12, -5, *range(20, 60)], 14, ("user", "assistant", "system", "tool", "", None))
    rows += rows[:40]  # repeated rows
    assert run(spark, rows, ranges=ranges) == expected(rows)


def test_conversation_over_many_ranges(spark, monkeypatch):
    """One conversation holds most rows, among them one very frequent turn, and spans the ranges."""
    rng = random.Random(9)
    rows = [(7, t, rng.choice(["user", "assistant"]), rng.choice(["same.", "same.", f"t{t}.", f"t{t}", ""])) for t in range(400)]
    rows += [(None, None, "user", "x.")] * 60 + rand_rows(4, range(10, 20), 6)
    monkeypatch.setattr(R, "SEGMENT", 50)
    want = expected(rows)
    got = R.repair(R.damage(table(spark, rows)), texts=True, ranges=9).collect()
    assert {r["conv_id"]: tuple(r)[1:9] for r in got} == want
    for r in got:
        done = plain(in_order([x for x in plain_damage(rows) if x[0] == r["conv_id"]]))[1]
        assert [(t["role"], t["text"]) for t in r["repaired"]] == done


def test_long_conversation_in_one_range(spark):
    rows = [(1, t, "user" if t % 3 else "assistant", "q." * (t % 50) + "x" * (t % 2)) for t in range(3000)] + [(2, 0, "user", "y" * 3_000_000 + ".")]
    assert run(spark, rows, ranges=1) == expected(rows)


def test_only_dropped_turns_and_empty_table(spark):
    gone = next(c for c in range(1000) if zlib.crc32(f"{c}:0".encode()) % 20 == 0)
    assert run(spark, [(gone, 0, "user", "Hi.")]) == {gone: (0, 0, 0, 0, 0, 0, "", R.NOTHING)}
    assert run(spark, []) == {}


def test_table_of_the_small_set(spark, sf):
    rows = [tuple(r) for r in spark.read.parquet(f"{sf}/conversations.parquet").select("conv_id", "turn", "role", "text").collect()]
    got = {r["conv_id"]: tuple(r)[1:9] for r in R.op11_conversation_repair(spark, sf).collect()}
    assert got == expected(rows)
