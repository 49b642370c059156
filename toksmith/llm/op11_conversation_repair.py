"""Conversation structure repair by depth-first branch-and-bound.

A conversation's turns, in order, are repaired by the cheapest edits that leave role initials of the
form ``(s?(ua)+)?``: Keep 0, Rerole to user/assistant 2, Delete 3 (required for a blank or a duplicate turn),
Insert an empty user/assistant turn 2, and 1 more for a truncated turn that stays.  Of equally cheap
edit strings the ASCII-least wins.

:func:`search` walks an explicit stack of nodes (turns done, last role).  A node is cut if its cost plus a
lower bound on the rest cannot beat the incumbent (cost, edit string), or if the node's dominance table
entry is no worse: two prefixes that reach one node have the same continuations, and equal costs rule out
that one edit string is the start of the other, so the better (cost, string) stays better.  The bound on
the rest: 3 a forced deletion, 1 a truncated turn, and 2 for each two illegal neighbours among the other turns,
as one paid edit mends two at most.  The search ends with an empty stack, so the incumbent is optimal.

Turns are range-dealt by (conversation, turn, role, digest), so a conversation of any size spreads over tasks.
One that lies in a single range is repaired in it, ``SEGMENT`` turns at a time.  Those that cross a range
border (at most one a border) are searched per range from every state to every state; the ranges'
(cost, string) tables are chained per conversation, and the texts of the repaired turns are streamed through the hash in
order.  What is inherently one value (the edit string, the hash) is made in one task, in bounded memory but for
the string itself.

Defined cases: a null role or text is one space; turns with null numbers come first; turns with one number are
ordered by role, then by the MD5 of role and text (repeated rows are thus neighbours, all but the first duplicates);
a null conversation id is a conversation of its own; an empty role has no initial and constrains nothing; a
conversation without turns (``live`` false) has zero counts, an empty edit string and the hash of nothing;
an empty table gives an empty result; other columns are not read.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from toksmith.operators.joins import hot_cold_join
from toksmith.session import cut_lineage

SEGMENT = 1024  # turns that one search takes
START, SYSTEM, USER, ASSISTANT = "^", "s", "u", "a"
STATES = START + SYSTEM + USER + ASSISTANT
#: role initials that may follow each state
NEXT = {START: "su", SYSTEM: "u", USER: "a", ASSISTANT: "u"}
ENDS = START + ASSISTANT  # states in which a conversation may end
FORCED, SOUND, CUT = 2, 0, 1  # blank or duplicate; no fault; truncated
NAMES = {USER: "user", ASSISTANT: "assistant"}
NOTHING = hashlib.sha256(b"").hexdigest()
ORDER = ["conv_id", "turn", "role", "digest"]  # ascending, nulls first
RESULT = "gaps long, blank long, duplicate long, truncated long, illegal long, cost long, audit string, repaired_sha256 string"


# -- the search ---------------------------------------------------------------------------------

def _bounds(turns: list[tuple[str, int]], ends: str) -> tuple[list[int], list[int], list[str | None]]:
    """Per position: the faults' cost from there on, illegal neighbours among the turns that may stay, and the
    initial of the first of these (None: none is left)."""
    n = len(turns)
    fault, pairs, first = [0] * (n + 1), [0] * (n + 1), [None] * (n + 1)
    for i in range(n - 1, -1, -1):
        initial, kind = turns[i]
        fault[i], pairs[i], first[i] = fault[i + 1], pairs[i + 1], first[i + 1]
        if kind == FORCED:
            fault[i] += 3
            continue
        fault[i] += kind
        if initial:  # a turn without initial constrains nothing
            after = first[i + 1]
            if after is None:
                pairs[i] += initial not in ends
            else:
                pairs[i] += after not in NEXT.get(initial, "")
            first[i] = initial
    return fault, pairs, first


def search(turns: list[tuple[str, int]], start: str = START, ends: str = ENDS) -> tuple[int, str] | None:
    """The least (cost, edit string) from state ``start`` to one of ``ends`` over ``(initial, fault)`` turns."""
    n = len(turns)
    fault, pairs, first = _bounds(turns, ends)

    def rest(i: int, state: str) -> int:
        broken = pairs[i] + (first[i] not in NEXT[state] if first[i] is not None else state not in ends)
        return fault[i] + 2 * ((broken + 1) // 2)

    best: tuple[int, str] | None = (3 * n, "D" * n) if start in ends else None
    table: dict[tuple[int, str], tuple[int, str]] = {}
    stack = [(0, start, 0, "")]
    while stack:
        i, state, cost, audit = stack.pop()
        mine = (cost, audit)
        known = table.get((i, state))
        if known is not None and known <= mine:
            continue
        if best is not None:
            least = cost + rest(i, state)
            if least > best[0] or least == best[0] and audit > best[1][:len(audit)]:
                continue
        table[i, state] = mine
        if i == n and state in ends and (best is None or mine < best):
            best = mine
        steps = []
        put = ASSISTANT if state == USER else USER
        if i < n:
            initial, kind = turns[i]
            steps.append((i + 1, state, cost + 3, audit + "D"))
            if kind != FORCED:
                if not initial or initial in NEXT[state]:
                    steps.append((i + 1, initial or state, cost + kind, audit + "K"))
                steps.append((i + 1, put, cost + 2 + kind, audit + "R"))
        steps.append((i, put, cost + 2, audit + "I"))
        steps.sort(key=lambda s: (s[2] + rest(s[0], s[1]), s[3]), reverse=True)  # the most promising is popped first
        stack.extend(steps)
    return best


def tables(turns: list[tuple[str, int]]) -> dict[str, tuple[int, str]]:
    """``search`` from every state to every state, by the two states' names."""
    found = {a + b: search(turns, a, b) for a in STATES for b in STATES}
    return {k: v for k, v in found.items() if v is not None}


def chain(segments: list[dict[str, tuple[int, str]]]) -> tuple[int, list[tuple[str, str]]]:
    """The least cost through the segments' tables, and of each segment (state before, edit string)."""
    reached: dict[str, tuple[int, str, list]] = {START: (0, "", [])}
    for table in segments:
        after: dict[str, tuple[int, str, list]] = {}
        for a, (cost, audit, way) in reached.items():
            for b in STATES:
                got = table.get(a + b)
                if got is not None:
                    new = (cost + got[0], audit + got[1])
                    if b not in after or new < after[b][:2]:
                        after[b] = (*new, [way, (a, got[1])])
        reached = after
    cost, _, way = min((reached[s] for s in ENDS if s in reached), key=lambda r: r[:2])
    out = []
    while way:
        way, step = way
        out.append(step)
    return cost, out[::-1]


def edited(rows: list[tuple[str, str]], state: str, audit: str) -> Iterator[tuple[str, str]]:
    """The repaired (role, text) turns that an edit string makes of ``rows`` from a state on."""
    rows = iter(rows)
    for edit in audit:
        role, text = ("", "") if edit == "I" else next(rows)
        if edit == "D":
            continue
        if edit != "K":
            role = NAMES[ASSISTANT if state == USER else USER]
        state = role[:1] or state
        yield role, text


# -- turns with their faults --------------------------------------------------------------------

def _turns(conversations: DataFrame) -> DataFrame:
    role, text = (F.coalesce(c, F.lit(" ")) for c in ("role", "text"))
    live = F.coalesce(F.col("live"), F.lit(True)) if "live" in conversations.columns else F.lit(True)
    rows = conversations.select("conv_id", "turn", role.alias("role"), text.alias("text"), live.alias("live"))
    return rows.withColumn("digest", F.md5(F.concat_ws(":", F.length("role").cast("string"), "role", "text").cast("binary")))


def _blank(text: Column) -> Column:
    return ~text.rlike(r"[^\x20\x09-\x0D]")


def _truncated(text: Column) -> Column:
    return ~text.rlike(r"[.!?][\x20\x09-\x0D]*\z")


def _key(conv: Column) -> Column:
    return F.coalesce(F.concat(F.lit("c"), conv.cast("string")), F.lit("null"))


def _counts(rows: list[tuple]) -> dict[str, int]:
    """Fault counts and facts of consecutive live rows ``(turn, initial, fault name)``."""
    turns = [r[0] for r in rows if r[0] is not None]
    pairs = [a[1] + b[1] for a, b in zip(rows, rows[1:], strict=False)]
    return {"blank": sum(r[2] == "blank" for r in rows), "duplicate": sum(r[2] == "duplicate" for r in rows),
            "truncated": sum(r[2] == "truncated" for r in rows), "illegal": sum(p not in ("su", "ua", "au") for p in pairs),
            "low": min(turns, default=None), "high": max(turns, default=None), "turns": len(set(turns))}


_KIND = {"blank": FORCED, "duplicate": FORCED, "truncated": CUT, "": SOUND}


def _whole(rows: list[tuple], texts: bool) -> dict:
    """Result of a conversation from its live rows ``(turn, role, text, digest, blank, truncated)`` in order."""
    seen: set[str] = set()
    judged = []
    for turn, role, _, digest, blank, truncated in rows:
        judged.append((turn, role[:1], "blank" if blank else "duplicate" if digest in seen else "truncated" if truncated else ""))
        seen.add(digest)
    out = _counts(judged)
    turns = [(initial, _KIND[fault]) for _, initial, fault in judged]
    if len(turns) <= SEGMENT:
        out["cost"], audit = search(turns)
        way = [(START, audit)]
    else:
        out["cost"], way = chain([tables(turns[i:i + SEGMENT]) for i in range(0, len(turns), SEGMENT)])
    done = [t for k, (state, audit) in enumerate(way) for t in edited([r[1:3] for r in rows[k * SEGMENT:(k + 1) * SEGMENT]], state, audit)]
    low, high, distinct = out.pop("low"), out.pop("high"), out.pop("turns")
    out["gaps"] = high - low + 1 - distinct if distinct else 0
    out["audit"] = "".join(audit for _, audit in way)
    out["repaired_sha256"] = hashlib.sha256("\n".join(f"{r}:{t}" for r, t in done).encode()).hexdigest()
    if texts:
        out["repaired"] = [{"role": r, "text": t} for r, t in done]
    return out


def _inside(dealt: DataFrame, border: set, schema: str, texts: bool) -> DataFrame:
    """Results of the conversations that lie in one range: the sorted range is streamed, one conversation held at a time."""
    names = [c.split()[0] for c in schema.split(", ")][:10 if texts else 9]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple] = []
        out: list[dict] = []
        arrow = None

        def close():
            if held and held[0][0] not in border:
                out.append({"conv_id": held[0][0], **_whole([r[1:7] for r in held if r[7]], texts)})
            held.clear()

        def flush():
            cols = [pa.array([r[c] for r in out], arrow if c == "conv_id" else _ARROW.get(c, pa.int64())) for c in names]
            out.clear()
            return pa.RecordBatch.from_arrays(cols, names=names)

        for batch in batches:
            arrow = batch.schema.field(0).type
            for row in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if held and held[0][0] != row[0]:
                    close()
                held.append(row)
            if out:
                yield flush()
        close()
        if out:
            yield flush()

    rows = dealt.sortWithinPartitions(*ORDER).select("conv_id", "turn", "role", "text", "digest", _blank(F.col("text")), _truncated(F.col("text")), "live")
    return rows.toDF("conv_id", "turn", "role", "text", "digest", "blank", "truncated", "live").mapInArrow(run, schema)


_TURN = pa.struct([("role", pa.string()), ("text", pa.string())])
_ARROW = {"audit": pa.string(), "repaired_sha256": pa.string(), "repaired": pa.list_(_TURN)}


# -- conversations over several ranges ----------------------------------------------------------

_PART = "key string, part int, blank long, duplicate long, truncated long, illegal long, low long, high long, turns long, first string, last string, n long, ways array<string>, costs array<long>, audits array<string>"


def _segment(table: pa.Table) -> pa.Table:
    rows = sorted(zip(*(table.column(c).to_pylist() for c in ("pos", "turn", "initial", "fault")), strict=True))
    rows = [r[1:] for r in rows]
    out = _counts(rows)
    turns = [(initial, _KIND[fault]) for _, initial, fault in rows]
    whole = {a + a: (0, "") for a in STATES}
    for i in range(0, len(turns), SEGMENT):  # (min, least) product of the segments' tables
        step = tables(turns[i:i + SEGMENT])
        joined: dict[str, tuple[int, str]] = {}
        for (a, b), (cost, audit) in whole.items():
            for c in STATES:
                got = step.get(b + c)
                if got is not None:
                    new = (cost + got[0], audit + got[1])
                    if a + c not in joined or new < joined[a + c]:
                        joined[a + c] = new
        whole = joined
    ways = sorted(whole)
    row = {"key": table.column("key")[0].as_py(), "part": table.column("part")[0].as_py(), **out,
           "first": rows[0][1], "last": rows[-1][1], "n": len(rows), "ways": ways, "costs": [whole[w][0] for w in ways], "audits": [whole[w][1] for w in ways]}
    return pa.Table.from_pylist([row], schema=_arrow_schema(_PART))


def _arrow_schema(ddl: str) -> pa.Schema:
    types = {"string": pa.string(), "int": pa.int32(), "long": pa.int64(), "array<string>": pa.list_(pa.string()), "array<long>": pa.list_(pa.int64()),
             "array<int>": pa.list_(pa.int32())}
    return pa.schema([(f.split()[0], types[f.split()[1]]) for f in ddl.split(", ")])


_CHAINED = "key string, gaps long, blank long, duplicate long, truncated long, illegal long, cost long, audit string, parts array<int>, states array<string>, audits array<string>"


def _chained(table: pa.Table) -> pa.Table:
    parts = sorted(table.to_pylist(), key=lambda r: r["part"])
    cost, way = chain([{w: (c, a) for w, c, a in zip(p["ways"], p["costs"], p["audits"], strict=True)} for p in parts])
    distinct, before = 0, None
    for p in parts:
        if p["turns"]:
            distinct += p["turns"] - (p["low"] == before)
            before = p["high"]
    known = [p for p in parts if p["turns"]]
    illegal = sum(p["illegal"] for p in parts) + sum(a["last"] + b["first"] not in ("su", "ua", "au") for a, b in zip(parts, parts[1:], strict=False))
    row = {"key": parts[0]["key"], "gaps": max(p["high"] for p in known) - min(p["low"] for p in known) + 1 - distinct if known else 0,
           **{c: sum(p[c] for p in parts) for c in ("blank", "duplicate", "truncated")}, "illegal": illegal, "cost": cost,
           "audit": "".join(a for _, a in way), "parts": [p["part"] for p in parts], "states": [s for s, _ in way], "audits": [a for _, a in way]}
    return pa.Table.from_pylist([row], schema=_arrow_schema(_CHAINED))


def _lines(rows: pa.Table, plan: pa.Table) -> pa.Table:
    schema = pa.schema([("key", pa.string()), ("part", pa.int32()), ("i", pa.int64()), ("role", pa.string()), ("text", pa.string())])
    if not len(plan) or not len(rows):
        return schema.empty_table()
    rows = sorted(zip(*(rows.column(c).to_pylist() for c in ("pos", "role", "text")), strict=True))
    p = plan.to_pylist()[0]
    done = list(edited([r[1:] for r in rows], p["state"], p["audit"]))
    return pa.Table.from_arrays([pa.array([p["key"]] * len(done)), pa.array([p["part"]] * len(done), pa.int32()), pa.array(range(len(done)), pa.int64()),
                                 pa.array([r for r, _ in done]), pa.array([t for _, t in done])], schema=schema)


def _hash_lines(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """SHA-256 of each conversation's lines, streamed in order."""
    keys, sums, now, digest = [], [], None, None
    for batch in batches:
        for key, role, text in zip(*(batch.column(i).to_pylist() for i in range(3)), strict=True):
            if key != now:
                if digest is not None:
                    keys.append(now)
                    sums.append(digest.hexdigest())
                now, digest = key, hashlib.sha256(f"{role}:{text}".encode())
            else:
                digest.update(f"\n{role}:{text}".encode())
    if digest is not None:
        keys.append(now)
        sums.append(digest.hexdigest())
    yield pa.RecordBatch.from_arrays([pa.array(keys, pa.string()), pa.array(sums, pa.string())], names=["key", "repaired_sha256"])


def _across(dealt: DataFrame, border: list, texts: bool) -> DataFrame:
    """Results of the conversations that lie in several ranges, those in ``border``."""
    known = [c for c in border if c is not None]
    chosen = F.col("conv_id").isin(known) if known else F.lit(False)
    if None in border:
        chosen = chosen | F.col("conv_id").isNull()
    everyone = dealt.where(chosen).withColumn("key", _key(F.col("conv_id")))
    at = Window.partitionBy("key", "part").orderBy(*ORDER[1:])
    rows = cut_lineage(everyone.where("live").withColumn("pos", F.row_number().over(at)).withColumn("same", F.concat_ws("/", "key", "digest")))
    firsts = rows.groupBy("same").agg(F.min(F.struct("part", "pos")).alias("first"))
    flagged = hot_cold_join(rows.select("same", "key", "part", "pos", "turn", "role", _blank(F.col("text")).alias("blank"), _truncated(F.col("text")).alias("cut")), firsts, "same")
    fault = F.when(F.col("blank"), "blank").when(F.struct("part", "pos") != F.col("first"), "duplicate").when(F.col("cut"), "truncated").otherwise("")
    narrow = flagged.select("key", "part", "pos", F.col("turn").cast("long").alias("turn"), F.substring("role", 1, 1).alias("initial"), fault.alias("fault"))
    done = cut_lineage(narrow.groupBy("key", "part").applyInArrow(_segment, _PART).groupBy("key").applyInArrow(_chained, _CHAINED))
    plan = done.select("key", F.explode(F.arrays_zip("parts", "states", "audits")).alias("p")).select(
        "key", F.col("p.parts").alias("part"), F.col("p.states").alias("state"), F.col("p.audits").alias("audit"))
    lines = rows.select("key", "part", "pos", "role", "text").groupBy("key", "part").cogroup(plan.groupBy("key", "part")).applyInArrow(
        _lines, "key string, part int, i long, role string, text string")
    lines = cut_lineage(lines) if texts else lines
    hashes = lines.repartition("key").sortWithinPartitions("key", "part", "i").select("key", "role", "text").mapInArrow(_hash_lines, "key string, repaired_sha256 string")
    ids = everyone.groupBy("key").agg(F.first("conv_id", ignorenulls=True).alias("conv_id"))  # those without a live turn too
    out = ids.join(done, "key", "left").join(hashes, "key", "left")
    zero = [F.coalesce(c, F.lit(0)).alias(c) for c in ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")]
    out = out.select("key", "conv_id", *zero, F.coalesce("audit", F.lit("")).alias("audit"), F.coalesce("repaired_sha256", F.lit(NOTHING)).alias("repaired_sha256"))
    if texts:
        turns = F.transform(F.array_sort(F.collect_list(F.struct("part", "i", "role", "text"))), lambda t: F.struct(t["role"].alias("role"), t["text"].alias("text")))
        none = F.array().cast("array<struct<role:string,text:string>>")
        out = out.join(lines.groupBy("key").agg(turns.alias("repaired")), "key", "left").withColumn("repaired", F.coalesce("repaired", none))
    return out.drop("key")


def repair(conversations: DataFrame, texts: bool = False, ranges: int | None = None) -> DataFrame:
    """``(conv_id, turn, role, text[, live])`` -> per conversation its faults, the cost and string of the cheapest edits and the hash of
    the repaired turns; with ``texts`` also the repaired turns themselves.  Rows that are not ``live`` only name their conversation."""
    rows = _turns(conversations)
    dealt = rows.repartitionByRange(ranges, *ORDER) if ranges else rows.repartitionByRange(*ORDER)
    dealt = cut_lineage(dealt.withColumn("part", F.spark_partition_id()))  # written once: a row's range is the same for all readers
    sides = dealt.groupBy("part").agg(F.min(F.struct(F.col("conv_id").isNotNull(), "conv_id")).alias("low"), F.max(F.struct(F.col("conv_id").isNotNull(), "conv_id")).alias("high")).collect()
    at: dict = {}
    for r in sides:  # two ids a range
        for side in (r["low"], r["high"]):
            at.setdefault(side["conv_id"], set()).add(r["part"])
    border = [c for c, parts in at.items() if len(parts) > 1]
    schema = f"conv_id {rows.schema['conv_id'].dataType.simpleString()}, {RESULT}" + (", repaired array<struct<role:string,text:string>>" if texts else "")
    inside = _inside(dealt, set(border), schema, texts)
    return inside.unionByName(_across(dealt, border, texts)) if border else inside


def damage(conversations: DataFrame) -> DataFrame:
    """The contract's damage by crc32 of ``conv_id:turn``; dropped rows stay as rows that are not live."""
    key = F.concat(F.coalesce(F.col("conv_id").cast("string"), F.lit(" ")), F.lit(":"), F.coalesce(F.col("turn").cast("string"), F.lit(" ")))
    kind = F.crc32(key.cast("binary")) % 20
    text = F.coalesce("text", F.lit(" "))
    text = F.when(kind == 1, "").when(kind == 2, F.translate(text, ".!?", "")).otherwise(text)
    role = F.when(kind == 4, "user").otherwise(F.coalesce("role", F.lit(" ")))
    copies = F.explode(F.when(kind == 3, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0))))
    return conversations.select("conv_id", "turn", role.alias("role"), text.alias("text"), (kind != 0).alias("live"), copies).drop("col")


def op11_conversation_repair(spark, sf_dir: str) -> DataFrame:
    return repair(damage(spark.read.parquet(f"{sf_dir}/conversations.parquet").select("conv_id", "turn", "role", "text")))
