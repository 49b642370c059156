import random

import brute
import duckdb
import pytest

from toksmith.llm import op3_pii as op3
from toksmith.llm import op5_line_dedup as op5
from toksmith.llm import op6_sharding as op6
from toksmith.llm import op7_warc_revisits as op7

PII = [
    None, "", "a@b.c@d.e f_g@h-i.co.uk", "x@y a@b.c_d@e.f", "1.2.3.4.5.6.7.8.9 300.1.1.1 00010.1.1.1", "4111 1111 1111 1111", "4111-1111-1111-1112 41111111111111111111 4111  1111",
    "+1 (555) 123-4567 +49 30 1234567890123456 +12", "é😊 a@b.com +1 555 123 4567)", "5 4111111111111111", "1 -2 4111-1111 1111-1111 3", "a" * 20000 + "@b.com", "1" * 20000,
    "+1" + "(" * 3000, "1." * 5000, "x@" + "a." * 5000 + "b", "@a@b@c.d@e.f.g", "1.2.3.4 " * 500]


def python_free(df):
    plan = df._jdf.queryExecution().executedPlan().toString()
    return not any(x in plan for x in ("Python", "Pandas", "InArrow"))


def test_pii_base_spans(make):
    out = op3.personal_data(make(PII))
    assert python_free(out)
    for r in out.collect():
        assert [(op3.KINDS[s["kind"]], s["start"], s["end"]) for s in r["base"]] == brute.personal_data(PII[r["doc_id"]])


def test_pii_added_spans_and_masking(make):
    texts = ["please call my phone (555) 234-5678 today", "my mail is bob (at) example (dot) com thanks", "invoice number 4111 1111 1111 1112 due",
             "see section 555 234 5678 of the release", "plain words only", "mail a@b.com"]
    docs = make(texts)
    found = op3.personal_data(docs)
    added = {r["doc_id"]: [texts[r["doc_id"]][s["start"]:s["end"]] for s in r["added"]] for r in found.collect()}
    assert added == {0: ["(555) 234-5678"], 1: ["bob (at) example (dot) com"], 2: [], 3: [], 4: [], 5: []}
    masked = {r["doc_id"]: r["text"] for r in op3.mask(docs, found).collect()}
    assert masked[0] == "please call my phone [phone] today" and masked[5] == "mail [email]" and masked[4] == texts[4]
    assert op3.personal_data(make([])).count() == 0


def test_pii_spans_added_without_a_cue(make):
    """Pattern and gazetteer together are enough; a failing check or a word against a span is not outvoted."""
    texts = ["office 555-234-5678 open", "bob at example dot com", "2001:db8:0:0:0:ff00:42:8329", "4111.1111.1111.1111 and 4111  1111  1111  1111",
             "4111.1111.1111.1112", "0:0:0:0:0:0:0:0", "version 555.234.5678", "4111 1111 1111 1111", None, "", "look at it dot 55"] + ["call +1 555 123 4567"] * 2
    ids = [None, None, *range(2, len(texts) - 1), len(texts) - 2]
    out = op3.personal_data(make(texts, ids))
    assert python_free(out)
    got = sorted((r["doc_id"] is not None, r["doc_id"] or 0, [(op3.KINDS[s["kind"]], s["start"], s["end"]) for s in r["added"]]) for r in out.collect())
    one = {d: spans for known, d, spans in got if known}
    assert sorted(s for known, _, s in got if not known) == [[("email", 0, 22)], [("phone", 7, 19)]]
    assert one[2] == [("ip", 0, 27)] and one[3] == [("card", 0, 19), ("card", 24, 46)]
    assert all(one[d] == [] for d in one if d > 3) and len(got) == len(texts)


def test_reliabilities_tell_a_bad_labeler():
    votes = [((1, 1, -1), 40), ((1, 1, 1), 40), ((-1, -1, 1), 40), ((-1, -1, -1), 40), ((0, 1, 0), 3)]
    p = op3.reliabilities(votes)
    assert p[(1, 1, -1)] > 0.9 and p[(-1, -1, 1)] < 0.1 and p[(0, 1, 0)] > 0.5


def test_line_dedup_equals_brute_force(make):
    r = random.Random(4)
    long = [" ".join(f"w{r.randrange(99)}" for _ in range(n)) for n in (op5.LONG_WORDS - 1, op5.LONG_WORDS, 60)]
    pool = ["alpha", "beta gamma", "", " ", "alpha ", "delta"] + long
    texts = ["\n".join(r.choice(pool) for _ in range(r.randint(1, 9))) for _ in range(60)] + [None, "", "\n", "\n\n", "alpha\nbeta gamma\nx\n" * 3, long[1] + "\n", "z" * 5000]
    ids = list(range(100, 100 + len(texts) - 1)) + [None]
    want = brute.line_dedup(list(zip(ids, texts, strict=True)), op5.MIN_LINES, op5.LONG_WORDS)
    out = op5.dedup_lines(make(texts, ids))
    assert python_free(out)
    rows = out.collect()
    assert {x["doc_id"]: x["text"] for x in rows} == want
    assert all(x["block"] == "b" and x["shard"] == 7 for x in rows)
    assert op5.dedup_lines(make([])).count() == 0
    twice = op5.dedup_lines(make(["a b\nc d\ne"] * 3, ids=[1, 1, 2])).collect()
    assert sorted((x["doc_id"], x["text"]) for x in twice) == [(1, "a b\nc d\ne"), (1, "a b\nc d\ne"), (2, "")]


def test_line_dedup_deletes_single_lines_of_ordinary_length(make):
    """A repeated line goes though the lines around it differ; a floor exempts shorter ones where asked for."""
    nine, seven, six = "one line of nine words stands here by itself", "a b c d e f g", "a b c d e f"
    texts = [f"first {i}\n{nine}\nsecond {i}\n{seven}\nthird {i}\n{six}\nlast {i}" for i in range(4)]
    got = {x["doc_id"]: (x["text"], x["n_removed"]) for x in op5.dedup_lines(make(texts), long_words=7).collect()}
    assert got[0] == (texts[0], 0)
    assert all(got[i] == (f"first {i}\nsecond {i}\nthird {i}\n{six}\nlast {i}", 2) for i in (1, 2, 3))
    every = {x["doc_id"]: x["text"] for x in op5.dedup_lines(make([f"a\n{i}x\n\n{i}y\nb c\n \nz" for i in range(3)])).collect()}
    # by default any line with a word goes, a blank one only inside a repeated run
    assert every == {0: "a\n0x\n\n0y\nb c\n \nz", 1: "1x\n\n1y", 2: "2x\n\n2y"}


def test_line_dedup_oracle(spark, sf):
    con = duckdb.connect()
    con.execute(f"CREATE VIEW documents AS SELECT * FROM '{sf}/documents.parquet'")
    assert sorted(con.execute(op5.ORACLE).fetchall()) == sorted(tuple(r) for r in op5.op5_line_dedup(spark, sf).collect())


@pytest.mark.parametrize("n,shards", [(0, 8), (5, 8), (1003, 8), (1003, 3)])
def test_shards_are_even_and_gapless(make, n, shards):
    ids = [None if i % 7 == 0 else i // 3 for i in range(n)]
    out = op6.shard(make([None if i % 5 == 0 else f"t{i % 11}" for i in range(n)], ids), shards)
    assert python_free(out)
    rows = out.collect()
    assert len(rows) == n and all(r["block"] == "b" for r in rows)
    for s in range(shards):
        slots = sorted(r["slot"] for r in rows if r["shard"] == s)
        assert slots == list(range(len(slots))) and len(slots) in (n // shards, -(-n // shards))


def test_ring_moves_little_and_overflow_goes_clockwise(spark, make):
    nodes = op6.ring_nodes(spark, 8)
    assert set(op6.ring_nodes(spark, 8)) < set(op6.ring_nodes(spark, 9))  # a new shard only adds nodes
    order = op6.clockwise(nodes)
    assert all(sorted(o) == list(range(8)) for o in order)
    parts = op6.fill({0: 30, 1: 2}, [[0, 1, 2, 3]] * 2, 4)
    assert sum(p["upto"] for p in parts if p["cell"] == 1) and [p["shard"] for p in parts if p["cell"] == 0][:2] == [0, 1]
    home = op6.shard(make([f"t{i}" for i in range(4000)]), 8)
    cell = {r["doc_id"]: r["c"] for r in spark.range(4000).selectExpr("id doc_id", f"pmod(xxhash64(cast(id as string)), {op6.CELLS}) c").collect()}
    at_home = sum(order[cell[r["doc_id"]]][0] == r["shard"] for r in home.collect())
    assert at_home > 0.8 * 4000


def records(spark, rows):
    return spark.createDataFrame(rows, "record_id long, kind string, url string, ts long, etag string, last_modified string, digest string, headers map<string,string>")


def test_revisits(spark):
    u = "http://www.Ex.org:80/a/?b=2&utm_source=x&a=1#f"
    rows = [
        (1, "response", "https://ex.org/a?a=1&b=2", 10, '"x"', "mon", "d1", {"etag": '"x"', "content-length": "9", "age": "0"}),
        (2, "response", u, 20, '"y"', "tue", "d2", {"etag": '"y"', "server": "s"}),
        (3, "response", u, 20, '"z"', "tue", "d3", None),
        (4, "revisit", u, 15, 'W/"x"', None, None, {"content-length": "0", "age": "7"}),
        (5, "revisit", u, 20, '"x"', None, "d1", {}),
        (6, "revisit", u, 21, None, "tue", None, None),
        (7, "revisit", u, 21, '"y"', None, None, None),
        (8, "revisit", u, 21, None, None, None, None),
        (9, "revisit", u, 5, '"x"', None, None, None),
        (10, "revisit", None, 5, '"x"', None, None, None),
        (11, "revisit", u, None, '"x"', None, None, None),
        (12, "revisit", "mailto:x", 9, '"x"', None, None, None),
        (13, "revisit", u, 16, '"x"', None, "other", None),
        (4, "revisit", u, 15, 'W/"x"', None, None, {"content-length": "0", "age": "7"})]
    got = {}
    for r in op7.resolve(records(spark, rows)).collect():
        got.setdefault(r["record_id"], []).append((r["status"], r["refers_to"], r["headers"]))
    one = ("resolved", 1, {"etag": '"x"', "content-length": "9", "age": "7"})
    assert got[4] == [one, one] and got[5][0][:2] == ("resolved", 1) and got[6][0] == ("resolved", 3, {})
    assert [got[k][0][0] for k in (7, 8, 9, 10, 11, 12, 13)] == ["mismatch", "no_validator", "no_response", "unresolvable", "unresolvable", "unresolvable", "mismatch"]
    assert op7.resolve(records(spark, [])).count() == 0
    body = spark.createDataFrame([(1, "html")], "record_id long, html string")
    assert {r["html"] for r in op7.attach_body(op7.resolve(records(spark, rows)).where("record_id = 4"), body, "html").collect()} == {"html"}


def test_revisits_of_a_hot_url_cross_ranges(spark):
    rows = [(i, "response" if i % 50 == 0 else "revisit", "http://h/x", i, f'"{i // 50}"', None, None, None) for i in range(2000)]
    got = op7.resolve(records(spark, rows).repartition(5)).collect()
    assert all(r["status"] == "resolved" and r["refers_to"] == r["record_id"] // 50 * 50 for r in got) and len(got) == 1960


def test_revisit_oracle(spark, sf):
    con = duckdb.connect()
    con.execute(f"CREATE VIEW pages AS SELECT * FROM '{sf}/pages.parquet'")
    cur = con.execute(op7.ORACLE)
    names = [c[0] for c in cur.description]
    want = sorted(cur.fetchall())
    assert want and sorted(tuple(r[c] for c in names) for r in op7.op7_warc_revisits(spark, sf).collect()) == want
