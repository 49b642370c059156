"""op10: words of a bucket are solved together, and documents cross the shuffle packed."""

import random

import brute
import pytest

from toksmith.llm import op10_sentencepiece as op10


def _model():
    bytes_ = [bytes([b]) for b in range(256)]
    names = ["a", "aa", "aaa", "aaaa", "b", "ab", "ba", "▁", "▁a", "é"]
    pieces = [(p, 256 + k, -float(len(p))) for k, p in enumerate(names)]  # equal sums everywhere
    return op10.Pieces(pieces, list(range(256)), bytes_ + [p.replace("▁", " ").encode() for p in names])


def test_equal_sums_in_short_and_long_words(spark):
    model, r = _model(), random.Random(3)
    texts = ["".join(r.choice("aaab é?") for _ in range(r.choice((1, 5, 39, 40, 41, 300)))) for _ in range(60)] + ["", "a", "a" * 40, "a" * 39, "a" * 1000, None, "a" * 40]
    rows = spark.createDataFrame([(k if k % 7 else None, t, [k]) for k, t in enumerate(texts)], "doc_id long, text string, extra array<int>")
    got = {r["extra"][0]: r for r in op10.encode(rows, model).collect()}
    assert len(got) == len(texts)
    table = {p: (i, s) for p, i, s in model.pieces}
    for k, t in enumerate(texts):
        assert got[k]["doc_id"] == (k if k % 7 else None) and got[k]["text"] == t
        want = t and [i for w in op10.split(t) for p, n in brute.segment(w, table, model.longest, model.unknown_score)
                      for i in ([n] if n >= 0 else [model.byte_ids[b] for b in p.encode()])]
        assert (got[k]["ids"] is None) if t is None else list(got[k]["ids"]) == list(want)


def test_plan_packs_documents_and_groups_no_edges(spark):
    rows = spark.createDataFrame([(1, "a b aa")], "doc_id long, text string")
    plan = op10.encode(rows, _model())._jdf.queryExecution().executedPlan().toString()
    assert "ObjectHashAggregate" not in plan and "SortAggregate" not in plan
    assert plan.count("MapInArrow") >= 1


@pytest.mark.parametrize("n", [1, 3])
def test_packed_rows_come_back(n):
    import pyarrow as pa

    rows = pa.table({"block": pa.array([k % n for k in range(10)], pa.int64()), "row": [{"k": k} for k in range(10)], "text": [None if k == 4 else str(k) for k in range(10)]})
    packed = pa.Table.from_batches(list(op10._pack(iter(rows.to_batches()))))
    assert sorted(packed.column("block").to_pylist()) == list(range(n))
    back = pa.concat_tables(op10._unpacked(packed))
    assert sorted((x["row"]["k"], x["text"]) for x in back.to_pylist()) == [(k, None if k == 4 else str(k)) for k in range(10)]
    assert pa.concat_tables(op10._unpacked(packed, only_text=True)).column_names == ["text"]
