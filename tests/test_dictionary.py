"""The dictionary of chunks is counted by hash, with exact first places."""

from toksmith.operators import pretokenize as PT


def test_first_places_without_a_sort(spark):
    big = 2**63 - 1
    rows = [(None, 3, "a"), (None, 2, "a"), (-5, 7, "a"), (big, 9, "b"), (big, 2**31 - 1, "c"), (-big - 1, 4, "d"), (-big - 1, 2**31 - 1, "e"), (0, 0, "f"), (-1, 5, "b")]
    df = spark.createDataFrame(rows, "doc_id LONG, chunk_pos INT, chunk STRING")
    d = PT.chunk_dictionary(df)
    got = {r["chunk"]: (r["n"], tuple(r["first"])) for r in d.collect()}
    assert got == {"a": (3, (None, 2)), "b": (2, (-1, 5)), "c": (1, (big, 2**31 - 1)), "d": (1, (-big - 1, 4)), "e": (1, (-big - 1, 2**31 - 1)), "f": (1, (0, 0))}
    plan = d._jdf.queryExecution().executedPlan().toString()
    assert "SortAggregate" not in plan and "HashAggregate" in plan
    named = PT.text_dictionary(spark.createDataFrame([("y", "t"), ("x", "t"), ("z", None)], "doc_id STRING, text STRING"))
    assert [(r["chunk"], r["n"], tuple(r["first"])) for r in named.collect()] == [("t", 2, ("x", 0))]
