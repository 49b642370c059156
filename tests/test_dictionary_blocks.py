"""The dictionary plan sends a segment once a block of texts, not once an occurrence."""

import pytest
from pyspark.sql import functions as F

from toksmith.model import Merge, Model
from toksmith.operators import encode as EN
from toksmith.operators import pretokenize as PT

MODEL = Model("regex", [Merge(0, 97, 98, 256, 1), Merge(1, 256, 99, 257, 1), Merge(2, 32, 257, 258, 1)], pattern=PT.patterns.resolve("gpt4"), specials={"<|a|>": 900})


def _rows(spark):
    texts = ["abc abc abcab" * 40, None, "", "ab<|a|>abc é abc", "\n", "x" * 120 + "abc" * 50] * 3
    return spark.createDataFrame([(i % 4 or None, t, f"k{i}") for i, t in enumerate(texts)], "doc_id long, text string, tag string").repartition(2)


@pytest.mark.parametrize("size", [1, 300, 1 << 20])
def test_blocks_of_any_size_give_the_same_rows(spark, monkeypatch, size):
    monkeypatch.setattr(EN, "BLOCK", size)
    df = _rows(spark)
    a, b = (sorted(map(str, EN.encode(df, MODEL, allowed_special="all", strategy=s, keep=("tag", "text")).collect())) for s in ("inline", "dictionary"))
    assert a == b and len(a) == 18


def test_a_segment_is_sent_once_a_block(spark):
    from pyspark.sql.pandas.types import to_arrow_schema
    from pyspark.sql.types import StructType

    df = spark.createDataFrame([(1, "abc" + " abc" * 5000), (2, " abc" * 3000), (3, None)], "doc_id long, text string").coalesce(1)
    text = F.array_join(PT.split_column(F.col("text"), MODEL.pattern), EN.SEP).alias("text")
    shape = StructType.fromDDL("block BIGINT, rows ARRAY<STRUCT<doc_id: BIGINT>>, segs STRING, texts ARRAY<ARRAY<INT>>")
    block = df.select(F.struct("doc_id").alias("row"), text).mapInArrow(EN._blocks(to_arrow_schema(shape)), shape).collect()
    assert len(block) == 1 and block[0]["segs"].split(EN.SEP) == ["abc", " abc"]
    assert [t and len(t) for t in block[0]["texts"]] == [5001, 3000, None]
