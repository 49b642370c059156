"""The dictionary plan's blocks travel in parts, and texts are cut into segments inside the tasks."""

import random

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from toksmith.functions import patterns
from toksmith.functions.symbols import sym
from toksmith.model import Merge, Model
from toksmith.operators import batches
from toksmith.operators import encode as EN

REGEX = Model("regex", [Merge(0, 97, 98, 256, 1), Merge(1, 256, 99, 257, 1)], pattern=patterns.resolve("gpt4"))
BASIC = Model("basic", [Merge(0, 97, 98, 256, 1), Merge(1, 256, 99, 257, 1), Merge(2, 32, 97, 258, 1)], specials={"<|a|>": 900})
CHAR = Model("char", [Merge(0, 3, 4, 7, 1), Merge(1, 7, 5, 8, 1)], alphabet="abc▁", add_bos=True, add_eos=True)


def _texts():
    r = random.Random(5)
    return [None, "", "a", "<|a|>", "ab<|a|>abc é", "\n"] + ["".join(r.choice("abc d<|a|>é") for _ in range(r.randint(1, 80))) for _ in range(60)]


@pytest.mark.parametrize("part", [1, 200, 1 << 18])
@pytest.mark.parametrize("model", [REGEX, BASIC, CHAR])
def test_parts_and_slices_of_any_size_give_the_same_rows(spark, monkeypatch, model, part):
    monkeypatch.setattr(EN, "PART", part)
    monkeypatch.setattr(EN, "SLICE_BYTES", part)
    monkeypatch.setattr(EN, "BLOCK", 1500)
    df = spark.createDataFrame([(i // 3, t) for i, t in enumerate(_texts())], "doc_id long, text string").repartition(2)
    a, b = (sorted(map(str, EN.encode(df, model, allowed_special="all", strategy=s, keep=("text",)).collect())) for s in ("inline", "dictionary"))
    assert a == b and len(a) == 66


def test_no_value_is_as_large_as_a_block(spark, monkeypatch):
    from pyspark.sql.pandas.types import to_arrow_schema
    from pyspark.sql.types import StructType

    monkeypatch.setattr(EN, "PART", 4000)
    df = spark.createDataFrame([(i, " abc" * 300) for i in range(40)] + [(None, None)], "doc_id long, text string").coalesce(1)
    text = F.replace("text", F.lit(" "), F.lit(EN.SEP)).alias("text")
    shape = StructType.fromDDL("block BIGINT, rows ARRAY<STRUCT<doc_id: BIGINT>>, segs STRING, texts ARRAY<ARRAY<INT>>")
    rows = df.select(F.struct("doc_id").alias("row"), text).mapInArrow(EN._blocks(to_arrow_schema(shape)), shape).collect()
    assert len({r["block"] for r in rows}) == 1 and [r["segs"] for r in rows if r["segs"] is not None] == [EN.SEP + "abc"]
    assert max(sum(map(len, filter(None, r["texts"]))) for r in rows) <= 602 and sum(len(r["rows"]) for r in rows) == 41


def test_texts_are_cut_where_no_piece_spans():
    inside = np.zeros(batches.MAP, dtype=bool)
    inside[batches._places(*EN._adjacent(CHAR))] = True
    a, b, c, s = (sym(i) for i in (3, 4, 5, 6))
    got = EN._cut(pa.array([a + b + c + s + a, None, "", b, a + EN.SEP + EN.DONE + c + EN.SEP + b]), inside).to_pylist()
    assert got == [EN.SEP.join([a + b + c, s, a]), None, "", b, EN.SEP.join([a, EN.DONE + c, b])]


def test_pages_of_large_rows_stay_small(spark):
    import pyarrow.parquet as pq

    from toksmith.session import write_once

    df = spark.range(60).select("id", F.array_join(F.transform(F.sequence(F.lit(1), F.lit(40_000)), lambda i: F.hex(i * 7919 + F.col("id"))), "").alias("text")).coalesce(1)
    written = write_once(df, large_rows=True)
    assert written.agg(F.sum(F.length("text"))).first()[0] == df.agg(F.sum(F.length("text"))).first()[0]
    (file,) = written.inputFiles()
    column = pq.ParquetFile(file.removeprefix("file://")).metadata.row_group(0).column(1)
    with open(file.removeprefix("file://"), "rb") as raw:
        data = raw.read()
    pages = data[column.data_page_offset:column.data_page_offset + column.total_compressed_size]
    assert len(pages) > 1 << 20 and _page_bytes(pages) < 2 << 20


def _page_bytes(data):
    """Uncompressed size of the first data page, from its header (Thrift compact: field 2 is a zigzag number)."""
    at = data.index(b"\x15", 1) + 1
    value = shift = 0
    while True:
        value |= (data[at] & 0x7F) << shift
        if data[at] < 0x80:
            return value >> 1
        at, shift = at + 1, shift + 7
