from toksmith.model import Merge, Model
from toksmith.operators import encode as EN
from toksmith.operators import specials as SP
from toksmith.operators import windows as WN
from toksmith.plans import catalog
from toksmith.sources import model_io


def test_pack_keeps_null_keys_and_empty_tables(spark):
    kind = "doc_id long, n_tokens long"
    rows = WN.pack(spark.createDataFrame([(None, 3), (5, 4), (7, 1)], kind), 4).collect()
    assert [(r["doc_id"], r["offset"], r["length"]) for r in sorted(rows, key=lambda r: r["offset"])] == [(None, 0, 4), (5, 4, 5), (7, 9, 2)]
    assert WN.pack(spark.createDataFrame([], kind), 4).count() == 0


def test_strip_leaves_no_special(spark):
    df = spark.createDataFrame([("<|pad<|pad|>|>",), ("a<|pad|>b",), ("<|p<|pa<|pad|>d|>ad|>x",), (None,), ("",)], "t string")
    assert [r[0] for r in df.select(SP.strip("t", ["<|pad|>"])).collect()] == ["", "ab", "x", None, ""]


def test_char_model_survives_json(spark, tmp_path):
    model = Model("char", [Merge(0, 3, 4, 6, 0)], alphabet="ab▁", add_bos=True, add_eos=True)
    model_io.save_json(spark, model, str(tmp_path / "m"))
    again = model_io.load_json(spark, str(tmp_path / "m"))
    df = spark.createDataFrame([(1, "ab ba")], "doc_id long, text string")
    assert (again.kind, again.alphabet, again.add_bos) == ("char", "ab▁", True)
    assert EN.encode(df, again).collect() == EN.encode(df, model).collect() and EN.encode(df, model).first()["ids"] == [1, 6, 5, 4, 3, 2]


def test_byte_helpers(spark):
    r = spark.sql("select 'é' c, '' e, 'abcde' t, cast(null as string) n").select(
        catalog.byte_fallback_tokens("c"), catalog.byte_patch_column("e"), catalog.byte_patch_column("t"), catalog.byte_patch_column("n")).first()
    assert r[0] == ["<0xC3>", "<0xA9>"] and r[1] == [] and [bytes(x) for x in r[2]] == [b"abcd", b"e"] and r[3] is None
