"""Printable rendering of vocabulary pieces (the vocab listing)."""

import unicodedata

from pyspark.sql import functions as F

from toksmith.operators import audit as AU


def render(b: bytes) -> str:
    s = b.decode("utf-8", errors="replace")
    return "".join(f"\\x{ord(c):02x}" if unicodedata.category(c)[0] in "CZ" else c for c in s)


def test_render_piece_matches_python(spark):
    pieces = [b"hello", b" a", b"\n", b"\t\r", b"\x00", b"\xe3\x81", "é".encode(), " x".encode(), b"\x7f", "😊".encode()]
    df = spark.createDataFrame([(i, bytearray(p)) for i, p in enumerate(pieces)], "id int, piece binary")
    got = [r.r for r in df.select("id", AU.render_piece(F.col("piece")).alias("r")).orderBy("id").collect()]
    assert got == [render(p) for p in pieces]
