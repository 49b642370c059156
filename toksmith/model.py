"""Tokenizer models as small, bounded tables.

A model is at most ``vocab_size`` rows (merges, vocabulary, specials); its size
is a parameter, never a function of the corpus.  Encoding and decoding turn
the model into one constant array expression (constant-folded by Catalyst,
shipped once with the task), so no join or shuffle is needed per token.
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import types as T

from toksmith.functions import patterns
from toksmith.functions.symbols import const_list, sym

# Upper bound on model rows turned into literals (a vocabulary far larger than any in use).
MAX_MODEL_ROWS = 2_000_000


@dataclass
class Merge:
    rank: int
    left_id: int
    right_id: int
    new_id: int
    freq: int
    total_tokens: int | None = None


@dataclass
class Model:
    """``kind`` ∈ basic (bytes, no split), regex (bytes, pre-split), char (▁ characters)."""

    kind: str
    merges: list[Merge] = field(default_factory=list)
    pattern: str | None = None
    specials: dict[str, int] = field(default_factory=dict)
    alphabet: str = ""  # char models: base characters in ID order, IDs from 3
    add_bos: bool = False
    add_eos: bool = False
    byte_fallback: bool = False  # char models: 256 byte pieces after all others stand for characters outside the alphabet

    # -- vocabulary -------------------------------------------------------
    @property
    def byte_level(self) -> bool:
        return self.kind in ("basic", "regex")

    @property
    def first_merge_id(self) -> int:
        return 256 if self.byte_level else len(patterns.SP_SPECIALS) + len(self.alphabet)

    def pieces(self) -> dict[int, bytes | str]:
        """ID → piece (bytes for byte models, str for char models)."""
        if self.byte_level:
            v: dict[int, bytes | str] = {i: bytes([i]) for i in range(256)}
        else:
            v = {i: t for t, i in patterns.SP_SPECIALS.items()}
            for j, c in enumerate(self.alphabet):
                v[len(patterns.SP_SPECIALS) + j] = c
        for m in self.merges:
            v[m.new_id] = v[m.left_id] + v[m.right_id]
        if self.byte_level:
            for t, i in self.specials.items():
                v[i] = t.encode("utf-8")
        elif self.byte_fallback:
            for b in range(256):
                v[self.first_byte_id + b] = f"<0x{b:02X}>"
        return v

    @property
    def first_byte_id(self) -> int:
        """ID of ``<0x00>`` in a char model with byte fallback."""
        return self.first_merge_id + len(self.merges)

    def kinds(self) -> dict[int, str]:
        out = {}
        if self.byte_level:
            out.update({i: "byte" for i in range(256)})
        else:
            out.update({i: "special" for i in patterns.SP_SPECIALS.values()})
            out.update({len(patterns.SP_SPECIALS) + j: "char" for j in range(len(self.alphabet))})
        out.update({m.new_id: "merge" for m in self.merges})
        if self.byte_fallback and not self.byte_level:
            out.update({self.first_byte_id + b: "byte" for b in range(256)})
        out.update({i: "special" for i in self.specials.values()})
        return out

    @property
    def vocab_size(self) -> int:
        return len(self.pieces())

    def check(self) -> None:
        if len(self.merges) + len(self.alphabet) + len(self.specials) > MAX_MODEL_ROWS:
            raise ValueError("model larger than MAX_MODEL_ROWS")
        ids = {m.new_id for m in self.merges}
        for t, i in self.specials.items():
            if i in ids or (self.byte_level and i < 256):
                raise ValueError(f"special token {t!r} id {i} collides with the vocabulary")

    # -- constant expressions --------------------------------------------
    def merge_arrays(self) -> tuple[Column, Column]:
        """Constant arrays (pair symbols, new symbol) in rank order."""
        self.check()
        return (const_list([sym(m.left_id) + sym(m.right_id) for m in self.merges]),
                const_list([sym(m.new_id) for m in self.merges]))

    def piece_array(self) -> Column:
        """Constant ``array<string>`` indexed by ID+1; byte pieces as ISO-8859-1
        symbol strings, char pieces as text; holes are empty strings."""
        self.check()
        v = self.pieces()
        top = max(v) if v else -1
        if self.byte_level:
            arr = [v[i].decode("latin-1") if i in v else "" for i in range(top + 1)]
        else:
            arr = [v.get(i, "") for i in range(top + 1)]
        return const_list(arr)

    # -- tables ------------------------------------------------------------
    def merges_df(self, spark: SparkSession) -> DataFrame:
        v = self.pieces()
        rows = [
            (m.rank, m.left_id, m.right_id, m.new_id,
             bytearray(v[m.new_id]) if self.byte_level else bytearray(v[m.new_id].encode("utf-8")),
             m.freq, m.total_tokens)
            for m in self.merges
        ]
        schema = ("rank INT, left_id INT, right_id INT, new_id INT, piece BINARY, freq BIGINT, "
                  "total_tokens BIGINT")
        return spark.createDataFrame(rows, schema)

    def vocab_df(self, spark: SparkSession) -> DataFrame:
        v = self.pieces()
        k = self.kinds()
        rows = [(i, bytearray(p) if isinstance(p, bytes) else bytearray(p.encode("utf-8")), k[i])
                for i, p in sorted(v.items())]
        return spark.createDataFrame(rows, "id INT, piece BINARY, kind STRING")

    def specials_df(self, spark: SparkSession) -> DataFrame:
        sp = dict(self.specials) if self.byte_level else dict(patterns.SP_SPECIALS)
        return spark.createDataFrame(sorted(sp.items(), key=lambda x: x[1]), "token STRING, id INT")

    def meta_df(self, spark: SparkSession) -> DataFrame:
        return spark.createDataFrame(
            [(self.kind, self.pattern, self.add_bos, self.add_eos, len(self.merges), self.alphabet)],
            T.StructType([
                T.StructField("kind", T.StringType()), T.StructField("pattern", T.StringType()),
                T.StructField("add_bos", T.BooleanType()), T.StructField("add_eos", T.BooleanType()),
                T.StructField("n_merges", T.IntegerType()), T.StructField("alphabet", T.StringType()),
            ]),
        )

    def summary(self) -> dict:
        return {
            "kind": self.kind, "vocab_size": self.vocab_size, "n_merges": len(self.merges),
            "specials": sorted(self.specials) if self.byte_level else list(patterns.SP_SPECIALS),
            "pattern": self.pattern,
        }
