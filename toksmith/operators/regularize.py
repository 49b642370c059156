"""Subword regularization: BPE-dropout.

Each merge is skipped for a whole text with probability ``p``; the draw is
a deterministic integer hash of (key, rank, seed), so reruns, retries and
an SQL recomputation all agree.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from toksmith.functions.symbols import byte_symbols
from toksmith.model import Model
from toksmith.operators import encode as EN
from toksmith.operators import pretokenize as PT
from toksmith.operators.batches import fold_some

# Fixed values of the draw: multiplier, rank step and modulus of the integer hash.
HASH_MULT, HASH_STEP, HASH_MOD = 2654435761, 40503, 1000003


def dropped(key: Column, rank: Column, p: float, seed: int) -> Column:
    """True when merge ``rank`` (1-based) is skipped for this key."""
    h = F.pmod(key * F.lit(HASH_MULT) + rank * F.lit(HASH_STEP) + F.lit(seed), F.lit(HASH_MOD))
    return h < F.lit(int(p * HASH_MOD))


def dropout_symbols(text: Column, key: Column, model: Model, p: float, seed: int = 0) -> Column:
    """Regex-model encoding with BPE-dropout: chunks joined by a separator no merge contains."""
    chunks = PT.split_column(text, model.pattern)
    s = F.array_join(F.transform(chunks, lambda c: byte_symbols(c)), EN.SEP)
    if model.merges:
        kept = F.filter(F.sequence(F.lit(1), F.lit(len(model.merges))), lambda i: F.coalesce(~dropped(key, i, p, seed), F.lit(True)))
        s = fold_some(s, kept, model)
    return F.replace(s, F.lit(EN.SEP), F.lit(""))
