"""Text helpers that Spark SQL lacks as built-ins.

Unicode normalization has no Spark built-in; it runs as an Arrow-batched
pandas UDF and only on rows that contain non-ASCII characters (ASCII text is
already in every normal form).
"""

from __future__ import annotations

import unicodedata

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.functions import pandas_udf
from pyspark.sql.types import StringType


@pandas_udf(StringType())
def _nfc(s: pd.Series) -> pd.Series:
    return s.map(lambda t: None if t is None else unicodedata.normalize("NFC", t))


def nfc(text) -> Column:
    """NFC normal form of a text column."""
    text = F.col(text) if isinstance(text, str) else text
    return F.when(text.rlike("[^\\x00-\\x7f]"), _nfc(text)).otherwise(text)


def mixed_script_words(text, other: str = r"\p{IsCyrillic}|\p{IsGreek}") -> Column:
    """Words (letter runs) that mix Latin with Cyrillic or Greek letters."""
    text = F.col(text) if isinstance(text, str) else text
    words = F.regexp_extract_all(text, F.lit(r"\p{L}+"), 0)
    return F.filter(words, lambda w: w.rlike(r"\p{IsLatin}") & w.rlike(other))
