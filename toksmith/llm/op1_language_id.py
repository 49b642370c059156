"""Language ID by compression.

One zstandard raw-content dictionary per language; a text (lower-cased, runs of
other characters than letters as one space) is encoded with each of them, block
by block, so that a dictionary stays in reach of a long text's whole length;
the dictionary that leaves the fewest bytes names the language.  A narrow
margin between the best two is a rejection, for texts of every length: a short
text, whose sizes are a few whole bytes, is rejected when its best two are equal.

The dictionaries come from a bounded sample of labelled rows, bounded by parameters
of :func:`learn`: per language the ``sample_rows`` texts of smallest id hash, of each
at most ``row_bytes`` bytes spread over its length, ``dict_bytes`` in all.  Ties go to the language with
more training rows, then to the smaller name.

Defined cases: a null text or one without a letter is ``und`` with score 0 and
is rejected; null languages are not learned; without any labelled row every
text is ``und``; null ids hash as the empty text, which holds them out; each input row, repeated
ones included, gives one output row; an empty table gives an empty result;
other columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
import regex
import zstandard
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

SAMPLE_ROWS = 120
ROW_BYTES = 1536
DICT_BYTES = 64 * 1024
MAX_LANGUAGES = 512
BLOCK_BYTES = 16 * 1024
LEVEL = 5
#: best and second-best compressed size closer than this share of the best: rejected
MIN_MARGIN = 0.002
UND = "und"

_OTHER = regex.compile(r"\P{L}+")  # signs such as ² or ½ are no letters


def _letters(text: str) -> str:
    return _OTHER.sub(" ", text.lower())


def held_out(doc_id: str = "doc_id") -> Column:
    """A null id counts as the empty text, so its rows are held out."""
    return F.crc32(F.coalesce(F.col(doc_id).cast("string"), F.lit("")).cast("binary")) % 5 == 0


def _excerpt(text: str, row_bytes: int = ROW_BYTES) -> bytes:
    """At most ``row_bytes`` bytes of a training text: three stretches across it."""
    raw = _letters(text).encode()
    if len(raw) <= row_bytes:
        return raw
    part = row_bytes // 3
    return b" ".join(raw[a:a + part] for a in (0, (len(raw) - part) // 2, len(raw) - part))


def learn(train: DataFrame, doc_id: str = "doc_id", text: str = "text", lang: str = "lang", sample_rows: int = SAMPLE_ROWS,
          row_bytes: int = ROW_BYTES, dict_bytes: int = DICT_BYTES, max_languages: int = MAX_LANGUAGES) -> list[tuple[str, bytes]]:
    """``(language, dictionary)``, most frequent language first.  The sample is bounded by
    ``max_languages * sample_rows`` excerpts; the language counts cover all training rows, and more
    than ``max_languages`` languages (all dictionaries lie in each task's memory) are an error."""
    rows = train.select(F.col(doc_id).alias("d"), F.col(text).alias("t"), F.col(lang).alias("l")).where(
        F.col("l").isNotNull() & (F.length("t") > 0))
    counts = rows.groupBy("l").agg(F.count(F.lit(1)).alias("n")).orderBy(F.desc("n"), "l").limit(max_languages + 1).collect()
    if len(counts) > max_languages:
        raise ValueError(f"more than {max_languages} languages")

    @F.pandas_udf("binary")
    def cut(texts: pd.Series) -> pd.Series:
        return texts.map(lambda t: _excerpt(t, row_bytes))

    # the rank limit is applied within each task before the shuffle, on ids and hashes alone
    rank = F.row_number().over(Window.partitionBy("l").orderBy("h", "d", "x"))
    keyed = rows.withColumn("h", F.xxhash64(F.col("d").cast("string"))).withColumn("x", F.xxhash64("t"))
    picked = keyed.select("l", "h", "d", "x").withColumn("r", rank).where(F.col("r") <= sample_rows).select("h", "x").distinct()
    found = keyed.join(F.broadcast(picked), ["h", "x"]).select("l", "h", "x", cut("t").alias("e"))
    sample = found.groupBy("l", "h", "x").agg(F.min("e").alias("e"))
    by_lang: dict[str, list] = {}
    for r in sample.collect():
        by_lang.setdefault(r["l"], []).append((r["h"], r["x"], bytes(r["e"])))
    out = []
    for c in counts:
        content = b" ".join(e for *_, e in sorted(by_lang.get(c["l"], [])))[:dict_bytes]
        out.append((c["l"], content))
    return out


def predict(docs: DataFrame, dictionaries: list[tuple[str, bytes]], text: str = "text") -> DataFrame:
    """``docs`` with ``lang_pred``, ``score`` (0 to 1: how much smaller the best coding is than the
    second) and ``accepted``; sizes of at most ``MAX_LANGUAGES`` dictionaries go to the tasks."""
    names = [n for n, _ in dictionaries]

    def scorer(parts: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        coders = []
        for _, content in dictionaries:
            known = zstandard.ZstdCompressionDict(content, dict_type=zstandard.DICT_TYPE_RAWCONTENT)
            known.precompute_compress(level=LEVEL)
            coders.append(zstandard.ZstdCompressor(dict_data=known, write_content_size=False, write_dict_id=False, write_checksum=False))

        def one(t: str | None) -> tuple[str, float, bool]:
            plain = _letters(t) if t else ""
            if not coders or not plain.strip():
                return UND, 0.0, False
            raw = plain.encode()
            cuts = [raw[a:a + BLOCK_BYTES] for a in range(0, len(raw), BLOCK_BYTES)]
            size = [sum(len(c.compress(x)) for x in cuts) for c in coders]
            best = min(range(len(size)), key=size.__getitem__)
            if len(size) == 1:
                return names[0], 1.0, True
            second = min(s for i, s in enumerate(size) if i != best)
            gain = (second - size[best]) / size[best]
            return names[best], gain / (gain + 0.05), gain >= MIN_MARGIN

        for texts in parts:
            yield pd.DataFrame([one(t) for t in texts], columns=["lang_pred", "score", "accepted"])

    score = F.pandas_udf(scorer, "lang_pred string, score double, accepted boolean")
    kept = [c for c in docs.columns if c not in ("lang_pred", "score", "accepted")]
    row = F.struct(*(F.col(f"`{c}`") for c in kept)).alias("row")
    return docs.select(row, score(text).alias("found")).select("row.*", "found.*")


def op1_language_id(spark, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    model = learn(docs.where(~held_out()))
    return predict(docs.select("doc_id", held_out().alias("held_out"), "text"), model).drop("text")
