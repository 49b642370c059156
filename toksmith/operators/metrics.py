"""Tokenizer and corpus metrics over encoded tables ``(doc_id, ids, n_tokens, …)``.

All metrics are aggregations; frequency tables are bounded by the vocabulary
size, so joins against them are broadcast-safe and windows over them are
small.  Entropies use the window-free identity
``H = log2 N − (1/N) Σ n·log2 n``.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from toksmith.functions.symbols import adjacent_pairs, char_id, chars, pair_left, pair_right
from toksmith.operators.pairs import id_pairs

# ---------------------------------------------------------------------------
# The characters Python's str.split()/str.isspace() treat as
# whitespace, so that "words" are counted the same way.
# ---------------------------------------------------------------------------
WHITESPACE_CLASS = (
    r"[\t\n\x{0b}\x{0c}\r\x{1c}-\x{1f} \x{85}\x{a0}\x{1680}\x{2000}-\x{200a}"
    r"\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}]"
)
# ---------------------------------------------------------------------------


def _c(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def n_words(text) -> Column:
    """Whitespace-separated words (runs collapse, ends trimmed)."""
    return F.size(F.filter(F.split(_c(text), WHITESPACE_CLASS + "+"), lambda x: x != ""))


def r6(c) -> Column:
    return F.round(_c(c).cast("double"), 6)


def compression(enc: DataFrame, by: str = "lang") -> DataFrame:
    """Bytes per token (A8), per group and overall (rollup: the total row has a NULL group)."""
    return enc.rollup(by).agg(
        F.count(F.lit(1)).alias("n_docs"),
        F.sum(F.octet_length("text")).cast("bigint").alias("n_bytes"),
        F.sum("n_tokens").cast("bigint").alias("n_tokens"),
    ).withColumn("bytes_per_token", r6(F.col("n_bytes") / F.col("n_tokens")))


def fertility(enc: DataFrame, by: str = "lang") -> DataFrame:
    """Tokens per whitespace word (Q2) and tokens per 1,000 characters (Q3)."""
    return enc.groupBy(by).agg(
        F.sum("n_tokens").cast("bigint").alias("n_tokens"),
        F.sum(n_words("text")).cast("bigint").alias("n_words"),
        F.sum(F.length("text")).cast("bigint").alias("n_chars"),
    ).select(
        by, "n_tokens", "n_words", "n_chars",
        r6(F.col("n_tokens") / F.col("n_words")).alias("fertility"),
        r6(F.lit(1000.0) * F.col("n_tokens") / F.col("n_chars")).alias("tokens_per_1k_chars"),
    )


def utf8_width(df: DataFrame, by: str = "lang", text: str = "text") -> DataFrame:
    """Characters by UTF-8 width (1–4 bytes) per group (Q4)."""
    ex = df.select(by, F.explode(F.split(text, "")).alias("ch")).where(F.col("ch") != "")
    return ex.groupBy(by, F.octet_length("ch").cast("bigint").alias("width")).agg(
        F.count(F.lit(1)).alias("n_chars"))


def token_freq(enc: DataFrame, by: tuple = ()) -> DataFrame:
    """``(…by, id, n)``: token frequencies (Q6); partial aggregation absorbs hot tokens.
    Works on symbol strings (``sym``) when present: tokens are counted as
    characters and mapped to IDs after the aggregation (≤ vocab-size rows)."""
    if "sym" in enc.columns:
        ex = enc.select(*by, F.explode(chars(F.col("sym"))).alias("c"))
        agg = ex.groupBy(*by, "c").agg(F.count(F.lit(1)).alias("n"))
        return agg.select(*by, char_id("c").cast("bigint").alias("id"), "n")
    ex = enc.select(*by, F.explode("ids").alias("id"))
    return ex.groupBy(*by, F.col("id").cast("bigint").alias("id")).agg(F.count(F.lit(1)).alias("n"))


def zipf(freq: DataFrame) -> DataFrame:
    """Rank, share and cumulative share by frequency (W4).  ``freq`` has at most
    vocab-size rows, so the global ordering window is bounded."""
    w = Window.orderBy(F.col("n").desc(), F.col("id"))
    total = F.sum("n").over(Window.partitionBy())
    return freq.select(
        "id", "n", F.row_number().over(w).cast("bigint").alias("rank"),
        r6(F.col("n") / total).alias("share"),
        r6(F.sum("n").over(w.rowsBetween(Window.unboundedPreceding, 0)) / total).alias("cum_share"),
    )


def entropy(freq: DataFrame, chars: DataFrame, by: str = "lang") -> DataFrame:
    """Unigram token entropy (bits/token) and bits per character per group (Q9).
    ``freq``: (by, id, n); ``chars``: (by, n_chars)."""
    h = freq.groupBy(by).agg(
        F.sum("n").alias("N"), F.sum(F.col("n") * F.log2("n")).alias("s"), F.count("id").alias("n_types"))
    h = h.select(by, "N", "n_types", (F.log2("N") - F.col("s") / F.col("N")).alias("H"))
    return h.join(chars, by).select(
        by, F.col("N").alias("n_tokens"), F.col("n_types").cast("bigint").alias("n_types"),
        r6("H").alias("bits_per_token"),
        r6(F.col("H") * F.col("N") / F.col("n_chars")).alias("bits_per_char"),
    )


def bigram_counts(enc: DataFrame) -> DataFrame:
    """Adjacent token pairs within each sequence: ``(a, b, n)``."""
    if "sym" in enc.columns:
        ex = enc.select(F.explode(adjacent_pairs(F.col("sym"))).alias("p"))
        agg = ex.groupBy("p").agg(F.count(F.lit(1)).alias("n"))
        return agg.select(pair_left("p").cast("bigint").alias("a"), pair_right("p").cast("bigint").alias("b"), "n")
    ex = enc.select(F.explode(id_pairs(F.col("ids"))).alias("p"))
    return ex.groupBy(F.col("p.l").cast("bigint").alias("a"), F.col("p.r").cast("bigint").alias("b")).agg(
        F.count(F.lit(1)).alias("n"))


def mutual_information(enc: DataFrame) -> DataFrame:
    """Adjacent-token information measures in bits, one row (Q10, Q11):
    I(A;B) = log2 T + (Σn·log2 n − Σn·log2 n_a − Σn·log2 n_b)/T,
    H(A,B) = log2 T − Σn·log2 n / T,  H(A) = log2 T − Σn·log2 n_a / T,
    H(B|A) = H(A,B) − H(A).  Marginals have at most vocab-size rows (broadcast)."""
    # marginals as windows over the aggregated bigram table (≤ vocab² rows): the
    # corpus is read and encoded once, no branch recomputes it
    j = bigram_counts(enc)
    x = j.withColumn("na", F.sum("n").over(Window.partitionBy("a"))) \
         .withColumn("nb", F.sum("n").over(Window.partitionBy("b")))
    s = x.agg(
        F.sum("n").alias("T"),
        F.sum(F.col("n") * F.log2("n")).alias("s_ab"),
        F.sum(F.col("n") * F.log2("na")).alias("s_a"),
        F.sum(F.col("n") * F.log2("nb")).alias("s_b"),
    )
    lt = F.log2("T")
    return s.select(
        F.col("T").cast("bigint").alias("n_pairs"),
        r6(lt + (F.col("s_ab") - F.col("s_a") - F.col("s_b")) / F.col("T")).alias("mutual_info"),
        r6(lt - F.col("s_ab") / F.col("T")).alias("joint_entropy"),
        r6(lt - F.col("s_a") / F.col("T")).alias("left_entropy"),
        r6((F.col("s_a") - F.col("s_ab")) / F.col("T")).alias("cond_entropy"),
    )


def perplexity_by_model(logprobs: DataFrame) -> DataFrame:
    """Q12: ``(model, doc_id, pos, piece BINARY, logprob)`` -> perplexity, bits per character and per byte of each model.
    Characters are counted where their first byte is, so pieces may cut them.  Rows are summed by piece first: a model has no more
    pieces than its vocabulary, so that is a partial aggregate in the task, and a piece is looked at once, not once a token."""
    first_bytes = F.length(F.regexp_replace(F.decode("piece", "ISO-8859-1"), r"[\x{80}-\x{bf}]", ""))
    by_piece = logprobs.groupBy("model", "piece").agg(F.count("logprob").alias("n"), F.sum("logprob").alias("lp"), F.count(F.lit(1)).alias("k"))
    g = by_piece.groupBy("model").agg(F.sum("n").alias("n_tokens"), F.sum("lp").alias("_lp"),
                                      F.sum(F.col("k") * first_bytes).alias("_chars"), F.sum(F.col("k") * F.octet_length("piece")).alias("_bytes"))
    bits = -F.col("_lp") / F.log(F.lit(2.0))
    return g.select("model", "n_tokens", r6(F.exp(-F.col("_lp") / F.col("n_tokens"))).alias("perplexity"),
                    r6(bits / F.col("_chars")).alias("bits_per_char"), r6(bits / F.col("_bytes")).alias("bits_per_byte"))


def number_spans(chunks: DataFrame, model) -> DataFrame:
    """Q16: ``(number, n_chunks, n_tokens, pieces, n_occurrences)`` of the whole numbers that stand in several adjacent digit chunks.

    Gaps and islands: consecutive positions minus their row number are constant within a run of digit chunks.  ``pieces``
    are each chunk's token IDs, chunks separated by ``|``."""
    from toksmith.functions.symbols import byte_symbols, symbols_ids
    from toksmith.operators.encode import fold

    digits = chunks.where(F.col("chunk").rlike(r"^\p{N}+$"))
    run = F.col("chunk_pos") - F.row_number().over(Window.partitionBy("doc_id").orderBy("chunk_pos"))
    ids = symbols_ids(fold(byte_symbols("chunk"), model))
    part = F.struct("chunk_pos", "chunk", ids.alias("ids"))
    runs = digits.withColumn("run", run).groupBy("doc_id", "run").agg(F.array_sort(F.collect_list(part)).alias("parts")).where(F.size("parts") > 1)
    numbers = runs.select(
        F.array_join(F.transform("parts", lambda p: p["chunk"]), "").alias("number"), F.size("parts").cast("bigint").alias("n_chunks"),
        F.aggregate("parts", F.lit(0), lambda n, p: n + F.size(p["ids"])).cast("bigint").alias("n_tokens"),
        F.array_join(F.transform("parts", lambda p: F.array_join(p["ids"], " ")), "|").alias("pieces"))
    return numbers.groupBy("number", "n_chunks", "n_tokens", "pieces").agg(F.count(F.lit(1)).alias("n_occurrences"))
