"""WordPiece.

Training runs on the dictionary of distinct words (letter runs) with their
counts.  A word is a symbol string whose first symbol is an *initial* piece
and whose other symbols are *continuation* pieces (written ``##x``).  Each
round scores every adjacent pair by ``n(ab) / (n(a)·n(b))`` — pair counts and
symbol counts are two aggregations of the same dictionary, the symbol counts
(at most vocabulary-size rows) broadcast into the join — and merges the best
pair (ties: higher pair count, then first occurrence).  One merge per round:
a score is not monotone under other merges, so the batching argument of BPE
does not carry over.

Encoding is greedy longest-match-first per word: every (start, length)
substring of the distinct words that is a vocabulary piece becomes an edge
(equi-join with the bounded vocabulary), and a walk over each word's edges
takes the longest edge at the current position; a word with no complete walk
is ``[UNK]``.
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark import StorageLevel
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from toksmith.functions.symbols import adjacent_pairs, chars, cp_to_id, sym, syms
from toksmith.model import MAX_MODEL_ROWS
from toksmith.session import cut_lineage
from toksmith.sources.corpus import widen

WORD_PATTERN = r"\p{L}+"
UNK = "[UNK]"


@dataclass
class WordPieceModel:
    alphabet: str
    pieces: list[str] = field(default_factory=list)  # merged pieces in rank order (## for continuation)
    merges: list[tuple[int, int, int, int]] = field(default_factory=list)  # (left, right, new, freq)

    def vocab(self) -> dict[str, int]:
        """piece → id: [UNK]=0, initial chars 1..A, ##chars A+1..2A, then merges."""
        a = len(self.alphabet)
        v = {UNK: 0}
        for i, c in enumerate(self.alphabet):
            v.setdefault(c, 1 + i)
        for i, c in enumerate(self.alphabet):
            v.setdefault("##" + c, 1 + a + i)
        for k, p in enumerate(self.pieces):
            v.setdefault(p, 1 + 2 * a + k)
        return v

    def vocab_df(self, spark) -> DataFrame:
        rows = sorted(((i, p) for p, i in self.vocab().items()))
        return spark.createDataFrame(rows, "id INT, piece STRING")


def words(df: DataFrame, text_col: str = "text", id_col: str = "doc_id") -> DataFrame:
    """``(doc_id, pos, word)`` letter-run words."""
    return df.select(F.col(id_col).alias("doc_id"),
                     F.posexplode(F.regexp_extract_all(F.col(text_col), F.lit(WORD_PATTERN), 0)).alias("pos", "word"))


def word_dictionary(df: DataFrame, text_col: str = "text", id_col: str = "doc_id") -> DataFrame:
    w = words(df, text_col, id_col)
    return w.groupBy("word").agg(F.count(F.lit(1)).alias("n"),
                                 F.min(F.struct(F.col("doc_id"), F.col("pos").alias("chunk_pos"))).alias("first"))


def train(df: DataFrame, n_merges: int, text_col: str = "text", id_col: str = "doc_id",
          checkpoint_every: int = 8) -> WordPieceModel:
    if n_merges > MAX_MODEL_ROWS:
        raise ValueError("too many merges")
    d0 = widen(word_dictionary(df, text_col, id_col), "word").persist(StorageLevel.MEMORY_AND_DISK)
    alphabet = "".join(sorted(r["c"] for r in d0.select(F.explode(chars(F.col("word"))).alias("c")).distinct().collect()))
    a = len(alphabet)
    init, cont = syms(range(1, 1 + a)), syms(range(1 + a, 1 + 2 * a))
    s = F.concat(F.translate(F.substring("word", 1, 1), alphabet, init),
                 F.translate(F.expr("substring(word, 2)"), alphabet, cont))
    d = d0.select(s.alias("sym"), "n", "first").persist(StorageLevel.MEMORY_AND_DISK)
    d0.unpersist()
    text = {1 + i: c for i, c in enumerate(alphabet)}
    text.update({1 + a + i: "##" + c for i, c in enumerate(alphabet)})
    model = WordPieceModel(alphabet)
    for r in range(n_merges):
        units = d.select("n", F.explode(chars(F.col("sym"))).alias("u")).groupBy("u").agg(F.sum("n").alias("nu"))
        pairs = d.select(F.col("n").alias("w"), F.col("first").alias("f"),
                         F.posexplode(adjacent_pairs(F.col("sym"))).alias("offset", "pair"))
        pairs = pairs.groupBy("pair").agg(F.sum("w").alias("k"), F.min(F.struct(
            F.col("f.doc_id"), F.col("f.chunk_pos"), F.col("offset"))).alias("pos"))
        ua = F.broadcast(units.select(F.col("u").alias("ua"), F.col("nu").alias("na")))
        ub = F.broadcast(units.select(F.col("u").alias("ub"), F.col("nu").alias("nb")))
        x = pairs.join(ua, F.substring("pair", 1, 1) == F.col("ua")).join(ub, F.substring("pair", 2, 1) == F.col("ub"))
        x = x.withColumn("score", F.col("k") / (F.col("na").cast("double") * F.col("nb")))
        top = x.orderBy(F.col("score").desc(), F.col("k").desc(), F.col("pos")).limit(1).collect()
        if not top:
            break
        p = top[0]["pair"]
        left, right = cp_to_id(ord(p[0])), cp_to_id(ord(p[1]))
        new = 1 + 2 * a + r
        piece = text[left] + (text[right][2:] if text[right].startswith("##") else text[right])
        text[new] = piece
        model.pieces.append(piece)
        model.merges.append((left, right, new, top[0]["k"]))
        prev = d
        # single-symbol words stay: they count in the symbol marginals of the score
        d = d.select(F.replace(F.col("sym"), F.lit(p), F.lit(sym(new))).alias("sym"), "n", "first") \
            .persist(StorageLevel.MEMORY_AND_DISK)
        if (r + 1) % checkpoint_every == 0:
            ck = cut_lineage(d)
            d.unpersist()
            d = ck.persist(StorageLevel.MEMORY_AND_DISK)
        prev.unpersist()
    d.unpersist()
    return model


def encode_words(word_df: DataFrame, model: WordPieceModel, word_col: str = "word") -> DataFrame:
    """Greedy longest-match-first: ``(word, ids)``; a word without a full match is ``[0]``."""
    spark = word_df.sparkSession
    vocab = model.vocab()
    longest = max((len(p[2:]) if p.startswith("##") else len(p)) for p in vocab if p != UNK)
    v = F.broadcast(model.vocab_df(spark).where(F.col("id") > 0))  # bounded by the vocabulary size
    w = word_df.select(F.col(word_col).alias("word")).distinct()
    starts = F.sequence(F.lit(0), F.length("word") - 1)
    cand = w.select("word", F.explode(starts).alias("start")).select(
        "word", "start", F.explode(F.sequence(F.lit(1), F.least(F.lit(longest), F.length("word") - F.col("start")))).alias("len"))
    cand = cand.withColumn("piece", F.concat(F.when(F.col("start") > 0, F.lit("##")).otherwise(F.lit("")),
                                             F.expr("substring(word, start + 1, len)")))
    edges = cand.join(v, "piece").groupBy("word", "start").agg(F.max(F.struct("len", "id")).alias("e"))
    per_word = edges.groupBy("word").agg(F.map_from_entries(F.collect_list(F.struct("start", "e"))).alias("m"))
    walk = F.aggregate(
        F.sequence(F.lit(1), F.length("word")),
        F.struct(F.lit(0).alias("pos"), F.array().cast("array<int>").alias("ids"), F.lit(False).alias("fail")),
        lambda acc, _: F.when(acc["fail"] | (acc["pos"] >= F.length("word")), acc).otherwise(
            F.when(F.element_at("m", acc["pos"]).isNull(),
                   F.struct(acc["pos"].alias("pos"), acc["ids"].alias("ids"), F.lit(True).alias("fail"))).otherwise(
                F.struct((acc["pos"] + F.element_at("m", acc["pos"])["len"]).alias("pos"),
                         F.concat(acc["ids"], F.array(F.element_at("m", acc["pos"])["id"])).alias("ids"),
                         F.lit(False).alias("fail")))))
    res = w.join(per_word, "word", "left").select("word", walk.alias("r"))
    ok = (~F.col("r.fail")) & (F.col("r.pos") == F.length("word"))
    return res.select("word", F.when(ok, F.col("r.ids")).otherwise(F.array(F.lit(0))).alias("ids"))
