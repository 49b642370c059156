"""Unigram language-model tokenization.

Segmentation (X6) runs on *distinct* chunks: every substring up to the
longest piece is a candidate edge, an equi-join with the broadcast vocabulary
(bounded by its size) keeps the pieces, and a dynamic programme over each
chunk's edges (``aggregate``) finds the best-scoring path; ties go to the
larger start.  Characters outside the vocabulary become single-character
edges with a penalty score.

Training (X5) is hard EM on the chunk dictionary: seed pieces are every single
character and the most frequent longer substrings up to ``max_len`` characters, ``seed_factor`` times
as many as the vocabulary asked for (a distributed rank cut), E-step = best segmentation of each distinct
chunk weighted by its count, M-step = log relative frequencies, and pruning
drops the pieces whose removal costs least:
``loss = uses · (logp(piece) − score of its best split without it)``.
Single characters are never pruned, so training ends at the latest when no
longer piece is left.

Sampling (X7) draws a segmentation from the forward scores with a
deterministic hash of (key, position, seed) per step.
"""

from __future__ import annotations

from pyspark import StorageLevel
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from toksmith.operators import pretokenize as PT
from toksmith.session import cut_lineage, write_once

UNK_PENALTY = 10.0


def _candidates(words: DataFrame, max_len: int, col: str = "chunk", keep: tuple = ()) -> DataFrame:
    n = F.length(col)
    c = words.select(col, *keep, F.explode(F.sequence(F.lit(0), F.greatest(n - 1, F.lit(0)))).alias("start")).where(n > 0)
    c = c.select(col, *keep, "start", F.explode(F.sequence(F.lit(1), F.least(F.lit(max_len), F.length(col) - F.col("start")))).alias("len"))
    return c.withColumn("piece", F.expr(f"substring({col}, start + 1, len)"))


def _edges(words: DataFrame, vocab: DataFrame, max_len: int, exclude_whole: bool, col: str = "chunk") -> DataFrame:
    """(chunk, start, end, logp) lattice edges; unknown single characters get a penalty."""
    floor = vocab.agg(F.min("logp")).first()[0]
    unk = (floor if floor is not None else 0.0) - UNK_PENALTY
    cand = _candidates(words, max_len, col)
    e = cand.join(F.broadcast(vocab), "piece", "left")
    e = e.where(F.col("logp").isNotNull() | (F.col("len") == 1)).withColumn("logp", F.coalesce("logp", F.lit(unk)))
    if exclude_whole:
        e = e.where(~((F.col("start") == 0) & (F.col("len") == F.length(col))))
    return e.select(col, "start", (F.col("start") + F.col("len")).alias("end"), "logp")


def _by_end(e: DataFrame, col: str) -> DataFrame:
    """Edges grouped by end position: ``B[j]`` (1-based) holds the edges into position j.
    Every position has at least its single-character edge, so B has length(chunk) entries."""
    # edges into a position sorted by start once, so every later use sees one fixed order
    g1 = e.groupBy(col, "end").agg(F.array_sort(F.collect_list(F.struct("start", "logp"))).alias("ins"))
    g = g1.groupBy(col).agg(F.array_sort(F.collect_list(F.struct("end", "ins"))).alias("B"))
    return g.select(col, F.transform("B", lambda b: b["ins"]).alias("B"))


def _into(by_end: Column, j: Column) -> Column:
    return F.element_at(by_end, j)


def _forward_best(n: Column, by_end: Column) -> Column:
    """best[j] = max over edges (start → j) of (best[start].score + logp, start); ties → larger start."""
    init = F.array(F.struct(F.lit(0.0).alias("score"), F.lit(-1).alias("start")))
    return F.aggregate(
        F.sequence(F.lit(1), n), init,
        lambda acc, j: F.concat(acc, F.array(F.array_max(F.transform(
            _into(by_end, j),
            lambda e: F.struct((F.element_at(acc, e["start"] + 1)["score"] + e["logp"]).alias("score"),
                               e["start"].alias("start")))))))


def _backtrack(n: Column, best: Column) -> Column:
    """(start, end) pieces of the best path, read back from ``best`` (a materialized column)."""
    back = F.aggregate(
        F.sequence(F.lit(1), n),
        F.struct(n.alias("j"), F.array().cast("array<struct<s:int,e:int>>").alias("path")),
        lambda acc, _: F.when(acc["j"] <= 0, acc).otherwise(F.struct(
            F.element_at(best, acc["j"] + 1)["start"].alias("j"),
            F.concat(F.array(F.struct(F.element_at(best, acc["j"] + 1)["start"].alias("s"), acc["j"].alias("e"))),
                     acc["path"]).alias("path"))))
    return back["path"]


def segment(words: DataFrame, vocab: DataFrame, max_len: int, col: str = "chunk", exclude_whole: bool = False) -> DataFrame:
    """(chunk, score, pieces ARRAY<STRING>) for distinct ``words[col]``."""
    e = _edges(words, vocab, max_len, exclude_whole, col)
    g = _by_end(e, col)
    if exclude_whole:  # a one-character piece has no split without itself
        g = g.where(F.size("B") == F.length(col))
    # the forward table is its own column: a lambda that read it as an expression would
    # re-run the whole forward pass at every backward step
    f = g.select(col, _forward_best(F.length(col), F.col("B")).alias("best"))
    r = f.select(col, F.element_at("best", F.length(col) + 1)["score"].alias("score"),
                 _backtrack(F.length(col), F.col("best")).alias("path"))
    pieces = F.transform("path", lambda p: F.substring(F.col(col), p["s"] + 1, p["e"] - p["s"]))
    return r.select(col, "score", pieces.alias("pieces"))


def seeds(d: DataFrame, k: int, max_len: int) -> DataFrame:
    """``(piece, f)``: every character of the dictionary ``d(chunk, n)``, and its longer substrings from the most frequent
    down to the count of the ``k``-th (all that tie with it).

    The rank cut is distributed: substrings are counted by count, and the running number of substrings over those
    (few) counts gives the least count kept; no list of substrings is ranked in one place."""
    from pyspark.sql import Window

    cand = _candidates(d, max_len, keep=("n",)).groupBy("piece", "len").agg(F.sum("n").alias("f")).persist(StorageLevel.MEMORY_AND_DISK)
    by_count = cand.where(F.col("len") > 1).groupBy("f").agg(F.count(F.lit(1)).alias("m"))
    down = by_count.select("f", (F.sum("m").over(Window.orderBy(F.col("f").desc())) - F.col("m")).alias("above"))
    least = down.where(F.col("above") < k).agg(F.min("f")).first()[0]
    kept = write_once(cand.where((F.col("len") == 1) | (F.col("f") >= F.lit(least if least is not None else 0))).select("piece", "f"))
    cand.unpersist()
    return kept


def log_shares(v: DataFrame) -> DataFrame:
    """``(piece, f)`` -> ``(piece, logp)``."""
    total = float(v.agg(F.sum("f")).first()[0] or 1)
    return v.select("piece", F.log(F.col("f") / F.lit(total)).alias("logp"))


def train(docs: DataFrame, vocab_size: int, max_len: int = 8, seed_factor: int = 4, em_iters: int = 2,
          shrink: float = 0.8, pattern: str | None = "gpt4", text_col: str = "text", id_col: str = "doc_id") -> DataFrame:
    """Unigram vocabulary ``(piece, logp)`` of ``vocab_size`` pieces, or of all characters where those are more.
    Training starts from ``seed_factor * vocab_size`` longer substrings, and raises where the corpus has fewer pieces than asked for."""
    d = PT.chunk_dictionary(PT.split_chunks(docs, pattern, text_col, id_col)).select("chunk", "n") \
        .persist(StorageLevel.MEMORY_AND_DISK)
    first = seeds(d, seed_factor * vocab_size, max_len)
    found = first.count()
    if found < vocab_size:
        d.unpersist()
        raise ValueError(f"the corpus has {found} substrings of up to {max_len} characters, fewer than the {vocab_size} pieces asked for")
    v = _normalise(first)
    while True:
        for _ in range(em_iters):
            v = _em_step(d, v, max_len)
        size, single = v.agg(F.count(F.lit(1)), F.count(F.when(F.length("piece") == 1, 1))).first()
        if size <= vocab_size or size == single:
            break
        v = _prune(v, d, max_len, max(vocab_size, int(size * shrink)))
    d.unpersist()
    return v


def _normalise(v: DataFrame) -> DataFrame:
    """Log relative frequencies ``(piece, logp)``; written once, so that a round does not rerun the last."""
    v = v.persist(StorageLevel.MEMORY_AND_DISK)
    total = float(v.agg(F.sum("f")).first()[0] or 1)
    out = cut_lineage(v.select("piece", F.log(F.col("f") / F.lit(total)).alias("logp")))
    v.unpersist()
    return out


def _usage(d: DataFrame, v: DataFrame, max_len: int) -> DataFrame:
    seg = segment(d.select("chunk"), v, max_len).join(d, "chunk")
    return seg.select("n", F.explode("pieces").alias("piece")).groupBy("piece").agg(F.sum("n").alias("f"))


def _em_step(d: DataFrame, v: DataFrame, max_len: int) -> DataFrame:
    u = _usage(d, v, max_len)
    # unused pieces keep a small share: only pruning takes pieces away, so the size asked for is met
    return _normalise(v.join(u, "piece", "left").select("piece", F.greatest(F.coalesce("f", F.lit(0)).cast("double"), F.lit(0.5)).alias("f")))


def _prune(v: DataFrame, d: DataFrame, max_len: int, target: int) -> DataFrame:
    u = _usage(d, v, max_len)
    multi = v.where(F.length("piece") > 1)
    alt = segment(multi.select(F.col("piece").alias("chunk")), v, max_len, exclude_whole=True) \
        .select(F.col("chunk").alias("piece"), F.col("score").alias("alt"))
    loss = multi.join(u, "piece", "left").join(alt, "piece", "left").select(
        "piece", (F.coalesce("f", F.lit(0)) * (F.col("logp") - F.coalesce("alt", F.lit(-1e9)))).alias("loss"))
    n_single = v.where(F.length("piece") == 1).count()
    keep_multi = loss.orderBy(F.col("loss").desc(), "piece").limit(max(0, target - n_single)).select("piece")
    kept = v.join(keep_multi, "piece", "left_semi").unionByName(v.where(F.length("piece") == 1))
    return kept.persist(StorageLevel.MEMORY_AND_DISK)


def _logaddexp(a: Column, b: Column) -> Column:
    """log(exp a + exp b); ``a`` may be NULL (empty sum)."""
    return F.when(a.isNull(), b).otherwise(F.greatest(a, b) + F.log1p(F.exp(-F.abs(a - b))))


def forward(words: DataFrame, vocab: DataFrame, max_len: int, col: str = "chunk") -> DataFrame:
    """``(chunk, B, alpha)`` of distinct chunks: the edges into each position, and the log sum of the scores of all paths to it."""
    g = _by_end(_edges(words, vocab, max_len, False, col), col)
    alpha = F.aggregate(
        F.sequence(F.lit(1), F.length(col)), F.array(F.lit(0.0)),
        lambda acc, j: F.concat(acc, F.array(F.aggregate(
            _into(F.col("B"), j), F.lit(None).cast("double"),
            lambda s, x: _logaddexp(s, F.element_at(acc, x["start"] + 1) + x["logp"])))))
    return g.select(col, "B", alpha.alias("alpha"))  # materialized once per chunk


def _drawn(n: Column, uniform) -> Column:
    """Backward draw over the columns ``B`` and ``alpha``: ``(s, e)`` of the pieces; ``uniform(j)`` is the draw at end ``j``."""
    by_end, alpha = F.col("B"), F.col("alpha")

    def step(acc, _):
        j = acc["j"]
        into = _into(by_end, j)
        probs = F.transform(into, lambda x: F.exp(F.element_at(alpha, x["start"] + 1) + x["logp"] - F.element_at(alpha, j + 1)))
        u = uniform(j)
        cum = F.aggregate(probs, F.struct(F.lit(0.0).alias("c"), F.lit(-1).alias("k"), F.lit(0).alias("i")),
                          lambda a, p: F.struct((a["c"] + p).alias("c"),
                                                F.when((a["k"] < 0) & (a["c"] + p > u), a["i"]).otherwise(a["k"]).alias("k"),
                                                (a["i"] + 1).alias("i")))
        pick = F.element_at(into, F.when(cum["k"] < 0, F.size(into) - 1).otherwise(cum["k"]) + 1)
        return F.when(j <= 0, acc).otherwise(F.struct(
            pick["start"].alias("j"),
            F.concat(F.array(F.struct(pick["start"].alias("s"), j.alias("e"))), acc["path"]).alias("path")))
    return F.aggregate(F.sequence(F.lit(1), n), F.struct(n.alias("j"), F.array().cast("array<struct<s:int,e:int>>").alias("path")), step)["path"]


def sample(words: DataFrame, vocab: DataFrame, max_len: int, key: Column, seed: int = 0, col: str = "chunk") -> DataFrame:
    """One segmentation of each distinct word, drawn from the lattice with probability ∝ exp(path score):
    forward sums α, then backward steps choosing the edge into j with
    probability ∝ exp(α[start] + logp − α[j]), the uniform draw being
    ``xxhash64(key, j, seed)`` scaled to [0, 1)."""
    path = _drawn(F.length(col), lambda j: F.pmod(F.xxhash64(key, j, F.lit(seed)), F.lit(1 << 30)) / F.lit(float(1 << 30)))
    return forward(words, vocab, max_len, col).select(
        col, F.transform(path, lambda p: F.substring(F.col(col), p["s"] + 1, p["e"] - p["s"])).alias("pieces"))


# Fixed values of the draw of one occurrence: a small prime field, so that SQL can recompute it.
DRAW_MOD, DRAW_ID, DRAW_POS, DRAW_STEP, DRAW_MIX = 1000003, 7919, 40503, 9973, 48271


def draw_sql(row: str, pos: str, step: str, seed: int) -> str:
    """SQL of the uniform draw in [0, 1) keyed by (row, position, step, seed)."""
    x = f"(({row} % {DRAW_MOD} * {DRAW_ID} + {pos} % {DRAW_MOD} * {DRAW_POS} + {step} * {DRAW_STEP} + {seed}) % {DRAW_MOD})"
    return f"(({x} * {x} % {DRAW_MOD} * {DRAW_MIX} + {x}) % {DRAW_MOD} / CAST({DRAW_MOD} AS DOUBLE))"


def sample_occurrences(chunks: DataFrame, vocab: DataFrame, max_len: int, seed: int = 0) -> DataFrame:
    """``chunks(doc_id, chunk_pos, chunk)`` -> ``(doc_id, pos, chunk, ends)``, a segmentation drawn for every occurrence, so a
    frequent chunk is cut in different ways in different places.  The forward table is made once per distinct chunk and
    joined to the occurrences (frequent chunks through a bounded broadcast); draws are keyed by (doc_id, position, step, seed), so a
    rerun, or a task run again after a lost executor, gives the same rows."""
    from toksmith.operators.joins import hot_cold_join

    counts = chunks.groupBy("chunk").agg(F.count(F.lit(1)).alias("n")).persist(StorageLevel.MEMORY_AND_DISK)
    table = write_once(forward(counts.select("chunk"), vocab, max_len))
    rows = hot_cold_join(chunks.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("chunk_pos").cast("long").alias("pos"), "chunk"), table, "chunk", counts=counts)

    def uniform(j: Column) -> Column:
        m = F.lit(DRAW_MOD).cast("long")
        x = (F.pmod("doc_id", m) * DRAW_ID + F.pmod("pos", m) * DRAW_POS + j * DRAW_STEP + seed) % m
        return (x * x % m * DRAW_MIX + x) % m / F.lit(float(DRAW_MOD))

    return rows.select("doc_id", "pos", "chunk", F.transform(_drawn(F.length("chunk"), uniform), lambda p: p["e"]).alias("ends"))
