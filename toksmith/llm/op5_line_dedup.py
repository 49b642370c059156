"""Line dedup by winnowing over line hashes.

Lines are what ``split`` at line feeds gives.  Of every window of ``MIN_LINES``
consecutive lines the smallest line hash is a fingerprint, so any repeated run of
that many lines shares one; a single line of ``LONG_WORDS`` words or more (by default
any line with a word) is a window of its own, so blank lines go only with a repeated run.  Fingerprint positions that share a value with another
position are extended both ways to the windows around them, equal windows are
traced to their first occurrence in order of (id, line), and every line that a
later occurrence covers is deleted: the union of equal windows is the maximal
repeated run.  Runs are judged on the input, not on what is left of it.

Defined cases: a null text stays null and has no line; an empty text is one empty
line; null ids sort first; rows equal in id and text are one document and get the
same result; an empty table gives an empty result; other columns pass through,
``n_lines`` and ``n_removed`` of the input are replaced.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from toksmith.llm.blocks import row_key
from toksmith.operators.joins import hot_cold_join
from toksmith.session import write_once

MIN_LINES = 2
LONG_WORDS = 1


def _windows(docs: DataFrame, min_lines: int, long_words: int) -> DataFrame:
    """``(rid, doc_id, s, n, p, fp, win)``: a window of ``n`` lines from line ``s`` on, with its
    fingerprint ``fp`` at line ``p`` and a digest of its text."""
    lines = docs.select("rid", "doc_id", F.split("text", "\n", -1).alias("ls")).withColumn("hs", F.transform("ls", lambda x: F.xxhash64(x)))

    def run(i: Column) -> Column:
        low = F.array_min(F.slice("hs", i + 1, min_lines))
        return F.struct(i.alias("s"), F.lit(min_lines).alias("n"), (i + F.array_position(F.slice("hs", i + 1, min_lines), low).cast("int") - 1).alias("p"),
                        low.alias("fp"), F.unhex(F.md5(F.concat(F.lit("run\n"), F.array_join(F.slice("ls", i + 1, min_lines), "\n")))).alias("win"))

    def alone(x: Column, i: Column) -> Column:
        return F.when(F.regexp_count(x, F.lit(r"[^\x20\x09-\x0D]+")) >= long_words, F.struct(
            i.alias("s"), F.lit(1).alias("n"), i.alias("p"), F.xxhash64(x).alias("fp"), F.unhex(F.md5(F.concat(F.lit("one\n"), x))).alias("win")))

    last = F.size("ls") - min_lines
    found = F.concat(F.when(last >= 0, F.transform(F.sequence(F.lit(0), last), run)).otherwise(F.array()),
                     F.filter(F.transform("ls", alone), lambda x: x.isNotNull()))
    return lines.select("rid", "doc_id", F.explode(found).alias("w")).select("rid", "doc_id", "w.*")


def removed_lines(docs: DataFrame, min_lines: int = MIN_LINES, long_words: int = LONG_WORDS) -> DataFrame:
    """``(rid, gone)``: line numbers to delete, for the documents that have any.  ``docs`` has
    ``rid``, ``doc_id`` and ``text``."""
    windows = write_once(_windows(docs, min_lines, long_words))
    prints = windows.select("rid", "p", "fp").distinct()
    shared = prints.groupBy("fp").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") > 1)
    near = hot_cold_join(windows, shared.select("fp"), "fp", counts=shared)
    firsts = near.groupBy("win").agg(F.count(F.lit(1)).alias("n"), F.min(F.struct("doc_id", "rid", "s")).alias("first")).where(F.col("n") > 1)
    firsts = write_once(firsts)
    later = hot_cold_join(near, firsts.select("win", "first"), "win", counts=firsts.select("win", "n")).where(F.struct("doc_id", "rid", "s") != F.col("first"))
    return later.groupBy("rid").agg(F.array_sort(F.array_distinct(F.flatten(F.collect_set(F.sequence("s", F.col("s") + F.col("n") - 1))))).alias("gone"))


def dedup_lines(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", min_lines: int = MIN_LINES, long_words: int = LONG_WORDS) -> DataFrame:
    """``docs`` with the later repeated runs of lines deleted from ``text``, with ``n_lines`` and ``n_removed``."""
    kept = [c for c in docs.columns if c not in ("n_lines", "n_removed")]
    rows = docs.select(F.struct(*(F.col(f"`{c}`") for c in kept)).alias("row"), row_key(doc_id, text).alias("rid"), F.col(doc_id).alias("doc_id"), F.col(text).alias("text"))
    gone = removed_lines(rows.select("rid", "doc_id", "text"), min_lines, long_words)
    out = rows.select("row", "rid").join(gone, "rid", "left").withColumn("lines", F.split(F.col("row").getField(text), "\n", -1))
    left = F.when(F.col("gone").isNull(), F.col("row").getField(text)).otherwise(
        F.array_join(F.filter("lines", lambda x, i: ~F.array_contains("gone", i)), "\n"))
    return out.select(*((left if c == text else F.col("row").getField(c)).alias(c) for c in kept),
                      F.coalesce(F.size("lines"), F.lit(0)).cast("long").alias("n_lines"), F.coalesce(F.size("gone"), F.lit(0)).cast("long").alias("n_removed"))


def op5_line_dedup(spark, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    return dedup_lines(docs).select("doc_id", "n_lines", "n_removed", F.md5(F.col("text").cast("binary")).alias("kept_md5"))


ORACLE = rf"""
WITH l AS (
  SELECT doc_id, text, string_split(text, chr(10)) AS ls FROM documents),
w AS (
  SELECT doc_id, s, {MIN_LINES} AS n, array_to_string(ls[s + 1 : s + {MIN_LINES}], chr(10)) AS win
  FROM (SELECT doc_id, ls, unnest(range(0, len(ls) - {MIN_LINES} + 1)) AS s FROM l)
  UNION ALL
  SELECT doc_id, s, 1, ls[s + 1] || chr(10)
  FROM (SELECT doc_id, ls, unnest(range(0, len(ls))) AS s FROM l)
  WHERE len(regexp_extract_all(ls[s + 1], '[^\x20\x09-\x0D]+')) >= {LONG_WORDS}),
f AS (SELECT n, win, min((doc_id, s)) AS first FROM w GROUP BY n, win HAVING count(*) > 1),
g AS (
  SELECT DISTINCT doc_id, unnest(range(s, s + w.n)) AS i
  FROM w JOIN f USING (win) WHERE w.n = f.n AND (doc_id, s) <> first),
k AS (
  SELECT doc_id, len(ls) AS n_lines, unnest(ls) AS line, unnest(range(0, len(ls))) AS i FROM l)
SELECT k.doc_id, any_value(k.n_lines)::BIGINT AS n_lines, count(g.i)::BIGINT AS n_removed,
  md5(coalesce(string_agg(k.line, chr(10) ORDER BY k.i) FILTER (WHERE g.i IS NULL), '')) AS kept_md5
FROM k LEFT JOIN g ON k.doc_id = g.doc_id AND k.i = g.i GROUP BY k.doc_id
UNION ALL
SELECT doc_id, 0, 0, NULL FROM documents WHERE text IS NULL
"""
