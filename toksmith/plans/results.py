"""Queries that return whole rows (IDs, texts, pieces) of corpus jobs; registered with those of the catalog."""

from __future__ import annotations

from pyspark.sql import functions as F

from toksmith.operators import decode as DE
from toksmith.operators import encode as EN
from toksmith.operators import metrics as MX
from toksmith.operators import pretokenize as PT
from toksmith.operators import train as TR
from toksmith.operators import unigram as UG
from toksmith.operators import vocabulary as VO
from toksmith.operators import windows as WN
from toksmith.plans import catalog as C
from toksmith.plans import oracle as O
from toksmith.sources import corpus

CONTEXT, EOT = 2048, 400


@C.query("token_chunk_rows", "WITH RECURSIVE " + C._ENC + """,
 w AS (SELECT doc_id, S, unnest(generate_series(0, length(S) - 1, 224)) AS start FROM enc WHERE length(S) > 0),
 wk AS (SELECT doc_id * 1000000 + start // 224 AS key, doc_id, start, substr(S, start + 1, 256) AS S FROM w),
 """ + O.expand_cte("wx", "(SELECT key, S AS s FROM wk)", "merges", C.K_REGEX) + f""",
 wb AS (SELECT wk.*, {O.sym_hex('wx.s')} AS hx, list_transform(string_split(wx.s, ''), lambda x: unicode(x) - 256) AS bytes FROM wk JOIN wx USING (key)),
 wl AS (SELECT *, list_position(list_transform(list_reverse(bytes), lambda b: b < 128 OR b >= 192), true) AS back,
               coalesce(list_position(list_transform(bytes, lambda b: b < 128 OR b >= 192), true), len(bytes) + 1) - 1 AS lead FROM wb),
 wf AS (SELECT *, coalesce(back < CASE WHEN bytes[len(bytes) - back + 1] >= 240 THEN 4 WHEN bytes[len(bytes) - back + 1] >= 224 THEN 3
                                       WHEN bytes[len(bytes) - back + 1] >= 192 THEN 2 ELSE 1 END, false) AS open FROM wl)
 SELECT doc_id, (start // 224)::BIGINT AS window, start::BIGINT AS start, {O.ids_of('S')} AS ids,
        repeat(chr(65533), lead) || decode(unhex(substr(hx, 2 * lead + 1, length(hx) - 2 * lead - CASE WHEN open THEN 2 * back ELSE 0 END))) || CASE WHEN open THEN chr(65533) ELSE '' END AS text,
        lead > 0 AS starts_inside, open AS ends_inside FROM wf""")
def token_chunk_rows(spark, sf):
    """256-token retrieval chunks with 32 tokens of overlap: IDs, decoded text, and whether a border cuts a character."""
    w = WN.chunk_rows(C._enc_docs(spark, sf, ()), C.regex_model(spark, sf), 256, 32)
    return w.select("doc_id", F.col("window").cast("bigint"), F.col("start").cast("bigint"), C._ids_str().alias("ids"), "text", "starts_inside", "ends_inside")


@C.query("pack_context_rows", "WITH RECURSIVE " + C._ENC + f""",
 whole AS (SELECT string_agg(S || chr(256 + {EOT}), '' ORDER BY doc_id) AS s FROM enc WHERE text IS NOT NULL),
 parts AS (SELECT i AS context_id, substr(s, (i * {CONTEXT} + 1)::BIGINT, {CONTEXT}) AS S FROM whole, LATERAL (SELECT unnest(range(0, (length(s) + {CONTEXT - 1}) // {CONTEXT})) AS i) q)
 SELECT context_id::BIGINT AS context_id, length(S)::BIGINT AS n_tokens, {O.ids_of('S')} AS ids FROM parts""")
def pack_context_rows(spark, sf):
    """The packed 2,048-token contexts, each document followed by the end-of-text ID."""
    r = WN.context_rows(C._enc_docs(spark, sf, ()), CONTEXT, EOT)
    return r.select("context_id", F.size("ids").cast("bigint").alias("n_tokens"), C._ids_str().alias("ids"))


_PROMPTS = "(SELECT item_id AS doc_id, substr(text, 1, length(text) - 2) AS text FROM benchmark)"


@C.query("healing_list", "WITH RECURSIVE " + C._VOCAB_SQL + ",\n" + O.fold_docs_ctes("th", _PROMPTS, "merges") + """,
 last AS (SELECT doc_id, unicode(substr(S, length(S), 1)) - 256 AS last_id FROM th WHERE length(S) > 0)
 SELECT l.doc_id AS item_id, l.last_id::BIGINT AS last_id, w.id AS extension_id, w.piece_hex AS extension_hex
 FROM last l JOIN vocab v ON v.id = l.last_id JOIN vocab w ON starts_with(w.piece_hex, v.piece_hex) AND length(w.piece_hex) > length(v.piece_hex)""")
def healing_list(spark, sf):
    """For every prompt (benchmark texts that stop two characters early) the vocabulary pieces that extend its last token, one row each."""
    m = C.regex_model(spark, sf)
    prompts = corpus.table(spark, sf, "benchmark", "item_id", "text").select("item_id", F.expr("substring(text, 1, length(text) - 2)").alias("text"))
    enc = EN.encode(prompts, m, id_col="item_id")
    return VO.healing(enc.withColumnRenamed("doc_id", "item_id"), m, "item_id").select(
        "item_id", F.col("last_id").cast("bigint"), F.col("extension_id").cast("bigint"), "extension_hex")


@C.query("piece_lookup", "WITH RECURSIVE " + C._VOCAB_SQL + """,
 dc AS (SELECT chunk, count(*) AS n FROM chunks GROUP BY chunk),
 best AS (SELECT piece_hex, max(id) AS id FROM vocab GROUP BY piece_hex)
 SELECT chunk, n::BIGINT AS n, best.id, best.piece_hex FROM dc JOIN best ON best.piece_hex = hex(encode(chunk))""")
def piece_lookup(spark, sf):
    """The document chunks that are pieces of the vocabulary, with their ID, and the ID's piece looked up again."""
    m = C.regex_model(spark, sf)
    d = PT.chunk_dictionary(PT.split_chunks(C._docs(spark, sf))).select("chunk", "n")
    found = VO.token_to_id(d, m, "chunk").where(F.col("id").isNotNull())
    return VO.id_to_token(found, m).select("chunk", "n", F.col("id").cast("bigint"), F.hex("piece").alias("piece_hex"))


GRAMS = 20
_EXPAND = C._ENC + ",\n" + C._VOCAB_SQL.replace(C._REGEX + ",\n", "") + f""",
 gr AS (SELECT substr(S, i, k) AS gram FROM enc, LATERAL (SELECT unnest(range(1, length(S))) AS i) p, LATERAL (SELECT unnest([2, 3, 4]) AS k) q WHERE i + k - 1 <= length(S)),
 gc AS (SELECT gram, count(*) AS n FROM gr GROUP BY gram),
 gh AS (SELECT gram, n, a.piece_hex || b.piece_hex || coalesce(c.piece_hex, '') || coalesce(d.piece_hex, '') AS hx FROM gc
        JOIN vocab a ON a.id = unicode(substr(gram, 1, 1)) - 256 JOIN vocab b ON b.id = unicode(substr(gram, 2, 1)) - 256
        LEFT JOIN vocab c ON length(gram) > 2 AND c.id = unicode(substr(gram, 3, 1)) - 256 LEFT JOIN vocab d ON length(gram) > 3 AND d.id = unicode(substr(gram, 4, 1)) - 256),
 nw AS (SELECT gram, n, n * (length(gram) - 1) AS saving, row_number() OVER (ORDER BY n * (length(gram) - 1) DESC, gram) - 1 AS rank
        FROM gh WHERE hx NOT IN (SELECT piece_hex FROM vocab) ORDER BY saving DESC, gram LIMIT {GRAMS})"""


def _new_grams(spark, sf):
    m = C.regex_model(spark, sf)
    rows = VO.frequent_ngrams(C._sym_docs(spark, sf), m, GRAMS).collect()  # GRAMS rows: the new part of the vocabulary
    return m, rows, VO.expanded([r["gram"] for r in rows], m)


@C.query("expand_ngrams", "WITH RECURSIVE " + _EXPAND + f""" SELECT rank::BIGINT AS rank, {O.ids_of('gram')} AS ids, n::BIGINT AS n, saving::BIGINT AS saving,
        ({256 + C.K_REGEX} + rank)::BIGINT AS new_id FROM nw""")
def expand_ngrams(spark, sf):
    """X11: the token n-grams (2 to 4) that would save most tokens and are no piece yet, with IDs from the model's next one on."""
    _, rows, new = _new_grams(spark, sf)
    return spark.createDataFrame([(i, " ".join(map(str, VO.gram_ids(r["gram"]))), r["n"], r["saving"], new[r["gram"]]) for i, r in enumerate(rows)],
                                 "rank BIGINT, ids STRING, n BIGINT, saving BIGINT, new_id BIGINT")


@C.query("expand_retokenize", "WITH RECURSIVE " + _EXPAND + f""",
 pat AS (SELECT string_agg(gram, '|' ORDER BY length(gram) DESC, gram) || '|.' AS p, map_from_entries(list((gram, chr((256 + {256 + C.K_REGEX} + rank)::INTEGER)))) AS m FROM nw),
 rt AS (SELECT doc_id, length(S) AS before, CASE WHEN S = '' THEN '' ELSE array_to_string(list_transform(regexp_extract_all(S, p), lambda x: CASE WHEN length(x) = 1 THEN x ELSE m[x] END), '') END AS R FROM enc, pat)
 SELECT doc_id, before::BIGINT AS n_before, length(R)::BIGINT AS n_after, {O.ids_of('R')} AS ids FROM rt""")
def expand_retokenize(spark, sf):
    """X11: every document re-tokenized with the expanded vocabulary, and the tokens that saves."""
    _, _, new = _new_grams(spark, sf)
    e = C._sym_docs(spark, sf).withColumn("new", VO.rewrite(F.col("sym"), new))
    return e.select("doc_id", F.col("n_tokens").cast("bigint").alias("n_before"), F.length("new").cast("bigint").alias("n_after"),
                    F.array_join(EN.symbols_ids(F.col("new")), " ").alias("ids"))


def _fallback_sql():
    """Documents → alphabet IDs, or the byte IDs behind the merges for other characters → merges."""
    return (C._CHAR + """,
_fb AS (SELECT (SELECT count(*) + 3 FROM alpha) + (SELECT count(*) FROM cmerges) AS f),
_fm AS (SELECT doc_id, replace(text, ' ', '▁') AS t FROM documents WHERE text IS NOT NULL),
_fch AS (SELECT doc_id, p, ch FROM _fm, LATERAL (SELECT generate_subscripts(string_split(t, ''), 1) AS p, unnest(string_split(t, '')) AS ch) u WHERE ch <> ''),
_fs AS (SELECT doc_id, string_agg(CASE WHEN a.id IS NOT NULL THEN chr((256 + a.id)::INTEGER) ELSE
           array_to_string(list_transform(""" + O.byte_list("ch") + """, lambda b: chr((256 + f + b)::INTEGER)), '') END, '' ORDER BY p) AS s
        FROM _fch JOIN _fb ON true LEFT JOIN alpha a ON a.c = _fch.ch GROUP BY doc_id),
_ff(i, doc_id, s) AS (SELECT 0, doc_id, s FROM _fs UNION ALL
  SELECT x.i + 1, x.doc_id, replace(x.s, m.pr, chr((256 + m.new_id)::INTEGER)) FROM _ff x JOIN cmerges m ON m.rank = x.i),
fenc AS (SELECT d.doc_id, d.text, coalesce(x.s, '') AS s FROM documents d LEFT JOIN (SELECT doc_id, s FROM _ff WHERE i = (SELECT count(*) FROM cmerges)) x ON d.doc_id = x.doc_id)""")


def _fallback_model(spark, sf):
    m = C.char_model(spark, sf)
    return type(m)(**{**m.__dict__, "byte_fallback": True})


@C.query("fallback_encode", "WITH RECURSIVE " + _fallback_sql() + f""" SELECT doc_id, length(s)::BIGINT AS n_tokens,
        len(list_filter(string_split(s, ''), lambda x: x <> '' AND unicode(x) - 256 >= f))::BIGINT AS n_byte_tokens, {O.ids_of('s')} AS ids FROM fenc, _fb""")
def fallback_encode(spark, sf):
    """Documents encoded with the char model and byte fallback: a character outside the alphabet becomes its bytes' pieces."""
    m = _fallback_model(spark, sf)
    e = EN.encode(C._docs(spark, sf), m)
    return e.select("doc_id", F.col("n_tokens").cast("bigint"), F.size(F.filter("ids", lambda i: i >= m.first_byte_id)).cast("bigint").alias("n_byte_tokens"), C._ids_str().alias("ids"))


@C.query("fallback_decode", """SELECT doc_id, regexp_replace(replace(text, '▁', ' '), '^[\\t\\n\\x0b\\x0c\\r\\x1c-\\x1f \\x{85}\\x{a0}]+|[\\t\\n\\x0b\\x0c\\r\\x1c-\\x1f \\x{85}\\x{a0}]+$', '', 'g') AS text FROM documents""")
def fallback_decode(spark, sf):
    """The byte-fallback encoding decoded again: every character comes back (edge white space is stripped, as the char decoder does)."""
    m = _fallback_model(spark, sf)
    return DE.decode(EN.encode(C._docs(spark, sf), m), m)


_PRUNED = C._ENC + """,
 f AS (SELECT id, count(*) AS n FROM enc_ids GROUP BY id),
 rare AS (SELECT m.new_id AS id FROM merges m LEFT JOIN f ON f.id = m.new_id WHERE coalesce(f.n, 0) < 0.01 * (SELECT sum(n) FROM f)),
 clo(id) AS (SELECT id FROM rare UNION SELECT m.new_id FROM merges m JOIN clo ON m.left_id = clo.id OR m.right_id = clo.id),
 kept AS (SELECT (row_number() OVER (ORDER BY rank) - 1) AS rank, pr, new_id FROM merges WHERE new_id NOT IN (SELECT id FROM clo)),
 """ + O.fold_docs_ctes("pe", "(SELECT doc_id, text FROM documents)", "kept")


@C.query("prune_reencode", "WITH RECURSIVE " + _PRUNED + f"""
 SELECT enc.doc_id, enc.n_tokens::BIGINT AS n_tokens, length(pe.S)::BIGINT AS n_tokens_pruned, {O.ids_of('pe.S')} AS ids FROM enc JOIN pe ON pe.doc_id = enc.doc_id""")
def prune_reencode(spark, sf):
    """Q8: documents encoded again with the model that lost its rare merges and all merges built on them."""
    m = C.regex_model(spark, sf)
    small = VO.pruned_model(m, C.prune_vocab(spark, sf))
    d = C._docs(spark, sf)
    return d.select("doc_id", F.length(EN.text_symbols(F.col("text"), m)).cast("bigint").alias("n_tokens"), EN.text_symbols(F.col("text"), small).alias("s")).select(
        "doc_id", "n_tokens", F.length("s").cast("bigint").alias("n_tokens_pruned"), F.array_join(EN.symbols_ids(F.col("s")), " ").alias("ids"))


# == log-probability tables (Q12), numbers over several chunks (Q16), balanced training (T6) ==

_LP = C._ENC + ",\n" + C._VOCAB_SQL.replace(C._REGEX + ",\n", "") + """,
 fq AS (SELECT id, count(*) AS n FROM enc_ids GROUP BY id),
 fl AS (SELECT lang, id, count(*) AS n FROM enc_ids GROUP BY lang, id),
 tl AS (SELECT lang, sum(n) AS t FROM fl GROUP BY lang),
 lp AS (SELECT 'all' AS model, x.id, v.piece_hex, ln(fq.n / (SELECT sum(n) FROM fq)) AS lp FROM enc_ids x JOIN fq ON fq.id = x.id JOIN vocab v ON v.id = x.id
        UNION ALL SELECT 'by_lang', x.id, v.piece_hex, ln(fl.n / tl.t) FROM enc_ids x JOIN fl ON fl.id = x.id AND fl.lang = x.lang JOIN tl ON tl.lang = x.lang JOIN vocab v ON v.id = x.id)"""


@C.query("logprob_table", "WITH RECURSIVE " + _LP + """
 SELECT model, count(*)::BIGINT AS n_tokens, round(exp(-avg(lp)), 6) AS perplexity,
        round(-sum(lp) / ln(2) / sum(len(list_filter(regexp_extract_all(piece_hex, '..'), lambda h: ('0x' || h)::INTEGER NOT BETWEEN 128 AND 191))), 6) AS bits_per_char,
        round(-sum(lp) / ln(2) / sum(length(piece_hex) / 2), 6) AS bits_per_byte FROM lp GROUP BY model""")
def logprob_table(spark, sf):
    """Q12: perplexity, bits per character and per byte of each model in a table ``(model, doc_id, pos, piece, logprob)``.
    The table stands in for two models' output: token shares over all documents, and over those of the document's language."""
    return MX.perplexity_by_model(_logprob_rows(spark, sf))


def _logprob_rows(spark, sf):
    m = C.regex_model(spark, sf)
    freq = MX.token_freq(C._sym_docs(spark, sf, ("lang",)), ("lang",))  # languages x vocabulary
    from pyspark.sql import Window
    over = lambda *c: F.sum("n").over(Window.partitionBy(*c))
    shares = freq.select("lang", "id", F.log(over("id") / over()).alias("all"), F.log(F.col("n") / over("lang")).alias("by_lang"))
    vocab = m.vocab_df(spark).select(F.col("id").cast("long").alias("id"), "piece")
    tokens = C._enc_docs(spark, sf, ("lang",)).select("doc_id", "lang", F.posexplode(EN.each()).alias("pos", "id")).withColumn("id", F.col("id").cast("long"))
    rows = tokens.join(F.broadcast(shares), ["lang", "id"]).join(F.broadcast(vocab), "id")
    both = F.array(*[F.struct(F.lit(n).alias("model"), F.col(n).alias("logprob")) for n in ("all", "by_lang")])
    return rows.select("doc_id", "pos", "piece", F.explode(both).alias("m")).select("m.model", "doc_id", "pos", "piece", "m.logprob")


@C.query("number_spans", C._CS + f""",
 dg AS (SELECT x.doc_id, x.chunk_pos, x.chunk, cs.sym, x.chunk_pos - row_number() OVER (PARTITION BY x.doc_id ORDER BY x.chunk_pos) AS island
        FROM chunks x JOIN cs ON cs.chunk = x.chunk WHERE regexp_matches(x.chunk, '^\\p{{N}}+$')),
 nr AS (SELECT string_agg(chunk, '' ORDER BY chunk_pos) AS number, count(*) AS k, sum(length(sym)) AS t, string_agg({O.ids_of('sym')}, '|' ORDER BY chunk_pos) AS pieces FROM dg GROUP BY doc_id, island)
 SELECT number, k::BIGINT AS n_chunks, t::BIGINT AS n_tokens, pieces, count(*)::BIGINT AS n_occurrences FROM nr WHERE k > 1 GROUP BY ALL""")
def number_spans(spark, sf):
    """Q16: whole numbers that the pre-split spreads over several chunks, with the token IDs of each chunk."""
    m = C.regex_model(spark, sf)
    return MX.number_spans(PT.split_chunks(C._docs(spark, sf)), m)


_WEIGHTED = O.chunks_cte() + """,
 wl AS (SELECT d.lang, count(*) AS k FROM chunks x JOIN documents d ON d.doc_id = x.doc_id GROUP BY d.lang),
 ww AS (SELECT lang, greatest(1, round(1000.0 * (SELECT sum(k) FROM wl) / (SELECT count(*) FROM wl) / k))::BIGINT AS w FROM wl),
 wd AS (SELECT x.chunk AS c, sum(ww.w)::BIGINT AS n, min(x.doc_id::HUGEINT * 1000000000 + x.chunk_pos) AS f FROM chunks x JOIN documents d ON d.doc_id = x.doc_id JOIN ww ON ww.lang = d.lang GROUP BY x.chunk),
 wsrc AS (SELECT c, n, f, """ + O.byte_syms("c") + """ AS s FROM wd),
 """


@C.query("train_balanced", "WITH RECURSIVE " + _WEIGHTED + O.train_cte(24, "wsrc", 256, "wm") + C._MERGES_SELECT + "wm")
def train_balanced(spark, sf):
    """The regex model trained on chunk counts weighted so that every language has the same share (counts in thousandths)."""
    m, _ = TR.train_balanced(C._docs(spark, sf), 256 + 24, "lang")
    return C._merges_out(spark, m)


SEEDS, SEED_LEN, SAMPLE_SEED = 400, 4, 3
_SEEDS = O.chunks_cte("conversations", "conv_id * 1000 + turn") + f""",
 dic AS (SELECT chunk, count(*) AS n FROM chunks GROUP BY chunk),
 sub AS (SELECT chunk, n, s, l, substr(chunk, s + 1, l) AS piece FROM dic, LATERAL (SELECT unnest(range(0, length(chunk))) AS s) a, LATERAL (SELECT unnest(range(1, {SEED_LEN + 1})) AS l) b WHERE s + l <= length(chunk)),
 cand AS (SELECT piece, sum(n)::BIGINT AS f FROM sub GROUP BY piece),
 voc AS (SELECT piece, f FROM cand WHERE length(piece) = 1 OR f >= (SELECT f FROM cand WHERE length(piece) > 1 ORDER BY f DESC LIMIT 1 OFFSET {SEEDS - 1}))"""


def _conv_chunks(spark, sf):
    conv = corpus.conversations(spark, sf, "conv_id", "turn", "text")
    return PT.split_chunks(conv.select((F.col("conv_id") * 1000 + F.col("turn")).alias("doc_id"), "text"))


def _seeds(spark, sf):
    d = PT.chunk_dictionary(_conv_chunks(spark, sf)).select("chunk", "n")
    return UG.seeds(d, SEEDS, SEED_LEN)


@C.query("unigram_seeds", "WITH " + _SEEDS + " SELECT piece, f FROM voc")
def unigram_seeds(spark, sf):
    """Seed pieces of the conversations: all characters, and the longer substrings down to the count of the 400th."""
    return _seeds(spark, sf)


@C.query("unigram_sample_rows", "WITH RECURSIVE " + _SEEDS + f""",
 vl AS (SELECT piece, ln(f / (SELECT sum(f) FROM voc)) AS lp FROM voc),
 eg AS (SELECT chunk, s + l AS e, list({{'s': s, 'lp': lp}} ORDER BY s) AS ins FROM sub JOIN vl USING (piece) GROUP BY chunk, s + l),
 al(chunk, j, a) AS (SELECT chunk, 0::BIGINT, [0.0::DOUBLE] FROM dic UNION ALL
   SELECT chunk, j + 1, list_append(a, m + ln(list_sum(list_transform(v, lambda x: exp(x - m))))) FROM
     (SELECT chunk, j, a, v, list_max(v) AS m FROM (SELECT x.chunk, x.j, x.a, list_transform(eg.ins, lambda i: x.a[i.s + 1] + i.lp) AS v FROM al x JOIN eg ON eg.chunk = x.chunk AND eg.e = x.j + 1) t1) t2),
 fw AS (SELECT chunk, a FROM al WHERE j = length(chunk)),
 dr(doc_id, pos, chunk, j, ends) AS (SELECT doc_id, chunk_pos, chunk, length(chunk)::BIGINT, []::BIGINT[] FROM chunks UNION ALL
   SELECT doc_id, pos, chunk, ins[coalesce(list_position(list_transform(range(1, len(p) + 1), lambda i: list_sum(p[1:i]) > u), true), len(p))].s::BIGINT, list_prepend(j, ends) FROM
     (SELECT y.doc_id, y.pos, y.chunk, y.j, y.ends, eg.ins, list_transform(eg.ins, lambda i: exp(fw.a[i.s + 1] + i.lp - fw.a[y.j + 1])) AS p,
             {UG.draw_sql('y.doc_id', 'y.pos', 'y.j', SAMPLE_SEED)} AS u
      FROM dr y JOIN eg ON eg.chunk = y.chunk AND eg.e = y.j JOIN fw ON fw.chunk = y.chunk WHERE y.j > 0) t3)
 SELECT doc_id, pos::BIGINT AS pos, len(ends)::BIGINT AS n_pieces, array_to_string(ends, ',') AS ends FROM dr WHERE j = 0""")
def unigram_sample_rows(spark, sf):
    """One sampled segmentation for every chunk occurrence of the conversations, its draws keyed by (row, position, step,
    seed); ``ends`` are the pieces' end offsets."""
    chunks = _conv_chunks(spark, sf)
    v = UG.log_shares(_seeds(spark, sf))
    drawn = UG.sample_occurrences(chunks, v, SEED_LEN, SAMPLE_SEED)
    return drawn.select("doc_id", F.col("pos").cast("bigint"), F.size("ends").cast("bigint").alias("n_pieces"), F.array_join("ends", ",").alias("ends"))
