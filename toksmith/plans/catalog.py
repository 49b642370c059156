"""Registered queries: each is a Spark plan over the given tables plus, where
SQL can express it, an independent DuckDB oracle.

Models used by the queries are trained from the tables themselves (the
regex model on ``documents``, the whole-text byte and char models on
``conversations``) and memoised per input path; a model is bounded by its
vocabulary size.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from toksmith.model import Model
from toksmith.operators import encode as EN
from toksmith.operators import metrics as MX
from toksmith.operators import pairs as P
from toksmith.operators import pretokenize as PT
from toksmith.operators import train as TR
from toksmith.plans import oracle as O
from toksmith.session import write_once
from toksmith.sources import corpus

REGEX_VOCAB = 300  # 44 merges, the size used by the reference's tests
BASIC_VOCAB = 300
CHAR_VOCAB = 400

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    def deco(fn):
        QUERIES[name] = fn
        if sql is not None:
            ORACLE[name] = sql
        return fn
    return deco


# -- models (memoised; small driver-side tables) ----------------------------------
_MODELS: dict[tuple, Model] = {}


def regex_model(spark: SparkSession, sf: str) -> Model:
    key = ("regex", sf, REGEX_VOCAB)
    if key not in _MODELS:
        _MODELS[key] = TR.train_regex(corpus.documents(spark, sf, "doc_id", "text"), REGEX_VOCAB)[0]
    return _MODELS[key]


def basic_model(spark: SparkSession, sf: str) -> Model:
    key = ("basic", sf, BASIC_VOCAB)
    if key not in _MODELS:
        conv = corpus.conversations(spark, sf, "conv_id", "turn", "text")
        docs = conv.select((F.col("conv_id") * 1000 + F.col("turn")).alias("doc_id"), "text")
        _MODELS[key] = TR.train_basic(docs, BASIC_VOCAB)[0]
    return _MODELS[key]


def char_model(spark: SparkSession, sf: str) -> Model:
    key = ("char", sf, CHAR_VOCAB)
    if key not in _MODELS:
        conv = corpus.conversations(spark, sf, "conv_id", "turn", "text")
        docs = conv.select((F.col("conv_id") * 1000 + F.col("turn")).alias("doc_id"), "text")
        _MODELS[key] = TR.train_char(docs, CHAR_VOCAB)[0]
    return _MODELS[key]


def _docs(spark, sf):
    return corpus.documents(spark, sf, "doc_id", "text", "lang", "source")


def _enc_docs(spark, sf, keep=("lang", "source", "text")):
    m = regex_model(spark, sf)
    return EN.encode(_docs(spark, sf), m, keep=tuple(F.col(k) for k in keep))


def _sym_docs(spark, sf, keep=()):
    """Encoded documents as symbol strings (for token statistics)."""
    m = regex_model(spark, sf)
    return EN.encode_symbols(_docs(spark, sf), m, keep=tuple(F.col(k) for k in keep))


def _ids_str(c="ids"):
    return F.array_join(F.col(c), " ")


K_REGEX = REGEX_VOCAB - 256
K_BASIC = BASIC_VOCAB - 256

# SQL: the regex model trained on documents, and every document's encoding.
_REGEX = O.regex_train_ctes(K_REGEX)
_ENC = (_REGEX + ",\n"
        "enc_chunks AS (SELECT x.doc_id, x.chunk_pos, f.s FROM chunks x JOIN merges_final f ON x.chunk = f.c),\n"
        "enc_docs AS (SELECT doc_id, string_agg(s, '' ORDER BY chunk_pos) AS S FROM enc_chunks GROUP BY doc_id),\n"
        "enc AS (SELECT d.doc_id, d.lang, d.source, d.text, coalesce(e.S, '') AS S, length(coalesce(e.S, '')) AS n_tokens\n"
        "        FROM documents d LEFT JOIN enc_docs e ON d.doc_id = e.doc_id),\n"
        "enc_ids AS (SELECT doc_id, lang, unicode(x) - 256 AS id FROM enc, LATERAL (SELECT unnest(string_split(S, '')) AS x) u WHERE length(S) > 0)")


# == pre-split and dictionary ======================================================

@query("presplit_gpt4", "WITH " + O.chunks_cte() +
       " SELECT doc_id, chunk_pos::BIGINT AS chunk_pos, chunk FROM chunks")
def presplit_gpt4(spark, sf):
    """GPT-4 pre-split of every document."""
    c = PT.split_chunks(_docs(spark, sf), "gpt4")
    return c.select("doc_id", F.col("chunk_pos").cast("bigint"), "chunk")


@query("presplit_gpt2", "WITH " + O.chunks_cte(pattern="gpt2") +
       " SELECT doc_id, chunk_pos::BIGINT AS chunk_pos, chunk FROM chunks")
def presplit_gpt2(spark, sf):
    """GPT-2 (as defined by the reference) pre-split."""
    c = PT.split_chunks(_docs(spark, sf), "gpt2")
    return c.select("doc_id", F.col("chunk_pos").cast("bigint"), "chunk")


@query("chunk_dictionary", "WITH " + O.chunks_cte() + """
 SELECT chunk, count(*)::BIGINT AS n, arg_min(doc_id, doc_id * 1000000000 + chunk_pos) AS first_doc_id,
        arg_min(chunk_pos, doc_id * 1000000000 + chunk_pos)::BIGINT AS first_chunk_pos
 FROM chunks GROUP BY chunk""")
def chunk_dictionary(spark, sf):
    """Distinct chunks with count and first occurrence."""
    d = PT.chunk_dictionary(PT.split_chunks(_docs(spark, sf)))
    return d.select("chunk", "n", F.col("first.doc_id").alias("first_doc_id"),
                    F.col("first.chunk_pos").cast("bigint").alias("first_chunk_pos"))


_PAIRS_SQL = ("WITH " + O.chunks_cte() + ",\n"
              f"b AS (SELECT doc_id, chunk_pos, {O.byte_list('chunk')} AS l FROM chunks),\n"
              "p AS (SELECT l[j] AS left_id, l[j + 1] AS right_id, doc_id, chunk_pos, j FROM b, "
              "LATERAL (SELECT unnest(range(1, len(l))) AS j) q)\n")


@query("pair_counts", _PAIRS_SQL +
       "SELECT left_id::BIGINT AS left_id, right_id::BIGINT AS right_id, count(*)::BIGINT AS n FROM p GROUP BY 1, 2")
def pair_counts(spark, sf):
    """A1/A2: byte-pair counts summed over all chunks (weighted by chunk frequency)."""
    d = PT.with_byte_symbols(PT.chunk_dictionary(PT.split_chunks(_docs(spark, sf))))
    s = P.with_ids(P.pair_stats(d))
    return s.select(F.col("left_id").cast("bigint"), F.col("right_id").cast("bigint"), "n")


@query("top_pairs", _PAIRS_SQL + """
SELECT (row_number() OVER (ORDER BY n DESC, pos) - 1)::BIGINT AS rank, left_id, right_id, n FROM (
  SELECT left_id::BIGINT AS left_id, right_id::BIGINT AS right_id, count(*)::BIGINT AS n,
         min(doc_id::HUGEINT * 1000000000000 + chunk_pos * 1000000 + j) AS pos
  FROM p GROUP BY 1, 2 ORDER BY n DESC, pos LIMIT 20) t""")
def top_pairs(spark, sf):
    """A3/L1: the 20 most frequent pairs, ties broken by first occurrence."""
    d = PT.with_byte_symbols(PT.chunk_dictionary(PT.split_chunks(_docs(spark, sf))))
    top = P.with_ids(P.top_pairs(P.pair_stats(d), 20))
    # ≤ 20 rows: the rank window is over the already-limited result
    from pyspark.sql import Window
    w = Window.orderBy(F.col("n").desc(), F.col("pos"))
    return top.select((F.row_number().over(w) - 1).cast("bigint").alias("rank"),
                      F.col("left_id").cast("bigint"), F.col("right_id").cast("bigint"), "n")


# == training =========================================================================

def _merges_out(spark, m: Model) -> DataFrame:
    return m.merges_df(spark).select(*[F.col(c).cast("bigint") for c in
                                       ("rank", "left_id", "right_id", "new_id", "freq", "total_tokens")])


_MERGES_SELECT = " SELECT rank::BIGINT AS rank, left_id::BIGINT AS left_id, right_id::BIGINT AS right_id, " \
                 "new_id::BIGINT AS new_id, freq::BIGINT AS freq, total_tokens::BIGINT AS total_tokens FROM "


@query("train_regex", "WITH RECURSIVE " + _REGEX + _MERGES_SELECT + "merges")
def train_regex(spark, sf):
    """GPT-4-split byte BPE on documents; merge log with tokens after each merge."""
    return _merges_out(spark, regex_model(spark, sf))


_CONV_DOCS = "(SELECT conv_id * 1000 + turn AS doc_id, text FROM conversations)"


@query("train_basic", "WITH RECURSIVE " + O.basic_train_ctes(K_BASIC, _CONV_DOCS, "doc_id", "text")
       + _MERGES_SELECT + "bmerges")
def train_basic(spark, sf):
    """Byte BPE on whole conversation turns (no pre-split)."""
    return _merges_out(spark, basic_model(spark, sf))


# == encoding ==========================================================================

@query("encode_regex", "WITH RECURSIVE " + _ENC +
       f" SELECT doc_id, n_tokens::BIGINT AS n_tokens, {O.ids_of('S')} AS ids FROM enc")
def encode_regex(spark, sf):
    """Every document encoded with the regex model (inline fold, no shuffle)."""
    e = _enc_docs(spark, sf, ())
    return e.select("doc_id", F.col("n_tokens").cast("bigint"), _ids_str().alias("ids"))


@query("encode_basic", "WITH RECURSIVE " + O.basic_train_ctes(K_BASIC, _CONV_DOCS, "doc_id", "text") +
       " SELECT t.doc_id, length(coalesce(f.s, ''))::BIGINT AS n_tokens, " + O.ids_of("coalesce(f.s, '')") + " AS ids"
       f" FROM {_CONV_DOCS} t LEFT JOIN bmerges_final f ON t.text = f.c")
def encode_basic(spark, sf, strategy="inline"):
    """Conversation turns encoded with the whole-text byte model."""
    m = basic_model(spark, sf)
    conv = corpus.conversations(spark, sf, "conv_id", "turn", "text")
    docs = conv.select((F.col("conv_id") * 1000 + F.col("turn")).alias("doc_id"), "text")
    e = EN.encode(docs, m, strategy=strategy)
    return e.select("doc_id", F.col("n_tokens").cast("bigint"), _ids_str().alias("ids"))


# == metrics =============================================================================

@query("compression", "WITH RECURSIVE " + _ENC + """
 SELECT lang, count(*)::BIGINT AS n_docs, sum(octet_length(encode(text)))::BIGINT AS n_bytes,
        sum(n_tokens)::BIGINT AS n_tokens, round(sum(octet_length(encode(text))) / sum(n_tokens), 6) AS bytes_per_token
 FROM enc GROUP BY ROLLUP (lang)""")
def compression(spark, sf):
    """Bytes per token by language, with the overall total (rollup)."""
    return MX.compression(_enc_docs(spark, sf), "lang")


_WS = MX.WHITESPACE_CLASS


@query("fertility", "WITH RECURSIVE " + _ENC + f"""
 SELECT lang, sum(n_tokens)::BIGINT AS n_tokens,
        sum(len(list_filter(regexp_split_to_array(text, {O.q(_WS + '+')}), lambda x: x <> '')))::BIGINT AS n_words,
        sum(length(text))::BIGINT AS n_chars,
        round(sum(n_tokens) / sum(len(list_filter(regexp_split_to_array(text, {O.q(_WS + '+')}), lambda x: x <> ''))), 6) AS fertility,
        round(1000.0 * sum(n_tokens) / sum(length(text)), 6) AS tokens_per_1k_chars
 FROM enc GROUP BY lang""")
def fertility(spark, sf):
    """Q2/Q3: tokens per whitespace word and per 1,000 characters, by language."""
    return MX.fertility(_enc_docs(spark, sf), "lang")


@query("utf8_width", """
 SELECT lang, octet_length(encode(ch))::BIGINT AS width, count(*)::BIGINT AS n_chars
 FROM documents, LATERAL (SELECT unnest(string_split(text, '')) AS ch) u WHERE ch <> '' GROUP BY ALL""")
def utf8_width(spark, sf):
    """Q4: characters by UTF-8 width per language."""
    return MX.utf8_width(_docs(spark, sf), "lang")


@query("token_freq", "WITH RECURSIVE " + _ENC +
       " SELECT id::BIGINT AS id, count(*)::BIGINT AS n FROM enc_ids GROUP BY id")
def token_freq(spark, sf):
    """Q6: token frequencies over the encoded documents."""
    return MX.token_freq(_sym_docs(spark, sf))


@query("zipf", "WITH RECURSIVE " + _ENC + """,
 f AS (SELECT id::BIGINT AS id, count(*)::BIGINT AS n FROM enc_ids GROUP BY id)
 SELECT id, n, row_number() OVER (ORDER BY n DESC, id)::BIGINT AS rank,
        round(n / sum(n) OVER (), 6) AS share,
        round(sum(n) OVER (ORDER BY n DESC, id ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) / sum(n) OVER (), 6) AS cum_share
 FROM f""")
def zipf(spark, sf):
    """Frequency rank, share and cumulative share."""
    return MX.zipf(MX.token_freq(_sym_docs(spark, sf)))


@query("entropy", "WITH RECURSIVE " + _ENC + """,
 f AS (SELECT lang, id, count(*) AS n FROM enc_ids GROUP BY lang, id),
 h AS (SELECT lang, sum(n) AS N, count(*) AS n_types, log2(sum(n)) - sum(n * log2(n)) / sum(n) AS H FROM f GROUP BY lang),
 c AS (SELECT lang, sum(length(text)) AS n_chars FROM documents GROUP BY lang)
 SELECT h.lang, N::BIGINT AS n_tokens, n_types::BIGINT AS n_types, round(H, 6) AS bits_per_token,
        round(H * N / n_chars, 6) AS bits_per_char
 FROM h JOIN c ON h.lang = c.lang""")
def entropy(spark, sf):
    """Q9: unigram token entropy and bits per character by language."""
    e = _sym_docs(spark, sf, ("lang",))
    chars = _docs(spark, sf).groupBy("lang").agg(F.sum(F.length("text")).alias("n_chars"))
    return MX.entropy(MX.token_freq(e, ("lang",)), chars, "lang")


@query("mutual_info", "WITH RECURSIVE " + _ENC + """,
 l AS (SELECT doc_id, string_split(S, '') AS t FROM enc WHERE length(S) > 1),
 j AS (SELECT unicode(t[i]) AS a, unicode(t[i + 1]) AS b, count(*) AS n
       FROM l, LATERAL (SELECT unnest(range(1, len(t))) AS i) q GROUP BY 1, 2),
 la AS (SELECT a, sum(n) AS na FROM j GROUP BY a),
 rb AS (SELECT b, sum(n) AS nb FROM j GROUP BY b),
 s AS (SELECT sum(n) AS T, sum(n * log2(n)) AS s_ab, sum(n * log2(na)) AS s_a, sum(n * log2(nb)) AS s_b
       FROM j JOIN la USING (a) JOIN rb USING (b))
 SELECT T::BIGINT AS n_pairs, round(log2(T) + (s_ab - s_a - s_b) / T, 6) AS mutual_info,
        round(log2(T) - s_ab / T, 6) AS joint_entropy, round(log2(T) - s_a / T, 6) AS left_entropy,
        round((s_a - s_ab) / T, 6) AS cond_entropy FROM s""")
def mutual_info(spark, sf):
    """Q10/Q11: mutual information and conditional entropy of adjacent tokens."""
    return MX.mutual_information(_sym_docs(spark, sf))


# == decode, round trip, vocabulary audits ==============================================

from toksmith.operators import audit as AU  # noqa: E402
from toksmith.operators import decode as DE  # noqa: E402

_DEC = (_ENC + ",\n" + O.expand_cte("dec_syms", "(SELECT doc_id AS key, S AS s FROM enc)", "merges", K_REGEX) + ",\n"
        f"dec AS (SELECT key AS doc_id, decode(unhex({O.sym_hex('s')})) AS text FROM dec_syms)")


@query("decode_bytes", "WITH RECURSIVE " + _DEC + " SELECT doc_id, text FROM dec")
def decode_bytes(spark, sf):
    """Encoded documents decoded back to text (constant piece array, no join)."""
    m = regex_model(spark, sf)
    return DE.decode(_enc_docs(spark, sf, ()), m)


@query("roundtrip", "WITH RECURSIVE " + _DEC + """
 SELECT d.lang, count(*)::BIGINT AS n_docs, sum(CASE WHEN x.text = d.text THEN 1 ELSE 0 END)::BIGINT AS n_ok
 FROM documents d JOIN dec x ON d.doc_id = x.doc_id GROUP BY d.lang""")
def roundtrip(spark, sf):
    """Q1: decode(encode(text)) = text on every document, by language."""
    return AU.roundtrip(_docs(spark, sf), regex_model(spark, sf), "lang")


_VOCAB_SQL = (_REGEX + ",\n" + O.expand_cte("mpieces", "(SELECT new_id AS key, chr((256 + new_id)::INTEGER) AS s FROM merges)",
                                             "merges", K_REGEX) + ",\n"
              "vocab AS (SELECT i::BIGINT AS id, printf('%02X', i) AS piece_hex, 'byte' AS kind FROM range(256) t(i)\n"
              f"          UNION ALL SELECT key::BIGINT, {O.sym_hex('s')}, 'merge' FROM mpieces)")


@query("vocab", "WITH RECURSIVE " + _VOCAB_SQL + " SELECT id, piece_hex, kind FROM vocab")
def vocab(spark, sf):
    """IO4/A7/L3: the regex model's vocabulary rebuilt from its merges."""
    return AU.vocab_table(spark, regex_model(spark, sf))


@query("vocab_listing")
def vocab_listing(spark, sf):
    """IO5/P9: printable ``[%6d] token`` lines of the vocabulary."""
    return AU.vocab_listing(spark, regex_model(spark, sf))


@query("unknown_ids", "WITH RECURSIVE " + _ENC + """
 SELECT doc_id, id::BIGINT AS id FROM enc_ids WHERE id < 0 OR id >= 256 + """ + str(K_REGEX))
def unknown_ids(spark, sf):
    """Token IDs of the encoded corpus that are not in the vocabulary."""
    m = regex_model(spark, sf)
    return AU.unknown_ids(_enc_docs(spark, sf, ()), m).select("doc_id", F.col("id").cast("bigint"))


def _freq_vocab(spark, sf):
    m = regex_model(spark, sf)
    freq = MX.token_freq(_sym_docs(spark, sf))
    return freq, AU.vocab_table(spark, m)


_FREQ_VOCAB = "WITH RECURSIVE " + _VOCAB_SQL + ",\n" + _ENC.split("WITH RECURSIVE ")[-1].replace(_REGEX + ",\n", "") + \
    ",\n f AS (SELECT id::BIGINT AS id, count(*)::BIGINT AS n FROM enc_ids GROUP BY id)\n"


@query("rare_tokens", _FREQ_VOCAB + """
 SELECT v.id, v.piece_hex, v.kind, coalesce(f.n, 0)::BIGINT AS n FROM vocab v LEFT JOIN f ON v.id = f.id
 WHERE coalesce(f.n, 0) < 100""")
def rare_tokens(spark, sf):
    """Q7: vocabulary entries seen fewer than 100 times in the corpus."""
    freq, voc = _freq_vocab(spark, sf)
    return AU.rare_tokens(freq, voc, 100)


@query("unused_tokens", _FREQ_VOCAB + """
 SELECT v.id, v.piece_hex, v.kind FROM vocab v ANTI JOIN f ON v.id = f.id""")
def unused_tokens(spark, sf):
    """Vocabulary entries the encoded corpus never uses (glitch-token candidates)."""
    freq, voc = _freq_vocab(spark, sf)
    return AU.unused_tokens(freq, voc)


@query("boundary_check", "WITH RECURSIVE " + _VOCAB_SQL + """
 SELECT id, piece_hex FROM vocab
 WHERE regexp_matches(decode(unhex(piece_hex), 'replace'), '\\p{L}.*\\p{N}|\\p{N}.*\\p{L}') AND kind = 'merge'""")
def boundary_check(spark, sf):
    """Q14: merged pieces mixing letters and digits (none for a pre-split model)."""
    m = regex_model(spark, sf)
    v = m.vocab_df(spark).where(F.col("kind") == "merge")
    return AU.mixed_letter_digit(v).select(F.col("id").cast("bigint"), F.hex("piece").alias("piece_hex"))


# == char model (space → ▁) ======================================================================

_CONV_ID = "conv_id * 1000 + turn"
_CHAR = O.char_train_ctes(CHAR_VOCAB, "conversations", _CONV_ID)


@query("train_char", "WITH RECURSIVE " + _CHAR + _MERGES_SELECT + "cmerges")
def train_char(spark, sf):
    """Char BPE with ▁ on whole conversation turns; IDs after specials and alphabet."""
    return _merges_out(spark, char_model(spark, sf))


@query("char_alphabet", "WITH RECURSIVE " + _CHAR + " SELECT id::BIGINT AS id, c AS piece FROM alpha")
def char_alphabet(spark, sf):
    """The char model's alphabet with dense IDs from 3 in code-point order."""
    m = char_model(spark, sf)
    rows = [(3 + i, c) for i, c in enumerate(m.alphabet)]
    return spark.createDataFrame(rows, "id BIGINT, piece STRING") if rows else \
        spark.createDataFrame([], "id BIGINT, piece STRING")


def _char_docs_sql():
    # documents → ▁ → alphabet IDs (unknown → 0) → char model merges in rank order
    return (_CHAR + ",\n"
            "_dm AS (SELECT doc_id, replace(text, ' ', '▁') AS t FROM documents WHERE text IS NOT NULL),\n"
            "_dch AS (SELECT doc_id, p, ch FROM _dm, LATERAL (SELECT generate_subscripts(string_split(t, ''), 1) AS p, "
            "unnest(string_split(t, '')) AS ch) u WHERE ch <> ''),\n"
            "_dsym AS (SELECT doc_id, string_agg(chr((256 + coalesce(a.id, 0))::INTEGER), '' ORDER BY p) AS s FROM _dch "
            "LEFT JOIN alpha a ON a.c = _dch.ch GROUP BY doc_id),\n"
            "_dfold(i, doc_id, s) AS (SELECT 0, doc_id, s FROM _dsym UNION ALL\n"
            "  SELECT x.i + 1, x.doc_id, replace(x.s, m.pr, chr((256 + m.new_id)::INTEGER)) FROM _dfold x JOIN cmerges m ON m.rank = x.i),\n"
            "cenc AS (SELECT d.doc_id, d.lang, coalesce(f.s, '') AS s FROM documents d LEFT JOIN "
            "(SELECT doc_id, s FROM _dfold WHERE i = (SELECT count(*) FROM cmerges)) f ON d.doc_id = f.doc_id)")


@query("encode_char", "WITH RECURSIVE " + _char_docs_sql() +
       f" SELECT doc_id, (length(s) + 2)::BIGINT AS n_tokens, '1 ' || {O.ids_of('s')} || ' 2' AS ids FROM cenc")
def encode_char(spark, sf, strategy="inline"):
    """Documents encoded with the char model, with BOS and EOS."""
    m = char_model(spark, sf)
    m2 = type(m)(**{**m.__dict__, "add_bos": True, "add_eos": True})
    e = EN.encode(_docs(spark, sf), m2, strategy=strategy)
    # IDs joined with single spaces; an empty text gives "1  2" in both engines
    return e.select("doc_id", F.col("n_tokens").cast("bigint"),
                    F.concat(F.lit("1 "), F.array_join(F.slice("ids", 2, F.size("ids") - 2), " "), F.lit(" 2")).alias("ids"))


@query("oov_rate", "WITH RECURSIVE " + _char_docs_sql() + """,
 _u AS (SELECT d.lang, _dch.ch, a.id FROM _dch JOIN documents d ON d.doc_id = _dch.doc_id LEFT JOIN alpha a ON a.c = _dch.ch)
 SELECT lang, count(*)::BIGINT AS n_chars, count(*) FILTER (WHERE id IS NULL)::BIGINT AS n_unk,
        round(count(*) FILTER (WHERE id IS NULL) / count(*), 6) AS oov_rate FROM _u GROUP BY lang""")
def oov_rate(spark, sf):
    """Q19: share of characters unknown to the char model, by language."""
    return AU.oov_rate(_docs(spark, sf), char_model(spark, sf), "lang")


@query("decode_char", "WITH RECURSIVE " + _char_docs_sql() + """,
 """ + O.expand_cte("cdec", "(SELECT doc_id AS key, s FROM cenc)", "cmerges") + """,
 _pc AS (SELECT key AS doc_id, p, unicode(x) - 256 AS id FROM cdec,
         LATERAL (SELECT generate_subscripts(string_split(s, ''), 1) AS p, unnest(string_split(s, '')) AS x) u WHERE x <> ''),
 _txt AS (SELECT doc_id, string_agg(CASE WHEN _pc.id = 0 THEN '<unk>' ELSE a.c END, '' ORDER BY p) AS t
          FROM _pc LEFT JOIN alpha a ON a.id = _pc.id GROUP BY doc_id)
 SELECT d.doc_id, regexp_replace(replace(coalesce(t, ''), '▁', ' '), '^[\\t\\n\\x0b\\x0c\\r\\x1c-\\x1f \\x{85}\\x{a0}]+|[\\t\\n\\x0b\\x0c\\r\\x1c-\\x1f \\x{85}\\x{a0}]+$', '', 'g') AS text
 FROM documents d LEFT JOIN _txt ON d.doc_id = _txt.doc_id""")
def decode_char(spark, sf):
    """Char-model decode of the encoded documents (unknown → <unk>, ▁ → space, stripped)."""
    m = char_model(spark, sf)
    e = EN.encode(_docs(spark, sf), m)
    return DE.decode(e, m)


# == special tokens ==================================================================================

from toksmith.operators import specials as SP  # noqa: E402
from toksmith.operators import vocabulary as VO  # noqa: E402
from toksmith.operators import windows as WN  # noqa: E402

# Special tokens and IDs used by the reference's tests, plus the chat markers.
SPECIALS = {"<|endoftext|>": 400, "<|pad|>": 401}
CHAT_SPECIALS = {"<|endoftext|>": 400, "<|pad|>": 401, "<|im_start|>": 402, "<|im_end|>": 403}
SCREEN_TOKENS = ["<|endoftext|>", "<|pad|>", "<|im_start|>", "<|im_end|>"]

_MARK = ""


def _sql_segments(name: str, source: str, specials: dict[str, int]) -> str:
    """SQL: ``source(doc_id, t)`` split into text / special segments (longest token first);
    exposes ``name(doc_id, seg_pos, seg, sid)`` with 0-based positions, empty segments dropped."""
    expr = "t"
    for tok, i in sorted(specials.items(), key=lambda x: (-len(x[0]), x[0])):
        expr = f"replace({expr}, {O.q(tok)}, {O.q(_MARK + chr(0xF000 + i) + _MARK)})"
    return f"""_{name}_raw AS (SELECT doc_id, generate_subscripts(l, 1) AS sp, unnest(l) AS seg
                FROM (SELECT doc_id, string_split({expr}, {O.q(_MARK)}) AS l FROM {source}) x),
{name} AS (SELECT doc_id, (row_number() OVER (PARTITION BY doc_id ORDER BY sp) - 1) AS seg_pos, seg,
                  CASE WHEN length(seg) = 1 AND unicode(seg) >= 61440 AND unicode(seg) < 61440 + 4096
                       THEN unicode(seg) - 61440 END AS sid
           FROM _{name}_raw WHERE seg <> '')"""


def _sql_encode_with_specials(name: str, source: str, specials: dict[str, int], merges: str = "merges") -> str:
    """SQL: ``source(doc_id, t)`` encoded with specials allowed; exposes ``name(doc_id, S)``."""
    return (_sql_segments(f"{name}_sg", source, specials) + ",\n"
            f"{name}_txt AS (SELECT doc_id * 1000000 + seg_pos AS doc_id, seg AS text FROM {name}_sg WHERE sid IS NULL),\n"
            + O.fold_docs_ctes(f"{name}_fx", f"{name}_txt", merges) + ",\n"
            f"{name}_parts AS (SELECT g.doc_id, g.seg_pos, CASE WHEN g.sid IS NOT NULL THEN chr((256 + g.sid)::INTEGER) ELSE f.S END AS s\n"
            f"   FROM {name}_sg g LEFT JOIN {name}_fx f ON f.doc_id = g.doc_id * 1000000 + g.seg_pos),\n"
            f"_{name}_agg AS (SELECT doc_id, string_agg(s, '' ORDER BY seg_pos) AS S FROM {name}_parts GROUP BY doc_id),\n"
            f"{name} AS (SELECT x.doc_id, coalesce(a.S, '') AS S FROM {source} x LEFT JOIN _{name}_agg a ON x.doc_id = a.doc_id)")


def _special_model(spark, sf, specials=SPECIALS):
    return SP.register_specials(regex_model(spark, sf), specials)


_NL_DOCS = "(SELECT doc_id, replace(text, chr(10), '<|endoftext|>') AS t FROM documents WHERE text IS NOT NULL)"


@query("encode_specials", "WITH RECURSIVE " + _REGEX + ",\n" + _sql_encode_with_specials("es", _NL_DOCS, SPECIALS) +
       f" SELECT doc_id, length(S)::BIGINT AS n_tokens, {O.ids_of('S')} AS ids FROM es")
def encode_specials(spark, sf, strategy="inline"):
    """Documents whose line breaks are written as <|endoftext|>, encoded with
    special tokens allowed (longest-first segmentation, specials → their IDs)."""
    m = _special_model(spark, sf)
    docs = corpus.documents(spark, sf, "doc_id", "text").where(F.col("text").isNotNull()).select(
        "doc_id", F.replace(F.col("text"), F.lit("\n"), F.lit("<|endoftext|>")).alias("text"))
    e = EN.encode(docs, m, allowed_special="all", strategy=strategy)
    return e.select("doc_id", F.col("n_tokens").cast("bigint"), _ids_str().alias("ids"))


def _conv_injected(spark, sf):
    """Conversations with special-token strings typed by users: user turns end with
    ' <|endoftext|>', system turns start with '<|im_start|>'."""
    c = corpus.conversations(spark, sf, "conv_id", "turn", "role", "text")
    t = F.when(F.col("role") == "user", F.concat(F.col("text"), F.lit(" <|endoftext|>"))) \
        .when(F.col("role") == "system", F.concat(F.lit("<|im_start|>"), F.col("text"))).otherwise(F.col("text"))
    return c.select((F.col("conv_id") * 1000 + F.col("turn")).alias("doc_id"), "conv_id", "turn", "role", t.alias("text"))


_CONV_INJ = ("(SELECT conv_id * 1000 + turn AS doc_id, conv_id, turn, role, CASE WHEN role = 'user' THEN text || ' <|endoftext|>' "
             "WHEN role = 'system' THEN '<|im_start|>' || text ELSE text END AS text FROM conversations)")


@query("special_segments", "WITH " + _sql_segments("sg", f"(SELECT doc_id, text AS t FROM {_CONV_INJ} c)", CHAT_SPECIALS) +
       " SELECT doc_id, seg_pos::BIGINT AS seg_pos, CASE WHEN sid IS NULL THEN seg ELSE "
       + " ".join(f"WHEN sid = {i} THEN {O.q(t)}" for t, i in CHAT_SPECIALS.items()).join(["CASE ", " END"])
       + " END AS segment, sid IS NOT NULL AS is_special FROM sg")
def special_segments(spark, sf):
    """P10/L2: user text split into text and special-token segments."""
    s = SP.segments(_conv_injected(spark, sf), list(CHAT_SPECIALS))
    return s.select("doc_id", F.col("seg_pos").cast("bigint"), "segment", "is_special")


@query("special_policy", "WITH RECURSIVE " + _REGEX + ",\n" + O.fold_docs_ctes("sp", f"(SELECT doc_id, text FROM {_CONV_INJ} c)") + """
 SELECT c.doc_id, CASE WHEN regexp_matches(c.text, '<\\|endoftext\\|>|<\\|pad\\|>') THEN 'rejected' ELSE 'clean' END AS status,
        length(sp.S)::BIGINT AS n_tokens_as_text
 FROM """ + _CONV_INJ + " c JOIN sp ON c.doc_id = sp.doc_id")
def special_policy(spark, sf):
    """The default policy (none_raise) as a bulk quarantine of rows that contain a
    registered special token; tokens when specials are read as plain text (policy none)."""
    m = _special_model(spark, sf)
    conv = _conv_injected(spark, sf)
    clean, rejected = SP.policy_split(conv, m)
    both = clean.withColumn("status", F.lit("clean")).unionByName(rejected.withColumn("status", F.lit("rejected")))
    n = F.length(EN.text_symbols(F.col("text"), m, "none"))
    return both.select("doc_id", "status", n.cast("bigint").alias("n_tokens_as_text"))


@query("special_screen", "WITH x AS (SELECT doc_id, unnest(regexp_extract_all(text, "
       + O.q("|".join(__import__("re").escape(t) for t in sorted(SCREEN_TOKENS, key=lambda t: (-len(t), t)))) + ")) AS token FROM "
       + _CONV_INJ + " c) SELECT doc_id, token, count(*)::BIGINT AS n FROM x GROUP BY doc_id, token")
def special_screen(spark, sf):
    """Special-token strings found in user-supplied text."""
    return SP.screen(_conv_injected(spark, sf), SCREEN_TOKENS)


# == corpus jobs: windows, packing, budgets ============================================================

@query("token_chunks", "WITH RECURSIVE " + _ENC + """,
 w AS (SELECT doc_id, S, unnest(generate_series(0, length(S) - 1, 224)) AS start FROM enc WHERE length(S) > 0)
 SELECT doc_id, (start // 224)::BIGINT AS window, start::BIGINT AS start, least(256, length(S) - start)::BIGINT AS n_tokens,
        (unicode(substr(S, start + 1, 1)) - 256)::BIGINT AS first_id,
        (unicode(substr(S, start + least(256, length(S) - start), 1)) - 256)::BIGINT AS last_id FROM w""")
def token_chunks(spark, sf):
    """256-token retrieval chunks with 32 tokens of overlap, never splitting a token."""
    w = WN.token_windows(_enc_docs(spark, sf, ()), 256, 32)
    return w.select("doc_id", F.col("window").cast("bigint"), F.col("start").cast("bigint"),
                    F.size("ids").cast("bigint").alias("n_tokens"),
                    F.col("ids")[0].cast("bigint").alias("first_id"),
                    F.element_at("ids", -1).cast("bigint").alias("last_id"))


@query("pack_context", "WITH RECURSIVE " + _ENC + """,
 o AS (SELECT doc_id, (n_tokens + 1) AS len,
              coalesce(sum(n_tokens + 1) OVER (ORDER BY doc_id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS ofs FROM enc)
 SELECT doc_id, ofs::BIGINT AS "offset", len::BIGINT AS "length", (ofs // 2048)::BIGINT AS first_context,
        ((ofs + len - 1) // 2048)::BIGINT AS last_context FROM o""")
def pack_context(spark, sf):
    """Documents plus an end-of-text token packed end to end into 2,048-token contexts."""
    e = EN.encode_symbols(_docs(spark, sf), regex_model(spark, sf))
    return WN.pack(e, 2048)


_CONV_ENC = ("WITH RECURSIVE " + _REGEX + ",\n" +
             O.fold_docs_ctes("ce", "(SELECT conv_id * 1000 + turn AS doc_id, text FROM conversations)") + ",\n"
             "cv AS (SELECT c.conv_id, c.turn, c.role, length(ce.S) AS n_tokens FROM conversations c "
             "JOIN ce ON ce.doc_id = c.conv_id * 1000 + c.turn)\n")


def _conv_enc(spark, sf):
    c = corpus.conversations(spark, sf, "conv_id", "turn", "role", "text")
    return EN.encode_symbols(c.withColumn("doc_id", F.col("conv_id") * 1000 + F.col("turn")), regex_model(spark, sf),
                             keep=(F.col("conv_id"), F.col("turn"), F.col("role")))


@query("token_budget", _CONV_ENC + """
 SELECT conv_id, turn, n_tokens::BIGINT AS n_tokens,
        sum(n_tokens) OVER (PARTITION BY conv_id ORDER BY turn ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)::BIGINT AS cum_tokens,
        sum(n_tokens) OVER (PARTITION BY conv_id ORDER BY turn ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) <= 1024 AS fits
 FROM cv""")
def token_budget(spark, sf):
    """Running token total per conversation in turn order; turns that fit a 1,024-token budget."""
    e = _conv_enc(spark, sf).select("conv_id", "turn", F.col("n_tokens").cast("bigint"))
    return WN.budget(e, "conv_id", "turn", "n_tokens", 1024)


@query("context_budget", _CONV_ENC + """
 SELECT role, sum(n_tokens)::BIGINT AS n_tokens, round(sum(n_tokens) / (SELECT sum(n_tokens) FROM cv), 6) AS share,
        round(avg(n_tokens), 6) AS avg_tokens, floor(4096 / avg(n_tokens))::BIGINT AS fit_in_4096 FROM cv GROUP BY role""")
def context_budget(spark, sf):
    """Share of tokens by conversation role and how many average turns fit 4,096 tokens."""
    e = _conv_enc(spark, sf)
    g = e.groupBy("role").agg(F.sum("n_tokens").cast("bigint").alias("n_tokens"), F.avg("n_tokens").alias("_avg"))
    from pyspark.sql import Window
    g = g.withColumn("_t", F.sum("n_tokens").over(Window.partitionBy()))  # one row per role
    return g.select(
        "role", "n_tokens", MX.r6(F.col("n_tokens") / F.col("_t")).alias("share"), MX.r6("_avg").alias("avg_tokens"),
        F.floor(F.lit(4096) / F.col("_avg")).cast("bigint").alias("fit_in_4096"))


@query("over_length", "WITH RECURSIVE " + _ENC + """
 SELECT lang, count(*)::BIGINT AS n_over, max(n_tokens)::BIGINT AS max_tokens FROM enc WHERE n_tokens > 2048 GROUP BY lang""")
def over_length(spark, sf):
    """Documents longer than a 2,048-token context, by language."""
    e = EN.encode_symbols(_docs(spark, sf), regex_model(spark, sf), keep=(F.col("lang"),))
    return e.where(F.col("n_tokens") > 2048).groupBy("lang").agg(
        F.count(F.lit(1)).alias("n_over"), F.max("n_tokens").cast("bigint").alias("max_tokens"))


@query("inflation", "WITH RECURSIVE " + _ENC + """
 SELECT lang, round(max(n_tokens / length(text)), 6) AS max_tokens_per_char,
        count(*) FILTER (WHERE n_tokens > 0.5 * length(text))::BIGINT AS n_inflated,
        sum(least(n_tokens, 1024))::BIGINT AS tokens_truncated_1024 FROM enc WHERE length(text) > 0 GROUP BY lang""")
def inflation(spark, sf):
    """Token inflation (tokens per character), outliers above 0.5, and truncation to 1,024 tokens."""
    e = EN.encode_symbols(_docs(spark, sf), regex_model(spark, sf), keep=(F.col("lang"), F.col("text")))
    e = e.where(F.length("text") > 0)
    return e.groupBy("lang").agg(
        MX.r6(F.max(F.col("n_tokens") / F.length("text"))).alias("max_tokens_per_char"),
        F.sum((F.col("n_tokens") > F.lit(0.5) * F.length("text")).cast("int")).cast("bigint").alias("n_inflated"),
        F.sum(F.least(F.col("n_tokens"), F.lit(1024))).cast("bigint").alias("tokens_truncated_1024"))


@query("chat_render", "WITH RECURSIVE " + _REGEX + """,
 r AS (SELECT conv_id AS doc_id, count(*) AS n_turns,
              string_agg('<|im_start|>' || role || chr(10) || text || '<|im_end|>' || chr(10), '' ORDER BY turn) AS t
       FROM conversations GROUP BY conv_id),
 """ + _sql_encode_with_specials("ch", "(SELECT doc_id, t FROM r)", CHAT_SPECIALS) + """
 SELECT r.doc_id AS conv_id, r.n_turns::BIGINT AS n_turns, length(ch.S)::BIGINT AS n_tokens FROM r JOIN ch ON r.doc_id = ch.doc_id""")
def chat_render(spark, sf):
    """Conversations rendered with turn markers (ChatML form) and encoded with the markers as
    specials.  Every turn is delimited by special tokens, so no text segment crosses a turn and the
    conversation's token count is the sum over its rendered turns: a partial aggregate, never a
    whole conversation collected into one task."""
    m = _special_model(spark, sf, CHAT_SPECIALS)
    c = corpus.conversations(spark, sf, "conv_id", "turn", "role", "text")
    turn = F.concat(F.lit("<|im_start|>"), F.col("role"), F.lit("\n"), F.col("text"), F.lit("<|im_end|>\n"))
    t = c.select("conv_id", F.length(EN.text_symbols(turn, m, "all")).alias("n"))
    return t.groupBy("conv_id").agg(F.count(F.lit(1)).cast("bigint").alias("n_turns"),
                                    F.sum("n").cast("bigint").alias("n_tokens"))


def render_chat(conv: DataFrame) -> DataFrame:
    """The rendered text of each turn (``<|im_start|>role\ntext<|im_end|>\n``) in turn order;
    the conversation text is the concatenation of its turns."""
    turn = F.concat(F.lit("<|im_start|>"), F.col("role"), F.lit("\n"), F.col("text"), F.lit("<|im_end|>\n"))
    return conv.select("conv_id", "turn", turn.alias("rendered"))


# == chunk-level analyses (distinct chunks with their encoding) ========================================

from toksmith.functions.symbols import byte_symbols  # noqa: E402
from toksmith.functions import text as TX  # noqa: E402


def _chunk_syms(spark, sf):
    """Distinct document chunks ``(chunk, n, sym)`` with their encoding under the regex model."""
    m = regex_model(spark, sf)
    d = PT.chunk_dictionary(PT.split_chunks(_docs(spark, sf)))
    return d.select("chunk", "n", EN.fold(byte_symbols("chunk"), m).alias("sym"))


_CS = "WITH RECURSIVE " + _REGEX + ",\n cs AS (SELECT c AS chunk, n, s AS sym FROM merges_final)\n"


@query("case_variants", _CS + """
 SELECT lower(ltrim(chunk, ' ')) AS word, count(DISTINCT chunk)::BIGINT AS n_forms,
        count(DISTINCT sym)::BIGINT AS n_tokenizations, sum(n)::BIGINT AS n_occurrences
 FROM cs WHERE regexp_matches(chunk, '^ ?\\p{L}+$') GROUP BY 1 HAVING count(DISTINCT sym) > 1""")
def case_variants(spark, sf):
    """Q15: one word, several tokenizations (leading-space and case variants)."""
    c = _chunk_syms(spark, sf).where(F.col("chunk").rlike(r"^ ?\p{L}+$"))
    g = c.groupBy(F.lower(F.ltrim(F.col("chunk"))).alias("word")).agg(
        F.countDistinct("chunk").alias("n_forms"), F.countDistinct("sym").alias("n_tokenizations"),
        F.sum("n").cast("bigint").alias("n_occurrences"))
    return g.where(F.col("n_tokenizations") > 1)


@query("number_split", _CS + """
 SELECT length(chunk)::BIGINT AS n_digits, sum(n)::BIGINT AS n_occurrences,
        round(sum(n * length(sym)) / sum(n), 6) AS avg_tokens, count(*)::BIGINT AS n_distinct
 FROM cs WHERE regexp_matches(chunk, '^\\p{N}+$') GROUP BY 1""")
def number_split(spark, sf):
    """Q16: how numbers split: tokens per number by digit count."""
    c = _chunk_syms(spark, sf).where(F.col("chunk").rlike(r"^\p{N}+$"))
    return c.groupBy(F.length("chunk").cast("bigint").alias("n_digits")).agg(
        F.sum("n").cast("bigint").alias("n_occurrences"),
        MX.r6(F.sum(F.col("n") * F.length("sym")) / F.sum("n")).alias("avg_tokens"),
        F.count(F.lit(1)).alias("n_distinct"))


@query("whitespace_cost", _CS + """
 SELECT length(chunk)::BIGINT AS width, sum(n)::BIGINT AS n_occurrences,
        round(sum(n * length(sym)) / sum(n), 6) AS avg_tokens
 FROM cs WHERE regexp_matches(chunk, '^[ \\t]+$') GROUP BY 1""")
def whitespace_cost(spark, sf):
    """Q17: tokens spent on runs of spaces/tabs, by run width."""
    c = _chunk_syms(spark, sf).where(F.col("chunk").rlike(r"^[ \t]+$"))
    return c.groupBy(F.length("chunk").cast("bigint").alias("width")).agg(
        F.sum("n").cast("bigint").alias("n_occurrences"),
        MX.r6(F.sum(F.col("n") * F.length("sym")) / F.sum("n")).alias("avg_tokens"))


@query("delimiter_cost", _CS + """
 SELECT chunk, n::BIGINT AS n_occurrences, length(sym)::BIGINT AS n_tokens
 FROM cs WHERE regexp_matches(chunk, '^ ?[^\\s\\p{L}\\p{N}]+[\\r\\n]*$')""")
def delimiter_cost(spark, sf):
    """Q18: token cost of each punctuation/delimiter chunk seen in the corpus."""
    c = _chunk_syms(spark, sf).where(F.col("chunk").rlike(r"^ ?[^\s\p{L}\p{N}]+[\r\n]*$"))
    return c.select("chunk", F.col("n").alias("n_occurrences"), F.length("sym").cast("bigint").alias("n_tokens"))


# == vocabulary lifecycle =================================================================================

SWEEP = (256, 266, 276, 286, 300)


@query("vocab_sweep", "WITH RECURSIVE " + _REGEX + """,
 b AS (SELECT sum(octet_length(encode(text))) AS bytes FROM documents),
 t AS (SELECT 256 AS vocab_size, (SELECT bytes FROM b) AS n_tokens
       UNION ALL SELECT new_id + 1, total_tokens FROM merges WHERE new_id + 1 IN """ + str(SWEEP) + """)
 SELECT vocab_size::BIGINT AS vocab_size, n_tokens::BIGINT AS n_tokens, round((SELECT bytes FROM b) / n_tokens, 6) AS bytes_per_token FROM t""")
def vocab_sweep(spark, sf):
    """T5: nested vocabularies (merge-rank prefixes) evaluated in one pass over the corpus."""
    m = regex_model(spark, sf)
    docs = _docs(spark, sf)
    s = F.col("_s0")
    cols, prev = [], 0
    x = docs.select(F.octet_length("text").alias("_b"),
                    F.array_join(F.transform(PT.split_column(F.col("text"), m.pattern), lambda c: byte_symbols(c)),
                                 EN.SEP).alias("_s0"))
    for v in SWEEP:
        k = v - 256
        part = type(m)("regex", m.merges[prev:k], pattern=m.pattern)
        s = EN.fold(s, part)
        prev = k
        x = x.withColumn(f"_s{v}", s)
        s = F.col(f"_s{v}")
        cols.append(F.struct(F.lit(v).alias("vocab_size"),
                             F.length(F.replace(F.col(f"_s{v}"), F.lit(EN.SEP), F.lit(""))).alias("n")))
    ex = x.select("_b", F.explode(F.array(*cols)).alias("r"))
    g = ex.groupBy(F.col("r.vocab_size").cast("bigint").alias("vocab_size")).agg(
        F.sum("r.n").cast("bigint").alias("n_tokens"), F.sum("_b").alias("_bytes"))
    return g.select("vocab_size", "n_tokens", MX.r6(F.col("_bytes") / F.col("n_tokens")).alias("bytes_per_token"))


_BENCH = "(SELECT item_id AS doc_id, text FROM benchmark)"


@query("model_diff", "WITH RECURSIVE " + _REGEX + ",\n"
       + O.fold_docs_ctes("va", _BENCH, "(SELECT * FROM merges WHERE rank < 24)") + ",\n"
       + O.fold_docs_ctes("vb", _BENCH, "merges") + """
 SELECT va.doc_id AS item_id, length(va.S)::BIGINT AS n_tokens_280, length(vb.S)::BIGINT AS n_tokens_300, va.S = vb.S AS same
 FROM va JOIN vb ON va.doc_id = vb.doc_id""")
def model_diff(spark, sf):
    """Q20: regression of two model versions (280 vs 300 tokens) on the fixed benchmark set."""
    m = regex_model(spark, sf)
    m280 = type(m)("regex", m.merges[:24], pattern=m.pattern)
    b = corpus.table(spark, sf, "benchmark", "item_id", "text")
    a1, a2 = EN.text_symbols(F.col("text"), m280), EN.text_symbols(F.col("text"), m)
    return b.select("item_id", F.length(a1).cast("bigint").alias("n_tokens_280"),
                    F.length(a2).cast("bigint").alias("n_tokens_300"), (a1 == a2).alias("same"))


_BVOCAB = (O.basic_train_ctes(K_BASIC, _CONV_DOCS, "doc_id", "text") + ",\n"
           + O.expand_cte("bpieces", "(SELECT new_id AS key, chr((256 + new_id)::INTEGER) AS s FROM bmerges)", "bmerges", K_BASIC) + ",\n"
           "bvocab AS (SELECT i::BIGINT AS id, printf('%02X', i) AS piece_hex FROM range(256) t(i)\n"
           f"          UNION ALL SELECT key::BIGINT, {O.sym_hex('s')} FROM bpieces)")


@query("vocab_compare", "WITH RECURSIVE " + _VOCAB_SQL + ",\n" + _BVOCAB + """
 SELECT coalesce(v.piece_hex, b.piece_hex) AS piece_hex, coalesce(v.id, -1)::BIGINT AS id_documents,
        coalesce(b.id, -1)::BIGINT AS id_conversations
 FROM vocab v FULL OUTER JOIN bvocab b ON v.piece_hex = b.piece_hex""")
def vocab_compare(spark, sf):
    """Two vocabularies (documents vs conversations model) side by side: shared and one-sided pieces."""
    a = AU.vocab_table(spark, regex_model(spark, sf)).select(F.col("piece_hex").alias("p"), F.col("id").alias("id_documents"))
    b = AU.vocab_table(spark, basic_model(spark, sf)).select(F.col("piece_hex").alias("q"), F.col("id").alias("id_conversations"))
    j = a.join(b, a["p"] == b["q"], "full_outer")
    # -1 marks a piece absent from one side
    return j.select(F.coalesce("p", "q").alias("piece_hex"), F.coalesce("id_documents", F.lit(-1)).cast("bigint").alias("id_documents"),
                    F.coalesce("id_conversations", F.lit(-1)).cast("bigint").alias("id_conversations"))


@query("head_to_head", "WITH RECURSIVE " + _REGEX + ",\n" + O.basic_train_ctes(K_BASIC, _CONV_DOCS, "doc_id", "text") + ",\n"
       + O.fold_docs_ctes("hr", _BENCH, "merges") + ",\n" + O.fold_docs_ctes("hb", _BENCH, "bmerges", None) + """,
 nb AS (SELECT sum(octet_length(encode(text))) AS bytes, sum(length(text)) AS chars FROM benchmark)
 SELECT 'regex' AS model, sum(length(S))::BIGINT AS n_tokens, round((SELECT bytes FROM nb) / sum(length(S)), 6) AS bytes_per_token,
        round(1000.0 * sum(length(S)) / (SELECT chars FROM nb), 6) AS tokens_per_1k_chars FROM hr
 UNION ALL
 SELECT 'basic', sum(length(S))::BIGINT, round((SELECT bytes FROM nb) / sum(length(S)), 6),
        round(1000.0 * sum(length(S)) / (SELECT chars FROM nb), 6) FROM hb""")
def head_to_head(spark, sf):
    """Q5: two tokenizers on one corpus (the benchmark set)."""
    b = corpus.table(spark, sf, "benchmark", "item_id", "text")
    parts = []
    for name, m in (("regex", regex_model(spark, sf)), ("basic", basic_model(spark, sf))):
        parts.append(b.select(F.lit(name).alias("model"), F.length(EN.text_symbols(F.col("text"), m)).alias("n"),
                              F.octet_length("text").alias("by"), F.length("text").alias("ch")))
    u = parts[0].unionByName(parts[1])
    g = u.groupBy("model").agg(F.sum("n").cast("bigint").alias("n_tokens"), F.sum("by").alias("_b"), F.sum("ch").alias("_c"))
    return g.select("model", "n_tokens", MX.r6(F.col("_b") / F.col("n_tokens")).alias("bytes_per_token"),
                    MX.r6(F.lit(1000.0) * F.col("n_tokens") / F.col("_c")).alias("tokens_per_1k_chars"))


_BIGRAMS = """,
 l AS (SELECT doc_id, string_split(S, '') AS t FROM enc WHERE length(S) > 1),
 j AS (SELECT unicode(t[i]) - 256 AS a, unicode(t[i + 1]) - 256 AS b, count(*) AS n
       FROM l, LATERAL (SELECT unnest(range(1, len(t))) AS i) q GROUP BY 1, 2)"""


@query("vocab_expand", "WITH RECURSIVE " + _ENC + _BIGRAMS + """
 SELECT (row_number() OVER (ORDER BY n DESC, a, b) - 1)::BIGINT AS rank, a::BIGINT AS left_id, b::BIGINT AS right_id,
        n::BIGINT AS n, (300 + row_number() OVER (ORDER BY n DESC, a, b) - 1)::BIGINT AS new_id
 FROM (SELECT * FROM j ORDER BY n DESC, a, b LIMIT 20) t""")
def vocab_expand(spark, sf):
    """X11: the 20 most frequent adjacent token pairs of the encoded corpus as new vocabulary entries."""
    from pyspark.sql import Window
    j = MX.bigram_counts(_sym_docs(spark, sf)).orderBy(F.col("n").desc(), "a", "b").limit(20)
    w = Window.orderBy(F.col("n").desc(), "a", "b")  # over the 20 rows only
    r = F.row_number().over(w) - 1
    return j.select(r.cast("bigint").alias("rank"), F.col("a").alias("left_id"), F.col("b").alias("right_id"), "n",
                    (F.lit(300) + r).cast("bigint").alias("new_id"))


@query("token_healing", "WITH RECURSIVE " + _VOCAB_SQL + ",\n" + O.fold_docs_ctes("th", _BENCH, "merges") + """,
 last AS (SELECT doc_id, unicode(substr(S, length(S), 1)) - 256 AS last_id FROM th WHERE length(S) > 0)
 SELECT l.doc_id AS item_id, l.last_id::BIGINT AS last_id, count(w.id)::BIGINT AS n_extensions
 FROM last l JOIN vocab v ON v.id = l.last_id
 LEFT JOIN vocab w ON starts_with(w.piece_hex, v.piece_hex) AND length(w.piece_hex) > length(v.piece_hex)
 GROUP BY l.doc_id, l.last_id""")
def token_healing(spark, sf):
    """For each prompt, the last token and how many vocabulary pieces extend it (healing candidates).
    The prefix join is bucketed on the first byte (equi-join) and filtered by prefix; the vocabulary is
    bounded, so it is broadcast."""
    m = regex_model(spark, sf)
    b = corpus.table(spark, sf, "benchmark", "item_id", "text")
    s = EN.text_symbols(F.col("text"), m)
    last = b.select("item_id", s.alias("s")).where(F.length("s") > 0).select(
        "item_id", F.element_at(EN.symbols_ids(F.col("s")), -1).cast("bigint").alias("last_id"))
    v = m.vocab_df(spark).select(F.col("id").cast("bigint").alias("vid"), F.col("piece").alias("vp"))
    w = m.vocab_df(spark).select(F.col("id").alias("wid"), F.col("piece").alias("wp"))
    lv = last.join(F.broadcast(v), last["last_id"] == v["vid"])
    cand = lv.join(F.broadcast(w), (F.substring(w["wp"], 1, 1) == F.substring(lv["vp"], 1, 1))
                   & (F.substring(w["wp"], 1, F.length(lv["vp"])) == lv["vp"]) & (F.length(w["wp"]) > F.length(lv["vp"])), "left")
    return cand.groupBy("item_id", "last_id").agg(F.count("wid").alias("n_extensions"))


@query("perplexity", "WITH RECURSIVE " + _ENC + """,
 f AS (SELECT id, count(*) AS n FROM enc_ids GROUP BY id),
 lp AS (SELECT id, ln(n / (SELECT sum(n) FROM f)) AS lp FROM f),
 fl AS (SELECT lang, id, count(*) AS n FROM enc_ids GROUP BY lang, id),
 s AS (SELECT fl.lang, sum(fl.n * lp.lp) AS slp, sum(fl.n) AS n FROM fl JOIN lp ON fl.id = lp.id GROUP BY fl.lang),
 nb AS (SELECT lang, sum(octet_length(encode(text))) AS bytes, sum(length(text)) AS chars FROM documents GROUP BY lang)
 SELECT s.lang, round(exp(-slp / n), 6) AS perplexity, round(-slp / ln(2) / bytes, 6) AS bits_per_byte,
        round(-slp / ln(2) / chars, 6) AS bits_per_char FROM s JOIN nb ON s.lang = nb.lang""")
def perplexity(spark, sf):
    """Q12: perplexity and bits per byte/character from a log-prob table; the log-probs come
    from the corpus's own unigram token model (p = n/N)."""
    e = _sym_docs(spark, sf, ("lang",))
    fl = MX.token_freq(e, ("lang",))  # ≤ languages × vocabulary rows
    from pyspark.sql import Window
    # per-token totals and the grand total as windows over the small table: one pass over the corpus
    lp = F.log(F.sum("n").over(Window.partitionBy("id")) / F.sum("n").over(Window.partitionBy()))
    s = fl.withColumn("lp", lp).groupBy("lang").agg(F.sum(F.col("n") * F.col("lp")).alias("slp"),
                                                   F.sum("n").alias("n"))
    nb = _docs(spark, sf).groupBy("lang").agg(F.sum(F.octet_length("text")).alias("bytes"),
                                              F.sum(F.length("text")).alias("chars"))
    return s.join(nb, "lang").select(
        "lang", MX.r6(F.exp(-F.col("slp") / F.col("n"))).alias("perplexity"),
        MX.r6(-F.col("slp") / F.log(F.lit(2.0)) / F.col("bytes")).alias("bits_per_byte"),
        MX.r6(-F.col("slp") / F.log(F.lit(2.0)) / F.col("chars")).alias("bits_per_char"))


@query("prune_vocab", "WITH RECURSIVE " + _ENC + """,
 f AS (SELECT id, count(*) AS n FROM enc_ids GROUP BY id),
 rare AS (SELECT m.new_id AS id FROM merges m LEFT JOIN f ON f.id = m.new_id
          WHERE coalesce(f.n, 0) < 0.01 * (SELECT sum(n) FROM f)),
 clo(id) AS (SELECT id FROM rare UNION SELECT m.new_id FROM merges m JOIN clo ON m.left_id = clo.id OR m.right_id = clo.id)
 SELECT DISTINCT id::BIGINT AS id, (id IN (SELECT id FROM rare)) AS rare FROM clo""")
def prune_vocab(spark, sf):
    """Q8: merges used by under 1 % of all tokens, plus every merge built on a pruned one (closure over the merge table)."""
    m = regex_model(spark, sf)
    f = MX.token_freq(_sym_docs(spark, sf))
    merges = m.merges_df(spark).select(F.col("new_id").cast("bigint").alias("id"), "left_id", "right_id")
    total = f.agg(F.sum("n")).first()[0] or 0  # one scalar
    rare = merges.join(f, "id", "left").where(F.coalesce(F.col("n"), F.lit(0)) < F.lit(0.01 * total)).select("id")
    return VO.pruned_ids(merges, rare)


# == corpus transforms and other tokenizations ==========================================================

@query("word_vocab", f"""WITH w AS (SELECT lang, unnest(list_filter(regexp_split_to_array(text, {O.q(_WS + '+')}), lambda x: x <> '')) AS word FROM documents),
 top AS (SELECT word FROM (SELECT word, count(*) AS n FROM w GROUP BY word) t ORDER BY n DESC, word LIMIT 1000)
 SELECT lang, count(*)::BIGINT AS n_words, count(*) FILTER (WHERE top.word IS NULL)::BIGINT AS n_unk,
        round(count(*) FILTER (WHERE top.word IS NULL) / count(*), 6) AS unk_rate
 FROM w LEFT JOIN top ON w.word = top.word GROUP BY lang""")
def word_vocab(spark, sf):
    """Word-level vocabulary (top 1,000 whitespace words) and the <UNK> rate by language."""
    w = _docs(spark, sf).select("lang", F.explode(F.filter(F.split("text", _WS + "+"), lambda x: x != "")).alias("word"))
    top = w.groupBy("word").agg(F.count(F.lit(1)).alias("n")).orderBy(F.col("n").desc(), "word").limit(1000)
    j = w.join(F.broadcast(top.select("word", F.lit(True).alias("known"))), "word", "left")  # 1,000 rows
    return j.groupBy("lang").agg(F.count(F.lit(1)).alias("n_words"),
                                 F.sum(F.col("known").isNull().cast("int")).cast("bigint").alias("n_unk")) \
        .withColumn("unk_rate", MX.r6(F.col("n_unk") / F.col("n_words")))


@query("char_tokens", """
 SELECT lang, count(*)::BIGINT AS n_chars, count(DISTINCT ch)::BIGINT AS n_distinct
 FROM documents, LATERAL (SELECT unnest(string_split(text, '')) AS ch) u WHERE ch <> '' GROUP BY lang""")
def char_tokens(spark, sf):
    """Character-level tokenization: tokens and distinct characters by language."""
    ex = _docs(spark, sf).select("lang", F.explode(F.split("text", "")).alias("ch")).where(F.col("ch") != "")
    return ex.groupBy("lang").agg(F.count(F.lit(1)).alias("n_chars"), F.countDistinct("ch").alias("n_distinct"))


@query("byte_fallback", "WITH RECURSIVE " + _CHAR + """,
 u AS (SELECT lang, ch FROM documents, LATERAL (SELECT unnest(string_split(replace(text, ' ', '▁'), '')) AS ch) q WHERE ch <> '')
 SELECT lang, count(*) FILTER (WHERE a.c IS NULL)::BIGINT AS n_oov_chars,
        coalesce(sum(octet_length(encode(ch))) FILTER (WHERE a.c IS NULL), 0)::BIGINT AS n_fallback_tokens
 FROM u LEFT JOIN alpha a ON a.c = u.ch GROUP BY lang""")
def byte_fallback(spark, sf):
    """Characters outside the char model's alphabet become one <0xNN> token per UTF-8 byte."""
    m = char_model(spark, sf)
    cls = EN._char_class(m.alphabet)
    ex = _docs(spark, sf).select("lang", F.explode(F.split(F.replace(F.col("text"), F.lit(" "), F.lit("▁")), "")).alias("ch"))
    ex = ex.where(F.col("ch") != "").withColumn("oov", ~F.col("ch").rlike(f"^[{cls}]$"))
    return ex.groupBy("lang").agg(F.sum(F.col("oov").cast("int")).cast("bigint").alias("n_oov_chars"),
                                  F.coalesce(F.sum(F.when(F.col("oov"), F.octet_length("ch"))), F.lit(0)).cast("bigint")
                                  .alias("n_fallback_tokens"))


def byte_fallback_tokens(ch):
    """The ``<0xNN>`` tokens of one character."""
    return F.transform(F.regexp_extract_all(F.hex(F.encode(ch, "UTF-8")), F.lit(".."), 0), lambda h: F.concat(F.lit("<0x"), h, F.lit(">")))


_DECOMP = "replace(text, 'é', 'e' || chr(769))"


@query("nfc_audit", f"""
 SELECT lang, count(*)::BIGINT AS n_docs, count(*) FILTER (WHERE {_DECOMP} <> nfc_normalize({_DECOMP}))::BIGINT AS n_changed,
        sum(octet_length(encode({_DECOMP})))::BIGINT AS bytes_before,
        sum(octet_length(encode(nfc_normalize({_DECOMP}))))::BIGINT AS bytes_after
 FROM documents GROUP BY lang""")
def nfc_audit(spark, sf):
    """Texts whose é is written decomposed (e + U+0301): which would change under NFC, bytes saved."""
    t = F.replace(F.col("text"), F.lit("é"), F.lit("é"))
    x = _docs(spark, sf).select("lang", t.alias("t")).withColumn("n", TX.nfc("t"))
    return x.groupBy("lang").agg(F.count(F.lit(1)).alias("n_docs"),
                                 F.sum((F.col("t") != F.col("n")).cast("int")).cast("bigint").alias("n_changed"),
                                 F.sum(F.octet_length("t")).cast("bigint").alias("bytes_before"),
                                 F.sum(F.octet_length("n")).cast("bigint").alias("bytes_after"))


_HOMO = "CASE WHEN source = 'src7' THEN replace(text, 'o', 'о') ELSE text END"


@query("homoglyphs", f"""
 WITH w AS (SELECT doc_id, unnest(regexp_extract_all({_HOMO}, '\\p{{L}}+')) AS word FROM documents)
 SELECT doc_id, count(*)::BIGINT AS n_mixed_words FROM w
 WHERE regexp_matches(word, '\\p{{Latin}}') AND regexp_matches(word, '\\p{{Cyrillic}}|\\p{{Greek}}') GROUP BY doc_id""")
def homoglyphs(spark, sf):
    """Words mixing Latin with Cyrillic/Greek letters (source src7 has Cyrillic 'о' for 'o')."""
    t = F.when(F.col("source") == "src7", F.replace(F.col("text"), F.lit("o"), F.lit("о"))).otherwise(F.col("text"))
    x = _docs(spark, sf).select("doc_id", F.size(TX.mixed_script_words(t)).cast("bigint").alias("n_mixed_words"))
    return x.where(F.col("n_mixed_words") > 0)


@query("byte_patches", """
 SELECT lang, sum(octet_length(encode(text)))::BIGINT AS n_bytes,
        sum(ceil(octet_length(encode(text)) / 4))::BIGINT AS n_patches_4,
        sum(len(regexp_extract_all(text, '[^ ]* +|[^ ]+')))::BIGINT AS n_space_patches
 FROM documents GROUP BY lang""")
def byte_patches(spark, sf):
    """Fixed 4-byte patches and space-bounded patches per language."""
    d = _docs(spark, sf)
    return d.groupBy("lang").agg(
        F.sum(F.octet_length("text")).cast("bigint").alias("n_bytes"),
        F.sum(F.ceil(F.octet_length("text") / 4)).cast("bigint").alias("n_patches_4"),
        F.sum(F.size(F.regexp_extract_all("text", F.lit("[^ ]* +|[^ ]+"), 0))).cast("bigint").alias("n_space_patches"))


def byte_patch_column(text, width: int = 4):
    """The fixed-width byte patches of a text (BINARY pieces)."""
    b = F.encode(text, "UTF-8")
    cut = F.transform(F.sequence(F.lit(0), F.greatest(F.octet_length(b) - 1, F.lit(0)), F.lit(width)),
                      lambda i: F.substring(b, i + 1, width))
    return F.when(F.octet_length(b) > 0, cut).when(text.isNotNull() if hasattr(text, "isNotNull") else F.col(text).isNotNull(),
                                                   F.array().cast("array<binary>"))


_STRIPPED = f"regexp_replace(text, {O.q('^' + _WS + '+|' + _WS + '+$')}, '', 'g')"


@query("strip_effect", "WITH RECURSIVE " + _ENC + ",\n"
       + O.fold_docs_ctes("st", f"(SELECT doc_id, {_STRIPPED} AS text FROM documents)", "merges") + """
 SELECT e.source, count(*)::BIGINT AS n_docs,
        count(*) FILTER (WHERE substr(e.S, 1, 1) IS DISTINCT FROM substr(st.S, 1, 1))::BIGINT AS n_first_changed,
        sum(length(e.S) - length(st.S))::BIGINT AS tokens_saved
 FROM enc e JOIN st ON e.doc_id = st.doc_id GROUP BY e.source""")
def strip_effect(spark, sf):
    """Does stripping surrounding whitespace change the first token? By source."""
    m = regex_model(spark, sf)
    d = _docs(spark, sf)
    a = EN.text_symbols(F.col("text"), m)
    b = EN.text_symbols(F.regexp_replace("text", "^" + _WS + "+|" + _WS + "+$", ""), m)
    x = d.select("source", a.alias("a"), b.alias("b"))
    return x.groupBy("source").agg(
        F.count(F.lit(1)).alias("n_docs"),
        F.sum((~F.substring("a", 1, 1).eqNullSafe(F.substring("b", 1, 1))).cast("int")).cast("bigint").alias("n_first_changed"),
        F.sum(F.length("a") - F.length("b")).cast("bigint").alias("tokens_saved"))


@query("lang_balance", "WITH " + O.chunks_cte() + """,
 c AS (SELECT d.lang, count(DISTINCT d.doc_id) AS n_docs, count(x.chunk) AS n_chunks
       FROM documents d LEFT JOIN chunks x ON x.doc_id = d.doc_id GROUP BY d.lang)
 SELECT lang, n_docs::BIGINT AS n_docs, n_chunks::BIGINT AS n_chunks,
        round((SELECT sum(n_chunks) FROM c) / (SELECT count(*) FROM c) / n_chunks, 6) AS weight FROM c""")
def lang_balance(spark, sf):
    """Per-language weights that give every language the same share of training chunks."""
    d = _docs(spark, sf)
    n = d.select("doc_id", "lang", F.size(PT.split_column(F.col("text"))).alias("k"))
    g = n.groupBy("lang").agg(F.count(F.lit(1)).alias("n_docs"), F.coalesce(F.sum("k"), F.lit(0)).cast("bigint").alias("n_chunks"))
    from pyspark.sql import Window
    w = Window.partitionBy()  # one row per language
    return g.select("lang", "n_docs", "n_chunks",
                    MX.r6(F.sum("n_chunks").over(w) / F.count(F.lit(1)).over(w) / F.col("n_chunks")).alias("weight"))


# == WordPiece ==========================================================================================

from toksmith.operators import wordpiece as WPC  # noqa: E402

WP_MERGES = 20
_WP_MODELS: dict = {}


def wordpiece_model(spark, sf):
    key = (sf, WP_MERGES)
    if key not in _WP_MODELS:
        conv = corpus.conversations(spark, sf, "conv_id", "turn", "text")
        docs = conv.select((F.col("conv_id") * 1000 + F.col("turn")).alias("doc_id"), "text")
        _WP_MODELS[key] = WPC.train(docs, WP_MERGES)
    return _WP_MODELS[key]


_WP = f"""_wpw AS (SELECT doc_id, generate_subscripts(l, 1) - 1 AS p, unnest(l) AS w
          FROM (SELECT conv_id * 1000 + turn AS doc_id, regexp_extract_all(text, '\\p{{L}}+') AS l FROM conversations WHERE text IS NOT NULL) x),
_wpd AS (SELECT w AS c, count(*) AS n, min(doc_id::HUGEINT * 1000000000 + p) AS f FROM _wpw GROUP BY w),
walpha AS (SELECT c, row_number() OVER (ORDER BY c)::INTEGER AS id FROM (SELECT DISTINCT unnest(string_split(c, '')) AS c FROM _wpd) a WHERE c <> ''),
_wA AS (SELECT count(*)::INTEGER AS A FROM walpha),
_wtr AS (SELECT string_agg(c, '' ORDER BY id) AS src, string_agg(chr((256 + id)::INTEGER), '' ORDER BY id) AS ini,
                string_agg(chr((256 + A + id)::INTEGER), '' ORDER BY id) AS con FROM walpha, _wA GROUP BY A),
_wsrc AS (SELECT c, n, f, translate(substr(c, 1, 1), src, ini) || translate(substr(c, 2), src, con) AS s FROM _wpd, _wtr),
_ww(i, c, n, f, s, pr, k) AS (
  SELECT 0, c, n, f, s, NULL::VARCHAR, NULL::BIGINT FROM _wsrc
  UNION ALL
  SELECT i + 1, c, n, f, replace(s, t.pr, chr((256 + 2 * (SELECT A FROM _wA) + 1 + i)::INTEGER)), t.pr, t.k FROM _ww,
    (SELECT z.pr, z.k FROM
       (SELECT l[j] || l[j + 1] AS pr, sum(n)::BIGINT AS k, min(f * 1000000000 + j) AS pos
        FROM (SELECT n, f, string_split(s, '') AS l FROM _ww WHERE length(s) > 1) ww,
             LATERAL (SELECT unnest(range(1, len(l))) AS j) q GROUP BY 1) z
     JOIN (SELECT u, sum(n) AS nu FROM (SELECT n, unnest(string_split(s, '')) AS u FROM _ww) uu GROUP BY u) ua ON ua.u = substr(z.pr, 1, 1)
     JOIN (SELECT u, sum(n) AS nu FROM (SELECT n, unnest(string_split(s, '')) AS u FROM _ww) uu GROUP BY u) ub ON ub.u = substr(z.pr, 2, 1)
     ORDER BY z.k / (ua.nu::DOUBLE * ub.nu) DESC, z.k DESC, z.pos LIMIT 1) t
  WHERE i < {WP_MERGES}),
wpm AS (SELECT i - 1 AS rank, any_value(pr) AS pr, unicode(substr(any_value(pr), 1, 1)) - 256 AS left_id,
               unicode(substr(any_value(pr), 2, 1)) - 256 AS right_id, 2 * (SELECT A FROM _wA) + i AS new_id, any_value(k) AS freq
        FROM _ww WHERE i > 0 GROUP BY i),
""" + O.expand_cte("wpx", "(SELECT new_id AS key, chr((256 + new_id)::INTEGER) AS s FROM wpm)", "wpm") + """,
wpieces AS (SELECT key AS new_id, CASE WHEN unicode(substr(s, 1, 1)) - 256 > (SELECT A FROM _wA) THEN '##' ELSE '' END
                   || translate(s, (SELECT ini || con FROM _wtr), (SELECT src || src FROM _wtr)) AS piece FROM wpx)"""


@query("wordpiece_train", "WITH RECURSIVE " + _WP + """
 SELECT m.rank::BIGINT AS rank, m.left_id::BIGINT AS left_id, m.right_id::BIGINT AS right_id, m.new_id::BIGINT AS new_id,
        m.freq::BIGINT AS freq, p.piece FROM wpm m JOIN wpieces p ON p.new_id = m.new_id""")
def wordpiece_train(spark, sf):
    """WordPiece merges by score n(ab)/(n(a)·n(b)) on the words of the conversations."""
    m = wordpiece_model(spark, sf)
    rows = [(r, l, rt, n, f, p) for r, ((l, rt, n, f), p) in enumerate(zip(m.merges, m.pieces))]
    return spark.createDataFrame(rows, "rank BIGINT, left_id BIGINT, right_id BIGINT, new_id BIGINT, freq BIGINT, piece STRING")


@query("wordpiece_encode", "WITH RECURSIVE " + _WP + """,
 wvocab AS (SELECT piece, min(id) AS id FROM (SELECT c AS piece, id FROM walpha UNION ALL SELECT '##' || c, (SELECT A FROM _wA) + id FROM walpha
            UNION ALL SELECT piece, new_id FROM wpieces) v GROUP BY piece),
 _L AS (SELECT max(length(replace(piece, '##', ''))) AS L FROM wvocab),
 _dw AS (SELECT d.lang, t.w FROM documents d, LATERAL (SELECT unnest(regexp_extract_all(d.text, '\\p{L}+')) AS w) t),
 words AS (SELECT DISTINCT w FROM _dw),
 cand AS (SELECT w, st, ln FROM words, LATERAL (SELECT unnest(range(0, length(w))) AS st) a,
          LATERAL (SELECT unnest(range(1, (SELECT L FROM _L) + 1)) AS ln) b WHERE st + ln <= length(w)),
 edges AS (SELECT w, st, max(ln) AS ln FROM cand JOIN wvocab v
           ON v.piece = CASE WHEN st = 0 THEN '' ELSE '##' END || substr(w, st + 1, ln) GROUP BY w, st),
 walk(w, pos, ntok) AS (SELECT w, 0, 0 FROM words UNION ALL
           SELECT walk.w, walk.pos + e.ln, walk.ntok + 1 FROM walk JOIN edges e ON e.w = walk.w AND e.st = walk.pos),
 res AS (SELECT w, max(pos) = length(w) AS ok, max(ntok) AS ntok FROM walk GROUP BY w)
 SELECT lang, count(*)::BIGINT AS n_words, sum(CASE WHEN ok THEN ntok ELSE 1 END)::BIGINT AS n_tokens,
        count(*) FILTER (WHERE NOT ok)::BIGINT AS n_unk FROM _dw JOIN res ON _dw.w = res.w GROUP BY lang""")
def wordpiece_encode(spark, sf):
    """documents' words encoded greedily longest-match-first with the WordPiece vocabulary; [UNK] rate."""
    m = wordpiece_model(spark, sf)
    # words are counted by language before they meet their encoding: a row per (language, word), whatever a word's frequency
    occ = _docs(spark, sf).select("lang", F.explode(F.regexp_extract_all("text", F.lit(WPC.WORD_PATTERN), 0)).alias("word"))
    counts = write_once(occ.groupBy("lang", "word").agg(F.count(F.lit(1)).alias("n")))
    enc = WPC.encode_words(counts.select("word"), m)
    return counts.join(enc, "word").groupBy("lang").agg(
        F.sum("n").cast("bigint").alias("n_words"), F.sum(F.col("n") * F.size("ids")).cast("bigint").alias("n_tokens"),
        F.sum(F.when(F.col("ids") == F.array(F.lit(0)), F.col("n")).otherwise(0)).cast("bigint").alias("n_unk"))


# == subword regularization, vocabulary transfer, relational forms ==========================================

from toksmith.operators import regularize as RG  # noqa: E402

DROPOUT_P, DROPOUT_SEED = 0.1, 7


@query("bpe_dropout", "WITH RECURSIVE " + _ENC + f""",
 _dl AS (SELECT doc_id, lang, array_to_string(list_transform({O.split_list('text')}, lambda c: {O.byte_syms('c')}), chr(57345)) AS s
         FROM documents WHERE text IS NOT NULL),
 _df(i, doc_id, lang, s) AS (SELECT 0, doc_id, lang, s FROM _dl UNION ALL
    SELECT x.i + 1, x.doc_id, x.lang,
           CASE WHEN ((x.doc_id * {RG.HASH_MULT} + (x.i + 1) * {RG.HASH_STEP} + {DROPOUT_SEED}) % {RG.HASH_MOD}) < {int(DROPOUT_P * RG.HASH_MOD)}
                THEN x.s ELSE replace(x.s, m.pr, chr((256 + m.new_id)::INTEGER)) END
    FROM _df x JOIN merges m ON m.rank = x.i),
 _dd AS (SELECT doc_id, lang, length(replace(s, chr(57345), '')) AS n FROM _df WHERE i = {K_REGEX})
 SELECT d.lang, sum(e.n_tokens)::BIGINT AS n_tokens, sum(_dd.n)::BIGINT AS n_tokens_dropout
 FROM _dd JOIN enc e ON e.doc_id = _dd.doc_id JOIN documents d ON d.doc_id = _dd.doc_id GROUP BY d.lang""")
def bpe_dropout(spark, sf):
    """BPE-dropout (p = 0.1, one deterministic draw per merge and document) vs. plain encoding."""
    m = regex_model(spark, sf)
    d = _docs(spark, sf).where(F.col("text").isNotNull())
    x = d.select("lang", F.length(EN.text_symbols(F.col("text"), m)).alias("a"),
                 F.length(RG.dropout_symbols(F.col("text"), F.col("doc_id"), m, DROPOUT_P, DROPOUT_SEED)).alias("b"))
    return x.groupBy("lang").agg(F.sum("a").cast("bigint").alias("n_tokens"), F.sum("b").cast("bigint").alias("n_tokens_dropout"))


@query("vocab_transfer", "WITH RECURSIVE " + _VOCAB_SQL + ",\n" + _BVOCAB + ",\n" + O.basic_train_ctes(
    K_BASIC, _CONV_DOCS, "doc_id", "text", "bm2").split(",\n_src_bm2")[0].replace("_tx_bm2", "_unused_tx") + """,
 newp AS (SELECT v.id, v.piece_hex, b.id AS old_id FROM vocab v LEFT JOIN bvocab b ON b.piece_hex = v.piece_hex),
 """ + O.fold_docs_ctes("tp", "(SELECT id AS doc_id, decode(unhex(piece_hex), 'replace') AS text, piece_hex FROM newp WHERE old_id IS NULL)",
                        "bmerges", None).replace(
    "SELECT 0, chunk, " + O.byte_syms("chunk") + " FROM (SELECT DISTINCT chunk FROM _tp_ch) d",
    "SELECT 0, chunk, array_to_string(list_transform(regexp_extract_all(chunk, '..'), lambda h: chr((256 + ('0x' || h)::INTEGER)::INTEGER)), '') FROM (SELECT DISTINCT chunk FROM _tp_ch) d").replace(
    "SELECT doc_id, 0 AS chunk_pos, text AS chunk FROM (SELECT id AS doc_id", "SELECT doc_id, 0 AS chunk_pos, piece_hex AS chunk FROM (SELECT id AS doc_id") + """,
 parts AS (SELECT id, old_id AS part, 'copy' AS method FROM newp WHERE old_id IS NOT NULL
           UNION ALL SELECT doc_id, unicode(x) - 256, 'mean' FROM tp, LATERAL (SELECT unnest(string_split(S, '')) AS x) u),
 dims AS (SELECT vec_id, generate_subscripts(embedding, 1) AS dim, unnest(embedding)::DOUBLE AS v FROM embeddings),
 mv AS (SELECT p.id, p.method, d.dim, avg(d.v) AS v, count(*) AS k FROM parts p JOIN dims d ON d.vec_id = p.part GROUP BY p.id, p.method, d.dim)
 SELECT id::BIGINT AS id, any_value(method) AS method, max(k)::BIGINT AS n_parts, round(sum(v), 3) AS vec_sum FROM mv GROUP BY id""")
def vocab_transfer(spark, sf):
    """Vectors for the documents model's vocabulary from an older model (the conversations model,
    whose token i has embeddings.vec_id = i): copy when the piece exists, else the mean of the old
    tokens that encode the piece."""
    new, old = regex_model(spark, sf), basic_model(spark, sf)
    nv = new.vocab_df(spark).select(F.col("id").alias("nid"), F.col("piece").alias("p"))
    ov = old.vocab_df(spark).select(F.col("id").alias("oid"), F.col("piece").alias("q"))
    j = nv.join(F.broadcast(ov), nv["p"] == ov["q"], "left")  # both sides bounded by vocabulary size
    copy = j.where(F.col("oid").isNotNull()).select("nid", F.col("oid").alias("part"), F.lit("copy").alias("method"))
    enc = j.where(F.col("oid").isNull()).select("nid", EN.symbols_ids(EN.fold(F.decode(F.col("p"), "ISO-8859-1"), old)).alias("ids"))
    mean = enc.select("nid", F.explode("ids").alias("part"), F.lit("mean").alias("method"))
    parts = copy.unionByName(mean)
    emb = corpus.table(spark, sf, "embeddings", "vec_id", "embedding")
    dims = emb.select("vec_id", F.posexplode("embedding").alias("dim", "v"))
    mv = parts.join(dims, parts["part"] == dims["vec_id"]).groupBy("nid", "method", "dim").agg(
        F.avg(F.col("v").cast("double")).alias("v"), F.count(F.lit(1)).alias("k"))
    return mv.groupBy(F.col("nid").cast("bigint").alias("id")).agg(
        F.first("method").alias("method"), F.max("k").cast("bigint").alias("n_parts"), F.round(F.sum("v"), 3).alias("vec_sum"))


@query("bigram_window", "WITH RECURSIVE " + _ENC + """,
 t AS (SELECT doc_id, p, unicode(x) - 256 AS id FROM enc, LATERAL (SELECT generate_subscripts(string_split(S, ''), 1) AS p,
        unnest(string_split(S, '')) AS x) u WHERE length(S) > 0),
 w AS (SELECT id AS a, lead(id) OVER (PARTITION BY doc_id ORDER BY p) AS b FROM t)
 SELECT a::BIGINT AS a, b::BIGINT AS b, count(*)::BIGINT AS n FROM w WHERE b IS NOT NULL GROUP BY a, b""")
def bigram_window(spark, sf):
    """Adjacent token pairs as a sliding window of width 2 over the long (doc_id, pos, id) form."""
    from pyspark.sql import Window
    e = _enc_docs(spark, sf, ())
    t = e.select("doc_id", F.posexplode(EN.each()).alias("pos", "id"))
    w = t.withColumn("b", F.lead("id").over(Window.partitionBy("doc_id").orderBy("pos")))
    return w.where(F.col("b").isNotNull()).groupBy(F.col("id").cast("bigint").alias("a"), F.col("b").cast("bigint").alias("b")) \
        .agg(F.count(F.lit(1)).alias("n"))


MODALITY_OFFSET = 1000


@query("id_ranges", "WITH RECURSIVE " + _ENC + ",\n"
       + O.basic_train_ctes(K_BASIC, _CONV_DOCS, "doc_id", "text") + ",\n"
       + O.fold_docs_ctes("pg", "(SELECT page_id AS doc_id, html AS text FROM pages)", "bmerges", None) + f""",
 u AS (SELECT 'text' AS stream, unicode(x) - 256 AS id FROM enc, LATERAL (SELECT unnest(string_split(S, '')) AS x) q WHERE length(S) > 0
       UNION ALL SELECT 'html', unicode(x) - 256 + {MODALITY_OFFSET} FROM pg, LATERAL (SELECT unnest(string_split(S, '')) AS x) q WHERE length(S) > 0)
 SELECT stream, count(*)::BIGINT AS n_tokens, min(id)::BIGINT AS min_id, max(id)::BIGINT AS max_id FROM u GROUP BY stream""")
def id_ranges(spark, sf):
    """Two token streams (document text, page HTML) in disjoint ID ranges (HTML IDs + 1,000)."""
    a = EN.encode_symbols(_docs(spark, sf), regex_model(spark, sf))
    pg = corpus.table(spark, sf, "pages", "page_id", "html")
    b = EN.encode_symbols(pg, basic_model(spark, sf), text_col="html", id_col="page_id")
    fa = MX.token_freq(a).withColumn("stream", F.lit("text"))
    fb = MX.token_freq(b).withColumn("stream", F.lit("html")).withColumn("id", F.col("id") + MODALITY_OFFSET)
    u = fa.unionByName(fb)
    return u.groupBy("stream").agg(F.sum("n").cast("bigint").alias("n_tokens"), F.min("id").alias("min_id"),
                                   F.max("id").alias("max_id"))


@query("logprob_norm", "WITH RECURSIVE " + _VOCAB_SQL + ",\n" + _ENC.split("WITH RECURSIVE ")[-1].replace(_REGEX + ",\n", "") + """,
 f AS (SELECT id, count(*) AS n FROM enc_ids GROUP BY id),
 lp AS (SELECT f.id, ln(f.n / (SELECT sum(n) FROM f)) AS lp, length(v.piece_hex) / 2 AS nbytes FROM f JOIN vocab v ON v.id = f.id),
 fl AS (SELECT lang, id, count(*) AS n FROM enc_ids GROUP BY lang, id)
 SELECT fl.lang, round(sum(fl.n * lp.lp) / sum(fl.n), 6) AS avg_logprob,
        round(sum(fl.n * lp.lp / lp.nbytes) / sum(fl.n), 6) AS avg_logprob_per_byte
 FROM fl JOIN lp ON fl.id = lp.id GROUP BY fl.lang""")
def logprob_norm(spark, sf):
    """Q13: length-normalised token log-probability (per token and per byte of the piece), by language."""
    m = regex_model(spark, sf)
    e = _sym_docs(spark, sf, ("lang",))
    fl = MX.token_freq(e, ("lang",))  # ≤ languages × vocabulary rows
    from pyspark.sql import Window
    v = m.vocab_df(spark).select(F.col("id").cast("bigint").alias("id"), F.octet_length("piece").alias("nbytes"))
    lp = F.log(F.sum("n").over(Window.partitionBy("id")) / F.sum("n").over(Window.partitionBy()))
    x = fl.withColumn("lp", lp).join(F.broadcast(v), "id")
    return x.groupBy("lang").agg(MX.r6(F.sum(F.col("n") * F.col("lp")) / F.sum("n")).alias("avg_logprob"),
                                 MX.r6(F.sum(F.col("n") * F.col("lp") / F.col("nbytes")) / F.sum("n")).alias("avg_logprob_per_byte"))


# == unigram language model (checked against a brute-force loop in tests/test_unigram.py) ====================

from toksmith.operators import unigram as UG  # noqa: E402

UNIGRAM_SIZE, UNIGRAM_MAXLEN = 300, 8
_UG_MODELS: dict = {}


def unigram_vocab(spark, sf):
    key = (sf, UNIGRAM_SIZE)
    if key not in _UG_MODELS:
        conv = corpus.conversations(spark, sf, "conv_id", "turn", "text")
        docs = conv.select((F.col("conv_id") * 1000 + F.col("turn")).alias("doc_id"), "text")
        v = UG.train(docs, UNIGRAM_SIZE, max_len=UNIGRAM_MAXLEN, em_iters=1, shrink=0.5)
        _UG_MODELS[key] = spark.createDataFrame([(r["piece"], r["logp"]) for r in v.collect()], "piece STRING, logp DOUBLE")
    return _UG_MODELS[key]


@query("unigram_train")
def unigram_train(spark, sf):
    """Unigram vocabulary (hard EM + loss pruning) learned from the conversations."""
    return unigram_vocab(spark, sf).select("piece", MX.r6("logp").alias("logp"))


def _doc_chunks(spark, sf):
    return PT.split_chunks(_docs(spark, sf))


@query("unigram_viterbi")
def unigram_viterbi(spark, sf):
    """Best unigram segmentation of every distinct document chunk, joined back; tokens by language."""
    v = unigram_vocab(spark, sf)
    occ = _docs(spark, sf).select("lang", F.explode(PT.split_column("text")).alias("chunk"))
    counts = write_once(occ.groupBy("lang", "chunk").agg(F.count(F.lit(1)).alias("n")))  # a row per (language, chunk)
    seg = UG.segment(counts.select("chunk").distinct(), v, UNIGRAM_MAXLEN).select("chunk", F.size("pieces").alias("k"))
    return counts.join(seg, "chunk").groupBy("lang").agg(F.sum("n").cast("bigint").alias("n_chunks"), F.sum(F.col("n") * F.col("k")).cast("bigint").alias("n_tokens"))


@query("unigram_sample")
def unigram_sample(spark, sf):
    """Sampled segmentations (subword regularization), one draw per distinct chunk and seed."""
    v = unigram_vocab(spark, sf)
    ch = _doc_chunks(spark, sf).select("chunk").distinct()
    s = UG.sample(ch, v, UNIGRAM_MAXLEN, F.col("chunk"), seed=3)
    return s.select("chunk", F.size("pieces").cast("bigint").alias("n_pieces"),
                    (F.array_join("pieces", "") == F.col("chunk")).alias("covers"))


# == model summary, caller's split pattern ================================================================

@query("model_summary", "WITH RECURSIVE " + _REGEX + """
 SELECT 'regex' AS kind, (256 + count(*))::BIGINT AS vocab_size, count(*)::BIGINT AS n_merges,
        max(freq)::BIGINT AS max_freq, min(freq)::BIGINT AS min_freq FROM merges""")
def model_summary(spark, sf):
    """One-row summary of the trained model (size, merges, merge frequency range)."""
    m = regex_model(spark, sf)
    return m.merges_df(spark).agg(
        F.lit(m.kind).alias("kind"), (F.lit(256) + F.count(F.lit(1))).cast("bigint").alias("vocab_size"),
        F.count(F.lit(1)).alias("n_merges"), F.max("freq").cast("bigint").alias("max_freq"),
        F.min("freq").cast("bigint").alias("min_freq"))


CUSTOM_PATTERN = r"\p{L}+|\p{N}+|[^\p{L}\p{N}]+"


@query("presplit_custom", f"""
 WITH c AS (SELECT doc_id, regexp_extract_all(text, {O.q(CUSTOM_PATTERN)}) AS l FROM documents WHERE text IS NOT NULL)
 SELECT doc_id, (generate_subscripts(l, 1) - 1)::BIGINT AS chunk_pos, unnest(l) AS chunk FROM c""")
def presplit_custom(spark, sf):
    """Pre-split with a caller's pattern (letters, digits, other runs)."""
    c = PT.split_chunks(_docs(spark, sf), CUSTOM_PATTERN)
    return c.select("doc_id", F.col("chunk_pos").cast("bigint"), "chunk")


@query("encode_regex_dictionary", ORACLE["encode_regex"])
def encode_regex_dictionary(spark, sf):
    """E2/J3, large-model plan: distinct chunks encoded with only the merges whose bytes occur in
    them (substring ⋈ broadcast piece table), joined back (hot chunks broadcast, the rest
    shuffled), rows rebuilt in chunk order.  Same result as the inline plan."""
    m = regex_model(spark, sf)
    e = EN.encode(_docs(spark, sf), m, strategy="dictionary")
    return e.select("doc_id", F.col("n_tokens").cast("bigint"), _ids_str().alias("ids"))


@query("encode_basic_dictionary", ORACLE["encode_basic"])
def encode_basic_dictionary(spark, sf):
    """E1 by the large-vocabulary plan: whole texts cut where no merge spans."""
    return encode_basic(spark, sf, "dictionary")


@query("encode_char_dictionary", ORACLE["encode_char"])
def encode_char_dictionary(spark, sf):
    """E4 by the large-vocabulary plan."""
    return encode_char(spark, sf, "dictionary")


@query("encode_specials_dictionary", ORACLE["encode_specials"])
def encode_specials_dictionary(spark, sf):
    """E3 by the large-vocabulary plan, special tokens allowed."""
    return encode_specials(spark, sf, "dictionary")


@query("encode_repeated", "WITH RECURSIVE " + _ENC + f"""
 SELECT (doc_id // 3)::BIGINT AS doc_id, CASE WHEN doc_id % 10 = 0 THEN -1 ELSE n_tokens::BIGINT END AS n_tokens,
        CASE WHEN doc_id % 10 = 0 THEN NULL ELSE {O.ids_of('S')} END AS ids FROM enc""")
def encode_repeated(spark, sf):
    """E2 by the large-vocabulary plan with repeated ids (each three documents share one) and NULL texts."""
    docs = _docs(spark, sf).select((F.expr("doc_id div 3")).alias("doc_id"), F.when(F.col("doc_id") % 10 != 0, F.col("text")).alias("text"))
    e = EN.encode(docs, regex_model(spark, sf), strategy="dictionary")
    n = F.coalesce(F.col("n_tokens").cast("bigint"), F.lit(-1).cast("bigint")).alias("n_tokens")  # -1: no text
    return e.select("doc_id", n, F.when(F.col("ids").isNotNull(), _ids_str()).alias("ids"))


from toksmith.plans import results  # noqa: E402, F401  (registers its queries)
