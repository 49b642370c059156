"""DuckDB SQL that recomputes each registered query independently.

RE2 has no look-ahead or possessive quantifiers, so the GPT-4 split is
rewritten: a marker M (U+E000) is put before the last whitespace character
that precedes a non-space, the pattern below is matched, and M is removed.
RE2's ``\\s`` is ASCII-only, which is adequate for the test tables.
Symbols in the oracle are ``chr(256 + id)``.
"""

from __future__ import annotations

M = ""
# Look-ahead-free form of the GPT-4 pattern for RE2 (M = marker).
GPT4_RE2 = (
    "M?'(?i:[sdmt]|ll|ve|re)|M?[^\\r\\n\\p{L}\\p{N}M]?\\p{L}+|\\p{N}{1,3}|M? ?[^\\s\\p{L}\\p{N}M]+[\\r\\nM]*"
    "|[\\sM]*[\\r\\n]|\\s+M|\\s+$|M?\\s+"
).replace("M", M)


def q(s: str) -> str:
    """SQL string literal."""
    return "'" + s.replace("'", "''") + "'"


GPT2_RE2 = GPT4_RE2.replace("(?i:", "(?:")


def split_list(text: str, pattern: str = "gpt4") -> str:
    """SQL list of GPT-4 (or GPT-2) chunks of ``text``."""
    p = GPT4_RE2 if pattern == "gpt4" else GPT2_RE2
    return (f"list_transform(regexp_extract_all(regexp_replace({text}, '(\\s\\S)', {q(M)} || '\\1', 'g'), "
            f"{q(p)}), lambda x: replace(x, {q(M)}, ''))")


def byte_list(s: str) -> str:
    """SQL list of the UTF-8 byte values of ``s``."""
    return f"list_transform(regexp_extract_all(hex(encode({s})), '..'), lambda h: ('0x' || h)::INTEGER)"


def byte_syms(s: str) -> str:
    return f"array_to_string(list_transform({byte_list(s)}, lambda b: chr(256 + b)), '')"


def chunks_cte(table: str = "documents", id_col: str = "doc_id", text_col: str = "text",
               pattern: str = "gpt4") -> str:
    """CTEs ``_d`` (chunk lists) and ``chunks(doc_id, chunk_pos, chunk)`` with 0-based positions."""
    return (
        f"_d AS (SELECT {id_col} AS doc_id, {split_list(text_col, pattern)} AS l FROM {table} WHERE {text_col} IS NOT NULL),\n"
        "chunks AS (SELECT doc_id, generate_subscripts(l, 1) - 1 AS chunk_pos, unnest(l) AS chunk FROM _d)"
    )


def train_cte(k, source: str, first_id=256, name: str = "merges") -> str:
    """Recursive training over ``source(c, s, n, f)`` (key, symbol string, weight, first position HUGEINT).

    Produces CTEs ``name(rank, pr, left_id, right_id, new_id, freq, total_tokens)`` and
    ``name_final(c, s, n)`` (the symbols after all merges).  Pairs are read from
    ``string_split(s, '')`` (O(1) per position, also for long unsplit texts).
    """
    w = f"_w_{name}"
    return f"""{w}(i, c, n, f, s, pr, k) AS (
    SELECT 0, c, n, f, s, NULL::VARCHAR, NULL::BIGINT FROM {source}
    UNION ALL
    SELECT i + 1, c, n, f, replace(s, t.pr, chr((256 + ({first_id}) + i)::INTEGER)), t.pr, t.k FROM {w},
      (SELECT pr, k FROM (SELECT l[j] || l[j + 1] AS pr, sum(n)::BIGINT AS k,
                                 min(f * 1000000000 + j) AS pos
                          FROM (SELECT n, f, string_split(s, '') AS l FROM {w} WHERE length(s) > 1) ww,
                               LATERAL (SELECT unnest(range(1, len(l))) AS j) q
                          GROUP BY 1) z
       ORDER BY k DESC, pos LIMIT 1) t
    WHERE i < ({k})),
_last_{name} AS (SELECT max(i) AS i FROM {w}),
{name}_final AS (SELECT c, s, n FROM {w} WHERE i = (SELECT i FROM _last_{name})),
{name} AS (SELECT i - 1 AS rank, any_value(pr) AS pr,
        (unicode(substr(any_value(pr), 1, 1)) - 256) AS left_id,
        (unicode(substr(any_value(pr), 2, 1)) - 256) AS right_id,
        (({first_id}) + i - 1) AS new_id, any_value(k) AS freq,
        sum(n * length(s))::BIGINT AS total_tokens
      FROM {w} WHERE i > 0 GROUP BY i)"""


def regex_train_ctes(k: int, table: str = "documents", id_col: str = "doc_id", text_col: str = "text",
                     name: str = "merges") -> str:
    """Chunks → dictionary → byte symbols → training; exposes ``chunks``, ``dic``, ``name``, ``name_final``."""
    return (
        chunks_cte(table, id_col, text_col) + ",\n"
        "dic AS (SELECT chunk, count(*) AS n, min(doc_id::HUGEINT * 1000000000 + chunk_pos) AS f FROM chunks GROUP BY chunk),\n"
        f"_src_{name} AS (SELECT chunk AS c, n, f, {byte_syms('chunk')} AS s FROM dic),\n"
        + train_cte(k, f"_src_{name}", 256, name)
    )


def basic_train_ctes(k: int, table: str, id_col: str, text_col: str, name: str = "bmerges") -> str:
    """Whole texts (no split) → byte symbols → training."""
    return (
        f"_tx_{name} AS (SELECT {text_col} AS c, count(*) AS n, min({id_col})::HUGEINT * 1000000000 AS f "
        f"FROM {table} WHERE {text_col} IS NOT NULL GROUP BY {text_col}),\n"
        f"_src_{name} AS (SELECT c, n, f, {byte_syms('c')} AS s FROM _tx_{name}),\n"
        + train_cte(k, f"_src_{name}", 256, name)
    )


def ids_of(sym_expr: str) -> str:
    """Space-separated token IDs of an oracle symbol string."""
    return (f"CASE WHEN length({sym_expr}) = 0 THEN '' ELSE array_to_string(list_transform("
            f"string_split({sym_expr}, ''), lambda x: unicode(x) - 256), ' ') END")


def sym_hex(s: str) -> str:
    """Uppercase hex of the bytes of a byte-level oracle symbol string."""
    return f"array_to_string(list_transform(string_split({s}, ''), lambda x: printf('%02X', unicode(x) - 256)), '')"


def expand_cte(name: str, source: str, merges: str = "merges", k=None) -> str:
    """Reverse fold: replace each merge symbol by its pair, highest rank first.
    ``source(key, s)`` → CTE ``name(key, s)`` with base symbols only."""
    kk = k if k is not None else f"(SELECT count(*) FROM {merges})"
    return f"""_x_{name}(i, key, s) AS (
    SELECT {kk}, key, s FROM {source}
    UNION ALL
    SELECT x.i - 1, x.key, replace(x.s, chr((256 + m.new_id)::INTEGER), m.pr) FROM _x_{name} x JOIN {merges} m ON m.rank = x.i - 1
    WHERE x.i > 0),
{name} AS (SELECT key, s FROM _x_{name} WHERE i = 0)"""


def char_train_ctes(vocab: int, table: str, id_expr: str, text_col: str = "text", name: str = "cmerges") -> str:
    """Char model: space → ▁, alphabet in code-point order from ID 3, whole texts."""
    return f"""_cv AS (SELECT {id_expr} AS doc_id, replace({text_col}, ' ', '▁') AS t FROM {table} WHERE {text_col} IS NOT NULL),
alpha AS (SELECT c, (row_number() OVER (ORDER BY c) + 2)::INTEGER AS id
          FROM (SELECT DISTINCT unnest(string_split(t, '')) AS c FROM _cv) a WHERE c <> ''),
_tr AS (SELECT string_agg(c, '' ORDER BY id) AS src, string_agg(chr((256 + id)::INTEGER), '' ORDER BY id) AS dst FROM alpha),
_ctx AS (SELECT t AS c, count(*) AS n, min(doc_id)::HUGEINT * 1000000000 AS f FROM _cv GROUP BY t),
_src_{name} AS (SELECT c, n, f, translate(c, src, dst) AS s FROM _ctx, _tr),
""" + train_cte(f"{vocab} - 3 - (SELECT count(*) FROM alpha)", f"_src_{name}",
                "(SELECT count(*) + 3 FROM alpha)", name)


def fold_docs_ctes(name: str, source: str, merges: str = "merges", pattern: str | None = "gpt4") -> str:
    """Encode any ``source(doc_id, text)`` with a trained byte model: chunks →
    distinct chunks → merges folded in rank order (recursive) → join back.
    ``pattern=None`` treats each text as one chunk.  Exposes ``name(doc_id, S)``."""
    if pattern is None:
        ch = (f"_{name}_ch AS (SELECT doc_id, 0 AS chunk_pos, text AS chunk FROM {source} "
              f"WHERE text IS NOT NULL AND length(text) > 0)")
    else:
        ch = (f"_{name}_l AS (SELECT doc_id, {split_list('text', pattern)} AS l FROM {source} WHERE text IS NOT NULL),\n"
              f"_{name}_ch AS (SELECT doc_id, generate_subscripts(l, 1) - 1 AS chunk_pos, unnest(l) AS chunk FROM _{name}_l)")
    return f"""{ch},
_{name}_f(i, chunk, s) AS (
    SELECT 0, chunk, {byte_syms('chunk')} FROM (SELECT DISTINCT chunk FROM _{name}_ch) d
    UNION ALL
    SELECT x.i + 1, x.chunk, replace(x.s, m.pr, chr((256 + m.new_id)::INTEGER)) FROM _{name}_f x JOIN {merges} m ON m.rank = x.i),
_{name}_fin AS (SELECT chunk, s FROM _{name}_f WHERE i = (SELECT count(*) FROM {merges})),
_{name}_docs AS (SELECT c.doc_id, string_agg(f.s, '' ORDER BY c.chunk_pos) AS S
                 FROM _{name}_ch c JOIN _{name}_fin f ON c.chunk = f.chunk GROUP BY c.doc_id),
{name} AS (SELECT s.doc_id, coalesce(d.S, '') AS S FROM {source} s LEFT JOIN _{name}_docs d ON s.doc_id = d.doc_id)"""
