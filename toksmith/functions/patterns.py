"""Pre-split patterns.

Java regular expressions support ``\\p{L}``, possessive quantifiers and
look-ahead, so the canonical patterns run unchanged inside
``regexp_extract_all``; the ``(?U)`` flag makes ``\\s`` and friends Unicode-aware,
as in the Python ``regex`` module.
"""

# ---------------------------------------------------------------------------
# The two split patterns must equal the published ones so that
# chunk boundaries (and therefore merges) agree.
# ---------------------------------------------------------------------------
GPT2_SPLIT_PATTERN = (
    r"""'(?:[sdmt]|ll|ve|re)|[^\r\n\p{L}\p{N}]?\p{L}+|\p{N}{1,3}| ?[^\s\p{L}\p{N}]+[\r\n]*|\s*[\r\n]+|\s+(?!\S)|\s+"""
)
GPT4_SPLIT_PATTERN = (
    r"""'(?i:[sdmt]|ll|ve|re)|[^\r\n\p{L}\p{N}]?+\p{L}+|\p{N}{1,3}| ?[^\s\p{L}\p{N}]++[\r\n]*|\s*[\r\n]|\s+(?!\S)|\s+"""
)
# Special tokens of the char model: unknown, begin and end of sequence.
SP_UNK, SP_BOS, SP_EOS = 0, 1, 2
SP_SPECIALS = {"<unk>": SP_UNK, "<s>": SP_BOS, "</s>": SP_EOS}
SPACE_MARK = "▁"  # the "lower one eighth block" that stands for a space
# ---------------------------------------------------------------------------

PATTERNS = {"gpt4": GPT4_SPLIT_PATTERN, "gpt2": GPT2_SPLIT_PATTERN}


def resolve(pattern: str | None) -> str:
    """Name (``gpt4``/``gpt2``) or literal pattern → pattern text; None → GPT-4."""
    if pattern is None:
        return GPT4_SPLIT_PATTERN
    return PATTERNS.get(pattern, pattern)


def java_pattern(pattern: str | None) -> str:
    """The pattern with Unicode character classes switched on."""
    return "(?U)" + resolve(pattern)


def special_alternation(tokens: list[str]) -> str:
    """Longest-first alternation of literal tokens (``\\Q..\\E`` quoted)."""
    ordered = sorted(set(tokens), key=lambda t: (-len(t), t))
    return "|".join(_quote(t) for t in ordered)


def _quote(token: str) -> str:
    # \Q...\E cannot contain \E; split around it.
    return "\\Q" + token.replace("\\E", "\\E\\\\E\\Q") + "\\E"


def segment_pattern(tokens: list[str]) -> str:
    """Regex that yields, left to right, either a special token or the longest
    run of text before the next special token (or the end)."""
    alt = special_alternation(tokens)
    return f"(?s)(?:{alt})|.+?(?=(?:{alt})|\\z)"
