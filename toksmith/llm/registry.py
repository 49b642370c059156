"""Queries and oracle SQL of the subpackage."""

from __future__ import annotations

from toksmith.llm import (
    op1_language_id,
    op10_sentencepiece,
    op11_conversation_repair,
    op12_token_counts,
    op13_prefix_trie,
    op2_jaccard_join,
    op3_pii,
    op4_decontamination,
    op5_line_dedup,
    op6_sharding,
    op7_warc_revisits,
    op8_suffix_dedup,
    op9_quality_rules,
)

QUERIES = {
    "op1_language_id": op1_language_id.op1_language_id,
    "op2_jaccard_join": op2_jaccard_join.op2_jaccard_join,
    "op3_pii": op3_pii.op3_pii,
    "op4_decontamination": op4_decontamination.op4_decontamination,
    "op5_line_dedup": op5_line_dedup.op5_line_dedup,
    "op6_sharding": op6_sharding.op6_sharding,
    "op7_warc_revisits": op7_warc_revisits.op7_warc_revisits,
    "op8_suffix_dedup": op8_suffix_dedup.op8_suffix_dedup,
    "op9_quality_rules": op9_quality_rules.op9_quality_rules,
    "op10_sentencepiece": op10_sentencepiece.op10_sentencepiece,
    "op11_conversation_repair": op11_conversation_repair.op11_conversation_repair,
    "op12_token_counts": op12_token_counts.op12_token_counts,
    "op13_prefix_trie": op13_prefix_trie.op13_prefix_trie,
}

ORACLE: dict[str, str] = {
    "op5_line_dedup": op5_line_dedup.ORACLE,
    "op7_warc_revisits": op7_warc_revisits.ORACLE,
}
