"""The registered queries of this subpackage, and their SQL where SQL can express them."""

from __future__ import annotations

from railtempo.llm import (
    decontaminate,
    language_id,
    lm_scoring,
    mixing,
    prefix_trie,
    quality_classifier,
    quality_rules,
    simhash_dedup,
    substring_dedup,
    suffix_dedup,
    token_alignment,
    tool_calls,
    vector_search,
)

QUERIES = {
    "op1_suffix_dedup": suffix_dedup.op1_suffix_dedup,
    "op2_tool_calls": tool_calls.op2_tool_calls,
    "op3_language_id": language_id.op3_language_id,
    "op4_simhash_dedup": simhash_dedup.op4_simhash_dedup,
    "op5_decontaminate": decontaminate.op5_decontaminate,
    "op6_quality_classifier": quality_classifier.op6_quality_classifier,
    "op7_quality_rules": quality_rules.op7_quality_rules,
    "op8_substring_dedup": substring_dedup.op8_substring_dedup,
    "op9_lm_scoring": lm_scoring.op9_lm_scoring,
    "op10_mixing": mixing.op10_mixing,
    "op11_prefix_trie": prefix_trie.op11_prefix_trie,
    "op12_token_alignment": token_alignment.op12_token_alignment,
    "op13_vector_search": vector_search.op13_vector_search,
}

SQL: dict[str, str] = {
    "op1_suffix_dedup": suffix_dedup.OP1_SQL,
    "op2_tool_calls": tool_calls.OP2_SQL,
    "op5_decontaminate": decontaminate.OP5_SQL,
    "op8_substring_dedup": substring_dedup.OP8_SQL,
    "op11_prefix_trie": prefix_trie.OP11_SQL,
    "op13_vector_search": vector_search.OP13_SQL,
}
