"""Queries of the training-data operators and, where SQL can say it, their SQL."""

from __future__ import annotations

from terraweave.llm import chat_format, katz_lm, language_id, mixing, packing, phrase_mining, piece_codec, prefix_trie, quality_rules, simhash_dedup, substring_dedup, topk_search, toxicity

QUERIES = {
    "op1_topk_search": topk_search.op1_topk_search,
    "op2_substring_dedup": substring_dedup.op2_substring_dedup,
    "op3_quality_rules": quality_rules.op3_quality_rules,
    "op4_source_mixing": mixing.op4_source_mixing,
    "op5_toxicity": toxicity.op5_toxicity,
    "op6_chat_format": chat_format.op6_chat_format,
    "op7_simhash_dedup": simhash_dedup.op7_simhash_dedup,
    "op8_bin_completion": packing.op8_bin_completion,
    "op9_katz_lm": katz_lm.op9_katz_lm,
    "op10_language_id": language_id.op10_language_id,
    "op11_prefix_trie": prefix_trie.op11_prefix_trie,
    "op12_phrase_mining": phrase_mining.op12_phrase_mining,
    "op13_piece_codec": piece_codec.op13_piece_codec,
}

ORACLES = {
    "op1_topk_search": topk_search.ORACLE,
    "op2_substring_dedup": substring_dedup.ORACLE,
    "op6_chat_format": chat_format.ORACLE,
    "op11_prefix_trie": prefix_trie.ORACLE,
    "op12_phrase_mining": phrase_mining.ORACLE,
}
